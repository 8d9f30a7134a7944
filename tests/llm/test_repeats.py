"""Repeated windows against brute force."""

import hashlib

import pytest

from clickmill.llm import repeats
from clickmill.llm.op4_substring import substring_dedup
from clickmill.llm.op8_suffix_array import suffix_array_dedup, suffix_array_text


def sha(data):
    return hashlib.sha256(data).hexdigest()


def low(doc_id):
    return -10**18 if doc_id is None else doc_id


def brute_words(rows, length):
    rows = sorted(rows, key=lambda r: (low(r[0]), r[1] or ""))
    first = {}
    for i, text in rows:
        w = (text or "").encode().split()
        for k in range(len(w) - length + 1):
            first.setdefault(tuple(w[k:k + length]), low(i))
    out = []
    for i, text in rows:
        w = (text or "").encode().split()
        hit = [0] * len(w)
        for k in range(len(w) - length + 1):
            if first[tuple(w[k:k + length])] < low(i):
                hit[k:k + length] = [1] * length
        out.append((i, len(w), sum(hit), sha(b" ".join(x for x, h in zip(w, hit) if not h))))
    return sorted(out, key=repr)


def brute_bytes(rows, length):
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (low(r[0]), r[1] or "")):
        b = (text or "").encode()
        hit = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if b[k:k + length] in seen:
                hit[k:k + length] = b"\1" * length
            seen.add(b[k:k + length])
        spans = sum(1 for k, h in enumerate(hit) if h and not (k and hit[k - 1]))
        out.append((i, len(b), sum(hit), spans, sha(bytes(x for x, h in zip(b, hit) if not h))))
    return sorted(out, key=repr)


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["edge_docs", "small_docs", "no_docs"])
def test_substring_dedup(request, which):
    docs = request.getfixturevalue(which)
    got = sorted(map(tuple, substring_dedup(docs, digest=True).collect()), key=repr)
    assert got == brute_words(pairs(docs), 13)


@pytest.mark.parametrize("which", ["edge_docs", "small_docs", "no_docs"])
def test_suffix_array(request, which):
    docs = request.getfixturevalue(which)
    got = sorted(map(tuple, suffix_array_dedup(docs).collect()), key=repr)
    assert got == brute_bytes(pairs(docs), 100)


def test_common_anchors_are_split_without_loss(spark, small_docs, monkeypatch):
    """With every anchor taken for common all windows go alone; the result stays."""
    import numpy as np

    rows = pairs(small_docs)
    real = repeats.common_anchors

    def all_common(docs, n, search):
        monkeypatch.setattr(repeats, "COMMON_SHARE", 0.0)
        found = docs.mapInArrow(lambda it: it, docs.schema)
        keys = [k for b in found.toArrow().to_batches() for k, *_ in repeats._runs_of(b, search)]
        return np.unique(np.concatenate(keys))

    assert real is not all_common
    monkeypatch.setattr(repeats, "common_anchors", all_common)
    got = sorted(map(tuple, suffix_array_dedup(small_docs).collect()), key=repr)
    assert got == brute_bytes(rows, 100)


def test_full_sketch_loses_nothing(small_docs):
    """A sketch of 2**16 cells is full: all runs count as repeated, the result stays."""
    from clickmill.llm.common import keyed
    from clickmill.llm.op4_substring import _cut_digest
    from clickmill.llm.repeats import Search, with_spans

    rows, step = keyed(small_docs)
    cut = with_spans(rows, Search(13, 6, True, True, step), _cut_digest, "n_words long, n_removed long, kept_sha256 string", 2, 16)
    assert sorted(map(tuple, cut.collect()), key=repr) == brute_words(pairs(small_docs), 13)


def test_stage_keeps_columns_and_first_passages(edge_docs):
    out = suffix_array_text(edge_docs)
    assert out.columns == edge_docs.columns
    rows = out.collect()
    kept = {r.doc_id: r.text for r in rows}
    texts = dict(pairs(edge_docs))
    assert kept[1] == texts[1] and 2 not in kept and kept[4] is None and kept[18] == texts[18]
    passage = [r.text for r in rows if r.doc_id is None and r.text][0].split()
    assert len(passage) == 60 and 13 not in kept
    assert " ".join(passage) not in kept[11] and len(kept[11].split()) == 70 and len(kept[12].split()) == 85
    assert all(r.n_chars == len(r.text or "") for r in rows)
