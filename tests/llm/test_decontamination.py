"""FM-index and decontamination against plain search."""

import hashlib
import random
import re

import numpy as np
import pytest

from clickmill.llm import op3_decontamination as m
from clickmill.llm.fm_index import FMIndex, suffix_array


def test_index_finds_all_occurrences():
    rng = random.Random(2)
    text = [rng.randint(0, 4) for _ in range(3000)]
    assert suffix_array(np.array(text[:300] + [9])).tolist() == sorted(range(301), key=lambda i: (text[:300] + [9])[i:])
    index = FMIndex(np.array(text), 4)
    phrases = [[rng.randint(1, 4) for _ in range(5)] for _ in range(300)]
    low, high = index.search(np.array(phrases))
    for phrase, a, b in zip(phrases, low, high):
        want = [i for i in range(2996) if text[i:i + 5] == phrase]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda c: c[0].lower(), text or ""))


def brute(rows, items):
    found = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            found.setdefault(tuple(w[i:i + 10]), set()).add("" if name is None else str(name))
    out = []
    for doc, text in rows:
        w = words(text)
        hit, names = [0] * len(w), set()
        for phrase, own in found.items():
            for i in range(len(w) - len(phrase) + 1):
                if tuple(w[i:i + len(phrase)]) == phrase:
                    hit[i:i + len(phrase)] = [1] * len(phrase)
                    names |= own
        out.append((doc, len(w), sum(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), sum(hit) > 0))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(1, " ".join(rng.choices(vocabulary, k=25))), (2, "Short One"), (2, "short, one!"), (3, None), (4, ""), (None, "w1 W2-w3")]
    docs = [(i, " ".join(rng.choices(vocabulary, k=200))) for i in range(20)]
    docs += [(30, items[0][1].upper()), (31, "a " + items[0][1].replace(" ", " - ") + " b"), (32, None), (33, ""), (33, "short\none short one"),
             (None, "w1.w2.w3"), (34, items[0][1][:40]), (35, "Ünï " * 5000)]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block", [1 << 24, 40])
def test_hits(case, block, monkeypatch):
    docs, items, rows, benchmark = case
    monkeypatch.setattr(m, "BLOCK_BYTES", block)
    found = m.digests(rows, benchmark)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(docs, items)


def test_nothing_to_find(case, no_docs):
    _, _, rows, benchmark = case
    assert m.digests(no_docs, benchmark).collect() == []
    assert not any(r.contaminated for r in m.digests(rows, benchmark.limit(0)).collect())


def test_one_block_is_held_at_a_time(case, monkeypatch):
    """A block's phrases are given up before those of the next one are sent, and columns of the result's names are replaced."""
    docs, items, rows, benchmark = case
    monkeypatch.setattr(m, "BLOCK_BYTES", 200)
    context, held = type(rows.sparkSession.sparkContext), []
    send = context.broadcast

    def counted(self, value):
        out = send(self, value)
        if isinstance(value, m.Phrases):
            assert not held
            held.append(out)
            end = out.destroy
            out.destroy = lambda: (held.remove(out), end())
        return out

    monkeypatch.setattr(context, "broadcast", counted)
    clashing = rows.selectExpr("*", "'x' AS spans", "1 AS items", "2 AS n_words", "3 AS cover", "4 AS other")
    found = m.hits(clashing, benchmark)
    assert sorted(found.columns) == ["cover", "doc_id", "items", "n_words", "other", "spans", "text"]
    got = sorted(((r.doc_id, r.n_words, len(r["items"]), r.other) for r in found.collect()), key=repr)
    assert got == sorted(((d, n, k, 4) for d, n, _, k, _, _ in brute(docs, items)), key=repr)


def test_stage_cuts_passages_only(case, edge_docs, spark):
    _, items, _, benchmark = case
    rows = edge_docs.limit(0).union(spark.createDataFrame(
        [(1, f"keep this {items[0][1]} and that", "en", "s", 5, "c", 1), (2, items[0][1], "en", "s", 5, "c", 1),
         (3, "clean  text", "en", "s", 99, "c", 1), (4, None, "en", "s", None, "c", 1)], edge_docs.schema))
    out = m.decontaminate(rows, benchmark)
    assert out.columns == rows.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in out.collect()}
    assert got == {1: ("keep this and that", 18), 3: ("clean  text", 99), 4: (None, None)}
