"""Byte-level BPE against the public library, a plain loop and round trips."""

import hashlib
import random

import numpy as np
import pytest

from clickmill.llm import op12_byte_bpe as bpe

HARD = ["", " ", "a", "  two  spaces ", "\n\n\n  x", "a\n b\t\r\nc", "x" * 3000, "ab" * 2000, "日本語のテキスト" * 200, "🎉🎉 naïve café",
        "<|endoftext|>", "it's they'LL I'd", "\x00\x01", " " * 5000, "\t" * 700 + "x", "é" * 900, "A" * 1000 + "b" * 999, "12345 ٣٤ Ⅷ"]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load()


@pytest.fixture(scope="module")
def library(vocabulary):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={})


def mixed(rng, n):
    pools = [(32, 127), (0xA0, 0x250), (0x400, 0x500), (0x3040, 0x30FF), (0x1F600, 0x1F640)]
    return "".join(chr(rng.randrange(*rng.choice(pools))) if rng.random() < 0.9 else " " for _ in range(n))


def test_ids_are_the_librarys(vocabulary, library, small_docs):
    rng = random.Random(3)
    rows = HARD + [mixed(rng, rng.randrange(200)) for _ in range(300)] + [r.text or "" for r in small_docs.collect()]
    rows += ["".join(rng.choice("aeinrst") for _ in range(rng.randrange(bpe.LONG - 5, 900))) for _ in range(30)]
    encoder = bpe.Encoder(vocabulary)
    ids, at = encoder.encode(rows)
    for text, a, b in zip(rows, at[:-1], at[1:]):
        assert ids[a:b].tolist() == library.encode_ordinary(text), text[:60]
    back, ends = vocabulary.decode(ids, at)
    assert [bytes(back[a:b]).decode() for a, b in zip(ends[:-1], ends[1:])] == rows


def plain(match, ranks):
    parts = [bytes([b]) for b in match]
    while match not in ranks:
        found = [(ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks]
        if not found:
            break
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[match]] if match in ranks else [ranks[p] for p in parts]


@pytest.mark.parametrize("seed", range(4))
def test_any_order_of_ranks(seed, monkeypatch):
    """Ranks that do not rise with the merges: a merge may put a lower rank beside it."""
    rng = random.Random(seed)
    ranks = {bytes([b]): b for b in range(256)}
    made = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))).encode() for _ in range(60)})
    rng.shuffle(made)
    ranks |= {token: 256 + i for i, token in enumerate(made)}
    v = bpe.Vocabulary(ranks, r"\S+|\s+")
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 60))).encode() for _ in range(400)]
    for limit in (bpe.LONG, 1):  # matrices, then the rounds for long matches
        monkeypatch.setattr(bpe, "LONG", limit)
        ids, n = v.encode_matches(words)
        ends = np.concatenate([[0], np.cumsum(n)])
        for i, word in enumerate(words):
            assert ids[ends[i]:ends[i + 1]].tolist() == plain(word, ranks), (limit, word)


def test_kept_matches_are_bounded(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "_KEPT_MATCHES", 50)
    monkeypatch.setattr(bpe, "_MATCHES", 70)
    monkeypatch.setattr(bpe, "SLICE_BYTES", 500)
    rng = random.Random(8)
    rows = [mixed(rng, 2000), "", mixed(rng, 40), mixed(rng, 3000)]
    encoder = bpe.Encoder(vocabulary)
    ids, at = encoder.encode(rows)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [library.encode_ordinary(t) for t in rows]
    assert len(encoder.known) <= 50


def test_query_round_trip_and_edges(spark, edge_docs, no_docs, library):
    """Nulls, empty and very long texts, repeated rows, clashing columns, no rows."""
    docs = edge_docs.withColumnsRenamed({"spans": "ids", "region": "decoded"})
    both = bpe.encode_and_decode(docs)
    assert [c for c in both.columns if c in ("ids", "decoded")] == ["ids", "decoded"]
    assert both.where("coalesce(text, '') <> decoded").count() == 0 and both.count() == docs.count()
    assert bpe.decode(bpe.encode(docs)).exceptAll(both).count() == 0
    text_of = {}
    for r in docs.collect():
        text_of.setdefault(r.doc_id, []).append(r.text or "")
    for r in bpe.round_trip(docs).collect():
        want = [(len(i := library.encode_ordinary(t)), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(),
                 hashlib.sha256(t.encode()).hexdigest()) for t in text_of[r.doc_id]]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) in want
    assert bpe.round_trip(no_docs).collect() == [] and bpe.encode(no_docs).collect() == []


def test_strange_ids(spark, vocabulary):
    rows = spark.createDataFrame([(1, [int(vocabulary.bytes[0xC3])]), (2, None), (3, [])], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decode(rows).orderBy("doc_id").collect()] == ["\ufffd", "", ""]
    with pytest.raises(ValueError):
        vocabulary.decode(np.array([len(vocabulary.raw_at)]), np.array([0, 1]))
