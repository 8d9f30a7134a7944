"""Two words that a polynomial hash modulo 2**64 takes for one: the Thue-Morse word over a, b and its complement."""

import numpy as np
import pyarrow as pa
import pytest

from clickmill.llm import op3_decontamination as clean
from clickmill.llm import op4_substring as substring
from clickmill.llm import op7_sentencepiece as pieces
from clickmill.llm import op10_jaccard_join as jaccard
from clickmill.llm.common import texts
from clickmill.llm.windows import range_hashes, word_bounds

ONE = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
OTHER = ONE.translate(str.maketrans("ab", "ba"))
SHARED = [f"w{i}" for i in range(12)]


@pytest.fixture(scope="module")
def pair(spark):
    return spark.createDataFrame([(1, " ".join([*SHARED, ONE])), (2, " ".join([*SHARED, OTHER]))], "doc_id long, text string")


def test_hashes_tell_contents_and_lengths_apart():
    data = np.frombuffer(f"{ONE} {OTHER} ab ba b a aa a\0".encode(), np.uint8)
    begin, end = word_bounds(data, np.array([0, len(data)]))
    assert len(set(range_hashes(data, begin, end).tolist())) == len(begin) == 8
    same = np.frombuffer(b"abc xabc abc", np.uint8)
    one, two, three, none = range_hashes(same, np.array([0, 5, 9, 12]), np.array([3, 8, 12, 12]))
    assert one == two == three != none
    assert len(range_hashes(data, begin[:0], end[:0])) == 0


def test_no_operator_takes_them_for_one(spark, pair):
    assert [r.n_removed for r in substring.substring_dedup(pair).collect()] == [0, 0]
    assert {r.component_id for r in jaccard.jaccard_components(pair).collect()} == {1, 2}
    items = spark.createDataFrame([(7, OTHER)], "item_id long, text string")
    assert {r.doc_id: r.n_hit for r in clean.digests(pair, items).collect()} == {1: 0, 2: 1}


def test_pieces_give_back_the_text():
    model = pieces.Pieces.load()
    rows = [f"{ONE} {OTHER}", OTHER, ONE]
    ids, at = model.encode(*texts(pa.array(rows)))
    back, ends = model.decode(ids, at)
    assert [bytes(back[a:b]).decode() for a, b in zip(ends[:-1], ends[1:])] == rows
