"""Hard-negative mining by coordinate pruning over length buckets.

Each component c of a vector becomes the integer floor(scale * c); scores are integer inner
products, higher ones first, ties by the smaller vec_id. Rows with a missing label, a missing
vector or a null or non-finite component take no part, nor do those whose length is not that
of most rows (on a tie the greater one).

Anchors are the rows that the caller marks. An anchor's positives are its first `positives`
other rows of the same label. For each of them, its negatives are the first `negatives`
rows of other labels whose score lies between low % and high % of the positive's.

1. Rows are dealt into blocks of bounded size by label, length of the vector and id, and
   written. Anchors are sent to the blocks that can hold an answer (for positives those
   with rows of their label, for negatives those with rows of another). A task reads the
   rows of a block, then takes the anchors batch by batch, so anchors are never gathered.
2. In a task the rows of a block lie in buckets by falling length. A bucket holds, for
   each coordinate, the list of its rows in order of that coordinate of the unit vector.
3. An anchor q that needs a score of at least s from a bucket whose longest vector is l
   needs a cosine of at least t = s / (|q| l). If t > 1 the bucket is passed over. Else a
   coordinate f of a fitting unit vector p obeys, with u = q / |q|,
       t u_f - r <= p_f <= t u_f + r,   r = sqrt((1 - t^2) (1 - u_f^2)),
   without the upper bound if u_f >= t and without the lower one if -u_f >= t.
   The anchor's FOCUS largest coordinates give such ranges, whose rows in the sorted lists
   are intersected; what is left is scored exactly. Where the ranges leave more than one row
   in DENSE, the bucket is scored whole by one matrix product for all such anchors.
4. s rises as answers are found: for positives the score of the last one held, for
   negatives the least score that any positive still asks for.
5. The few answers of each block are merged by Spark.

Answers do not depend on blocks or pruning. Scores are exact: products are taken in doubles
where all sums stay below 2**53, else in 64-bit integers; where a score could exceed a long,
ArithmeticError is raised.

 - Rows that repeat a vec_id are rows of their own; of rows with equal score and vec_id any
   may come first. A missing vec_id sorts last and is never an anchor by id.
 - An empty table, or one without anchors, gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import settle, table
from .op11_whitening import integer_vectors

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 3, 50, 95
#: Blocks that small tables are dealt into, and the least and most rows of a block.
BLOCKS, LEAST_ROWS, MOST_ROWS = 64, 256, 65_536
BUCKET_ROWS, FOCUS, DENSE = 2048, 4, 4
_LAST = np.iinfo(np.int64).max
_MATRIX = 1 << 22


@dataclass(frozen=True)
class Mining:
    """What is asked for: how many positives and negatives, and between which percentages of the positive's score."""

    positives: int = POSITIVES
    negatives: int = NEGATIVES
    low: int = LOW
    high: int = HIGH


class Bucket:
    """Rows of like length with, for each coordinate asked for, their order by it."""

    def __init__(self, x: np.ndarray, lengths: np.ndarray, exact: bool):
        self.x = x.astype(np.float64) if exact else x
        self.longest = float(lengths[0])
        self.unit = x / np.maximum(lengths, 1e-300)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]

    def candidates(self, unit: np.ndarray, focus: np.ndarray, t: float) -> np.ndarray | None:
        """Rows whose focus coordinates allow a cosine of t; None where pruning would not pay."""
        if t <= 0:
            return None
        u = unit[focus]
        reach = np.sqrt(max(0.0, 1 - t * t) * np.maximum(0.0, 1 - u * u)) + 1e-9
        # Where the coordinate's axis itself is within reach, the range ends at the axis.
        low, high = np.where(-u >= t, -2.0, t * u - reach), np.where(u >= t, 2.0, t * u + reach)
        best, span = None, len(self.unit) // DENSE
        for k, f in enumerate(focus):
            order, values = self.sorted_list(int(f))
            a, b = np.searchsorted(values, low[k], "left"), np.searchsorted(values, high[k], "right")
            if b - a <= span:
                best, span = order[a:b], b - a
        if best is None:
            return None
        near = self.unit[best][:, focus]
        return np.sort(best[((near >= low) & (near <= high)).all(1)])


def product(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of rows and anchors as longs, one column an anchor."""
    return (x @ (q.astype(np.float64) if x.dtype == np.float64 else q).T).astype(np.int64)


class Block:
    """The rows of a block in buckets by falling length."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, labels: np.ndarray, x: np.ndarray, exact: bool):
        lengths = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        order = np.lexsort((ids, -lengths))
        self.ids, self.keys, self.labels = ids[order], keys[order], labels[order]
        x, lengths = x[order], lengths[order]
        self.at = list(range(0, len(x), BUCKET_ROWS))
        self.buckets = [Bucket(x[a:a + BUCKET_ROWS], lengths[a:a + BUCKET_ROWS], exact) for a in self.at]

    def scores(self, q: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(anchor, first row, candidate rows of the bucket, their scores); least may rise between buckets."""
        lengths = np.sqrt((q.astype(np.float64) ** 2).sum(1))
        unit = q / np.maximum(lengths, 1e-300)[:, None]
        focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        for at, bucket in zip(self.at, self.buckets):
            reach = lengths * bucket.longest
            whole = []
            for i in range(len(q)):
                t = least[i] / reach[i] if reach[i] > 0 else (2.0 if least[i] > 0 else 0.0)
                if t > 1 + 1e-9:
                    continue
                some = bucket.candidates(unit[i], focus[i], min(t, 1.0))
                if some is None:
                    whole.append(i)
                elif len(some):
                    yield i, at, some, product(bucket.x[some], q[i:i + 1])[:, 0]
            every = np.arange(len(bucket.unit))
            step = max(1, _MATRIX // len(every))
            for k in range(0, len(whole), step):
                found = product(bucket.x, q[whole[k:k + step]])
                for column, i in enumerate(whole[k:k + step]):
                    yield i, at, every, found[:, column]


def _first(score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the first n by falling score and rising id."""
    if len(score) > 4 * n:
        edge = np.partition(score, len(score) - n)[len(score) - n]
        some = np.flatnonzero(score >= edge)
        return some[np.lexsort((ids[some], -score[some]))][:n]
    return np.lexsort((ids, -score))[:n]


class _Best:
    """The first n answers so far."""

    def __init__(self, n: int):
        self.n, self.score, self.row = n, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, row: np.ndarray, ids: np.ndarray) -> None:
        score, row = np.concatenate([self.score, score]), np.concatenate([self.row, row])
        first = _first(score, ids[row], self.n)
        self.score, self.row = score[first], row[first]

    def edge(self, otherwise: int) -> int:
        return int(self.score[-1]) if len(self.score) == self.n else otherwise


def _positives(block: Block, keys, labels, q, _, asked: Mining):
    least = np.full(len(q), -_LAST, np.float64)
    best = [_Best(asked.positives) for _ in keys]
    for i, at, rows, score in block.scores(q, least):
        place = at + rows
        good = (block.labels[place] == labels[i]) & (block.keys[place] != keys[i]) & (score >= least[i])
        if good.any():
            best[i].add(score[good], place[good], block.ids)
            least[i] = best[i].edge(-_LAST)
    for i, b in enumerate(best):
        for score, row in zip(b.score, b.row):
            yield i, -1, row, score


def _negatives(block: Block, keys, labels, q, wanted, asked: Mining):
    """wanted: of each anchor the scores of its positives."""
    floor = [np.array([-(-asked.low * p // 100) for p in ps], np.int64) for ps in wanted]
    ceil = [np.array([asked.high * p // 100 for p in ps], np.int64) for ps in wanted]
    best = [[_Best(asked.negatives) for _ in ps] for ps in wanted]
    asks = [[h >= f for f, h in zip(a, b)] for a, b in zip(floor, ceil)]

    def needed(i: int) -> float:
        return min((b.edge(int(f)) for b, f, ask in zip(best[i], floor[i], asks[i]) if ask), default=np.inf)

    least = np.array([needed(i) for i in range(len(q))], np.float64)
    for i, at, rows, score in block.scores(q, least):
        place = at + rows
        good = (block.labels[place] != labels[i]) & (score >= least[i])
        if not good.any():
            continue
        place, score = place[good], score[good]
        for b, f, h, ask in zip(best[i], floor[i], ceil[i], asks[i]):
            inside = (score >= b.edge(int(f))) & (score <= h) if ask else np.zeros(0, bool)
            if inside.any():
                b.add(score[inside], place[inside], block.ids)
        least[i] = needed(i)
    for i, own in enumerate(best):
        for k, b in enumerate(own):
            for score, row in zip(b.score, b.row):
                yield i, k, row, score


_SENT = "block int, anchor boolean, key long, vec_id long, label long, x binary, wanted array<long>"
_ANSWER = "anchor_key long, place int, key long, vec_id long, score long"


def _unpack(column: pa.Array, exact: bool) -> np.ndarray:
    """Vectors stored as 32-bit integers, or 64-bit ones where those are too small."""
    flat = np.frombuffer(b"".join(column.to_pylist()), np.int32 if exact else np.int64)
    return flat.reshape(len(column), -1).astype(np.int64)


def _search(find, asked: Mining, exact: bool):
    """Read the rows of each block, then answer its anchors batch by batch."""
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now, block = None, None
        for batch in incoming:
            number = batch.column("block").to_numpy()
            anchor = batch.column("anchor").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((number[1:] != number[:-1]) | (anchor[1:] != anchor[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, len(number)]):
                part = batch.slice(a, b - a)
                if number[a] != now:
                    now, block, held = number[a], None, []
                if not anchor[a]:
                    held.append(part)
                    continue
                if block is None:
                    if not held:
                        continue
                    rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    ids = rows.column("vec_id").fill_null(_LAST).to_numpy()
                    block = Block(ids, rows.column("key").to_numpy(), rows.column("label").to_numpy(), _unpack(rows.column("x"), exact), exact)
                    missing = rows.column("vec_id").null_count > 0
                    held = []
                keys = part.column("key").to_numpy()
                found = [*find(block, keys, part.column("label").to_numpy(), _unpack(part.column("x"), exact), part.column("wanted").to_pylist(), asked)]
                if found:
                    i, place, row, score = (np.array(v, np.int64) for v in zip(*found))
                    ids = block.ids[row]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys[i]), pa.array(place.astype(np.int32)), pa.array(block.keys[row]),
                        pa.array(ids, pa.int64(), mask=(ids == _LAST) if missing else None), pa.array(score)],
                        ["anchor_key", "place", "key", "vec_id", "score"])
    return run


def _dealt(rows: DataFrame, blocks: int, exact: bool) -> DataFrame:
    """Rows with a key and a block of bounded size, by label, length and id, as a written table."""
    length = F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    kind = np.int32 if exact else np.int64

    def pack(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            x = batch.column("x")
            flat = x.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(x), -1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "block", "vec_id", "label", "anchor")), pa.array([v.tobytes() for v in flat], pa.binary())],
                ["key", "block", "vec_id", "label", "anchor", "x"])

    spread = rows.withColumn("length", length).withColumn("salt", F.monotonically_increasing_id())
    # A range of one vector's copies is cut by id and salt: ids repeat, the salt does not.
    ranged = spread.repartitionByRange(blocks, "label", "length", "vec_id", "salt")
    keyed = ranged.select(F.monotonically_increasing_id().alias("key"), F.spark_partition_id().alias("block"), "vec_id", "label", "anchor", "x")
    return settle(keyed.mapInArrow(pack, "key long, block int, vec_id long, label long, anchor boolean, x binary"), "blocks")


def _answers(dealt: DataFrame, anchors: DataFrame, find, asked: Mining, exact: bool) -> DataFrame:
    """Answers of all blocks; anchors has block, key, vec_id, label, x and wanted."""
    rows = dealt.select("block", F.lit(False).alias("anchor"), "key", "vec_id", "label", "x", F.lit(None).cast("array<long>").alias("wanted"))
    sent = anchors.select("block", F.lit(True).alias("anchor"), "key", "vec_id", "label", "x", "wanted")
    met = rows.union(sent).repartition("block").sortWithinPartitions("block", "anchor")
    return met.mapInArrow(_search(find, asked, exact), _ANSWER)


def _ranked(answers: DataFrame, n: int, *group: str) -> DataFrame:
    """The first n answers of each group with their rank: at most n of each block reach the merge."""
    order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "key")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(rows: DataFrame, is_anchor: Column, scale: int = SCALE, asked: Mining = Mining(),
                   vector: str = "embedding", label: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of every mined negative."""
    named = rows.where(F.col(label).isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.col(vector).alias("x"))
    usable = settle(integer_vectors(named, "x", scale, 0), "usable")
    size = usable.agg(F.count("*").alias("n"), F.max(F.greatest(F.abs(F.array_max("x")), F.abs(F.array_min("x")))).alias("top"),
                      F.max(F.size("x")).alias("d")).first()
    n, d, top = size["n"], size["d"] or 0, size["top"] or 0
    if d * top * top >= 2**63:
        raise ArithmeticError("scores exceed a long")
    exact = top < 2**31 and d * top * top < 2**53
    blocks = max(1, -(-n // min(MOST_ROWS, max(LEAST_ROWS, n // BLOCKS))))
    dealt = _dealt(usable, blocks, exact)
    anchors = dealt.where("anchor").drop("anchor", "block")
    # One row for each block and label in it: as many as there are blocks and labels together.
    holds = dealt.select("block", "label").distinct()
    near = anchors.join(holds, "label").withColumn("wanted", F.lit(None).cast("array<long>"))
    found = settle(_ranked(_answers(dealt, near, _positives, asked, exact), asked.positives, "anchor_key"), "positives")
    listed = found.groupBy("anchor_key").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "vec_id"))).alias("positives"))
    ready = anchors.join(listed.withColumnRenamed("anchor_key", "key"), "key").withColumn("wanted", F.col("positives.score"))
    # A block all of whose rows have the anchor's label holds no negative of it.
    other = F.col("only").isNull() | (F.col("only") != F.col("label"))
    only = holds.groupBy("block").agg(F.when(F.min("label") == F.max("label"), F.min("label")).alias("only"))
    away = ready.drop("positives").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(only, "block").where(other)
    mined = _ranked(_answers(dealt, away, _negatives, asked, exact), asked.negatives, "anchor_key", "place")
    known = ready.select(F.col("key").alias("anchor_key"), F.col("vec_id").alias("anchor_id"),
                         F.posexplode("positives").alias("place", "positive"))
    return mined.join(known, ["anchor_key", "place"]).select(
        "anchor_id", F.col("positive.vec_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


OP13_SQL = """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, p.vec_id, a.label = p.label AS same, CAST(list_dot_product(a.x, p.x) AS BIGINT) AS score
  FROM good a JOIN good p ON a.vec_id % 50 = 0 AND a.vec_id <> p.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""
