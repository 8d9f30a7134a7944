"""Exact Jaccard join of word shingles as a metric-space join.

Jaccard distance d = 1 - |A n B| / |A u B| is a metric on sets; documents link when d is at
most eps = 1 - threshold.

1. First pivots are the one-shingle sets {s}: d(A, {s}) is 1 - 1/|A| if A holds s, else 1,
   so A lies in the region of any of its shingles, taken in one order for all documents. A
   document's own region is that of its first shingle. A linked document shares at least
   need = ceil(threshold |A|) of A's shingles, so replicating A to the regions of its first
   |A| - need + 1 shingles covers every link: the window of this level. The order puts
   shingles that a merged count sketch of all documents reports common last, so regions of
   common passages hold only documents made of little else.
   Two documents first meet in the region of the first shingle that both have. Whoever has
   that shingle at place i of its order shares at most |A| - i shingles with the other, so
   members of a region that reach no size in it are left out, and so are pairs.
2. Regions of up to LEAF documents compare all of them. In larger ones PIVOTS documents
   become pivots, those with the fewest own (rare) shingles before the region's, which near
   copies of one text have nearest in their middle. Each document's distance to each pivot is
   computed, it belongs to the nearest pivot p and, by the triangle inequality, may link with
   documents of pivot q only if d(x, q) <= d(x, p) + 2 eps: it is replicated to those. Whoever
   links with a pivot has joined its component, and a region all of whose documents are in one
   component is finished: it can add nothing. Regions with the same documents are one, and a
   region that a pivot's region holds whole goes on only once. Distances here are those of
   the documents' profiles, the numbers of their shingles in CELLS hash cells, by the
   Jaccard distance of multisets. That is a metric too and never more than d, so windows
   stay right with it; and pairs of profiles further apart than eps cannot link. Only the
   pairs left are compared by their whole sets.
3. Unrelated documents are all at distances near 1, where the triangle inequality separates
   nothing. What ROUNDS rounds leave is compared in blocks of BLOCK documents, block against
   block, but for pairs that are of one component already or out of reach.

Document pivots alone would replicate nearly every document everywhere; hence the first
level. All links found are between exact sets; connected components give the groups.

Words are `[^\\x20\\x09-\\x0D]+` after A-Z are lower-cased. A text of fewer than `width` words
is its whole word sequence as one shingle; one without words, or a missing one, has no
shingle and links with nothing. Documents with equal sets are one class from the start.
Rows repeating a doc_id are documents of their own with one id. A missing doc_id stays
missing in its row and counts as one below the smallest as component_id. An empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sketch
from .common import batches, keyed, settle, table, texts
from .components import components
from .windows import U, hashes, mix, powers, prefix_sums, slices, word_units

WIDTH, PERCENT = 4, 85
#: Shingles and similarity where documents are removed.
STAGE_WIDTH, STAGE_PERCENT = 5, 80
LEAF, PIVOTS, ROUNDS, BLOCK, CELLS = 8, 4, 1, 64, 256

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    for i, j in slices(buf, offsets):
        part = offsets[i:j + 1]
        units, at, _, _ = word_units(buf[part[0]:part[-1]], part - part[0], fold=LOWER)
        sums = prefix_sums(units)
        grams = mix((sums[width:] - sums[:-width]) * powers(len(sums))[1][:max(0, len(sums) - width)])
        for a, b in zip(at[:-1], at[1:]):
            if b - a >= width:
                yield np.unique(grams[a:b - width + 1])
            elif b > a:
                yield hashes(sums, np.array([a]), np.array([b]))
            else:
                yield np.zeros(0, U)


def profile(one: np.ndarray) -> bytes:
    """Number of shingles in each of CELLS cells, as one byte each, or four where one is not enough."""
    counts = np.bincount((one & U(CELLS - 1)).astype(np.int64), minlength=CELLS)
    return counts.astype(np.uint8 if len(one) < 256 or counts.max() < 256 else np.uint32).tobytes()


def _profiles(column: pa.Array) -> np.ndarray:
    rows = [np.frombuffer(x.as_buffer(), np.uint8 if len(x.as_buffer()) == CELLS else np.uint32) for x in column]
    return np.array(rows, np.int64).reshape(len(rows), CELLS)


def need(size, percent: int):
    """Shingles that a document linked with one of this size has in common with it, at least."""
    return (percent * size + 99) // 100


def _sets_of(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    return shingle_sets(*texts(batch.column("text")), width)


def _own_regions(one: np.ndarray, common: sketch.Sketch | None, percent: int) -> np.ndarray:
    """The first shingles of a set in the order of all documents: rare ones, then common ones."""
    many = common.reached(one)
    return np.concatenate([one[~many], one[many]])[:len(one) - need(len(one), percent) + 1]


def _dealt(width: int, percent: int, common, shared):
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            keys = batch.column("doc_key").to_numpy()
            n, low, high, regions, places, of, counts = [], [], [], [], [], [], []
            # Of equal sets the copy with the smallest key posts: only that can be the head of its class.
            seen: dict[tuple[int, int], int] = {}
            for doc, one in enumerate(_sets_of(batch, width)):
                n.append(len(one))
                counts.append(profile(one))
                low.append(int(np.add.reduce(mix(one))) if len(one) else 0)
                high.append(int(np.bitwise_xor.reduce(mix(one + U(1)))) if len(one) else 0)
                if len(one) and (at := seen.setdefault((low[-1], high[-1]), len(of))) == len(of):
                    first = _own_regions(one, common.value, percent)
                    place = np.flatnonzero(shared.value.reached(mix(first)))
                    regions.append(first[place])
                    places.append(place)
                    of.append(doc)
                elif len(one) and keys[doc] < keys[of[at]]:
                    of[at] = doc
            n = np.array(n, np.int64)
            none = np.zeros(len(n), np.int64)
            yield from batches({
                "posting": np.zeros(len(n), bool), "region": none, "doc": keys, "size": n, "low": np.array(low, U).view(np.int64),
                "high": np.array(high, U).view(np.int64), "doc_id": batch.column("doc_id"), "profile": pa.array(counts, pa.binary()), "place": none})
            if regions:
                which, region = np.repeat(of, list(map(len, regions))), np.concatenate(regions).view(np.int64)
                yield from batches({
                    "posting": np.ones(len(which), bool), "region": region, "doc": keys[which], "size": n[which],
                    "low": none[:1].repeat(len(which)), "high": none[:1].repeat(len(which)), "doc_id": keys[which],
                    "profile": pa.nulls(len(which), pa.binary()), "place": np.concatenate(places)})
    return run


_DEALT = "posting boolean, region long, doc long, size long, low long, high long, doc_id long, profile binary, place long"


def _shared_shingles(width: int):
    def run(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            left = _sets_of(batch.select([2]).rename_columns(["text"]), width)
            right = _sets_of(batch.select([3]).rename_columns(["text"]), width)
            shared, sizes_a, sizes_b = [], [], []
            for x, y in zip(left, right):
                both = np.concatenate([x, y])
                both.sort()
                shared.append(int((both[1:] == both[:-1]).sum()))
                sizes_a.append(len(x))
                sizes_b.append(len(y))
            shared, union = np.array(shared, np.int64), np.array(sizes_a, np.int64) + np.array(sizes_b, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shared), pa.array(union - shared)], ["u", "v", "shared", "joint"])
    return run


def _profile_distances(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in incoming:
        a, b = _profiles(batch.column(2)), _profiles(batch.column(3))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.minimum(a, b).sum(1)), pa.array(np.maximum(a, b).sum(1))],
            ["u", "v", "shared", "joint"])


def profile_distances(profiles: DataFrame, pairs: DataFrame) -> DataFrame:
    """(u, v, shared, joint) of the profiles of each pair: shared / joint is at least the similarity of the sets."""
    left = profiles.select(F.col("doc").alias("u"), F.col("profile").alias("profile_u"))
    right = profiles.select(F.col("doc").alias("v"), F.col("profile").alias("profile_v"))
    joined = pairs.select("u", "v").distinct().join(right, "v").join(left, "u")
    return settle(joined.select("u", "v", "profile_u", "profile_v").mapInArrow(
        _profile_distances, "u long, v long, shared long, joint long"), "profiles")


def distances(docs: DataFrame, pairs: DataFrame, width: int, rows: int) -> DataFrame:
    """(u, v, shared, joint): intersection and union of the sets of each pair."""
    spark = docs.sparkSession
    pairs = settle(pairs.select("u", "v").distinct(), "pairs")
    ends = pairs.select(F.explode(F.array("u", "v")).alias("doc_key"))
    wanted = spark.sparkContext.broadcast(sketch.build(ends, _doc_keys, sketch.bits_for(rows), 1, 1))

    def pick(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in incoming:
            keys = mix(batch.column("doc_key").to_numpy().astype(U))
            yield batch.filter(pa.array(wanted.value.reached(keys)))

    held = docs.select("doc_key", "text").mapInArrow(pick, "doc_key long, text string")
    left = held.select(F.col("doc_key").alias("u"), F.col("text").alias("text_u"))
    right = held.select(F.col("doc_key").alias("v"), F.col("text").alias("text_v"))
    out = settle(
        pairs.join(right, "v").join(left, "u").select("u", "v", "text_u", "text_v")
        .mapInArrow(_shared_shingles(width), "u long, v long, shared long, joint long"), "distances")
    wanted.destroy()
    return out


def _doc_keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield mix(batch.column("doc_key").to_numpy().astype(U))


def _reach(size, place, other, percent: int):
    """Whether a set of this size, whose shingle at `place` is the first that it shares, can share enough with one of size `other`.

    It shares nothing before that place, so at most size - place shingles, and a link needs
    percent / (100 + percent) of both sizes together.
    """
    return (size - place) * (100 + percent) >= (size + other) * percent


def _sizes_fit(percent: int):
    u, v = F.col("size_u"), F.col("size_v")
    return ((F.least(u, v) * 100 >= F.greatest(u, v) * percent)
            & _reach(u, F.col("place_u"), v, percent) & _reach(v, F.col("place_v"), u, percent))


def _sides(rows: DataFrame, *by: str) -> tuple[DataFrame, DataFrame]:
    renamed = [rows.select(*by, *(F.col(c).alias(f"{c}_{side}") for c in rows.columns if c not in by)) for side in "uv"]
    return renamed[0], renamed[1]


def _leaf_pairs(regions: DataFrame, percent: int) -> DataFrame:
    """All pairs of regions of at most LEAF documents."""
    left, right = _sides(regions.select("region", "doc", "size", "place"), "region")
    return (left.join(right, "region").where((F.col("doc_u") < F.col("doc_v")) & _sizes_fit(percent))
            .select(F.col("doc_u").alias("u"), F.col("doc_v").alias("v")))


def _sized(regions: DataFrame) -> DataFrame:
    """Regions of two documents or more, with their number of documents."""
    count = regions.groupBy("region").agg(F.count("*").alias("n")).where("n > 1")
    return regions.join(count, "region")


def _within_reach(regions: DataFrame, percent: int) -> DataFrame:
    """Members that can link with a document of the region's sizes at this place of their order, in regions of two or more.

    Linked documents meet at the first shingle that both have, where both are within reach.
    """
    least = regions.groupBy("region").agg(F.min("size").alias("least"))
    other = F.greatest(F.col("least"), F.col("size") * percent / 100)
    near = regions.join(least, "region").where(_reach(F.col("size"), F.col("place"), F.floor(other), percent))
    return _sized(near.drop("least", "n"))


def _distinct(regions: DataFrame) -> DataFrame:
    """Regions that hold the same documents as one, each with its least place: neighbouring shingles of a passage make the same region."""
    mark = regions.groupBy("region").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("doc")).alias("x"), F.sum(F.xxhash64("doc", F.lit(1)).cast("decimal(20,0)")).alias("s"))
    kept = mark.groupBy("n", "x", "s").agg(F.min("region").alias("kept"), F.count("*").alias("same"))
    named = mark.join(kept, ["n", "x", "s"]).select("region", "kept")
    return regions.join(named, "region").groupBy(F.col("kept").alias("region"), "doc", "size", "n").agg(F.min("place").alias("place"))


def _split(within: DataFrame, parents: DataFrame) -> DataFrame:
    """The pivots' regions; of a parent region that one of them holds whole, only that one."""
    count = within.groupBy("parent", "region").agg(F.count("*").alias("m"))
    widest = count.groupBy("parent").agg(F.max(F.struct("m", "region")).alias("widest"))
    whole = widest.join(parents.select(F.col("region").alias("parent"), "n").distinct(), "parent").where(F.col("widest.m") == F.col("n"))
    spare = count.join(whole.select("parent", F.col("widest.region").alias("only")), "parent").where("region <> only").select("region")
    return within.join(spare, "region", "left_anti").select("region", "doc", "size", "place")


def _pivots(regions: DataFrame, round_: int) -> DataFrame:
    """PIVOTS documents of each region: of each hash class the one with the fewest own shingles before the region's.

    Near copies of one text have their changes, which are rare, before what they share. The
    one with the least of them is the nearest to all others.
    """
    class_ = F.pmod(F.xxhash64("doc", F.lit(round_)), F.lit(PIVOTS))
    chosen = [F.min(F.when(class_ == i, F.struct("place", F.xxhash64("doc", F.lit(round_)).alias("draw"), "doc")))["doc"] for i in range(PIVOTS)]
    return regions.groupBy("region").agg(F.array_compact(F.array(*chosen)).alias("pivots")).select(
        "region", F.posexplode("pivots").alias("number", "pivot"))


def _block_pairs(regions: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents of different components, met block against block."""
    blocks = regions.withColumn("block", F.pmod(F.xxhash64("doc"), F.greatest(F.lit(1), F.col("n") / BLOCK).cast("int")))
    sides = blocks.select("region", "block").distinct()
    met = (sides.join(sides.withColumnRenamed("block", "block_v"), "region").where("block <= block_v")
           .withColumnRenamed("block", "block_u"))
    left, right = _sides(blocks.select("region", "block", "doc", "size", "place", "component"), "region")
    return (met.join(left, ["region", "block_u"]).join(right, ["region", "block_v"])
            .where((F.col("component_u") != F.col("component_v")) & (F.col("doc_u") != F.col("doc_v")) & _sizes_fit(percent))
            .select(F.least("doc_u", "doc_v").alias("u"), F.greatest("doc_u", "doc_v").alias("v")))


def _open_regions(regions: DataFrame, links: DataFrame) -> DataFrame:
    """Regions whose documents are not yet all of one component."""
    known = components(links)
    marked = regions.join(known, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    still = (marked.groupBy("region").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("n"))
             .where("a <> b").select("region", "n"))
    return marked.drop("n").join(still, "region")


def _found(docs: DataFrame, width: int, percent: int, most_bits: int, whole: bool) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Every row, the copies of each class (head u, copy v), links (u, v, shared, joint) between heads, and the key's step.

    All links if `whole`, else as many as components need: pairs that are of one already are left out.
    """
    rows, step = keyed(docs)
    rows = rows.select("doc_key", "doc_id", "text")
    spark = docs.sparkSession
    size = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    shingles = size["bytes"] // 6
    bits = sketch.bits_for(shingles, most_bits)
    load = shingles / 2**bits
    common = spark.sparkContext.broadcast(sketch.build(
        rows, lambda batch: _sets_of(batch, width), bits, 1, int(8 + 2 * load + 6 * np.sqrt(load))))

    shared = spark.sparkContext.broadcast(sketch.build(
        rows, _regions_of(width, percent, common), sketch.bits_for(shingles * (100 - percent) // 100 + size["rows"], most_bits), 1, 2))

    dealt = settle(rows.mapInArrow(_dealt(width, percent, common, shared), _DEALT), "dealt", "posting")
    common.destroy()
    shared.destroy()
    every = dealt.where(~F.col("posting"))
    classes = every.where("size > 0").groupBy("low", "high").agg(F.min("doc").alias("head"), F.count("*").alias("copies"))
    copies = every.join(classes.where("copies > 1"), ["low", "high"]).select(F.col("head").alias("u"), F.col("doc").alias("v")).where("u <> v")
    copies = links = settle(copies, "copies")
    met = []
    postings = dealt.where("posting").select("region", "doc", "size", "place").join(links.select(F.col("v").alias("doc")), "doc", "left_anti")

    regions = settle(_distinct(_within_reach(postings, percent)), "regions")
    profiles = every.select("doc", "profile")
    fits = F.col("shared") * 100 >= F.col("joint") * percent
    large = regions.where(F.col("n") > LEAF)
    for round_ in range(ROUNDS + 1):
        last = round_ == ROUNDS or large.isEmpty()
        pairs = _leaf_pairs(regions.where(F.col("n") <= LEAF), percent)
        if last:
            if round_:
                pairs = pairs.union(_block_pairs(large, percent))
        else:
            to_pivots = large.join(settle(_pivots(large, round_), "pivots"), "region")
            pairs = pairs.union(to_pivots.where("doc <> pivot").select(
                F.least("doc", "pivot").alias("u"), F.greatest("doc", "pivot").alias("v")))
        near = profile_distances(profiles, pairs)
        exact = distances(rows, near.where(fits), width, size["rows"])
        met.append(exact.where(fits))
        if last:
            break
        eps = 1 - percent / 100
        away = to_pivots.join(
            near.select(F.col("u").alias("a"), F.col("v").alias("b"), (1 - F.col("shared") / F.col("joint")).alias("d")),
            (F.least("doc", "pivot") == F.col("a")) & (F.greatest("doc", "pivot") == F.col("b")), "left",
        ).select("region", "doc", "size", "place", "number", F.coalesce("d", F.lit(0.0)).alias("d"))
        nearest = away.groupBy("region", "doc").agg(F.min("d").alias("near"))
        # A little over 2 eps, so that rounding loses no document on the border.
        within = (away.join(nearest, ["region", "doc"]).where(F.col("d") <= F.col("near") + 2 * eps + 1e-9)
                  .select(F.col("region").alias("parent"), F.xxhash64("region", "number", F.lit(round_)).alias("region"), "doc", "size", "place"))
        within = settle(within, "within")
        regions = _sized(_split(within, large))
        if whole:
            regions = settle(regions.withColumn("component", F.col("doc")), "regions")
        else:
            links = settle(links.union(met[-1].select("u", "v")), "links")
            regions = settle(_open_regions(regions, links), "regions")
        large = regions.where(F.col("n") > LEAF)
        if regions.isEmpty():
            break

    return every, copies, reduce(DataFrame.union, met).distinct(), step


def jaccard_links(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, most_bits: int = sketch.MAX_BITS) -> tuple[DataFrame, DataFrame]:
    """The join itself: all links between classes of equal sets, and every row with its class.

    Links are u, v (class ids, u < v), shared and joint (sizes of intersection and union). Rows are
    doc_id, n_shingles, class_id and n_links, the number of other rows that the row is linked with.
    A class id is the doc_key of its first row, its doc_id where doc_ids are unique.
    """
    every, copies, links, _ = _found(docs, width, percent, most_bits, True)
    links = settle(links, "links")
    rows = every.join(copies.select(F.col("v").alias("doc"), F.col("u").alias("head")), "doc", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.coalesce("head", "doc").alias("class_id"))
    sizes = rows.groupBy("class_id").agg(F.count("*").alias("copies"))
    ends = links.select(F.col("u").alias("class_id"), F.col("v").alias("other")).union(links.select("v", "u"))
    beside = (ends.join(sizes.withColumnRenamed("class_id", "other"), "other").groupBy("class_id")
              .agg(F.sum("copies").alias("beside")))
    counted = sizes.join(beside, "class_id", "left").select(
        "class_id", (F.coalesce("beside", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return links, rows.join(counted, "class_id").select("doc_id", "n_shingles", "class_id", "n_links")


def jaccard_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, most_bits: int = sketch.MAX_BITS) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reached by links) of every row, and the keys of both."""
    every, copies, links, step = _found(docs, width, percent, most_bits, False)
    member = components(copies.union(links.select("u", "v")))
    return (
        every.join(member, "doc", "left")
        .select("doc_id", F.col("size").alias("n_shingles"),
                F.expr(f"floor(coalesce(component, doc) / {step}D)").cast("long").alias("component_id") if step > 1
                else F.coalesce("component", "doc").alias("component_id"), F.col("doc").alias("doc_key"), F.coalesce("component", "doc").alias("component_key"))
    )


def _regions_of(width: int, percent: int, common):
    """Region keys of each batch, equal sets of a batch once."""
    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        seen: set[tuple[int, int]] = set()
        for one in _sets_of(batch, width):
            if not len(one):
                continue
            mark = (int(np.add.reduce(mix(one))), int(np.bitwise_xor.reduce(mix(one + U(1)))))
            if mark not in seen:
                seen.add(mark)
                # Hashed anew: a set's first shingles are those with the lowest hashes and would share few cells.
                yield mix(_own_regions(one, common.value, percent))
    return keys_of


def one_of_each(docs: DataFrame, width: int = STAGE_WIDTH, percent: int = STAGE_PERCENT) -> DataFrame:
    """Of each group of linked documents the row whose doc_id is smallest; documents without shingles all stay."""
    found = jaccard_components(docs, width, percent)
    gone = found.where("doc_key <> component_key").select("doc_key")
    rows, _ = keyed(docs, whole=True)
    return rows.select("doc_key", "row").join(gone, "doc_key", "left_anti").select("row.*")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("doc_key", "component_key")
