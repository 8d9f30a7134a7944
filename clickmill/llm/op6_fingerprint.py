"""Document fingerprints: a Merkle tree over paragraphs and sections.

A leaf is the SHA-256 of a paragraph (a line). A section is a run of paragraphs that ends
with one whose hash begins with a hex digit below 4, so an edit moves no border further on;
its node is the SHA-256 of its leaves, the root that of the sections. Equal roots mean equal
texts; where roots differ, equal section nodes rule out whole branches, and the unequal
leaves below the others locate the edit.

Each leaf also carries short hashes of its pieces (16 to 96 characters, cut where the text
itself says, not by position), so that two versions of one paragraph can be likened. Their
number is the weight of the leaf, and of the branches above it.

The fingerprint is the tree as text: the root in full, then `;` and a section, which is its
node and `,` with a leaf each, which is its hash and `.` with a piece hash each (nodes and
leaves as 16 hex digits, pieces as 8).

Likeness goes down both trees: 1 for equal roots; else distinct sections in common count
with their weight, of the other sections the distinct leaves in common with theirs, and of
the other leaves the distinct pieces in common; twice that over the sum of both sides.

 - A missing text is the empty one: one empty paragraph, no piece. It is like another empty
   text by the equal root and unlike any other.
 - Rows are in descending order of doc_id, then of text; missing ids come last. Repeated rows
   are documents of their own. The only document of a table is followed by itself.
 - An empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import settle, table

#: Documents of a bucket on average, and quantiles between which ids are taken to be evenly spread.
BUCKET_ROWS, QUANTILES = 1024, 32
#: Buckets that a task of the main pass has on average, at most, and buckets looked at together for their order.
TASK_BUCKETS, GROUP_BUCKETS = 32, 1024

_PIECE = r"(?s).{16,96}?(?:(?:[^\p{L}\s]|[nsr])\s|\z)|.{1,96}"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def tree(text: Column) -> Column:
    """Struct of the root (hex) and the sections of a text, each as in the fingerprint."""
    def leaf(paragraph: Column) -> Column:
        pieces = F.filter(F.regexp_extract_all(paragraph, F.lit(_PIECE), F.lit(0)), lambda p: p != "")
        marks = F.transform(pieces, lambda p: F.concat(
            F.lit("."), F.lpad(F.lower(F.hex(F.hash(p).bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")))
        return F.concat(F.sha2(paragraph.cast("binary"), 256), F.array_join(marks, ""))

    def section(leaves: Column) -> Column:
        node = F.sha2(F.array_join(F.transform(leaves, lambda h: F.left(h, F.lit(64))), ",").cast("binary"), 256)
        short = F.transform(leaves, lambda h: F.concat(F.left(h, F.lit(16)), F.substr(h, F.lit(65))))
        return F.concat(node, F.lit(","), F.array_join(short, ","))

    leaves = F.transform(F.split(text, "\n", -1), leaf)
    ends = F.array_join(F.transform(leaves, lambda h: F.concat(h, F.when(h < "4", ";").otherwise(","))), "")
    sections = F.transform(F.split(F.rtrim(ends, F.lit(",;")), ";"), lambda s: section(F.split(s, ",")))
    return _let(sections, lambda all_: F.struct(
        F.sha2(F.array_join(F.transform(all_, lambda s: F.left(s, F.lit(64))), ",").cast("binary"), 256).alias("root"),
        F.transform(all_, lambda s: F.concat(F.left(s, F.lit(16)), F.substr(s, F.lit(65)))).alias("sections")))


def as_text(node: Column) -> Column:
    return F.concat_ws(";", node["root"], F.array_join(node["sections"], ";"))


def _leaves(sections: Column) -> Column:
    return F.flatten(F.transform(sections, lambda s: F.split(F.substr(s, F.lit(18)), ",")))


def _pieces(leaves: Column) -> Column:
    marks = F.flatten(F.transform(leaves, lambda h: F.split(F.substr(h, F.lit(18)), "\\.")))
    return F.array_distinct(F.filter(marks, lambda p: p != ""))


def _count(parts: Column, mark: str) -> Column:
    """How often the mark stands in all parts: `.` counts pieces, `,` leaves."""
    return F.length(F.regexp_replace(F.array_join(parts, ""), f"[^{mark}]", ""))


def _parted(a: Column, b: Column, weight: Column) -> Column:
    """The weight so far with that of what a and b share, and what each has alone."""
    return F.struct((weight + _count(F.array_intersect(a, b), ".")).alias("weight"),
                    F.array_except(a, b).alias("a"), F.array_except(b, a).alias("b"))


def likeness(a: Column, b: Column) -> Column:
    def ratio(rest: Column) -> Column:
        own = F.struct(_pieces(rest["a"]).alias("a"), _pieces(rest["b"]).alias("b"))
        return _let(own, lambda p: F.coalesce(F.try_divide(
            2.0 * (rest["weight"] + F.size(F.array_intersect(p["a"], p["b"]))),
            (2 * rest["weight"] + F.size(p["a"]) + F.size(p["b"])).cast("double")), F.lit(0.0)))

    return F.when(a["root"] == b["root"], 1.0).otherwise(
        _let(_parted(a["sections"], b["sections"], F.lit(0)),
             lambda s: _let(_parted(_leaves(s["a"]), _leaves(s["b"]), s["weight"]), ratio)))


def differing(a: Column, b: Column) -> Column:
    """Numbers (from 0) of b's paragraphs that lie in sections a lacks and are not among the leaves of sections b lacks."""
    def told(s: Column) -> Column:
        known = F.array_contains(a["sections"], s)
        return F.transform(F.split(F.substr(s, F.lit(18)), ","), lambda h: F.when(~known, h))

    def missing(lacking: Column) -> Column:
        found = F.transform(F.flatten(F.transform(b["sections"], told)),
                            lambda h, i: F.when(h.isNotNull() & ~F.array_contains(lacking, h), i))
        return F.filter(found, lambda i: i.isNotNull())

    return F.when(a["root"] == b["root"], F.array().cast("array<int>")).otherwise(
        _let(_leaves(F.array_except(a["sections"], b["sections"])), missing))


def first_edit(a: Column, b: Column) -> Column:
    """Number (from 0) of the first paragraph in which the texts differ; null where roots are equal."""
    def lead(x: Column, y: Column) -> Column:
        return (F.array_position(F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False))), F.lit(False)) - 1).cast("int")

    def leaves(node: Column, k: Column) -> Column:
        return F.coalesce(F.split(F.substr(F.get(node["sections"], k), F.lit(18)), ","), F.array().cast("array<string>"))

    return F.when(a["root"] != b["root"], _let(lead(a["sections"], b["sections"]), lambda k: (
        _count(F.slice(a["sections"], F.lit(1), k), ",") + lead(leaves(a, k), leaves(b, k))).cast("long")))


def _bucketed(docs: DataFrame) -> tuple[DataFrame, int]:
    """docs with `bucket`, rising with doc_id: quantile by quantile, evenly spread within each; and the number of buckets."""
    grid = [i / QUANTILES for i in range(QUANTILES + 1)]
    seen = docs.agg(F.count("*").alias("n"), F.percentile_approx("doc_id", grid, 1000).alias("q"),
                    F.min("doc_id").alias("low")).first()
    bounds = sorted({seen["low"], *(seen["q"] or [])} - {None})
    if not bounds:
        return docs.withColumn("bucket", F.lit(0).cast("long")), 1
    parts = -(-seen["n"] // (BUCKET_ROWS * len(bounds)))
    bucket = F.lit(-1).cast("long")
    for i, low in enumerate(bounds):
        width = max(1, -(-(bounds[i + 1] - low) // parts)) if i + 1 < len(bounds) else BUCKET_ROWS
        inside = F.least(F.lit(parts - 1), F.expr(f"(doc_id - {low}L) div {width}L"))
        bucket = F.when(F.col("doc_id") >= low, i * parts + inside).otherwise(bucket)
    return docs.withColumn("bucket", bucket.cast("long")), parts * len(bounds) + 1


def _next_lower(buckets: DataFrame) -> DataFrame:
    """Each bucket and the next lower one there is as `from`; the lowest one has the highest.

    Buckets are looked at in groups of GROUP_BUCKETS, of which the largest of the group before is known.
    """
    group = F.expr(f"bucket div {GROUP_BUCKETS}L")
    groups = buckets.groupBy(group.alias("group")).agg(F.max("bucket").alias("last"))
    # One row for each GROUP_BUCKETS buckets of thousands of documents.
    before = groups.select("group", F.lag("last").over(Window.orderBy("group")).alias("before"))
    inside = buckets.select("bucket", group.alias("group")).withColumn(
        "inside", F.lag("bucket").over(Window.partitionBy("group").orderBy("bucket")))
    top = groups.agg(F.max("last").alias("top"))
    return inside.join(before, "group").join(top, F.lit(True), "left").select("bucket", F.coalesce("inside", "before", "top").alias("from"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, node (tree) and the text and node of the next document (`following`, `after`).

    The order is settled bucket by bucket: one row is added to each bucket, the first
    document of the next lower one, so no task sees more than a bucket.
    """
    rows, buckets = _bucketed(docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    # First in order: the largest id, then the largest text; a missing id is smaller than any.
    heads = settle(rows.groupBy("bucket").agg(F.max(F.struct("doc_id", "text")).alias("head")), "heads")
    added = _next_lower(heads.select("bucket")).join(heads.withColumnRenamed("bucket", "from"), "from").select(
        "head.doc_id", "head.text", "bucket", F.lit(True).alias("added"))
    # The number of tasks grows with the buckets, so that a task holds a few of them at any size.
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets // TASK_BUCKETS)
    placed = rows.withColumn("added", F.lit(False)).unionByName(added).repartition(tasks, "bucket").withColumn("node", tree(F.col("text")))
    order = Window.partitionBy("bucket").orderBy("added", F.desc_nulls_last("doc_id"), F.desc("text"))
    return placed.withColumns({"following": F.lead("text").over(order), "after": F.lead("node").over(order)}).where(
        ~F.col("added")).drop("added", "bucket")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every document."""
    return docs.select("doc_id", as_text(tree(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("fingerprint"))


def judged(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how like they and the next document's are."""
    rows = with_next(docs)
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.left("text", n - cut), F.left("following", cut)))
    rows = rows.withColumn("edit", tree(F.col("edited")))
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("node")).alias("fingerprint"), as_text(F.col("edit")).alias("edited_fingerprint"),
        likeness(F.col("node"), F.col("edit")).alias("near_edited"), likeness(F.col("node"), F.col("after")).alias("near_next"),
        first_edit(F.col("node"), F.col("edit")).alias("first_edit"))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))
