"""HTML extraction by inferred wrappers: union-free regular expressions over the pages of a host.

Every page becomes a tree of elements and texts; runs of like siblings fold into repeated
groups. The expressions of a host's pages are aligned one after the other: what only some
have becomes optional, neighbours that have become alike fold again, texts that differ
become slots. A page's texts are those in its article or main part, or all of a page without
one. From these go furniture (menus, headers, footers, sidebars, notices, adverts, forms,
comments, by element or by words of class, id and role) and, on hosts of MANY pages or more,
the wrapper's regions that say the same on all of them; a page without an article part also
loses regions that are only lists of links. A region that only some pages have stays unless
labelled as furniture: tables and figures are optional too.

Alignment is spread: each record batch aligns its own pages of a host, then parts of a host,
then the parts' results, in streams sorted by host, so a host with very many pages never
meets in one task. Wrappers are written to the shared folder; Spark broadcasts them only if
their files are small, else joins by host.

Character references are decoded, white space inside a block becomes one space, blocks are
joined by a line feed. Nothing else is dropped and no text is cut.

 - A missing or empty page gives the empty text; one without markup is its own text.
 - A url that is missing or has no host belongs to the host of empty name.
 - Rows are treated one by one; repeated or missing page ids keep a row each. An empty
   table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, table
from .op2_url_filter import host_and_path
from .page_tree import MANY, align, blocks, expression, parse

#: Parts into which the pages of one host are aligned first.
PARTS = 64
_ROW = "host string, wrapper string, pages long"


def _rows(found: list[tuple[str, list, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([f[0] for f in found], pa.string()), pa.array([json.dumps(f[1], separators=(",", ":")) for f in found], pa.string()),
         pa.array([f[2] for f in found], pa.int64())], ["host", "wrapper", "pages"])


def _of_batches(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in incoming:
        now: dict[str, list] = {}
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html")):
            own = expression(parse(page.as_py() or ""))
            had = now.get(host)
            now[host] = [own, 1] if had is None else [align(had[0], own), had[1] + 1]
        yield _rows([(host, *x) for host, x in now.items()])


def _aligned(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for each run of rows of a host."""
    host, wrapper, pages = None, None, 0
    for batch in incoming:
        for h, w, n in zip(*(c.to_pylist() for c in batch.columns)):
            if h != host:
                if wrapper is not None:
                    yield _rows([(host, wrapper, pages)])
                host, wrapper, pages = h, None, 0
            own = json.loads(w)
            wrapper = own if wrapper is None else align(wrapper, own)
            pages += n
    if wrapper is not None:
        yield _rows([(host, wrapper, pages)])


def wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper (JSON) and number of pages of every host; pages has host and html."""
    found = pages.select("host", "html").mapInArrow(_of_batches, _ROW)
    part = F.pmod(F.xxhash64("wrapper"), F.lit(PARTS))
    found = found.repartition(F.col("host"), part).sortWithinPartitions("host").mapInArrow(_aligned, _ROW)
    return found.repartition(F.col("host")).sortWithinPartitions("host").mapInArrow(_aligned, _ROW)


def _texts(incoming: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, list] = {}
    for batch in incoming:
        out = []
        for page, wrapper, pages in zip(batch.column("html"), batch.column("wrapper").to_pylist(), batch.column("pages").to_pylist()):
            if wrapper is not None and wrapper not in known:
                if len(known) > 256:
                    known.clear()
                known[wrapper] = json.loads(wrapper)
            out.append("\n".join(blocks(parse(page.as_py() or ""), known.get(wrapper), (pages or 0) >= MANY)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    host, _ = host_and_path(F.col("url").cast("string"))
    rows = pages.select("page_id", "url", host.alias("host"), F.col("html").cast("string").alias("html"))
    known = settle(wrappers(rows), "wrappers")
    types = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    found = rows.join(known, "host", "left").select("page_id", "url", "html", "wrapper", "pages").mapInArrow(_texts, f"{types}, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
