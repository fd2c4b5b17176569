"""Merkle fixity audit of WARC replicas (operator 8).

A record is known by page_id and url, which set its file and its range of the
file; within a file, records lie by range, page_id, url and hash, and so each
range is one run of offsets. Leaves are SHA-256 of the records; a range hashes
its ordered leaves and an inner node its ordered children. Roots are compared,
only mismatching branches are descended, and records are compared in mismatching
ranges alone. Hashes leave offsets out, so that a lost record, which moves all
that follow it, damages its own branch only.

A null url or html is an empty string; equal records are kept as
one with its number of copies, so a page repeated in many rows stays small; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import cut_lineage


def file_count(pages: DataFrame, per_file: int = 1024) -> int:
    """Number of WARC files, so that a file holds about ``per_file`` records at any size."""
    return -(-max(pages.count(), 1) // per_file)


def records(pages: DataFrame, files: int = 64, ranges: int = 256) -> DataFrame:
    """(file, pos, page_id, url, leaf, length, copies, offset) of the distinct records
    of a replica, ``pos`` being the range; replicas are compared under the same
    ``files`` and ``ranges``."""
    url = F.coalesce("url", F.lit(""))
    body = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), url,
                    F.lit("\r\n\r\n"), F.coalesce("html", F.lit("")))
    key = F.xxhash64("page_id", url)
    rec = pages.select(
        F.pmod(key, F.lit(files)).alias("file"), F.pmod(F.shiftright(key, 32), F.lit(ranges)).alias("pos"),
        "page_id", url.alias("url"), F.sha2(body, 256).alias("leaf"),
        F.octet_length(body).cast("long").alias("length"),
    ).groupBy("file", "pos", "page_id", "url", "leaf", "length").agg(F.count("*").alias("copies"))
    w = Window.partitionBy("file").orderBy("pos", "page_id", "url", "leaf")
    before = F.sum(F.col("length") * F.col("copies")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return rec.withColumn("offset", F.coalesce(before, F.lit(0)))


def _node(order: list, said) -> Column:
    """SHA-256 over the parts ``said`` of a node, in ``order``."""
    parts = F.array_sort(F.collect_list(F.struct(*order, said.alias("said"))))
    return F.sha2(F.array_join(F.transform(parts, lambda x: x.said), ","), 256).alias("leaf")


def tree(rec: DataFrame, fan: int, ranges: int) -> list[DataFrame]:
    """Levels (file, pos, leaf) from the ranges up to the root of each file."""
    said = F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), "leaf", "copies")
    # read by every level above and by the descent: written once
    levels = [cut_lineage(rec.groupBy("file", "pos").agg(_node(["page_id", "url", "leaf"], said)))]
    while ranges > 1:
        up = F.floor(F.col("pos") / fan)
        levels.append(levels[-1].groupBy("file", up.alias("up")).agg(_node(["pos"], F.col("leaf")))
                      .withColumnRenamed("up", "pos"))
        ranges = -(-ranges // fan)
    return levels


def audit(a: DataFrame, b: DataFrame, fan: int = 16, ranges: int = 256) -> DataFrame:
    """Differing records (file, pos, page_id, url, offset, copies, status): of ``a``,
    'corrupt' where ``b`` has the page in another form and 'missing' where it has too
    few; of ``b``, 'extra' where ``a`` has no differing form of the page."""
    bad = None
    for x, y in zip(reversed(tree(a, fan, ranges)), reversed(tree(b, fan, ranges))):
        if bad is not None:
            up = F.floor(F.col("pos") / fan).alias("up")
            x, y = (t.select("*", up).join(bad, ["file", "up"], "left_semi").drop("up") for t in (x, y))
        bad = x.join(y.withColumnRenamed("leaf", "other"), ["file", "pos"], "full").where(
            ~F.col("leaf").eqNullSafe(F.col("other"))).select("file", F.col("pos").alias("up"))
    bad = bad.withColumnRenamed("up", "pos")
    page = ["file", "pos", "page_id", "url"]
    both = a.withColumn("side", F.lit(1)).unionByName(b.withColumn("side", F.lit(-1))).join(
        bad, ["file", "pos"], "left_semi")
    differ = both.groupBy(*page, "leaf").agg(
        F.sum(F.col("side") * F.col("copies")).alias("more"),
        F.coalesce(F.max(F.when(F.col("side") == 1, F.col("offset"))), F.max("offset")).alias("offset"),
    ).where("more <> 0")
    w = Window.partitionBy(*page)
    status = F.when(F.col("more") < 0, "extra").when(F.min("more").over(w) < 0, "corrupt").otherwise("missing")
    return differ.withColumn("most", F.max("more").over(w)).withColumn("status", status).where(
        "more > 0 or most < 0").select(*page, "offset", F.abs("more").alias("copies"), "status")
