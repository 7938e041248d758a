"""WARC Merkle fixity audit.

A replica is a set of archive files; its catalogue has one row per record:
``file, offset, length, record_id, digest``. Records are grouped by ordered
ranges of ``RANGE`` bytes of their file (a record belongs to the range of its
first byte); a range node hashes its records' offsets, lengths and digests in
order, and every node above hashes the ranges of its ``FAN`` children, up to
one root per file. An audit joins the roots of two replicas and goes down only
below nodes that differ, so intact files cost one comparison and a corrupt
record one path. Ranges are fixed in the offset space: a missing or extra
record changes its own range and leaves its neighbours aligned.

Only catalogue rows (no payloads) are shuffled. Files are filled up to about
``FILE_BYTES`` by a hash of id, digest and number of the copy, so neither a host
nor null ids nor a group of equal records decide how much one task gets, and
the running offset of a file is a window over bounded rows.

Defined results: null urls and bodies are empty, a null page_id is an id of its
own; repeated rows are separate records at their own offsets, dealt over the
files; an empty replica
against a full one reports every record as missing (or extra); two empty ones
give an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brasa.session import cut_lineage

from .common import table

FILE_BYTES = 32_000_000
RANGE = 1 << 16
FAN_BITS = 4
#: Equal records that are numbered in one step.
COPIES = 4096
#: Share of records damaged in the replica that the query audits, out of 256 by kind.
DAMAGE = {"altered": (0, 4), "truncated": (4, 6), "missing": (6, 8)}


def record(url: Column, body: Column, page_id: Column) -> Column:
    """The bytes of a WARC resource record, as text."""
    body, url, pid = (F.coalesce(c.cast("string"), F.lit("")) for c in (body, url, page_id))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), pid,
                    F.lit(">\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def _mark(page_id: Column, digest: Column) -> Column:
    return F.md5(F.concat(F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":"), digest))


def _records(pages: DataFrame) -> DataFrame:
    """``page_id, r, digest, m`` of every page: the record, its sha256 and the md5 that decides about it."""
    rows = pages.select("page_id", record(F.col("url"), F.col("html"), F.col("page_id")).alias("r"))
    rows = rows.withColumn("digest", F.sha2("r", 256))
    return rows.withColumn("m", _mark(F.col("page_id"), F.col("digest")))


def catalogue(pages: DataFrame) -> DataFrame:
    """Catalogue of the archive that holds ``pages`` (page_id, url, html), in page order within each file."""
    rows = cut_lineage(_records(pages).select("page_id", F.octet_length("r").cast("long").alias("length"), "digest", "m"))
    size = rows.agg(F.sum("length")).first()[0] or 0
    n = max(1, math.ceil(size / FILE_BYTES))
    # equal records are counted before they are shuffled, and numbered afterwards
    rows = (rows.groupBy("page_id", "length", "digest", "m").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {COPIES}"))))
            .withColumn("copy", F.explode(F.sequence(F.lit(0), F.least(F.lit(COPIES), F.expr(f"n - block * {COPIES}")) - 1)))
            .withColumn("copy", F.col("block") * COPIES + F.col("copy")))
    place = F.md5(F.concat_ws(":", "m", "copy"))
    file = (F.conv(F.substring(place, 1, 8), 16, 10).cast("long") % n).alias("file")
    order = W.partitionBy("file").orderBy("page_id", "length", "digest").rowsBetween(W.unboundedPreceding, -1)
    return rows.select(file, "page_id", "length", "digest", "m").select(
        "file", F.coalesce(F.sum("length").over(order), F.lit(0)).alias("offset"), "length",
        F.col("page_id").alias("record_id"), "digest", "m")


def tree(records: DataFrame, levels: int) -> DataFrame:
    """Nodes ``file, level, idx, hash`` of a catalogue; level 0 are the offset ranges."""
    own = F.struct(F.col("offset"), F.concat_ws(":", "offset", "length", "digest").alias("h"))
    level = records.groupBy("file", F.expr(f"offset div {RANGE}").alias("idx")).agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(own)), lambda x: x["h"]), "\n"), 256).alias("hash"))
    out = level.withColumn("level", F.lit(0))
    for k in range(1, levels):
        child = F.struct("idx", F.concat_ws(":", "idx", "hash").alias("h"))
        level = level.groupBy("file", F.shiftright("idx", FAN_BITS).alias("idx")).agg(
            F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(child)), lambda x: x["h"]), "\n"), 256).alias("hash"))
        out = out.unionByName(level.withColumn("level", F.lit(k)))
    return cut_lineage(out)


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """``file, offset, record_id, length, status``: records of ``a`` that ``b`` has lost (``missing``) or altered
    (``altered``), and records that only ``b`` has (``extra``)."""
    top = max((r[0] or 0) for r in a.select("offset").unionByName(b.select("offset")).agg(F.max("offset")).collect())
    levels = 1
    while top // RANGE >> (FAN_BITS * (levels - 1)):
        levels += 1
    ta, tb = tree(a, levels), tree(b, levels)
    bad = None
    for k in reversed(range(levels)):
        sides = []
        for t, name in ((ta, "x"), (tb, "y")):
            side = t.where(F.col("level") == k).select("file", "idx", F.col("hash").alias(name))
            if bad is not None:
                up = bad.select("file", F.col("idx").alias("up"))
                side = side.withColumn("up", F.shiftright("idx", FAN_BITS)).join(up, ["file", "up"], "left_semi").drop("up")
            sides.append(side)
        bad = cut_lineage(sides[0].join(sides[1], ["file", "idx"], "full").where(~F.col("x").eqNullSafe(F.col("y")))
                          .select("file", "idx"))
    leaf = [r.withColumn("idx", F.expr(f"offset div {RANGE}")).join(bad, ["file", "idx"], "left_semi").select(
        "file", "offset", F.struct("record_id", "length", "digest").alias(name)) for r, name in ((a, "x"), (b, "y"))]
    both = leaf[0].join(leaf[1], ["file", "offset"], "full")
    status = F.when(F.col("y").isNull(), "missing").when(F.col("x").isNull(), "extra").otherwise("altered")
    return both.where(~F.col("x").eqNullSafe(F.col("y"))).select(
        "file", "offset", F.coalesce("x", "y")["record_id"].alias("record_id"),
        F.coalesce("x", "y")["length"].alias("length"), status.alias("status"))


def damaged(records: DataFrame, pages: DataFrame) -> DataFrame:
    """Catalogue of a second replica that holds ``pages`` record by record at the same places: some records have a
    changed byte, lost their end, or are gone.

    Which ones follows from the md5 of id and digest. Digests and lengths are those of the replica's own bytes; a
    record that lost its end leaves a hole before the next.
    """
    hit = F.conv(F.substring("m", 31, 2), 16, 10).cast("int")
    within = lambda k: (hit >= DAMAGE[k][0]) & (hit < DAMAGE[k][1])
    r = F.col("r")
    new = F.when(within("altered"), F.concat(F.lit("X"), F.substring(r, 2, 2 ** 31 - 2))).otherwise(
        F.substring(r, F.lit(1), F.length(r) - 8))
    changed = (_records(pages).where(within("altered") | within("truncated")).withColumn("r", new)
               .select("digest", F.sha2("r", 256).alias("new"), F.octet_length("r").cast("long").alias("size")).distinct())
    return records.where(~within("missing")).join(changed, "digest", "left").select(
        "file", "offset", F.coalesce("size", "length").alias("length"), "record_id", F.coalesce("new", "digest").alias("digest"))


def query(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    first = cut_lineage(catalogue(pages))
    return audit(first.drop("m"), cut_lineage(damaged(first, pages)))


def oracle(pages: str = "pages") -> str:
    """DuckDB SQL of :func:`query`: offsets, and the records that the damage rule names."""
    return f"""
WITH r AS (SELECT page_id,
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), '')
      || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
      || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
      || chr(13) || chr(10) || chr(13) || chr(10) AS r FROM {pages}),
s AS (SELECT page_id, CAST(strlen(r) AS BIGINT) AS length, sha256(r) AS digest FROM r),
c AS (SELECT *, md5(coalesce(CAST(page_id AS VARCHAR), '') || ':' || digest) AS m,
    row_number() OVER (PARTITION BY page_id, digest) - 1 AS copy FROM s),
n AS (SELECT greatest(1, CAST(ceil(sum(length) / {FILE_BYTES}.0) AS BIGINT)) AS n FROM c),
f AS (SELECT CAST('0x' || substr(md5(m || ':' || copy), 1, 8) AS BIGINT) % n AS file, CAST('0x' || substr(m, 31, 2) AS INT) AS hit, * FROM c, n),
o AS (SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id NULLS FIRST, length, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM f)
SELECT file, "offset", page_id AS record_id, length,
  CASE WHEN hit >= {DAMAGE['missing'][0]} AND hit < {DAMAGE['missing'][1]} THEN 'missing' ELSE 'altered' END AS status
FROM o WHERE hit < {DAMAGE['missing'][1]}"""
