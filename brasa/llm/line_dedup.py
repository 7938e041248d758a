"""Line dedup by site-relative frequency, native DataFrame operations only.

A line is boilerplate of its host when the share of the host's pages that
contain it exceeds ``ratio``. The pages of a line are counted by a partial
aggregate over 96-bit line keys (each page contributes a line once, so no
distinct count is needed and a line that is on every page adds one row per
map task). The boilerplate lines of one host are at most (mean lines per page)
/ ratio, so they fit in one array per host: a bound by the definition of the
ratio, not a cap. That small table is written first, so the join back to the
pages is broadcast only when its measured size is under the session's limit
and is otherwise a shuffle join whose hot host adaptive execution splits.

Defined results: a null host is a host of its own; a null text stays null and
has no lines; blank lines are never boilerplate and always stay; lines are
compared without surrounding white space; each row counts as one page, also
when rows repeat, or, with ``distinct_pages``, each distinct text of a host
does, so that copies of a page do not vote its own lines out; a line needs
``min_pages`` pages before a ratio is judged, so small hosts lose nothing; an
empty table gives an empty result; other columns, whatever their names, are
kept. The registered query counts rows, as its SQL does; the pipeline counts
distinct texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brasa.session import cut_lineage

RATIO = 0.05
MIN_PAGES = 10
TRIM = " \t\x0b\x0c\r"


def _key(line: Column) -> Column:
    line = F.trim(line, F.lit(TRIM))
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def _distinct_pages(df: DataFrame, host: str, text: str, keys: Column) -> DataFrame:
    """``host, keys`` once for each distinct text of a host; only 128-bit text keys and line keys are dealt out."""
    pages = df.select(F.col(host).alias("host"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"),
                      keys.alias("keys"))
    # plain arrays of numbers are a third of an array of structs
    once = (pages.select("host", "k1", "k2", F.col("keys.a").alias("a"), F.col("keys.b").alias("b"))
            .dropDuplicates(["host", "k1", "k2"]))
    return cut_lineage(once.select("host", F.arrays_zip("a", "b").alias("keys")))


def boilerplate(df: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                min_pages: int = MIN_PAGES, distinct_pages: bool = False) -> DataFrame:
    """``host`` and ``flags``: the keys of the host's boilerplate lines."""
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: F.length(F.trim(x, F.lit(TRIM))) > 0)
    keys = F.array_distinct(F.transform(lines, _key))
    pages = _distinct_pages(df, host, text, keys) if distinct_pages else df.select(F.col(host).alias("host"), keys.alias("keys"))
    totals = pages.groupBy(F.col("host").alias("h")).agg(F.count("*").alias("total"))
    found = (pages.select("host", F.explode("keys").alias("key")).groupBy("host", "key")
             .agg(F.count("*").alias("n")).where(F.col("n") >= min_pages))
    return (found.join(totals, F.col("host").eqNullSafe(F.col("h"))).where(F.col("n") > F.col("total") * ratio)
            .groupBy("host").agg(F.collect_list("key").alias("flags")))


def line_dedup(df: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
               min_pages: int = MIN_PAGES, distinct_pages: bool = False) -> DataFrame:
    """``row`` (the input row), ``kept`` (its text without boilerplate lines), ``n_lines`` and ``n_dropped``."""
    flags = cut_lineage(boilerplate(df, host, text, ratio, min_pages, distinct_pages))
    flags = flags.select(F.col("host").alias("__h"), "flags")
    rows = df.select(F.struct("*").alias("row"))
    joined = rows.join(flags, F.col(f"row.{host}").eqNullSafe(F.col("__h")), "left")
    lines = joined.select("row", "flags", F.split(F.col(f"row.{text}"), "\n").alias("lines"))
    kept = lines.select("row", "lines", F.when(F.col("flags").isNull(), F.col("lines")).otherwise(F.filter(
        "lines", lambda x: ~F.array_contains("flags", _key(x)) | (F.length(F.trim(x, F.lit(TRIM))) == 0)))
        .alias("left"))
    n = lambda c: F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.size(c)).cast("long")
    return kept.select("row", F.when(F.col("left").isNotNull(), F.array_join("left", "\n")).alias("kept"),
                       n("lines").alias("n_lines"), (n("lines") - n("left")).alias("n_dropped"))


def without_boilerplate(df: DataFrame) -> DataFrame:
    """Copies count as one page; ``documents`` with ``text`` and ``n_chars`` replaced, all other columns as they are."""
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return line_dedup(df, distinct_pages=True).select(*[(new.get(c, F.col(f"row.`{c}`"))).alias(c) for c in df.columns])


def query(spark, sf_dir) -> DataFrame:
    from .common import table
    return line_dedup(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.length("kept").cast("long").alias("n_chars"),
        F.sha2("kept", 256).alias("kept_sha256"))


def cleaned_sql(docs: str = "documents") -> str:
    """DuckDB CTEs; ``cleaned`` has rid, the row's columns, lines, left and kept."""
    trim = "trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13))"
    return f"""
src AS (SELECT row_number() OVER () AS rid, * FROM {docs}),
lines AS (SELECT rid, source, unnest(list_distinct(list_filter(list_transform(string_split(text, chr(10)), lambda x: {trim}),
            lambda x: x <> ''))) AS line FROM src),
totals AS (SELECT source, count(*) AS total FROM src GROUP BY source),
flagged AS (SELECT l.source, l.line FROM (SELECT source, line, count(*) AS n FROM lines GROUP BY source, line) l
            JOIN totals t ON l.source IS NOT DISTINCT FROM t.source
            WHERE n >= {MIN_PAGES} AND n > total * CAST({RATIO} AS DOUBLE)),
flags AS (SELECT source, list(line) AS flags FROM flagged GROUP BY source),
split AS (SELECT s.*, string_split(s.text, chr(10)) AS ls, coalesce(f.flags, []) AS flags
          FROM src s LEFT JOIN flags f ON s.source IS NOT DISTINCT FROM f.source),
cleaned AS (SELECT *, list_filter(ls, lambda x: NOT list_contains(flags, {trim})) AS lf,
              CASE WHEN text IS NOT NULL THEN array_to_string(list_filter(ls, lambda x: NOT list_contains(flags, {trim})), chr(10)) END AS kept
            FROM split)"""


def oracle(docs: str = "documents") -> str:
    return f"""WITH {cleaned_sql(docs)}
SELECT doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(ls) - len(lf), 0) AS BIGINT) AS n_dropped,
  CAST(length(kept) AS BIGINT) AS n_chars, sha256(kept) AS kept_sha256 FROM cleaned"""
