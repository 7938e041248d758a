"""Quality rules: a threshold table compiled into one Spark projection.

Every rule is a ratio of two per-document counts with a lower and an upper
bound in per cent. ``compile_rules`` turns the table into one boolean column
expression and one text column naming the rules that failed; the counts come
from built-in array and string functions, so the whole operator is a narrow
projection: no user function, no shuffle, no state.

Defined results: a null text counts as empty, an empty or blank text has zero
words and fails the base rule, rows are judged one by one (repeated rows give
repeated results), an empty table gives an empty result, and input columns of
any name survive because the counts live beside a struct of the whole row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE_CHARS, words

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on not he this are at from or an have had his they which "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine auch es an werden aus "
    "de la le et les un du une est pour qui dans par plus pas au sur ne se ce il sont avec ou "
    "el en y los las con no su para al lo como más o pero sus del que"
).split()


@dataclass(frozen=True)
class Rule:
    """``low`` <= 100 * num / den <= ``high``; a bound of None is open."""

    name: str
    num: str
    den: str
    low: int | None = None
    high: int | None = None


#: The threshold table. Counts are those of :func:`counts`.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=250, high=1200),
    Rule("symbols", "n_symbols", "n_words", high=20),
    Rule("exclamations", "n_exclaims", "n_words", high=50),
    Rule("stop_words", "n_stop_words", "n_words", low=5),
    Rule("digits", "n_digits", "word_chars", high=30),
    Rule("dup_lines", "n_dup_lines", "n_lines", high=50),
)
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
          "n_digits", "n_exclaims")


def _n_chars_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (struct of the input row) and the counts of its text.

    Three projections, because an array that a lambda reads by position has to
    be a column of the level below: otherwise it is evaluated once per element.
    """
    first = df.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    split = first.select("row", "t", words(F.col("t")).alias("w"),
                         F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("l"))
    n = F.size("w")
    # (hash, position) of every 3-word window, in hash order: equal windows are neighbours
    windows = split.select("row", "t", "w", "l", F.when(n >= 3, F.array_sort(F.transform(
        F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
        lambda i: F.struct(F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i")))))
        .otherwise(F.array()).alias("s"))
    same = lambda s, j: F.coalesce(F.get("s", j)["h"] == s["h"], F.lit(False))
    repeated = F.array_sort(F.filter(F.transform("s", lambda s, k: F.when(
        (same(s, k - 1) & (k > 0)) | same(s, k + 1), s["i"])), lambda x: x.isNotNull()))
    covered = F.aggregate(
        repeated, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")),
        lambda a: a["n"])
    stop = F.size(F.filter("w", lambda x: F.lower(x).isin(STOP_WORDS)))
    values = {
        "n_words": n, "word_chars": F.length("t") - _n_chars_of(F.col("t"), SPACE_CHARS),
        "n_symbols": _n_chars_of(F.col("t"), "#*$%&|<>"), "n_dup_lines": F.size("l") - F.size(F.array_distinct("l")),
        "n_repeat_words": covered, "n_lines": F.size("l"), "n_stop_words": stop,
        "n_digits": _n_chars_of(F.col("t"), "0123456789"), "n_exclaims": _n_chars_of(F.col("t"), "!"),
    }
    return windows.select("row", *[values[c].cast("long").alias(c) for c in COUNTS])


def compile_rules(rules=RULES) -> tuple[Column, Column]:
    """(names of the failed rules, all rules passed) over the count columns."""
    fails = []
    for r in rules:
        num, den = F.col(r.num) * 100, F.col(r.den)
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (num < den * r.low)
        if r.high is not None:
            bad = bad | (num > den * r.high)
        fails.append((r.name, bad))
    passed = F.lit(True)
    for _, bad in fails:
        passed = passed & ~bad
    return F.concat_ws(",", *[F.when(bad, F.lit(name)) for name, bad in fails]), passed


def quality_rules(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``row``, the counts, ``base_failed``, ``failed_rules`` and ``kept``."""
    failed, passed = compile_rules(rules)
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT)
    return counts(df, text).select("row", *COUNTS, base.alias("base_failed"), failed.alias("failed_rules"),
                                   (~base & passed).alias("kept"))


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` that pass, with their own columns.

    ``inline`` of an array of one row or none, not a filter: a filter would be
    pushed below the projections and evaluate the arrays once per element.
    """
    return quality_rules(df, text).select(F.inline(F.when(F.col("kept"), F.array("row"))))


def query(spark, sf_dir) -> DataFrame:
    from .common import table
    return quality_rules(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), *COUNTS, "base_failed", "failed_rules", "kept")


def rules_sql(rules=RULES) -> tuple[str, str]:
    """The same table as DuckDB SQL: (failed rule names, passed)."""
    bad = []
    for r in rules:
        parts = ([f"{r.num} * 100 < {r.den} * {r.low}"] if r.low is not None else []) + \
                ([f"{r.num} * 100 > {r.den} * {r.high}"] if r.high is not None else [])
        bad.append((r.name, "(" + " OR ".join(parts) + ")"))
    names = ", ".join(f"CASE WHEN {b} THEN '{n}' END" for n, b in bad)
    return f"concat_ws(',', {names})", " AND ".join(f"NOT {b}" for _, b in bad)


def oracle(docs: str = "documents") -> str:
    """DuckDB SQL of :func:`query`; rows keep their identity by a row number, so repeated rows stay apart."""
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    failed, passed = rules_sql()
    chars = lambda cls: f"length(t) - length(regexp_replace(t, '{cls}', '', 'g'))"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM {docs}),
w AS (SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
tri AS (SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM tri) WHERE n > 1),
cov AS (SELECT rid, sum(least(3, i - coalesce(p, -9))) AS n FROM
        (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS p FROM rep) GROUP BY rid),
c AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST({chars('[#*$%&|<>]')} AS BIGINT) AS n_symbols,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, CAST(len(l) AS BIGINT) AS n_lines,
        CAST(len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS BIGINT) AS n_stop_words,
        CAST({chars('[0-9]')} AS BIGINT) AS n_digits, CAST({chars('[!]')} AS BIGINT) AS n_exclaims
      FROM w LEFT JOIN cov USING (rid)),
b AS (SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PCT} AS base_failed,
        {failed} AS failed_rules, {passed} AS passed FROM c)
SELECT * EXCLUDE (passed), NOT base_failed AND passed AS kept FROM b"""
