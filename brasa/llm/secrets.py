"""Secret scan with built-in functions only.

Three base patterns are located by splitting the text at the matches and
summing the lengths of pieces and matches (code points), which gives spans
without a user function. Beside them, candidate strings (runs of 20 or more
characters of the base64 / URL-safe alphabet) are judged by what the allow-list
leaves of them: UUIDs go, then the run is split at its separators (/ = _ -)
and parts that are, as a whole, plain words, placeholders or one repeated
character go. The rest, if it is long enough and holds a letter and a digit,
is judged by Shannon entropy: a window of ``WINDOW`` characters slides over it,
the sum of n * log2(n) over the counts in the window is updated by the
entering and the leaving character only, and the candidate is a secret when
the highest entropy reaches the limit of its character class. Candidates that
overlap a base span add nothing.

Everything is a projection of one row: no shuffle, no skew. The work is linear
in the length of a text, of a candidate and in the number of matches, but for
one term with the square of a block of ``SCAN`` matches: running state over an
array is kept by blocks. Defined results: a null or empty text has no spans
(its hash is that of the empty string); very long texts and candidates are
judged whole; repeated rows give repeated results; an empty table gives an
empty result; only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import table

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
#: Maximal runs, so the look-behind only saves attempts inside of a run.
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
KINDS = ("assign", "access", "hex", "entropy")
MIN_VALUE = 8
WINDOW = 20
#: Lowest entropy (bits a character in a window) of a secret, by character class. No window reaches a limit exactly.
LIMITS = {"hex": 3.01, "lower": 3.51, "mixed": 3.76}
UUID = r"(^|[/=_-])[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\b"
SEPARATORS = "[/=_-]"
#: Parts of a run (between separators) that are no secret, as a whole: words, placeholders.
ALLOWED = (r"^([A-Z]?[a-z]{1,15}|[A-Z]{1,15})[0-9]{0,2}$", r"^(?i:example|sample|dummy|placeholder|changeme|test)[0-9]*$",
           r"^1234567(8(90?)?)?$")
REPEATED = r"^(.)\1*$"
#: Matches in a block of a running scan.
SCAN = 256

_SPAN = "struct<start:int,end:int>"


def _with(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once, also inside of a lambda."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _scan(items: Column, zero: Column, step, emit) -> Column:
    """``emit(state before, item)`` for every item, the state being updated by ``step(state, item)``.

    The state at the start of each block of SCAN items comes first, so that no long array grows by one item at a time.
    """
    def run(x):
        blocks = F.transform(F.sequence(F.lit(0), F.size(x) - 1, F.lit(SCAN)), lambda i: F.slice(x, i + 1, F.lit(SCAN)))

        def through(b):
            none = F.filter(F.array(zero), lambda s: F.lit(False))
            begin = F.aggregate(b, F.struct(zero.alias("s"), none.alias("o")), lambda a, k: F.struct(
                F.aggregate(k, a["s"], step).alias("s"), F.concat(a["o"], F.array(a["s"])).alias("o")), lambda a: a["o"])

            def inside(k, s):
                out = F.filter(F.transform(k, lambda i: emit(s, i)), lambda e: F.lit(False))
                return F.aggregate(k, F.struct(s.alias("s"), out.alias("o")), lambda a, i: F.struct(
                    step(a["s"], i).alias("s"), F.concat(a["o"], F.array(emit(a["s"], i))).alias("o")), lambda a: a["o"])
            return F.flatten(F.zip_with(b, begin, inside))
        return _with(blocks, through)
    return _with(items, run)


def _spans(text: Column, pattern: str, valid) -> Column:
    """Spans of the valid matches of ``pattern``; the others are passed over."""
    pieces = F.arrays_zip(F.split(text, pattern, -1).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    sized = F.transform(pieces, lambda x: F.struct(
        F.length(x["p"]).alias("p"), F.coalesce(F.length(x["m"]), F.lit(0)).alias("m"),
        F.coalesce(x["m"].isNotNull() & valid(x["m"]), F.lit(False)).alias("ok")))
    ends = _scan(sized, F.lit(0), lambda at, x: at + x["p"] + x["m"], lambda at, x: F.struct(
        (at + x["p"]).alias("start"), (at + x["p"] + x["m"]).alias("end"), x["ok"].alias("ok")))
    found = F.transform(F.filter(ends, lambda x: x["ok"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(F.array().cast(f"array<{_SPAN}>"))


def max_entropy(s: Column, window: int = WINDOW) -> Column:
    """Highest Shannon entropy of any ``window`` consecutive characters of an ASCII string at least as long."""
    f = lambda n: n * math.log2(n) if n > 1 else 0.0
    # what a character adds to the sum of n * log2(n) if its count was n before
    gain = F.array(*[F.lit(f(n + 1) - f(n)) for n in range(window)])

    def run(c):
        # the leaving character goes first, so the entering one is counted among the window - 1 characters before it
        count = lambda x, at, n: F.size(F.filter(F.slice(c, at, n), lambda y: y == x))
        enter = lambda x, i: F.get(gain, count(x, F.greatest(i + 2 - window, F.lit(1)), F.least(i, F.lit(window - 1))))
        leave = lambda x, i: F.get(gain, count(x, i + 2, F.lit(window - 1)))

        def change(x, i):
            out = F.when(i >= window, leave(F.get(c, i - window), i - window)).otherwise(0.0)
            return enter(x, i) - out

        def step(a, d):
            return F.struct((a["s"] + d).alias("s"), (a["k"] + 1).alias("k"), F.when(
                a["k"] + 1 >= window, F.least(a["low"], a["s"] + d)).otherwise(a["low"]).alias("low"))

        start = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("k"), F.lit(float(f(window))).alias("low"))
        return F.aggregate(F.transform(c, change), start, step, lambda a: math.log2(window) - a["low"] / window)
    return _with(F.transform(F.split(s, ""), F.ascii), run)


def judged(m: Column) -> Column:
    """What the allow-list leaves of a run, its separators made one."""
    def plain(p):
        out = (p == "") | p.rlike(REPEATED)
        for pattern in ALLOWED:
            out = out | p.rlike(pattern)
        return out
    return F.array_join(F.filter(F.split(F.regexp_replace(m, UUID, "$1"), SEPARATORS), lambda p: ~plain(p)), "-")


def looks_secret(m: Column) -> Column:
    def run(s):
        limit = (F.when(s.rlike("^([0-9a-f-]+|[0-9A-F-]+)$"), LIMITS["hex"])
                 .when(~s.rlike("[A-Z]") | ~s.rlike("[a-z]"), LIMITS["lower"]).otherwise(LIMITS["mixed"]))
        short = (F.length(s) < WINDOW) | ~s.rlike("[0-9]") | ~s.rlike("[A-Za-z]")
        return F.when(short, False).otherwise(max_entropy(s) >= limit)
    return _with(judged(m), run)


def _joined(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"], x["end"])), ",")


def find_secrets(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, counts of the base kinds, ``base`` and ``found``: sorted arrays of (start, kind, end)."""
    t = F.col("t")
    yes = lambda m: F.lit(True)
    raw = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t")).select(
        "doc_id",
        _spans(t, ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= MIN_VALUE).alias("assign"),
        F.when(F.contains(t, F.lit("AKIA")), _spans(t, ACCESS, yes)).otherwise(F.array().cast(f"array<{_SPAN}>")).alias("access"),
        _spans(t, HEX, yes).alias("hex"), _spans(t, CANDIDATE, looks_secret).alias("entropy"))
    tag = lambda k: F.transform(k, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(k)).alias("kind"), s["end"].alias("end")))
    base = raw.select("doc_id", *KINDS, F.array_sort(F.concat(*map(tag, KINDS[:3]))).alias("base"))
    # entropy spans that no base span overlaps: one pass for the base spans that start before, one back for those after
    spans = F.array_sort(F.concat(F.col("base"), tag("entropy")))
    mine = lambda x: x["kind"] < len(KINDS) - 1
    field = lambda x, **more: F.struct(*[x[c].alias(c) for c in ("start", "kind", "end")], *[v.alias(k) for k, v in more.items()])
    left = _scan(spans, F.lit(0), lambda s, x: F.when(mine(x), F.greatest(s, x["end"])).otherwise(s),
                 lambda s, x: field(x, clear=mine(x) | (s <= x["start"])))
    right = _scan(F.reverse(left), F.lit(2 ** 31 - 1), lambda s, x: F.when(mine(x), F.least(s, x["start"])).otherwise(s),
                  lambda s, x: field(x, clear=x["clear"] & (mine(x) | (s >= x["end"]))))
    clear = F.transform(F.filter(F.reverse(right), lambda x: x["clear"]), lambda x: field(x))
    return base.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]], "base",
                       F.when(F.size("entropy") > 0, clear).otherwise(F.col("base")).alias("found"))


def query(spark, sf_dir) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", *[f"n_{k}" for k in KINDS[:3]], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"))


def oracle(docs: str = "documents") -> str:
    """DuckDB SQL of :func:`query`: matches by position, entropy of every window by plain counting."""
    pats = {"assign": """(?i:(password|passwd|secret|token|api_?key))["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
            "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+", "entropy": "[A-Za-z0-9+/_=-]+"}
    parts = " UNION ALL ".join(
        f"SELECT rid, {k} AS kind, '{name}' AS name, unnest(regexp_extract_all(t, '{p}', 0)) AS m, "
        f"unnest(regexp_split_to_array(t, '{p}')[:-2]) AS p, generate_subscripts(regexp_extract_all(t, '{p}', 0), 1) AS i FROM d"
        for k, (name, p) in enumerate(pats.items()))
    allowed = " OR ".join([f"regexp_matches(p, '{p}')" for p in ALLOWED] + ["p = repeat(left(p, 1), length(p))"])
    rest = (f"array_to_string(list_filter(string_split_regex(regexp_replace(m, '{UUID}', '\\1', 'g'), '{SEPARATORS}'), "
            f"lambda p: p <> '' AND NOT ({allowed})), '-')")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM {docs}),
m AS ({parts}),
pos AS (SELECT rid, kind, name, m, CAST(sum(length(p) + length(m)) OVER (PARTITION BY rid, kind ORDER BY i ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fin FROM m),
pick AS (SELECT *, fin - length(m) AS start, CASE WHEN name = 'entropy' AND length(m) >= {WINDOW} THEN {rest} ELSE m END AS r FROM pos),
ok AS (SELECT * FROM pick WHERE CASE name
  WHEN 'assign' THEN length(regexp_extract(m, '{pats['assign']}', 2)) >= {MIN_VALUE}
  WHEN 'access' THEN length(m) >= 16 WHEN 'hex' THEN length(m) >= 32
  ELSE length(m) >= {WINDOW} AND length(r) >= {WINDOW} AND regexp_matches(r, '[0-9]') AND regexp_matches(r, '[A-Za-z]') END),
win AS (SELECT rid, start, unnest(range(1, length(r) - {WINDOW - 2})) AS o, r FROM ok WHERE name = 'entropy'),
ch AS (SELECT rid, start, o, c, count(*) AS n FROM (SELECT rid, start, o, unnest(string_split(substr(r, o, {WINDOW}), '')) AS c FROM win) GROUP BY ALL),
ent AS (SELECT rid, start, max(h) AS h FROM (SELECT rid, start, o, -sum(n / {WINDOW}.0 * log2(n / {WINDOW}.0)) AS h FROM ch GROUP BY ALL) GROUP BY ALL),
base AS (SELECT * FROM ok WHERE kind < 3),
extra AS (SELECT k.* FROM ok k JOIN ent e USING (rid, start) WHERE k.name = 'entropy' AND e.h >=
  CASE WHEN regexp_matches(r, '^([0-9a-f-]+|[0-9A-F-]+)$') THEN {LIMITS['hex']}
       WHEN NOT regexp_matches(r, '[A-Z]') OR NOT regexp_matches(r, '[a-z]') THEN {LIMITS['lower']} ELSE {LIMITS['mixed']} END
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = k.rid AND b.start < k.fin AND k.start < b.fin)),
bs AS (SELECT rid, string_agg(name || ':' || start || ':' || fin, ',' ORDER BY start, kind) AS s,
         count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2 FROM base GROUP BY rid),
fs AS (SELECT rid, string_agg(name || ':' || start || ':' || fin, ',' ORDER BY start, kind) AS s
       FROM (SELECT * FROM base UNION ALL SELECT * FROM extra) GROUP BY rid)
SELECT doc_id, CAST(coalesce(n0, 0) AS BIGINT) AS n_assign, CAST(coalesce(n1, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n2, 0) AS BIGINT) AS n_hex, sha256(coalesce(bs.s, '')) AS base_sha256, coalesce(fs.s, '') AS spans
FROM d LEFT JOIN bs USING (rid) LEFT JOIN fs USING (rid)"""
