"""Skew-safe building blocks shared by the operators.

Assume one group may hold a third of all rows.  Nothing here sends a whole
group to one task:

* ``quantiles_of`` — exact linear-interpolated quantiles of several columns per
  group.  A mergeable sketch (``percentile_approx``, partial aggregation)
  brackets each target rank in a narrow value window; the rows inside are
  counted by value in one more scan, a range histogram of the window finds the
  bins that hold the rank, and only those are ranked exactly: one plan for
  every group size.
* ``rank_within_groups`` — exact 0-based rank by a uniformly distributed hash
  string.  Rows are split into 4096 sub-buckets by hash prefix; the rank is the
  sub-bucket's offset (from a groups x 4096 count table) plus the row's
  position inside the sub-bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brasa.session import cut_lineage

SKETCH_ACCURACY = 100_000
#: Equal ranges of a bracket.
BINS = 1024


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on group columns where NULL is a group like any other."""
    cond = F.lit(True)
    for c in keys:
        right = right.withColumnRenamed(c, f"_k_{c}")
        cond = cond & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return left.join(right, cond, how).drop(*[f"_k_{c}" for c in keys])


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float], names: Sequence[str] | None = None,
                    accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """One row per group: ``group_cols + names + ['n']``; see :func:`quantiles_of`."""
    names = list(names or [f"q{i}" for i in range(len(probs))])
    return quantiles_of(df, group_cols, {nm: (value_col, p) for nm, p in zip(names, probs)}, accuracy)


def quantiles_of(df: DataFrame, group_cols: Sequence[str], wanted: Mapping[str, tuple[str, float]],
                 accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """Quantiles of several columns, ``name -> (column, p)``: one row per group, ``group_cols + names + ['n']``.

    Linear interpolation between order statistics at ``p * (n - 1)`` (the
    numpy / ``quantile_cont`` definition).  NULL and NaN values are skipped;
    a NULL group key is a group; ``n`` is the largest number of values.

    One plan for every size and two scans of the values, which are written once
    as (group, column, value).  The first gives, by a mergeable sketch, two
    values that enclose each target rank with a margin of ten times its error.
    The second counts the rows below them and, by value, the rows between them.
    Equal ranges of a bracket (``BINS``) tell which of them holds the rank, and
    the values of that one are ranked.  A group with fewer rows than the margin
    is its own bracket.  A rank outside of its bracket fails the job instead of
    giving NULL.
    """
    g = list(group_cols)
    ungrouped = not g
    if ungrouped:  # one global group: a constant key
        df, g = df.withColumn("_all", F.lit(0)), ["_all"]
    names, cols = list(wanted), list(dict.fromkeys(c for c, _ in wanted.values()))
    at = [cols.index(c) for c, _ in wanted.values()]
    probs = [p for _, p in wanted.values()]
    delta = 10.0 / accuracy
    ends = [max(0.0, p - delta) for p in probs] + [min(1.0, p + delta) for p in probs]

    one = lambda i, c: [F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v")]
    values = one(0, cols[0]) if len(cols) == 1 else [F.inline(F.array(*[F.struct(*one(i, c)) for i, c in enumerate(cols)]))]
    v = cut_lineage(df.select(*g, *values).where(F.col("_v").isNotNull() & ~F.isnan("_v")))
    stats = v.groupBy(*g, "_c").agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", ends, accuracy).alias("_b"))
    # the margin has to hold the two order statistics around the rank: delta * n >= 2
    whole = F.col("_n") * F.lit(delta) < 2
    brackets = F.array(*[F.when(F.col("_c") == at[k], F.struct(
        F.lit(k).alias("_k"), F.lit(float(p)).alias("_p"), F.when(whole, F.lit(float("-inf"))).otherwise(F.col("_b")[k]).alias("_lo"),
        F.when(whole, F.lit(float("inf"))).otherwise(F.col("_b")[len(names) + k]).alias("_hi"))) for k, p in enumerate(probs)])
    # one row per group and column, written: joins meet it by its measured size, the sketch runs once.  The values are
    # the left side of left joins (each has its group), so they are never the side that goes through the driver.
    stats = cut_lineage(stats.select(*g, "_c", "_n", F.filter(brackets, lambda b: b.isNotNull()).alias("_b")))
    # a value below a bracket counts as NULL
    met = F.transform(F.filter("_b", lambda b: F.col("_v") <= b["_hi"]), lambda b: F.struct(
        b["_k"].alias("_k"), F.when(F.col("_v") >= b["_lo"], F.col("_v")).alias("_x")))
    counted = cut_lineage(join_groups(v, F.broadcast(stats) if ungrouped else stats, g + ["_c"], "left")
                          .select(*g, F.inline(met)).groupBy(*g, "_k", "_x").agg(F.count(F.lit(1)).alias("_cnt")))

    pos = F.col("_p") * (F.col("_n") - 1).cast("double")
    target = stats.select(*g, "_n", F.inline("_b")).withColumn("_pos", pos)
    below = counted.where("_x is null").select(*g, "_k", F.col("_cnt").alias("_below"))
    target = cut_lineage(join_groups(target, below, g + ["_k"], "left").select(
        *g, "_k", "_n", "_lo", "_hi", "_pos", F.floor("_pos").alias("_rlo"), F.ceil("_pos").alias("_rhi"),
        F.coalesce("_below", F.lit(0)).alias("_below")))
    share = (F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    narrow = (F.col("_lo") == float("-inf")) | (F.col("_hi") <= F.col("_lo")) | F.isnan(share)
    binned = join_groups(counted.where("_x is not null"), target, g + ["_k"], "left").withColumn(
        "_bin", F.when(narrow, 0).otherwise(F.least(F.lit(BINS - 1), F.floor(share * BINS).cast("int"))))
    # at most BINS rows in a window, then the values of the bins that hold a rank
    order = Window.partitionBy(*g, "_k").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = binned.groupBy(*g, "_k", "_bin").agg(F.sum("_cnt").alias("_size"), F.first("_below").alias("_below"),
                                                F.first("_rlo").alias("_rlo"), F.first("_rhi").alias("_rhi"))
    start = F.col("_below") + F.coalesce(F.sum("_size").over(order), F.lit(0))
    bins = cut_lineage(bins.withColumn("_start", start).where(
        (F.col("_start") <= F.col("_rhi")) & (F.col("_start") + F.col("_size") > F.col("_rlo"))).select(*g, "_k", "_bin", "_start"))
    inside = Window.partitionBy(*g, "_k", "_bin").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = join_groups(binned.drop("_below"), bins, g + ["_k", "_bin"]).withColumn(
        "_end", F.col("_start") + F.sum("_cnt").over(inside))
    holds = lambda r: (F.col("_end") - F.col("_cnt") <= F.col(r)) & (F.col(r) < F.col("_end"))
    picked = ranked.groupBy(*g, "_k", "_pos", "_rlo", "_n").agg(
        F.max(F.when(holds("_rlo"), F.col("_x"))).alias("_vlo"), F.max(F.when(holds("_rhi"), F.col("_x"))).alias("_vhi"))
    q = F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * (F.col("_pos") - F.col("_rlo").cast("double"))
    found = F.when(q.isNull(), F.raise_error(F.lit("quantile rank outside of its bracket"))).otherwise(q)
    out = picked.groupBy(*g).agg(
        *[F.max(F.when(F.col("_k") == k, found)).alias(nm) for k, nm in enumerate(names)], F.max("_n").alias("n"))
    return out.drop("_all") if ungrouped else out


def exact_quantile_value(df: DataFrame, value_col: str, prob: float, **kw) -> float | None:
    """Scalar exact quantile (one small action)."""
    r = exact_quantiles(df, [], value_col, [prob], ["q"], **kw).collect()
    return r[0]["q"] if r else None


def hash_key(seed: int, *cols) -> F.Column:
    """Seeded md5 hex of the key columns: uniform, portable (same text in SQL)."""
    parts = [F.lit(f"{seed}")]
    for c in cols:
        parts += [F.lit(":"), (F.col(c) if isinstance(c, str) else c).cast("string")]
    return F.md5(F.concat(*parts))


def rank_within_groups(df: DataFrame, group_cols: Sequence[str], hash_col: str,
                       tie_cols: Sequence[str] = (), rank_col: str = "_rank",
                       size_col: str = "_group_n") -> DataFrame:
    """Exact 0-based rank by ``hash_col`` (hex string) within each group, plus group size."""
    g = list(group_cols)
    sb = F.substring(F.col(hash_col), 1, 3)
    d = df.withColumn("_sb", sb)
    counts = d.groupBy(*g, "_sb").agg(F.count(F.lit(1)).alias("_cnt"))
    wo = Window.partitionBy(*g).orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)
    wt = Window.partitionBy(*g)
    # groups x 4096 rows at most: each window partition is bounded by 4096 rows
    offs = counts.select(*g, "_sb",
                         F.coalesce(F.sum("_cnt").over(wo), F.lit(0)).alias("_off"),
                         F.sum("_cnt").over(wt).alias(size_col))
    wr = Window.partitionBy(*g, "_sb").orderBy(F.col(hash_col), *[F.col(c) for c in tie_cols])
    return (d.withColumn("_rn", F.row_number().over(wr))
             .transform(lambda x: join_groups(x, offs, g + ["_sb"]))
             .withColumn(rank_col, F.col("_off") + F.col("_rn") - 1)
             .drop("_sb", "_rn", "_off"))
