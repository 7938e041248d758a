"""Long-form predictions and tail-risk residual diagnostics.

Two grouped passes: (1) counts, sums and exact quantile cut-offs per group;
(2) tail means against the joined cut-offs.  Both are partial aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brasa.operators.stats import join_groups, quantiles_of

LONG_ID_COLUMNS = ["fire_id", "zone_WE", "zone_NS", "high_season", "diurnal_nocturnal", "zone_alert",
                   "split2", "propagation_speed_mm"]
LONG_MODELS = ["xgb0", "circular_speed_mm", "base"]


def to_long(df: DataFrame, id_cols: Sequence[str] = LONG_ID_COLUMNS, models: Sequence[str] = LONG_MODELS,
            stubs: Sequence[str] = ("prediction", "lo", "hi"), model_col: str = "model") -> DataFrame:
    """Wide ``<stub>_<model>`` columns -> one row per (id, model) (a generator, no shuffle)."""
    ids = [c for c in id_cols if c in df.columns]
    rows = F.array(*[F.struct(F.lit(m).alias(model_col),
                              *[F.col(f"{s}_{m}").cast("double").alias(s) for s in stubs]) for m in models])
    return df.select(*ids, F.inline(rows))


def residual_diagnostics(df: DataFrame, cols: Sequence[str], y_true: str, y_pred: str,
                         cutoff: float = 0.95) -> DataFrame:
    """Per group: n, n_scored, RMSE, MAE, RelativeMAE, MaxAbsError, CVaRAbs, VaRUnder,
    VaROver, CVaRUnder, CVaROver, RiskFactor.

    ``n`` counts every row; residual statistics use rows with both values.
    """
    g = list(cols)
    for c in [y_true, y_pred] + g:
        if c not in df.columns:
            raise KeyError(f"Column '{c}' not found in df.")
    y, yh = F.col(y_true), F.col(y_pred)
    d = df.select(*g, y.alias("_y"), yh.alias("_yh"),
                  F.when(y.isNotNull() & yh.isNotNull(), y - yh).alias("_r"))
    d = d.withColumn("_ar", F.abs("_r"))
    p1 = d.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n"), F.count("_r").alias("n_scored"),
        F.sqrt(F.avg(F.col("_r") * F.col("_r"))).alias("RMSE"),
        F.avg("_ar").alias("MAE"), F.max("_ar").alias("MaxAbsError"),
        F.avg(F.when(F.col("_r").isNotNull(), F.col("_y"))).alias("_ybar"),
        F.avg("_y").alias("_ymean"), F.avg("_yh").alias("_yhmean"))
    cuts = quantiles_of(d, g, {"_qabs": ("_ar", cutoff), "VaRUnder": ("_r", cutoff), "VaROver": ("_r", 1 - cutoff)}).drop("n")
    stats = join_groups(p1, cuts, g, "left")
    # every row has its group: a left join, so that only the table of groups can be broadcast
    j = join_groups(d, stats.select(*g, "_ybar", "_qabs", "VaRUnder", "VaROver"), g, "left")
    r, ar = F.col("_r"), F.col("_ar")
    p2 = j.groupBy(*g).agg(
        F.avg(F.when(r.isNotNull(), F.abs(F.col("_y") - F.col("_ybar")))).alias("_mae_mean"),
        F.avg(F.when(ar >= F.col("_qabs"), ar)).alias("CVaRAbs"),
        F.avg(F.when(r >= F.col("VaRUnder"), ar)).alias("CVaRUnder"),
        F.avg(F.when(r <= F.col("VaROver"), ar)).alias("CVaROver"))
    out = join_groups(stats, p2, g, "left")
    rel = F.when(F.col("_mae_mean") != 0, F.col("MAE") / F.col("_mae_mean"))
    risk = F.when(F.abs(F.col("_yhmean")) > F.lit(1e-8), F.col("_ymean") / F.col("_yhmean"))
    return out.select(*g, "n", "n_scored", "RMSE", "MAE", rel.alias("RelativeMAE"), "MaxAbsError",
                      F.coalesce("CVaRAbs", F.lit(0.0)).alias("CVaRAbs"), "VaRUnder", "VaROver",
                      F.coalesce("CVaRUnder", F.lit(0.0)).alias("CVaRUnder"),
                      F.coalesce("CVaROver", F.lit(0.0)).alias("CVaROver"), risk.alias("RiskFactor"))


def numeric_summary(df: DataFrame, cols: Sequence[str], stats: Sequence[str] = ("count", "mean", "stddev", "min",
                                                                             "25%", "50%", "75%", "max")) -> DataFrame:
    """``summary()`` of numeric columns with ±inf treated as missing."""
    clean = df.select(*[F.when(~F.col(c).isin(float("inf"), float("-inf")), F.col(c)).alias(c) for c in cols])
    return clean.summary(*stats)
