"""Category reduction, per-zone split and group-wise mappings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brasa.functions.lookups import FUEL_CODE_LABELS, ZONE_FACTORS
from brasa.operators.geo import filter_by_group_count
from brasa.operators.stats import hash_key, rank_within_groups


def filter_low_observation_zones(df: DataFrame, min_observations: int = 5, zone_col: str = "zone_alert") -> DataFrame:
    """A3: keep zones with strictly more than ``min_observations`` rows."""
    return filter_by_group_count(df, zone_col, min_observations)


# ---- A4 ----------------------------------------------------------------------
def add_fuel_reduced(df: DataFrame, factors: Sequence[str] = ZONE_FACTORS, fuel_col: str = "initial_fuel",
                     fuel_reduced_col: str = "initial_fuel_reduced", min_fuel_samples: float = 15,
                     other_label: str = "other") -> DataFrame:
    """Within each zone, fuel levels seen fewer than ``min_fuel_samples`` times -> ``other_label``.

    A threshold below 1 is a fraction of the zone's rows (nulls included):
    ``max(1, ceil(frac * n))``.  Counts come from two partial aggregates
    (zone x fuel, zone) joined back on small keyed tables — a hot fuel or zone
    never lands in one task.  Rows with a NULL zone factor stay unreduced.
    """
    f = list(factors)
    lvl = df.groupBy(*f, fuel_col).agg(F.count(F.lit(1)).alias("_lvl_n"))
    out = df.join(lvl, f + [fuel_col], "left")
    if min_fuel_samples < 1:
        tot = df.groupBy(*f).agg(F.count(F.lit(1)).alias("_zone_n"))
        out = out.join(tot, f, "left")
        thr = F.greatest(F.lit(1), F.ceil(F.lit(float(min_fuel_samples)) * F.col("_zone_n").cast("double")))
    else:
        thr = F.lit(min_fuel_samples)
    fuel = F.col(fuel_col)
    rare = fuel.isNotNull() & (F.col("_lvl_n") < thr) & F.col(f[0]).isNotNull() & F.col(f[1]).isNotNull()
    zoned = F.col(f[0]).isNotNull() & F.col(f[1]).isNotNull()
    out = out.withColumn(fuel_reduced_col, F.when(zoned, F.when(rare, F.lit(other_label)).otherwise(fuel)))
    return out.drop("_lvl_n", "_zone_n")


def fuel_level_report(df: DataFrame, factors: Sequence[str] = ZONE_FACTORS, fuel_col: str = "initial_fuel",
                      fuel_reduced_col: str = "initial_fuel_reduced") -> DataFrame:
    """A5: distinct original / kept levels per zone."""
    return df.groupBy(*factors).agg(F.countDistinct(fuel_col).alias("n_original"),
                                    F.countDistinct(fuel_reduced_col).alias("n_kept"))


# ---- W2 / W3 -------------------------------------------------------------------
def add_train_test_split(df: DataFrame, zone_col: str = "zone_alert", id_col: str = "fire_id",
                         test_frac: float = 0.20, val_frac: float = 0.20, seed: int = 42,
                         split2_col: str = "split2", split3_col: str = "split3") -> DataFrame:
    """Independent seeded split per zone: ``split3`` in train/valid/test, ``split2`` in train+valid/test.

    Order within a zone is md5(seed:id) (ties by id).  Sizes follow the
    splitter's ceiling rule: ``n_test = ceil(test_frac * n)``, then
    ``n_valid = ceil(val_frac / (1 - test_frac) * (n - n_test))``.  Ranks are
    exact and skew-safe (``rank_within_groups``).
    """
    d = df.withColumn("_h", hash_key(seed, id_col))
    r = rank_within_groups(d, [zone_col], "_h", [id_col])
    n = F.col("_group_n").cast("double")
    n_test = F.ceil(F.lit(float(test_frac)) * n)
    n_val = F.ceil(F.lit(float(val_frac / (1.0 - test_frac))) * (n - n_test))
    rank = F.col("_rank")
    split3 = F.when(rank < n_test, "test").when(rank < n_test + n_val, "valid").otherwise("train")
    return (r.withColumn(split3_col, split3)
             .withColumn(split2_col, F.when(F.col(split3_col) == "test", "test").otherwise("train+valid"))
             .drop("_h", "_rank", "_group_n"))


def split_coverage(df: DataFrame, factors: Sequence[str] = ZONE_FACTORS, fuel_col: str = "initial_fuel_reduced",
                   split_col: str = "split3", levels=("train", "valid", "test")) -> DataFrame:
    """Zone x fuel x split counts, pivoted with fixed levels (no extra pass)."""
    return (df.where(F.col(fuel_col).isNotNull())
              .groupBy(*factors, fuel_col).pivot(split_col, list(levels)).count().na.fill(0, list(levels)))


# ---- A6 ----------------------------------------------------------------------
def learn_groupwise_mapping(df: DataFrame, factors: Sequence[str] = ZONE_FACTORS,
                            categories: Sequence[str] | None = tuple(FUEL_CODE_LABELS.values()),
                            source_col: str = "initial_fuel", target_col: str = "initial_fuel_reduced",
                            other_label: str = "other", strict: bool = True) -> DataFrame:
    """Mapping table ``(f1, f2, source, target)``.

    Every known category defaults to ``other_label`` in every observed zone,
    overwritten by the observed (source -> target) pairs; observed sources
    outside ``categories`` are added.  ``strict``: a source with two targets in
    one zone fails the job (lazy check).
    """
    f = list(factors)
    pairs = (df.where(F.col(source_col).isNotNull() & F.col(target_col).isNotNull())
               .groupBy(*f, source_col)
               .agg(F.min(target_col).alias("_t"), F.countDistinct(target_col).alias("_k")))
    if strict:
        pairs = pairs.withColumn("_t", F.when(F.col("_k") <= 1, F.col("_t")).otherwise(F.raise_error(
            F.concat(F.lit("conflicting mappings for "), F.col(source_col)))))
    pairs = pairs.select(*f, source_col, "_t")
    zones = df.select(*f).distinct()
    if categories is None:  # every observed source label, as one array beside the zones
        found = df.agg(F.array_sort(F.collect_set(source_col)).alias("_cats"), F.lit(0).alias("_all"))
        zones = zones.withColumn("_all", F.lit(0)).join(found, "_all").drop("_all")
    else:
        zones = zones.withColumn("_cats", F.array(*[F.lit(c) for c in dict.fromkeys(categories)]))
    grid = zones.select(*f, F.explode("_cats").alias(source_col))   # zones x categories, a generator
    full = grid.join(pairs, f + [source_col], "full_outer")
    return full.select(*f, source_col, F.coalesce(F.col("_t"), F.lit(other_label)).alias(target_col))


# ---- J11 ----------------------------------------------------------------------
def apply_groupwise_mapping(df: DataFrame, mapping: DataFrame, factors: Sequence[str] = ZONE_FACTORS,
                            source_col: str = "initial_fuel", target_col: str = "initial_fuel_reduced",
                            unknown_label: str = "Unknown", fill_unmapped: bool = True) -> DataFrame:
    """Left join on (f1, f2, source); unmapped -> ``unknown_label``. Replaces an existing target.

    Spark broadcasts the mapping by its measured size.
    """
    f = list(factors)
    m = mapping.select(*f, source_col, F.col(target_col).alias("_mapped"))
    out = df.drop(target_col).join(m, f + [source_col], "left")
    val = F.coalesce(F.col("_mapped"), F.lit(unknown_label)) if fill_unmapped else F.col("_mapped")
    return out.withColumn(target_col, val).drop("_mapped")
