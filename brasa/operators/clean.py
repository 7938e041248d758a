"""Cleaning operators for incident and dispatch tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brasa.functions.columns import lookup, parse_decimal_text, require
from brasa.functions.lookups import (
    DISPATCH_ZONES, REPORT_TYPES, TARGET_ZONE_OTHER, TARGET_ZONES, ZONE_PREFIX,
    ZONE_FACTORS, ZONE_NS_LEVELS, ZONE_WE_LEVELS,
)
from brasa.functions.text import team_code_v1, team_code_v2

TIME_FORMAT = "yyyy-MM-dd HH:mm"


# ---- F1 -------------------------------------------------------------------
def parse_datetime(c, fmt: str = TIME_FORMAT):
    """Trimmed text -> TIMESTAMP_NTZ with a strict pattern; bad text -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(F.trim(col.cast("string")), F.lit(fmt)).cast("timestamp_ntz")


def add_date_time_columns(df: DataFrame, date_column: str = "INICIO", out: str | None = None,
                          day_col: str | None = None, hour_col: str | None = None,
                          fmt: str = TIME_FORMAT) -> DataFrame:
    """Parse ``date_column`` in place (or into ``out``) and add ``DIA_<c>`` / ``HORA_<c>``."""
    if date_column not in df.columns:
        raise KeyError(f"Column '{date_column}' not found")
    out = out or date_column
    ts = parse_datetime(date_column, fmt)
    return (df.withColumn(out, ts)
              .withColumn(day_col or f"DIA_{date_column}", F.to_date(out))
              .withColumn(hour_col or f"HORA_{date_column}", F.hour(out).cast("int")))


# ---- F2 / F3 / F4 / F5 / W1 -------------------------------------------------
def filter_report_types(df: DataFrame, col: str = "TIPO_FICHA", keep: Sequence[str] = REPORT_TYPES) -> DataFrame:
    return df.where(F.col(col).isin(list(keep)))


def standard_dispatch_id(fire_id, dispatch_id):
    """bigint(text(fire_id) || text(dispatch_id)); non-numeric text raises (ANSI cast)."""
    f = F.col(fire_id) if isinstance(fire_id, str) else fire_id
    d = F.col(dispatch_id) if isinstance(dispatch_id, str) else dispatch_id
    return F.concat(f.cast("string"), d.cast("string")).cast("bigint")


def filter_id_length(df: DataFrame, col: str, length: int = 9) -> DataFrame:
    return df.where(F.length(F.col(col).cast("string")) == length)


def filter_zones(df: DataFrame, col: str = "ZONA", keep: Sequence[str] = DISPATCH_ZONES) -> DataFrame:
    return df.where(F.col(col).isin(list(keep)))


def strip_zone_prefix(df: DataFrame, col: str = "ZONA", prefix: str = ZONE_PREFIX) -> DataFrame:
    return df.withColumn(col, F.replace(F.col(col), F.lit(prefix), F.lit("")))


def keep_first(df: DataFrame, key: Sequence[str] | str, order_cols: Sequence[str]) -> DataFrame:
    """Keep the first row per key in ``order_cols`` order (deterministic).

    A rank-limited window: each task keeps its own first row of a key before the
    shuffle, so a hot key sends one row per task.  Ties are broken by the other
    columns.  Rows with a NULL in the key are not duplicates of each other: each
    has a group of its own, in the same branch of the plan.
    """
    key = [key] if isinstance(key, str) else list(key)
    missing = F.lit(False)
    for c in key:
        missing = missing | F.col(c).isNull()
    ties = [c for c, t in df.dtypes if c not in key and c not in order_cols and not t.startswith("map")]
    alone = F.when(missing, F.monotonically_increasing_id()).otherwise(F.lit(-1))
    first = Window.partitionBy(*key, "_alone").orderBy(*order_cols, *ties)
    return (df.withColumn("_alone", alone).withColumn("_nth", F.row_number().over(first))
            .where("_nth = 1").drop("_alone", "_nth"))


@dataclass(frozen=True)
class DispatchNames:
    """What a dispatch table calls its columns."""
    kind: str
    fire: str
    dispatch: str
    standard: str
    zone: str
    file: str


RAW_DISPATCHES = DispatchNames("TIPO_FICHA", "ID_FOCO_INCENDIO", "ID_DESPACHO", "ID_INCENDIO_DESPACHO", "ZONA", "ARCHIVO")
DISPATCHES = DispatchNames("report_type", "fire_id", "dispatch_id", "fire_dispatch_id", "zone", "file_source")


def standard_dispatches(df: DataFrame, names: DispatchNames, order: Sequence[str]) -> DataFrame:
    """F2 -> F3 -> F4 -> W1 (first row of an id within each report file) -> F5; the dedup precedes the zone filter."""
    return (df.transform(filter_report_types, names.kind)
            .withColumn(names.standard, standard_dispatch_id(names.fire, names.dispatch))
            .transform(filter_id_length, names.fire)
            .transform(keep_first, [names.standard, names.file], order)
            .transform(filter_zones, names.zone)
            .transform(strip_zone_prefix, names.zone))


# ---- F6 -------------------------------------------------------------------
def standardize_fire_ids(df: DataFrame, std_col: str = "ID_FOCO_INCENDIO", id_col: str = "FICHA",
                         length: int = 9) -> DataFrame:
    if std_col not in df.columns:
        if id_col not in df.columns:
            raise KeyError(f"Column '{id_col}' not found")
        df = df.withColumnRenamed(id_col, std_col)
    return filter_id_length(df, std_col, length)


# ---- X1-X3 ----------------------------------------------------------------
def standardize_teams(df: DataFrame, col: str = "GLOSA", source_col: str = "ARCHIVO",
                      v1_sources: Sequence[str] = (), v2_sources: Sequence[str] = ()) -> DataFrame:
    """Rewrite team codes with rule variant 1 or 2 chosen by the lineage column.

    Any number of sources; sources in neither list keep their text.
    """
    src = F.col(source_col)
    s = F.col(col).cast("string")
    return df.withColumn(col, F.when(src.isin(list(v1_sources)), team_code_v1(s))
                               .when(src.isin(list(v2_sources)), team_code_v2(s))
                               .otherwise(s))


# ---- F7 -------------------------------------------------------------------
def filter_target_zones(df: DataFrame, mapping: Mapping[str, str] = TARGET_ZONES,
                        other: str = TARGET_ZONE_OTHER, col: str = "target_zone") -> DataFrame:
    if col not in df.columns:
        raise KeyError(f"Column '{col}' not found")
    recoded = lookup(col, mapping, other)
    return df.withColumn(col, recoded).where(F.col(col) != F.lit(other))


# ---- F8 -------------------------------------------------------------------
def normalise_surface(df: DataFrame, initial: str = "initial_surface_ha", final: str = "final_surface_ha") -> DataFrame:
    """Text surfaces (``1.234,56``; final may end in ``m2``) -> double. Numeric columns pass."""
    types = dict(df.dtypes)
    out = df
    if types.get(initial) == "string":
        out = out.withColumn(initial, parse_decimal_text(initial))
    if types.get(final) == "string":
        out = out.withColumn(final, parse_decimal_text(final, strip=("m2",)))
    return out


def surface_violations(df: DataFrame, initial: str = "initial_surface_ha", final: str = "final_surface_ha") -> DataFrame:
    """Rows breaking the surface rules, with a ``violation`` label."""
    i, f = F.col(initial), F.col(final)
    label = (F.when(i < 0, "negative_initial")
              .when(f < 0, "negative_final")
              .when(i.isNotNull() & f.isNotNull() & (f < i), "final_below_initial"))
    return df.withColumn("violation", label).where(F.col("violation").isNotNull())


def validate_surface(df: DataFrame, initial: str = "initial_surface_ha", final: str = "final_surface_ha") -> DataFrame:
    """Lazy assertion: the first violating row fails the job (no extra pass)."""
    i, f = F.col(initial), F.col(final)
    bad = (i < 0) | (f < 0) | (f < i)
    return require(df, ~F.coalesce(bad, F.lit(False)), "surface violation: negative area or final < initial")


# ---- F9 -------------------------------------------------------------------
def coerce_hr_columns(df: DataFrame, prefix: str = "hr_", fmt: str | None = None) -> DataFrame:
    """Every ``hr_*`` column to TIMESTAMP_NTZ; unparsable text -> NULL (one projection)."""
    types = dict(df.dtypes)
    cols = []
    for c in df.columns:
        if c.startswith(prefix) and types[c] not in ("timestamp", "timestamp_ntz"):
            s = F.trim(F.col(c).cast("string"))
            ts = F.try_to_timestamp(s, F.lit(fmt)) if fmt else F.coalesce(
                F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(s, F.lit(TIME_FORMAT)))
            cols.append(ts.cast("timestamp_ntz").alias(c))
        elif c.startswith(prefix):
            cols.append(F.col(c).cast("timestamp_ntz").alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


# ---- F10 / F12 --------------------------------------------------------------
def filter_by_range(df: DataFrame, thresholds: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Inclusive bounds ANDed; a missing value fails its bound."""
    cond = F.lit(True)
    for col, b in thresholds.items():
        if "lower" in b:
            cond = cond & F.coalesce(F.col(col) >= F.lit(b["lower"]), F.lit(False))
        if "upper" in b:
            cond = cond & F.coalesce(F.col(col) <= F.lit(b["upper"]), F.lit(False))
    return df.where(cond)


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL (or NaN) in ``subset`` (all columns by default)."""
    return df.na.drop("any", subset=list(subset) if subset else None)


# ---- F11 --------------------------------------------------------------------
def zone_factors(df: DataFrame, factors: Sequence[str] = ZONE_FACTORS, check: bool = True) -> DataFrame:
    """Drop rows missing a zone factor, make ``zone_NS`` integer text, check levels.

    The level check is a lazy per-row assertion (a filter, see ``require``), not an
    extra pass over the data.
    """
    out = df.na.drop("any", subset=list(factors))
    f1, f2 = factors
    out = out.withColumn(f2, F.col(f2).try_cast("double").try_cast("bigint").cast("string"))
    if check:
        for f, levels in ((f1, ZONE_WE_LEVELS), (f2, ZONE_NS_LEVELS)):
            out = require(out, F.col(f).isin(levels),
                          F.concat(F.lit(f"{f} contains an unexpected level: "), F.coalesce(F.col(f), F.lit("NULL"))))
    return out
