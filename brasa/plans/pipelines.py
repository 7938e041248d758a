"""Composed pipelines (P1-P5).  Each is one lazy plan; actions happen only at
validation scalars (outlier threshold), ML fits and sinks.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brasa.functions.lookups import FEATURE_COLUMNS, FUEL_CODE_LABELS, ZONE_FACTORS
from brasa.operators import clean, features as X, geo, match, reduce as R
from brasa.operators.schema import rename_dispatch_columns, rename_fire_columns
from brasa.session import cut_and_count, cut_lineage

DEFAULT_THRESHOLDS = {"dt_minutes": {"lower": 10, "upper": 30}, "initial_radius_m": {"lower": 2, "upper": 100}}


def preprocessing(fires: DataFrame, dispatches: DataFrame, *, dispatch_order: Sequence[str],
                  v1_sources: Sequence[str] = (), v2_sources: Sequence[str] = (),
                  already_standard: bool = False) -> tuple[DataFrame, DataFrame]:
    """P1 on canonical (English) column names: standardise, match, zone, recode,
    normalise surfaces, coerce times, merge and repair clocks.
    Returns ``(fires, dispatches)``."""
    d = dispatches
    if not already_standard:
        d = clean.standard_dispatches(d, clean.DISPATCHES, dispatch_order)
        d = clean.standardize_teams(d, "glosa", "file_source", v1_sources, v2_sources)
    f = clean.filter_id_length(fires, "fire_id", 9)
    f, d = match.match_fires_and_dispatches(f, d, "fire_id")
    f = match.zone_from_dispatch(f, d, "zone", "fire_id", dispatch_order)
    f = clean.filter_target_zones(f)
    f = clean.validate_surface(clean.normalise_surface(f))
    d = clean.coerce_hr_columns(d)
    d = match.merge_dispatch_fire(f, d)
    d, _ = match.detect_and_fix_time_anomalies(f, d)
    return f, d


def preprocessing_raw(fires: DataFrame, dispatches: DataFrame, *, v1_sources: Sequence[str],
                      v2_sources: Sequence[str], dispatch_order: Sequence[str] = ("ROW_SEQ",)
                      ) -> tuple[DataFrame, DataFrame]:
    """P1 from the raw report tables (normalised upper-case headers, ``ARCHIVO`` lineage):
    parse start time, standardise ids, filter/dedup dispatches, rewrite team codes,
    rename to canonical names, then the canonical P1 core.

    ``dispatch_order``: the columns giving the reports' row order for keep-first
    (the scan sequence ``ROW_SEQ`` added by ``load_csv``).

    The loaded report tables are materialised first (parquet in the shared
    checkpoint folder): CSV parsing happens once, and the all-empty-row filter
    — one predicate over every column — stays below the cut, so the 26
    renames that follow do not multiply the optimizer's inferred constraints.
    """
    fires, dispatches = cut_lineage(fires), cut_lineage(dispatches)
    f = clean.add_date_time_columns(fires, "INICIO")
    f = clean.standardize_fire_ids(f)
    d = clean.standard_dispatches(dispatches, clean.RAW_DISPATCHES, dispatch_order)
    d = clean.standardize_teams(d, "GLOSA", "ARCHIVO", v1_sources, v2_sources)
    d = (d.withColumn("ID_DESPACHO", F.col("ID_DESPACHO").try_cast("bigint"))
          .withColumn("ID_FOCO_INCENDIO", F.col("ID_FOCO_INCENDIO").try_cast("bigint")))
    f = f.withColumn("ID_FOCO_INCENDIO", F.col("ID_FOCO_INCENDIO").try_cast("bigint"))
    f = rename_fire_columns(f)
    d = rename_dispatch_columns(d)
    for c in ("arrival_datetime_inc", "control_datetime", "extinction_datetime"):
        f = f.withColumn(c, clean.parse_datetime(c))
    order = [c.lower() for c in dispatch_order]
    return preprocessing(f, d, dispatch_order=order, already_standard=True)


def feature_engineering(df: DataFrame, *, topo: DataFrame | None, weather: DataFrame | None = None,
                        polygons: DataFrame | None = None, zone_threshold: int = 5,
                        fuel_cells: DataFrame | None = None, fuel_meta=None, skip_target: bool = False,
                        include: Sequence[str] = FEATURE_COLUMNS, checkpoint: bool = True) -> DataFrame:
    """Zones -> split zones -> hour -> topography -> day/season -> fuel -> weather -> target.

    With a target, the table is cut (reliable checkpoint) right before the
    outlier trim, so the trim's quantile scans materialised rows instead of
    replaying the joins, and the stage is planned once.
    """
    out = df
    if polygons is not None:   # zones come from the layer (any previous zone columns are replaced)
        out = geo.add_zones(out.drop("zone_alert", "zone_WE", "zone_NS"), polygons, zone_threshold=zone_threshold)
    out = geo.split_zone(out)
    out = X.add_hour_cycle(out)
    if topo is not None:
        out = X.merge_topo(out, topo)
    out = X.add_diurnal_nocturnal(out)
    out = X.add_high_season(out)
    if fuel_cells is not None:
        out = geo.sample_raster(out.drop("initial_fuel"), fuel_cells, fuel_meta, out_col="_fuel_code")
        out = out.withColumn("initial_fuel", X.fuel_code_label("_fuel_code")).drop("_fuel_code")
    else:
        out = X.map_local_fuel(out)
    if weather is not None:
        out = X.merge_weather(out, weather)
        out = X.add_weather_features(out)
    if not skip_target:
        out = X.add_surface_radius(X.add_elapsed_minutes(out))
        wanted = {*include}
        if wanted & {*out.columns}:   # columns that the result leaves out are neither joined nor written
            wanted |= {"initial_surface_m2", "initial_radius_m", "dt_minutes"}
            out = out.select(*[c for c in out.columns if c in wanted])
        if checkpoint:
            out = cut_lineage(out)
        out = X.trim_upper_outliers(out, "initial_surface_m2", 0.99)
        out = X.add_propagation_speed(out)
    return X.select_columns(out, include=include)


def postprocessing(df: DataFrame, thresholds=None, *, zone_col: str = "zone_alert",
                   min_observations: int = 5, min_fuel_samples: float = 15,
                   categories: Sequence[str] | None = tuple(FUEL_CODE_LABELS.values())
                   ) -> tuple[DataFrame, DataFrame]:
    """Range filter -> zone factors -> small zones -> missing rows -> rare fuels -> split;
    returns ``(table, fuel_mapping)``."""
    out = clean.filter_by_range(df, thresholds or DEFAULT_THRESHOLDS)
    out = clean.zone_factors(out)
    if out.isEmpty():
        raise ValueError("no rows remain after the zone factor filter")
    out = R.filter_low_observation_zones(out, min_observations, zone_col)
    out = clean.drop_missing(out)
    out = R.add_fuel_reduced(out, min_fuel_samples=min_fuel_samples)
    out = R.add_train_test_split(out, zone_col=zone_col)
    mapping = R.learn_groupwise_mapping(out, categories=categories)
    return out, mapping


def scoring(df: DataFrame, *, models: dict, intervals: DataFrame, mapping: DataFrame, topo: DataFrame,
            polygons: DataFrame | None, fuel_cells: DataFrame, fuel_meta, ratio: float = 3.0,
            pi_covariates: Sequence[str] = ("diurnal_nocturnal", "high_season")) -> DataFrame:
    """P5: features (raster fuel, no weather/target) -> fuel mapping -> predictions ->
    intervals -> elliptical speeds.  Stateless per row after the lookups, so it
    also runs on a stream (``brasa.streaming``)."""
    from brasa.operators import model as M
    include = list(df.columns) + ["zone_WE", "zone_NS", "zone_alert", "hour", "sin_hour", "cos_hour",
                                  "slope_degrees", "initial_fuel", "diurnal_nocturnal", "high_season"]
    out = feature_engineering(df, topo=topo, polygons=polygons, zone_threshold=0, fuel_cells=fuel_cells,
                              fuel_meta=fuel_meta, skip_target=True, include=include)
    out = R.apply_groupwise_mapping(out, mapping)
    if models and not out.isStreaming:   # written by zone, so that each model reads its own rows
        out = cut_lineage(out, partition_by=ZONE_FACTORS)
    out = M.add_zone_predictions(out, models, ZONE_FACTORS, {"prediction_circular_speed_mm": 1})
    out = M.add_prediction_interval(out, intervals, ZONE_FACTORS, pi_covariates,
                                    "lo_circular_speed_mm", "hi_circular_speed_mm")
    return X.add_elliptical_speed(out, ratio=ratio)



def training_run(fires: DataFrame, dispatches: DataFrame, *, topo: DataFrame, weather: DataFrame | None,
                 polygons: DataFrame | None, run_dir: str, dispatch_order: Sequence[str],
                 v1_sources: Sequence[str] = (), v2_sources: Sequence[str] = (), alpha: float = 0.1,
                 ratio: float = 3.0, n_trials: int = 50, max_iter: int = 200) -> dict:
    """P1 -> P2 -> P3 -> per-zone models -> elliptical speeds -> base model ->
    long form -> diagnostics -> artifacts + metrics.  Returns the artifact paths
    and the metrics (parameters, row counts, six headline MAEs, seconds)."""
    from brasa.functions.lookups import COVARIATES, COVARIATE_META
    from brasa.operators import diagnostics as DG, model as M
    from brasa.sources.artifacts import save_artifacts
    started = time.time()
    f, _ = preprocessing(fires, dispatches, dispatch_order=dispatch_order, v1_sources=v1_sources,
                         v2_sources=v2_sources)
    counts = {}
    f, counts["df_rows_after_preprocessing"] = cut_and_count(f)
    feats, counts["df_rows_after_features"] = cut_and_count(
        feature_engineering(f, topo=topo, weather=weather, polygons=polygons))
    post, counts["df_rows_after_postprocessing"] = cut_and_count(postprocessing(feats)[0])
    post = cut_lineage(post, partition_by=ZONE_FACTORS)
    mapping = R.learn_groupwise_mapping(post)
    log: dict = {}
    models = M.train_zone_models(post, n_trials=n_trials, max_iter=max_iter, log=log)
    out = M.add_zone_predictions(post, models, ZONE_FACTORS, {"prediction_xgb0": 0, "prediction_circular_speed_mm": 1})
    out = M.add_prediction_interval(out, M.zone_intervals(post, models, 0, alpha=alpha), lo_col="lo_xgb0", hi_col="hi_xgb0")
    iv = M.zone_intervals(post, models, 1, alpha=alpha)
    out = M.add_prediction_interval(out, iv, lo_col="lo_circular_speed_mm", hi_col="hi_circular_speed_mm")
    out = X.add_elliptical_speed(out, ratio=ratio)
    out = cut_lineage(M.add_base_model_predictions(out, alpha=alpha))
    diag = DG.residual_diagnostics(DG.to_long(out), ["model", "split2"], "propagation_speed_mm", "prediction")
    maes = {f"MAE_{r['model']}_{'train' if r['split2'] == 'train+valid' else 'test'}": r["MAE"]
            for r in diag.collect()}                      # one row per (model, split): 6 rows
    params = {"alpha": alpha, "ratio": ratio, "n_trials": n_trials, "max_iter": max_iter}
    meta = dict(COVARIATE_META, **params)
    values = {**params, **counts, **maes, "total_runtime_seconds": time.time() - started}
    metrics = out.sparkSession.createDataFrame([(k, float(v)) for k, v in values.items() if v is not None],
                                               "key string, value double")
    paths = save_artifacts(run_dir, df=out, models=models, intervals=iv, mapping=mapping, covariates=COVARIATES,
                           meta=meta, metrics=metrics, outputs={"diagnostics.parquet": diag,
                                    "trials.parquet": M.trial_table(out.sparkSession, log)})
    return {"paths": paths, "metrics": values}


def diff_with_file(actual: DataFrame, path: str, key: Sequence[str], schema=None, sep: str = ";",
                   numeric_cols: Sequence[str] = (), exclude: Sequence[str] = (), tol: float = 1e-6) -> DataFrame:
    """The rows that differ from a golden CSV, read under a stored schema."""
    from brasa.operators.check import diff
    expected = actual.sparkSession.read.option("sep", sep).option("header", True).csv(path)
    if schema is not None:
        expected = schema.apply(expected)
    return diff(actual, expected, key, numeric_cols=numeric_cols, exclude=exclude, tol=tol)


def assert_matches_file(actual: DataFrame, path: str, key: Sequence[str], schema=None, **kw) -> None:
    """Fails on the first differences from a golden CSV."""
    bad = diff_with_file(actual, path, key, schema, **kw).limit(10).collect()
    if bad:
        raise AssertionError(f"table differs from {path}, e.g. {bad}")
