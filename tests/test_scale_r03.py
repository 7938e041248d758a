"""Round 3: what is computed, written and broadcast by the larger queries."""

from pyspark.sql import functions as F

from brasa.functions.lookups import COVARIATES, COVARIATES_CATEGORICAL
from brasa.operators import diagnostics as DG, model as M, stats
from brasa.plans import pipelines, queries as Q


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def values(spark):
    return spark.range(4000, numPartitions=4).selectExpr(
        "concat('zone', id % 3) AS zone", "IF(id % 5 = 0, NULL, concat('cell', id % 2)) AS cell", "id * 7 % 4000 * 0.5D AS v")


def test_values_of_a_quantile_are_never_broadcast(spark, monkeypatch):
    seen, cut = [], stats.cut_lineage
    monkeypatch.setattr(stats, "cut_lineage", lambda df, **kw: (seen.append(plan(df)), cut(df, **kw))[1])
    q = stats.exact_quantiles(values(spark), ["zone", "cell"], "v", [0.1, 0.9], ["lo", "hi"])
    plans = seen + [plan(q)]
    assert any("BroadcastHashJoin" in p for p in plans)      # the table of groups is
    assert not any("BuildLeft" in p for p in plans)
    got = {(r.zone, r.cell): (r.lo, r.hi, r.n) for r in q.collect()}
    want = values(spark).groupBy("zone", "cell").agg(F.percentile("v", 0.1).alias("lo"), F.percentile("v", 0.9).alias("hi"),
                                                     F.count("v").alias("n")).collect()
    assert len(got) == len(want) == 9
    for r in want:
        lo, hi, n = got[r.zone, r.cell]
        assert abs(lo - r.lo) < 1e-9 and abs(hi - r.hi) < 1e-9 and n == r.n


def test_rows_of_the_diagnostics_are_never_broadcast(spark, tmp_path):
    path = f"{tmp_path}/rows"
    values(spark).selectExpr("zone", "v AS y", "v + 1 AS p").write.parquet(path)
    out = DG.residual_diagnostics(spark.read.parquet(path), ["zone"], "y", "p")
    assert "BuildLeft" not in plan(out)
    assert [(r.n, r.n_scored, r.MAE) for r in out.orderBy("zone").collect()] == [(1334, 1334, 1.0), (1333, 1333, 1.0), (1333, 1333, 1.0)]


def based(spark):
    return values(spark).select(
        F.expr("CAST(v * 2 AS BIGINT)").alias("fire_id"), F.lit("Costa").alias("zone_WE"), F.lit("1").alias("zone_NS"),
        F.lit("Costa 1").alias("zone_alert"), F.lit("d").alias("diurnal_nocturnal"), F.lit("h").alias("high_season"),
        F.when(F.col("v") < 500, "test").otherwise("train+valid").alias("split2"),
        F.when(F.col("v") < 500, "test").when(F.col("v") < 900, "valid").otherwise("train").alias("split3"),
        F.col("v").alias("propagation_speed_mm"), F.lit(700.0).alias("prediction_base"),
        F.lit(-1.0).alias("lo_base"), F.lit(1.0).alias("hi_base"))


def test_interval_lookup_builds_its_table_once(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(Q, "based_table", lambda s, d: (calls.append(d), based(s))[1])
    out = Q.q_interval_lookup(spark, "none")
    assert calls == ["none"]
    assert out.count() == 4000 and out.select("pi_lo", "pi_hi").distinct().count() == 1


def test_stored_metrics_sends_the_preview_to_the_table(spark, monkeypatch):
    monkeypatch.setattr(Q, "based_table", lambda s, d: based(s))
    out = Q.q_stored_metrics(spark, "none")
    assert "rightHint=(strategy=broadcast)" in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r.key: r.value for r in out.collect()}
    assert got["rows"] == 4000 and got["preview_rows"] == got["preview_rows_of_the_table"] == 50


def test_apply_mapping_builds_the_features_once_and_does_not_shuffle_them(spark, monkeypatch):
    calls = []
    rows = values(spark).select(F.expr("CAST(v * 2 AS BIGINT)").alias("fire_id"), F.lit("Costa").alias("zone_WE"),
                                F.lit("1").alias("zone_NS"), F.col("cell").alias("initial_fuel"))
    monkeypatch.setattr(Q, "features_table", lambda s, d: (calls.append(d), rows)[1])
    monkeypatch.setattr(Q, "postprocessing", lambda f: (f.withColumn("initial_fuel_reduced", F.col("initial_fuel")), None))
    out = Q.q_apply_mapping(spark, "none")
    assert calls == ["none"]
    assert "SortMergeJoin" not in plan(out) and "BuildLeft" not in plan(out)
    assert out.groupBy("initial_fuel_reduced").count().where("initial_fuel_reduced = 'Unknown'").first()["count"] == 800


def test_feature_table_writes_only_columns_it_needs(spark, monkeypatch):
    seen, cut = [], pipelines.cut_lineage
    monkeypatch.setattr(pipelines, "cut_lineage", lambda df, **kw: (seen.append(df.columns), cut(df, **kw))[1])
    fires = spark.range(300).selectExpr(
        "id AS fire_id", "'Costa 1' AS zone_alert", "timestamp_ntz'2020-01-01 10:00:00' AS start_datetime",
        "timestamp_ntz'2020-01-01 10:20:00' AS arrival_datetime_inc", "id / 100 AS initial_surface_ha",
        "'Pastizal' AS initial_fuel", "repeat('x', 50) AS start_text", "1.0D AS latitude", "2.0D AS longitude")
    topo = spark.range(300).selectExpr("id AS fire_id", "1.0D AS elevation", "2.0D AS slope_degrees", "3.0D AS aspect_degrees")
    out = pipelines.feature_engineering(fires, topo=topo)
    assert "initial_surface_m2" in seen[0] and not {"start_text", "elevation", "dt_minutes_cat", "arrival_datetime_inc"} & {*seen[0]}
    assert out.count() == 297 and out.columns == [c for c in out.columns if c in pipelines.FEATURE_COLUMNS]
    every = pipelines.feature_engineering(fires, topo=topo, include=())
    assert {"start_text", "elevation", "propagation_speed_kmh"} <= {*every.columns}


def test_fits_of_a_small_zone_take_one_task(spark, monkeypatch):
    rows = spark.range(400, numPartitions=4).select(
        F.lit("Costa").alias("zone_WE"), F.lit("1").alias("zone_NS"), (F.col("id") % 7 * 1.0).alias("propagation_speed_mm"),
        F.when(F.col("id") % 5 == 0, "test").otherwise("train+valid").alias("split2"),
        F.when(F.col("id") % 5 == 0, "test").when(F.col("id") % 5 == 1, "valid").otherwise("train").alias("split3"),
        *[(F.concat(F.lit(c), F.col("id") % 2) if c in COVARIATES_CATEGORICAL else (F.col("id") % 11 * 1.0)).alias(c)
          for c in COVARIATES])
    seen, cut = [], M.cut_lineage
    monkeypatch.setattr(M, "cut_lineage", lambda df, **kw: (seen.append(df), cut(df, **kw))[1])
    for per_task, tasks in ((50_000, 1), (150, 3)):        # more rows, more tasks
        monkeypatch.setattr(M, "ROWS_PER_TASK", per_task, raising=False)
        seen.clear()
        models = M.train_zone_models(rows, n_trials=1, max_iter=1)
        vectors, = [df for df in seen if "_features" in df.columns]
        assert vectors.rdd.getNumPartitions() == tasks and vectors.count() == 400
        assert M.add_zone_predictions(rows, models).where("prediction is not null").count() == 400
