"""P5 scoring end to end, P6-P8 checks, sinks and projections."""
import math

import pytest
from pyspark.sql import functions as F

from brasa.functions.lookups import SCORING_INPUT
from brasa.operators import check, geo, model as M
from brasa.plans import queries as Q
from brasa.plans.pipelines import scoring
from brasa.sources import derived as D, files as S

SF = "/root/testdata/sf0.001"


def test_scoring_pipeline_end_to_end(spark):
    post, mapping = Q.post_table(spark, SF)
    models = M.train_zone_models(post, n_trials=1, max_iter=5)
    intervals = M.zone_intervals(post, models, 1)
    cells, meta = Q.fuel_meta(spark, SF)
    incoming = D.fires(spark, SF).select(*SCORING_INPUT[:4]).join(
        D.weather(spark, SF).select("fire_id", "temperature", "relative_humidity",
                                    (F.coalesce("wind_speed_ms", F.lit(0.0)) * 3.6).alias("wind_speed_kmh")), "fire_id")
    incoming = incoming.where(F.col("start_datetime").isNotNull())
    topo = D.topo(spark, SF)
    out = scoring(incoming, models=models, intervals=intervals, mapping=mapping, topo=topo,
                  polygons=D.polygons(spark), fuel_cells=cells, fuel_meta=meta).cache()
    n_in = incoming.count()
    zoned = geo.add_zones(incoming, D.polygons(spark)).count()
    assert out.count() == zoned and zoned <= n_in * 2
    modelled = out.where(F.col("prediction_circular_speed_mm").isNotNull())
    assert modelled.count() > 0
    r = modelled.where(F.col("lo_circular_speed_mm").isNotNull()).first()
    assert abs(r["prediction_major_axis_speed_mm"] - math.sqrt(3) * r["prediction_circular_speed_mm"]) < 1e-9


def test_diff_and_sample(spark):
    a = spark.createDataFrame([(1, 1.0, "x"), (2, 2.0, "y"), (3, 3.0, "z")], "k long, v double, s string")
    b = spark.createDataFrame([(1, 1.0 + 1e-9, "x"), (2, 2.5, "y"), (4, 4.0, "w")], "k long, v double, s string")
    d = {r["k"]: (r["_side"], list(r["_columns"])) for r in check.diff(a, b, ["k"], numeric_cols=["v"]).collect()}
    assert d == {2: ("value", ["v"]), 3: ("missing_expected", []), 4: ("missing_actual", [])}
    check.assert_same(a, a, ["k"])
    s1 = check.sample_rows(a, "k").first()["k"]
    assert s1 == check.sample_rows(a.repartition(3), "k").first()["k"]


def test_sinks(spark, tmp):
    src = f"{tmp}/data.parquet"
    D.fires(spark, SF).select(*SCORING_INPUT[:4]).write.parquet(src)
    S.parquet_to_csv(spark, src, f"{tmp}/csv", SCORING_INPUT[:4])
    assert spark.read.option("header", True).csv(f"{tmp}/csv").count() == 1500
    S.write_table(spark.read.parquet(src), f"{tmp}/out_csv", fmt="csv")
    assert spark.read.option("sep", ";").option("header", True).csv(f"{tmp}/out_csv").count() == 1500


def test_projections(spark):
    df = spark.createDataFrame([(1, -73.0, -37.0)], "id long, longitude double, latitude double")
    x, y = geo.to_web_mercator()
    r = df.select(x.alias("x"), y.alias("y")).first()
    assert abs(r["x"] - (-8126322.8279)) < 1e-3 and abs(r["y"] - (-4439106.7868)) < 1e-3
    e, n = geo.to_utm(18, True)
    r = df.select(e.alias("e"), n.alias("n")).first()
    # lon -73 is 2 degrees east of zone 18's meridian (-75)
    assert 670000 < r["e"] < 680000 and 5890000 < r["n"] < 5910000


def test_rescored_sample_and_missing_run(spark, tmp):
    from brasa.sources import artifacts
    a = spark.range(50).selectExpr("id AS k", "id * 2.0D AS p")
    check.assert_rescored(a, lambda d: d.selectExpr("k", "k * 2.0D AS p"), "k", ["p"], n=10)
    with pytest.raises(AssertionError):
        check.assert_rescored(a, lambda d: d.selectExpr("k", "k * 3.0D AS p"), "k", ["p"], n=50)
    runs = spark.createDataFrame([("e", "r1", "n", "FAILED", "deleted", 1.0, "p")], artifacts.REGISTRY_SCHEMA)
    with pytest.raises(LookupError, match="r1"):
        artifacts.find_run(runs, "e", "other")
    artifacts.save_artifacts(f"{tmp}/run", df=a)
    with pytest.raises(FileExistsError):
        artifacts.save_artifacts(f"{tmp}/run", df=a)


def test_golden_file(spark, tmp):
    from brasa.plans.pipelines import assert_matches_file
    a = spark.createDataFrame([(1, 1.0, None), (2, 2.0, "y")], "k long, v double, s string")
    S.write_table(a, f"{tmp}/golden", "csv")
    same = dict(key=["k"], numeric_cols=["v"])
    assert_matches_file(a.withColumn("k", F.col("k").cast("string")), f"{tmp}/golden", **same)
    with pytest.raises(AssertionError):
        assert_matches_file(a.withColumn("v", F.col("v") + 0.1).withColumn("k", F.col("k").cast("string")), f"{tmp}/golden", **same)
