"""Hand-written edge rows (null / NaN, bin edges, half rounding, dt = 0, thresholds)."""
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from brasa.functions.columns import cut, parse_decimal_text
from brasa.operators import clean, features as X, geo, match, reduce as R

T = dt.datetime


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy(cols[0]).collect()]


def test_time_rules_edges(spark):
    hours = [2, 3, 11, 12, 17, 18]
    data = [(i, T(2020, 6, 1, h, 0)) for i, h in enumerate(hours)] + [(99, None)]
    df = spark.createDataFrame(data, "id long, ts timestamp_ntz")
    out = X.add_diurnal_nocturnal(X.add_period_of_day(df, "ts"), "ts")
    got = {r["id"]: (r["period_day"], r["diurnal_nocturnal"]) for r in out.collect()}
    assert [got[i][0] for i in range(6)] == ["night", "morning", "morning", "afternoon", "afternoon", "night"]
    assert [got[i][1] for i in range(6)] == ["nocturnal", "diurnal", "diurnal", "diurnal", "diurnal", "nocturnal"]
    assert got[99] == ("night", "nocturnal")


def test_high_season_edges(spark):
    days = [T(2020, 12, 14), T(2020, 12, 15), T(2021, 3, 15), T(2021, 3, 16), T(2021, 1, 31)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)] + [(9, None)], "id long, ts timestamp_ntz")
    got = dict(rows(X.add_high_season(df, "ts"), "id", "high_season"))
    assert [got[i] for i in range(5)] == ["low", "high", "high", "low", "high"]
    assert got[9] == "low"


def test_cut_edges_and_nan(spark):
    vals = [0.0, 9.999, 10.0, 30.0, -1.0, float("nan"), None, float("inf")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    got = dict(rows(df.select("id", cut("v", [0, 10, 30, math.inf], ["0-10", "10-30", "30+"]).alias("c")), "id", "c"))
    assert [got[i] for i in range(8)] == ["0-10", "0-10", "10-30", "30+", None, None, None, None]


def test_speed_dt_zero_and_category(spark):
    df = spark.createDataFrame([(1, 5.0, 0.0), (2, 0.0, 0.0), (3, 17.0, 10.0), (4, 830.0, 10.0), (5, None, 1.0)],
                               "id long, r double, dt double")
    out = X.add_speed_category(X.add_propagation_speed(df, "r", "dt"))
    got = {r["id"]: (r["propagation_speed_mm"], r["speed_category"]) for r in out.collect()}
    assert got[1][0] == float("inf") and got[1][1] is None
    assert got[2] == (None, None)
    assert got[3] == (1.7, "media")
    assert got[4] == (83.0, "extrema")
    assert got[5] == (None, None)


def test_clock_half_even_and_order_error(spark):
    base = T(2020, 1, 1, 10, 0)
    fires = spark.createDataFrame([
        (1, base, base + dt.timedelta(minutes=59, seconds=30)),   # 59.5 -> 60 (half even) flagged
        (2, base, base + dt.timedelta(minutes=60, seconds=30)),   # 60.5 -> 60 flagged
        (3, base, base + dt.timedelta(minutes=61, seconds=30)),   # 61.5 -> 62 not flagged
        (4, base + dt.timedelta(hours=2), base + dt.timedelta(minutes=30)),  # order error
    ], "fire_id long, start_datetime timestamp_ntz, arrival_datetime_inc timestamp_ntz")
    disp = spark.createDataFrame([(i, base) for i in (1, 2, 3)] + [(4, base + dt.timedelta(minutes=30))],
                                 "fire_id long, hr_arribo timestamp_ntz")
    fixed, rep = match.detect_and_fix_time_anomalies(fires, disp)
    r = {x["fire_id"]: x for x in rep.collect()}
    assert r[1]["dst_flag_before"] and r[2]["dst_flag_before"] and not r[3]["dst_flag_before"]
    assert r[1]["dst_fixed"] and r[2]["dst_fixed"]
    assert r[4]["order_error"]
    f = {x["fire_id"]: x["hr_arribo"] for x in fixed.collect()}
    assert f[1] == base + dt.timedelta(minutes=60) and f[3] == base


def test_keep_first_and_standard_id(spark):
    df = spark.createDataFrame([(123456789, 1, 3, "b"), (123456789, 1, 1, "a"), (123456789, 2, 5, "c"),
                                (12345, 1, 0, "short")], "fid long, did long, seq long, v string")
    df = df.withColumn("std", clean.standard_dispatch_id("fid", "did"))
    out = clean.keep_first(clean.filter_id_length(df, "fid"), "std", ["seq"])
    assert sorted((r["std"], r["v"]) for r in out.collect()) == [(1234567891, "a"), (1234567892, "c")]


def test_surface_text_and_violations(spark):
    df = spark.createDataFrame([(1, "1.234,5", "2.000,0 m2"), (2, "-3,0", "1,0"), (3, "x", "5,0"), (4, "5,0", "4,0")],
                               "id long, initial_surface_ha string, final_surface_ha string")
    n = clean.normalise_surface(df)
    got = dict(rows(n, "id", "initial_surface_ha"))
    assert got[1] == 1234.5 and got[2] == -3.0 and got[3] is None
    v = dict(rows(clean.surface_violations(n), "id", "violation"))
    assert v == {2: "negative_initial", 4: "final_below_initial"}
    with pytest.raises(Exception):
        clean.validate_surface(n).collect()
    assert parse_decimal_text  # exported


def test_zone_threshold_strict(spark):
    df = spark.createDataFrame([(i, "A") for i in range(5)] + [(10 + i, "B") for i in range(6)], "id long, z string")
    out = R.filter_low_observation_zones(df, 5, "z")
    assert {r["z"] for r in out.collect()} == {"B"}


def test_fuel_reduction_threshold_and_fraction(spark):
    data = [(i, "Costa", "1", "F1") for i in range(15)] + [(100 + i, "Costa", "1", "F2") for i in range(14)] + \
           [(200, "Costa", "1", None)]
    df = spark.createDataFrame(data, "id long, zone_WE string, zone_NS string, initial_fuel string")
    out = dict(rows(R.add_fuel_reduced(df), "id", "initial_fuel_reduced"))
    assert out[0] == "F1" and out[100] == "other" and out[200] is None
    # fraction: ceil(0.5 * 30) = 15 -> F2 (14) rare, F1 (15) kept
    out = dict(rows(R.add_fuel_reduced(df, min_fuel_samples=0.5), "id", "initial_fuel_reduced"))
    assert out[0] == "F1" and out[100] == "other"


def test_polygons_overlap_and_edge(spark):
    sq = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    sq2 = [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0)]
    polys = spark.createDataFrame([("A 1", [dict(x=x, y=y) for x, y in sq]), ("B 2", [dict(x=x, y=y) for x, y in sq2])],
                                  "area string, ring array<struct<x:double,y:double>>")
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 2.0, 1.5), (4, 5.0, 5.0), (5, 0.0, 1.0)],
                                "id long, longitude double, latitude double")
    out = geo.add_zones(pts, polys)
    got = sorted((r["id"], r["zone_alert"]) for r in out.collect())
    # 2 is in both; 3 lies on A's edge (inside B); 4 outside; 5 on A's edge
    assert got == [(1, "A 1"), (2, "A 1"), (2, "B 2"), (3, "B 2")]


def test_raster_nodata_and_bounds(spark):
    cells = spark.createDataFrame([(0, 0, 1.0), (0, 1, -9999.0), (1, 0, 999.0), (1, 1, float("nan"))],
                                  "row long, col long, value double")
    meta = geo.RasterMeta(0.0, 1.0, 2.0, -1.0, 2, 2, -9999.0)
    pts = spark.createDataFrame([(1, 0.5, 1.5), (2, 1.5, 1.5), (3, 0.5, 0.5), (4, 1.5, 0.5), (5, 3.0, 1.0), (6, 2.0, 0.0)],
                                "id long, longitude double, latitude double")
    out = geo.sample_raster(pts, cells, meta)
    got = {r["id"]: r["fuel"] for r in out.collect()}
    assert got == {1: 1.0, 2: None, 3: 999.0, 4: None, 5: None, 6: None}
    lab = {r["id"]: r["l"] for r in out.select("id", X.fuel_code_label("fuel").alias("l")).collect()}
    assert lab[1] == "Pastizales Mesomorficos Densos" and lab[3] == "No combustible" and lab[2] == "Unknown"


def test_mapping_unseen_key_and_zone_without_interval(spark):
    df = spark.createDataFrame([("Costa", "1", "a", "a"), ("Costa", "1", "b", "other")],
                               "zone_WE string, zone_NS string, initial_fuel string, initial_fuel_reduced string")
    m = R.learn_groupwise_mapping(df, categories=["a", "b", "c"])
    assert sorted((r["initial_fuel"], r["initial_fuel_reduced"]) for r in m.collect()) == \
        [("a", "a"), ("b", "other"), ("c", "other")]
    new = spark.createDataFrame([("Costa", "1", "c"), ("Costa", "1", "zzz"), ("Valle", "2", "a")],
                                "zone_WE string, zone_NS string, initial_fuel string")
    got = sorted(tuple(r) for r in R.apply_groupwise_mapping(new, m).select("zone_WE", "initial_fuel", "initial_fuel_reduced").collect())
    assert got == [("Costa", "c", "other"), ("Costa", "zzz", "Unknown"), ("Valle", "a", "Unknown")]
    conflict = spark.createDataFrame([("Costa", "1", "a", "x"), ("Costa", "1", "a", "y")],
                                     "zone_WE string, zone_NS string, initial_fuel string, initial_fuel_reduced string")
    with pytest.raises(Exception):
        R.learn_groupwise_mapping(conflict, categories=["a"]).collect()


def test_elliptical_null_safe_minimum(spark):
    df = spark.createDataFrame([(1, 3.0, -1.0, 2.0), (2, 3.0, None, 2.0)], "id long, c double, lo double, hi double")
    out = {r["id"]: r for r in X.add_elliptical_speed(df, "c", "lo", "hi", ratio=3.0).collect()}
    assert abs(out[1]["lo_major_axis_speed_mm"] + math.sqrt(3)) < 1e-12
    assert out[2]["lo_major_axis_speed_mm"] is None and out[2]["lo_minor_axis_speed_mm"] is None


def test_split_sizes_and_disjoint(spark):
    df = spark.range(0, 103).select(F.col("id").alias("fire_id"), (F.col("id") % 2).cast("string").alias("zone_alert"))
    out = R.add_train_test_split(df).toPandas()
    for z, sub in out.groupby("zone_alert"):
        n = len(sub)
        n_test = math.ceil(0.2 * n)
        n_val = math.ceil(0.25 * (n - n_test))
        assert (sub.split3 == "test").sum() == n_test and (sub.split3 == "valid").sum() == n_val
    assert set(out.split2) == {"test", "train+valid"}
    again = R.add_train_test_split(df.repartition(7)).toPandas().set_index("fire_id").split3
    assert (out.set_index("fire_id").split3 == again.loc[out.fire_id].values).all()


def test_weather_clamp_and_indices(spark):
    df = spark.createDataFrame([(1, 31.0, 20.0, 400.0, None, 70.0), (2, -1.0, 101.0, 10.0, 5.0, None)],
                               "fire_id long, temperature double, relative_humidity double, wind_direction double, "
                               "wind_speed_ms double, wind_speed_knots double")
    out = {r["fire_id"]: r for r in X.add_weather_features(df).collect()}
    assert out[1]["wind_direction"] is None and abs(out[1]["wind_speed_kmh"] - 0.51445 * 70 * 3.6) < 1e-9
    assert out[1]["weather_index_full"] == "FHD"
    assert out[2]["relative_humidity"] is None and out[2]["temperature_cat"] == "N" and out[2]["weather_index"] == "NA"


def test_idempotent_merges_and_stable_keep_first(spark):
    from brasa.sources import derived as D
    sf = "/root/testdata/sf0.001"
    f = D.fires(spark, sf).select("fire_id", "zone_alert")
    once = X.merge_weather(X.merge_topo(f, D.topo(spark, sf)), D.weather(spark, sf))
    twice = X.merge_weather(X.merge_topo(once, D.topo(spark, sf)), D.weather(spark, sf))
    assert sorted(once.columns) == sorted(twice.columns)
    assert once.exceptAll(twice.select(*once.columns)).count() == 0 and once.count() == twice.count() == f.count()
    d = D.dispatches(spark, sf).withColumn("k", clean.standard_dispatch_id("fire_id", "dispatch_id"))
    order = ["seq_ship", "seq_part", "seq_supp", "seq_qty"]
    a = clean.keep_first(d, "k", order)
    b = clean.keep_first(d.repartition(7, "seq_part"), "k", order)
    assert a.count() == d.select("k").distinct().count()
    assert a.exceptAll(b.select(*a.columns)).count() == 0


def test_rows_without_a_key_are_not_duplicates(spark):
    from brasa.operators import clean
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (None, 3, "a"), (None, 4, "a")], "k int, seq int, f string")
    assert sorted(r.seq for r in clean.keep_first(df, "k", ["seq"]).collect()) == [1, 3, 4]


def test_dispatch_ids_are_deduplicated_within_a_file(spark):
    from brasa.operators import clean
    rows = [("FOCO", 123456789, 5, "ZONA ARAUCO", "a", 1), ("FOCO", 123456789, 5, "ZONA ARAUCO", "a", 2), ("FOCO", 123456789, 5, "ZONA ARAUCO", "b", 3)]
    df = spark.createDataFrame(rows, "TIPO_FICHA string, ID_FOCO_INCENDIO long, ID_DESPACHO long, ZONA string, ARCHIVO string, seq int")
    out = clean.standard_dispatches(df, clean.RAW_DISPATCHES, ["seq"]).collect()
    assert sorted((r.ARCHIVO, r.seq) for r in out) == [("a", 1), ("b", 3)]


def test_split_and_scores_keep_rows_without_a_zone(spark):
    from brasa.operators import model, reduce
    df = spark.createDataFrame([(i, "Costa" if i % 2 else None, "1", "Pino") for i in range(10)],
                               "fire_id long, zone_WE string, zone_NS string, initial_fuel string")
    assert model.add_zone_predictions(df, {}).count() == 10
    out = reduce.learn_groupwise_mapping(df.withColumn("initial_fuel_reduced", df.initial_fuel), categories=None)
    assert {r.initial_fuel for r in out.collect()} == {"Pino"}


def test_checkpoint_folder_must_be_named_on_a_cluster():
    import pytest
    from brasa.session import checkpoint_dir

    class Context:
        master = "yarn"
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        class conf:
            @staticmethod
            def get(k, d=None):
                return d
    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_checks_fire_when_only_the_key_is_read(spark):
    from brasa.operators import model as M
    bad = spark.createDataFrame([(1, "Sierra", "9", "unheard of", -1.0, 2.0)],
                                "fire_id long, zone_WE string, zone_NS string, initial_fuel string, "
                                "initial_surface_ha double, final_surface_ha double")
    iv = spark.createDataFrame([("Costa", "1", 0.0, 1.0)], "zone_WE string, zone_NS string, lo double, hi double")
    for checked in (clean.validate_surface(bad), clean.zone_factors(bad), X.map_local_fuel(bad),
                    M.add_prediction_interval(bad, iv, pi_covariates=[], strict=True)):
        with pytest.raises(Exception):
            checked.select("fire_id").collect()


def test_points_in_a_hole_are_outside(spark):
    from brasa.sources.files import polygons_from_wkt
    layer = polygons_from_wkt(spark.createDataFrame([
        ("a", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0), (4 4, 6 4, 6 6, 4 6, 4 4))"),
        ("b", "MULTIPOLYGON (((20 0, 30 0, 30 10, 20 0)), ((40 0, 50 0, 50 10, 40 10, 40 0), (44 4, 46 4, 46 6, 44 4)))")],
        "area string, wkt string"))
    pts = spark.createDataFrame([(1, 2.0, 2.0), (2, 5.0, 5.0), (3, 29.0, 2.0), (4, 45.5, 4.5), (5, 41.0, 5.0), (6, 60.0, 1.0)],
                                "fire_id long, longitude double, latitude double")
    assert rows(geo.add_zones(pts, layer), "fire_id", "zone_alert") == [(1, "a"), (3, "b"), (5, "b")]


def test_terrain_across_tile_borders(spark, monkeypatch):
    grid = spark.range(400).selectExpr("id div 20 AS row", "id % 20 AS col", "CAST(id * id % 97 AS DOUBLE) AS value")
    whole = {r[:2]: r for r in geo.terrain_attributes(grid, 10.0, 10.0).collect()}
    monkeypatch.setattr(geo, "TILE", 3)
    tiled = {r[:2]: r for r in geo.terrain_attributes(grid, 10.0, 10.0).collect()}
    assert len(tiled) == 400 and tiled == whole
    assert sum(r["slope_degrees"] is None for r in tiled.values()) == 76


def test_projection_pairs(spark):
    df = spark.createDataFrame([(-72.0, -37.0)], "longitude double, latitude double")
    x, y = geo.project("longitude", "latitude", "EPSG:4326", "EPSG:32718")
    east, north = df.select(x, y).first()
    assert 766000 < east < 768000 and 5900000 < north < 5902000
    with pytest.raises(ValueError):
        geo.project("longitude", "latitude", "EPSG:4326", "EPSG:9999")
