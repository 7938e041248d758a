"""Sources, sinks, artifacts, registry and the streaming path."""
import json
import os

from pyspark.sql import functions as F

from brasa.operators import features as X
from brasa.sources import artifacts as A, files as S
from brasa.streaming import scoring as ST


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_load_csv_headers_lineage_and_empty_rows(spark, tmp):
    _write(f"{tmp}/in/incendios_2019.csv", " ficha ;Sup  inicial\n123456789;1,5\n;\n")
    _write(f"{tmp}/in/incendios_2020.csv", "FICHA;SUP INICIAL\n223456789;2,0\n")
    df = S.load_csv(spark, f"{tmp}/in")
    assert set(df.columns) == {"FICHA", "SUP_INICIAL", "ARCHIVO", "ROW_SEQ"}
    got = sorted((r["FICHA"], r["ARCHIVO"]) for r in df.collect())
    assert got == [("123456789", "incendios_2019"), ("223456789", "incendios_2020")]


def test_load_csv_header_variants_and_names(spark, tmp):
    """Columns in another order, a further column, and a file name with a blank, a plus and a percent sign."""
    _write(f"{tmp}/in/a 1+x.csv", "FICHA;SUP;CAUSA\n1;10;x\n2;20;y\n")
    _write(f"{tmp}/in/b%2.csv", "FICHA;CAUSA;SUP;OTRA\n3;z;30;o\n")
    got = {r["FICHA"]: r.asDict() for r in S.load_csv(spark, f"{tmp}/in").collect()}
    assert (got["2"]["SUP"], got["2"]["CAUSA"], got["2"]["OTRA"], got["2"]["ARCHIVO"]) == ("20", "y", None, "a_1+x")
    assert (got["3"]["SUP"], got["3"]["CAUSA"], got["3"]["OTRA"], got["3"]["ARCHIVO"]) == ("30", "z", "o", "b%2")
    assert got["1"]["ROW_SEQ"] < got["2"]["ROW_SEQ"]


def test_row_sequence_follows_files_and_lines(spark, tmp):
    """Unequal files, several splits a file, splits of many files in one task: the list's order, then the lines'."""
    _write(f"{tmp}/in/a 1.csv", "FICHA;SUP\n" + "1;0\n")
    _write(f"{tmp}/in/b+2.csv", "FICHA;SUP\n" + "".join(f"{i};0\n" for i in range(2, 3000)))
    _write(f"{tmp}/in/c%3.csv", "FICHA;OTRA\n" + "".join(f"{i};0\n" for i in range(3000, 3100)))
    _write(f"{tmp}/in/d.csv", "FICHA;SUP\n" + "".join(f"{i};0\n" for i in range(3100, 3900)))
    names = ["a 1", "b+2", "c%3", "d"]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("2k", old):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = S.load_csv(spark, f"{tmp}/in").orderBy("ROW_SEQ").collect()
            assert [int(r["FICHA"]) for r in rows] == list(range(1, 3900))
            back = S.load_csv(spark, [f"{tmp}/in/{n}.csv" for n in reversed(names)]).orderBy("ROW_SEQ").collect()
            assert [int(r["FICHA"]) for r in back] == [*range(3100, 3900), *range(3000, 3100), *range(2, 3000), 1]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_missing_csv_raises(spark, tmp):
    import pytest
    with pytest.raises(FileNotFoundError):
        S.load_csv(spark, [f"{tmp}/nope.csv"])


def test_weather_and_scoring_inputs(spark, tmp):
    _write(f"{tmp}/w.csv", "FICHA;TEMPERATURA;HUMEDAD_RELATIVA;VELOCIDAD_VIENTO_MS;VELOCIDAD_VIENTO_KNOTS;DIRVIENTO;OTRA\n"
                           "1;25,5;40;x;10;90;z\n")
    w = S.load_weather(spark, f"{tmp}/w.csv").first()
    assert w["temperature"] == 25.5 and w["wind_speed_ms"] is None and w["wind_speed_knots"] == 10.0
    _write(f"{tmp}/in.json", json.dumps({"fire_id": 7, "longitude": -72.0, "latitude": -37.0,
                                         "start_datetime": "2024-01-05 14:30:00", "temperature": 31.0,
                                         "wind_speed_kmh": 12.0, "relative_humidity": 20.0}))
    s = S.load_scoring_input(spark, f"{tmp}/in.json").first()
    assert s["fire_id"] == 7 and s["start_datetime"].hour == 14


def test_artifacts_and_interval_json_roundtrip(spark, tmp):
    iv = spark.createDataFrame([("Costa", "1", "diurnal", "low", -1.5, 1.0), ("Costa", "1", "nocturnal", "high", -0.5, 2.0)],
                               "zone_WE string, zone_NS string, diurnal_nocturnal string, high_season string, lo double, hi double")
    js = A.intervals_to_json(iv).first()["json"]
    assert "('Costa', '1')" in json.loads(js)
    back = A.intervals_from_json(spark.createDataFrame([(js,)], "json string"))
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in iv.collect())
    df = spark.range(60).withColumn("x", F.col("id") * 2.0)
    paths = A.save_artifacts(f"{tmp}/run1", df=df, intervals=iv, meta={"alpha": 0.1, "ratio": 3.0, "none": None})
    got = A.load_artifacts(spark, f"{tmp}/run1")
    assert got["df"].count() == 60 and got["meta"] == {"alpha": 0.1, "ratio": 3.0}
    assert got["pi"].count() == 2 and "schema" in paths


def test_registry_latest_run(spark, tmp):
    reg = f"{tmp}/registry"
    A.register_run(spark, reg, "exp", "default-run", "/p1", "FINISHED", "a")
    A.register_run(spark, reg, "exp", "default-run", "/p2", "FAILED", "b")
    A.register_run(spark, reg, "exp", "other", "/p3", "FINISHED", "c")
    runs = spark.read.parquet(reg)
    assert A.latest_run(runs, "exp", "default-run").first()["run_id"] == "a"
    assert A.latest_run(runs, "exp", "default-run", status=None).first()["run_id"] == "b"
    assert A.latest_run(runs, "exp").first()["run_id"] == "c"
    assert [r["run_id"] for r in A.recent_runs(runs, "exp", 2).collect()] == ["c", "b"]
    from brasa.operators.diagnostics import numeric_summary
    s = {r["summary"]: r["v"] for r in numeric_summary(
        spark.createDataFrame([(1.0,), (float("inf"),), (3.0,)], "v double"), ["v"]).collect()}
    assert s["count"] == "2" and float(s["mean"]) == 2.0


def test_stream_equals_batch(spark, tmp):
    rows = [{"fire_id": i, "start_datetime": f"2024-0{1 + i % 9}-1{i % 9} {i % 24:02d}:15:00", "zone_alert": "Costa 3"}
            for i in range(40)]
    os.makedirs(f"{tmp}/src")
    for k in range(4):
        _write(f"{tmp}/src/part{k}.json", "\n".join(json.dumps(r) for r in rows[k * 10:(k + 1) * 10]))
    schema = "fire_id long, start_datetime timestamp_ntz, zone_alert string"
    stream = ST.read_incident_stream(spark, f"{tmp}/src", schema, max_files_per_trigger=1)
    feats = ST.stream_features(stream)
    q = feats.writeStream.format("memory").queryName("feat_out").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    batch = ST.stream_features(spark.read.schema(schema).json(f"{tmp}/src"))
    cols = ["fire_id", "hour", "diurnal_nocturnal", "high_season", "zone_WE", "zone_NS"]
    assert sorted(tuple(r) for r in spark.table("feat_out").select(*cols).collect()) == \
        sorted(tuple(r) for r in batch.select(*cols).collect())
    # foreachBatch scorer, idempotent epoch folders
    q2 = ST.start_scoring(ST.read_incident_stream(spark, f"{tmp}/src", schema), lambda d: X.add_hour_cycle(d),
                          f"{tmp}/sink", f"{tmp}/ckpt")
    q2.awaitTermination(120)
    assert spark.read.parquet(f"{tmp}/sink").count() == 40


def test_wkt_polygons_and_raster_reader(spark, tmp):
    from brasa.operators import geo
    df = spark.createDataFrame([("A 1", "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"),
                                ("B 2", "MULTIPOLYGON (((5 5, 6 5, 6 6, 5 5)), ((8 8, 9 8, 9 9, 8 8)))")],
                               "area string, wkt string")
    polys = S.polygons_from_wkt(df)
    rings = {(r["area"], len(r["ring"])) for r in polys.collect()}
    assert rings == {("A 1", 4), ("B 2", 3)} and polys.count() == 3
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 8.8, 8.2)], "id long, longitude double, latitude double")
    assert sorted((r["id"], r["zone_alert"]) for r in geo.add_zones(pts, polys).collect()) == [(1, "A 1"), (2, "B 2")]
    spark.createDataFrame([(0, 0, 3.0)], "row long, col long, value double").write.parquet(f"{tmp}/cells")
    _write(f"{tmp}/meta.json", json.dumps({"x0": 0, "dx": 1, "y0": 1, "dy": -1, "nrows": 1, "ncols": 1, "nodata": -1}))
    cells, meta = S.read_raster(spark, f"{tmp}/cells", f"{tmp}/meta.json")
    assert meta.nrows == 1 and meta.nodata == -1.0 and cells.count() == 1
