"""Schema operators, header rules, team codes, month cycle."""
import math

import pytest
from pyspark.sql import functions as F

from brasa.functions.text import normalise_header, team_code_v1, team_code_v2
from brasa.operators import features as X, match
from brasa.operators.schema import (DtypeSchema, check_dataset_compatibility, key_overlap, normalise_headers,
                                    set_categories)


def test_headers(spark):
    assert normalise_header("  sup   inicial ") == "SUP_INICIAL"
    df = spark.createDataFrame([(1, 2)], "`a b` long, `A_B` long")
    with pytest.raises(ValueError):
        normalise_headers(df)


def test_dtype_schema_roundtrip(spark):
    df = spark.createDataFrame([("low", "3"), ("high", "x"), ("mid", "5")], "hs string, n string")
    df = set_categories(df, "hs", ["low", "high"], ordered=True)
    assert [r["hs"] for r in df.collect()] == ["low", "high", None]
    sch = DtypeSchema.from_json(DtypeSchema.from_df(df).to_json())
    assert sch.entries["hs"] == {"type": "category", "categories": ["low", "high"], "ordered": True}
    typed = DtypeSchema({"n": {"type": "other", "dtype": "bigint"}, "hs": sch.entries["hs"]}).apply(
        spark.createDataFrame([("3", "high", 1), ("x", "zzz", 2)], "n string, hs string, extra long"))
    assert typed.columns == ["n", "hs", "extra"]
    assert [tuple(r) for r in typed.collect()] == [(3, "high", 1), (None, None, 2)]
    with pytest.raises(KeyError):
        DtypeSchema({"missing": {"type": "other", "dtype": "int"}}).apply(typed, strict=True)


def test_key_overlap_and_compatibility(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "FICHA long")
    b = spark.createDataFrame([(2,), (3,), (None,)], "FICHA long")
    assert [tuple(r) for r in key_overlap({"a": a, "b": b}, "FICHA").collect()] == [(2, 2)]
    with pytest.raises(ValueError):
        check_dataset_compatibility({"a": a, "b": b}, check_unique_rows=True)
    c = spark.createDataFrame([(5, 1)], "FICHA long, X long")
    with pytest.raises(ValueError):
        check_dataset_compatibility({"a": a, "c": c}, check_matching_columns=True)
    assert check_dataset_compatibility({"a": a, "c": c.select("FICHA")}, check_unique_rows=True)


def test_team_codes(spark):
    df = spark.createDataFrame([("H12",), ("A3 x",), ("B7 EXTRA",), ("BHA12",), ("H12B",)], "g string")
    v1 = [r[0] for r in df.select(team_code_v1("g")).collect()]
    assert v1 == ["BHA12", "AA3 x", "BA7", "BHA12", "H12B"]
    df2 = spark.createDataFrame([("BHA-12 3",), ("AA123 - foo",), ("BA7 sur",), ("BHA12",)], "g string")
    assert [r[0] for r in df2.select(team_code_v2("g")).collect()] == ["BHA12", "AA123", "BA7", "BHA12"]


def test_month_cycle_peak(spark):
    df = spark.createDataFrame([(m,) for m in range(1, 13)], "month int")
    out = X.add_month_cycle(df, peak_month=12).collect()
    cos = {r["month"]: r["cos_month"] for r in out}
    assert max(cos, key=cos.get) == 12 and abs(cos[12] - 1.0) < 1e-12
    assert abs(cos[6] - math.cos(2 * math.pi * -6 / 12)) < 1e-12


def test_first_zone_in_dispatch_order(spark):
    d = spark.createDataFrame([(1, None, 1), (1, "B", 3), (1, "A", 2), (2, None, 1)], "fire_id long, zone string, seq long")
    f = spark.createDataFrame([(1, 10, "a"), (2, 20, "a"), (3, 30, "b")], "fire_id long, season long, file_source string")
    out = {r["fire_id"]: r["zone"] for r in match.zone_from_dispatch(f.drop("file_source"), d, order_cols=["seq"]).collect()}
    assert out == {1: "A", 2: None, 3: None}
    summary = match.season_summary(f, d).collect()
    assert [(r["season"], r["file"], r["fires_with_dispatch"], r["fires_without_dispatch"]) for r in summary] == \
        [(10, "a", 1, 0), (20, "a", 1, 0), (30, "b", 0, 1)]
    assert F  # keep import used
