import numpy as np
import pandas as pd

from brasa.operators.stats import exact_quantiles, hash_key, rank_within_groups


def _data(spark, n=3000, seed=0):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n).astype("int64"), "v": np.round(rng.normal(size=n), 2)})
    pdf.loc[::9, "v"] = np.nan
    # one hot group with many ties
    pdf.loc[pdf.index[:n // 3], "g"] = 7
    pdf.loc[pdf.index[:n // 6], "v"] = 1.5
    return pdf, spark.createDataFrame(pdf)


def test_exact_quantiles_match_numpy(spark):
    pdf, df = _data(spark)
    probs = [0.0, 0.05, 0.1, 0.5, 0.9, 0.95, 1.0]
    for kw in ({}, {"accuracy": 500}, {"accuracy": 20_000}):
        out = exact_quantiles(df, ["g"], "v", probs, **kw).toPandas()
        for _, row in out.iterrows():
            x = pdf[pdf.g == row.g].v.dropna().to_numpy()
            assert row.n == len(x)
            for i, p in enumerate(probs):
                assert abs(row[f"q{i}"] - np.quantile(x, p)) < 1e-12


def test_exact_quantile_ungrouped(spark):
    pdf, df = _data(spark, seed=3)
    out = exact_quantiles(df, [], "v", [0.99], ["q"]).first()
    assert abs(out["q"] - np.nanquantile(pdf.v, 0.99)) < 1e-12


def test_rank_within_groups_is_exact(spark):
    pdf, df = _data(spark)
    from pyspark.sql import functions as F
    d = df.withColumn("id", F.monotonically_increasing_id()).withColumn("h", hash_key(42, "id"))
    r = rank_within_groups(d, ["g"], "h", ["id"]).toPandas()
    for _, sub in r.groupby("g"):
        s = sub.sort_values(["h", "id"])
        assert (s["_rank"].to_numpy() == np.arange(len(s))).all()
        assert (s["_group_n"] == len(s)).all()


def test_null_group_is_a_group(spark):
    """Quantiles and ranks keep rows whose group key is NULL, at every size of the bracket."""
    df = spark.range(4000).selectExpr("IF(id % 4 = 0, NULL, id % 4) AS g", "CAST(id AS DOUBLE) AS v", "md5(CAST(id AS STRING)) AS h", "id")
    for accuracy in (100_000, 500):
        out = {r.g: (r.n, r.q) for r in exact_quantiles(df, ["g"], "v", [0.5], ["q"], accuracy=accuracy).collect()}
        assert out[None] == (1000, 1998.0) and len(out) == 4
    assert rank_within_groups(df, ["g"], "h", ["id"]).count() == 4000


def test_several_columns_in_one_plan(spark):
    """Columns with gaps of their own, a skewed one with infinite values, one without values in a group."""
    from brasa.operators.stats import quantiles_of
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 40_000).astype("int64"), "a": rng.normal(size=40_000),
                        "b": np.exp(rng.normal(size=40_000) * 8), "c": rng.integers(0, 4, 40_000).astype(float)})
    pdf.loc[::7, "a"] = np.nan
    pdf.loc[::5000, "b"] = np.inf
    pdf.loc[pdf.g == 2, "c"] = np.nan
    wanted = {"a5": ("a", 0.05), "a95": ("a", 0.95), "b50": ("b", 0.5), "b99": ("b", 0.99), "c50": ("c", 0.5)}
    for accuracy in (100_000, 2000, 500):
        out = quantiles_of(spark.createDataFrame(pdf), ["g"], wanted, accuracy).toPandas().set_index("g")
        for g, sub in pdf.groupby("g"):
            for name, (col, p) in wanted.items():
                x = sub[col].dropna().to_numpy()
                want = np.quantile(x, p) if len(x) else np.nan
                assert (np.isnan(want) and np.isnan(out.loc[g, name])) or abs(out.loc[g, name] - want) <= 1e-9 * abs(want)
