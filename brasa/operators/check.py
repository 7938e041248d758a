"""Table comparison checks (P6-P8): key-based diff with numeric tolerance."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brasa.operators.stats import hash_key


def diff(actual: DataFrame, expected: DataFrame, key: Sequence[str], numeric_cols: Sequence[str] = (),
         tol: float = 1e-6, exclude: Sequence[str] = ()) -> DataFrame:
    """Rows that differ on common columns (full outer join on ``key``).

    Output: key columns, ``_side`` (missing_actual / missing_expected / value) and
    the names of differing columns.
    """
    key = list(key)
    common = [c for c in actual.columns if c in expected.columns and c not in key and c not in set(exclude)]
    a = actual.select(*key, *[F.col(c).alias(f"a_{c}") for c in common], F.lit(True).alias("_a"))
    e = expected.select(*key, *[F.col(c).alias(f"e_{c}") for c in common], F.lit(True).alias("_e"))
    j = a.join(e, key, "full_outer")
    diffs = []
    for c in common:
        x, y = F.col(f"a_{c}"), F.col(f"e_{c}")
        if c in set(numeric_cols):
            same = (x.isNull() & y.isNull()) | (F.abs(x.cast("double") - y.cast("double")) <= F.lit(tol))
        else:
            same = x.eqNullSafe(y)
        diffs.append(F.when(~F.coalesce(same, F.lit(False)), F.lit(c)))
    bad = F.filter(F.array(*diffs), lambda v: v.isNotNull()) if diffs else F.array()
    side = (F.when(F.col("_a").isNull(), "missing_actual").when(F.col("_e").isNull(), "missing_expected")
              .otherwise("value"))
    cols = F.when(side == "value", bad).otherwise(F.array().cast("array<string>"))
    out = j.select(*key, side.alias("_side"), cols.alias("_columns"))
    return out.where((F.col("_side") != "value") | (F.size("_columns") > 0))


def assert_same(actual: DataFrame, expected: DataFrame, key: Sequence[str], **kw) -> None:
    bad = diff(actual, expected, key, **kw).limit(10).collect()
    if bad:
        raise AssertionError(f"tables differ, e.g. {bad}")


def sample_rows(df: DataFrame, key: str, n: int = 1, seed: int = 42) -> DataFrame:
    """A seeded, repartition-stable sample of ``n`` rows (order of ``md5(seed:key)``)."""
    return df.orderBy(hash_key(seed, key), F.col(key)).limit(n)


def assert_rescored(scored: DataFrame, score: Callable[[DataFrame], DataFrame], key: str, cols: Sequence[str],
                    n: int = 100, seed: int = 42, tol: float = 1e-6) -> None:
    """Score a sample of the stored rows again and compare ``cols`` by key."""
    rows = sample_rows(scored, key, n, seed)
    assert_same(score(rows.drop(*cols)).select(key, *cols), rows.select(key, *cols), [key], numeric_cols=cols, tol=tol)
