"""Run artifacts and run registry.

A run is a new directory (never wiped): data parquet, schema JSON, 50-row
preview, per-zone Spark ML models with an index table, interval and mapping
tables (parquet + nested JSON), meta JSON and a metrics table.  The registry
is a parquet table of runs queried with DataFrame filters and a window.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from brasa.operators.schema import DtypeSchema

KEY_RE = r"^\('([^']*)', '([^']*)'\)$"


# ---- S16 ---------------------------------------------------------------------
def _tuple_key(*cols):
    return F.concat(F.lit("('"), F.concat_ws("', '", *cols), F.lit("')"))


def intervals_to_json(intervals: DataFrame, factors=("zone_WE", "zone_NS"),
                      cells=("diurnal_nocturnal", "high_season")) -> DataFrame:
    """``(f1, f2, c1, c2, lo, hi)`` -> one row, one JSON text ``{"('f1', 'f2')": {"lo": {"('c1', 'c2')": x}, "hi": …}}``."""
    ck = _tuple_key(*[F.col(c) for c in cells])
    per_zone = intervals.groupBy(*factors).agg(
        F.map_from_entries(F.collect_list(F.struct(ck, F.col("lo")))).alias("lo"),
        F.map_from_entries(F.collect_list(F.struct(ck, F.col("hi")))).alias("hi"))
    zk = _tuple_key(*[F.col(c) for c in factors])
    return per_zone.agg(F.to_json(F.map_from_entries(F.collect_list(
        F.struct(zk, F.struct("lo", "hi"))))).alias("json"))


def intervals_from_json(df: DataFrame, json_col: str = "json", factors=("zone_WE", "zone_NS"),
                        cells=("diurnal_nocturnal", "high_season")) -> DataFrame:
    """Inverse of ``intervals_to_json``: tuple-text keys parsed with a regex."""
    m = F.from_json(F.col(json_col), "map<string, struct<lo: map<string, double>, hi: map<string, double>>>")
    z = df.select(F.explode(m).alias("zk", "v"))
    lo = z.select("zk", F.explode("v.lo").alias("ck", "lo"))
    hi = z.select("zk", F.explode("v.hi").alias("ck", "hi"))
    j = lo.join(hi, ["zk", "ck"], "full_outer")
    return j.select(*[F.regexp_extract("zk", KEY_RE, i + 1).alias(c) for i, c in enumerate(factors)],
                    *[F.regexp_extract("ck", KEY_RE, i + 1).alias(c) for i, c in enumerate(cells)], "lo", "hi")


def mapping_to_json(mapping: DataFrame, factors=("zone_WE", "zone_NS"), source="initial_fuel",
                    target="initial_fuel_reduced") -> DataFrame:
    per_zone = mapping.groupBy(*factors).agg(F.map_from_entries(F.collect_list(F.struct(source, target))).alias("m"))
    return per_zone.agg(F.to_json(F.map_from_entries(F.collect_list(
        F.struct(_tuple_key(*[F.col(c) for c in factors]), F.col("m"))))).alias("json"))


# ---- S13 / S14 -------------------------------------------------------------------
def save_artifacts(run_dir: str, *, df: DataFrame | None = None, models: Mapping | None = None,
                   intervals: DataFrame | None = None, mapping: DataFrame | None = None,
                   covariates: Sequence[str] | None = None, meta: Mapping | None = None,
                   metrics: DataFrame | None = None, outputs: Mapping[str, DataFrame] | None = None) -> dict:
    """Write each member under ``run_dir``; returns name -> path.

    A folder that already holds a run is an error: members of an older run never
    mix with the new ones.
    """
    spark = SparkSession.getActiveSession()
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_dir)
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        raise FileExistsError(f"run folder exists: {run_dir}")
    paths = {}
    if df is not None:
        paths["data"] = p = os.path.join(run_dir, "data.parquet")
        df.write.mode("overwrite").parquet(p)
        schema_df = df.select(*covariates) if covariates else df
        paths["schema"] = _write_text(df.sparkSession, os.path.join(run_dir, "schema.json"),
                                      DtypeSchema.from_df(schema_df).to_json())
        paths["preview"] = p = os.path.join(run_dir, "data_preview.csv")
        df.limit(50).coalesce(1).write.mode("overwrite").option("header", True).csv(p)
    if models:
        rows = []
        for key, pair in models.items():
            m = pair[1] if isinstance(pair, tuple) else pair
            p = os.path.join(run_dir, "models", "_".join(str(k) for k in key))
            m.write().overwrite().save(p)
            rows.append((*[str(k) for k in key], p))
        idx = spark.createDataFrame(rows, "zone_WE string, zone_NS string, path string")
        paths["model"] = p = os.path.join(run_dir, "models", "index.parquet")
        idx.write.mode("overwrite").parquet(p)
    for name, t, to_json in (("pi", intervals, intervals_to_json), ("fuel_mapping", mapping, mapping_to_json)):
        if t is not None:
            paths[name] = p = os.path.join(run_dir, f"{name}.parquet")
            t.write.mode("overwrite").parquet(p)
            paths[f"{name}_json"] = p = os.path.join(run_dir, f"{name}.json")
            to_json(t).coalesce(1).write.mode("overwrite").text(p)
    if meta:
        clean = {k: v for k, v in meta.items() if v is not None}
        paths["meta"] = _write_text(spark, os.path.join(run_dir, "meta.json"),
                                    json.dumps(clean, indent=2))
    if metrics is not None:
        paths["metrics"] = p = os.path.join(run_dir, "metrics.parquet")
        metrics.write.mode("overwrite").parquet(p)
    for name, out in (outputs or {}).items():
        paths[f"output:{name}"] = p = os.path.join(run_dir, name)
        out.write.mode("overwrite").parquet(p)
    return paths


def _write_text(spark: SparkSession, path: str, text: str) -> str:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def _read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect())


def load_artifacts(spark: SparkSession, run_dir: str, strict: bool = False) -> dict:
    """Load every member present (``strict`` raises on a missing one)."""
    out: dict = {}

    def exists(p):
        jvm = spark.sparkContext._jvm
        hp = jvm.org.apache.hadoop.fs.Path(p)
        ok = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hp)
        if not ok and strict:
            raise FileNotFoundError(f"Missing artifact: {p}")
        return ok

    p = os.path.join(run_dir, "data.parquet")
    out["df"] = spark.read.parquet(p) if exists(p) else None
    p = os.path.join(run_dir, "schema.json")
    out["schema"] = DtypeSchema.from_json(_read_text(spark, p)) if exists(p) else None
    p = os.path.join(run_dir, "models", "index.parquet")
    if exists(p):
        out["model"] = {(r["zone_WE"], r["zone_NS"]): PipelineModel.load(r["path"])
                        for r in spark.read.parquet(p).collect()}   # bounded: one row per zone
    else:
        out["model"] = None
    for name in ("pi", "fuel_mapping", "metrics"):
        p = os.path.join(run_dir, f"{name}.parquet")
        out[name] = spark.read.parquet(p) if exists(p) else None
    p = os.path.join(run_dir, "meta.json")
    out["meta"] = json.loads(_read_text(spark, p)) if exists(p) else None
    return out


# ---- S15 / S17 -------------------------------------------------------------------
REGISTRY_SCHEMA = ("experiment string, run_id string, run_name string, status string, "
                   "lifecycle string, start_time double, path string")


def register_run(spark: SparkSession, registry: str, experiment: str, run_name: str, path: str,
                 status: str = "FINISHED", run_id: str | None = None) -> str:
    run_id = run_id or uuid.uuid4().hex
    row = [(experiment, run_id, run_name, status, "active", time.time(), path)]
    spark.createDataFrame(row, REGISTRY_SCHEMA).write.mode("append").parquet(registry)
    return run_id


def latest_run(runs: DataFrame, experiment: str, run_name: str | None = None, status: str | None = "FINISHED",
               only_active: bool = True) -> DataFrame:
    """Newest run of an experiment (optionally by name); runs with the wanted status
    are preferred, others are the fallback.  One row (or none)."""
    r = runs.where(F.col("experiment") == experiment)
    if run_name is not None:
        r = r.where(F.col("run_name") == run_name)
    if only_active:
        r = r.where(F.col("lifecycle") == "active")
    pref = F.coalesce(F.col("status") == F.lit(status), F.lit(False)) if status else F.lit(True)
    best = r.groupBy("experiment").agg(F.max_by(F.struct(*runs.columns), F.struct(
        pref, F.col("start_time"), F.col("run_id"))).alias("_run"))
    return best.select("_run.*")


def find_run(runs: DataFrame, experiment: str, run_name: str | None = None, status: str | None = "FINISHED",
             only_active: bool = True) -> Row:
    """The row of ``latest_run``; without one, an error that lists the 10 newest runs."""
    found = latest_run(runs, experiment, run_name, status, only_active).first()
    if found is None:
        newest = [f"{r['run_id']} {r['run_name']} {r['status']} {r['lifecycle']}"
                  for r in recent_runs(runs, experiment).collect()]
        raise LookupError(f"no run of {experiment!r} named {run_name!r}; newest runs: {newest}")
    return found


def metrics_rows(spark: SparkSession, run_id: str, metrics: Mapping[str, float]) -> DataFrame:
    """``(run_id, key, value)`` rows for a metrics table."""
    return spark.createDataFrame([(run_id, k, float(v)) for k, v in metrics.items()],
                                 "run_id string, key string, value double")


def recent_runs(runs: DataFrame, experiment: str, n: int = 10) -> DataFrame:
    """The ``n`` newest runs of an experiment (diagnostics when no run qualifies)."""
    return runs.where(F.col("experiment") == experiment).orderBy(F.col("start_time").desc()).limit(n)
