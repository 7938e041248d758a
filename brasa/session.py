"""Session helpers.

The cluster owns its configuration: we only fill in settings that are unset,
so a submitted job inherits whatever the cluster names (shuffle partitions,
``spark.checkpoint.dir`` on shared storage, ...).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

# Defaults applied only when the running session has no value for the key.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "brasa", **conf) -> SparkSession:
    """Return the active session, or build a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        spark = active
    else:
        b = SparkSession.builder.appName(app)
        if master:
            b = b.master(master)
        b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        for k, v in conf.items():
            b = b.config(k.replace("__", "."), v)
        spark = b.getOrCreate()
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only where it is unset and the master is local (tests, bench) do we create
    a scratch folder and register it. On a cluster an unset folder is an error:
    executors would each write their own disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext on the client
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        d = tempfile.mkdtemp(prefix="brasa-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df, partition_by=()):
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and
    continue from it.

    One columnar write (``Dataset.checkpoint`` would compute the plan twice
    and store Java-serialised rows); the table lives on the shared storage the
    cluster names in ``spark.checkpoint.dir``, so it survives executor loss,
    and the new plan starts at a plain scan.  With ``partition_by``, filters on
    those columns read only their folders.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/brasa-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    # the schema is given, so that folder names are not turned into numbers
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def cut_and_count(df):
    """``(cut_lineage(df), number of rows)``: rows are counted while they are written."""
    rows = Observation()
    out = cut_lineage(df.observe(rows, F.count(F.lit(1)).alias("n")))
    return out, rows.get.get("n", 0)
