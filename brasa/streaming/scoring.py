"""Scoring on a stream (P5).

Scoring is stateless per incident once the lookup tables (topography, fuel
mapping, intervals, zone polygons, raster cells) are fixed, so it runs as
Structured Streaming:

* ``stream_features`` — pure streaming plan: per-row features and
  stream-static joins (no state, no watermark needed).
* ``start_scoring`` — the full batch scorer applied per micro-batch with
  ``foreachBatch``; each epoch is written to its own ``epoch=<id>`` folder
  with overwrite, so a replayed epoch after a failure is idempotent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brasa.operators import features as X, geo
from brasa.operators.model import add_zone_predictions


def read_incident_stream(spark: SparkSession, path: str, schema: str, fmt: str = "json",
                         max_files_per_trigger: int = 100) -> DataFrame:
    return (spark.readStream.schema(schema).format(fmt)
                 .option("maxFilesPerTrigger", max_files_per_trigger).load(path))


def stream_features(stream: DataFrame, topo: DataFrame | None = None) -> DataFrame:
    """Stateless feature projection over a stream; ``topo`` is a static side (left join)."""
    out = X.add_hour_cycle(stream)
    out = X.add_diurnal_nocturnal(out)
    out = X.add_high_season(out)
    if "zone_alert" in out.columns:
        out = geo.split_zone(out)
    if topo is not None:
        out = X.merge_topo(out, topo)
    return out


def start_scoring(stream: DataFrame, score: Callable[[DataFrame], DataFrame], sink_dir: str,
                  checkpoint_location: str, available_now: bool = True):
    """Run ``score`` on every micro-batch and write ``sink_dir/epoch=<id>`` (idempotent)."""
    def batch(df: DataFrame, epoch_id: int) -> None:
        score(df).write.mode("overwrite").parquet(f"{sink_dir}/epoch={epoch_id}")

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def stream_scores(stream: DataFrame, models: dict, prediction_col: str = "prediction",
                  factors=("zone_WE", "zone_NS"), which: int = 1) -> DataFrame:
    """Per-zone model scores on a stream without ``foreachBatch``: one filtered
    ``transform`` per zone model, united (stateless, append mode)."""
    return add_zone_predictions(stream, models, factors, {prediction_col: which})
