"""Helpers shared by the text operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brasa.session import cut_lineage

#: Characters between words: space and \x09-\x0D (Java regex and Python ``bytes.split`` agree).
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words of a text (empty for a null or blank one)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node: ``(a, b)`` bigint edges -> ``(node, root)``.

    Alternating large-star / small-star rounds: every round replaces a node's
    edges by edges to the smallest neighbour it knows, so stars grow
    geometrically and the number of rounds is logarithmic. The neighbour
    minimum is a partial aggregate and the join back is an ordinary equi-join
    that adaptive execution splits, so a hub with many edges is not one task.
    Each round is cut to a table in the checkpoint folder; only the row count
    and a checksum of the links reach the driver. Isolated nodes are not
    returned. An empty edge table gives an empty result.
    """
    links = cut_lineage(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m"))
                        .where("v != m").distinct())
    seen = None
    while True:
        both = links.unionByName(links.select(F.col("m").alias("v"), F.col("v").alias("m")))
        low = both.groupBy("v").agg(F.least(F.min("m"), F.col("v")).alias("low"))
        # large star: every larger neighbour of v is linked to the smallest node v knows
        large = (both.join(low, "v").where("m > v").select(F.col("m").alias("v"), F.col("low").alias("m"))
                 .where("v != m").distinct())
        low = large.groupBy("v").agg(F.min("m").alias("low"))
        # small star: v and its smaller neighbours are linked to the smallest of them
        links = cut_lineage(large.join(low, "v").select(F.explode(F.array(
            F.struct(F.col("v"), F.col("low").alias("m")), F.struct(F.col("m").alias("v"), F.col("low").alias("m"))))
            .alias("e")).select("e.*").where("v != m").distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if now == seen:
            return links.select(F.col("v").alias("node"), F.col("m").alias("root"))
        seen = now


def utf8(column: pa.Array):
    """The values of a string column as bytes, one at a time (null: empty), without a copy of the whole batch."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1].tolist()
    data = memoryview(column.buffers()[2] or b"")
    valid = column.is_valid().to_pylist()
    return (bytes(data[a:b]) if ok else b"" for a, b, ok in zip(ends, ends[1:], valid))
