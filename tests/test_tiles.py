"""Raster blocks: sampling from them equals sampling from the cell table."""

import random

import pytest
from pyspark.sql import functions as F

from brasa.operators import geo
from brasa.sources import files


@pytest.fixture()
def grid(spark):
    rng = random.Random(8)
    rows = [(r, c, rng.choice([None, float("nan"), -9.0, float(r * 100 + c)])) for r in range(21) for c in range(17)
            if rng.random() < 0.7]  # holes, nulls, NaN, nodata; no block is whole
    return spark.createDataFrame(rows, "row int, col int, value double"), \
        geo.RasterMeta(-70.0, 0.5, -30.0, -0.5, 21, 17, -9.0)


def points(spark, n=600):
    rng = random.Random(9)
    rows = [(i, -70.0 + rng.uniform(-1, 10), -30.0 - rng.uniform(-1, 12), "x") for i in range(n)]
    rows += [(n, None, -31.0, "x"), (n + 1, -70.0, -30.0, None), (n + 2, -70.0 + 8.5, -30.0 - 10.5, "edge")]
    rows += [(n + 3 + i, -69.9, -30.1, "hot") for i in range(300)]
    return spark.createDataFrame(rows, "fire_id long, longitude double, latitude double, `odd.name` string")


def rows_of(df):
    return sorted((str(tuple(r)) for r in df.collect()))  # as text: NaN equals itself


@pytest.mark.parametrize("size", [1, 4, 64])
def test_blocks_equal_cells(spark, grid, size, tmp_path):
    cells, meta = grid
    files.write_tiles(geo.tile_raster(cells, size=size), meta, str(tmp_path))
    tiles, read = files.read_tiles(spark, str(tmp_path))
    assert read == meta and tiles.size == size
    p = points(spark)
    assert rows_of(geo.sample_raster(p, tiles, read)) == rows_of(geo.sample_raster(p, cells, meta))
    t, names = cells.select("row", "col", "value", (F.col("row") + F.col("col")).alias("sum")), ["value", "sum"]
    blocks = geo.tile_raster(t, names, size)
    assert rows_of(geo.sample_dem(p, blocks, meta, value_cols=names)) == rows_of(geo.sample_dem(p, t, meta, value_cols=names))


def test_block_edges(spark, grid):
    _, meta = grid
    p = points(spark, 20)
    empty = spark.createDataFrame([], "row int, col int, value double")
    assert {r.fuel for r in geo.sample_raster(p, geo.tile_raster(empty), meta).collect()} == {None}
    # a repeated cell counts with its largest value, a cell without a place is passed over
    odd = spark.createDataFrame([(0, 0, 1.0), (0, 0, 3.0), (None, 0, 9.0), (5, 5, None)], "row int, col int, value double")
    tiles = geo.tile_raster(odd, size=4)
    assert {(r.tile_row, r.tile_col, tuple(r.value)) for r in tiles.blocks.collect()} == \
        {(0, 0, (3.0,)), (1, 1, (None,) * 6)}
    got = geo.sample_raster(p, tiles, meta).where("fire_id > 22")
    assert {r.fuel for r in got.collect()} == {3.0} and got.count() == 300


def test_points_are_joined_on_blocks(spark, grid):
    """One join on the block, and the element is picked without a generator."""
    cells, meta = grid
    plan = geo.sample_raster(points(spark), geo.tile_raster(cells), meta)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "Generate" not in plan
