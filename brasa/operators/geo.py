"""Geospatial operators: point-in-polygon zones, raster sampling, terrain.

Polygons arrive as ``(area, ring ARRAY<STRUCT<x, y>>)``, with an optional
``holes`` array of rings; rasters as cell tables ``(row, col, value)`` plus a
one-row georeferencing record.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from brasa.functions.lookups import ZONE_NS_LEVELS, ZONE_WE_LEVELS
from brasa.session import cut_lineage

# a polygon layer's cell cover is broadcast up to this many bytes
BROADCAST_BYTES = 64 << 20


# ---- J8 -----------------------------------------------------------------------
def _edges(ring):
    """Array of (x1, y1, x2, y2) for consecutive vertices (closing edge included)."""
    n = F.size(ring)
    return F.transform(ring, lambda p, i: F.struct(
        p["x"].alias("x1"), p["y"].alias("y1"),
        ring[(i + 1) % n]["x"].alias("x2"), ring[(i + 1) % n]["y"].alias("y2")))


def polygon_edges(polygons: DataFrame):
    """Edges of the outer ring and of every hole (optional column ``holes``, an array of rings)."""
    outer = _edges(F.col("ring"))
    if "holes" not in polygons.columns:
        return outer
    inner = F.flatten(F.transform(F.col("holes"), _edges))
    return F.concat(outer, F.coalesce(inner, F.slice(outer, 1, 0)))


def point_within(px, py, edges):
    """Strictly inside (even-odd ray casting over the edges of all rings, so a hole is
    outside; points on an edge are not within)."""
    crossings = F.aggregate(edges, F.lit(0), lambda acc, e: acc + F.when(
        ((e["y1"] > py) != (e["y2"] > py)) &
        (px < (e["x2"] - e["x1"]) * (py - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]), 1).otherwise(0))
    on_edge = F.exists(edges, lambda e: (
        ((e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"]) == 0) &
        (px >= F.least(e["x1"], e["x2"])) & (px <= F.greatest(e["x1"], e["x2"])) &
        (py >= F.least(e["y1"], e["y2"])) & (py <= F.greatest(e["y1"], e["y2"]))))
    return ((crossings % 2) == 1) & ~on_edge


# cells of level k have side SPLIT ** k (a power of two: cell bounds and the cell of a point are exact)
SPLIT = 8
# a border cell with more edges than this is split once more
CELL_EDGES = 64


def _classified(cells: DataFrame) -> DataFrame:
    """Drops cells outside of their polygon and marks those inside of it.

    A border cell keeps the edges that can matter to its points: those in its
    band of y that are not wholly to its left (a ray to the right never meets
    the others, and no point of the cell lies on them).  An edge touches a cell
    if the cell meets its bounds and the corners are not all clearly on one side
    of its line; without such an edge the cell's middle decides for all of it.
    """
    corner = "(e.x2 - e.x1) * ({y} - e.y1) - (e.y2 - e.y1) * ({x} - e.x1)"
    corners = ", ".join(corner.format(x=x, y=y) for x in ("_x", "_x + _s") for y in ("_y", "_y + _s"))
    tol = "(abs(e.x2 - e.x1) + abs(e.y2 - e.y1)) * _s * 1e-9D"
    box = cells.selectExpr("*", f"power({SPLIT}D, k) AS _s").selectExpr("*", "cx * _s AS _x", "cy * _s AS _y")
    near = box.selectExpr("*", """if(_in, NULL, filter(_edges, e -> greatest(e.y1, e.y2) >= _y - _s * 1e-9D
        AND least(e.y1, e.y2) <= _y + _s * (1 + 1e-9D) AND greatest(e.x1, e.x2) >= _x - _s * 1e-9D)) AS _near""")
    seen = near.selectExpr("*", f"""exists(_near, e -> least(e.x1, e.x2) <= _x + _s * (1 + 1e-9D)
        AND least({corners}) <= {tol} AND greatest({corners}) >= -{tol}) AS _touch""")
    seen = seen.selectExpr("*", """if(_touch, NULL, aggregate(_near, 0, (n, e) -> n + if((e.y1 > _y + _s / 2) != (e.y2 > _y + _s / 2)
        AND _x + _s / 2 < (e.x2 - e.x1) * (_y + _s / 2 - e.y1) / (e.y2 - e.y1) + e.x1, 1, 0)) % 2 = 1) AS _mid""")
    return seen.where("_in OR _touch OR _mid").selectExpr(
        "_zone", "k", "cx", "cy", "_in OR NOT _touch AS _in", "if(_in OR NOT _touch, slice(_edges, 1, 0), _near) AS _edges")


def _divided(cells: DataFrame, least_edges: int) -> DataFrame:
    """Border cells with at least so many edges become their parts; the others stay."""
    return cells.selectExpr("_zone", "_in", "_edges", f"""inline(if(_in OR size(_edges) < {least_edges},
        array(named_struct('k', k, 'cx', cx, 'cy', cy)), transform(sequence(0, {SPLIT * SPLIT - 1}), i -> named_struct(
            'k', k - 1, 'cx', cx * {SPLIT} + i % {SPLIT}, 'cy', cy * {SPLIT} + i div {SPLIT}))))""")


def polygon_cover(polygons: DataFrame, zone_col: str = "area") -> DataFrame:
    """Hierarchical cell cover ``(_zone, k, cx, cy, _in, _edges)`` of a polygon layer.

    Cells start at the size of the polygon and are divided twice, each time only
    those on its border (a third time where many edges meet), so the number of
    cells follows the polygon's outline at its own scale, whatever the others'.
    Cells inside need no further test.  One projection chain: no shuffle.
    """
    layer = polygons.select(F.col(zone_col).alias("_zone"), polygon_edges(polygons).alias("_edges"), "ring").selectExpr(
        "_zone", "_edges", *[f"{f}(transform(ring, p -> p.{v})) AS _{f[6:]}{v}" for v in "xy" for f in ("array_min", "array_max")])
    layer = layer.selectExpr("*", f"ceil(log({SPLIT}, greatest(_maxx - _minx, _maxy - _miny, 1e-9D))) AS k").selectExpr(
        "*", f"power({SPLIT}D, k) AS _s")
    roots = layer.selectExpr("*", "explode(sequence(floor(_minx / _s), floor(_maxx / _s))) AS cx").selectExpr(
        "*", "explode(sequence(floor(_miny / _s), floor(_maxy / _s))) AS cy")
    roots = roots.selectExpr("_zone", "k", "cx", "cy", "false AS _in", "_edges")
    cover = _classified(roots)
    for least in (1, 1, CELL_EDGES):
        cover = _classified(_divided(cover, least))
    return cover


def add_zones(df: DataFrame, polygons: DataFrame, *, lon_col: str = "longitude", lat_col: str = "latitude",
              zone_col: str = "area", new_zone_col: str = "zone_alert", zone_threshold: int = 0) -> DataFrame:
    """Spatial join: each point gets the area of every polygon it lies *within*.

    Points outside all polygons, or in a hole, are dropped; overlapping polygons
    duplicate the point.  Plan: the layer's cover is written once; each point
    meets it by an equi-join on its cell at every level the cover has (a few);
    a point in an inside cell is within, one in a border cell is tested against
    that cell's edges.  The cover is broadcast when its measured bytes are at
    most ``BROADCAST_BYTES``, otherwise shuffled (AQE splits hot cells).
    """
    seen = Observation()
    level = F.expr("shiftleft(1L, cast(k + 31 as int))")
    cover = cut_lineage(polygon_cover(polygons, zone_col).observe(
        seen, F.bit_or(level).alias("levels"), F.sum(F.size("_edges") * 32 + F.length(F.col("_zone").cast("string")) + 64).alias("bytes")))
    found = seen.get
    levels = [k - 31 for k in range(63) if (found.get("levels") or 0) >> k & 1]
    if (found.get("bytes") or 0) <= BROADCAST_BYTES:
        cover = F.broadcast(cover)
    cells = F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.floor(F.col(lon_col) / float(SPLIT) ** k).alias("cx"),
                               F.floor(F.col(lat_col) / float(SPLIT) ** k).alias("cy")) for k in levels or [0]])
    pts = df.drop(new_zone_col).select("*", F.inline(cells))
    out = (pts.join(cover, ["k", "cx", "cy"])
              .where(F.col("_in") | point_within(F.col(lon_col), F.col(lat_col), F.col("_edges")))
              .withColumnRenamed("_zone", new_zone_col).drop("k", "cx", "cy", "_in", "_edges"))
    if zone_threshold > 0:
        out = filter_by_group_count(out, new_zone_col, zone_threshold)
    return out


def filter_by_group_count(df: DataFrame, col: str, threshold: int) -> DataFrame:
    """A3: keep rows whose ``col`` value occurs strictly more than ``threshold`` times (NULL drops).

    Group counts are a partial aggregate; the join back is keyed on a table
    with one row per level (AQE broadcasts it by measured size).
    """
    keep = (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > threshold).select(col))
    return df.join(keep, col, "left_semi")


# ---- F13 ----------------------------------------------------------------------
def split_zone(df: DataFrame, zone_col: str = "zone_alert", keys=("zone_WE", "zone_NS"),
               levels=(ZONE_WE_LEVELS, ZONE_NS_LEVELS)) -> DataFrame:
    """"Costa 3" -> zone_WE="Costa", zone_NS="3" (single-space split); out-of-domain -> NULL."""
    parts = F.split(F.col(zone_col).cast("string"), " ", -1)
    out = df
    for i, (k, lv) in enumerate(zip(keys, levels)):
        v = F.get(parts, i)
        out = out.withColumn(k, F.when(v.isin(list(lv)), v))
    return out


# ---- raster metadata --------------------------------------------------------------
@dataclass(frozen=True)
class RasterMeta:
    """Affine georeferencing of a north-up grid (``dy`` negative) in the coordinate system ``crs``."""
    x0: float
    dx: float
    y0: float
    dy: float
    nrows: int
    ncols: int
    nodata: float | None = None
    crs: str = "EPSG:4326"

    @property
    def bounds(self):
        xs = (self.x0, self.x0 + self.dx * self.ncols)
        ys = (self.y0, self.y0 + self.dy * self.nrows)
        return min(xs), min(ys), max(xs), max(ys)


def raster_shape(cells: DataFrame) -> tuple[int, int]:
    """(nrows, ncols) of a cell table: one tiny aggregate."""
    r = cells.agg(F.max("row").alias("r"), F.max("col").alias("c")).first()
    return int(r["r"]) + 1, int(r["c"]) + 1


# ---- S11: blocks of cells -------------------------------------------------------
#: cells along a side of a block
TILE = 64


@dataclass(frozen=True)
class Tiles:
    """A raster as one row per square block: ``(tile_row, tile_col, <one array per value column>)``.

    A block holds its cells row by row; a cell without a value is NULL, cells
    after the last one with a value are left off.
    """
    blocks: DataFrame
    size: int
    columns: tuple[str, ...] = ("value",)


def _tile_key(row, col, size: int):
    """(tile_row, tile_col, place in the block) of a cell."""
    n = F.lit(size)
    place = F.pmod(row, n) * n + F.pmod(col, n)
    return (F.floor(row / n).alias("tile_row"), F.floor(col / n).alias("tile_col"), place.cast("int").alias("_place"))


def tile_raster(cells: DataFrame, value_cols=("value",), size: int = TILE) -> Tiles:
    """Cell table ``(row, col, *value_cols)`` -> blocks of ``size`` x ``size`` cells.

    One shuffle, by block; a block has at most ``size * size`` cells, so no group
    grows with the raster. Of repeated cells the largest value counts.
    """
    cols = list(value_cols)
    key = _tile_key(F.col("row").cast("bigint"), F.col("col").cast("bigint"), size)
    placed = (cells.where(F.col("row").isNotNull() & F.col("col").isNotNull()).select(*key, *cols)
                   .repartition("tile_row", "tile_col"))
    one = placed.groupBy("tile_row", "tile_col", "_place").agg(*[F.max(c).alias(c) for c in cols])
    held = one.groupBy("tile_row", "tile_col").agg(F.array_sort(F.collect_list(F.struct("_place", *cols))).alias("_cells"))

    def dense(c):
        def fill(cell, i):
            before = F.coalesce(F.get("_cells", i - 1)["_place"], F.lit(-1))
            return F.concat(F.array_repeat(F.lit(None).cast(cells.schema[c].dataType), cell["_place"] - before - 1),
                            F.array(cell[c]))
        return F.flatten(F.transform("_cells", fill)).alias(c)

    return Tiles(held.select("tile_row", "tile_col", *[dense(c) for c in cols]), size, tuple(cols))


def _cell_values(pts: DataFrame, grid: DataFrame | Tiles, value_cols) -> DataFrame:
    """``pts`` with the values of the cell ``(_row, _col)`` (NULL where there is none), key columns dropped.

    On blocks, the join is on the block and each point picks its element there: a
    block crosses the network once, not cell by cell, and is not copied per point.
    A hot block's points are split by AQE like any skewed left side.
    """
    cols = list(value_cols)
    if isinstance(grid, Tiles):
        b = grid.blocks.select(F.col("tile_row").alias("_tr"), F.col("tile_col").alias("_tc"),
                               *[F.col(c).alias(f"_block_{c}") for c in cols])
        tr, tc, place = _tile_key(F.col("_row"), F.col("_col"), grid.size)
        kept = [F.col(f"`{c}`") for c in pts.columns if c not in ("_row", "_col")]
        x = pts.select(*kept, tr.alias("_tr"), tc.alias("_tc"), place).join(b, ["_tr", "_tc"], "left")
        return x.select(*kept, *[F.get(f"_block_{c}", F.col("_place")).alias(c) for c in cols])
    c = grid.select(F.col("row").cast("bigint").alias("_row"), F.col("col").cast("bigint").alias("_col"),
                    *[F.col(c) for c in cols])
    return pts.join(c, ["_row", "_col"], "left").drop("_row", "_col")


# ---- J9 -----------------------------------------------------------------------
def sample_raster(df: DataFrame, cells: DataFrame | Tiles, meta: RasterMeta, *, x_col: str = "longitude",
                  y_col: str = "latitude", out_col: str = "fuel", crs: str = "EPSG:4326") -> DataFrame:
    """Value of the cell containing each point (floor indexing); bounds are closed.

    Points in another coordinate system than the raster's are projected first.

    Points outside the raster, on nodata, or on a missing cell get NULL; every
    point is kept (left join on the cell or block key, shuffle or broadcast by AQE).
    """
    left, bottom, right, top = meta.bounds
    x, y = project(x_col, y_col, crs, meta.crs)
    inb = (x >= left) & (x <= right) & (y >= bottom) & (y <= top)
    pts = (df.withColumn("_row", F.when(inb, F.floor((y - F.lit(meta.y0)) / F.lit(meta.dy))))
             .withColumn("_col", F.when(inb, F.floor((x - F.lit(meta.x0)) / F.lit(meta.dx)))))
    v = F.col("_value")
    if meta.nodata is not None:
        v = F.when(v != F.lit(float(meta.nodata)), v)
    v = F.when(~F.isnan(v), v)
    named = (Tiles(cells.blocks.withColumnRenamed("value", "_value"), cells.size) if isinstance(cells, Tiles)
             else cells.withColumnRenamed("value", "_value"))
    return _cell_values(pts, named, ["_value"]).withColumn(out_col, v).drop("_value")


# ---- J10 ----------------------------------------------------------------------
def sample_dem(df: DataFrame, terrain: DataFrame | Tiles, meta: RasterMeta, *, x_col: str = "longitude",
               y_col: str = "latitude", id_col: str = "fire_id",
               value_cols=("elevation", "slope_degrees", "aspect_degrees"), crs: str = "EPSG:4326") -> DataFrame:
    """Terrain attributes at each point: cell = half-even rounded grid offset; outside -> NULL.

    Returns ``(id_col, *value_cols)`` (a topography table for ``merge_topo``).
    """
    x, y = project(x_col, y_col, crs, meta.crs)
    col = F.bround((x - F.lit(meta.x0)) / F.lit(meta.dx), 0).cast("bigint")
    row = F.bround((y - F.lit(meta.y0)) / F.lit(meta.dy), 0).cast("bigint")
    inside = (row >= 0) & (row < meta.nrows) & (col >= 0) & (col < meta.ncols)
    pts = df.select(id_col, F.when(inside, row).alias("_row"), F.when(inside, col).alias("_col"))
    return _cell_values(pts, terrain, value_cols).select(id_col, *value_cols)


# ---- X23 ----------------------------------------------------------------------
_OFFSETS = [(dr, dc) for dr in (-1, 0, 1) for dc in (-1, 0, 1)]


def terrain_attributes(dem: DataFrame, res_x: float, res_y: float, slope_units: str = "degrees",
                       nodata: float | None = None) -> DataFrame:
    """Horn (1981) slope and aspect per cell of an elevation grid.

    Cells are shuffled once, by tile; only cells at a tile's border also go to
    the tiles beside it.  Within its tile each cell sends its value to its 3x3
    neighbourhood and one grouped aggregate, on the same partitioning, assembles
    every window.  Cells without a complete neighbourhood get NULL slope/aspect.
    Aspect is degrees clockwise from north in [0, 360); flat cells get -1.
    """
    v = F.col("value")
    if nodata is not None:
        v = F.when(v != F.lit(float(nodata)), v)

    def tiles(c):
        return F.array_distinct(F.array(*[F.floor((F.col(c) + d) / TILE) for d in (-1, 0, 1)]))

    tiled = (dem.select("row", "col", v.alias("z"))
                .withColumn("_tr", F.explode(tiles("row"))).withColumn("_tc", F.explode(tiles("col")))
                .repartition("_tr", "_tc"))
    sent = tiled.select("_tr", "_tc", "z", F.explode(F.array(*[F.struct(
        (F.col("row") - dr).alias("row"), (F.col("col") - dc).alias("col"),
        F.lit(dr * 3 + dc + 4).alias("pos")) for dr, dc in _OFFSETS])).alias("s")).select("_tr", "_tc", "z", "s.*")
    sent = sent.where((F.floor(F.col("row") / TILE) == F.col("_tr")) & (F.floor(F.col("col") / TILE) == F.col("_tc")))
    win = sent.groupBy("_tr", "_tc", "row", "col").agg(
        *[F.max(F.when(F.col("pos") == i, F.col("z"))).alias(f"z{i}") for i in range(9)],
        F.count(F.col("z")).alias("_k"), F.count_if(F.col("pos") == 4).alias("_own"))
    z = [F.col(f"z{i}") for i in range(9)]   # z0 z1 z2 / z3 z4 z5 / z6 z7 z8 (row-major, north up)
    dzdx = ((z[2] + 2 * z[5] + z[8]) - (z[0] + 2 * z[3] + z[6])) / F.lit(8.0 * res_x)
    dzdy = ((z[6] + 2 * z[7] + z[8]) - (z[0] + 2 * z[1] + z[2])) / F.lit(8.0 * res_y)
    rise = F.sqrt(dzdx * dzdx + dzdy * dzdy)
    slope = F.atan(rise)
    slope = F.degrees(slope) if slope_units.lower().startswith("deg") else slope
    aspect = F.degrees(F.atan2(-dzdx, dzdy))     # downslope azimuth: 0 = north, clockwise (rows grow south)
    aspect = F.when(rise == 0, F.lit(-1.0)).otherwise(F.when(aspect < 0, aspect + 360.0).otherwise(aspect))
    full = F.col("_k") == 9
    slope_col = "slope_degrees" if slope_units.lower().startswith("deg") else "slope_radians"
    return (win.where("_own > 0")
               .select("row", "col", z[4].alias("elevation"),
                       F.when(full, slope).alias(slope_col), F.when(full, aspect).alias("aspect_degrees")))


# ---- X22 ----------------------------------------------------------------------
def to_web_mercator(lon_col: str = "longitude", lat_col: str = "latitude"):
    """EPSG:4326 -> EPSG:3857 as column math: (x, y) in metres."""
    r = 6378137.0
    x = F.radians(F.col(lon_col)) * F.lit(r)
    y = F.log(F.tan(F.lit(math.pi / 4) + F.radians(F.col(lat_col)) / 2)) * F.lit(r)
    return x, y


def to_utm(zone: int, south: bool, lon_col: str = "longitude", lat_col: str = "latitude"):
    """EPSG:4326 -> UTM (WGS84) easting/northing, Krüger series to third order."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    n = f / (2 - f)
    A = a / (1 + n) * (1 + n * n / 4 + n ** 4 / 64)
    al = [n / 2 - 2 * n * n / 3 + 5 * n ** 3 / 16, 13 * n * n / 48 - 3 * n ** 3 / 5, 61 * n ** 3 / 240]
    lon0 = math.radians(zone * 6 - 183)
    lat = F.radians(F.col(lat_col))
    dl = F.radians(F.col(lon_col)) - F.lit(lon0)
    e2n = 2 * math.sqrt(n) / (1 + n)
    t = F.sinh(F.atanh(F.sin(lat)) - F.lit(e2n) * F.atanh(F.lit(e2n) * F.sin(lat)))
    xi = F.atan2(t, F.cos(dl))
    eta = F.atanh(F.sin(dl) / F.sqrt(F.lit(1.0) + t * t))
    e = eta
    nn = xi
    for j, aj in enumerate(al, start=1):
        e = e + F.lit(aj) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
        nn = nn + F.lit(aj) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
    east = F.lit(500000.0) + F.lit(k0 * A) * e
    north = F.lit(k0 * A) * nn + F.lit(10000000.0 if south else 0.0)
    return east, north



def project(x_col: str, y_col: str, source: str, target: str):
    """Coordinate columns in the ``target`` system.

    Longitude/latitude (EPSG:4326) go to Web Mercator (EPSG:3857) or to a WGS84
    UTM zone (EPSG:326zz north, 327zz south); any other pair is an error.
    """
    if source == target:
        return F.col(x_col), F.col(y_col)
    code = target.removeprefix("EPSG:")
    if source == "EPSG:4326" and code == "3857":
        return to_web_mercator(x_col, y_col)
    if source == "EPSG:4326" and len(code) == 5 and code[:3] in ("326", "327"):
        return to_utm(int(code[3:]), code[:3] == "327", x_col, y_col)
    raise ValueError(f"no projection from {source} to {target}")
