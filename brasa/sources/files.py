"""File sources and sinks.

CSV columns are read as strings (no inference pass, ids stay exact) and typed
afterwards with ``try_cast``.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brasa.functions.lookups import SCORING_INPUT
from brasa.operators.schema import drop_all_null_rows, normalise_headers


def _expand(spark: SparkSession, path: str | Sequence[str], suffix: str = ".csv") -> list[str]:
    """A file, a list of files, or a directory's ``*<suffix>`` files; missing -> error."""
    if isinstance(path, str):
        paths = [path] if path.endswith(suffix) else [os.path.join(path, f"*{suffix}")]
    else:
        paths = list(path)
    if not paths:
        raise FileNotFoundError("No CSV files found in the given path(s).")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        st = fs.globStatus(hp)
        if st is None or len(st) == 0:
            raise FileNotFoundError(f"CSV file not found: {p}")
        out.extend(s.getPath().toString() for s in st)
    return out


SEQ_COL = "ROW_SEQ"


def _header(spark: SparkSession, path: str) -> str:
    """First line of a file, through the file system Spark itself uses."""
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    stream = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(hp)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def load_csv(spark: SparkSession, path: str | Sequence[str], sep: str = ";",
             lineage_col: str = "ARCHIVO") -> DataFrame:
    """Read every file (all strings), normalise headers, tag the file stem,
    drop all-empty rows, outer-union by name across header variants.

    Files with the same header line are one read, in order of the first of them.
    ``ROW_SEQ`` orders the rows as the files' list and lines do: (place of the
    file, start of its split, position in the task), whatever the sizes of the
    files and however splits are packed into tasks.
    """
    paths = _expand(spark, path)
    groups: dict[str, list[str]] = {}
    for f in paths:
        groups.setdefault(_header(spark, f), []).append(f)
    place: dict[str, int] = {}
    for f in paths:
        place.setdefault(_plain(f), len(place))
    # file names come URL-escaped; a plus sign is itself
    unescaped = lambda c: F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B")))
    stem = F.regexp_replace(F.regexp_extract(unescaped("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1), r"\s", "_")
    ranks = F.map_from_arrays(F.array(*map(F.lit, place)), F.array(*map(F.lit, place.values())))
    rank = F.element_at(ranks, F.regexp_replace(unescaped("_metadata.file_path"), _SCHEME, "/"))
    seq = F.struct(F.coalesce(rank, F.raise_error(F.lit("unknown file"))).cast("int").alias("file"),
                   F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    out = None
    for files in groups.values():
        df = spark.read.option("sep", sep).option("header", True).option("inferSchema", False).csv(files)
        df = drop_all_null_rows(normalise_headers(df)).withColumn(lineage_col, stem).withColumn(SEQ_COL, seq)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:/*"


def _plain(path: str) -> str:
    """A path without its scheme: one form for what the file system and the scan call a file."""
    return re.sub(_SCHEME, "/", path)


WEATHER_RENAME = {"FICHA": "fire_id", "TEMPERATURA": "temperature", "HUMEDAD_RELATIVA": "relative_humidity",
                  "VELOCIDAD_VIENTO_MS": "wind_speed_ms", "VELOCIDAD_VIENTO_KNOTS": "wind_speed_knots",
                  "DIRVIENTO": "wind_direction"}


def load_weather(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """Six pruned columns, renamed; comma decimals -> double, bad text -> NULL."""
    df = spark.read.option("sep", sep).option("header", True).csv(path)
    cols = []
    for src, dst in WEATHER_RENAME.items():
        if src not in df.columns:
            continue
        c = F.col(src)
        cols.append((c.try_cast("bigint") if dst == "fire_id" else _comma_double(c)).alias(dst))
    return df.select(*cols)


def _comma_double(c):
    return F.trim(F.replace(c.cast("string"), F.lit(","), F.lit("."))).try_cast("double")


def load_topo(spark: SparkSession, path: str, id_col: str = "fire_id") -> DataFrame:
    """``(fire_id, elevation, slope_*, aspect_degrees)``; first ``slope_`` column is used."""
    df = spark.read.option("header", True).csv(path)
    if id_col not in df.columns:
        raise KeyError(f"Column '{id_col}' not found in topographic CSV.")
    slope = [c for c in df.columns if c.startswith("slope_")]
    if not slope:
        raise KeyError("No slope column found in topographic data (expected 'slope_degrees' or 'slope_radians').")
    return df.select(F.col(id_col).try_cast("bigint").alias(id_col),
                     *[F.col(c).try_cast("double").alias(c) for c in ("elevation", slope[0], "aspect_degrees")
                       if c in df.columns])


SCORING_SCHEMA = ("fire_id BIGINT, longitude DOUBLE, latitude DOUBLE, start_datetime STRING, "
                  "temperature DOUBLE, wind_speed_kmh DOUBLE, relative_humidity DOUBLE")


def load_scoring_input(spark: SparkSession, path: str) -> DataFrame:
    """``.json`` (object or list of objects) or ``.csv``, fixed 7-column schema."""
    ext = os.path.splitext(path)[1].lower()
    if ext == ".json":
        df = spark.read.schema(SCORING_SCHEMA).option("multiLine", True).json(path)
    elif ext == ".csv":
        df = spark.read.option("header", True).schema(SCORING_SCHEMA).csv(path)
    else:
        raise ValueError(f"Unsupported file extension: {ext}")
    return df.withColumn("start_datetime", F.col("start_datetime").try_cast("timestamp_ntz")).select(*SCORING_INPUT)


def parquet_to_csv(spark: SparkSession, src: str, dst: str, columns: Sequence[str] = tuple(SCORING_INPUT)) -> None:
    """Column-pruned parquet scan written as CSV."""
    spark.read.parquet(src).select(*columns).write.mode("overwrite").option("header", True).csv(dst)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", sep: str = ";",
                partition_by: Sequence[str] = ()) -> None:
    """Cleaned-table sink (parquet by default; ``;`` CSV on request)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("sep", sep).option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


# ---- S10 / S11 ------------------------------------------------------------------
def polygons_from_wkt(df: DataFrame, wkt_col: str = "wkt", area_col: str = "area") -> DataFrame:
    """``POLYGON ((x y, x y, ...), (...))`` text -> ``(area, ring, holes)``.

    Rings are ``ARRAY<STRUCT<x, y>>`` without the closing vertex; ``holes`` is the
    array of inner rings.  ``MULTIPOLYGON`` rows explode into one row per part.
    """
    body = F.regexp_replace(F.upper(F.col(wkt_col)), r"^\s*(MULTI)?POLYGON\s*", "")
    part = F.regexp_extract_all(body, F.lit(r"\(\s*\([^()]*\)(\s*,\s*\([^()]*\))*\s*\)"), 0)
    x = df.select(F.col(area_col).alias("area"), F.explode(part).alias("_part"))

    def points(text):
        pts = F.transform(F.split(F.trim(text), r"\s*,\s*"),
                          lambda p: F.struct(F.split(F.trim(p), r"\s+")[0].cast("double").alias("x"),
                                             F.split(F.trim(p), r"\s+")[1].cast("double").alias("y")))
        closed = (F.size(pts) > 1) & (pts[0] == F.element_at(pts, -1))
        return F.when(closed, F.slice(pts, 1, F.size(pts) - 1)).otherwise(pts)

    x = x.select("area", F.transform(F.regexp_extract_all("_part", F.lit(r"\(([^()]*)\)"), 1), points).alias("_rings"))
    return x.select("area", F.col("_rings")[0].alias("ring"),
                    F.slice("_rings", F.lit(2), F.size("_rings")).alias("holes"))


def read_polygons(spark: SparkSession, path: str, fmt: str = "parquet", area_col: str = "area",
                  wkt_col: str | None = None) -> DataFrame:
    """Zone layer: parquet/JSON with ``(area, ring[, holes])`` or a WKT text column."""
    df = spark.read.format(fmt).load(path)
    if wkt_col:
        return polygons_from_wkt(df, wkt_col, area_col)
    holes = ["holes"] if "holes" in df.columns else []
    return df.select(F.col(area_col).alias("area"), "ring", *holes)


def _raster_meta(spark: SparkSession, path: str):
    """``RasterMeta`` of a one-row JSON record, and the record."""
    from brasa.operators.geo import RasterMeta
    m = spark.read.json(path).first().asDict()          # one metadata record
    return RasterMeta(float(m["x0"]), float(m["dx"]), float(m["y0"]), float(m["dy"]), int(m["nrows"]),
                      int(m["ncols"]), None if m.get("nodata") is None else float(m["nodata"]),
                      m.get("crs") or "EPSG:4326"), m


def read_raster(spark: SparkSession, cells_path: str, meta_path: str):
    """Cell table ``(row, col, value)`` + one-row JSON georeferencing record
    (``x0, dx, y0, dy, nrows, ncols, nodata, crs``) -> ``(cells, RasterMeta)``."""
    meta, _ = _raster_meta(spark, meta_path)
    cells = spark.read.parquet(cells_path).select(F.col("row").cast("bigint"), F.col("col").cast("bigint"),
                                                  F.col("value").cast("double"))
    return cells, meta


def write_tiles(tiles, meta, path: str) -> None:
    """Blocks of a raster as parquet and its georeferencing record as JSON, in one folder."""
    tiles.blocks.write.mode("overwrite").parquet(f"{path}/blocks")
    record = {c: getattr(meta, c) for c in ("x0", "dx", "y0", "dy", "nrows", "ncols", "nodata", "crs")}
    spark = tiles.blocks.sparkSession
    (spark.range(1).select(*[F.lit(v).alias(c) for c, v in record.items()], F.lit(tiles.size).alias("tile"),
                           F.array(*map(F.lit, tiles.columns)).alias("columns"))
          .write.mode("overwrite").json(f"{path}/georef"))


def read_tiles(spark: SparkSession, path: str):
    """``(Tiles, RasterMeta)`` as written by ``write_tiles``."""
    from brasa.operators.geo import Tiles
    meta, m = _raster_meta(spark, f"{path}/georef")
    cols = tuple(m["columns"])
    return Tiles(spark.read.parquet(f"{path}/blocks").select("tile_row", "tile_col", *cols), int(m["tile"]), cols), meta
