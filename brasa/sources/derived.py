"""Incident-shaped inputs derived from the benchmark tables.

The driver ships TPC-H-like tables, not incident records, so each input the
library expects is a deterministic rule over those tables.  The same rules
are written as SQL in ``brasa.plans.oracle`` so DuckDB can check every query.
All work grows with the tables (no fixed fixtures).

* fires        <- orders            (one incident per order)
* dispatches   <- lineitem ⋈ orders (one dispatch per line item)
* topo/weather <- orders            (per-incident covariates, some missing)
* polygons     <- rule (15 zone quadrilaterals + 1 overlapping triangle)
* fuel raster  <- part              (one cell per part)
* DEM          <- customer          (one cell per customer)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brasa.functions.lookups import LOCAL_FUEL_LABELS, ZONE_WE_LEVELS

DISPATCH_ZONE_NAMES = ["CHILLAN", "CONSTITUCION", "ARAUCO", "VALDIVIA", "TEMUCO"]
TARGET_ZONE_RAW = ["UNIDAD BASICA", "ZONA INTERFAZ", "CONFLICTO", "VALDIVIA", "NOCTURNO", "SIN META"]
LOCAL_FUEL_NAMES = list(LOCAL_FUEL_LABELS)

# raster / DEM geometry (georeferencing of the derived grids)
FUEL_X0, FUEL_DX, FUEL_Y0, FUEL_HEIGHT, FUEL_NCOLS, FUEL_NODATA = -73.5, 0.035, -33.8, 6.4, 100, -9999.0
DEM_X0, DEM_DX, DEM_Y0, DEM_HEIGHT, DEM_NCOLS = -74.05, 0.1025, -33.9, 6.2, 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one benchmark table; the (immutable) DataFrame is reused per session
    so the file listing and footer read happen once. The session holds its own
    tables, so they go with it."""
    tables = spark.__dict__.setdefault("_brasa_tables", {})
    if (sf_dir, name) not in tables:
        tables[sf_dir, name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return tables[sf_dir, name]


def _pick(values, idx):
    """element_at(array(values), idx + 1)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _nominal_start(k, orderdate):
    return F.timestamp_add("MINUTE", k % 1440, orderdate)


def fires(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    nominal = _nominal_start(k, F.col("o_orderdate"))
    fmt = F.date_format(nominal, "yyyy-MM-dd HH:mm")
    arrival = F.when(k % 59 != 0, F.timestamp_add("MINUTE", c % 45, nominal))
    year = F.year("o_orderdate")
    ini = F.col("o_totalprice") / F.lit(1e6)
    n = F.floor("o_totalprice").cast("bigint")
    ini_txt = F.concat(
        F.when(k % 97 == 0, F.lit("-")).otherwise(F.lit("")),
        (n / 1000).cast("bigint").cast("string"), F.lit("."),
        F.lpad((n % 1000).cast("string"), 3, "0"), F.lit(","),
        F.lpad((c % 100).cast("string"), 2, "0"))
    fin_n = n * (c % 7 + 1)
    fin_txt = F.concat(
        (fin_n / 1000).cast("bigint").cast("string"), F.lit("."),
        F.lpad((fin_n % 1000).cast("string"), 3, "0"), F.lit(","),
        F.lpad((c % 100).cast("string"), 2, "0"),
        F.when(k % 3 == 0, F.lit(" m2")).otherwise(F.lit("")))
    zone_we = _pick(ZONE_WE_LEVELS, c % 3)
    zone_ns = (k % 5 + 1).cast("string")
    return o.select(
        F.when(k % 53 == 7, k).otherwise(k + 100000000).alias("fire_id"),
        F.when(year < 1998, F.lit("incendios_1995-1997")).otherwise(F.lit("incendios_1998-2001")).alias("file_source"),
        year.cast("bigint").alias("season"),
        F.when(k % 71 == 0, F.lit("sin dato"))
         .when(k % 67 == 0, F.concat(fmt, F.lit(":00")))
         .when(k % 61 == 0, F.concat(F.lit(" "), fmt, F.lit(" ")))
         .otherwise(fmt).alias("start_text"),
        F.when(k % 71 != 0, nominal).alias("start_datetime"),
        arrival.alias("arrival_datetime_inc"),
        F.timestamp_add("MINUTE", c % 60 + 30, arrival).alias("control_datetime"),
        (F.lit(-40.0) + (k % 600).cast("double") / F.lit(100.0)).alias("latitude"),
        (F.lit(-74.0) + (c % 400).cast("double") / F.lit(100.0)).alias("longitude"),
        ini.alias("initial_surface_ha"),
        F.when(k % 89 == 0, ini / F.lit(2.0)).otherwise(ini * (c % 7 + 1).cast("double")).alias("final_surface_ha"),
        ini_txt.alias("initial_surface_txt"),
        fin_txt.alias("final_surface_txt"),
        _pick(TARGET_ZONE_RAW, k % 6).alias("target_zone"),
        F.when(c % 3 == 0, F.lit("Pastizal")).otherwise(_pick(LOCAL_FUEL_NAMES, (c + k) % 26)).alias("initial_fuel"),
        zone_we.alias("zone_WE"),
        zone_ns.alias("zone_NS"),
        F.concat(zone_we, F.lit(" "), zone_ns).alias("zone_alert"),
    )


def dispatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "left")
    lk, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    nominal = _nominal_start(k, F.col("o_orderdate"))
    shift = F.when(lk % 10 == 0, F.lit(-60)).otherwise(F.lit(0))
    arribo = F.when(k % 71 != 0, F.timestamp_add("MINUTE", c % 45 + pk % 3 + shift, nominal))
    s = sk.cast("string")
    glosa_a = (F.when(pk % 4 == 0, F.concat(F.lit("H"), s))
                .when(pk % 4 == 1, F.concat(F.lit("A"), s))
                .when(pk % 4 == 2, F.concat(F.lit("B"), s, F.lit(" EXTRA")))
                .otherwise(F.concat(F.lit("X"), s)))
    glosa_b = (F.when(pk % 4 == 0, F.concat(F.lit("BHA-"), s, F.lit(" 1")))
                .when(pk % 4 == 1, F.concat(F.lit("AA"), s, F.lit(" - FOO")))
                .when(pk % 4 == 2, F.concat(F.lit("BA"), s, F.lit(" SUR")))
                .otherwise(F.concat(F.lit("Z"), s)))
    control = F.timestamp_add("MINUTE", F.lit(30), arribo)
    return j.select(
        F.when(pk % 97 == 0, lk + 200000000).otherwise(lk + 100000000).alias("fire_id"),
        F.col("l_linenumber").cast("bigint").alias("dispatch_id"),
        F.when(sk % 11 == 0, F.lit("ALARMA")).otherwise(F.lit("FOCO")).alias("report_type"),
        F.when(pk % 101 != 0, F.concat(F.lit("ZONA "), _pick(DISPATCH_ZONE_NAMES, sk % 5))).alias("zone"),
        F.when(lk % 2 == 0, glosa_a).otherwise(glosa_b).alias("glosa"),
        F.when(lk % 2 == 0, F.lit("despachos_a")).otherwise(F.lit("despachos_b")).alias("file_source"),
        F.timestamp_add("MINUTE", F.lit(-12), arribo).alias("hr_despacho"),
        F.timestamp_add("MINUTE", F.lit(-8), arribo).alias("hr_salida"),
        arribo.alias("hr_arribo"),
        F.when(sk % 13 == 0, F.lit("sin hora"))
         .otherwise(F.date_format(control, "yyyy-MM-dd HH:mm")).alias("hr_control"),
        F.timestamp_add("MINUTE", F.col("l_quantity").cast("bigint") * 3, arribo).alias("hr_extincion"),
        # scan order of the dispatch records (keep-first dedup key)
        F.col("l_shipdate").alias("seq_ship"), pk.alias("seq_part"),
        sk.alias("seq_supp"), F.col("l_quantity").alias("seq_qty"),
    )


def topo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.where(k % 13 != 0).select(
        (k + 100000000).alias("fire_id"),
        ((c % 1000).cast("double") * F.lit(1.5)).alias("elevation"),
        ((k % 45).cast("double") + F.lit(0.5)).alias("slope_degrees"),
        ((k * 7) % 360).cast("double").alias("aspect_degrees"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return o.where(k % 17 != 0).select(
        (k + 100000000).alias("fire_id"),
        F.when(k % 23 != 0, (c % 40).cast("double") - F.lit(2.0) + (k % 10).cast("double") / F.lit(10.0)).alias("temperature"),
        ((k % 120).cast("double") - F.lit(5.0)).alias("relative_humidity"),
        (((k * 13) % 400).cast("double") - F.lit(10.0)).alias("wind_direction"),
        F.when(k % 4 != 0, (c % 15).cast("double") * F.lit(0.7)).alias("wind_speed_ms"),
        F.when(k % 29 != 0, (k % 30).cast("double")).alias("wind_speed_knots"),
    )


def polygons(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """Zone layer ``(area, ring)``: a 3 x 5 grid of quadrilaterals with slanted
    west/east edges over lon [-74, -70], lat [-40, -34], plus one triangle
    overlapping the first zones (overlaps duplicate points, as in a spatial join)
    and one with a hole."""
    i = F.col("id")
    we, ns = (i % 3), (i / 3).cast("bigint")
    x_w = F.lit(-74.0) + we.cast("double") * F.lit(4.0 / 3.0) + F.lit(0.0013)
    x_e = x_w + F.lit(4.0 / 3.0)
    y_s = F.lit(-40.0) + ns.cast("double") * F.lit(1.2) + F.lit(0.0017)
    y_n = y_s + F.lit(1.2)
    tilt = F.lit(0.05)

    def pt(x, y):
        return F.struct(x.alias("x"), y.alias("y"))

    quads = spark.range(15).select(
        F.concat(_pick(ZONE_WE_LEVELS, we), F.lit(" "), (ns + 1).cast("string")).alias("area"),
        F.array(pt(x_w, y_s), pt(x_e, y_s), pt(x_e + tilt, y_n), pt(x_w + tilt, y_n)).alias("ring"),
    )
    tri = spark.range(1).select(
        F.concat(F.lit("Valle "), (F.col("id") + 2).cast("string")).alias("area"),   # "Valle 2"
        F.array(pt(F.lit(-73.9), F.lit(-39.9)), pt(F.lit(-72.3), F.lit(-39.5)),
                pt(F.lit(-73.2), F.lit(-38.1))).alias("ring"),
    )
    hole = F.array(pt(F.lit(-72.0), F.lit(-36.9)), pt(F.lit(-71.1), F.lit(-36.9)), pt(F.lit(-71.5), F.lit(-36.1)))
    holed = spark.range(1).select(
        F.concat(_pick(ZONE_WE_LEVELS, F.col("id") + 2), F.lit(" 3")).alias("area"),
        F.array(pt(F.lit(-72.5), F.lit(-37.3)), pt(F.lit(-70.8), F.lit(-37.2)), pt(F.lit(-71.4), F.lit(-35.5))).alias("ring"),
        F.array(hole).alias("holes"))
    return quads.unionByName(tri).unionByName(holed, allowMissingColumns=True)


def fuel_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell table ``(row, col, value)``; codes 1..31, 999, nodata -9999."""
    p = table(spark, sf_dir, "part")
    pk, size = F.col("p_partkey"), F.col("p_size")
    return p.select(
        (pk / FUEL_NCOLS).cast("bigint").alias("row"),
        (pk % FUEL_NCOLS).alias("col"),
        F.when(size == 50, F.lit(FUEL_NODATA))
         .when(size % 17 == 0, F.lit(999.0))
         .otherwise(((size - 1) % 31 + 1).cast("double")).alias("value"),
    )


def dem_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    cu = table(spark, sf_dir, "customer")
    ck = F.col("c_custkey")
    return cu.select(
        (ck / DEM_NCOLS).cast("bigint").alias("row"),
        (ck % DEM_NCOLS).alias("col"),
        F.col("c_acctbal").cast("double").alias("value"),
    )
