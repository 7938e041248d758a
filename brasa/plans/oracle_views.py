"""DuckDB SQL for the derived input views (same rules as brasa.sources.derived).

Used only to build the ``oracle_sql()`` strings the driver runs on DuckDB.
"""

from __future__ import annotations

from brasa.functions.lookups import ZONE_WE_LEVELS
from brasa.sources.derived import (
    DISPATCH_ZONE_NAMES, LOCAL_FUEL_NAMES, TARGET_ZONE_RAW,
    FUEL_NCOLS, FUEL_NODATA, DEM_NCOLS,
)


def _lst(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


VIEWS: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}

VIEWS["fires"] = f"""
SELECT
  CASE WHEN o_orderkey % 53 = 7 THEN o_orderkey ELSE o_orderkey + 100000000 END AS fire_id,
  CASE WHEN year(o_orderdate) < 1998 THEN 'incendios_1995-1997' ELSE 'incendios_1998-2001' END AS file_source,
  CAST(year(o_orderdate) AS BIGINT) AS season,
  CASE WHEN o_orderkey % 71 = 0 THEN 'sin dato'
       WHEN o_orderkey % 67 = 0 THEN strftime(o_orderdate + to_minutes(o_orderkey % 1440), '%Y-%m-%d %H:%M') || ':00'
       WHEN o_orderkey % 61 = 0 THEN ' ' || strftime(o_orderdate + to_minutes(o_orderkey % 1440), '%Y-%m-%d %H:%M') || ' '
       ELSE strftime(o_orderdate + to_minutes(o_orderkey % 1440), '%Y-%m-%d %H:%M') END AS start_text,
  CASE WHEN o_orderkey % 71 <> 0 THEN o_orderdate + to_minutes(o_orderkey % 1440) END AS start_datetime,
  CASE WHEN o_orderkey % 59 <> 0 THEN o_orderdate + to_minutes(o_orderkey % 1440) + to_minutes(o_custkey % 45) END AS arrival_datetime_inc,
  CASE WHEN o_orderkey % 59 <> 0 THEN o_orderdate + to_minutes(o_orderkey % 1440) + to_minutes(o_custkey % 45) + to_minutes(o_custkey % 60 + 30) END AS control_datetime,
  -40.0::DOUBLE + CAST(o_orderkey % 600 AS DOUBLE) / 100.0::DOUBLE AS latitude,
  -74.0::DOUBLE + CAST(o_custkey % 400 AS DOUBLE) / 100.0::DOUBLE AS longitude,
  o_totalprice / 1e6::DOUBLE AS initial_surface_ha,
  CASE WHEN o_orderkey % 89 = 0 THEN (o_totalprice / 1e6::DOUBLE) / 2.0::DOUBLE
       ELSE (o_totalprice / 1e6::DOUBLE) * CAST(o_custkey % 7 + 1 AS DOUBLE) END AS final_surface_ha,
  (CASE WHEN o_orderkey % 97 = 0 THEN '-' ELSE '' END)
    || CAST(CAST(floor(o_totalprice) AS BIGINT) // 1000 AS VARCHAR) || '.'
    || lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0') || ','
    || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') AS initial_surface_txt,
  CAST((CAST(floor(o_totalprice) AS BIGINT) * (o_custkey % 7 + 1)) // 1000 AS VARCHAR) || '.'
    || lpad(CAST((CAST(floor(o_totalprice) AS BIGINT) * (o_custkey % 7 + 1)) % 1000 AS VARCHAR), 3, '0') || ','
    || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0')
    || (CASE WHEN o_orderkey % 3 = 0 THEN ' m2' ELSE '' END) AS final_surface_txt,
  {_lst(TARGET_ZONE_RAW)}[o_orderkey % 6 + 1] AS target_zone,
  CASE WHEN o_custkey % 3 = 0 THEN 'Pastizal' ELSE {_lst(LOCAL_FUEL_NAMES)}[(o_custkey + o_orderkey) % 26 + 1] END AS initial_fuel,
  {_lst(ZONE_WE_LEVELS)}[o_custkey % 3 + 1] AS "zone_WE",
  CAST(o_orderkey % 5 + 1 AS VARCHAR) AS "zone_NS",
  {_lst(ZONE_WE_LEVELS)}[o_custkey % 3 + 1] || ' ' || CAST(o_orderkey % 5 + 1 AS VARCHAR) AS zone_alert
FROM orders
"""
DEPS["fires"] = []

VIEWS["dispatches"] = f"""
SELECT
  CASE WHEN l_partkey % 97 = 0 THEN l_orderkey + 200000000 ELSE l_orderkey + 100000000 END AS fire_id,
  CAST(l_linenumber AS BIGINT) AS dispatch_id,
  CASE WHEN l_suppkey % 11 = 0 THEN 'ALARMA' ELSE 'FOCO' END AS report_type,
  CASE WHEN l_partkey % 101 <> 0 THEN 'ZONA ' || {_lst(DISPATCH_ZONE_NAMES)}[l_suppkey % 5 + 1] END AS zone,
  CASE WHEN l_orderkey % 2 = 0 THEN
    CASE l_partkey % 4 WHEN 0 THEN 'H' || CAST(l_suppkey AS VARCHAR)
                       WHEN 1 THEN 'A' || CAST(l_suppkey AS VARCHAR)
                       WHEN 2 THEN 'B' || CAST(l_suppkey AS VARCHAR) || ' EXTRA'
                       ELSE 'X' || CAST(l_suppkey AS VARCHAR) END
  ELSE
    CASE l_partkey % 4 WHEN 0 THEN 'BHA-' || CAST(l_suppkey AS VARCHAR) || ' 1'
                       WHEN 1 THEN 'AA' || CAST(l_suppkey AS VARCHAR) || ' - FOO'
                       WHEN 2 THEN 'BA' || CAST(l_suppkey AS VARCHAR) || ' SUR'
                       ELSE 'Z' || CAST(l_suppkey AS VARCHAR) END
  END AS glosa,
  CASE WHEN l_orderkey % 2 = 0 THEN 'despachos_a' ELSE 'despachos_b' END AS file_source,
  arribo - to_minutes(12) AS hr_despacho,
  arribo - to_minutes(8) AS hr_salida,
  arribo AS hr_arribo,
  CASE WHEN l_suppkey % 13 = 0 THEN 'sin hora' ELSE strftime(arribo + to_minutes(30), '%Y-%m-%d %H:%M') END AS hr_control,
  arribo + to_minutes(CAST(l_quantity AS BIGINT) * 3) AS hr_extincion,
  l_shipdate AS seq_ship, l_partkey AS seq_part, l_suppkey AS seq_supp, l_quantity AS seq_qty
FROM (
  SELECT l.*,
    CASE WHEN o.o_orderkey % 71 <> 0 THEN o.o_orderdate + to_minutes(o.o_orderkey % 1440)
         + to_minutes(o.o_custkey % 45 + l.l_partkey % 3 + CASE WHEN l.l_orderkey % 10 = 0 THEN -60 ELSE 0 END) END AS arribo
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
) li
"""
DEPS["dispatches"] = []

VIEWS["topo"] = """
SELECT o_orderkey + 100000000 AS fire_id,
       CAST(o_custkey % 1000 AS DOUBLE) * 1.5::DOUBLE AS elevation,
       CAST(o_orderkey % 45 AS DOUBLE) + 0.5::DOUBLE AS slope_degrees,
       CAST((o_orderkey * 7) % 360 AS DOUBLE) AS aspect_degrees
FROM orders WHERE o_orderkey % 13 <> 0
"""
DEPS["topo"] = []

VIEWS["weather"] = """
SELECT o_orderkey + 100000000 AS fire_id,
       CASE WHEN o_orderkey % 23 <> 0 THEN CAST(o_custkey % 40 AS DOUBLE) - 2.0::DOUBLE + CAST(o_orderkey % 10 AS DOUBLE) / 10.0::DOUBLE END AS temperature,
       CAST(o_orderkey % 120 AS DOUBLE) - 5.0::DOUBLE AS relative_humidity,
       CAST((o_orderkey * 13) % 400 AS DOUBLE) - 10.0::DOUBLE AS wind_direction,
       CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey % 15 AS DOUBLE) * 0.7::DOUBLE END AS wind_speed_ms,
       CASE WHEN o_orderkey % 29 <> 0 THEN CAST(o_orderkey % 30 AS DOUBLE) END AS wind_speed_knots
FROM orders WHERE o_orderkey % 17 <> 0
"""
DEPS["weather"] = []

# polygon edges (area, poly, x1, y1, x2, y2): the same quadrilaterals as the Spark layer
VIEWS["poly_vertices"] = f"""
SELECT area, poly, 0 AS ring, vi, x, y FROM (
  SELECT {_lst(ZONE_WE_LEVELS)}[i % 3 + 1] || ' ' || CAST(i // 3 + 1 AS VARCHAR) AS area, i AS poly,
         -74.0::DOUBLE + CAST(i % 3 AS DOUBLE) * (4.0::DOUBLE / 3.0::DOUBLE) + 0.0013::DOUBLE AS xw,
         -40.0::DOUBLE + CAST(i // 3 AS DOUBLE) * 1.2::DOUBLE + 0.0017::DOUBLE AS ys
  FROM (SELECT range AS i FROM range(15)) r
) q, LATERAL (VALUES
  (0, xw, ys),
  (1, xw + 4.0::DOUBLE / 3.0::DOUBLE, ys),
  (2, xw + 4.0::DOUBLE / 3.0::DOUBLE + 0.05::DOUBLE, ys + 1.2::DOUBLE),
  (3, xw + 0.05::DOUBLE, ys + 1.2::DOUBLE)) v(vi, x, y)
UNION ALL
SELECT 'Valle 2', 15, 0, vi, x, y FROM (VALUES (0, -73.9::DOUBLE, -39.9::DOUBLE), (1, -72.3::DOUBLE, -39.5::DOUBLE), (2, -73.2::DOUBLE, -38.1::DOUBLE)) t(vi, x, y)
UNION ALL
SELECT {_lst(ZONE_WE_LEVELS)}[3] || ' 3', 16, ring, vi, x, y FROM (VALUES
  (0, 0, -72.5::DOUBLE, -37.3::DOUBLE), (0, 1, -70.8::DOUBLE, -37.2::DOUBLE), (0, 2, -71.4::DOUBLE, -35.5::DOUBLE),
  (1, 0, -72.0::DOUBLE, -36.9::DOUBLE), (1, 1, -71.1::DOUBLE, -36.9::DOUBLE), (1, 2, -71.5::DOUBLE, -36.1::DOUBLE)) h(ring, vi, x, y)
"""
DEPS["poly_vertices"] = []

VIEWS["poly_edges"] = """
SELECT a.area, a.poly, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
FROM poly_vertices a
JOIN (SELECT poly, ring, max(vi) + 1 AS nv FROM poly_vertices GROUP BY poly, ring) m ON a.poly = m.poly AND a.ring = m.ring
JOIN poly_vertices b ON b.poly = a.poly AND b.ring = a.ring AND b.vi = (a.vi + 1) % m.nv
"""
DEPS["poly_edges"] = ["poly_vertices"]

VIEWS["fuel_raster"] = f"""
SELECT p_partkey // {FUEL_NCOLS} AS "row", p_partkey % {FUEL_NCOLS} AS col,
       CASE WHEN p_size = 50 THEN {FUEL_NODATA}::DOUBLE
            WHEN p_size % 17 = 0 THEN 999.0::DOUBLE
            ELSE CAST((p_size - 1) % 31 + 1 AS DOUBLE) END AS value
FROM part
"""
DEPS["fuel_raster"] = []

VIEWS["dem_raster"] = f"""
SELECT c_custkey // {DEM_NCOLS} AS "row", c_custkey % {DEM_NCOLS} AS col, CAST(c_acctbal AS DOUBLE) AS value
FROM customer
"""
DEPS["dem_raster"] = []


def with_views(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first)."""
    order: list[str] = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in order)
    return f"WITH {ctes}\n{body.strip()}"


def add_view(name: str, sql: str, deps=()) -> None:
    VIEWS[name] = sql
    DEPS[name] = list(deps)
