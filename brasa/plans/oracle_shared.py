"""Shared DuckDB CTEs for the oracle SQL (features, post-processing, base model)."""

from __future__ import annotations

import math

from brasa.functions.lookups import FUEL_CODE_LABELS, LOCAL_FUEL_LABELS
from brasa.plans.oracle_views import add_view

TWO_PI_24 = repr(2 * math.pi / 24)
TWO_PI_12 = repr(2 * math.pi / 12)


def _s(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


LOCAL_FUEL_VALUES = ", ".join(f"({_s(k)}, {_s(v)})" for k, v in LOCAL_FUEL_LABELS.items())
FUEL_CODE_VALUES = ", ".join(f"({k}, {_s(v)})" for k, v in FUEL_CODE_LABELS.items())

add_view("local_fuel", f"SELECT * FROM (VALUES {LOCAL_FUEL_VALUES}) t(name, label)")
add_view("fuel_codes", f"SELECT * FROM (VALUES {FUEL_CODE_VALUES}) t(code, label)")

DT = "CAST(date_diff('microsecond', f.start_datetime, f.arrival_datetime_inc) AS DOUBLE) / 60000000.0::DOUBLE"
M2 = "f.initial_surface_ha * 10000.0::DOUBLE"
RADIUS = f"CASE WHEN {M2} >= 0 THEN sqrt({M2} / pi()) END"


def speed_sql(r: str, dt: str) -> str:
    return (f"CASE WHEN ({r}) IS NULL OR ({dt}) IS NULL THEN NULL WHEN ({dt}) <> 0 THEN ({r}) / ({dt}) "
            f"WHEN ({r}) > 0 THEN 'Infinity'::DOUBLE WHEN ({r}) < 0 THEN '-Infinity'::DOUBLE END")


add_view("wx", """
SELECT fire_id, temperature,
  CASE WHEN relative_humidity BETWEEN 0.0 AND 100.0 THEN relative_humidity END AS relative_humidity,
  CASE WHEN NOT (wind_direction < 0.0 OR wind_direction > 360.0) THEN wind_direction END AS wind_direction,
  coalesce(wind_speed_ms, 0.51445::DOUBLE * wind_speed_knots) * 60.0::DOUBLE AS wind_speed_mm,
  coalesce(wind_speed_ms, 0.51445::DOUBLE * wind_speed_knots) * 3.6::DOUBLE AS wind_speed_kmh
FROM weather
""", ["weather"])

add_view("features", f"""
SELECT fire_id, longitude, latitude, start_datetime, "zone_WE", "zone_NS", temperature, wind_speed_kmh,
       relative_humidity, slope_degrees, sin_hour, cos_hour, initial_fuel, diurnal_nocturnal, high_season,
       propagation_speed_mm, dt_minutes, initial_radius_m, zone_alert, hour
FROM (
  SELECT f.fire_id, f.longitude, f.latitude, f.start_datetime, f."zone_WE", f."zone_NS",
    w.temperature, w.wind_speed_kmh, w.relative_humidity, t.slope_degrees,
    sin(CAST(hour(f.start_datetime) AS DOUBLE) * {TWO_PI_24}::DOUBLE) AS sin_hour,
    cos(CAST(hour(f.start_datetime) AS DOUBLE) * {TWO_PI_24}::DOUBLE) AS cos_hour,
    lf.label AS initial_fuel,
    CASE WHEN hour(f.start_datetime) >= 3 AND hour(f.start_datetime) < 18 THEN 'diurnal' ELSE 'nocturnal' END AS diurnal_nocturnal,
    CASE WHEN month(f.start_datetime) * 100 + day(f.start_datetime) >= 1215
           OR month(f.start_datetime) * 100 + day(f.start_datetime) <= 315 THEN 'high' ELSE 'low' END AS high_season,
    {speed_sql(RADIUS, DT)} AS propagation_speed_mm,
    {DT} AS dt_minutes, {RADIUS} AS initial_radius_m, f.zone_alert,
    CAST(hour(f.start_datetime) AS INTEGER) AS hour, {M2} AS m2
  FROM fires f LEFT JOIN topo t USING (fire_id) LEFT JOIN wx w USING (fire_id)
  LEFT JOIN local_fuel lf ON lf.name = f.initial_fuel
) x
WHERE m2 < (SELECT quantile_cont(f.initial_surface_ha * 10000.0::DOUBLE, 0.99) FROM fires f)
""", ["fires", "topo", "wx", "local_fuel"])

# P3 up to the fuel reduction (min 15 per zone x fuel)
add_view("post_base", """
SELECT * FROM features
WHERE dt_minutes BETWEEN 10 AND 30 AND initial_radius_m BETWEEN 2 AND 100
  AND "zone_WE" IS NOT NULL AND "zone_NS" IS NOT NULL
  AND zone_alert IN (SELECT zone_alert FROM features
                     WHERE dt_minutes BETWEEN 10 AND 30 AND initial_radius_m BETWEEN 2 AND 100
                       AND "zone_WE" IS NOT NULL AND "zone_NS" IS NOT NULL AND zone_alert IS NOT NULL
                     GROUP BY zone_alert HAVING count(*) > 5)
  AND fire_id IS NOT NULL AND longitude IS NOT NULL AND latitude IS NOT NULL AND start_datetime IS NOT NULL
  AND temperature IS NOT NULL AND wind_speed_kmh IS NOT NULL AND relative_humidity IS NOT NULL
  AND slope_degrees IS NOT NULL AND sin_hour IS NOT NULL AND cos_hour IS NOT NULL AND initial_fuel IS NOT NULL
  AND diurnal_nocturnal IS NOT NULL AND high_season IS NOT NULL AND propagation_speed_mm IS NOT NULL
  AND zone_alert IS NOT NULL AND hour IS NOT NULL
""", ["features"])

add_view("post_reduced", """
SELECT p.*, CASE WHEN c.n < 15 THEN 'other' ELSE p.initial_fuel END AS initial_fuel_reduced
FROM post_base p JOIN (SELECT "zone_WE", "zone_NS", initial_fuel, count(*) AS n FROM post_base GROUP BY ALL) c
  USING ("zone_WE", "zone_NS", initial_fuel)
""", ["post_base"])

add_view("post", """
SELECT * EXCLUDE (rk, n, n_test, n_val),
  CASE WHEN rk < n_test THEN 'test' WHEN rk < n_test + n_val THEN 'valid' ELSE 'train' END AS split3,
  CASE WHEN rk < n_test THEN 'test' ELSE 'train+valid' END AS split2
FROM (
  SELECT *, ceil(0.2::DOUBLE * CAST(n AS DOUBLE)) AS n_test,
         ceil(0.25::DOUBLE * (CAST(n AS DOUBLE) - ceil(0.2::DOUBLE * CAST(n AS DOUBLE)))) AS n_val
  FROM (SELECT *, row_number() OVER (PARTITION BY zone_alert ORDER BY md5('42:' || CAST(fire_id AS VARCHAR)), fire_id) - 1 AS rk,
               count(*) OVER (PARTITION BY zone_alert) AS n
        FROM post_reduced) a
) b
""", ["post_reduced"])

add_view("based", """
SELECT p.*, m.prediction_base, q.lo_base, q.hi_base
FROM post p
JOIN (SELECT "zone_WE", "zone_NS", avg(propagation_speed_mm) AS prediction_base FROM post GROUP BY ALL) m USING ("zone_WE", "zone_NS")
JOIN (SELECT "zone_WE", "zone_NS", quantile_cont(r, 0.1) AS lo_base, quantile_cont(r, 0.9) AS hi_base
      FROM (SELECT p2."zone_WE", p2."zone_NS", p2.propagation_speed_mm - m2.mu AS r
            FROM post p2 JOIN (SELECT "zone_WE", "zone_NS", avg(propagation_speed_mm) AS mu FROM post GROUP BY ALL) m2
            USING ("zone_WE", "zone_NS")) z GROUP BY ALL) q USING ("zone_WE", "zone_NS")
""", ["post"])
