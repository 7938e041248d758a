"""Hierarchical polygon cover against ray casting of every point in every polygon."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brasa.operators import geo

RING = "array<struct<x:double,y:double>>"


def layer(spark, rows):
    return spark.createDataFrame([(a, [tuple(map(float, p)) for p in r], h) for a, r, h in rows],
                                 f"area string, ring {RING}, holes array<{RING}>")


def within(x, y, ring, holes):
    inside = False
    for r in [ring, *(holes or [])]:
        for (x1, y1), (x2, y2) in zip(r, [*r[1:], r[0]]):
            if ((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) == 0 and min(x1, x2) <= x <= max(x1, x2)
                    and min(y1, y2) <= y <= max(y1, y2)):
                return False
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


def polygons():
    rng = np.random.default_rng(4)
    out = []
    for i in range(12):  # small star-shaped ones
        cx, cy = rng.uniform(-70, -69), rng.uniform(-40, -39)
        n = int(rng.integers(3, 9))
        r = rng.uniform(0.02, 0.1, n)
        out.append((f"s{i}", [(cx + r[k] * math.cos(2 * math.pi * k / n), cy + r[k] * math.sin(2 * math.pi * k / n))
                              for k in range(n)], None))
    # one 1000 times as long, one with many edges and a hole, and a square on cell bounds
    out.append(("long", [(-110.0, -60.0), (-10.0, -20.0), (-10.0, -20.03), (-110.0, -60.05)], None))
    wave = [(-70 + 0.4 * math.cos(t) * (1 + 0.2 * math.sin(40 * t)), -39.5 + 0.4 * math.sin(t) * (1 + 0.2 * math.sin(40 * t)))
            for t in np.linspace(0, 2 * math.pi, 900, endpoint=False)]
    out.append(("wave", wave, [[(-70.1, -39.6), (-69.9, -39.6), (-70.0, -39.4)]]))
    out.append(("square", [(-72.0, -40.0), (-71.0, -40.0), (-71.0, -39.0), (-72.0, -39.0)], None))
    return out


def test_cover_equals_ray_casting(spark):
    rng = np.random.default_rng(1)
    shapes = polygons()
    pts = list(zip(rng.uniform(-72.2, -68.8, 3000), rng.uniform(-40.2, -38.8, 3000)))
    t = rng.uniform(0, 1, 600)
    pts += [(-110 + 100 * a, -60 + 40 * a + d) for a, d in zip(t, rng.uniform(-0.06, 0.03, 600))]
    pts += [p for _, r, _ in shapes for p in r]                      # vertices
    pts += [(-71.5, -40.0), (-72.0, -39.5), (-71.5, -39.5), (-70.0, -39.5), (-71.0, -39.0)]
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "id long, longitude double, latitude double")
    out = geo.add_zones(df, layer(spark, shapes)).select("id", "zone_alert").collect()
    want = sorted((i, a) for i, (x, y) in enumerate(pts) for a, r, h in shapes if within(float(x), float(y), r, h))
    assert sorted(map(tuple, out)) == want and len({a for _, a in want}) == len(shapes)


def test_cover_follows_each_polygon_at_its_own_scale(spark):
    cover = geo.polygon_cover(layer(spark, polygons())).cache()
    n = {r.area: r["count"] for r in cover.groupBy(F.col("_zone").alias("area")).count().collect()}
    assert n["long"] < 3000 and n["square"] < 3000 and max(n.values()) < 6000
    assert cover.where("_in").count() > 200
    area = cover.where("_zone = 'square'").agg(F.sum(F.pow(F.lit(64.0), F.col("k")))).first()[0]
    assert 1.0 <= area < 1.3                                          # the square's area and a rim
    # edges of a border cell are few where the outline has many
    assert cover.where("_zone = 'wave' and not _in").agg(F.expr("percentile(size(_edges), 0.5)")).first()[0] < 200


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_broadcast_follows_measured_size(spark, monkeypatch, limit):
    monkeypatch.setattr(geo, "BROADCAST_BYTES", limit)
    df = spark.createDataFrame([(1, -71.5, -39.5), (2, 0.0, 0.0), (3, None, -39.5), (4, float("nan"), 1.0)],
                               "id long, longitude double, latitude double")
    assert [tuple(r) for r in geo.add_zones(df, layer(spark, polygons())).select("id", "zone_alert").collect()] == [(1, "square")]


def test_layers_without_shape(spark):
    df = spark.createDataFrame([(1, -71.5, -39.5)], "id long, longitude double, latitude double")
    none = spark.createDataFrame([("a", None), ("b", []), ("c", [(1.0, 1.0)])], f"area string, ring {RING}")
    assert geo.add_zones(df, none).count() == 0 and geo.add_zones(df, none.limit(0)).count() == 0
