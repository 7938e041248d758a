"""Embedding near-dedup by an epsilon grid order join.

For unit vectors a cosine of at least t is a distance of at most
eps = sqrt(2 - 2 t), and no projection on orthonormal axes makes a distance
longer. Equal vectors first collapse to one row with a count. The rest are
laid out in grid order: cells of side eps on the ``AXES`` leading principal
dimensions (fitted by Spark ML over all vectors of the commonest length),
compared cell by cell, ties by the vector. The sequence is cut into blocks of
``BLOCK`` vectors and the blocks into intervals of ``FAN`` blocks, of ``FAN``
intervals and so on; each interval knows the bounds of its coordinates.

The join starts with the whole sequence against itself and goes down the
intervals level by level, as equi-joins on the parent, keeping only pairs
whose bounds come within eps of each other. A pair of blocks that is left is
joined in one task by the same recursion over tiles of ``TILE`` vectors, and
two tiles that are not provably distant get the cosine of each pair in double
precision. From a pair of blocks come a link count per vector and a spanning
forest of its links, never the pairs, so a group of near copies yields as many
rows as it has vectors. Components come from distributed star contraction.

The work is that of all pairs where nothing is provably distant (isotropic
vectors in many dimensions); memory is two blocks a task at any size.

Defined results: a null or empty vector, a zero vector and one with null or
non-finite components link with nothing (0 links, a component of their own);
vectors of different lengths are never linked; rows without a vec_id take part
but never name a component (a component of only such rows has a null id);
repeated rows are rows of their own that link with each other; an empty table
gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brasa.session import cut_and_count, cut_lineage

from .common import connected_components, table

THRESHOLD = 0.9
AXES = 16
BLOCK = 8192
TILE = 512
FAN = 8
#: Room for rounding in every "provably distant".
SLACK = 1e-6


def usable(v: Column) -> Column:
    """Whether a vector has a direction."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def leading_axes(vectors: DataFrame) -> np.ndarray | None:
    """Principal axes (length x AXES) of the commonest vector length (None: fewer than two vectors of it).

    Only the axes reach the driver; a vector of another length keeps its own first coordinates.
    """
    top = (vectors.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), "length").first())
    if top is None or top["count"] < 2:
        return None
    x = vectors.where(F.size("v") == top.length).select(array_to_vector(F.col("v").cast("array<double>")).alias("x"))
    x = Normalizer(p=2.0, inputCol="x", outputCol="u").transform(x)
    return PCA(k=min(AXES, top.length), inputCol="u", outputCol="p").fit(x).pc.toArray()


def _coordinates(x: np.ndarray, axes: np.ndarray | None) -> np.ndarray:
    """Length of the vector, then its coordinates on the axes (zeros beyond the last): lengths never come close."""
    out = np.zeros((len(x), 1 + AXES))
    out[:, 0] = x.shape[1]
    p = x @ axes if axes is not None and len(axes) == x.shape[1] else x[:, :AXES]
    out[:, 1:1 + p.shape[1]] = p
    return out


def _placed(axes: np.ndarray | None, eps: float):
    def run(batches):
        for pdf in batches:
            for _, part in pdf.groupby(pdf["v"].map(len)):
                p = _coordinates(unit(np.stack(part["v"].to_list())), axes)
                cells = np.floor(p / max(eps, 1e-3)).astype(np.int64)
                yield part.assign(cells=list(cells), p=list(p))
    return run


def _packed(width: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        p = np.stack(pdf["p"].to_list())
        v = np.stack(pdf["v"].to_list()).astype(width)
        return pd.DataFrame([(int(pdf["place"].iloc[0]), len(pdf), v.tobytes(), p.tobytes(),
                              pdf["n"].to_numpy(np.int64).tobytes(), p.min(axis=0), p.max(axis=0))],
                            columns=["id", "size", "v", "p", "n", "lo", "hi"])
    return run


def _apart(a: str, b: str) -> Column:
    """Squared distance between the bounds of two intervals."""
    gap = F.zip_with(F.zip_with(f"{a}_lo", f"{b}_hi", lambda x, y: x - y), F.zip_with(f"{b}_lo", f"{a}_hi", lambda x, y: x - y),
                     lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x)


def close_blocks(blocks: DataFrame, n_blocks: int, eps: float) -> DataFrame:
    """Pairs ``a <= b`` of blocks that are not provably distant, found from the whole sequence downwards."""
    bounds = lambda f, c: F.array(*[f(F.col(c)[i]) for i in range(1 + AXES)]).alias(c)
    levels = [blocks.select("id", F.expr(f"id div {BLOCK * FAN}").alias("up"), "lo", "hi")]
    left = n_blocks
    while left > 1 or len(levels) == 1:
        level = levels[-1].groupBy(F.col("up").alias("id")).agg(bounds(F.min, "lo"), bounds(F.max, "hi"))
        levels.append(cut_lineage(level.select("id", F.expr(f"id div {FAN}").alias("up"), "lo", "hi")))
        left = -(-left // FAN)
    pairs = levels[-1].select(F.col("id").alias("a"), F.col("id").alias("b"))
    for level in reversed(levels[:-1]):
        side = lambda s: level.select(F.col("up").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("id", "lo", "hi")])  # noqa: E731,B023
        pairs = cut_lineage(pairs.join(side("a"), "a").join(side("b"), "b")
                            .where((F.col("a_id") <= F.col("b_id")) & (_apart("a", "b") <= eps * eps + SLACK))
                            .select(F.col("a_id").alias("a"), F.col("b_id").alias("b")))
    return pairs


class Block:
    def __init__(self, v: bytes, p: bytes, n: bytes, size: int, width: str):
        self.x = unit(np.frombuffer(v, width).reshape(size, -1))
        self.p = np.frombuffer(p).reshape(size, -1)
        self.n = np.frombuffer(n, np.int64).astype(np.float64)
        starts = np.arange(0, size, TILE)
        self.tiles = len(starts)
        self.lo, self.hi = np.minimum.reduceat(self.p, starts), np.maximum.reduceat(self.p, starts)


def close_tiles(a: Block, b: Block, eps: float, same: bool):
    """Pairs of tiles that are not provably distant, by halving both intervals."""
    todo = [(0, a.tiles, 0, b.tiles)]
    while todo:
        i, j, k, m = todo.pop()
        if same and m <= i:
            continue
        gap = np.maximum(0, np.maximum(a.lo[i:j].min(0) - b.hi[k:m].max(0), b.lo[k:m].min(0) - a.hi[i:j].max(0)))
        if gap @ gap > eps * eps + SLACK:
            continue
        if j - i == 1 and m - k == 1:
            yield i, k
        elif j - i >= m - k:
            todo += [(i, (i + j) // 2, k, m), ((i + j) // 2, j, k, m)]
        else:
            todo += [(i, j, k, (k + m) // 2), (i, j, (k + m) // 2, m)]


def _contract(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the trees of the linked places a and b in ``root``."""
    while len(a):
        ra, rb = root[a], root[b]
        live = ra != rb
        if not live.any():
            return
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (root[root] != root).any():
            root[:] = root[root]


def join_blocks(a: Block, b: Block, threshold: float, eps: float, same: bool):
    """Linked rows per vector of both blocks (copies counted) and the roots of the forest over both."""
    na, nb = len(a.x), len(b.x)
    links, root = np.zeros(na + nb), np.arange(na + nb)
    for i, k in close_tiles(a, b, eps, same):
        if same and k < i:
            continue
        rows, cols = slice(i * TILE, min(na, (i + 1) * TILE)), slice(k * TILE, min(nb, (k + 1) * TILE))
        near = a.x[rows] @ b.x[cols].T >= threshold
        if same and i == k:
            np.fill_diagonal(near, False)
        x, y = np.nonzero(near)
        if not len(x):
            continue
        x, y = x + rows.start, y + cols.start
        links[:na] += np.bincount(x, b.n[y], na)
        if not (same and i == k):
            links[0 if same else na:][:nb] += np.bincount(y, a.n[x], nb)
        _contract(root, x, y if same else y + na)
    return links, root


def _joined(threshold: float, eps: float, width: str):
    def run(batches):
        for pdf in batches:
            for t in pdf.itertuples(index=False):
                a = Block(t.a_v, t.a_p, t.a_n, t.a_size, width)
                same = t.a == t.b
                b = a if same else Block(t.b_v, t.b_p, t.b_n, t.b_size, width)
                links, root = join_blocks(a, b, threshold, eps, same)
                places = np.concatenate([t.a + np.arange(t.a_size), t.b + np.arange(t.b_size)])
                some, child = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(root)))
                yield pd.DataFrame({
                    "place": np.concatenate([places[some], places[child]]),
                    "other": pd.array(np.concatenate([places[some], places[root[child]]]), "Int64"),
                    "n": np.concatenate([links[some].astype(np.int64), np.zeros(len(child), np.int64)])})
    return run


def near_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                 threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``df``."""
    eps = math.sqrt(max(0.0, 2 - 2 * threshold))
    narrow = df.schema[embedding].dataType.simpleString() == "array<float>"
    width = "<f4" if narrow else "<f8"
    v = F.col(embedding).cast("array<float>" if narrow else "array<double>")
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.when(usable(v), v).alias("v"))
    vectors = cut_lineage(rows.where("v is not null").groupBy("v")
                          .agg(F.count("*").alias("n"), F.min("vec_id").alias("first_id")))
    array = "array<float>" if narrow else "array<double>"
    placed = vectors.mapInPandas(_placed(leading_axes(vectors), eps),
                                 f"v {array}, n long, first_id long, cells array<long>, p array<double>")
    # the id holds the partition of the sorted table and the place in it
    ordered, total = cut_and_count(placed.orderBy(F.size("v"), "cells", "v").withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = ordered.groupBy(part.alias("part")).count().select(
        "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    sequence = ordered.withColumn("part", part).join(offsets, "part").select(
        (F.col("at") - F.shiftleft("part", 33) + F.col("offset")).alias("place"), "v", "n", "first_id", "p")
    blocks = cut_lineage(sequence.groupBy(F.expr(f"place div {BLOCK}"), F.size("v")).applyInPandas(
        _packed(width), "id long, size int, v binary, p binary, n binary, lo array<double>, hi array<double>"))

    pairs = close_blocks(blocks, -(-total // BLOCK), eps)
    # the side by which a pair is dealt alternates, so that each block is met about as often
    turn = F.expr(f"(a div {BLOCK} + b div {BLOCK}) % 2 = 1")
    pairs = pairs.select(F.when(turn, F.col("b")).otherwise(F.col("a")).alias("a"),
                         F.when(turn, F.col("a")).otherwise(F.col("b")).alias("b"))
    side = lambda s: blocks.select(F.col("id").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("size", "v", "p", "n")])
    found = cut_lineage(pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(
        _joined(threshold, eps, width), "place long, other long, n long"))
    links = found.where("n > 0").groupBy("place").agg(F.sum("n").alias("links"))
    comps = connected_components(found.where("n = 0").select(F.col("place").alias("a"), F.col("other").alias("b")))
    named = (sequence.join(links, "place", "left").join(comps.withColumnRenamed("node", "place"), "place", "left")
             .select("v", "first_id", F.coalesce("root", "place").alias("root"),
                     (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")))
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(names, "root").select("v", "links", "component_id")
    component = F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (rows.join(named, "v", "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def query(spark, sf_dir) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def oracle(vectors: str = "embeddings") -> str:
    """DuckDB SQL of :func:`query` (vec_ids unique): all pairs by plain sums, components by recursion."""
    return f"""
WITH RECURSIVE d AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM {vectors}),
u AS (SELECT vec_id, list_transform(v, lambda x: coalesce(x, 0)) AS v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS len FROM d
      WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v)
        AND len(list_filter(v, lambda x: x <> 0)) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      AND list_dot_product(a.v, b.v) / (a.len * b.len) >= {THRESHOLD}),
r AS (SELECT vec_id AS a, vec_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM e GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)"""
