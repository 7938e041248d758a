"""Exact per-feature contributions of per-zone tree ensembles (M5).

Each zone's fitted ensemble is saved to the shared checkpoint folder, its
node table read back (bounded: trees x nodes) and broadcast; contributions
are computed per Arrow batch in ``mapInPandas``.

A contribution is the Shapley value of the game whose players are the
covariates and whose value for a set of them is the tree's expectation when
only those are known: a split on a known covariate is followed, any other one
is averaged by the rows each side had in training (the node's cover). All 0/1
level features of one categorical are one player, and so are several splits on
one covariate along a path. The base value is the expectation with nothing
known, and base value plus contributions is the prediction.

Leaf by leaf: a player's splits on the way to a leaf are all satisfied by a
row or not, so a row matters to a leaf only by the pattern of its satisfied
players. Shapley values are computed for the patterns that occur, by
elementary symmetric polynomials of the cover shares, and read by the rows.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoderModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brasa.operators.model import in_zone
from brasa.session import checkpoint_dir


def ensemble_arrays(model: PipelineModel, covariates: Sequence[str]) -> dict:
    """Node arrays of every tree of the pipeline's final GBT stage, with the covariate of each split.

    The node table comes as Arrow columns, trees x nodes rows (model size).  A
    split on a 0/1 level feature is "equal to", any other one "at most".
    """
    session = SparkSession.getActiveSession()
    gbt = model.stages[-1]
    path = f"{checkpoint_dir(session).rstrip('/')}/brasa-model-{uuid.uuid4().hex}"
    gbt.write().save(path)
    node = F.col("nodeData")
    split = node["split"]
    nodes = (session.read.parquet(f"{path}/data")
             .select("treeID", node["id"].alias("id"), node["prediction"].alias("value"),
                     node["leftChild"].alias("left"), node["rightChild"].alias("right"),
                     node["rawCount"].cast("double").alias("cover"),
                     split["featureIndex"].alias("feat"),
                     F.coalesce(F.get(split["leftCategoriesOrThreshold"], 0), F.lit(0.0)).alias("thr"),
                     F.coalesce(split["numCategories"] > 0, F.lit(False)).alias("equal"))
             .toArrow())
    # vector slot -> covariate: one slot for a number, one for each level of a categorical
    levels = {c.removeprefix("_").removesuffix("_hot"): n for st in model.stages if isinstance(st, OneHotEncoderModel)
              for c, n in [(st.getOutputCol(), st.categorySizes[0])]}
    owner = np.repeat(np.arange(len(covariates)), [levels.get(c, 1) for c in covariates])
    return ensemble_of(nodes, np.asarray(gbt.treeWeights, dtype=float), owner)


def ensemble_of(nodes: pa.Table, weights: np.ndarray, owner: np.ndarray) -> dict:
    """An ensemble from its node table ``treeID, id, value, left, right, cover, feat, thr, equal``.

    ``id`` counts from 0 (the root) within a tree, a leaf has no children (-1), ``owner`` gives the covariate of a feature.
    """
    nodes = nodes.sort_by([("treeID", "ascending"), ("id", "ascending")])
    cols = {c: nodes[c].to_numpy() for c in nodes.column_names}
    cols["feat"] = np.where(cols["left"] >= 0, cols["feat"], 0)
    starts = np.flatnonzero(np.diff(cols["treeID"], prepend=-1))
    trees = [{k: v[i:j] for k, v in cols.items()} for i, j in zip(starts, [*starts[1:], len(cols["id"])])]
    for tree in trees:
        tree["leaves"] = _leaves(tree, owner)
    return {"trees": trees, "weights": weights, "owner": owner, "n_features": len(owner)}


def _leaves(tree: dict, owner: np.ndarray) -> list[tuple]:
    """Per leaf: its value, the players on the way with the (split, left?) pairs and the cover share of each."""
    out, todo = [], [(0, {})]
    while todo:
        at, way = todo.pop()
        if tree["left"][at] < 0:
            players = list(way)
            out.append((float(tree["value"][at]), players, [way[p][0] for p in players],
                        np.array([way[p][1] for p in players], float)))
            continue
        p, whole = int(owner[tree["feat"][at]]), float(tree["cover"][at])
        for child, left in ((int(tree["left"][at]), True), (int(tree["right"][at]), False)):
            splits, share = way.get(p, ((), 1.0))
            todo.append((child, {**way, p: (splits + ((at, left),), share * float(tree["cover"][child]) / whole)}))
    return out


def pattern_values(known: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Shapley values (patterns x players) of a leaf of value 1.

    ``known[r, j]``: row pattern r satisfies all splits of player j, whose cover share is ``share[j]``.  For a set S of
    known players the leaf counts if the others of the set satisfy it, so only sets within the satisfied players count:
    a sum over their sizes of a Shapley weight times an elementary symmetric polynomial of the shares left out.
    """
    n, d = known.shape
    weight = np.array([math.factorial(s) * math.factorial(d - s - 1) / math.factorial(d) for s in range(d)])
    size = known.sum(axis=1)
    rest = np.prod(np.where(known, 1.0, share), axis=1)          # shares of the players that fail
    poly = np.zeros((n, d + 1))
    poly[:, 0] = 1.0
    for j in range(d):
        poly[:, 1:] += np.where(known[:, j:j + 1], share[j], 0.0) * poly[:, :-1]

    def total(p, players):
        """Sum over k of the weight of (players - k) known times the polynomial that leaves k out."""
        k = players[:, None] - np.arange(d)[None]
        return np.where(k >= 0, weight[np.clip(k, 0, d - 1)] * p[:, :d], 0.0).sum(axis=1)

    # a player that fails adds to any set of satisfied ones; all of them lose the same
    out = np.repeat((-rest * total(poly, np.minimum(size, d - 1)))[:, None], d, axis=1)
    for j in range(d):
        rows = np.flatnonzero(known[:, j])
        less = poly[rows].copy()                                 # the polynomial without player j
        for k in range(1, d + 1):
            less[:, k] -= share[j] * less[:, k - 1]
        out[rows, j] = (1 - share[j]) * rest[rows] * total(less, size[rows] - 1)
    return out


def shapley_contributions(X: np.ndarray, ens: dict) -> tuple[float, np.ndarray]:
    """(base value, contributions rows x covariates) for a batch of feature rows."""
    contrib = np.zeros((len(X), int(ens["owner"].max()) + 1))
    base = 0.0
    for tree, w in zip(ens["trees"], ens["weights"]):
        x = X[:, tree["feat"]]
        left = np.where(tree["equal"], x == tree["thr"], x <= tree["thr"])   # rows x nodes
        for value, players, splits, share in tree["leaves"]:
            base += w * value * share.prod()
            if not players:
                continue
            known = np.ones((len(X), len(players)), bool)
            for j, way in enumerate(splits):
                for at, side in way:
                    known[:, j] &= left[:, at] == side
            code = known @ (1 << np.arange(len(players)))
            seen, at = np.unique(code, return_inverse=True)
            values = pattern_values((seen[:, None] >> np.arange(len(players)) & 1).astype(bool), share)
            contrib[:, players] += w * value * values[at]
    return base, contrib


def _explained(rows: DataFrame, ens: dict, keep: Sequence[str], covariates: Sequence[str], prediction_col: str) -> DataFrame:
    """``keep + base_value + shap_<covariate>... + prediction`` of rows that carry their feature array ``_x``."""
    shap_cols = [f"shap_{c}" for c in covariates]
    schema = T.StructType([rows.schema[c] for c in keep] +
                          [T.StructField(c, T.DoubleType()) for c in ["base_value", *shap_cols, prediction_col]])
    sent = rows.sparkSession.sparkContext.broadcast(ens)      # trees x nodes: the size of the model

    def run(batches):
        e = sent.value
        for b in batches:
            X = np.stack(b["_x"].to_numpy()) if len(b) else np.zeros((0, e["n_features"]))
            base, con = shapley_contributions(X, e)
            out = b[list(keep)].copy()
            out["base_value"] = base
            for j, c in enumerate(shap_cols):
                out[c] = con[:, j]
            out[prediction_col] = base + con.sum(axis=1)
            yield out
    return rows.select(*dict.fromkeys([*keep, "_x"])).mapInPandas(run, schema)


def add_contributions(df: DataFrame, models: dict, covariates: Sequence[str], factors=("zone_WE", "zone_NS"),
                      id_cols: Sequence[str] = ("fire_id",), which: int = 1,
                      prediction_col: str = "prediction") -> DataFrame:
    """``id_cols + factors + base_value + shap_<cov>... + prediction`` for rows of modelled zones.

    One filtered scan per zone: a table written by zone is read once.
    """
    f = list(factors)
    parts = []
    for key, pair in models.items():
        m = pair[which] if isinstance(pair, tuple) else pair
        feats = PipelineModel(stages=m.stages[:-1]).transform(df.where(in_zone(f, key)))
        rows = feats.withColumn("_x", vector_to_array("_features"))
        parts.append(_explained(rows, ensemble_arrays(m, covariates), list(id_cols) + f, covariates, prediction_col))
    return reduce(DataFrame.unionByName, parts)


def add_tree_contributions(df: DataFrame, nodes: DataFrame, covariates: Sequence[str], id_cols: Sequence[str] = ("fire_id",),
                           prediction_col: str = "prediction") -> DataFrame:
    """Contributions of an ensemble given as a node table over numeric covariates.

    ``nodes``: ``treeID, id, value, left, right, cover, feat, thr, equal`` (see :func:`ensemble_of`; ``feat`` counts
    covariates from 0) and ``weight``, the same for all nodes of a tree.  Its size is that of the model.  A row with a
    null covariate has null contributions.
    """
    table = nodes.toArrow()
    by_tree = table.group_by("treeID").aggregate([("weight", "min")]).sort_by("treeID")
    ens = ensemble_of(table.drop_columns(["weight"]), by_tree["weight_min"].to_numpy(), np.arange(len(covariates)))
    rows = df.withColumn("_x", F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in covariates]))
    out = _explained(rows, ens, list(id_cols) + ["_x"], covariates, prediction_col)
    known = ~F.exists("_x", F.isnan)
    return out.select(*id_cols, "base_value", *[F.when(known, F.col(c)).alias(c) for c in
                                                [*[f"shap_{c}" for c in covariates], prediction_col]])
