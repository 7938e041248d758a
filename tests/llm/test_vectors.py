"""Vector operators against plain numpy over all pairs, and against their SQL."""

import numpy as np
import pytest

from brasa.llm import epsilon_join, hard_negatives
from tools.oracle_check import digest, duck

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture()
def vectors(spark):
    def make(rows, schema=SCHEMA):
        from pyspark.sql import functions as F
        return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], l)
                                      for i, v, l in rows], schema).withColumns(
            {c: F.lit(1) for c in ("v", "n", "q", "block", "place", "id", "p", "length", "r", "rank")})
    return make


def planted(seed=3, n=300, dim=64):
    """Vectors with groups of near and exact copies."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    for i in range(0, n // 2, 3):
        x[i + 1] = x[i] + rng.normal(size=dim) * rng.choice([0.1, 0.3, 0.5])
        x[i + 2] = x[i] * 2 if i % 2 else x[i]
    x[200:240] = x[200] + rng.normal(size=(40, dim)) * 0.2
    return [(i, v, int(rng.integers(0, 4))) for i, v in enumerate(x)]


AWKWARD = [(900, None, 1), (901, [], 1), (902, [0.0] * 64, 1), (903, [None] + [1.0] * 63, 1), (904, [float("nan")] + [1.0] * 63, 1),
           (905, [float("inf")] + [1.0] * 63, 1), (906, [1.0, 0.0], 1), (907, [1.0, 0.0], 2), (None, [1.0, 0.0], 1),
           (908, [2.0] * 64, None), (909, [2.0] * 64, 1), (909, [2.0] * 64, 1), (None, None, None)]


def links(rows, threshold=0.9):
    good = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
            for _, v, _ in rows]
    n = len(rows)
    near = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            if good[i] and good[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = (np.asarray(rows[k][1], np.float32).astype(np.float64) for k in (i, j))
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    near[i].append(j)
                    near[j].append(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(near[i]), min(ids, default=None), rows[i][0] == min(ids, default=None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("threshold, block, tile", [(0.9, 8192, 512), (0.9, 32, 8), (0.6, 50, 7), (0.3, 64, 16)])
def test_epsilon_join_equals_brute_force(spark, vectors, monkeypatch, threshold, block, tile):
    monkeypatch.setattr(epsilon_join, "BLOCK", block)
    monkeypatch.setattr(epsilon_join, "TILE", tile)
    rows = planted() + AWKWARD
    out = epsilon_join.near_vectors(vectors(rows), threshold=threshold).collect()
    assert sorted(map(tuple, out), key=repr) == links(rows, threshold)
    assert sum(r.n_links > 0 for r in out) > 100


def test_epsilon_join_skips_distant_blocks(spark, vectors, monkeypatch):
    monkeypatch.setattr(epsilon_join, "BLOCK", 16)
    monkeypatch.setattr(epsilon_join, "FAN", 2)
    rng = np.random.default_rng(5)
    centres = np.eye(16)[:8]  # far from each other
    rows = [(i, centres[i % 8] + rng.normal(size=16) * 0.02, 0) for i in range(400)]
    kept = []
    whole = epsilon_join.close_blocks
    monkeypatch.setattr(epsilon_join, "close_blocks", lambda b, n, e: kept.append((whole(b, n, e), n)) or kept[0][0])
    out = epsilon_join.near_vectors(vectors(rows)).collect()
    assert sorted(map(tuple, out), key=repr) == links(rows)
    pairs, n = kept[0]
    assert n == 25 and pairs.count() < 0.5 * n * (n + 1) / 2


def test_tile_recursion_visits_each_close_pair_once():
    rng = np.random.default_rng(1)
    x = np.sort(rng.normal(size=(700, 3)), axis=0)
    a = epsilon_join.Block(x.tobytes(), x.tobytes(), np.ones(700, np.int64).tobytes(), 700, "<f8")
    seen = [t for t in epsilon_join.close_tiles(a, a, 10.0, True) if t[0] <= t[1]]
    assert sorted(seen) == [(0, 0), (0, 1), (1, 1)]


def mined(rows, positives=5, negatives=5):
    q, label = {}, {}
    for i, v, l in sorted((r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None and len(r[1])
                           and all(x is not None and np.isfinite(x) for x in r[1])), key=lambda r: (r[0], r[2])):
        if i not in q:
            q[i] = np.floor(np.asarray(v, np.float32).astype(np.float64) * 256).astype(np.int64)
            label[i] = l
    out = []
    for a in q:
        if a % 100:
            continue
        score = {b: int(q[a] @ q[b]) for b in q if b != a and len(q[b]) == len(q[a])}
        order = sorted(score, key=lambda b: (-score[b], b))
        for p in [b for b in order if label[b] == label[a]][:positives]:
            hard = [b for b in order if label[b] != label[a] and 80 * score[p] <= 100 * score[b] <= 100 * score[p]]
            out += [(a, p, r + 1, b, score[p], score[b]) for r, b in enumerate(hard[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("block, bits", [(8192, 8), (40, 3)])
def test_hard_negatives_equal_brute_force(spark, vectors, monkeypatch, block, bits):
    from pyspark.sql import functions as F
    monkeypatch.setattr(hard_negatives, "ROWS", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 2)
    rows = planted(n=600) + AWKWARD
    out = hard_negatives.mine(vectors(rows), F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, out)) == mined(rows) and len(out) > 30


def test_ties_and_short_lists(spark, vectors):
    from pyspark.sql import functions as F
    rows = [(0, [1, 1], 1)] + [(i, [1, 1], 1) for i in (9, 3, 5)] + [(i, [1, 1], 2) for i in range(20, 30)] + [(100, [5, 5], 7)]
    out = hard_negatives.mine(vectors(rows), F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, out)) == mined(rows)
    assert {(r.positive_id, r["rank"], r.negative_id) for r in out if r.positive_id == 3} == {(3, k + 1, 20 + k) for k in range(5)}


@pytest.mark.parametrize("dim", [3, 64, 100])
def test_intervals_hold_every_score(dim):
    rng = np.random.default_rng(dim)
    x, q = rng.integers(-300, 300, (500, dim)), rng.integers(-300, 300, (40, dim))
    x[0], q[0] = 0, 0
    turned = hard_negatives.rotate(x.astype(float))
    assert np.allclose(turned @ turned.T, x @ x.T)
    low, high = hard_negatives.Queries(q).intervals(slice(None), hard_negatives.Codes.of(x))
    true = q @ x.T
    assert (low <= true).all() and (true <= high).all()
    # an interval is not trivial: it is narrower than what the lengths alone allow
    length = np.sqrt((q * q).sum(1))[:, None] * np.sqrt((x * x).sum(1))[None]
    assert ((high - low)[1:, 1:] < 1.6 * length[1:, 1:]).mean() > 0.9


def test_scores_past_double_precision():
    rows, query = np.array([[2 ** 29 + 1, 3]]), np.array([2 ** 29 + 5, 7])
    assert hard_negatives.scores(rows, query).tolist() == [(2 ** 29 + 1) * (2 ** 29 + 5) + 21]
    with pytest.raises(OverflowError):
        hard_negatives.scores(np.array([[2 ** 40]]), np.array([2 ** 40]))


@pytest.mark.parametrize("module", [epsilon_join, hard_negatives])
def test_awkward_rows_and_empty_tables_equal_sql(spark, vectors, tmp, module):
    con = duck("/root/testdata/sf0.001")
    rows = planted(n=400) + [r for r in AWKWARD if r[0] != 909 and r[0] is not None]
    for name, some in (("full", rows), ("empty", [])):
        vectors(some).write.parquet(f"{tmp}/{name}/embeddings.parquet")
        con.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM read_parquet('{tmp}/{name}/embeddings.parquet/*.parquet')")
        got, want = module.query(spark, f"{tmp}/{name}").toPandas(), con.execute(module.oracle()).fetchdf()
        assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
        assert digest(got)[0] == digest(want)[0]
