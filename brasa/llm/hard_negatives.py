"""Hard-negative mining with rotated one-bit codes.

The index: every vector, as integers, is turned by a seeded orthogonal
rotation (random signs and Hadamard transforms, three times), and stored as
the sign bits of its coordinates, its alignment (inner product with the unit
code vector, the signs over sqrt(D)) and the length of what the code vector
leaves over. An anchor is turned the same way and cut to ``QUERY_BITS`` bit
planes, so its inner product with a code vector is a sum of popcounts plus an
error of known length. With x = A c + r (c the code vector, r orthogonal to
it) and a query q, <q, x> = A <q, c> + <q, r>, and Cauchy-Schwarz gives
|<q, r>| <= |q - <q, c> c| |r|: an interval that holds the score for certain,
no probability in it.

Two passes over the index, both exact:

* positives: in a block of rows, the fifth largest lower end among the rows of
  the anchor's label is a floor; only rows whose upper end reaches it are
  scored in integers;
* negatives: only rows of other labels whose interval meets the band of one of
  the anchor's positives are scored in integers.

A task keeps the first few of its block; a window over those gives the first
few of all. Rows and anchors are dealt in blocks of bounded size; an anchor
block is sent once to each block of rows (a stated query set against all rows,
by an equi-join on the block), so neither side is ever whole in one place.

Defined results: rows with a null vec_id, label or vector, an empty vector, or
a null or non-finite component take no part; rows with one vec_id count once
(the smallest label, then vector); vectors are only compared with vectors of
the same length; ties go to the smaller vec_id; an anchor without positives
and a positive without negatives in its band give no row; an empty table gives
an empty result; only the named columns are read. Scores are bigint: inputs
whose scores could pass 2**63 raise an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brasa.session import cut_and_count, cut_lineage

from .common import table

POSITIVES = 5
NEGATIVES = 5
#: A negative scores between these percentages of its positive.
LOW, HIGH = 80, 100
SCALE = 256
ROWS = 8192
ANCHORS = 128
QUERY_BITS = 8
SEED = 7
#: Room for rounding in the ends of an interval, as a share of the product of the lengths.
SLACK = 1e-9


def whole_numbers(v: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null for a vector that takes no part."""
    x = v.cast("array<double>")
    fine = (F.size(x) > 0) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return F.when(F.coalesce(fine, F.lit(False)), F.transform(x, lambda e: F.floor(e * scale).cast("long")))


def rotate(x: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Rows turned by a fixed orthogonal matrix; the length grows to a power of two, 64 at least."""
    n, d = x.shape
    size = max(64, 1 << (d - 1).bit_length())
    out = np.zeros((n, size))
    out[:, :d] = x
    rng = np.random.default_rng([seed, size])
    for _ in range(3):
        out *= rng.choice([-1.0, 1.0], size)
        step = 1
        while step < size:
            pairs = out.reshape(n, size // (2 * step), 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
            step *= 2
        out /= np.sqrt(size)
    return out


def _bits(flags: np.ndarray) -> np.ndarray:
    return np.packbits(flags, axis=-1).view(np.uint64)


class Codes:
    """Sign codes of integer vectors with the alignment and the residual length of each."""

    def __init__(self, codes: np.ndarray, align: np.ndarray, rest: np.ndarray):
        self.codes, self.align, self.rest = codes, align, rest

    @classmethod
    def of(cls, x: np.ndarray) -> Codes:
        turned = rotate(np.asarray(x, np.float64))
        align = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
        return cls(_bits(turned > 0), align, np.sqrt(np.maximum(0, (turned * turned).sum(axis=1) - align ** 2)))


class Queries:
    """Anchors in bit planes."""

    def __init__(self, x: np.ndarray, bits: int = QUERY_BITS):
        turned = rotate(np.asarray(x, np.float64))
        self.size = turned.shape[1]
        self.square = (turned * turned).sum(axis=1)
        self.low = turned.min(axis=1)
        self.step = np.maximum((turned.max(axis=1) - self.low) / (2 ** bits - 1), 1e-300)
        cut = np.rint((turned - self.low[:, None]) / self.step[:, None])
        self.error = np.abs(turned - (self.low[:, None] + self.step[:, None] * cut)).sum(axis=1) / np.sqrt(self.size)
        self.planes = [_bits((cut.astype(np.int64) >> b & 1).astype(bool)) for b in range(bits)]
        self.total = cut.sum(axis=1)

    def intervals(self, some: slice, rows: Codes) -> tuple[np.ndarray, np.ndarray]:
        """Ends (queries x rows) between which the inner products lie."""
        count = np.zeros((len(self.low[some]), len(rows.codes)))
        for b, plane in enumerate(self.planes):
            count += np.bitwise_count(plane[some, None] & rows.codes[None]).sum(axis=2, dtype=np.int64) << b
        ones = np.bitwise_count(rows.codes).sum(axis=1, dtype=np.int64)
        get = lambda a: a[some, None]
        # sum over the set bits minus the sum over the others, of low + step * cut
        signed = get(self.step) * (2 * count - get(self.total)) + get(self.low) * (2 * ones - self.size)
        along = signed / np.sqrt(self.size)
        least = np.maximum(0, np.abs(along) - get(self.error))
        aside = np.sqrt(np.maximum(0, get(self.square) - least ** 2))
        length = np.sqrt(rows.align ** 2 + rows.rest ** 2)
        wide = rows.align * get(self.error) + aside * rows.rest + SLACK * (np.sqrt(get(self.square)) * length + 1)
        return rows.align * along - wide, rows.align * along + wide


def scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(query).max(initial=0)) * rows.shape[1]
    if most < 2 ** 53:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    if most >= 2 ** 63:
        raise OverflowError("a score could pass the range of bigint")
    return rows @ query


def _first(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties by the smaller id."""
    return np.lexsort((ids, -score))[:k]


def _narrow(q: np.ndarray) -> tuple[bytes, int]:
    size = next(s for s in (2, 4, 8) if s == 8 or np.abs(q).max(initial=0) < 1 << (8 * s - 1))
    return q.astype(f"<i{size}").tobytes(), size


def _wide(data: bytes, size: int, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{size}").astype(np.int64).reshape(n, -1)


def _index(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row for a block of rows: ids, labels, integers and codes."""
    q = np.stack(pdf["q"].to_list())
    codes, (data, size) = Codes.of(q), _narrow(q)
    return pd.DataFrame([(q.shape[1], int(pdf["block"].iloc[0]), len(q), pdf["vec_id"].to_numpy(np.int64).tobytes(),
                          pdf["label"].to_numpy(np.int64).tobytes(), data, size, codes.codes.tobytes(),
                          codes.align.tobytes(), codes.rest.tobytes())],
                        columns=["length", "block", "n", "ids", "labels", "q", "bytes", "codes", "align", "rest"])


INDEX = "length int, block long, n int, ids binary, labels binary, q binary, bytes int, codes binary, align binary, rest binary"


def _ask(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row for a block of anchors; ``bands`` holds (positive id, positive score) pairs, flat."""
    q = np.stack(pdf["q"].to_list())
    data, size = _narrow(q)
    bands = [np.asarray([(p["positive_id"], p["positive_score"]) for p in b], np.int64).reshape(-1, 2) for b in pdf["bands"]]
    return pd.DataFrame([(q.shape[1], len(q), pdf["vec_id"].to_numpy(np.int64).tobytes(),
                          pdf["label"].to_numpy(np.int64).tobytes(), data, size,
                          np.concatenate(bands).tobytes(), np.array([len(b) for b in bands], np.int64).tobytes())],
                        columns=["length", "asks", "a_ids", "a_labels", "a_q", "a_bytes", "bands", "per"])


ASK = "length int, asks int, a_ids binary, a_labels binary, a_q binary, a_bytes int, bands binary, per binary"


def _pairs(batches):
    """(anchors, rows) of each pair of blocks, and the intervals of a few anchors at a time."""
    for pdf in batches:
        for t in pdf.itertuples(index=False):
            ids, labels = np.frombuffer(t.ids, np.int64), np.frombuffer(t.labels, np.int64)
            rows = Codes(np.frombuffer(t.codes, np.uint64).reshape(t.n, -1), np.frombuffer(t.align), np.frombuffer(t.rest))
            asked, q = _wide(t.a_q, t.a_bytes, t.asks), _wide(t.q, t.bytes, t.n)
            queries = Queries(asked)
            a_ids, a_labels = np.frombuffer(t.a_ids, np.int64), np.frombuffer(t.a_labels, np.int64)
            per = np.frombuffer(t.per, np.int64)
            bands = np.split(np.frombuffer(t.bands, np.int64).reshape(-1, 2), np.cumsum(per)[:-1])
            few = 32
            for s in range(0, t.asks, few):
                lows, highs = queries.intervals(slice(s, s + few), rows)
                for i, (low, high) in enumerate(zip(lows, highs), s):
                    yield (int(a_ids[i]), int(a_labels[i]), asked[i], bands[i]), (ids, labels, q), low, high


def _positives(k: int):
    def run(batches):
        out = []
        for (anchor, label, query, _), (ids, labels, q), low, high in _pairs(batches):
            same = np.flatnonzero((labels == label) & (ids != anchor))
            if len(same) > k:
                # at least k rows score no less than the k-th largest lower end
                same = same[high[same] >= np.partition(low[same], -k)[-k]]
            score = scores(q[same], query)
            out += [(anchor, int(ids[same[j]]), int(score[j])) for j in _first(ids[same], score, k)]
        yield pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score"])
    return run


def _negatives(k: int, least: int, most: int):
    def run(batches):
        out = []
        for (anchor, label, query, bands), (ids, labels, q), low, high in _pairs(batches):
            other, meets = labels != label, np.zeros(len(ids), bool)
            for _, score in bands.tolist():
                meets |= (100 * high >= least * score) & (100 * low <= most * score)
            left = np.flatnonzero(other & meets)
            score = scores(q[left], query)
            for positive, top in bands.tolist():
                # least * top <= 100 * score <= most * top in whole numbers
                at = np.flatnonzero((score >= -(-least * top // 100)) & (score <= most * top // 100))
                out += [(anchor, positive, top, int(ids[left[j]]), int(score[j]))
                        for j in at[_first(ids[left[at]], score[at], k)]]
        yield pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])
    return run


def _against(anchors: DataFrame, index: DataFrame, n_blocks: int) -> DataFrame:
    """Every block of anchors beside every block of rows with vectors of its length."""
    n = anchors.count()
    dealt = anchors.groupBy(F.size("q"), F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-n // ANCHORS))))).applyInPandas(_ask, ASK)
    sent = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    return sent.join(index, ["length", "block"])


def mine(df: DataFrame, is_anchor: Column, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; ``is_anchor`` may use vec_id, label."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                     whole_numbers(F.col(embedding)).alias("q")).dropna()
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.label", "r.q")
    rows, n = cut_and_count(one)
    n_blocks = max(1, -(-n // ROWS))
    index = cut_lineage(rows.withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "vec_id"), F.lit(n_blocks)))
                        .groupBy(F.size("q"), "block").applyInPandas(_index, INDEX))
    anchors = rows.where(is_anchor)
    none = F.array().cast("array<struct<positive_id:bigint,positive_score:bigint>>")
    found = _against(anchors.withColumn("bands", none), index, n_blocks).mapInPandas(
        _positives(positives), "anchor_id long, positive_id long, positive_score long")
    by_score = W.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = cut_lineage(found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= positives))
    bands = found.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("bands"))
    asked = cut_lineage(anchors.join(bands.withColumnRenamed("anchor_id", "vec_id"), "vec_id"))
    hard = _against(asked, index, n_blocks).mapInPandas(
        _negatives(negatives, low, high),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    by_score = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (hard.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
                    "negative_score"))


def query(spark, sf_dir) -> DataFrame:
    planted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings").withColumn("label", planted), F.col("vec_id") % 100 == 0)


def oracle(vectors: str = "embeddings") -> str:
    """DuckDB SQL of :func:`query`: every score of every anchor by plain sums."""
    return f"""
WITH d AS (SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    list_transform(embedding, lambda x: coalesce(floor({SCALE} * CAST(x AS DOUBLE)), 0)) AS q FROM {vectors}
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
u AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, q) = 1),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
n AS (SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND {LOW} * positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""
