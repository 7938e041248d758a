"""SimHash near-dedup with pigeonring filtering.

Fingerprints: 64 votes per document over XXH64 of its word shingles, in Arrow
batches (an Arrow function); equal fingerprints collapse to one row before any
pair is looked for.

Search: the 64 bits are a ring of eight 8-bit segments. For two fingerprints
within distance 2 the pigeonring principle gives a segment i from which every
chain of l consecutive segments differs in at most l * 2 / 8 bits: none in the
first three segments, at most one in the first seven. So 24 bits are equal,
and of the next four segments one half (16 bits) is equal too. Every
fingerprint is therefore posted under 8 starts x 2 halves, each key holding 40
exact bits, and inside a key only fingerprints that pass the chain budgets get
the full Hamming check. A key with more than ``DENSE`` fingerprints (a large
family of near copies) is divided by its other 24 bits: of their four parts of
6 bits two are equal when at most 2 bits differ, so each fingerprint goes to
the six pairs of parts. A group then holds at most 2**12 different
fingerprints by construction, whatever the size of the corpus or of a family,
and the groups of one key lie in different tasks.

Links inside a key are reduced to a spanning forest before they leave the
task, so a large group of near copies yields as many edges as it has members,
never its pairs. Components come from distributed star contraction.

Defined results: null, empty and blank texts have fingerprint zero and are
linked like any other; texts shorter than a shingle are one shingle; repeated
rows share a fingerprint and so a component; rows without a doc_id take part
but never name a component (a component of only such rows has a null id); an
empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from brasa.session import cut_lineage

from .common import connected_components, table, utf8

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SEGMENTS = 8
#: Fingerprints of a key that are compared as one group.
DENSE = 1 << 12
_LANES = np.array([[(b >> k) & 1 for k in range(8)] for b in range(256)], np.uint8).view(np.uint64).ravel()


def _shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    w = text.lower().split()
    flat = b" ".join(w)
    digest = xxhash.xxh64_intdigest
    if len(w) <= shingle:
        return np.array([digest(flat, SEED)] if w else [], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[:len(w) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
    return np.fromiter((digest(flat[a:b], SEED) for a, b in spans), np.uint64, len(w) - shingle + 1)


def _votes(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints of documents whose hashes lie one after another."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    n = sizes[full]
    # byte lanes hold counts up to 255, so a document is summed in chunks of 255 hashes
    chunks = (n + 254) // 255
    first = np.cumsum(chunks) - chunks
    within = np.arange(chunks.sum()) - np.repeat(first, chunks)
    at = np.repeat(np.cumsum(n) - n, chunks) + within * 255
    raw = hashes.view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        lanes = np.add.reduceat(_LANES[raw[:, byte]], at).view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(lanes.astype(np.int64), first, axis=0)
        bits = (2 * ones > n[:, None]) << np.arange(8)
        out[full] |= bits.sum(axis=1).astype(np.uint64) << np.uint64(8 * byte)
    return out


def fingerprints(texts, shingle: int = SHINGLE) -> np.ndarray:
    """uint64 fingerprints of UTF-8 texts; hashes are held for a bounded stretch of documents at a time."""
    out, held, n = [np.zeros(0, np.uint64)], [], 0

    def flush():
        out.append(_votes(np.concatenate(held or [np.zeros(0, np.uint64)]), np.array([len(h) for h in held], np.int64)))

    for t in texts:
        held.append(_shingle_hashes(t, shingle))
        n += len(held[-1])
        if n > 100_000:
            flush()
            held, n = [], 0
    flush()
    return np.concatenate(out)


def fingerprint_udf(shingle: int = SHINGLE):
    @arrow_udf("long")
    def fingerprint(text: pa.Array) -> pa.Array:
        return pa.array(fingerprints(utf8(text), shingle).view(np.int64))
    return fingerprint


def chain_passes(x: np.ndarray, start: int, bits: int = MAX_BITS, segments: int = SEGMENTS) -> np.ndarray:
    """Whether the differences ``x`` (xor of two fingerprints) keep within the proportional budget l * bits /
    segments on every chain of l consecutive segments from ``start`` round the ring."""
    width = 64 // segments
    total, ok = np.zeros(x.shape, np.int64), np.ones(x.shape, bool)
    for step in range(segments):
        shift = np.uint64(((start + step) % segments) * width)
        total += np.bitwise_count((x >> shift) & np.uint64((1 << width) - 1))
        ok &= total * segments <= (step + 1) * bits
    return ok


def spanning_forest(fps: np.ndarray, start: int, bits: int = MAX_BITS, block: int = 1024):
    """Edges (member, root) that connect what is linked inside one key; at most one per member."""
    n = len(fps)
    root = np.arange(n)
    for i in range(0, n, block):
        for j in range(i, n, block):
            x = fps[i:i + block, None] ^ fps[None, j:j + block]
            a, b = np.nonzero(np.bitwise_count(x) <= bits)
            keep = a + i < b + j
            a, b = a[keep], b[keep]
            ok = chain_passes(x[a, b], start, bits)
            a, b = a[ok] + i, b[ok] + j
            # contract at once, so that what is held stays a forest and not the pairs
            while len(a):
                ra, rb = root[a], root[b]
                low, high = np.minimum(ra, rb), np.maximum(ra, rb)
                live = low != high
                if not live.any():
                    break
                a, b = a[live], b[live]
                np.minimum.at(root, high[live], low[live])
                while (root[root] != root).any():
                    root = root[root]
    member = np.flatnonzero(root != np.arange(n))
    return fps[member], fps[root[member]]


def _posted() -> F.Column:
    """The 16 keys of a fingerprint: (start, half) and 40 exact bits from start."""
    fp, keys = F.col("fp"), []
    for s in range(SEGMENTS):
        turned = fp if s == 0 else F.shiftrightunsigned(fp, 8 * s).bitwiseOR(F.shiftleft(fp, 64 - 8 * s))
        head = turned.bitwiseAND((1 << 24) - 1)
        for half in range(2):
            rest = F.shiftrightunsigned(turned, 24 + 16 * half).bitwiseAND((1 << 16) - 1)
            keys.append(head.bitwiseOR(F.shiftleft(rest, 24)).bitwiseOR(F.lit((s * 2 + half) << 40)))
    return F.array(*keys)


def _parts() -> F.Column:
    """The 6 groups of a fingerprint inside a dense key: two equal 6-bit parts of the 24 bits that the key leaves open."""
    turn = "cast(8 * shiftright(key, 41) as int)"
    turned = f"(shiftrightunsigned(fp, {turn}) | shiftleft(fp, 64 - {turn}))"
    rest = F.expr(f"if((shiftright(key, 40) & 1) = 0, shiftrightunsigned({turned}, 40), "
                  f"(shiftrightunsigned({turned}, 24) & 65535L) | shiftleft(shiftrightunsigned({turned}, 56), 16))")
    part = [F.shiftright(rest, 6 * i).bitwiseAND(63) for i in range(4)]
    pairs = [(i, j) for i in range(4) for j in range(i)]
    return F.array(*[F.lit(n << 12).cast("long") + F.shiftleft(part[i], 6) + part[j] for n, (i, j) in enumerate(pairs)])


def posted_groups(reps: DataFrame) -> DataFrame:
    """``key, fps``: the groups of fingerprints (column ``fp``, distinct) inside which links are looked for."""
    posted = reps.select("fp", F.explode(_posted()).alias("key"))
    dense = cut_lineage(posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > DENSE).select("key"))
    light = posted.join(dense, "key", "left_anti").withColumn("part", F.lit(-1).cast("long"))
    heavy = posted.join(dense, "key", "left_semi").withColumn("part", F.explode(_parts()))
    return (light.unionByName(heavy).groupBy("key", "part").agg(F.collect_list("fp").alias("fps"))
            .where(F.size("fps") > 1).drop("part"))


def _links(batches):
    for pdf in batches:
        a, b = [], []
        for key, group in zip(pdf["key"], pdf["fps"]):
            x, y = spanning_forest(np.sort(np.asarray(group, np.int64).view(np.uint64)), int(key) >> 41)
            a.append(x)
            b.append(y)
        if a:
            yield pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_key``, ``fp``, ``root`` (fingerprint that stands for the component) and ``component_id``.

    The bit distance is that of the posting scheme (2).
    """
    docs = cut_lineage(df.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"),
                                 fingerprint_udf(shingle)(F.col(text)).alias("fp")))
    reps = cut_lineage(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    comps = connected_components(posted_groups(reps).mapInPandas(_links, "a long, b long"))
    rooted = reps.join(comps, reps.fp == comps.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(names, "root").select(F.col("fp").alias("__fp"), "root", "component_id")
    return docs.join(named, F.col("fp") == F.col("__fp")).drop("__fp")


def keep_one(df: DataFrame) -> DataFrame:
    """One document of each component: the row with the smallest doc_id (one of them, if rows repeat)."""
    found = near_duplicates(df)
    names = lambda *c: [F.xxhash64(*c).alias("k1"), F.hash(*c).alias("k2")]
    kept = (found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).dropDuplicates(["root"])
            .select(*names("doc_id", "text_key")))
    rows = df.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"),
                     F.xxhash64("text").alias("text_key")).select("row", *names("id", "text_key"))
    # both steps work on the same non-null keys, so the texts are dealt out once
    return rows.join(kept, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"]).select("row.*")


def query(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
