"""Removal of repeated byte strings by hash-compared suffix sorting.

A byte goes when it is covered by a string of ``WINDOW`` bytes that also starts
in a document with a smaller id. Suffixes are never sorted as a whole corpus:

1. Blocks. Documents are packed into blocks of about ``BLOCK_BYTES`` (a longer
   document is a block of its own) and written once; everything later refers
   to block numbers of that table.
2. Anchors. The smallest hash of the k-mers in a window (its minimizer) is a
   function of the window's bytes, so equal windows have equal anchors.
   Consecutive windows with the same anchor form one context of at most
   ``2 * WINDOW - K`` bytes. Hash fragments of the anchors go to hash buckets;
   anchors in one document only are out.
3. Suffix sort. The contexts of the other anchors are dealt out by anchor, so
   all equal windows meet in one task. There suffixes are mergesorted; two
   suffixes are compared by the binary search for their longest common
   extension over prefix polynomial hashes (modulo 2**64), which takes log2
   steps, and by the next byte. Neighbours whose common extension is the whole
   suffix are one class after their bytes have been compared, so a hash
   collision cannot remove anything. Whole contexts are sorted first; only
   anchors with different contexts (edges of a repeated passage) have their
   windows sorted one by one.
4. Each class carries its smallest document id back to the blocks, which mark
   the bytes of windows whose class has a smaller id than their document.

Blocks collapse their own equal contexts by the same sort before anything is
shuffled, so a group of copies or a common passage adds one context per block.

Defined results: a null or empty text has no bytes and nothing removed; equal
strings within one document, or in rows with the same id, do not count; a row
without an id neither removes nor is removed; matches never cross documents;
an empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from brasa.session import cut_lineage

from .common import table, utf8

WINDOW = 50
K = 20
SPAN = WINDOW - K + 1  # k-mers in a window
BLOCK_BYTES = 2_000_000
BUCKET_BYTES = 4_000_000
SEGMENT = 1 << 18
CHUNK_RUNS = 20_000
PORTION = 100_000
FRAGMENT = 40  # bits of an anchor hash that are compared within a bucket
NO_ID = np.iinfo(np.int64).max
BLOCKS = "block long, ids binary, nulls binary, sizes binary, data binary"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_BASE = 0x9E3779B97F4A7C15 | 1
_POW, _INV = _powers(_BASE, SEGMENT + WINDOW), _powers(pow(_BASE, -1, 1 << 64), SEGMENT + WINDOW)
_SHORT_POW, _SHORT_INV = _POW[:2 * WINDOW].copy(), _INV[:2 * WINDOW].copy()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(a.tobytes())


def _unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every stretch, one after another."""
    first = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - first, size)


# ---- suffix sorting -------------------------------------------------------------------------------------------------

class Contexts:
    """Short texts one after another, with prefix polynomial hashes that restart at each of them."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray):
        self.start = np.cumsum(lengths) - lengths
        self.length = lengths
        self.data = np.concatenate((data, np.zeros(8, np.uint8)))
        self.words = np.ndarray(len(data), "<u8", self.data, strides=(1,))  # the 8 bytes from each position
        self.at = _spread(np.zeros(len(lengths), np.int64), lengths).astype(np.uint8)
        self.prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _SHORT_POW[self.at], out=self.prefix[1:])

    def hash(self, start, length):
        return (self.prefix[start + length] - self.prefix[start]) * _SHORT_INV[self.at[start]]

    def common(self, a, b, most):
        """Longest common extension of suffixes at a and b up to ``most`` bytes: binary search over prefix hashes."""
        n = np.zeros(len(a), np.int64)
        for step in (64, 32, 16, 8, 4, 2, 1):
            longer = n + step
            fits = longer <= most
            longer = np.where(fits, longer, n)
            n = np.where(fits & (self.hash(a, longer) == self.hash(b, longer)), longer, n)
        return n

    def not_above(self, a, la, b, lb):
        """Whether suffix a (length la) sorts no later than suffix b."""
        most = np.minimum(la, lb)
        out = la <= lb
        differ = np.flatnonzero(self.hash(a, most) != self.hash(b, most))
        if len(differ):
            a, b = a[differ], b[differ]
            n = self.common(a, b, most[differ])
            out[differ] = self.data[a + n] < self.data[b + n]
        return out

    def same_bytes(self, a, b, length):
        out = np.ones(len(a), bool)
        for off in range(0, int(length.max(initial=0)), 8):
            at = np.minimum(off, length - 8)
            out &= self.words[a + at] == self.words[b + at]
        return out


def mergesort(text: Contexts, start: np.ndarray, length: np.ndarray, order: np.ndarray, first: np.ndarray, size: np.ndarray):
    """Sort the stretches ``first, size`` of ``order`` (suffix numbers) in place, bottom up, all stretches at once."""
    width = 1
    while True:
        live = size > width
        first, size = first[live], size[live]
        if not len(first):
            return
        blocks = -(-(size - width) // (2 * width))  # those with a right half
        left = _spread(np.zeros(len(first), np.int64), blocks) * (2 * width) + np.repeat(first, blocks)
        middle, end = left + width, np.minimum(left + 2 * width, np.repeat(first + size, blocks))
        pos = _spread(middle, end - middle)
        block = np.repeat(np.arange(len(left)), end - middle)
        me = order[pos]
        low, high = np.zeros(len(pos), np.int64), np.full(len(pos), width, np.int64)
        # rank of each right element among the left ones: those that sort no later than it
        open_ = np.arange(len(pos))
        while len(open_):
            probe = (low[open_] + high[open_]) >> 1
            other = order[left[block[open_]] + probe]
            mine = me[open_]
            before = text.not_above(start[other], length[other], start[mine], length[mine])
            low[open_] = np.where(before, probe + 1, low[open_])
            high[open_] = np.where(before, high[open_], probe)
            open_ = open_[low[open_] < high[open_]]
        to = pos - width + low
        everything = _spread(left, end - left)
        lefts = order[_spread(left, middle - left)]
        taken = np.zeros(int(end[-1]) if len(end) else 0, bool)
        taken[to] = True
        order[everything[~taken[everything]]] = lefts
        order[to] = me
        width *= 2


def classes(text: Contexts, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Class number of each suffix; suffixes of the same bytes share one.

    Suffixes are dealt into buckets by their length and their first and last
    eight bytes and sorted within the buckets.
    """
    n = len(start)
    if not n:
        return np.zeros(0, np.int64)
    key = _mix(_mix(text.words[start]) + text.words[start + length - 8]) + length.astype(np.uint64)
    order = np.argsort(key, kind="stable")
    new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, n))
    mergesort(text, start, length, order, first[size > 1], size[size > 1])
    a, b = order[:-1], order[1:]
    near = np.flatnonzero(~new[1:] & (length[a] == length[b]))
    near = near[text.hash(start[a[near]], length[a[near]]) == text.hash(start[b[near]], length[b[near]])]
    same = text.same_bytes(start[a[near]], start[b[near]], length[a[near]])
    new[1:][~new[1:]] = True
    new[near[same] + 1] = False
    out = np.empty(n, np.int64)
    out[order] = np.cumsum(new) - 1
    if not same.all():  # a hash collision: the buckets in question are compared as bytes
        _settle(text, start, length, order, key, near[~same], out)
    return out


def _settle(text, start, length, order, key, at, out):
    seen = {}
    for i in np.flatnonzero(np.isin(key, key[order[at]])).tolist():
        seen.setdefault(bytes(text.data[start[i]:start[i] + length[i]]), []).append(i)
    for members in seen.values():
        out[members] = out[members[0]]


def least(value: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Smallest value of each member's group."""
    low = np.full(int(group.max(initial=-1)) + 1, NO_ID, np.int64)
    np.minimum.at(low, group, value)
    return low[group]


def window_ids(data: np.ndarray, length: np.ndarray, ids: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Smallest document id of every window of every context, among contexts with the same anchor."""
    text = Contexts(data, length)
    whole = classes(text, text.start, length)
    low = least(ids, whole)
    # one context stands for each class; anchors with several classes need their windows compared
    _, one = np.unique(whole, return_index=True)
    order = one[np.argsort(anchor[one], kind="stable")]
    same = anchor[order][1:] == anchor[order][:-1]
    mixed = np.concatenate(([False], same)) | np.concatenate((same, [False]))
    chosen = order[mixed]
    count = length - WINDOW + 1
    offset = np.zeros(int(whole.max(initial=-1)) + 1, np.int64) - 1
    start = _spread(text.start[chosen], count[chosen])
    windows = classes(text, start, np.full(len(start), WINDOW, np.int64))
    found = least(np.repeat(low[chosen], count[chosen]), windows)
    offset[whole[chosen]] = np.cumsum(count[chosen]) - count[chosen]
    out = np.repeat(low, count)
    mine = offset[whole]
    edge = np.flatnonzero(mine >= 0)
    out[_spread((np.cumsum(count) - count)[edge], count[edge])] = found[_spread(mine[edge], count[edge])]
    return out


# ---- blocks ---------------------------------------------------------------------------------------------------------

class Block:
    """Documents one after another, and the runs of windows that share an anchor."""

    def __init__(self, row):
        self.number = int(row.block)
        self.ids, self.sizes = np.frombuffer(row.ids, np.int64), np.frombuffer(row.sizes, np.int64)
        self.known = ~np.frombuffer(row.nulls, bool)
        self.data = _unpack(row.data, np.uint8)
        self.first = np.cumsum(self.sizes) - self.sizes

    def runs(self):
        """(first window, end, anchor hash, document) of each run, in order of the anchor hash."""
        n = len(self.data)
        valid = np.repeat(self.known, self.sizes)
        ends = (self.first + self.sizes)[self.sizes > 0]
        late = _spread(np.maximum(ends - WINDOW + 1, self.first[self.sizes > 0]),
                       np.minimum(WINDOW - 1, self.sizes[self.sizes > 0]))
        valid[late] = False
        parts = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)]
        bits = np.uint64(SEGMENT.bit_length())
        for a in range(0, n - WINDOW + 1, SEGMENT):
            b = min(a + SEGMENT, n - WINDOW + 1)
            p = np.zeros(b - a + WINDOW, np.uint64)
            x = self.data[a:b + WINDOW - 1].astype(np.uint64) + np.uint64(1)
            x *= _POW[:len(x)]
            np.cumsum(x, out=p[1:])
            h = _mix((p[K:] - p[:-K]) * _INV[:len(x) - K + 1])
            low = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
            for step in (1, 2, 4, 8):
                low = np.minimum(low[:-step], low[step:])
            low = np.minimum(low[:-(SPAN - 16)], low[SPAN - 16:])
            at = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
            ok = np.concatenate(([False], valid[a:b], [False]))
            turn = np.concatenate(([True], at[1:] != at[:-1], [True]))
            s = np.flatnonzero(ok[1:-1] & (turn[:-1] | ~ok[:-2]))
            e = np.flatnonzero(ok[1:-1] & (turn[1:] | ~ok[2:])) + 1
            # mixed once more (one to one): smallest hashes crowd at the low end, where a few buckets would hold them all
            parts.append((a + s, a + e, _mix(h[at[s]])))
        s, e, g = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(g, kind="stable")
        s, e, g = s[order], e[order], g[order]
        full = np.flatnonzero(self.sizes)
        doc = full[np.searchsorted(self.first[full], s, "right") - 1] if len(s) else np.zeros(0, np.int64)
        return s, e, g, doc

    def contexts(self, runs, wanted, bits):
        """Runs with a wanted anchor, their class among the block's contexts, and one context of each class.

        Whole buckets at a time, about CHUNK_RUNS runs each, so that the working arrays stay small.
        """
        g = runs[2][wanted]
        ends = [b for _, _, b in _by_bucket(g, bits)]
        at = 0
        for k, b in enumerate(ends):
            if b - at < CHUNK_RUNS and k + 1 < len(ends):
                continue
            s, e, g, doc = (x[wanted[at:b]] for x in runs)
            at = b
            length = e - s + WINDOW - 1
            text = Contexts(self.data[_spread(s, length)], length)
            _, one, cls = np.unique(classes(text, text.start, length), return_index=True, return_inverse=True)
            # contexts in order of their anchors, as the runs are
            rank = np.argsort(one, kind="stable")
            back = np.empty(len(rank), np.int64)
            back[rank] = np.arange(len(rank))
            yield s, e, doc, back[cls], one[rank], text, g


def _anchors(g: np.ndarray):
    """(distinct hashes, which of them every run has)."""
    new = np.concatenate(([True], g[1:] != g[:-1])) if len(g) else np.zeros(0, bool)
    return g[new], np.cumsum(new) - 1


def _by_bucket(g: np.ndarray, bits: int):
    """(bucket, from, to) of each bucket with hashes; ``g`` is sorted."""
    bucket = (g >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(g), np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    return zip(bucket[first].tolist(), first.tolist(), np.append(first[1:], len(g)).tolist())


def _read_blocks(batches):
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            yield Block(row), row


def make_blocks(batches):
    """Arrow batches of (doc_id, text) -> rows of BLOCKS."""
    part, number = TaskContext.get().partitionId(), 0
    ids, texts, held = [], [], 0

    def row():
        nonlocal ids, texts, held, number
        known = [i is not None for i in ids]
        out = pa.RecordBatch.from_pydict({
            "block": pa.array([part << 32 | number], pa.int64()),
            "ids": [np.array([i if i is not None else 0 for i in ids], np.int64).tobytes()],
            "nulls": [(~np.array(known, bool)).tobytes()], "sizes": [np.array(list(map(len, texts)), np.int64).tobytes()],
            "data": [zstandard.ZstdCompressor(level=3).compress(b"".join(texts))]})
        ids, texts, held, number = [], [], 0, number + 1
        return out

    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            ids.append(i)
            texts.append(t)
            held += len(t)
            if held >= BLOCK_BYTES:
                yield row()
    if ids:
        yield row()


def _send_anchors(bits: int):
    def run(batches):
        for block, _ in _read_blocks(batches):
            _, _, g, doc = block.runs()
            if not len(g):
                continue
            u, at = _anchors(g)
            first = np.flatnonzero(np.diff(at, prepend=-1))
            last = np.append(first[1:], len(g)) - 1
            several = doc[first] != doc[last]  # runs of an anchor are in text order
            part = (u << np.uint64(bits)) >> np.uint64(64 - FRAGMENT)
            raw = part.view(np.uint8).reshape(-1, 8)[:, :FRAGMENT // 8]
            yield pd.DataFrame([(k, block.number, raw[a:b].tobytes(), np.packbits(several[a:b]).tobytes())
                                for k, a, b in _by_bucket(u, bits)], columns=["bucket", "block", "part", "several"])
    return run


def _repeated(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of the anchors that blocks sent to one bucket, which are in several documents."""
    step, parts, several = FRAGMENT // 8, [], []
    for raw, bits in zip(pdf["part"], pdf["several"]):
        x = np.zeros((len(raw) // step, 8), np.uint8)
        x[:, :step] = np.frombuffer(raw, np.uint8).reshape(-1, step)
        parts.append(x.view(np.uint64).ravel())
        several.append(np.unpackbits(np.frombuffer(bits, np.uint8), count=len(x)).astype(bool))
    size = np.array([len(p) for p in parts])
    part, hit = np.concatenate(parts), np.concatenate(several)
    order = np.argsort(part, kind="stable")
    same = part[order][1:] == part[order][:-1]
    twice = np.concatenate(([False], same)) | np.concatenate((same, [False]))
    # a flag of one block holds for all that sent the anchor
    group = np.cumsum(~np.concatenate(([False], same))) - 1
    flagged = np.zeros(int(group[-1]) + 1, bool)
    flagged[group[hit[order]]] = True
    good = np.empty(len(part), bool)
    good[order] = twice | flagged[group]
    ends = np.cumsum(size)
    rows = [(b, k, np.packbits(good[e - n:e]).tobytes(), int(n)) for b, k, e, n in zip(pdf["block"], pdf["bucket"], ends, size)
            if good[e - n:e].any()]
    return pd.DataFrame(rows, columns=["block", "bucket", "bits", "n"])


def _wanted(block: Block, runs, answers, bits: int) -> np.ndarray:
    """Which runs have a repeated anchor, by the answers (bucket, bits, n) to a block."""
    u, at = _anchors(runs[2])
    good = np.zeros(len(u), bool)
    said = {a["bucket"]: a for a in answers}
    for k, a, b in _by_bucket(u, bits):
        if k in said:
            good[a:b] = np.unpackbits(np.frombuffer(said[k]["bits"], np.uint8), count=b - a).astype(bool)
    return np.flatnonzero(good[at])


def _send_contexts(bits: int):
    def run(batches):
        for block, row in _read_blocks(batches):
            runs = block.runs()
            for s, e, doc, cls, one, text, g in block.contexts(runs, _wanted(block, runs, row.answers, bits), bits):
                low = np.full(len(one), NO_ID, np.int64)
                np.minimum.at(low, cls, block.ids[doc])
                length, start, rows = text.length[one], text.start[one], []
                for k, a, b in _by_bucket(g[one], bits):
                    data = text.data[_spread(start[a:b], length[a:b])]
                    # the end of the hash tells anchors apart; a chance equality only makes more windows be compared
                    end = (g[one[a:b]] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                    rows.append((k, block.number, _pack(low[a:b]), end.tobytes(), _pack(length[a:b].astype(np.uint8)), _pack(data)))
                yield pd.DataFrame(rows, columns=["bucket", "block", "ids", "anchors", "lengths", "data"])
    return run


def _sorted_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """Suffix sort of one bucket: the smallest id of every window that the blocks sent.

    The anchors are taken in portions of about PORTION windows, one after another.
    """
    get = lambda c, t: np.concatenate([_unpack(x, t) for x in pdf[c]])
    sizes = [_unpack(x, np.uint8) for x in pdf["lengths"]]
    length = np.concatenate(sizes).astype(np.int64)
    data, ids = get("data", np.uint8), get("ids", np.int64)
    anchor = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["anchors"]])
    start, count = np.cumsum(length) - length, length - WINDOW + 1
    first = np.cumsum(count) - count
    low = np.empty(int(count.sum()), np.int64)
    portions = 1 + len(low) // PORTION
    portion = anchor % np.uint32(portions)
    for k in range(portions):
        at = np.flatnonzero(portion == k)
        if len(at):
            low[_spread(first[at], count[at])] = window_ids(
                data[_spread(start[at], length[at])], length[at], ids[at], anchor[at])
    ends = np.cumsum([int(x.sum(dtype=np.int64)) - (WINDOW - 1) * len(x) for x in sizes])
    return pd.DataFrame({"block": pdf["block"], "bucket": pdf["bucket"],
                         "low": [_pack(p) for p in np.split(low, ends[:-1])]})


def _marked(bits: int):
    def run(batches):
        for block, row in _read_blocks(batches):
            gone = np.zeros(len(block.data), bool)
            if row.lows is not None and len(row.lows):
                runs = block.runs()
                lows = {x["bucket"]: x["low"] for x in row.lows}
                edge = np.zeros(len(gone) + 1, np.int32)
                for s, e, doc, cls, one, text, g in block.contexts(runs, _wanted(block, runs, row.answers, bits), bits):
                    low = np.concatenate([_unpack(lows[k], np.int64) for k, _, _ in _by_bucket(g[one], bits)])
                    count = text.length[one] - WINDOW + 1
                    first = (np.cumsum(count) - count)[cls]
                    smaller = low[_spread(first, e - s)] < np.repeat(block.ids[doc], e - s)
                    at = _spread(s, e - s)[smaller]
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + WINDOW, -1)
                gone = np.cumsum(edge[:-1]) > 0
            out = []
            for i, known, a, n in zip(block.ids.tolist(), block.known, block.first.tolist(), block.sizes.tolist()):
                cut = gone[a:a + n]
                step = np.diff(cut.astype(np.int8), prepend=0, append=0)
                x, y = np.flatnonzero(step > 0), np.flatnonzero(step < 0)
                kept = block.data[a:a + n][~cut] if len(x) else block.data[a:a + n]
                out.append((i if known else None, n, int((y - x).sum()), len(x), hashlib.sha256(kept).hexdigest(),
                            [[p, q] for p, q in zip(x.tolist(), y.tolist())]))
            pdf = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])
            yield pdf.astype({"doc_id": "Int64"})
    return run


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` (removed byte ranges, end exclusive)."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    blocks = cut_lineage(docs.mapInArrow(make_blocks, BLOCKS))
    size = blocks.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, 3 * size / BUCKET_BYTES))))
    # numbers of partitions that follow the data: a task holds about one bucket, or BUCKET_BYTES of blocks, at every size
    buckets = lambda df: df.repartition(1 << bits, "bucket")
    by_block = lambda df: df.repartition(max(1, math.ceil(size / BUCKET_BYTES)), "block")
    sent = blocks.mapInPandas(_send_anchors(bits), "bucket long, block long, part binary, several binary")
    answers = buckets(sent).groupBy("bucket").applyInPandas(_repeated, "block long, bucket long, bits binary, n int")
    answers = cut_lineage(by_block(answers).groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers")))
    contexts = by_block(blocks).join(by_block(answers), "block").mapInPandas(
        _send_contexts(bits), "bucket long, block long, ids binary, anchors binary, lengths binary, data binary")
    lows = buckets(contexts).groupBy("bucket").applyInPandas(_sorted_bucket, "block long, bucket long, low binary")
    lows = cut_lineage(by_block(lows).groupBy("block").agg(F.collect_list(F.struct("bucket", "low")).alias("lows"))
                       .join(by_block(answers), "block"))
    return by_block(blocks).join(by_block(lows), "block", "left").mapInPandas(
        _marked(bits), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>")


def query(spark, sf_dir) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")
