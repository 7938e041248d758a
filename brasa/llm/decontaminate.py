"""Benchmark decontamination: BM25 inverted index of test items with block-max pruning.

The test items are indexed; every passage of every training document is a
query. Impacts are BM25 term weights divided by the item's own score, so one
threshold (share of an item's weight found in the passage) holds for all
items. Three exact upper bounds prune in the order of weak-AND evaluation:

1. essential terms: the rarest terms that carry ``ESSENTIAL`` of an item's
   weight. What a passage lacks of them cannot be made up by the rest, so
   (passage, item) pairs whose essential share is below threshold -
   (1 - essential share) are skipped. This runs over the postings of a whole
   batch at once;
2. block maxima: of a surviving passage, postings are summed per block of
   items with the block's largest impact; blocks below the threshold are skipped;
3. the items of the remaining blocks are scored in full.

All items at or above the threshold are retrieved (no top-k), then question
and answer are verified: the share of their word bigrams that occur in the
passage and its surroundings, both at least ``OVERLAP``. The question is all
but the last line of an item (or the first two thirds of a one-line item), the
answer is the rest. Words are lower-cased runs of letters, digits and
underscores, so punctuation glued to a word does not hide it.

The index is broadcast in shards of at most ``SHARD_BYTES`` of item text
(measured first); each shard is one more pass over the documents, and document
frequencies are those of all items. A document is never split over tasks, so
there is no shuffle of documents at all.

Defined results: null or empty texts and items match nothing; repeated
documents are judged one by one; repeated items are items of their own; an
empty documents or benchmark table gives an empty result; only the named
columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from brasa.session import cut_lineage

from .common import table

THRESHOLD = 0.75
OVERLAP = 0.6
ESSENTIAL = 0.6
K1, B = 1.2, 0.75
BLOCK = 16
SHARD_BYTES = 16_000_000
SCHEMA = "row_key long, doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
WORD = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer of an item."""
    lines = [t for t in map(tokens, (text or "").split("\n")) if t]
    if len(lines) > 1:
        return [w for line in lines[:-1] for w in line], lines[-1]
    w = lines[0] if lines else []
    cut = (2 * len(w) + 2) // 3
    return w[:cut], w[cut:]


def overlap(part: list[str], bigrams: set, single: set) -> float:
    """Share of the bigrams of ``part`` that are in the passage (of its word, if it has only one)."""
    if len(part) < 2:
        return float(all(w in single for w in part))
    return sum(p in bigrams for p in zip(part, part[1:])) / (len(part) - 1)


class Index:
    """Postings of one shard of items, impacts normalised to each item's own score."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], n_items: int, mean_len: float,
                 threshold: float = THRESHOLD):
        self.threshold, self.items = threshold, items
        self.parts = [question_answer(t) for _, t in items]
        words = [q + a for q, a in self.parts]
        self.longest = max(map(len, words), default=0)
        #: two passages a stride apart overlap by half, and half a passage holds the longest item
        self.stride = max(32, self.longest)
        self.vocab = {w: i for i, w in enumerate(sorted({w for x in words for w in x}))}
        term, item, impact, essential = [], [], [], []
        self.need = np.zeros(len(items))
        for i, w in enumerate(words):
            if not w:
                self.need[i] = np.inf
                continue
            weight = {}
            for t, tf in Counter(w).items():
                idf = math.log(1 + (n_items - df[t] + 0.5) / (df[t] + 0.5))
                weight[t] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean_len))
            own, got = sum(weight.values()), 0.0
            for t in sorted(weight, key=lambda t: (df[t], t)):
                term.append(self.vocab[t])
                item.append(i)
                impact.append(weight[t] / own)
                essential.append(got < ESSENTIAL)
                got += weight[t] / own * (got < ESSENTIAL)
            self.need[i] = threshold - (1 - got) - 1e-9
        term, item, impact, essential = (np.array(x) for x in (term, item, impact, essential))
        v = len(self.vocab)
        self.postings = self._lists(term, item, impact, v)
        self.essential = self._lists(term[essential], item[essential], impact[essential], v) if len(term) else None
        block: dict[tuple[int, int], float] = {}
        for t, i, x in zip(term, item, impact):
            block[t, i // BLOCK] = max(block.get((t, i // BLOCK), 0.0), x)
        keys = np.array(list(block), np.int64).reshape(-1, 2)
        self.blocks = self._lists(keys[:, 0], keys[:, 1], np.array(list(block.values())), v)

    @staticmethod
    def _lists(term, other, impact, v):
        order = np.lexsort((other, term))
        return np.searchsorted(term[order], np.arange(v + 1)), other[order].astype(np.int64), impact[order]

    @staticmethod
    def _expand(lists, terms):
        """Postings of each of ``terms`` one after another: (which of terms, item or block, impact)."""
        at, other, impact = lists
        n = at[terms + 1] - at[terms]
        which = np.repeat(np.arange(len(terms)), n)
        pos = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at[terms], n)
        return which, other[pos], impact[pos]

    def candidates(self, term: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """Passages (each of cell c and c + 1) with an item whose essential share is large enough."""
        which, item, impact = self._expand(self.essential, term)
        n = len(self.items)
        passage = np.concatenate((cell[which], cell[which] - 1))
        key = passage * n + np.tile(item, 2)
        full = key * len(self.vocab) + np.tile(term[which], 2)
        full, first = np.unique(full, return_index=True)  # a term counts once in a passage
        key, impact = key[first], np.tile(impact, 2)[first]
        edge = np.flatnonzero(np.diff(key, prepend=key[0] - 1 if len(key) else 0))
        share = np.add.reduceat(impact, edge) if len(edge) else impact
        key = key[edge]
        return np.unique((key // n)[share >= self.need[key % n]])

    def retrieve(self, terms: np.ndarray) -> list[tuple[int, float]]:
        """All items at or above the threshold for one passage's distinct terms, by block maxima first."""
        _, block, top = self._expand(self.blocks, terms)
        bound = np.bincount(block, top, (len(self.items) + BLOCK - 1) // BLOCK)
        alive = bound >= self.threshold - 1e-9
        if not alive.any():
            return []
        _, item, impact = self._expand(self.postings, terms)
        live = alive[item // BLOCK]
        score = np.bincount(item[live], impact[live], len(self.items))
        return [(int(i), float(score[i])) for i in np.flatnonzero(score >= self.threshold - 1e-9)]

    def search(self, texts: list[str | None]):
        """(text, item, score, question overlap, answer overlap) of every verified hit, best passage per item."""
        words, term, cell, owner, start, base = [], [], [], [], [], 1
        get = self.vocab.get
        for k, text in enumerate(texts):
            w = tokens(text)
            ids = np.fromiter((get(x, -1) for x in w), np.int64, len(w))
            known = np.flatnonzero(ids >= 0)
            term.append(ids[known])
            cell.append(base + known // self.stride)
            n = len(w) // self.stride + 2  # one empty cell between texts: no passage spans two
            owner.append(np.full(n, k))
            start.append(np.arange(n) * self.stride)
            words.append(w)
            base += n
        term, cell = np.concatenate(term), np.concatenate(cell)
        if not len(term):
            return
        owner, start = np.concatenate(owner), np.concatenate(start)
        found: dict[tuple[int, int], tuple[float, float, float]] = {}
        for p in self.candidates(term, cell).tolist():
            a, b = np.searchsorted(cell, (p, p + 2))
            hits = self.retrieve(np.unique(term[a:b]))
            if not hits:
                continue
            at = max(p, 1)  # the passage before a text's first cell is its first cell alone
            k = int(owner[at - 1]) if at == p else int(owner[0])
            if cell[a:b].size and owner[cell[a] - 1] != k:
                k = int(owner[cell[a] - 1])
                begin = int(start[cell[a] - 1]) - self.stride
            else:
                begin = int(start[at - 1]) if at == p else -self.stride
            near = words[k][max(0, begin - self.longest):begin + 2 * self.stride + self.longest]
            bigrams, single = set(zip(near, near[1:])), set(near)
            for i, score in hits:
                q, ans = (overlap(x, bigrams, single) for x in self.parts[i])
                if q >= OVERLAP and ans >= OVERLAP:
                    found[k, i] = max(found.get((k, i), (0.0, 0.0, 0.0)), (score, q, ans))
        for (k, i), (score, q, ans) in found.items():
            yield k, self.items[i][0], score, q, ans


def _statistics(benchmark: DataFrame, item_id: str, text: str) -> tuple[int, list[DataFrame]]:
    """Shards of the items, each of at most SHARD_BYTES of text (one item at least)."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"),
                             F.coalesce(F.col(text), F.lit("")).alias("text"))
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    shards = max(1, math.ceil(size / SHARD_BYTES * 1.25))
    return n, [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == s) for s in range(shards)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row and benchmark item found in it (``SCHEMA``); ``row_key`` is xxhash64 of the text."""
    spark = docs.sparkSession
    queries = docs.select(F.xxhash64(text).alias("row_key"), F.col(doc_id).cast("long").alias("doc_id"),
                          F.col(text).alias("text"))
    n, shards = _statistics(benchmark, item_id, item_text)
    out = spark.createDataFrame([], SCHEMA)
    if not n:
        return out
    rows = [[(r.item_id, r.text) for r in s.orderBy("item_id", "text").toLocalIterator()] for s in shards] \
        if len(shards) == 1 else None
    df, length = Counter(), 0
    for shard in shards if rows is None else rows:
        for r in (shard.toLocalIterator() if rows is None else shard):
            w = tokens(r[1])
            df.update(set(w))
            length += len(w)
    hits = []
    for s, shard in enumerate(shards):
        items = rows[0] if rows else [(r.item_id, r.text) for r in shard.orderBy("item_id", "text").collect()]
        index = Index(items, {w: df[w] for _, t in items for w in tokens(t)}, n, max(1.0, length / n), threshold)
        if not index.vocab:
            continue
        sent = spark.sparkContext.broadcast(index)

        def search(batches, sent=sent):
            for pdf in batches:
                for lo in range(0, len(pdf), 256):
                    part = pdf.iloc[lo:lo + 256]
                    found = list(sent.value.search(part["text"].tolist()))
                    if found:
                        k, item, score, q, a = zip(*found)
                        k = list(k)
                        yield pd.DataFrame({
                            "row_key": part["row_key"].iloc[k].to_numpy(), "doc_id": part["doc_id"].iloc[k].array,
                            "item_id": pd.array(item, "Int64"), "score": np.round(score, 6),
                            "question_overlap": np.round(q, 6), "answer_overlap": np.round(a, 6)})

        hits.append(queries.mapInPandas(search, SCHEMA))
    for h in hits:
        out = out.unionByName(h)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents in which no benchmark item was found."""
    # written first: its measured size decides between a broadcast and a shuffle of the documents
    bad = cut_lineage(find_leaks(docs, benchmark).select(
        F.col("doc_id").alias("__id"), F.col("row_key").alias("__key")).distinct())
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"),
                       F.xxhash64("text").alias("key"))
    return rows.join(bad, F.col("id").eqNullSafe(F.col("__id")) & (F.col("key") == F.col("__key")),
                     "left_anti").select("row.*")


def query(spark, sf_dir) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")
