"""Spelling variants by Bloom-guided neighbourhoods.

Vocabulary: runs of letters are counted in Arrow batches (with the planted
misspellings of the contract in the query), pre-aggregated in the task and
summed by a shuffle on the word.

Filters: words are hashed by a polynomial with odd base modulo 2**64, so the
hash of an edited word follows from prefix sums without building it. Each word
length has a blocked Bloom filter of its own (512-bit blocks, one bit in each
of eight 64-bit lanes, ``BITS`` bits a word), built in pages by a shuffle and
broadcast in rounds of at most ``ROUND_BYTES``: the size of every broadcast is
bounded whatever the vocabulary; a larger vocabulary takes more rounds.

Neighbours: a pair one edit apart is met once, from the longer word by a
deletion, or from the word with the smaller letter by a replacement. Edits are
probed against the filter of their length; only positives, as (word, edit,
hash), are shuffled, joined with the vocabulary on the hash and compared
letter by letter, so neither a false positive of the filter nor a chance
equality of hashes is left.

Form: the most frequent neighbour, if ``RATIO`` times as frequent. Along forms
the counts grow by that factor, so chains are short and pointer doubling for
their largest possible length ends at the root.

Defined results: null and empty texts have no words; a null doc_id counts as
an empty one; repeated rows count again; very long texts are read in pieces
cut at spaces, and a very long run is one word; an empty table gives an empty
result; only the named columns are read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brasa.session import cut_and_count, cut_lineage

from .common import table, utf8

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
#: One run in so many has a letter removed in the registered query.
PLANT = 31
PIECE = 1 << 20
BITS = 16
PAGE_BLOCKS = 8192
ROUND_BYTES = 32 << 20
WORDS_PER_TASK = 32_768
#: Edits hashed at a time in a task.
CHUNK = 1 << 20
LANES = 8
BASE = np.uint64(0x9E3779B97F4A7C15)
_HELD = 300_000


def pieces(text: str):
    """Stretches of about PIECE characters, cut at spaces (a run of letters holds none)."""
    at = 0
    while at < len(text):
        end = text.find(" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def count_runs(plant: int | None, least: int):
    """Arrow batches of (id, text) -> (word, n), summed over a stretch of the task's documents.

    Runs shorter than ``least`` are never words: a removed letter only makes a run shorter.
    """
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def spread(found: Counter, key: str):
        start = zlib.crc32(f"{key}:".encode())
        for run, n in found.items():
            if plant and (h := zlib.crc32(run.encode(), start)) % plant == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= least:
                yield run, n

    def batch(total: Counter):
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                          ["word", "n"])

    def run(batches):
        total = Counter()
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                found = Counter()
                for piece in pieces(text.lower().decode()):  # bytes.lower() changes A-Z only
                    found.update(runs.findall(piece))
                for word, n in spread(found, "" if key is None else key):
                    total[word] += n
                if len(total) > _HELD:
                    yield batch(total)
                    total = Counter()
        yield batch(total)
    return run


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the polynomial hash over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, one row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _terms(codes: np.ndarray) -> np.ndarray:
    """What a letter adds to the hash at place 0: code points spread over 64 bits."""
    return mix(codes.astype(np.uint64) + np.uint64(1))


def _powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.cumprod(np.full(n - 1, BASE)) if n > 1 else out[1:]
    return out


_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def hashes(codes: np.ndarray) -> np.ndarray:
    return (_terms(codes) * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


def _hashed(batches):
    for pdf in batches:
        size = pdf["word"].str.len().to_numpy()
        h = np.zeros(len(pdf), np.uint64)
        for length in np.unique(size):
            at = np.flatnonzero(size == length)
            h[at] = hashes(_letters(pdf["word"].iloc[at].to_list()))
        yield pdf.assign(h=h.view(np.int64), length=size.astype(np.int32))


def block_of(mixed: np.ndarray, blocks) -> np.ndarray:
    """Block of a filter with ``blocks`` blocks (less than 2**31): the high half scaled to that number."""
    return ((mixed >> np.uint64(32)) * np.asarray(blocks, np.uint64)) >> np.uint64(32)


def _bit(mixed: np.ndarray, lane: int) -> np.ndarray:
    """The bit that a hash sets in a lane: six bits of a second mix."""
    return np.uint64(1) << ((mixed >> np.uint64(6 * lane)) & np.uint64(63))


def _page_rows(batches):
    for pdf in batches:
        mixed = mix(pdf["h"].to_numpy(np.int64).view(np.uint64))
        block = block_of(mixed, pdf["blocks"].to_numpy(np.int64))
        yield pdf[["length", "h"]].assign(page=(block // np.uint64(PAGE_BLOCKS)).astype(np.int32),
                                          slot=(block % np.uint64(PAGE_BLOCKS)).astype(np.int32), blocks=pdf["blocks"])


def _page(pdf: pd.DataFrame) -> pd.DataFrame:
    first, blocks = int(pdf["page"].iloc[0]) * PAGE_BLOCKS, int(pdf["blocks"].iloc[0])
    lanes = np.zeros((min(PAGE_BLOCKS, blocks - first), LANES), np.uint64)
    again = mix(mix(pdf["h"].to_numpy(np.int64).view(np.uint64)) + np.uint64(1))
    for lane in range(LANES):
        np.bitwise_or.at(lanes[:, lane], pdf["slot"].to_numpy(), _bit(again, lane))
    return pd.DataFrame([(int(pdf["length"].iloc[0]), int(pdf["page"].iloc[0]), blocks, lanes.tobytes())],
                        columns=["length", "page", "blocks", "bits"])


class Filter:
    """Pages of the Bloom filter of one word length."""

    def __init__(self, blocks: int, pages: dict[int, bytes]):
        self.blocks, self.whole = blocks, len(pages) * PAGE_BLOCKS >= blocks
        self.at = np.full(-(-blocks // PAGE_BLOCKS), -1, np.int64)
        self.lanes = np.concatenate([np.frombuffer(b, np.uint64).reshape(-1, LANES) for b in pages.values()])
        first = 0
        for page, b in pages.items():
            self.at[page] = first
            first += len(b) // (8 * LANES)

    def has(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be words (those of absent pages are not looked at)."""
        mixed = mix(h)
        block = block_of(mixed, self.blocks).astype(np.int64)
        some = np.arange(len(h))
        if not self.whole:
            some = np.flatnonzero(self.at[block // PAGE_BLOCKS] >= 0)
            block = block[some]
        block = self.at[block // PAGE_BLOCKS] + block % PAGE_BLOCKS
        mixed = mix(mixed[some] + np.uint64(1))
        for lane in range(LANES):
            hit = self.lanes[block, lane] & _bit(mixed, lane) != 0
            some, block, mixed = some[hit], block[hit], mixed[hit]
        return some


def filter_pages(vocabulary: DataFrame) -> DataFrame:
    """``length, page, blocks, bits``: the filters of all lengths, in pages."""
    blocks = F.ceil(F.count("*") * BITS / (64 * LANES)).cast("long")
    lengths = vocabulary.groupBy("length").agg(blocks.alias("blocks"))
    rows = vocabulary.select("length", "h").join(lengths, "length").mapInPandas(
        _page_rows, "length int, h long, page int, slot int, blocks long")
    return rows.groupBy("length", "page").applyInPandas(_page, "length int, page int, blocks long, bits binary")


def _edits(h: np.ndarray, codes: np.ndarray, alphabet: np.ndarray):
    """Hashes of the edits of words of one length: yields (deletion?, hashes, word, place, letter) in bounded portions.

    A run of equal letters loses its last one only; letters are replaced by larger ones.
    """
    n, size = codes.shape
    powers, letters = _powers(size), _terms(alphabet)
    places = max(1, CHUNK // max(1, n))
    for a in range(0, size, places):
        b = min(size, a + places)
        terms = _terms(codes) * powers
        before = np.cumsum(terms, axis=1, dtype=np.uint64)
        # what follows a place moves down by one
        short = (before - terms)[:, a:b] + (before[:, -1:] - before)[:, a:b] * _INVERSE
        last = np.ones((n, b - a), bool)
        stop = min(b, size - 1)
        last[:, :stop - a] = codes[:, a:stop] != codes[:, a + 1:stop + 1]
        word, place = np.nonzero(last)
        yield True, short[word, place], word, place + a, np.zeros(len(word), np.int64)
    places = max(1, CHUNK // max(1, n * len(alphabet)))
    for a in range(0, size, places):
        b = min(size, a + places)
        old = codes[:, a:b]
        word, place, letter = np.nonzero(alphabet > old[:, :, None])
        new = h[word] + (letters[letter] - _terms(old)[word, place]) * powers[place + a]
        yield False, new, word, place + a, alphabet[letter].astype(np.int64)


def _probe(filters, alphabet: np.ndarray):
    def run(batches):
        known = filters.value
        for pdf in batches:
            for length, part in pdf.groupby("length"):
                if length not in known and length - 1 not in known:
                    continue
                # few words of a great length at a time
                few = max(1, CHUNK // int(length))
                for s in range(0, len(part), few):
                    rows = part.iloc[s:s + few]
                    h = rows["h"].to_numpy(np.int64).view(np.uint64)
                    for gone, keys, word, place, letter in _edits(h, _letters(rows["word"].to_list()), alphabet):
                        f = known.get(length - 1 if gone else length)
                        if f is not None and len(hit := f.has(keys)):
                            yield pd.DataFrame({"h": h[word[hit]].view(np.int64), "place": place[hit],
                                                "letter": letter[hit], "key": keys[hit].view(np.int64)})
    return run


def near_words(vocabulary: DataFrame, n_words: int) -> DataFrame:
    """``a, b`` (words), each pair one edit apart once; ``vocabulary`` has ``word, n, h, length``."""
    spark = vocabulary.sparkSession
    letters = vocabulary.select(F.explode(F.split("word", "")).alias("c")).distinct().collect()  # at most the 90 letters of a run
    alphabet = np.array(sorted(ord(r.c) for r in letters if r.c), np.uint32)
    pages = cut_lineage(filter_pages(vocabulary))
    sizes = pages.select("length", "page", F.length("bits").alias("bytes")).toPandas().sort_values(["length", "page"])
    sizes["round"] = (sizes["bytes"].cumsum() - 1) // ROUND_BYTES if len(sizes) else 0
    words = vocabulary.repartition(max(1, -(-n_words // WORDS_PER_TASK)), "h").select("word", "h", "length")
    hits = None
    for _, mine in sizes.groupby("round"):
        low, high = mine.iloc[0], mine.iloc[-1]
        after = (F.col("length") > int(low.length)) | ((F.col("length") == int(low.length)) & (F.col("page") >= int(low.page)))
        upto = (F.col("length") < int(high.length)) | ((F.col("length") == int(high.length)) & (F.col("page") <= int(high.page)))
        got: dict[int, tuple[int, dict[int, bytes]]] = {}
        for r in pages.where(after & upto).collect():  # at most ROUND_BYTES and a page
            got.setdefault(r.length, (r.blocks, {}))[1][r.page] = bytes(r.bits)
        filters = spark.sparkContext.broadcast({k: Filter(b, p) for k, (b, p) in got.items()})
        probed = words.where(F.col("length").between(int(low.length), int(high.length) + 1)).mapInPandas(
            _probe(filters, alphabet), "h long, place int, letter int, key long")
        hits = cut_lineage(probed) if hits is None else hits.unionByName(cut_lineage(probed))
    if hits is None:
        return spark.createDataFrame([], "a string, b string")
    letter = F.when(F.col("letter") == 0, "").otherwise(F.char(F.col("letter").cast("long")))
    edited = F.concat(F.expr("substring(a, 1, place)"), letter, F.expr("substring(a, place + 2)"))
    there = vocabulary.select(F.col("h").alias("key"), F.col("word").alias("b"))
    source = vocabulary.select("h", F.col("word").alias("a"))
    return hits.join(there, "key").join(source, "h").where(edited == F.col("b")).select("a", "b")


def variants(counted: DataFrame, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of ``(word, n)`` rows, summed over equal words."""
    words = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    vocabulary, n_words = cut_and_count(words.mapInPandas(_hashed, "word string, n long, h long, length int"))
    pairs = cut_lineage(near_words(vocabulary, n_words))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = vocabulary.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    near = both.join(other, "b").groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("n"), "b")).alias("top"))
    grown = -F.col("top.n") >= ratio * F.col("n")
    found = cut_lineage(vocabulary.select("word", "n").join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(grown, F.col("top.b")).alias("form"), F.when(grown, -F.col("top.n")).alias("form_n")))
    # counts grow by the ratio from a word to its form, which bounds the length of a chain
    most = found.agg(F.max("n")).first()[0] or 1
    steps = math.ceil(math.log2(max(1, math.log(most, ratio) + 1))) if ratio > 1 else 0
    roots = found.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(steps):
        roots = cut_lineage(roots.join(roots.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
                            .select("word", F.coalesce("next", "root").alias("root")))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(df: DataFrame, doc_id: str = "doc_id", text: str = "text", plant: int | None = None,
                      least: int = MIN_LENGTH) -> DataFrame:
    """:func:`variants` of the runs of letters in ``text``; ``plant`` removes a letter from one run in so many."""
    rows = df.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))
    return variants(rows.mapInArrow(count_runs(plant, least), "word string, n long"))


def query(spark, sf_dir) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), plant=PLANT)
