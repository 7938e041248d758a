"""Spelling variants against plain comparison of all words."""

import re
import zlib
from collections import Counter

import pytest

from brasa.llm import spelling

from .conftest import EDGES


def words_of(rows, plant=spelling.PLANT):
    n = Counter()
    for key, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zA-ZÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % plant == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n):
    near = {w: [] for w in n}
    holes = {}
    for w in n:  # words within one edit share the word itself or the word less a letter, at any place
        for i in range(len(w)):
            holes.setdefault(w[:i] + w[i + 1:], set()).add(w)
        holes.setdefault(w, set()).add(w)
    for group in holes.values():
        for a in group:
            near[a] += [b for b in group if b != a and one_edit(a, b)]
    near = {w: set(b) for w, b in near.items()}
    form = {}
    for w, c in n.items():
        top = min(near[w], key=lambda b: (-n[b], b), default=None)
        if top is not None and n[top] >= 10 * c:
            form[w] = top
    out = set()
    for w, c in n.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, c, len(near[w]), n[form[w]] if w in form else None))
    return out


def rows_of(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = brute(words_of([(r.doc_id, r.text) for r in docs]))
    assert rows_of(spelling.query(spark, sf)) == want and len(want) > 1000


def test_chains_ties_accents_and_repeats(spark, docs):
    text = ("necessary " * 1000 + "necesary " * 100 + "necesry " * 3 + "Necessaré " * 2 + "Àccentué " * 30
            + "àccentué " * 2 + "aabbccdd aabccdd " * 2 + "beginner beginnex beginney " * 2)
    out = {r.word: r for r in spelling.spelling_variants(docs([(1, text), (2, None), (3, "")])).collect()}
    assert out["necesry"].form == "necesary" and out["necesry"].root == "necessary" and out["necesary"].form_n == 1000
    assert out["necessaré"].form == "necessary" and out["necessary"].form is None and out["necessary"].root == "necessary"
    assert out["àccentué"].form == "Àccentué"
    assert out["aabccdd"].n_near == 1 and out["beginnex"].n_near == 2 and out["beginnex"].form is None
    assert {w: r.n for w, r in out.items()}["necessary"] == 1000


def test_rounds_and_pages_change_nothing(spark, sf, monkeypatch):
    want = rows_of(spelling.query(spark, sf))
    monkeypatch.setattr(spelling, "PAGE_BLOCKS", 4)
    monkeypatch.setattr(spelling, "ROUND_BYTES", 4096)
    # a full filter says yes to everything, so only the exact join is left
    monkeypatch.setattr(spelling, "BITS", 2)
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    few = rows_of(spelling.spelling_variants(docs))
    monkeypatch.undo()
    assert few == rows_of(spelling.spelling_variants(docs)) and len(few) > 100 and len(want) > len(few)


@pytest.mark.parametrize("piece", [16, 1 << 20])
def test_long_texts_and_long_words(spark, docs, piece, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", piece)
    long = "abcdefghij" * 300
    rows = [(1, ("spelling " * 5 + "spellings ") * 400), (2, long), (3, f"{long} x{long}"), (4, f"x{long}")]
    assert rows_of(spelling.spelling_variants(docs(rows))) == {
        ("spelling", None, "spelling", 2000, 1, None), ("spellings", None, "spellings", 400, 1, None),
        (long, None, long, 2, 1, None), ("x" + long, None, "x" + long, 2, 1, None)}


def test_edges_and_empty(spark, docs, edges):
    rows = [(r[0], r[1]) for r in EDGES]
    assert rows_of(spelling.spelling_variants(edges, plant=spelling.PLANT)) == brute(words_of(rows))
    assert spelling.spelling_variants(docs([])).count() == 0
    assert spelling.spelling_variants(docs([(1, None), (2, "short words only")])).count() == 0
