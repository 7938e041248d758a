"""Personal data: base patterns and a linear-chain conditional random field.

Base kinds (email, ip, card, phone) are found by pattern, leftmost and without
overlaps, and checked (parts up to 255, Luhn, digit counts). A linear-chain
CRF over word-shape features then adds spans of numbers that the patterns
miss (phone numbers without a plus sign, identity and account numbers). It is
trained on the labelled lines below plus runs from a bounded sample of
``SAMPLE`` documents that hold digits: runs whose tokens are base hits or are
certainly no personal number. Runs with any other number are left out, since
the base patterns cannot tell what it is. Decoding is Viterbi in numpy batches.

Only tokens with a digit may carry a label: every other token is O by
constraint, and a token whose label is known cuts a chain in two. So decoding
the runs of tokens with digits, with the features of their neighbours, is
exact for the whole text, and texts without a digit or an @ cost one search.

Each document is judged on its own inside one Arrow batch: no shuffle. Defined
results: a null or empty text has no spans, repeated rows give repeated
results, an empty table gives an empty result (the field is then trained on
the lines below alone), and only the named columns are read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import table

SAMPLE = 200
#: Neighbouring tokens with at most so many digits in all are no phone, identity or account number; nor is a long hex string.
FEW_DIGITS = 5
_HASH = re.compile(r"[^0-9a-zA-Z]*[0-9a-f]{32,}[^0-9a-zA-Z]*")
#: Training takes the first runs of a sampled document and the first tokens of a run; decoding takes all.
TRAIN_RUNS, TRAIN_TOKENS = 20, 32
KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", "phone", "phone+", "id", "id+")  # a plus sign continues a span
N_FEATURES = 4096
EXTRA = {"phone": "crf_phone", "id": "crf_id"}

# The labelled table: [kind text] marks a span, everything else is O.
LABELLED = """
call me at [phone 555-123-4567] today
phone: [phone (743) 555-3824] or write
my number is [phone 555 867 5309] thanks
tel [phone 020 7946 0958] for details
Tel. [phone 030 901820] Berlin
office [phone 0049 30 901820] fax
reach us on [phone 1-800-555-0199] any time
mobile [phone 07700 900123] after six
téléphone [phone 01 23 45 67 89] merci
teléfono [phone 91 123 45 67] gracias
appelez le [phone 06 12 34 56 78] demain
llame al [phone 600 123 456] por favor
phone [phone 212-555-0143] ext
cell [phone (212) 555-0187] home
contact [phone 555.867.5309] now
social security number [id 123-45-6789] on file
SSN [id 078-05-1120] was
ssn: [id 219-09-9999] and
tax id [id 12-3456789] issued
IBAN [id DE89 3704 0044 0532 0130 00] bank
account [id GB29 NWBK 6016 1331 9268 19] open
passport [id X1234567] expires
passport no [id C01X00T47] valid
DNI [id 12345678Z] madrid
id number [id 850101-1234] sweden
insurance number [id QQ123456C] issued
license [id D1234562] state
in 1999 the town had 12,500 people and 3 schools
it cost $45.99 or 30% less in 2021
chapter 12 page 345 line 6
version 2.10.3 was released on 2020-05-17
on 12/05/2019 at 10:30 the 2nd meeting
scores were 3-2 and 1-0 in 1986
see https://example.com/a/123?b=45 for 10 more
sha 8a67639f74080f56c5aa328f676226e236a23e23 ok
key 8e3b1c77fc4c011f1bd38f1f34920fbd01f40072 end
token = "e3cf347862554017cdf83fd989e60f210402362d" done
uuid 550e8400-e29b-41d4-a716-446655440000 row
order 3141592653589794 3141592653589794 shipped
the 1,234,567 rows took 89 seconds and 1024 MB
items 1 2 3 4 5 6 7 8 9 10
table 12 34 56 78 cells 100 200 300
a 747 and an A320 flew 3500 km
room 101 on floor 7 of block B2
10 000 000 people in 27 countries
25 000 000 or 12 500 each
pi is 3.14159 and e is 2.71828
isbn 978-3-16-148410-0 printed
win $$$1000 now!!! 100% free 24/7
2,5 kg und 3,75 m in 2 Tagen
1990-1995 and 2001-2010 were years
"""

_MARK = re.compile("[0-9@]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?: ?[0-9]|-[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_SPACES = " \t\n\x0b\x0c\r"
_WORD = re.compile(r"[^ \t-\r]+")


def _emails(t: str):
    done, at = 0, t.find("@")
    while at >= 0:
        start = at
        while start > done and t[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(t, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = t.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(t: str) -> list[list[tuple[int, int]]]:
    """Checked spans of each base kind."""
    if not _MARK.search(t):
        return [[], [], [], []]
    small = lambda p: len(p.lstrip("0")) <= 3 and int(p[-3:].lstrip("0") or 0) <= 255
    ip = [m.span() for m in _IP.finditer(t) if all(map(small, m[0].split(".")))]
    card = []
    for m in _CARD.finditer(t):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            card.append(m.span())
    phone = [m.span() for m in _PHONE.finditer(t) if 8 <= len(_DIGIT.findall(m[0])) <= 15]
    return [list(_emails(t)), ip, card, phone]


def shape(word: str) -> str:
    """Word shape: letters and digits by class, runs of digits with their length (up to 9), of letters without."""
    out, last, n = [], "", 0
    for c in word[:64] + "\0":
        k = "d" if c in "0123456789" else "X" if c.isupper() else "x" if c.isalpha() else c
        if k != last:
            if last == "d":
                out.append(str(min(n, 9)))
            last, n = k, 0
            out.append(k if k != "\0" else "")
        n += 1
    return "".join(out)


def features(words: list[str], i: int) -> list[int]:
    """Hashed features of token ``i``: its shape and those of its neighbours, and words that may announce a number."""
    out = []
    for k in (-2, -1, 0, 1, 2):
        w = words[i + k] if 0 <= i + k < len(words) else ""
        s = shape(w)
        out.append(f"s{k}:{s}")
        if k in (-1, 0, 1):
            out.append(f"c{k}:{re.sub('[0-9]', '', s)}:{min(sum(c.isdigit() for c in w), 12)}")
        if k < 0:
            out.append(f"w{k}:{w.lower().strip('.,:;()')}")
    out += [f"p:{shape(words[i])}|{shape(words[i + 1]) if i + 1 < len(words) else ''}", "bias"]
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % N_FEATURES for f in out]


def runs(text: str):
    """Runs of consecutive tokens with digits: (all words of the stretch, first and last + 1 in it, spans)."""
    seen = -1
    for m in _DIGIT.finditer(text):
        if m.start() < seen:
            continue
        a = m.start()
        while a and text[a - 1] not in _SPACES:
            a -= 1
        # two words before, then as far as tokens have digits, then two words after
        before = text[max(0, a - 200):a].split()[-2:]
        spans, at, after = [], a, []
        while True:
            w = _WORD.search(text, at)
            if not w or not (_DIGIT.search(w[0])):
                if w:
                    after = text[w.start():w.start() + 200].split()[:2]
                break
            spans.append(w.span())
            at = w.end()
        seen = at
        words = before + [text[x:y] for x, y in spans] + after
        yield words, len(before), len(before) + len(spans), spans


class Field:
    """Linear-chain CRF: emission weights by hashed feature, transition and start weights by tag."""

    def __init__(self):
        k = len(TAGS)
        self.w, self.t, self.s = np.zeros((N_FEATURES, k)), np.zeros((k, k)), np.zeros(k)
        self.allowed = np.array([[not b.endswith("+") or a.rstrip("+") == b[:-1] for b in TAGS] for a in TAGS])
        self.first = np.array([not t.endswith("+") for t in TAGS])

    def _padded(self, chains):
        n, longest = len(chains), max(map(len, chains))
        width = len(chains[0][0])
        x = np.zeros((n, longest, width), np.int64)
        for i, c in enumerate(chains):
            x[i, :len(c)] = c
        return x, np.array([len(c) for c in chains])

    def fit(self, chains: list[list[list[int]]], tags: list[list[int]], rounds: int = 150, rate: float = 0.1, l2: float = 1e-3):
        """Maximum likelihood by full-batch Adam; gradients from forward and backward sums."""
        x, n = self._padded(chains)
        y = np.zeros(x.shape[:2], np.int64)
        for i, t in enumerate(tags):
            y[i, :len(t)] = t
        live = np.arange(x.shape[1])[None] < n[:, None]
        k, rows = len(TAGS), np.arange(len(x))
        params = [self.w, self.t, self.s]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        lse = lambda a, axis: np.logaddexp.reduce(a, axis=axis)
        for step in range(1, rounds + 1):
            e = self.w[x].sum(axis=2)
            trans = np.where(self.allowed, self.t, -1e9)
            alpha, beta = np.zeros(e.shape), np.zeros(e.shape)
            alpha[:, 0] = e[:, 0] + np.where(self.first, self.s, -1e9)
            for j in range(1, e.shape[1]):
                nxt = lse(alpha[:, j - 1, :, None] + trans, 1) + e[:, j]
                alpha[:, j] = np.where(live[:, j, None], nxt, alpha[:, j - 1])
            z = lse(alpha[:, -1], 1)
            for j in range(e.shape[1] - 2, -1, -1):
                prev = lse(trans + (e[:, j + 1] + beta[:, j + 1])[:, None, :], 2)
                beta[:, j] = np.where(live[:, j + 1, None], prev, 0)
            p = np.exp(alpha + beta - z[:, None, None]) * live[..., None]
            g = p.copy()
            np.subtract.at(g, (rows[:, None], np.arange(x.shape[1])[None], y), live.astype(float))
            gw = np.zeros_like(self.w)
            np.add.at(gw, x, g[:, :, None, :])
            gs = g[:, 0].sum(axis=0)
            gt = np.zeros((k, k))
            for j in range(1, e.shape[1]):
                on = live[:, j]
                if on.any():
                    pair = np.exp(alpha[on, j - 1, :, None] + trans + (e[on, j] + beta[on, j])[:, None, :] - z[on, None, None])
                    gt += pair.sum(axis=0)
                    np.subtract.at(gt, (y[on, j - 1], y[on, j]), 1.0)
            for q, grad in enumerate((gw, gt, gs)):
                grad = grad / len(x) + l2 * params[q]
                m[q] = 0.9 * m[q] + 0.1 * grad
                v[q] = 0.999 * v[q] + 0.001 * grad * grad
                params[q] -= rate * (m[q] / (1 - 0.9 ** step)) / (np.sqrt(v[q] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def decode(self, chains: list[list[list[int]]]) -> list[list[int]]:
        """Viterbi paths of a batch; chains of similar length are padded together."""
        out: list[list[int]] = [[]] * len(chains)
        order = sorted(range(len(chains)), key=lambda i: len(chains[i]))
        trans = np.where(self.allowed, self.t, -1e9)
        while order:
            longest = len(chains[order[-1]])
            take = max(1, min(len(order), 200_000 // longest))
            part, order = order[-take:], order[:-take]
            x, n = self._padded([chains[i] for i in part])
            e = self.w[x].sum(axis=2)
            score = e[:, 0] + np.where(self.first, self.s, -1e9)
            back = np.zeros(e.shape, np.int64)
            back[:] = np.arange(len(TAGS))
            for j in range(1, e.shape[1]):
                path = score[:, :, None] + trans
                best = path.argmax(axis=1)
                on = (j < n)[:, None]
                score = np.where(on, path.max(axis=1) + e[:, j], score)
                back[:, j] = np.where(on, best, np.arange(len(TAGS)))
            tag = score.argmax(axis=1)
            tags = np.zeros(e.shape[:2], np.int64)
            for j in range(e.shape[1] - 1, -1, -1):
                tags[:, j] = tag
                tag = back[np.arange(len(part)), j, tag]
            for i, row, size in zip(part, tags.tolist(), n):
                out[i] = row[:size]
        return out


def _certain(text: str, spans: list[tuple[int, int]], known: list[tuple[int, int]]) -> bool:
    """Whether each token of a run is in a known span or certainly no personal number."""
    digits = 0
    for x, y in spans:
        if any(x < e and s < y for s, e in known) or _HASH.fullmatch(text, x, y):
            digits = 0
            continue
        digits += len(_DIGIT.findall(text, x, y))
        if digits > FEW_DIGITS:
            return False
    return True


def _learn(text: str, marked: list[tuple[int, int, str]], chains, tags, known: list[tuple[int, int]] | None = None):
    """Add the runs of a text to the training set; a token gets the kind of the marked span that it touches.

    With ``known`` spans, only the runs that these label with certainty.
    """
    usable = (r for r in runs(text) if known is None or _certain(text, r[3], known))
    for words, a, b, spans in islice(usable, TRAIN_RUNS):
        chains.append([features(words, i) for i in range(a, min(b, a + TRAIN_TOKENS))])
        row, last = [], None
        for x, y in spans[:TRAIN_TOKENS]:
            hit = next(((s, e, k) for s, e, k in marked if x < e and s < y), None)
            row.append(TAGS.index("O" if hit is None else hit[2] + ("+" if hit == last else "")))
            last = hit
        tags.append(row)


def train(docs: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Field:
    """Fit the field on the labelled lines and on at most ``sample`` documents with digits, lowest md5 of the id first."""
    chains, tags = [], []
    for line in LABELLED.strip().split("\n"):
        plain, marked, at = "", [], 0
        for m in re.finditer(r"\[(\w+) ([^\]]+)\]", line):
            plain += line[at:m.start()]
            marked.append((len(plain), len(plain) + len(m[2]), m[1]))
            plain += m[2]
            at = m.end()
        for _ in range(5):  # the written lines weigh as much as some hundred sampled runs
            _learn(plain + line[at:], marked, chains, tags)
    if docs is not None:
        # ids and text hashes first, then the texts of those alone, each once
        named = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"), F.xxhash64(text).alias("h")).where(
            F.col("t").rlike("[0-9]") & F.col("id").isNotNull())
        chosen = named.select("id", "h").distinct().orderBy(F.md5(F.col("id").cast("string")), "h").limit(sample).collect()
        rows = (named.where(F.col("id").isin([c.id for c in chosen]) & F.col("h").isin([c.h for c in chosen]))
                .dropDuplicates(["h"]).select("t").orderBy("t").limit(sample).collect())
        for r in rows:
            email, ip, card, phone = base_spans(r.t)
            _learn(r.t, [(a, b, "phone") for a, b in phone] + [(a, b, "id") for a, b in card], chains, tags, email + ip + card + phone)
    return Field().fit(chains, tags)


def scan(texts: list[str], field: Field):
    """(base spans by kind, added spans (kind, start, end)) of each text."""
    base, chains, where = [], [], []
    for d, t in enumerate(texts):
        base.append(base_spans(t))
        if any(map(len, base[-1])) or _DIGIT.search(t):
            for words, a, b, spans in runs(t):
                chains.append([features(words, i) for i in range(a, b)])
                where.append((d, spans))
    added: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for (d, spans), tags in zip(where, field.decode(chains) if chains else []):
        taken = [s for kind in base[d] for s in kind]
        i = 0
        while i < len(tags):
            name = TAGS[tags[i]]
            j = i + 1
            while j < len(tags) and TAGS[tags[j]] == name.rstrip("+") + "+" and name != "O":
                j += 1
            a, b = spans[i][0], spans[j - 1][1]
            while a < b and texts[d][a] in "\"'([{<,;:" and not (texts[d][a] == "(" and ")" in texts[d][a:b]):
                a += 1
            while b > a and not texts[d][b - 1].isalnum():
                b -= 1
            if name != "O" and a < b and not any(x < b and a < y for x, y in taken):
                added[d].append((EXTRA[name.rstrip("+")], a, b))
            i = j
    return base, added


def find_pii(df: DataFrame, doc_id: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``."""
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sent = df.sparkSession.sparkContext.broadcast(field or train(docs, "doc_id", "text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for pdf in batches:
            for lo in range(0, len(pdf), 512):
                part = pdf.iloc[lo:lo + 512]
                base, added = scan([t if isinstance(t, str) else "" for t in part["text"]], sent.value)
                out = {"doc_id": part["doc_id"].array} | {f"n_{k}": [len(b[i]) for b in base] for i, k in enumerate(KINDS)}
                listed = [",".join(f"{k}:{a}:{e}" for k, spans in zip(KINDS, b) for a, e in spans) for b in base]
                more = [",".join(f"{k}:{a}:{e}" for k, a, e in sorted(x)) for x in added]
                out["base_sha256"] = [hashlib.sha256(s.encode()).hexdigest() for s in listed]
                out["spans"] = [",".join(filter(None, s)) for s in zip(listed, more)]
                yield pd.DataFrame(out)

    return docs.mapInPandas(run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def query(spark, sf_dir) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))
