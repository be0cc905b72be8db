"""Secrets in texts: fixed patterns, and strings that pass a randomness battery.

Candidates are long runs of one encoding's alphabet. For each the battery gives a p-value of being
ordinary text and checks that it is as even and irregular as random symbols (chi-squared, runs test,
serial correlation). Ordinary text is a Markov chain counted over the whole table: changes between small
letters, capitals, digits and marks, and pairs of letters. The p-value is the ratio of the string's
likelihood under it to that under even symbols: by Markov's inequality text has a ratio of r or less with a
probability of r at most, at any length and for any alphabet. The p-values of all candidates of one length
band are held to one false-discovery rate.
"""
from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from staffhouse.llm.common import stage, texts

# fixed values: the base kinds, in the order in which ties are listed
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")       # a run that holds 20 characters: shorter runs are dropped whole
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
LEAST = 20              # characters of a candidate, with its padding; 16 of them are symbols at least
# '=' belongs to a run as padding at its end only; inside it parts a name from a value
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:=+(?![A-Za-z0-9+/_=-]))?")
# sub-runs of one alphabet (either base64, or letters and digits only)
PARTS = tuple(re.compile(x + r"+(?:=+$)?") for x in ("[A-Za-z0-9+/]", "[A-Za-z0-9_-]", "[A-Za-z0-9]"))
ENCODINGS = (("digits", "0123456789"), ("hex", "0123456789abcdef"), ("HEX", "0123456789ABCDEF"), ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
             ("alnum", "0123456789abcdefghijklmnopqrstuvwxyz"), ("ALNUM", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
             ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
             ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"))
_TABLES = [(name, len(a), dict(zip(a, range(len(a))))) for name, a in ENCODINGS]
# the characters whose sequence is counted, in four classes: small letters, capitals, digits, marks
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/-_"
CLASS = np.array([0] * 26 + [1] * 26 + [2] * 10 + [3] * 4)
_CODES = np.zeros(256, np.int16)        # byte -> 1 + number of the symbol; 0 for all others
_CODES[list(SYMBOLS.encode())] = np.arange(1, len(SYMBOLS) + 1)
SIDE = len(SYMBOLS) + 1
WORD = 20               # a longer run of letters and digits may be a secret and is not counted as text
# shares of the class after each class that every table is mixed with, so that what never occurs in it is rare only
USUAL = np.array([[0.97, 0.01, 0.01, 0.01], [0.45, 0.50, 0.02, 0.03], [0.05, 0.05, 0.85, 0.05], [0.50, 0.20, 0.20, 0.10]])
MIXED = 0.1
MAX_BAND = 32
BINS, FLOOR = 400, 40.0         # p-values are counted in bins of their logarithm
LEVEL, RATE = 0.001, 0.001      # of the regularity tests; false-discovery rate of each band


def _normal_below(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def infer(s: str) -> tuple[str, int, np.ndarray] | None:
    """The smallest alphabet that holds the string (padding aside), its size and the symbols' numbers."""
    body = s.rstrip("=")
    for name, k, table in _TABLES:
        if all(c in table for c in set(body)):
            return name, k, np.array([table[c] for c in body])
    return None


def covered(s: int, e: int, spans: list[tuple[int, int, int]]) -> bool:
    """Whether spans, sorted by start, leave nothing of s to e."""
    for a, _, b in spans:
        if a > s:
            break
        s = max(s, b)
    return s >= e


def count_pairs(text: str) -> np.ndarray:
    """How often each symbol follows each other one (0 stands for any other character), at first * SIDE + second."""
    total = np.zeros(SIDE * SIDE, np.int64)
    x = _CODES[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]
    inside = (x > 0) & (x <= 62)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))).reshape(-1, 2)
    for a, b in edge[edge[:, 1] - edge[:, 0] >= WORD]:
        x[a:b] = 0
    for low in range(0, len(x) - 1, 1 << 20):       # each pair once
        part = x[low:low + (1 << 20) + 1]
        total += np.bincount(part[:-1] * np.int16(SIDE) + part[1:], minlength=SIDE * SIDE)
    return total


def text_model(pairs: np.ndarray) -> np.ndarray:
    """Logarithm of the probability of each symbol after each other one in text; the last row is for the first symbol."""
    n = pairs.reshape(SIDE, SIDE)[1:, 1:].astype(float)
    each = n.sum(axis=0)
    k = len(SYMBOLS)
    change = np.array([[n[np.ix_(CLASS == a, CLASS == b)].sum() for b in range(4)] for a in range(4)])
    change = (1 - MIXED) * (change + 100 * USUAL) / (change.sum(axis=1, keepdims=True) + 100) + MIXED * USUAL
    fold = np.where(CLASS == 1, np.arange(k) - 26, np.arange(k))
    letters = np.bincount(fold[:52], each[:52], 26) + 10
    letters /= letters.sum()
    # pairs of small letters, and of capitals, count together; a change of case inside a word says nothing of the next letter
    same = n[:26, :26] + n[26:52, 26:52] + n[26:52, :26]
    after = (1 - MIXED) * (same + 50 * letters) / (same.sum(axis=1, keepdims=True) + 50) + MIXED * letters
    marks = (each[62:] + 10) / (each[62:] + 10).sum()
    alone = np.concatenate([letters, letters, np.full(10, 0.1), marks])
    p = np.tile(alone, (k, 1))
    p[:26, :26] = p[26:52, :26] = p[26:52, 26:52] = after
    share = np.array([each[CLASS == c].sum() for c in range(4)]) + 100 * USUAL.mean(axis=0)
    share = (1 - MIXED) * share / share.sum() + MIXED / 4
    return np.log(np.vstack([p * change[CLASS][:, CLASS], alone * share[CLASS]]))


def battery(s: str, model: np.ndarray) -> tuple[float, float] | None:
    """(-ln p of being text, p of being as regular as this by chance); None for strings without an encoding,
    of one kind of letters and for all-digit strings (numbers are not secrets by themselves)."""
    if s.isalpha() and (s.islower() or s.isupper() or s.istitle()):
        return None
    got = infer(s)
    if got is None or got[0] == "digits" or len(got[2]) < 16:
        return None
    _, k, x = got
    n = len(x)
    counts = np.bincount(x, minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    # corrected for the choice of the alphabet
    at = _CODES[np.frombuffer(s[:n].encode(), np.uint8)] - 1
    less = -float(model[np.append(-1, at[:-1]), at].sum()) - n * math.log(k) - math.log(len(ENCODINGS))
    p_even = 1 - _normal_below(((chi / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1))))
    above = x > (k - 1) / 2
    up, down = int(above.sum()), int((~above).sum())
    if up and down:
        runs = 1 + int((above[1:] != above[:-1]).sum())
        mean = 1 + 2 * up * down / n
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        p_runs = _two_sided((runs - mean) / math.sqrt(var))
    else:
        p_runs = 0.0
    d = x - x.mean()
    square = float((d * d).sum())
    p_serial = _two_sided(float((d[1:] * d[:-1]).sum()) / square * math.sqrt(n)) if square else 0.0
    # the smallest of three, corrected for having been chosen
    return max(less, 0.0), min(1.0, 3 * min(p_even, p_runs, p_serial))


def band(n: int) -> int:
    return min(n // 8, MAX_BAND)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns: leftmost, not overlapping within a kind, by start and kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, model: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(start, end, band, -ln p) of the runs that pass the regularity tests.

    Tested are a run as a whole and its maximal sub-runs of one alphabet and without marks, as a value may be
    glued to a path or a name. Of those that overlap the one least like text counts, with its p-value corrected for
    the choice; so ordinary text around a value does not hide it."""
    out = []
    for m in CANDIDATE.finditer(text):
        if m.end() - m.start() < LEAST:
            continue
        spans = {(0, len(m[0]))} | {x.span() for part in PARTS for x in part.finditer(m[0]) if x.end() - x.start() >= LEAST}
        tested = [(got[0], a, b) for a, b in spans if (got := battery(m[0][a:b], model)) is not None and got[1] >= LEVEL]
        taken: list[tuple[int, int]] = []
        for less, a, b in sorted(tested, key=lambda x: (-x[0], x[1], -x[2])):
            if all(b <= c or d <= a for c, d in taken):
                taken.append((a, b))
                out.append((m.start() + a, m.start() + b, band(b - a), min(FLOOR, max(0.0, less - math.log(len(spans))))))
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of whole texts, the same however rows are dealt to batches: short ones are joined by line feeds, which
    count like the ends of a text."""
    total = np.zeros(SIDE * SIDE, np.int64)
    held, size = [], 0
    for b in batches:
        for t in b.column(0):
            text = t.as_py()
            held.append(text)
            size += len(text)
            if size >= 1 << 20:
                total += count_pairs("\n" + "\n".join(held) + "\n")
                held, size = [], 0
    total += count_pairs("\n" + "\n".join(held) + "\n")
    total[:SIDE] = total[::SIDE] = 0        # pairs with another character, line feeds among them, are not counted
    code = np.flatnonzero(total)
    yield pa.record_batch([pa.array(code, pa.int32()), pa.array(total[code])], names=["code", "n"])


def corpus_model(docs: DataFrame) -> np.ndarray:
    """The text model of all rows; at most 67 x 67 counts reach the driver."""
    rows = texts(docs).select("text").mapInArrow(_count, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    pairs = np.zeros(SIDE * SIDE, np.int64)
    for r in rows:
        pairs[r["code"]] = r["n"]
    return text_model(pairs)


def _scan(batches: Iterator[pa.RecordBatch], model: np.ndarray) -> Iterator[pa.RecordBatch]:
    base_type = pa.list_(pa.struct([("s", pa.int32()), ("k", pa.int32()), ("e", pa.int32())]))
    more_type = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("band", pa.int32()), ("bin", pa.int32()), ("own", pa.bool_())]))
    for b in batches:
        for low in range(0, b.num_rows, 1000):
            part = b.slice(low, 1000)
            base, more, sha = [], [], []
            for t in part.column(1).to_pylist():
                spans = base_spans(t)
                base.append([{"s": s, "k": k, "e": e} for s, k, e in spans])
                sha.append(hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest())
                more.append([{"s": s, "e": e, "band": w, "bin": int(p * BINS / FLOOR), "own": not covered(s, e, spans)} for s, e, w, p in candidates(t, model)])
            yield pa.record_batch([part.column(0), pa.array(base, base_type), pa.array(sha), pa.array(more, more_type)], names=["doc_id", "base", "base_sha256", "more"])


SCHEMA = ("doc_id long, base array<struct<s:int,k:int,e:int>>, base_sha256 string, "
          "more array<struct<s:int,e:int,band:int,bin:int,own:boolean>>")


def thresholds(scanned: DataFrame, rate: float = RATE) -> DataFrame:
    """band, cut: the least bin of every length band at which the rate is held (Benjamini-Hochberg over
    counted p-values). At most 33 bands of 401 bins, whatever the input."""
    hist = scanned.select(F.explode("more").alias("m")).groupBy("m.band", "m.bin").agg(F.count("*").alias("n"))
    total = Window.partitionBy("band")
    up = total.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    hist = hist.withColumn("m", F.sum("n").over(total)).withColumn("found", F.sum("n").over(up))
    p = F.exp(-F.col("bin") * F.lit(FLOOR / BINS))
    return hist.filter(p * F.col("m") <= F.col("found") * rate).groupBy("band").agg(F.min("bin").alias("cut"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base_sha256, found (array of kind, start, end by start, kind, end) for every row.

    Positions are code points, the end is exclusive. Null and empty texts have no spans. A random span
    that base spans cover fully is left out, base spans always stay. Rows are scanned on their own, whole; the
    rate is held over all rows together. Repeated rows count as often as they occur; extra columns are
    ignored; an empty table gives no rows."""
    model = corpus_model(docs)
    scanned = stage(texts(docs).mapInArrow(lambda it: _scan(it, model), SCHEMA), "op2_scan")
    cuts = {r["band"]: r["cut"] for r in thresholds(scanned).collect()}      # 33 bands at most
    table = F.array(*(F.lit(cuts.get(i, BINS + 1)) for i in range(MAX_BAND + 1)))
    over = F.filter("more", lambda m: (m["bin"] >= F.get(table, m["band"])) & m["own"])
    extra = F.transform(over, lambda m: F.struct(m["s"].alias("s"), F.lit(3).alias("k"), m["e"].alias("e")))
    return scanned.select("doc_id", "base_sha256", F.array_sort(F.concat("base", extra)).alias("found"))
