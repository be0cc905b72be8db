"""Text quality by a generalised additive model with pairwise interactions.

Features of the whole text are cut into bins. Cyclic boosting visits the features in turn; each visit
fits a shallow tree (a few leaves over one feature's bins) to the log-loss gradient and adds its
leaves to that feature's lookup table. Then the pairs of features that explain most of the rest
get two-dimensional tables the same way. A score is a sum of table entries.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffhouse.llm.common import label_sample, remainder, stage, texts

FEATURES = ("chars", "words", "word_length", "line_words", "upper", "digits", "space", "symbols", "punctuation", "beyond_ascii",
            "pipes", "bangs", "commas_stops", "distinct_words", "top_word", "repeated_lines", "short_words", "long_words",
            "symbol_end", "upper_words", "repeated_pairs", "entropy")
SAMPLE = 20_000                 # at most about so many labelled rows are fitted
BINS, ROUNDS, PAIRS, PAIR_BINS, PAIR_ROUNDS, RATE = 32, 60, 8, 8, 25, 0.15
_CLASS = np.zeros(256, np.int64)        # 0 other, 1 upper, 2 digit, 3 space, 4 symbol, 5 punctuation, 6 beyond ASCII
for _c, _s in ((1, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (2, b"0123456789"), (3, b" \t\n\r\x0b\x0c"), (4, b"#$%&*+/<=>@\\^_`{|}~"), (5, b"!\"'(),-.:;?[]")):
    _CLASS[list(_s)] = _c
_CLASS[128:] = 6


def features(text: str) -> list[float]:
    """Counts and shares over the whole text; all 0 for an empty one."""
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(FEATURES)
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kind = np.bincount(_CLASS, weights=hist, minlength=7) / len(raw)
    p = hist[hist > 0] / len(raw)
    words, lines = raw.split(), raw.split(b"\n")
    n = max(len(words), 1)
    size = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    count = Counter(words)
    ends = sum(c for w, c in count.items() if _CLASS[w[-1]] == 4 or w[-2:] == b"!!")
    upper = sum(c for w, c in count.items() if w.isupper() and len(w) > 1)
    pairs = len(set(zip(words, words[1:])))
    return [np.log1p(len(text)), np.log1p(len(words)), size.mean(), np.log1p(len(words) / len(lines)), kind[1], kind[2], kind[3], kind[4], kind[5], kind[6],
            hist[124] / n, hist[33] / n, (hist[44] + hist[46]) / n, len(count) / n, max(count.values(), default=0) / n,
            1 - len(set(lines)) / len(lines), (size <= 2).mean(), (size >= 14).mean(), ends / n, upper / n, 1 - pairs / max(n - 1, 1), -(p * np.log(p)).sum()]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = np.array([features(t.as_py()) for t in b.column(1)], np.float64).reshape(b.num_rows, -1)
        x = pa.FixedSizeListArray.from_arrays(pa.array(got.ravel()), got.shape[1]).cast(pa.list_(pa.float64())) if b.num_rows else pa.array([], pa.list_(pa.float64()))
        yield pa.record_batch([b.column(0), x], names=["doc_id", "x"])


def feature_table(docs: DataFrame) -> DataFrame:
    return texts(docs).mapInArrow(_rows, "doc_id long, x array<double>")


def _leaves(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """A shallow tree over ordered bins with gradient sums g and weight sums h: the leaf value of every bin."""
    total = g.sum() ** 2 / (h.sum() + 1)
    if depth and len(g) > 1:
        cg, ch = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = cg ** 2 / (ch + 1) + (g.sum() - cg) ** 2 / (h.sum() - ch + 1) - total
        at = int(np.argmax(gain)) + 1
        if gain[at - 1] > 1e-6:
            return np.concatenate([_leaves(g[:at], h[:at], depth - 1), _leaves(g[at:], h[at:], depth - 1)])
    return np.full(len(g), g.sum() / (h.sum() + 1))


class Gam:
    """edges: bin borders of every feature; tables: its lookup table; pairs: (i, j, table)."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        share = (y.sum() + 0.5) / (len(y) + 1)
        self.base = float(np.log(share / (1 - share)))
        width = x.shape[1]
        q = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, i], q)) if len(x) else np.empty(0) for i in range(width)]
        self.coarse = [e[np.linspace(0, len(e) - 1, min(len(e), PAIR_BINS - 1)).astype(int)] if len(e) else e for e in self.edges]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        if len(np.unique(y)) < 2:
            return
        bins = self._bins(x, self.edges)
        f = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            for i in range(width):
                self._visit(self.tables[i], bins[i], f, y, lambda g, h: _leaves(g, h, 2))
        small = self._bins(x, self.coarse)
        gains = sorted(((-self._gain(small[i] * PAIR_BINS + small[j], f, y), i, j) for i in range(width) for j in range(i)))[:PAIRS]
        self.pairs = [(i, j, np.zeros(PAIR_BINS * PAIR_BINS)) for _, i, j in gains]
        for _ in range(PAIR_ROUNDS):
            for i, j, t in self.pairs:
                self._visit(t, small[i] * PAIR_BINS + small[j], f, y, self._grid_leaves)

    @staticmethod
    def _bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, i], "right") for i, e in enumerate(edges)]

    @staticmethod
    def _sums(at: np.ndarray, f: np.ndarray, y: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        return np.bincount(at, y - p, size), np.bincount(at, p * (1 - p), size)

    def _visit(self, table, at, f, y, tree) -> None:
        step = RATE * tree(*self._sums(at, f, y, len(table)))
        table += step
        f += step[at]

    def _gain(self, at, f, y) -> float:
        g, h = self._sums(at, f, y, PAIR_BINS * PAIR_BINS)
        return float((g * g / (h + 5)).sum())

    @staticmethod
    def _grid_leaves(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """A tree that splits on the first feature, then each side on the second."""
        g, h = g.reshape(PAIR_BINS, PAIR_BINS), h.reshape(PAIR_BINS, PAIR_BINS)
        best, out = -1.0, None
        for at in range(1, PAIR_BINS):
            parts = [(_leaves(g[s].sum(axis=0), h[s].sum(axis=0), 1), s) for s in (slice(0, at), slice(at, None))]
            gain = sum(float((v * g[s].sum(axis=0)).sum()) for v, s in parts)
            if gain > best:
                best, out = gain, np.concatenate([np.tile(v, (g[s].shape[0], 1)) for v, s in parts])
        return out.ravel()

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: one lookup and addition for each table."""
        f = np.full(len(x), self.base)
        for t, at in zip(self.tables, self._bins(x, self.edges)):
            f += t[at]
        small = self._bins(x, self.coarse)
        for i, j, t in self.pairs:
            f += t[small[i] * PAIR_BINS + small[j]]
        return 1 / (1 + np.exp(-f))


def fit(sample: DataFrame) -> Gam:
    """From rows of (x, _y), a bounded sample, in a fixed order."""
    rows = sample.select("doc_id", "x", "_y").toPandas().sort_values("doc_id", kind="stable")
    x = np.array(rows["x"].tolist(), np.float64).reshape(len(rows), len(FEATURES))
    return Gam(x, rows["_y"].to_numpy(np.float64))


def score_quality(docs: DataFrame, labels: DataFrame, mod: int = 4, held: int = 2, threshold: float = 0.7, bound: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; fitted on at most about ``bound`` labelled rows whose
    crc32(doc_id) modulo ``mod`` is not ``held``.

    Only the text enters a score; texts are read once, features are kept. Null and empty texts have all
    features 0. Without labels of both kinds every score is the share of label 1 (0.5 without any). Repeated
    rows are scored each (a label weighs as often as its row occurs), extra columns are ignored, an empty table gives no rows."""
    x = stage(feature_table(docs), "op4_features")
    model = fit(label_sample(x, labels, "quality", remainder("doc_id", mod) == held, bound))

    def run(frames):
        for f in frames:
            s = model.score(np.array(f["x"].tolist(), np.float64).reshape(len(f), len(FEATURES)))
            yield pd.DataFrame({"doc_id": f["doc_id"], "score": s})
    out = x.mapInPandas(run, "doc_id long, score double")
    return out.select("doc_id", (remainder("doc_id", mod) == held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
