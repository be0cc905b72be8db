"""Toxicity by a convolutional text classifier trained in numpy.

Words are hashed to embeddings; filters of widths 1, 2 and 3 slide over them, each filter's largest value
over the whole text is kept, and a logistic layer joins them. A threshold is calibrated for each language,
which is told from the text's own letters and common words, and the score is shifted so that 0.5 is that
threshold everywhere.

All labelled rows are fitted. Those that one task cannot hold are dealt into shards: in every epoch each shard is
fitted by itself from the network of the epoch before, and what the shards have changed is averaged, a word's
embedding over the shards that have changed it.
"""
from __future__ import annotations

import math
import re
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staffhouse.llm.common import give_back, held, known_labels, label_sample, remainder, texts
from staffhouse.session import drop_stage, shared_path

BUCKETS, DIM, FILTERS, WIDTHS, STEM = 1 << 18, 8, 8, (1, 2, 3), 4
SAMPLE, EPOCHS, STEP, SEED = 6_000, 8, 0.12, 7       # about SAMPLE labelled rows, at most, are one shard's
SHARD_BYTES = 32 << 20      # of a shard's texts
SLOTS = 1 << 26             # one bit each, for the ids that have a label
UNIT, STEPS = 1 << 32, 1 << 10      # changes are added up as whole numbers, logits are counted in steps of 1 / STEPS
WORDS = re.compile(r"[^\W_]+")
REMEMBERED = 200_000
# common words by which the language of a text is told
LANGUAGES = {"en": {"the", "and", "of", "to", "is", "in", "that", "it"}, "de": {"der", "die", "und", "das", "ist", "ein", "zu", "nicht"},
             "fr": {"le", "la", "les", "et", "un", "une", "des", "que"}, "es": {"el", "los", "las", "y", "que", "del", "por", "una"}}
NAMES = (*LANGUAGES, "other")


class Buckets(dict):
    """Word -> its bucket and that of its beginning, packed in one number; remembered while there is room.
    The beginning lets a form that was never seen share what other forms of the word have shown."""

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = at = bucket(word) * BUCKETS + bucket("^" + word[:STEM])
        return at


def bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


def tokens(text: str, buckets: Buckets) -> tuple[np.ndarray, int]:
    """(words, 2) buckets of all words, and the number of the text's language: the one whose own common words
    occur most often; none of them: other."""
    words = WORDS.findall(text.lower())
    packed = np.fromiter(map(buckets.__getitem__, words), np.int64, len(words))
    ids = np.stack([packed // BUCKETS, packed % BUCKETS], axis=1).astype(np.int32)
    hist = np.bincount(_LANG_OF[ids[:, 0]] + 1, minlength=len(NAMES))[1:]
    return ids, int(hist.argmax()) if hist.any() else len(NAMES) - 1


_LANG_OF = np.full(BUCKETS, -1)
for _i, _own in enumerate(LANGUAGES.values()):
    for _w in _own:
        if sum(_w in x for x in LANGUAGES.values()) == 1:
            _LANG_OF[bucket(_w)] = _i


class Cnn:
    def __init__(self):
        rng = np.random.default_rng(SEED)
        self.e = rng.normal(0, 0.3, (BUCKETS, DIM)).astype(np.float32)
        self.w = {k: rng.normal(0, 0.4, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS}
        self.v = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
        self.b = np.float32(0)
        self.cut = np.zeros(len(NAMES))

    def tables(self, rows=slice(None), widths=WIDTHS) -> None:
        """For every width and offset the filters' values of every bucket: convolution is then lookup and addition.
        Those of a bucket lie side by side, so a word is looked up once. The tables before are given up first."""
        self.t = {}
        self.side = None
        e = self.e[rows]
        self.side = np.empty((len(e), FILTERS * sum(widths)), np.float32)
        at = 0
        for k in widths:
            self.t[k] = []
            for j in range(k):
                self.side[:, at:at + FILTERS] = e @ self.w[k][j]
                self.t[k].append(self.side[:, at:at + FILTERS])
                at += FILTERS

    def drop_tables(self) -> None:
        self.t, self.side = {}, None

    def _convs(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The widths that the tables are for and that fit, by number, with the values of their filters at every place."""
        both = self.side[ids[:, 0]] + self.side[ids[:, 1]]
        at = 0
        for k in self.t:
            n = len(ids) - k + 1
            if n > 0:
                yield WIDTHS.index(k), sum(both[j:j + n, at + j * FILTERS:at + (j + 1) * FILTERS] for j in range(k))
            at += k * FILTERS

    def _pool(self, ids: np.ndarray, top: np.ndarray) -> None:
        """Puts the largest values of the filters that the tables are for in their places of ``top``."""
        for low in range(0, len(ids), 8192):
            for i, c in self._convs(ids[low:low + 8192 + max(WIDTHS) - 1]):
                best = top[i * FILTERS:(i + 1) * FILTERS]
                np.maximum(best, c.max(axis=0), out=best)

    def logit(self, ids: np.ndarray) -> float:
        top = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self._pool(ids, top)
        return float(top @ self.v + self.b)

    def logits(self, docs: list[np.ndarray]) -> np.ndarray:
        """The logit of every document, with the tables of one width at a time: the driver holds no more of them."""
        tops = np.zeros((len(docs), FILTERS * len(WIDTHS)), np.float32)
        for k in WIDTHS:
            self.tables(widths=(k,))
            for ids, top in zip(docs, tops):
                self._pool(ids, top)
        self.drop_tables()
        return np.array([float(top @ self.v + self.b) for top in tops])

    def dense(self, acc: dict) -> list[np.ndarray]:
        """All that is fitted besides the embeddings, and what their steps go by."""
        return [*self.w.values(), self.v, np.array([self.b]), *[acc[k] for k in self.w], acc["v"], np.array([acc["b"]])]

    def move(self, acc: dict, by: np.ndarray) -> None:
        """Changes everything in ``dense`` by these, flat and in its order."""
        at = 0
        for x in self.dense(acc)[:-1]:
            if x.shape == (1,):
                self.b += np.float32(by[at])
            else:
                x += by[at:at + x.size].reshape(x.shape).astype(np.float32)
            at += x.size
        acc["b"] += by[at]

    def start(self) -> dict:
        """What the steps of Adagrad go by, before the first one."""
        return {"e": np.full((BUCKETS, 1), 1e-3, np.float32), "v": np.full_like(self.v, 1e-3), "b": 1e-3, **{k: np.full_like(w, 1e-3) for k, w in self.w.items()}}

    def fit(self, docs: list[np.ndarray], y: np.ndarray) -> None:
        """Adagrad over small batches in a fixed order; the tables of a batch hold its own words only."""
        rng = np.random.default_rng(SEED)
        acc = self.start()
        for _ in range(EPOCHS):
            self.epoch(docs, y, rng.permutation(len(docs)), acc)
        self.drop_tables()      # made again where texts are scored

    def epoch(self, docs: list[np.ndarray], y: np.ndarray, order: np.ndarray, acc: dict) -> np.ndarray:
        """Every document once; which embeddings have changed."""
        changed, used, place, col = np.zeros(BUCKETS, bool), np.zeros(BUCKETS, bool), np.zeros(BUCKETS, np.int32), np.arange(FILTERS)
        filters = [slice(i * FILTERS, (i + 1) * FILTERS) for i in range(len(WIDTHS))]
        for low in range(0, len(order), 64):
            batch = order[low:low + 64]
            ids = np.concatenate([docs[d] for d in batch])
            used[ids] = True
            own = np.flatnonzero(used)
            used[own] = False
            place[own] = np.arange(len(own))
            at_own = place[ids]
            self.tables(own)
            lens = np.array([len(docs[d]) for d in batch])
            starts = np.cumsum(lens) - lens
            tops, at, g = np.zeros((len(batch), FILTERS * len(WIDTHS)), np.float32), np.zeros((len(batch), len(WIDTHS), FILTERS), np.int64), np.zeros(len(batch), np.float32)
            gv, gb = np.zeros_like(self.v), 0.0
            for n, d in enumerate(batch):
                top = tops[n]
                if lens[n]:
                    for i, c in self._convs(at_own[starts[n]:starts[n] + lens[n]]):
                        at[n, i] = c.argmax(axis=0)
                        top[filters[i]] = np.maximum(c[at[n, i], col], 0)
                g[n] = np.float32(1 / (1 + np.exp(-(top @ self.v + self.b))) - y[d])
                gv += g[n] * top
                gb += g[n]
            up = g[:, None] * self.v * (tops > 0)
            # by document, width, offset, word or beginning, filter: the order in which steps are added up
            rows = np.zeros((len(batch), sum(WIDTHS), 2, FILTERS), np.int64)
            steps = np.zeros((*rows.shape, DIM), np.float32)
            gw, m = {k: np.zeros_like(w) for k, w in self.w.items()}, 0
            for i, k in enumerate(WIDTHS):
                fits, u = lens >= k, up[:, filters[i], None]
                for j in range(k):
                    t = ids[np.where(fits[:, None], starts[:, None] + at[:, i] + j, 0)] if len(ids) else np.zeros((len(batch), FILTERS, 2), np.int64)
                    if fits.any():
                        gw[k][j] = np.add.reduce(((self.e[t[:, :, 0]] + self.e[t[:, :, 1]]) * u)[fits], axis=0).T
                    rows[:, m] = t.transpose(0, 2, 1)
                    steps[:, m] = (self.w[k][j].T * u)[:, None]
                    m += 1
            for k in self.w:
                acc[k] += gw[k] ** 2
                self.w[k] -= STEP * gw[k] / np.sqrt(acc[k])
            acc["v"] += gv ** 2
            self.v -= STEP * gv / np.sqrt(acc["v"])
            acc["b"] += gb ** 2
            self.b -= np.float32(STEP * gb / np.sqrt(acc["b"]))
            rows, steps = rows.ravel(), steps.reshape(-1, DIM)
            some = np.flatnonzero(steps.any(axis=1))        # a filter whose value is not above 0 has none
            if len(some):
                t, inverse = np.unique(rows[some], return_inverse=True)
                step = np.zeros((len(t), DIM), np.float32)
                np.add.at(step, inverse, steps[some])
                acc["e"][t] += (step ** 2).mean(axis=1, keepdims=True)
                self.e[t] -= STEP * step / np.sqrt(acc["e"][t])
                changed[t] = True
        return changed

    def calibrate(self, docs: list[np.ndarray], lang: np.ndarray, y: np.ndarray) -> None:
        """For every language the cut with the largest difference of hit rate and false-alarm rate; the
        common cut where a language has fewer than 20 documents of either label."""
        self.cuts(self.logits(docs), lang, y, np.ones(len(docs)))

    def cuts(self, z: np.ndarray, lang: np.ndarray, y: np.ndarray, n: np.ndarray) -> None:
        """The cuts from logits and labels that ``n`` documents each have; toxic ones come first where logits are equal."""
        def best(z, y, n):
            order = np.argsort(z, kind="stable")
            z, y, n = z[order], y[order], n[order]
            gain = np.cumsum((1 - y) * n) / max(((1 - y) * n).sum(), 1) - np.cumsum(y * n) / max((y * n).sum(), 1)
            at = int(gain.argmax())
            return float((z[at] + z[min(at + 1, len(z) - 1)]) / 2)
        common = best(z, y, n) if len(y) and 0 < y.sum() < len(y) else 0.0
        for i in range(len(NAMES)):
            own = lang == i
            enough = min((y * n)[own].sum(), ((1 - y) * n)[own].sum()) >= 20
            self.cut[i] = best(z[own], y[own], n[own]) if enough else common

    def score(self, ids: np.ndarray, lang: int) -> float:
        """0 to 1; 0.5 is the language's cut."""
        return float(1 / (1 + np.exp(-np.clip(self.logit(ids) - self.cut[lang], -30, 30))))


def _calibrates(n: int) -> np.ndarray:
    """Which of ``n`` documents calibrate; the others are fitted."""
    return np.arange(n) % 4 == 3


def train(docs: list[tuple[np.ndarray, int]], y: np.ndarray) -> Cnn:
    """Three quarters of the documents fit the network, the rest calibrates it. One label only: no fit."""
    model = Cnn()
    part = _calibrates(len(y))
    if len(np.unique(y[~part])) == 2:
        model.fit([docs[i][0] for i in np.flatnonzero(~part)], y[~part])
    else:
        model.v[:], model.b = 0, np.float32(30 if len(y) and y.mean() > 0.5 else -30)
    own = [docs[i] for i in np.flatnonzero(part)]
    if len(np.unique(y[~part])) == 2:
        model.calibrate([d for d, _ in own], np.array([k for _, k in own], int), y[part])
    return model


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    buckets = Buckets()
    for b in batches:
        got = [tokens(t.as_py(), buckets) for t in b.column(1)]
        yield pa.record_batch([b.column(0), pa.array([x.tobytes() for x, _ in got], pa.binary()), pa.array([k for _, k in got], pa.int32()), b.column(2)],
                              names=["doc_id", "ids", "lang", "_y"])


def _slot(id_col: str):
    return F.pmod(F.xxhash64(id_col), F.lit(SLOTS))


def _labelled_tokens(docs: DataFrame, lab: DataFrame) -> DataFrame:
    """(doc_id, ids, lang, _y) of every document that has a label in ``lab``, chosen as by ``label_sample``. Only texts whose id may be one
    of these are split and shuffled: a bit for each of ``SLOTS`` hashes tells, whatever the number of labels."""
    word = _slot("doc_id").alias("slot")
    bits = lab.select(word).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")).toArrow()
    words = np.zeros(SLOTS >> 6, np.int64)
    words[bits["word"].to_numpy()] = bits["bits"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held("toxicity_cnn")
        buckets = Buckets()
        for b in batches:
            slot = b.column(2).to_numpy()
            b = b.filter(pa.array((words[slot >> 6] >> (slot & 63)) & 1 == 1))
            got = [tokens(t.as_py(), buckets) for t in b.column(1)]
            yield pa.record_batch([b.column(0), b.column(3), pa.array([x.tobytes() for x, _ in got], pa.binary()), pa.array([k for _, k in got], pa.int32())],
                                  names=["doc_id", "_order", "ids", "lang"])
            del b, got
        buckets.clear()
        give_back()
    found = (docs.filter("doc_id is not null").select("doc_id", "text", word, F.xxhash64("text").alias("_order"))
             .mapInArrow(run, "doc_id long, _order long, ids binary, lang int"))
    rows = found.join(lab, "doc_id").groupBy("doc_id", "_y").agg(F.min(F.struct("_order", "ids", "lang")).alias("_row"))
    return rows.select("doc_id", "_row.ids", "_row.lang", "_y")


def _shards(batches: Iterator[pa.RecordBatch], fitted: bool) -> Iterator[tuple[int, list[np.ndarray], np.ndarray, np.ndarray]]:
    """Number, documents, languages and labels of each shard, whose rows follow each other: of the part that is fitted, or of that which
    calibrates."""
    def ended():
        own = np.flatnonzero(_calibrates(len(docs)) != fitted)
        return at, [np.frombuffer(docs[i].as_buffer() or b"", np.int32).reshape(-1, 2) for i in own], np.array(lang, np.int32)[own], np.array(y, np.float64)[own]
    at, docs, lang, y = None, [], [], []
    for b in batches:
        number = b.column(0).to_numpy()
        for part in np.split(np.arange(len(number)), np.flatnonzero(np.diff(number)) + 1):
            if not len(part):
                continue
            if docs and number[part[0]] != at:
                yield ended()
                docs, lang, y = [], [], []
            at, rows = int(number[part[0]]), b.slice(part[0], len(part))
            docs += list(rows.column(1))        # not copied
            lang += rows.column(2).to_pylist()
            y += rows.column(3).to_pylist()
    if docs:
        yield ended()


def _fitted_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many clean and toxic documents are fitted, from (shard, _y)."""
    at, place, found = None, 0, [0, 0]
    for b in batches:
        for shard, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            at, place = shard, place + 1 if shard == at else 0
            found[y > 0] += bool(not _calibrates(4)[place % 4])
    yield pa.record_batch([pa.array([found[0]], pa.int64()), pa.array([found[1]], pa.int64())], names=["clean", "toxic"])


def _train_shards(packed: DataFrame) -> Cnn:
    """``train`` where the documents are rows (shard, ids, lang, _y): each shard runs an epoch from the network that all of them made in the epoch before."""
    model = Cnn()
    acc = model.start()
    shards, toxic = packed.agg(F.countDistinct("shard"), F.avg("_y")).first()
    found = packed.select("shard", "_y").mapInArrow(_fitted_labels, "clean long, toxic long").agg(F.sum("clean"), F.sum("toxic")).first()
    if not all(found):
        model.v[:], model.b = 0, np.float32(30 if toxic and toxic > 0.5 else -30)
        return model
    values = [f"v{i}" for i in range(DIM + 1)]
    size = sum(x.size for x in model.dense(acc))

    for epoch in range(EPOCHS):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held("toxicity_cnn")
            many, total, flat = np.zeros(BUCKETS, np.int64), np.zeros((BUCKETS, DIM + 1), np.int64), np.zeros(-(-size // DIM) * DIM, np.int64)
            before = np.concatenate([x.ravel() for x in model.dense(acc)]).astype(np.float64)
            for shard, docs, _, y in _shards(batches, True):
                own, own_acc = Cnn.__new__(Cnn), {k: np.copy(x) for k, x in acc.items()}
                own.e, own.w, own.v, own.b = model.e.copy(), {k: w.copy() for k, w in model.w.items()}, model.v.copy(), model.b
                changed = np.flatnonzero(own.epoch(docs, y, np.random.default_rng([SEED, shard, epoch]).permutation(len(docs)), own_acc))
                many[changed] += 1
                # whole numbers: the sum is the same in any order
                moved = np.concatenate([own.e[changed], own_acc["e"][changed]], axis=1) - np.concatenate([model.e[changed], acc["e"][changed]], axis=1).astype(np.float64)
                total[changed] += np.rint(moved * UNIT).astype(np.int64)
                flat[:size] += np.rint((np.concatenate([x.ravel() for x in own.dense(own_acc)]) - before) * UNIT).astype(np.int64)
            at = np.flatnonzero(many)
            rest = np.concatenate([flat.reshape(-1, DIM), np.zeros((len(flat) // DIM, 1), np.int64)], axis=1)
            out = np.concatenate([total[at], rest])
            yield pa.record_batch([pa.array(np.concatenate([at, BUCKETS + np.arange(len(rest))])), pa.array(np.concatenate([many[at], np.zeros(len(rest), np.int64)])),
                                   *[pa.array(np.ascontiguousarray(c)) for c in out.T]], names=["at", "many", *values])
            give_back()
        sums = packed.mapInArrow(run, "at long, many long, " + ", ".join(f"{c} long" for c in values))
        got = sums.groupBy("at").agg(*[F.sum(c).alias(c) for c in ("many", *values)]).toArrow().sort_by("at")
        at, many = got["at"].to_numpy(), got["many"].to_numpy()
        by = np.stack([got[c].to_numpy() for c in values], axis=1) / UNIT
        words = at < BUCKETS
        mean = by[words] / many[words][:, None]
        model.e[at[words]] += mean[:, :DIM].astype(np.float32)
        acc["e"][at[words]] += mean[:, DIM:].astype(np.float32)
        model.move(acc, by[~words][:, :DIM].ravel() / shards)

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, docs, lang, y in _shards(batches, False):
            step = np.clip(np.rint(model.logits(docs) * STEPS), -64 * STEPS, 64 * STEPS)
            yield pa.record_batch([pa.array(step.astype(np.int32)), pa.array(lang), pa.array(y.astype(np.int32))], names=["z", "lang", "y"])
        give_back()
    got = packed.mapInArrow(logits, "z int, lang int, y int").groupBy("z", "lang", "y").agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by([("z", "ascending"), ("y", "descending")])
    model.cuts(got["z"].to_numpy() / STEPS, got["lang"].to_numpy(), got["y"].to_numpy().astype(np.float64), got["n"].to_numpy().astype(np.float64))
    return model


def _collected(rows: DataFrame) -> Cnn:
    rows = rows.toPandas().sort_values("doc_id", kind="stable")
    return train([(np.frombuffer(i, np.int32).reshape(-1, 2), k) for i, k in zip(rows["ids"], rows["lang"])], rows["_y"].to_numpy(np.float64))


@contextmanager
def _small_batches(spark):
    """Documents go through the executors in small batches: large ones, read again in every epoch, let the heap grow to its limit."""
    small, before = {"spark.sql.parquet.columnarReaderBatchSize": "128", "spark.sql.execution.arrow.maxRecordsPerBatch": "256"}, {}
    for k, v in small.items():
        before[k] = spark.conf.get(k, None)
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def fit(docs: DataFrame, labels: DataFrame, use, bound: int = SAMPLE) -> Cnn:
    """The network from all labelled rows that ``use`` (a condition on doc_id) admits. Up to ``bound`` of them are fitted on the
    driver, which gives back the memory of the training: its session goes on to other queries. More are dealt into shards of
    about ``bound`` rows at most, or ``SHARD_BYTES`` of text, that are fitted by tasks."""
    docs, lab = texts(docs), known_labels(labels, "toxic", ~use)
    if lab.count() <= bound:
        sample = label_sample(docs, labels, "toxic", ~use, bound).select("doc_id", "text", "_y")
        model = _collected(sample.mapInArrow(_tokens, "doc_id long, ids binary, lang int, _y int"))
        give_back()
        return model
    with _small_batches(docs.sparkSession):
        known = docs.select("doc_id", F.octet_length("text").alias("size")).join(lab, "doc_id").groupBy("doc_id").agg(F.max("size").alias("size"))
        n, size = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
        shards, rows = max(math.ceil(n / bound), math.ceil(size / SHARD_BYTES)), _labelled_tokens(docs, lab)
        if shards <= 1:
            model = _collected(rows)
        else:
            spark, run = docs.sparkSession, uuid.uuid4().hex
            path = shared_path(spark, "staffhouse-stage", run, "toxicity_shards")
            try:
                # a file a shard in the order of its ids, so that shards are dealt to all cores
                (rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(shards)).cast("int")).repartition(shards, "shard").sortWithinPartitions("shard", "doc_id")
                 .select("ids", "lang", "_y", "shard").write.partitionBy("shard").parquet(path))
                model = _train_shards(spark.read.schema("ids binary, lang int, _y int, shard int").parquet(path).select("shard", "ids", "lang", "_y"))
            finally:
                drop_stage(spark, run)
    give_back()
    return model


def scored(batches: Iterator[pa.RecordBatch], model: Cnn, text: int) -> Iterator[tuple[pa.RecordBatch, list[float]]]:
    """Batches with the scores of their texts (a null text is an empty one). The model's tables are there while
    the task runs and go with it; the Python worker lives on."""
    held("toxicity_cnn")
    model.tables()
    buckets = Buckets()
    try:
        for b in batches:
            yield b, [model.score(*tokens(t.as_py() or "", buckets)) for t in b.column(text)]
    finally:
        model.drop_tables()
        buckets.clear()
        give_back()


def score(docs: DataFrame, model: Cnn) -> DataFrame:
    """doc_id, th (hash of the text), score for every row, from whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, s in scored(batches, model, 1):
            yield pa.record_batch([b.column(0), b.column(2), pa.array(s, pa.float64())], names=["doc_id", "th", "score"])
    return texts(docs).withColumn("th", F.xxhash64("text")).mapInArrow(run, "doc_id long, th long, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame, mod: int = 5, held: int = 0, threshold: float = 0.5, bound: int = SAMPLE) -> DataFrame:
    """doc_id, th, held_out, score, predicted for every row; learnt from rows whose crc32(doc_id) modulo ``mod`` is
    not ``held``.

    Only the text enters a score. Null and empty texts score as a text without any word. Without labels of both
    kinds every text is what the labels are (not toxic without any). Repeated rows are scored each, extra columns
    are ignored, an empty table gives no rows."""
    is_held = remainder("doc_id", mod) == held
    out = score(docs, fit(docs, labels, ~is_held, bound))
    return out.select("doc_id", "th", is_held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, mod: int = 5, held: int = 0, bound: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows scored 0.5 or more. Whole batches go through Arrow and are filtered there: no row is
    grouped, joined or held beside its scores.

    Columns of any name and type stay as they are. Null and empty texts score as a text without any word, rows with a null doc_id
    are scored like others, repeated rows alike; an empty table gives no rows."""
    is_held = remainder("doc_id", mod) == held
    model = fit(docs, labels, ~is_held, bound)
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, s in scored(batches, model, at):
            yield b.filter(pa.array([x < 0.5 for x in s], pa.bool_()))
    # numbered columns: mapInArrow looks names up, and takes a dot in one for a field
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
