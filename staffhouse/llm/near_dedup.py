"""Near duplicates: MinHash signatures joined by a multi-index Hamming search.

A document's set of five-word shingles gives a signature of ``SYMBOLS`` b-bit symbols. Signatures
are cut into ``CHUNKS`` chunks; if two differ in at most ``LIMIT`` = 2 * CHUNKS - 1 symbols, some
chunk differs in at most one (pigeonhole). Posting every chunk once for each symbol left out
enumerates that one allowed error, so every pair within the limit shares a posted key. Links are
then confirmed on the full sets, of those pairs only whose parity bitmaps do not rule a link out.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffhouse.llm.common import fresh, held, own, stage, texts
from staffhouse.llm.components import components
from staffhouse.llm.ngram_join import bitmap, folded

SHINGLE, SYMBOLS, CHUNKS = 5, 64, 16
PER = SYMBOLS // CHUNKS
ROOM = 4096                     # shingles a row that a block is meant for: of longer texts fewer rows share one
LIMIT = 2 * CHUNKS - 1          # a pair at similarity 0.75 exceeds it about once in 100,000
SHARE = (75, 100)               # linked when 100 * common >= 75 * union
_U = np.uint64
_rng = np.random.default_rng(20240517)
_WEIGHTS = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | _U(1)
_FACTORS = _rng.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) | _U(1)
_KEYS = _rng.integers(1, 1 << 63, (SYMBOLS, PER), dtype=np.uint64) | _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0x9E3779B97F4A7C15)
    return x ^ (x >> _U(29))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's five-word shingles; fewer words form one.
    Words are runs of anything but ASCII white space, A-Z lower-cased, which is what
    ``bytes.lower`` and ``bytes.split`` do."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    if n < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=n)], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    s = h[:n - 4] * _WEIGHTS[0]
    for j in range(1, SHINGLE):
        s += h[j:n - 4 + j] * _WEIGHTS[j]
    return np.unique(_mix(s))


def signature(s: np.ndarray) -> np.ndarray:
    """One 16-bit symbol for each hash function: bits of the smallest value over the set."""
    low = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(s), 2048):
        low = np.minimum(low, (s[i:i + 2048, None] * _FACTORS).min(axis=0))
    return (low >> _U(24)).astype(np.uint16)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """(documents, SYMBOLS) keys: of every chunk, with each of its symbols left out in turn; the lowest
    bits of a key are the number of that symbol."""
    sig = signatures.astype(np.uint64) + _U(1)
    keys = np.empty(sig.shape, np.uint64)
    for j in range(SYMBOLS):
        c = j // PER * PER
        keys[:, j] = _mix(sum((sig[:, i] * _KEYS[j, i - c] for i in range(c, c + PER) if i != j), _U(j))) & ~_U(SYMBOLS - 1) | _U(j)
    return keys.view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held("near_dedup")
    for b in batches:
        n, fp, sig, bits = [], [], [], []
        for t in b.column(1):
            s = shingles(t.as_py())
            n.append(len(s))
            fp.append(xxhash.xxh128_digest(s.tobytes()))
            sig.append(signature(s).tobytes() if len(s) else b"")
            bits.append(bitmap(s) if len(s) else b"")
        yield pa.record_batch([b.column(0), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(sig, pa.binary()), pa.array(bits, pa.binary())],
                              names=["doc_id", "n_shingles", "fp", "sig", "bits"])


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, SYMBOLS)
            yield pa.record_batch([pa.array(chunk_keys(sig).ravel()), pa.array(np.repeat(b.column(0).to_numpy(), SYMBOLS))], names=["key", "rep"])


def may_link(n: np.ndarray, m: np.ndarray, x: list[bytes], y: list[bytes]) -> np.ndarray:
    """Whether sets of these sizes and parity bitmaps may be similar enough: two bitmaps never differ in more places
    than the sets in shingles, so a pair that differs in more than a link may is certainly none."""
    most = n + m - 2 * -(-SHARE[0] * (n + m) // sum(SHARE))
    size = np.array([(len(a), len(b)) for a, b in zip(x, y)]).reshape(-1, 2)
    out = np.zeros(len(x), bool)
    for k, l in np.unique(size, axis=0):
        own = np.flatnonzero((size[:, 0] == k) & (size[:, 1] == l))
        a, b = (np.frombuffer(b"".join([z[i] for i in own]), np.uint64).reshape(len(own), -1) for z in (x, y))
        while a.shape[1] != b.shape[1]:
            a, b = (folded(a), b) if a.shape[1] > b.shape[1] else (a, folded(b))
        out[own] = np.bitwise_count(a ^ b).sum(axis=1) <= most[own]
    return out


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint16).reshape(-1, SYMBOLS) for i in (2, 3))
            near = np.flatnonzero((x != y).sum(axis=1) <= LIMIT)
            n, m, p, q = (b.column(i).take(pa.array(near)) for i in (4, 5, 6, 7))
            near = near[may_link(n.to_numpy(), m.to_numpy(), p.to_pylist(), q.to_pylist())]
            yield b.select([0, 1]).take(pa.array(near))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: tuple[str, np.ndarray] = ("", shingles(""))
    for b in batches:
        keep = []
        for x, y in zip(b.column(2), b.column(3)):
            y = y.as_py()
            if y != last[0]:
                last = (y, shingles(y))
            s, t = shingles(x.as_py()), last[1]
            common = len(np.intersect1d(s, t, assume_unique=True))
            keep.append(common * SHARE[1] >= SHARE[0] * (len(s) + len(t) - common) and common > 0)
        yield b.filter(pa.array(keep, pa.bool_())).select([0, 1])


def document_sets(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, fp (128-bit hash of the whole set), sig, bits (parity bitmap of the set)."""
    return texts(docs).filter("doc_id is not null").mapInArrow(_sets, "doc_id long, n_shingles long, fp binary, sig binary, bits binary")


def _linked(pairs: DataFrame, reps: DataFrame, bodies: DataFrame) -> DataFrame:
    """Pairs (a, b) whose signatures are within the limit, whose bitmaps leave it open and whose full sets are similar enough."""
    sig, body = reps.select("rep", "sig", "n_shingles", "bits"), bodies.select("rep", "body")
    both = pairs.join(sig.toDF("a", "sa", "na", "pa"), "a").join(sig.toDF("b", "sb", "nb", "pb"), "b")
    # sets whose sizes are further apart than the similarity allows cannot be linked
    both = both.filter(F.least("na", "nb") * SHARE[1] >= F.greatest("na", "nb") * SHARE[0])
    near = both.select("a", "b", "sa", "sb", "na", "nb", "pa", "pb").mapInArrow(_within, "a long, b long")
    return (near.join(body.toDF("a", "ta"), "a").join(body.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")
            .mapInArrow(_confirm, "a long, b long"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Rows sorted by (key, i, j) -> one dict of arrays for each group, whatever the batches."""
    held: list[pa.RecordBatch] = []
    for b in chain(batches, [None]):
        if b is not None and not b.num_rows:
            continue
        rows = pa.Table.from_batches([*held, *([b] if b is not None else [])]).combine_chunks() if held or b is not None else None
        if rows is None:
            return
        col = {c: rows[c].to_numpy() for c in ("key", "i", "j", "own", "rep", "c", "n")}
        new = (col["key"][1:] != col["key"][:-1]) | (col["i"][1:] != col["i"][:-1]) | (col["j"][1:] != col["j"][:-1])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), *([rows.num_rows] if b is None else [])]
        col["sig"] = np.frombuffer(b"".join(rows["sig"].to_pylist()), np.uint16).reshape(-1, SYMBOLS)
        col["bits"] = np.array([*rows["bits"].to_pylist(), None], object)[:-1]
        for low, high in zip(cuts, cuts[1:]):
            yield {k: v[low:high] for k, v in col.items()}
        # the last group may go on in the next batch; it has two blocks at most
        held = [] if b is None else rows.slice(cuts[-1]).to_batches()


def _candidates(g: dict[str, np.ndarray], x: int, among: np.ndarray) -> np.ndarray:
    """Of the rows ``among``: in another component, of a size and a signature that may be linked with row x."""
    y = among[(g["c"][among] != g["c"][x]) & (np.minimum(g["n"][among], g["n"][x]) * SHARE[1] >= np.maximum(g["n"][among], g["n"][x]) * SHARE[0])]
    return y[(g["sig"][y] != g["sig"][x]).sum(axis=1) <= LIMIT] if len(y) else y


def _left_open(g: dict[str, np.ndarray], x: int, among: np.ndarray) -> np.ndarray:
    """Of the rows ``among`` those that the parity bitmaps do not rule out as links of row x."""
    return among[may_link(np.full(len(among), g["n"][x]), g["n"][among], [g["bits"][x]] * len(among), g["bits"][among].tolist())] if len(among) else among


def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    x = np.concatenate([np.empty(0, np.int64), *(f[0] for f in found)])
    y = np.concatenate([np.empty(0, np.int64), *(f[1] for f in found)])
    return pa.record_batch([pa.array(np.maximum(x, y)), pa.array(np.minimum(x, y))], names=["a", "b"])


def _central(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every member of a block with the block's most central one: the nearest to the commonest symbols."""
    found = []
    for g in _groups(batches):
        m = len(g["rep"])
        s = np.sort(g["sig"], axis=0)
        run = np.ones(s.shape, np.int32)
        for k in range(1, m):
            run[k] = np.where(s[k] == s[k - 1], run[k - 1] + 1, 1)
        common = s[run.argmax(axis=0), np.arange(SYMBOLS)]
        p = int((g["sig"] != common).sum(axis=1).argmin())
        y = _left_open(g, p, _candidates(g, p, np.arange(m)))
        found.append((np.full(len(y), g["rep"][p]), g["rep"][y]))
    yield _pairs(found)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of two blocks (or within one) that may be linked, by signature and by bitmap, and are in different
    components. A pair that shares several keys is given back under the first of them only. A large group of texts
    that are alike but not similar enough is ruled out here, in the block: its pairs never become rows."""
    found = []
    for g in _groups(batches):
        i, j = g["i"][0], g["j"][0]
        left, right = np.flatnonzero(g["own"] == i), np.flatnonzero(g["own"] == j)
        here = int(g["key"][0]) & (SYMBOLS - 1)
        for x in left:
            y = _candidates(g, x, right[right > x] if i == j else right)
            if len(y):
                same = (g["sig"][y] == g["sig"][x]).reshape(len(y), CHUNKS, PER)
                # key c * PER + s is shared if all symbols of chunk c but s agree
                shared = (same.sum(axis=2, keepdims=True) - same == PER - 1).reshape(len(y), SYMBOLS)
                y = _left_open(g, x, y[shared.argmax(axis=1) == here])
            if len(y):
                found.append((np.full(len(y), g["rep"][x]), g["rep"][y]))
        if len(found) > 1000:
            yield _pairs(found)
            found = []
    yield _pairs(found)


def _open(buckets: DataFrame, comp: DataFrame, reps: DataFrame, block: int, name: str) -> DataFrame:
    """Members of the buckets that still hold several components, dealt to blocks of about ``block``, of long texts to
    smaller ones. A bucket of three is done: its smallest and its largest member were compared with all."""
    member = buckets.join(comp.toDF("rep", "c"), "rep", "left").withColumn("c", F.coalesce("c", "rep"))
    still = (member.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("m"), F.sum("n").alias("all"))
             .filter("lo < hi and m > 3").select("key", F.ceil(F.greatest(F.col("m"), F.col("all") / ROOM) / block).cast("int").alias("nb")))
    member = member.join(still, "key").join(reps.select("rep", "sig", "bits"), "rep")
    return stage(member.withColumn("own", F.pmod(F.xxhash64("rep", "key"), F.col("nb")).cast("int")), name)


def _dealt(rows: DataFrame) -> DataFrame:
    key = ["key", "i", "j"]
    return rows.select(*key, "own", "rep", "c", "n", "sig", "bits").repartition(*key).sortWithinPartitions(*key)


def _joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """The components with further links; without any they are what they were."""
    if links.isEmpty():
        return comp
    return components(comp.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links))


def near_duplicates(docs: DataFrame, block: int = 1024) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: the smallest doc_id reachable over links of similarity
    0.75 or more, for every row.

    Documents with equal sets are one node, so copies are never paired with each other. Every bucket
    first compares its members with its smallest and its largest one; buckets that still hold several
    components compare theirs with the most central one, and what then is left open is searched in
    blocks, between components only, so large groups of near copies are joined before any pairwise search.
    Null and empty texts have an empty set and are linked with nothing. Rows that share a doc_id count as
    linked, rows without one are left out. Extra columns are ignored; an empty table gives no rows."""
    sets = stage(document_sets(docs), "op10_sets")
    reps = stage(sets.filter("n_shingles > 0").groupBy("n_shingles", "fp")
                 .agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("bits").alias("bits")), "op10_reps")
    posted = reps.select("rep", "sig").mapInArrow(_post, "key long, rep long")
    shared = posted.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi")
    buckets = stage(posted.join(shared, "key").join(reps.select("rep", F.col("n_shingles").alias("n")), "rep"), "op10_buckets")
    pairs = (buckets.select(F.explode(F.array(F.struct(F.col("rep").alias("a"), F.col("lo").alias("b")),
                                              F.struct(F.col("hi").alias("a"), F.col("rep").alias("b")))).alias("p"))
             .select("p.*").filter("a <> b").distinct())
    needed = buckets.select("rep").distinct()
    bodies = stage(texts(docs).select(F.col("doc_id").alias("rep"), F.col("text").alias("body")).join(needed, "rep"), "op10_bodies", "zstd")
    same_id = sets.join(reps.select("n_shingles", "fp", "rep"), ["n_shingles", "fp"]).select("doc_id", "rep", "n_shingles")
    member = stage(same_id, "op10_member")
    several = member.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi").select("doc_id")
    twice = member.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    links = stage(_linked(pairs, reps, bodies).unionByName(twice), "op10_links")
    comp = components(links)
    buckets = buckets.select("key", "rep", "n")
    rows = _open(buckets, comp, reps, block, "op10_open").withColumns({"i": F.col("own"), "j": F.col("own")})
    central = _linked(_dealt(rows).mapInArrow(_central, "a long, b long").distinct(), reps, bodies)
    comp = _joined(comp, stage(central, "op10_central"))
    rows = _open(buckets, comp, reps, block, "op10_rest")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    rows = rows.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    more = _linked(_dealt(rows).mapInArrow(_across, "a long, b long").distinct(), reps, bodies)
    final = _joined(comp, stage(more, "op10_more"))
    empty = sets.filter("n_shingles = 0").select("doc_id", F.col("doc_id").alias("rep"), "n_shingles")
    return (member.unionByName(empty).join(final.toDF("rep", "c"), "rep", "left")
            .select("doc_id", "n_shingles", F.coalesce("c", "rep").alias("component_id"))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group: the document kept of its component, and of the rows that share a kept id the one with the
    least text hash. Rows without an id are in no component; of those with equal texts one stays.

    Null and empty texts of their own ids stay, other columns may have any names and types, an empty table gives no
    rows. Only the ids to drop, and those that several rows share, are joined, so the other texts need no grouping."""
    gone_id, many_id, key = fresh(docs, "_gone", "_many", "_key")
    id_ = lambda df: own(df, id_col).cast("long")
    gone = near_duplicates(docs.select(id_(docs).alias("doc_id"), own(docs, text_col).alias("text"))).filter(~F.col("kept")).select(F.col("doc_id").alias(gone_id)).distinct()
    kept = docs.join(gone, id_(docs) == F.col(gone_id), "left_anti")
    many = docs.groupBy(id_(docs).alias(many_id)).count().filter(F.col("count") > 1).select(many_id).filter(F.col(many_id).isNotNull())
    alone = kept.join(many, id_(kept) == F.col(many_id), "left_anti")
    text_hash = F.sha2(F.coalesce(own(docs, text_col), F.lit("")), 256)

    def one_each(rows: DataFrame, by: Column) -> DataFrame:
        first = rows.groupBy(by.alias(key)).agg(F.min_by(F.struct(*[own(docs, c) for c in docs.columns]), text_hash).alias("row"))
        return first.select("row.*")

    known = id_(docs).isNotNull()
    return (alone.filter(known).unionByName(one_each(kept.join(many, id_(kept) == F.col(many_id), "left_semi"), id_(docs)))
            .unionByName(one_each(kept.filter(~known), text_hash)))
