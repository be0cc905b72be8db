"""N-gram Jaccard join over prefix trees.

A document is the set of its three-word shingles. Shingles have one global order, rare ones first: by
how often their slot of a counting table (over all documents) was hit, then by hash. Two sets that are
similar enough share a shingle among the first few in that order, so sets meet in the buckets of those;
this holds for any order, the counts only keep common shingles out of it.

The sets of a bucket are stored in a trie, commonest shingles first. The trie is walked once for all sets
as queries: a node adds its shingles to the overlaps that its parent's have reached, shared by
everything below it, and queries leave a subtree whose remaining length cannot bring them to the overlap
they need, or whose sets are all in their component already. Buckets of the same members are one. Each set
first joins one bucket; of what is then still open, parity bitmaps (whose difference is never more than that of the sets) pick the
members that may still be linked, and these are joined in all their buckets.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffhouse.llm.common import stage, texts
from staffhouse.llm.components import components

SHINGLE = 3
SLOT_BITS = 20              # of the counting table; it is 8 MB on the driver whatever the corpus
WEIGHT = 1 << 19            # shingles of the sets in one block of a bucket, about
MEMBERS = 2048              # sets in one block, about
LEAST = 9                   # a set of fewer shingles is similar to no other one
RUN = 32                    # shingles of a trie path between two looks at the bounds
_U = np.uint64
_LOW = _U(64 - SLOT_BITS)
_rng = np.random.default_rng(20250312)
_FACTORS = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | _U(1)


def similar(common, a, b):
    """100 * common >= 90 * (a + b - common), for numbers or arrays."""
    return 19 * common >= 9 * (a + b)


def hashes(text: str) -> np.ndarray:
    """64-bit hashes of the text's three-word shingles in order; fewer words form one. Words are runs of
    anything but ASCII white space, A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    if n < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=n)], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    s = sum((h[j:n - SHINGLE + 1 + j] * _FACTORS[j] for j in range(1, SHINGLE)), h[:n - SHINGLE + 1] * _FACTORS[0])
    s = (s ^ (s >> _U(32))) * _U(0x9E3779B97F4A7C15)
    return s ^ (s >> _U(29))


def shingles(text: str) -> np.ndarray:
    """The text's set: its distinct shingles' hashes, sorted."""
    return np.unique(hashes(text))


def ordered(s: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Sorted numbers of shingles in the global order: a hash whose top bits (its slot) are replaced by the slot's rank."""
    return np.sort((rank[(s >> _LOW).astype(np.int64)] << _LOW) | (s & ((_U(1) << _LOW) - _U(1))))


def probe_length(n):
    """So many first shingles of a set meet those of any smaller similar set that ``index_length`` names."""
    return n - (90 * n + 99) // 100 + 1


def index_length(n):
    return n - (18 * n + 18) // 19 + 1


def bitmap(k: np.ndarray) -> bytes:
    """For each of B low-bit values, whether an odd number of shingles have it; B is a power of two, 2 a shingle or more."""
    b = max(64, 1 << (2 * len(k) - 1).bit_length())
    return np.packbits((np.bincount((k & _U(b - 1)).astype(np.int64), minlength=b) & 1).astype(np.uint8)).tobytes()


def folded(bits: np.ndarray) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) of B values as those of B / 2."""
    half = bits.shape[1] // 2
    return bits[:, :half] ^ bits[:, half:]


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count = np.zeros(1 << SLOT_BITS, np.int64)
    for b in batches:
        for low in range(0, b.num_rows, 500):
            found = [hashes(t.as_py()) for t in b.column(0).slice(low, 500)]
            count += np.bincount((np.concatenate(found) >> _LOW).astype(np.int64), minlength=len(count))
    hit = np.flatnonzero(count)
    for low in range(0, len(hit), 1 << 16):
        part = hit[low:low + (1 << 16)]
        yield pa.record_batch([pa.array(part.astype(np.int32)), pa.array(count[part])], names=["slot", "n"])


def slot_ranks(docs: DataFrame) -> np.ndarray:
    """The place of every slot by falling rarity: how many shingles of the table's texts hit it."""
    counts = texts(docs).select("text").mapInArrow(_slots, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(1 << SLOT_BITS, np.int64)
    total[counts["slot"].to_numpy()] = counts["n"].to_numpy()
    rank = np.empty(1 << SLOT_BITS, np.uint64)
    rank[np.argsort(total, kind="stable")] = np.arange(1 << SLOT_BITS, dtype=np.uint64)
    return rank


SETS = "doc_id long, n_shingles long, fp binary, prefix array<long>, bits binary"


def _sets(batches: Iterator[pa.RecordBatch], rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for low in range(0, b.num_rows, 500):
            part = b.slice(low, 500)
            n, fp, prefix, bits = [], [], [], []
            for t in part.column(1):
                k = ordered(shingles(t.as_py()), rank)
                n.append(len(k))
                fp.append(xxhash.xxh128_digest(k.tobytes()))
                prefix.append(k[:probe_length(len(k))].view(np.int64) if len(k) else k.view(np.int64))
                bits.append(bitmap(k) if len(k) else b"")
            yield pa.record_batch([part.column(0), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(prefix, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                                  names=[c.split()[0] for c in SETS.split(", ")])


class Links:
    """Components of a block's members, and the links that joined them."""

    def __init__(self, comp: np.ndarray):
        self.root = np.unique(comp, return_inverse=True)[1]
        self.found: list[tuple[int, int]] = []

    def join(self, x: int, others: np.ndarray) -> None:
        for y in others.tolist():
            if self.root[x] != self.root[y]:
                self.found.append((x, y))
                self.root[self.root == self.root[y]] = self.root[x]


def trie_links(sets: list[np.ndarray], comp: np.ndarray, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join all similar sets of different components, at most one for each two components joined.

    ``sets`` are sorted numbers of the global order; with ``side`` only sets of different sides are looked at."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), sizes)
    token, at, count = np.unique(flat, return_inverse=True, return_counts=True)
    # the trie starts with the commonest shingles; those of one set alone are no part of any overlap
    kept = count > 1
    number = np.full(len(token), -1)
    number[kept] = np.arange(kept.sum())[::-1]
    held = number[at] >= 0
    own, ids = owner[held], number[at][held]
    by_set = np.lexsort((ids, own))
    own, ids = own[by_set], ids[by_set]
    start = np.searchsorted(own, np.arange(m + 1))
    paths = [ids[start[i]:start[i + 1]] for i in range(m)]
    order = sorted(range(m), key=lambda i: paths[i].astype(">u4").tobytes())
    paths, sizes, comp = [paths[i] for i in order], sizes[order], comp[order]
    side = None if side is None else side[order]
    length = np.array([len(p) for p in paths])
    own = np.repeat(np.arange(m), length)
    ids = np.concatenate(paths) if m else ids
    start = np.concatenate([[0], np.cumsum(length)])
    u = int(kept.sum()) + 1
    place = own * u + ids                       # sorted: how many of a set's shingles come after one is a search
    by_token = np.lexsort((own, ids))
    holders, first = own[by_token], np.searchsorted(ids[by_token], np.arange(u + 1))
    lcp = np.zeros(m + 1, np.int64)
    for i in range(1, m):
        a, b = paths[i - 1], paths[i]
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        lcp[i] = differ[0] if len(differ) else n
    links = Links(comp)
    todo = [(0, m, 0, np.zeros(m, np.int64), np.arange(m))] if m > 1 else []
    while todo:
        low, high, depth, overlap, queries = todo.pop()
        queries = queries[queries > low]        # each pair once: with the later set as the query
        roots = links.root[low:high]
        if (roots == roots[0]).all():
            queries = queries[links.root[queries] != roots[0]]
        if side is not None and (side[low:high] == side[low]).all():
            queries = queries[side[queries] != side[low]]
        least, most, longest = sizes[low:high].min(), sizes[low:high].max(), length[low:high].max()
        queries = queries[(10 * sizes[queries] >= 9 * least) & (10 * most >= 9 * sizes[queries])]
        end = length[low] if high - low == 1 else int(lcp[low + 1:high].min())
        while len(queries) and depth < end:
            run = paths[low][depth:min(depth + RUN, end)]
            depth += len(run)
            hits = np.concatenate([holders[first[w]:first[w + 1]] for w in run])
            overlap = overlap + np.bincount(hits, minlength=m)
            rest = start[queries + 1] - np.searchsorted(place, queries * u + run[-1], "right")
            reach = overlap[queries] + np.minimum(rest, longest - depth)
            queries = queries[similar(reach, sizes[queries], least)]
        if not len(queries):
            continue
        while low < high and length[low] == end:
            good = queries[(queries > low) & similar(overlap[queries], sizes[queries], sizes[low])]
            if side is not None:
                good = good[side[good] != side[low]]
            links.join(low, good)
            low += 1
        if low < high:
            cuts = [low, *(low + 1 + np.flatnonzero(lcp[low + 1:high] == end)).tolist(), high]
            todo += [(a, b, end, overlap, queries) for a, b in zip(cuts, cuts[1:])][::-1]
    return [(order[x], order[y]) for x, y in links.found]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by (key, i, j) -> one table for each of these, whatever the batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = list(zip(*(b.column(i).to_pylist() for i in range(3))))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for low, high in zip(cuts, cuts[1:]):
            if held and keys[low] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(low, high - low))
            last = keys[low]
    if held:
        yield pa.Table.from_batches(held)


def _join(batches: Iterator[pa.RecordBatch], rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    for g in _groups(batches):
        sets = [ordered(shingles(t.as_py()), rank) for t in g["body"]]
        own, rep = g["own"].to_numpy(), g["rep"].to_numpy()
        across = g["i"][0].as_py() != g["j"][0].as_py()
        found = np.array(trie_links(sets, g["c"].to_numpy(), own if across else None), np.int64).reshape(-1, 2)
        yield pa.record_batch([pa.array(rep[found[:, 0]]), pa.array(rep[found[:, 1]])], names=["a", "b"])


def _open_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block, the members that may be similar to one of another component: their sizes fit and their
    bitmaps differ in no more places than the sets of a link may."""
    for g in _groups(batches):
        rep, c, n, own = (g[x].to_numpy() for x in ("rep", "c", "n", "own"))
        across = g["i"][0].as_py() != g["j"][0].as_py()
        raw = [np.frombuffer(x, np.uint64) for x in g["bits"].to_pylist()]
        words = np.array([len(x) for x in raw])
        maybe = np.zeros(len(rep), bool)
        for w in np.unique(words):
            same, twice = np.flatnonzero(words == w), np.flatnonzero(words == 2 * w)
            other = np.concatenate([same, twice])
            bits = np.stack([raw[i] for i in same])
            if len(twice):
                bits = np.concatenate([bits, folded(np.stack([raw[i] for i in twice]))])
            by_size = np.argsort(n[other], kind="stable")
            other, bits = other[by_size], bits[by_size]
            size = n[other]
            for x, row in zip(other.tolist(), bits):
                if words[x] != w:
                    continue
                near = slice(np.searchsorted(size, -(-9 * n[x] // 10)), np.searchsorted(size, 10 * n[x] // 9, "right"))
                y = other[near]
                fits = (c[y] != c[x]) & ~(maybe[y] & maybe[x])
                if across:
                    fits &= own[y] != own[x]
                y = y[fits]
                if len(y):
                    apart = np.bitwise_count(bits[near][fits] ^ row).sum(axis=1)
                    total = n[y] + n[x]
                    y = y[apart <= total - 2 * (-(-9 * total // 19))]
                    maybe[y] = True
                    maybe[x] |= len(y) > 0
        if maybe.any():
            yield pa.record_batch([pa.array(np.full(maybe.sum(), g["key"][0].as_py())), pa.array(rep[maybe])], names=["key", "rep"])


def _dealt(members: DataFrame, sizes: DataFrame, across: bool, *more: str) -> DataFrame:
    """Members (key, rep, n, ...) dealt to blocks of about ``WEIGHT`` shingles, as rows (key, i, j, own, ...) sorted by the
    first three: each block alone (i = j) and, if asked for, every two blocks of a key."""
    rows = members.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("rep", "key"), F.col("nb")).cast("int"))
    if across:
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    else:
        rows = rows.withColumn("other", F.col("own"))
    rows = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", *more)
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _blocks(members: DataFrame, weight: int) -> DataFrame:
    """(key, nb) of the keys with two members or more."""
    sizes = members.groupBy("key").agg(F.count("*").alias("m"), F.sum("n").alias("w")).filter("m > 1")
    return sizes.select("key", F.greatest(F.ceil(F.col("m") / MEMBERS), F.ceil(F.col("w") / weight)).cast("int").alias("nb"))


def _with_components(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    if links is None:
        return rows.withColumn("c", F.col("rep"))
    return rows.join(components(links).toDF("rep", "c"), "rep", "left").withColumn("c", F.coalesce("c", "rep"))


def _joined(members: DataFrame, bodies: DataFrame, rank, across: bool, weight: int) -> DataFrame:
    """Links between members (key, rep, n, c) of one key, found by the trie of each block."""
    rows = _dealt(members.join(bodies, "rep"), _blocks(members, weight), across, "c", "body")
    return rows.mapInArrow(lambda it: _join(it, rank.value), "a long, b long")


def jaccard_components(docs: DataFrame, weight: int = WEIGHT, rounds: int = 2) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id reachable over links of Jaccard similarity 0.9 or
    more between sets of three-word shingles, for every row with a doc_id.

    Documents with equal sets are one node. ``rounds`` first joins every set in one of its buckets, a different one
    each time; the last join is exact for all buckets that still hold several components, whatever came before. A
    bucket heavier than ``weight`` shingles is dealt to blocks, and every two of its blocks are compared. Null and empty
    texts have an empty set and are linked with nothing. Rows that share a doc_id count as linked, rows
    without one are left out. Extra columns are ignored; an empty table gives no rows."""
    spark: SparkSession = docs.sparkSession
    rank = spark.sparkContext.broadcast(slot_ranks(docs))       # 8 MB
    sets = stage(texts(docs).filter("doc_id is not null").mapInArrow(lambda it: _sets(it, rank.value), SETS), "op12_sets")
    nodes = stage(sets.filter("n_shingles > 0").groupBy(F.col("n_shingles").alias("n"), "fp")
                  .agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits")), "op12_nodes")
    member = stage(sets.select("doc_id", F.col("n_shingles").alias("n"), "fp").join(nodes.select("n", "fp", "rep"), ["n", "fp"], "left"), "op12_member")
    several = member.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi").select("doc_id")
    twice = member.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).dropna().distinct()
    posted = nodes.filter(F.col("n") >= LEAST).select("rep", "n", F.posexplode("prefix").alias("pos", "key")).select(
        "key", "rep", "n", (F.col("pos") < F.col("n") - F.floor((18 * F.col("n") + 18) / 19) + 1).alias("indexed"))
    # keys that the same sets have are one bucket: near copies share many
    shared = (posted.groupBy("key").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("rep", "n")).alias("s"), F.bit_xor(F.xxhash64("n", "rep")).alias("t"),
                                        F.max("indexed").alias("any")).filter("m > 1 and any")
              .groupBy("m", "s", "t").agg(F.min("key").alias("key")))
    buckets = stage(posted.join(shared.select("key"), "key").select("key", "rep", "n"), "op12_buckets")
    # a rep may stand for several sets when rows share an id; they are linked anyway, and the row with the shared text is all that a join needs
    body = texts(docs).select(F.col("doc_id").alias("rep"), F.col("text").alias("body"))
    bodies = stage(body.join(buckets.select("rep").distinct(), "rep"), "op12_bodies", "zstd")
    links, rows = twice, _with_components(buckets, None)
    for k in range(rounds + 1):
        if k:
            rows = _with_components(buckets, links)
            still = rows.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("key")
            rows = stage(rows.join(still, "key"), f"op12_still_{k}")
        if k < rounds:
            chosen = rows.groupBy("rep", "n", "c").agg(F.min_by("key", F.xxhash64("key", F.lit(k))).alias("key"))
            links = stage(links.unionByName(_joined(chosen, bodies, rank, False, weight)), f"op12_links_{k}")
    rows = rows.join(nodes.select("rep", "n", "bits"), ["rep", "n"])
    open_ = stage(_dealt(rows, _blocks(rows, weight), True, "n", "c", "bits").mapInArrow(_open_members, "key long, rep long").distinct(), "op12_open")
    last = open_.join(rows.select("key", "rep", "n", "c").distinct(), ["key", "rep"])
    links = stage(links.unionByName(_joined(last, bodies, rank, True, weight)), "op12_links")
    final = components(links).toDF("rep", "component")
    return (member.withColumn("rep", F.coalesce("rep", "doc_id")).join(final, "rep", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id")))
