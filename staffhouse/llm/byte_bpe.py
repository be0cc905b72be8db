"""Byte-level BPE encoding and decoding with recursive DuckDB queries, one connection per task.

Every distinct word of a batch becomes token-position rows, each with the position and token after it. The
recursive query joins these pairs with the merge table and contracts each word's leftmost pair of least
rank until no pair is left; ordered aggregation collects the ids, and again the bytes that they stand for.
"""
from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from staffhouse.llm.common import held, texts
from staffhouse.llm.pieces import split, units

LONG_WORD = 256         # longer words take the heap below: a round of the query costs their whole length
REMEMBERED = 200_000    # pieces of each of the two generations that a worker remembers; only speed depends on it
WORDS, BYTES = 20_000, 300_000      # of one query, which bounds its memory
DOCUMENTS, PART = 3000, 8           # documents that are taken at a time, and bytes of text for each piece to remember
BITS = 20               # pair keys and positions are packed; ranks stay far below 2^20

# s: word, position, token, next position, next token; a word's rows of a round are dead once it was contracted again.
# r: the pairs that merge; b: of each word the leftmost pair of least rank; e: with what follows the pair
ENCODE = f"""
with recursive s(w, p, t, q, u, live) as (
  select w, p, t, lead(p) over o, lead(t) over o, true from seed window o as (partition by w order by p)
  union all
  (with r as (select s.w, s.p, s.q, m.rank from s join merges m on m.pair = (s.t::bigint << {BITS}) + s.u where s.live and s.u is not null),
   b as (select w, arg_min(p, (rank::bigint << {BITS}) + p) bp, arg_min(q, (rank::bigint << {BITS}) + p) bq, min(rank) rank from r group by w),
   e as (select b.*, s.q nq, s.u nu from b join s on s.w = b.w and s.p = b.bq where s.live)
   select s.w, s.p, case when s.p = e.bp then e.rank else s.t end, case when s.p = e.bp then e.nq else s.q end,
          case when s.p = e.bp then e.nu when s.q = e.bp then e.rank else s.u end, e.bp is not null
   from s left join e on s.w = e.w where s.live and (e.bq is null or s.p <> e.bq)))
select w, count(*) n, string_agg(t::varchar, ',' order by p) ids, string_agg(v.hex, '' order by p) hex
from s join vocab v on v.rank = s.t where not live group by w order by w
"""


class Codec:
    """Ranks of a vocabulary file, the merge table made from them, and what was encoded so far."""

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.token = {r: t for t, r in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        # no spill folder: a query is small enough to stay in memory
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        pairs = [(a, b, r) for token, r in self.ranks.items() for i in range(1, len(token))
                 if (a := self.ranks.get(token[:i])) is not None and (b := self.ranks.get(token[i:])) is not None]
        left, right, rank = (np.array(x, np.int64) for x in zip(*pairs))
        self._table("merges", pa.table({"pair": (left << BITS) + right, "rank": rank.astype(np.int32)}))
        self._table("vocab", pa.table({"rank": pa.array(list(self.ranks.values()), pa.int32()), "hex": [t.hex() for t in self.ranks]}))
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.known: dict[str, tuple[str, int, bytes]] = {}
        self.before: dict[str, tuple[str, int, bytes]] = {}

    def _table(self, name: str, data: pa.Table) -> None:
        self.con.register("incoming", data)
        self.con.execute(f"create or replace temp table {name} as select * from incoming")
        self.con.unregister("incoming")

    def encode_words(self, words: list[bytes]) -> list[tuple[str, int, bytes]]:
        """Of each word the ids joined by commas, their number, and the bytes that they decode to."""
        out: list = [None] * len(words)
        rest = []
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                ids = self._long(w)
                out[i] = (",".join(map(str, ids)), len(ids), b"".join(self.token[t] for t in ids))
            else:
                rest.append(i)
        rest.sort(key=lambda i: len(words[i]))      # a query has as many rounds as its longest word has contractions
        size = np.cumsum([len(words[i]) for i in rest]) if rest else np.empty(0)
        low = 0
        while low < len(rest):
            high = min(low + WORDS, max(low + 1, int(np.searchsorted(size, (size[low - 1] if low else 0) + BYTES, "right"))))
            part, low = rest[low:high], high
            sizes = np.array([len(words[i]) for i in part])
            start = np.repeat(np.cumsum(sizes) - sizes, sizes)
            seed = {"w": np.repeat(np.arange(len(part), dtype=np.int32), sizes), "p": (np.arange(sizes.sum()) - start).astype(np.int32),
                    "t": self.bytes[np.frombuffer(b"".join(words[i] for i in part), np.uint8)]}
            self._table("seed", pa.table(seed))
            got = self.con.sql(ENCODE).to_arrow_table()
            raw = map(bytes.fromhex, got["hex"].to_pylist())
            for i, x in zip(part, zip(got["ids"].to_pylist(), got["n"].to_pylist(), raw)):      # ordered by w, every w is there
                out[i] = x
        return out

    def _long(self, word: bytes) -> list[int]:
        """The same contractions for one long word: a heap of pairs over a linked list."""
        tokens = [bytes([c]) for c in word]
        nxt, prev = list(range(1, len(tokens) + 1)), list(range(-1, len(tokens) - 1))
        rank = lambda i: self.ranks.get(tokens[i] + tokens[nxt[i]]) if nxt[i] < len(tokens) else None
        heap = [(r, i, nxt[i]) for i in range(len(tokens)) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, j = heapq.heappop(heap)
            if not tokens[i] or nxt[i] != j or rank(i) != r:
                continue
            tokens[i] += tokens[j]
            tokens[j] = b""
            nxt[i] = nxt[j]
            if nxt[i] < len(tokens):
                prev[nxt[i]] = i
            for k in (prev[i], i):
                if k >= 0 and (r := rank(k)) is not None:
                    heapq.heappush(heap, (r, k, nxt[k]))
        return [self.ranks[t] for t in tokens if t]

    def _missing(self, found: set[str]) -> list[str]:
        """Those that no generation remembers; what the older one does moves to the younger."""
        found = {u for u in found if u not in self.known}
        self.known.update((u, self.before[u]) for u in found if u in self.before)
        return sorted(u for u in found if u not in self.before)

    def learn(self, pieces: set[str]) -> None:
        """Remember the pieces and their words, encoded and decoded. The older generation is forgotten when the younger one is full:
        what is common stays, what occurred once goes."""
        if len(self.known) > self.remembered:
            self.before, self.known = self.known, {}
        new = self._missing(pieces)
        words = [self.pattern.findall(u) for u in new]
        unknown = self._missing({w for x in words for w in x})
        self.known.update(zip(unknown, self.encode_words([w.encode("utf-8") for w in unknown])))
        for u, x in zip(new, words):
            if len(x) > 1:
                got = [self.known[w] for w in x]
                self.known[u] = (",".join([g[0] for g in got]), sum([g[1] for g in got]), b"".join([g[2] for g in got]))

    def encode(self, texts: pa.Array) -> Iterator[tuple[str, int, bytes]]:
        """Of each text the ids joined by commas, their number, and the bytes that they decode to."""
        p = split(texts)
        cut = {i: units(texts[i].as_py()) for i in np.flatnonzero(p.slow).tolist()}
        self.learn({*p.text, *filter(None, p.heads), *(u for x in cut.values() for u in x)})
        ids, n, raw = [""] * len(p.plain), np.zeros(len(p.plain), np.int64), [b""] * len(p.plain)
        for i, x in zip(np.flatnonzero(p.plain).tolist(), map(self.known.__getitem__, p.text)):
            ids[i], n[i], raw[i] = x
        for i, (low, high) in enumerate(zip(p.offsets[:-1].tolist(), p.offsets[1:].tolist())):
            if i in cut:
                got = [self.known[u] for u in cut[i]]
                yield ",".join([g[0] for g in got]), sum([g[1] for g in got]), b"".join([g[2] for g in got])
                continue
            at = p.at[low + 1:high]
            own = at.tolist()
            head = self.known[p.heads[i]] if p.heads[i] else None
            joined, back = ",".join(map(ids.__getitem__, own)), b"".join(map(raw.__getitem__, own))
            if head:
                joined, back = f"{head[0]},{joined}" if own else head[0], head[2] + back
            yield joined, int(n[at].sum()) + (head[1] if head else 0), back


def codec(path: str, pattern: str, remembered: int = REMEMBERED) -> Codec:
    """One for each Python worker: the merge table is built once, pieces stay known across tasks."""
    codecs = held("byte_bpe")
    key = path, pattern, remembered
    if key not in codecs:
        codecs.clear()
        codecs[key] = Codec(*key)
    return codecs[key]


def _encoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str, whole: bool, remembered: int) -> Iterator[pa.RecordBatch]:
    c = codec(path, pattern, remembered)
    for b in batches:
        size = np.cumsum(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False))
        low = 0
        while low < b.num_rows:
            high = min(low + DOCUMENTS, max(low + 1, int(np.searchsorted(size, (size[low - 1] if low else 0) + max(1 << 20, remembered * PART), "right"))))
            n, sha, back, ids, raws = [], [], [], [], []
            for joined, count, raw in c.encode(b.column(1).slice(low, high - low)):
                n.append(count)
                sha.append(hashlib.sha256(joined.encode()).hexdigest())
                back.append(hashlib.sha256(raw).hexdigest())
                if whole:
                    ids.append([int(i) for i in joined.split(",")] if joined else [])
                    raws.append(raw)
            out = [b.column(0).slice(low, high - low), pa.array(n, pa.int64()), pa.array(sha), pa.array(back)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if whole:
                out, names = out + [pa.array(ids, pa.list_(pa.int32())), pa.array(raws, pa.binary())], names + ["ids", "decoded"]
            yield pa.record_batch(out, names=names)
            low = high


def encode(docs: DataFrame, path: str, pattern: str, whole: bool = True, remembered: int = REMEMBERED) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, with ``whole``, ids and decoded (bytes), for every row.

    ``path`` is a rank file that every executor has; special tokens are ordinary text. Null and empty
    texts have no ids. Rows are independent: repeated rows and ids give repeated results, extra columns
    are ignored, an empty table gives no rows. A worker remembers up to about three times ``remembered`` pieces (some
    350 bytes each), which only its speed depends on. Words over ``LONG_WORD`` bytes are contracted in the same
    order by a heap, as one round of the query for each merge would cost their length squared."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded binary" if whole else "")
    return texts(docs).mapInArrow(lambda it: _encoded(it, path, pattern, whole, remembered), schema)
