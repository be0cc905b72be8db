"""Token ids in a word-aligned binary format (Simple-8b) and its vectorised reader.

A word of 64 bits has a selector in its upper 4 bits and equally wide ids in the other 60; a wider id
takes a word of its own (selector 15, the escape). A segment is the bytes of consecutive words cut in
blocks: magic, number of ids, number of blocks, then for each block the word it begins at and the
id it begins with, then the words. Blocks decode independently, all words of one selector at once.
"""
from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staffhouse.llm.common import held, texts
from staffhouse.llm.pieces import split, units

MAGIC = 0x53384253
# selector: (ids a word, bits an id); 0 and 1 are runs of zeros; fixed values of the coding
WIDTHS = {0: (240, 0), 1: (120, 0), 2: (60, 1), 3: (30, 2), 4: (20, 3), 5: (15, 4), 6: (12, 5), 7: (10, 6),
          8: (8, 7), 9: (7, 8), 10: (6, 10), 11: (5, 12), 12: (4, 15), 13: (3, 20), 14: (2, 30), 15: (1, 60)}
POWERS = 1 << np.arange(61, dtype=np.int64)
BLOCK = 4096
END = 2
REMEMBERED = 800_000


_BITS = np.concatenate([[0], np.repeat(np.arange(1, 17), 1 << np.arange(16))]).astype(np.uint8)      # of each number below 2^16
_STEP = np.array([WIDTHS[s][0] for s in range(16)])


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs."""
    if len(ids) and ids.max() >= len(_BITS):
        return np.searchsorted(POWERS, ids, "right").astype(np.uint8)
    return _BITS[ids]


def _selectors(bits: np.ndarray) -> np.ndarray:
    """For rows of widths the selector that would be used if a word began at each place: the one that holds most ids of
    the row."""
    best = np.full(bits.shape, 15, np.uint8)
    widest, held = bits, 1          # the largest width of the ``held`` ids from each place on
    for sel in range(14, -1, -1):
        n, width = WIDTHS[sel]
        if n > bits.shape[1]:
            break
        for k in range(held, n):
            widest = np.maximum(widest[:, :-1], bits[:, k:])
        held = n
        fits = widest <= width
        if not fits.any():
            break           # what does not fit here fits no longer and narrower word either
        best[:, :fits.shape[1]][fits] = sel
    return best


def _blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all blocks, and how many each block has. Blocks are walked side by side."""
    blocks = -(-len(ids) // BLOCK)
    bits = np.full(blocks * BLOCK, 255, np.uint8)           # beyond the last id nothing fits
    bits[:len(ids)] = _widths(ids)
    best = _selectors(bits.reshape(blocks, BLOCK)).ravel()
    at = np.arange(blocks) * BLOCK
    end = np.minimum(at + BLOCK, len(ids))
    starts, sels = [], []
    while len(at):
        sel = best[at]
        starts.append(at)
        sels.append(sel)
        at = at + _STEP[sel]
        going = at < end
        at, end = at[going], end[going]
    starts, sels = np.concatenate(starts), np.concatenate(sels)
    order = np.argsort(starts)
    starts, sels = starts[order], sels[order]
    out = sels.astype(np.uint64) << np.uint64(60)
    for s in np.unique(sels):
        n, width = WIDTHS[int(s)]
        if width:
            rows = np.flatnonzero(sels == s)
            word = out[rows]
            for k in range(n):
                word |= ids[starts[rows] + k].astype(np.uint64) << np.uint64(k * width)
            out[rows] = word
    return out, np.bincount(starts // BLOCK, minlength=blocks)


def pack(ids: np.ndarray) -> bytes:
    """One segment. Ids from 0 to 2^60 - 1."""
    ids = np.asarray(ids, np.int64)
    words, count = _blocks(ids) if len(ids) else (np.empty(0, np.uint64), np.empty(0, np.int64))
    head = np.array([MAGIC, len(ids), len(count)], "<u8")
    return b"".join([head.tobytes(), (np.cumsum(count) - count).astype("<u8").tobytes(), (np.arange(len(count)) * BLOCK).astype("<u8").tobytes(), words.astype("<u8").tobytes()])


def unpack(segment: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` (exclusive) of a segment; only the blocks that hold them are read."""
    magic, n, blocks = np.frombuffer(segment, "<u8", 3)
    if magic != MAGIC:
        raise ValueError("not a segment of packed ids")
    n, blocks = int(n), int(blocks)
    last = n if last is None else min(last, n)
    if first >= last:
        return np.empty(0, np.int64)
    word_at, id_at = np.frombuffer(segment, "<u8", 2 * blocks, 24).astype(np.int64).reshape(2, blocks)
    a, b = np.searchsorted(id_at, first, "right") - 1, np.searchsorted(id_at, last, "left")
    words = np.frombuffer(segment, "<u8", offset=24 + 16 * blocks)[word_at[a]:word_at[b] if b < blocks else None]
    sel = (words >> np.uint64(60)).astype(np.int64)
    count = np.array([WIDTHS[s][0] for s in range(16)])[sel]
    start = np.cumsum(count) - count
    out = np.zeros(count.sum(), np.int64)
    for s in np.unique(sel):
        k, width = WIDTHS[int(s)]
        if width:
            rows = np.flatnonzero(sel == s)
            mask = np.uint64((1 << width) - 1)
            out[start[rows, None] + np.arange(k)] = ((words[rows, None] >> (np.arange(k, dtype=np.uint64) * np.uint64(width))) & mask).astype(np.int64)
    base = id_at[a]
    return out[first - base:last - base]


class Known(dict):
    """Piece of text -> its number; a piece not met before gets the next one and is noted as new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        self.new.append(piece)
        return n


class Encoder:
    """The tokenizers library over distinct pieces of texts; remembered pieces are not encoded again.

    Texts are split at spaces and line feeds and their pieces numbered in Arrow, so Python meets the distinct pieces of
    a batch only. Where a piece might not be independent of its neighbours (``_plain``) the text is cut by
    ``pieces.units`` instead.

    With ``added_tokens`` the vocabulary's added tokens are found in texts, as the library does unless told
    otherwise: the text before and after each is encoded alone, so white space beside one is split as at an
    end of the text. They are taken to be plain, without stripping of white space. Otherwise they are text."""

    def __init__(self, path: str, added_tokens: bool):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added_tokens
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True) if added_tokens else []
        self.pattern = "|".join(map(re.escape, added))
        self.added = re.compile(f"({self.pattern})") if added else None
        self._forget()

    def units(self, text: str) -> list[str]:
        if self.added is None or not self.added.search(text):
            return units(text)
        return [u for i, x in enumerate(self.added.split(text)) for u in ([x] if i % 2 else units(x))]

    def _forget(self) -> None:
        self.known = Known()
        self.ids, self.start, self.uses = np.empty(0, np.int32), np.zeros(1, np.int64), np.empty(0, np.int64)

    def _make_room(self) -> None:
        """Keep the pieces met most often, half of the room at most; half of a text's words or more are met once only."""
        least = max(2, int(np.sort(self.uses)[-(REMEMBERED // 2)]) + 1)
        kept = np.flatnonzero(self.uses >= least)
        pieces, ids, start = list(self.known), self.ids, self.start
        size = start[kept + 1] - start[kept]
        self._forget()
        for i in kept.tolist():
            self.known[pieces[i]] = len(self.known)
        self.start = np.append(0, np.cumsum(size))
        self.ids = ids[np.repeat(start[kept] - self.start[:-1], size) + np.arange(size.sum())]
        self.uses = np.ones(len(kept), np.int64)

    def _learn(self) -> None:
        new, self.known.new = self.known.new, []
        # the fast form leaves out offsets, which nothing here needs
        got = [x.ids for x in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        size = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter(chain.from_iterable(got), np.int32, int(size.sum()))
        self.ids = np.concatenate([self.ids, flat])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(size)])

    def _numbers(self, texts: pa.Array) -> list[np.ndarray]:
        """The numbers of each text's pieces in order."""
        p = split(texts, None if self.added is None else pc.match_substring_regex(texts, self.pattern))
        number = np.zeros(len(p.plain), np.int64)
        number[p.plain] = list(map(self.known.__getitem__, p.text))
        number = number[p.at]
        number[p.offsets[:-1]] = [self.known[h] for h in p.heads]
        out = []
        for i, (slow, low, high) in enumerate(zip(p.slow.tolist(), p.offsets[:-1].tolist(), p.offsets[1:].tolist())):
            if slow:
                own = self.units(texts[i].as_py())
                out.append(np.fromiter(map(self.known.__getitem__, own), np.int64, len(own)))
            else:
                out.append(number[low:high])
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by ``END``, and how many each has."""
        if len(self.known) > REMEMBERED:
            self._make_room()
        parts = self._numbers(texts)
        if self.known.new:
            self._learn()
        at, pieces = np.concatenate(parts), np.array([len(x) for x in parts])
        self.uses = np.bincount(at, minlength=len(self.known)) + np.pad(self.uses, (0, len(self.known) - len(self.uses)))
        size = self.start[at + 1] - self.start[at]
        ends = np.append(0, np.cumsum(size))[np.cumsum(pieces)]         # where each text's ids end, among all
        first = np.repeat(self.start[at] - (np.cumsum(size) - size), size)
        ids = self.ids[first + np.arange(len(first))]
        return np.insert(ids, ends, END), np.diff(ends, prepend=0) + 1


SEGMENT_DOCUMENTS, SEGMENT_BYTES = 4000, 16 << 20


def _segments(batches: Iterator[pa.RecordBatch], path: str, added_tokens: bool) -> Iterator[pa.RecordBatch]:
    """Sorted documents -> segments of some thousand documents; ``part`` and ``seq`` number them in order."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    encoders = held("packed_ids")
    if (path, added_tokens) not in encoders:
        encoders[path, added_tokens] = Encoder(path, added_tokens)
    encoder = encoders[path, added_tokens]
    seq = 0
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False))
        low = 0
        while low < b.num_rows:
            before = size[low - 1] if low else 0
            high = min(low + SEGMENT_DOCUMENTS, max(low + 1, int(np.searchsorted(size, before + SEGMENT_BYTES, "right"))))
            ids, counts = encoder.encode(b.column(1).slice(low, high - low))
            yield pa.record_batch([b.column(2).slice(low, 1), pa.array([seq]), pa.array([b.column(0).slice(low, high - low).to_pylist()], pa.list_(pa.int64())),
                                   pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([int(counts.sum())], pa.int64()), pa.array([pack(ids)], pa.binary())],
                                  names=["part", "seq", "docs", "counts", "n_ids", "segment"])
            seq += 1
            low = high


def write(docs: DataFrame, path: str, target: str, partitions: int | None = None, added_tokens: bool = False) -> None:
    """Write the ids of all documents, each followed by ``END``, in ascending doc_id order (rows of one id by
    text): a Parquet folder of segments, with part and seq giving their order.

    Documents are ranged over partitions by (doc_id, text hash), so no task orders all of them. Null and
    empty texts are the end id alone; rows without doc_id are left out; extra columns are ignored. Added tokens
    of the vocabulary that occur in a text are encoded as text, or with ``added_tokens`` as the library's default
    is, by their own id."""
    rows = texts(docs).filter("doc_id is not null").withColumn("th", F.xxhash64("text"))
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (rows.repartitionByRange(n, "doc_id", "th").sortWithinPartitions("doc_id", "th", "text")
            .select("doc_id", "text", F.spark_partition_id().alias("part")))
    schema = "part int, seq long, docs array<long>, counts array<long>, n_ids long, segment binary"
    rows.mapInArrow(lambda it: _segments(it, path, added_tokens), schema).write.mode("overwrite").option("compression", "uncompressed").parquet(target)


def _documents(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, seq, docs, counts, segment in zip(*(b.column(i).to_pylist() for i in range(5))):
            ids, end = unpack(segment), np.cumsum(counts)
            raw = ids.astype("<u4")
            out = [pa.array([part] * len(docs), pa.int32()), pa.array([seq] * len(docs), pa.int64()), pa.array(docs, pa.int64()), pa.array(end - counts),
                   pa.array(counts, pa.int64()), pa.array([zlib.crc32(raw[e - c:e]) for c, e in zip(counts, end)], pa.int64())]
            names = ["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"]
            if whole:
                out.append(pa.ListArray.from_arrays(pa.array(np.append(0, end), pa.int32()), pa.array(ids)))
                names.append("ids")
            yield pa.record_batch(out, names=names)


def read(spark: SparkSession, source: str, whole: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens (with the end id), ids_crc32 and, with ``whole``,
    ids: every document of a folder that ``write`` made, from the files alone."""
    rows = spark.read.parquet(source)
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # the window without a key has one row for each part written
    parts = (rows.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    starts = (rows.select("part", "seq", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("first")).join(parts, "part")
              .select("part", "seq", (F.col("before") + F.col("first")).alias("first")))
    schema = "part int, seq long, doc_id long, inside long, n_tokens long, ids_crc32 long" + (", ids array<long>" if whole else "")
    docs = rows.select("part", "seq", "docs", "counts", "segment").mapInArrow(lambda it: _documents(it, whole), schema)
    return docs.join(starts, ["part", "seq"]).select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * whole)
