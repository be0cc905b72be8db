"""Repeated line runs found by a suffix array over line ids, later copies deleted.

Every text is a sequence of line ids (blank lines left out); a position is (document, line). The
suffix array is built by distributed prefix doubling: round k ranks each position by its first
2^k lines, from the ranks of its two halves. Equal ranks are the suffixes of one
longest-common-prefix interval, so an interval of any depth L is named by the two ranks, at the
largest power of two within L, of its first and its last lines. Positions alone in their
interval can start no repeat and leave the rounds, which is why later rounds are small. Doubling
ends at the depth of the longest run that has to be compared.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from staffhouse.llm.common import fresh, held, own, stage, texts

MIN_WORDS = 50


def _key(text: Column) -> Column:
    """Tells rows of one doc_id with different texts apart; rows equal in both are one document."""
    return F.xxhash64(text)


def _lines(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    held("line_dedup")
    for b in batches:
        for low in range(0, b.num_rows, 500):
            part = b.slice(low, 500)
            count, at, line, need, most = [], [], [], [], []
            for text in part.column(2).to_pylist():
                found = [(i, x) for i, x in enumerate(text.split("\n")) if x.strip()]
                n = len(found)
                count.append(n)
                if not n:
                    continue
                at.append(np.array([i for i, _ in found], np.int32))
                line += [xxhash.xxh128_digest(x.strip()) for _, x in found]
                before = np.concatenate([[0], np.cumsum([len(x.split()) for _, x in found])])
                # the first line at whose end min_words words are reached, counted from every line
                end = np.searchsorted(before, before[:-1] + min_words)
                reached = end <= n
                need.append(np.where(reached, end - np.arange(n), 0).astype(np.int32))
                # the least run of the next line ends where this line's longer runs need no test any more
                following = np.minimum(np.append(end[1:], n + 1), n + 1) - 1
                most.append(np.where(reached, np.maximum(end, following) - np.arange(n), 0).astype(np.int32))
            if not line:
                continue
            count = np.array(count)
            index = pa.array(np.repeat(np.arange(len(count)), count))
            join = lambda x: pa.array(np.concatenate(x))
            pos = pa.array(np.concatenate([np.arange(c, dtype=np.int32) for c in count]))
            yield pa.record_batch([part.column(0).take(index), part.column(1).take(index), pos, join(at), pa.array(line, pa.binary()), join(need), join(most)],
                                  names=["doc_id", "th", "pos", "at", "line", "need", "most"])


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """One row for each non-blank line: doc_id, th, at (number among all lines), pos (number among the
    non-blank ones), line (128-bit hash without outer white space), need (how many lines from here on
    reach ``min_words`` words; 0: the document ends before) and most (the longest run to test here).

    Rows equal in doc_id and text are one document and give its lines once: the rounds join positions with
    each other, so a position listed m times would be m^2, m^4, m^8, ... rows there."""
    rows = texts(docs).filter("doc_id is not null").select("doc_id", _key(F.col("text")).alias("th"), "text")
    # the other columns follow from (doc_id, th, pos); without them in the key they would be sorted, not hashed
    return rows.mapInArrow(lambda it: _lines(it, min_words),
                           "doc_id long, th long, pos int, at int, line binary, need int, most int").distinct()


def _rank(pairs: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Keys that occur at two positions or more, with ``rank``: increasing in the order of the keys.

    The keys are sorted across partitions and numbered as they lie; the written table keeps the
    numbers fixed."""
    at = F.struct("doc_id", "th", "pos")
    groups = pairs.groupBy(*keys).agg(F.min(at).alias("lo"), F.max(at).alias("hi")).filter("lo < hi").select(*keys)
    return stage(groups.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("rank", F.monotonically_increasing_id()), name)


def suffix_ranks(lines: DataFrame, depth: int) -> list[DataFrame]:
    """Ranks of the positions at depths 1, 2, 4, ... up to ``depth``: tables of doc_id, th, pos, rank.

    Only positions whose prefix of that depth occurs elsewhere too are listed."""
    at = ["doc_id", "th", "pos"]
    first = lines.select(*at, "line")
    levels = [stage(first.join(_rank(first, ["line"], "op9_ids"), "line").select(*at, "rank"), "op9_rank")]
    step = 1
    while step * 2 <= depth:
        last = levels[-1]
        ahead = last.select("doc_id", "th", (F.col("pos") - step).alias("pos"), F.col("rank").alias("r2"))
        pairs = stage(last.withColumnRenamed("rank", "r1").join(ahead, at), "op9_pairs")
        ranks = _rank(pairs, ["r1", "r2"], "op9_names")
        levels.append(stage(pairs.join(ranks, ["r1", "r2"]).select(*at, "rank"), "op9_rank"))
        step *= 2
    return levels


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """(runs, line table). A run (doc_id, th, pos, n): from line ``pos`` on, ``n`` lines of ``min_words``
    words or more together repeat the first place of these lines (smallest doc_id, then text hash, then line)
    without overlapping it, as far as the repeat goes.

    A run of L lines is compared over its interval. From a position the least run (``need`` lines)
    and the longer ones up to where the next position's least run takes over are tested, which adds up to
    about one test a line; together these cover every maximal repeated run."""
    lines = stage(line_table(docs, min_words), "op9_lines")
    at = ["doc_id", "th", "pos"]
    levels = suffix_ranks(lines, lines.agg(F.max("most")).first()[0] or 1)
    # a run can only repeat from a line that does
    starts = lines.filter("need > 0").join(levels[0].select(*at), at)
    tests = starts.select(*at, F.explode(F.sequence("need", "most")).alias("n"))
    tests = tests.withColumn("k", F.floor(F.log2(F.col("n").cast("double"))).cast("int"))
    ranks = None
    for k, level in enumerate(levels):
        level = level.withColumn("k", F.lit(k))
        ranks = level if ranks is None else ranks.unionByName(level)
    head = tests.join(ranks.withColumnRenamed("rank", "r1"), [*at, "k"])
    tail = ranks.select("doc_id", "th", F.col("pos").alias("p2"), "k", F.col("rank").alias("r2"))
    head = head.withColumn("p2", F.col("pos") + F.col("n") - F.pow(F.lit(2), F.col("k")).cast("int"))
    named = stage(head.join(tail, ["doc_id", "th", "p2", "k"]).select(*at, "n", "r1", "r2"), "op9_named")
    place = F.struct(*at)
    first = named.groupBy("n", "r1", "r2").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first < last").drop("last")
    # a copy that overlaps the place that stays would take lines from it
    apart = (F.col("first.doc_id") != F.col("doc_id")) | (F.col("first.th") != F.col("th")) | (F.col("pos") >= F.col("first.pos") + F.col("n"))
    later = named.join(first, ["n", "r1", "r2"]).filter((place > F.col("first")) & apart)
    return later.groupBy(*at).agg(F.max("n").alias("n")), lines


@F.pandas_udf(StringType())
def _without(text: pd.Series, cut: pd.Series) -> pd.Series:
    def one(t: str, at) -> str:
        gone = set(at)
        return "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)
    return pd.Series([None if t is None else one(t, at) for t, at in zip(text, cut)], dtype=object)


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, drop_emptied: bool = False) -> DataFrame:
    """``docs`` without the later copies of repeated line runs of ``min_words`` words or more; the column
    ``text`` holds what is left, ``n_chars`` (if there) is counted anew where the text changed, other columns
    stay. ``drop_emptied`` leaves out documents that lost all their lines.

    The earliest copy (smallest doc_id) stays whole, also where a later one overlaps it: of a line repeated in a row as many stay as
    make one run. Null and empty texts stay as they are, blank lines are
    never part of a run and are kept, rows equal in doc_id and text are one document and stay together,
    rows without doc_id stay unchanged, other columns may have any names."""
    runs, lines = repeated_runs(docs, min_words)
    cut_id, cut_th, cut_at, new = fresh(docs, "_cut_id", "_cut_th", "_cut_at", "_new")
    covered = runs.select("doc_id", "th", F.explode(F.sequence("pos", F.col("pos") + F.col("n") - 1)).alias("pos")).distinct()
    cut = (covered.join(lines.select("doc_id", "th", "pos", "at"), ["doc_id", "th", "pos"])
           .groupBy(F.col("doc_id").alias(cut_id), F.col("th").alias(cut_th)).agg(F.collect_list("at").alias(cut_at)))
    cut = stage(cut, "op9_cut")
    at = (docs["doc_id"].cast("long") == F.col(cut_id)) & (_key(docs["text"]) == F.col(cut_th))
    # a merge join at every size: whether the table of cuts is small must not decide how texts move
    out = docs.join(cut.hint("merge"), at, "left")
    changed = F.col(cut_at).isNotNull()
    # only changed texts are sent to Python
    out = out.withColumn(new, F.coalesce(_without(F.when(changed, docs["text"]), cut_at), docs["text"]))
    if drop_emptied:
        out = out.filter(~changed | (F.trim(F.regexp_replace(new, r"[\t\r\n]", " ")) != ""))
    cols = [F.when(changed, F.length(new)).otherwise(own(docs, c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
            else F.col(new).alias("text") if c == "text" else own(docs, c) for c in docs.columns]
    return out.select(*cols)
