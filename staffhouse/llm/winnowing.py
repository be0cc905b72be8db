"""Benchmark decontamination by winnowing, with DataFrame functions only.

A text's fingerprints are the smallest k-gram hash of every window of w consecutive k-grams. Two texts
that share k + w - 1 words share such a window whole, hence its fingerprint: with k = 5 and w = 6
every common span of ten words is found. Documents sharing a fingerprint are then extended:
each span of ten words around a shared k-gram is compared with the items' spans, word by word.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffhouse.llm.common import fresh, stage, texts

SPAN, GRAM = 10, 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"      # fixed value: words are digits, letters a-z and all beyond ASCII
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_ROWS = 200_000


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does it wherever nothing beyond ASCII would change."""
    rest = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    return F.when(F.lower(rest) == rest, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _upto(n: Column, length: int) -> Column:
    """Start positions of all stretches of ``length`` in a sequence of ``n``."""
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))


def gram_hashes(hashes: Column, n: Column, k: int) -> Column:
    """Hash of the ``k`` words from every position on."""
    return F.transform(_upto(n, k), lambda i: F.xxhash64(F.lit(k), *(F.get(hashes, i + j) for j in range(k))))


def fingerprints(grams: Column, w: int) -> Column:
    """The distinct smallest hashes over all windows of ``w`` k-grams."""
    return F.array_distinct(F.transform(_upto(F.size(grams), w), lambda i: F.least(*(F.get(grams, i + j) for j in range(w))) if w > 1 else F.get(grams, i)))


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("n", F.size("w")).withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))


def _families(short: list[int]) -> list[tuple[int, int, int]]:
    """(span, k, w): ten words; and each length of a shorter item, as one gram of that length."""
    return [(SPAN, GRAM, SPAN - GRAM + 1)] + [(n, n, 1) for n in short]


def item_spans(benchmark: DataFrame) -> DataFrame:
    """item_id, n, w and the item's distinct spans: ten words each, or the whole shorter item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.coalesce("text", F.lit(""))).alias("w"))
    items = _hashed(items.filter("item_id is not null")).filter("n > 0")
    span = F.least("n", F.lit(SPAN))
    return items.withColumn("spans", F.transform(F.sequence(F.lit(0), F.col("n") - span), lambda i: F.array_join(F.slice("w", i + 1, span), " ")))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), n_words, n_hit, n_items, items_sha256, contaminated: one row for every
    row of ``docs``; rows equal in doc_id and text have equal results.

    ``n_hit`` counts the words inside any occurrence of an item's span, ``n_items`` the items with one. Null
    and empty texts have no words; items without words or without id have no span; repeated items and items
    of one id count once. A null doc_id keeps its row, which is matched by its text alone. The item side is broadcast only where its fingerprints were counted
    and stay under ``BROADCAST_ROWS``; beyond that both sides are shuffled."""
    items = stage(item_spans(benchmark), "op3_items")
    short = [r[0] for r in items.filter(F.col("n") < SPAN).select("n").distinct().collect()]      # nine lengths at most
    families = _families(sorted(short))
    # rows of one (doc_id, th) are one; without an id the hash is another one, so no id is taken for it
    own_hash = F.when(F.col("id").isNull(), F.xxhash64("text", F.lit(0))).otherwise(F.xxhash64("text"))
    rows = (texts(docs).withColumnRenamed("doc_id", "id")
            .select(F.coalesce("id", F.lit(0).cast("long")).alias("doc_id"), own_hash.alias("th"), "id", F.xxhash64("text").alias("text_hash"), "text"))
    base = _hashed(rows.select("doc_id", "th", "id", "text_hash", words(F.col("text")).alias("w")))
    for span, k, w in families:
        base = base.withColumn(f"g{span}", gram_hashes(F.col("h"), F.col("n"), k)).withColumn(f"f{span}", fingerprints(F.col(f"g{span}"), w))
    prints = F.flatten(F.array(*(F.col(f"f{s}") for s, _, _ in families)))
    base = stage(base.select("doc_id", "th", "id", "text_hash", F.col("n").cast("long").alias("n_words"), prints.alias("prints")), "op3_prints")

    own = None
    for span, k, w in families:
        part = items.filter(F.col("n") >= SPAN if span == SPAN else F.col("n") == span)
        part = part.withColumn("g", gram_hashes(F.col("h"), F.col("n"), k)).select(F.explode(fingerprints(F.col("g"), w)).alias("print"))
        own = part if own is None else own.unionByName(part)
    own = stage(own.distinct(), "op3_item_prints")
    bounded = F.broadcast if own.count() <= BROADCAST_ROWS else (lambda df: df)
    shared = (base.select("doc_id", "th", F.explode("prints").alias("print")).join(bounded(own), "print")
              .groupBy("doc_id", "th").agg(F.collect_set("print").alias("shared")))
    shared = stage(shared, "op3_shared")

    # extension: the words again, for documents with a shared fingerprint only
    some = rows.join(shared, ["doc_id", "th"]).dropDuplicates(["doc_id", "th"])
    some = stage(_hashed(some.select("doc_id", "th", "shared", words(F.col("text")).alias("w"))), "op3_words")
    spans = None
    for span, k, w in families:
        g = some.withColumn("g", gram_hashes(F.col("h"), F.col("n"), k))
        at = F.filter(F.transform("g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda x: F.array_contains("shared", x["x"]))
        starts = F.flatten(F.transform(at, lambda x: F.sequence(F.greatest(x["i"] - (span - k), F.lit(0)), F.least(x["i"], F.col("n") - span))))
        g = g.filter(F.col("n") >= span).select("doc_id", "th", "w", F.explode(F.array_distinct(starts)).alias("start"))
        g = g.select("doc_id", "th", "start", F.lit(span).alias("span"), F.array_join(F.slice("w", F.col("start") + 1, span), " ").alias("words"))
        spans = g if spans is None else spans.unionByName(g)
    texts_of = items.select("item_id", F.explode("spans").alias("words")).distinct()
    known = texts_of.select("words").distinct()
    hits = stage(spans.join(known, "words"), "op3_hits")
    covered = F.aggregate(
        F.array_sort("places"), F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["start"] + x["span"] - F.greatest(a["end"], x["start"]))).alias("n"),
                              F.greatest(a["end"], x["start"] + x["span"]).alias("end")), lambda a: a["n"])
    n_hit = (hits.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "span")).alias("places"))
             .select("doc_id", "th", covered.cast("long").alias("n_hit")))
    found = (hits.select("doc_id", "th", "words").distinct().join(texts_of, "words")
             .groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("item_id")).alias("ids")))
    out = base.drop("prints").join(n_hit, ["doc_id", "th"], "left").join(found, ["doc_id", "th"], "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return out.select(F.col("id").alias("doc_id"), F.col("text_hash").alias("th"), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                      F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
                      (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold an item's span. Other columns may have any names; null texts hold none, rows with a
    null doc_id are judged by their text, repeated rows alike, an empty table gives no rows."""
    bad_id, bad_th = fresh(docs, "_bad_id", "_bad_th")
    bad = contamination(docs, benchmark).filter("contaminated").select(F.col("doc_id").alias(bad_id), F.col("th").alias(bad_th)).distinct()
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(F.col(bad_id)) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col(bad_th)), "left_anti")
