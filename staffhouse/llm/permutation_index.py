"""Approximate nearest neighbours by a permutation index.

Every vector is described by the order of its nearest pivots. Pivot inverted files hold, for each
pivot, the vectors that have it among their ``prefix`` nearest and at which position. A query
adds up the footrule distance over these files, the nearest share of every block is reranked by
the exact cosine, and the blocks' best are merged.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ShortType, StructField, StructType

from staffhouse.llm.common import stage


def usable(vec: str) -> Column:
    """Vectors that take part: not null, every component present and finite, not all zero."""
    c = F.col(vec)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(c.isNotNull() & fine & F.exists(c, lambda x: x != 0), F.lit(False))


def _matrix(column, dim: int) -> np.ndarray:
    out = np.zeros((len(column), dim))
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def nearest_pivots(vectors: DataFrame, pivots: np.ndarray, prefix: int) -> DataFrame:
    """Add ``order``: the numbers of the ``prefix`` nearest pivots, nearest first."""
    dim = pivots.shape[1]
    out = StructType([*vectors.schema, StructField("order", ArrayType(ShortType()))])

    def run(frames):
        for f in frames:
            near = np.argsort(-(_unit(_matrix(f["vec"], dim)) @ pivots.T), axis=1, kind="stable")[:, :prefix]
            yield f.assign(order=list(near.astype(np.int16)))
    return vectors.mapInPandas(run, out)


def inverted_files(orders, n_pivots: int, prefix: int) -> np.ndarray:
    """Row p is the file of pivot p: for every vector its position there, ``prefix`` if it is not
    among the vector's nearest."""
    files = np.full((n_pivots, len(orders)), prefix, np.int16)
    for v, order in enumerate(orders):
        files[order, v] = np.arange(len(order), dtype=np.int16)
    return files


def search_block(queries: pd.DataFrame, block: pd.DataFrame, dim: int, n_pivots: int, prefix: int,
                 share: float, least: int, k: int) -> list[tuple[int, int, float]]:
    """(query key, vec_id, cosine): the k + 1 nearest entries of one block for every query."""
    files = inverted_files(block["order"], n_pivots, prefix).T.copy()
    own = inverted_files(queries["order"], n_pivots, prefix).T
    raw, q = _matrix(block["vec"], dim), _matrix(queries["vec"], dim)
    norm, qnorm = np.sqrt((raw * raw).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
    n = max(least, int(np.ceil(share * len(block))))
    members, out = list(block["ids"]), []
    for i, key in enumerate(queries["qkey"]):
        near = np.arange(len(block))
        if n < len(block):
            footrule = np.abs(files - own[i]).sum(axis=1, dtype=np.int32)
            # every vector as near as the last one chosen is reranked too: ties do not depend on order
            near = np.flatnonzero(footrule <= np.partition(footrule, n - 1)[n - 1])
        score = (raw[near] * q[i]).sum(axis=1) / (norm[near] * qnorm[i])
        if len(near) > k + 1:
            keep = score >= -np.partition(-score, k)[k]
            near, score = near[keep], score[keep]
        entries = sorted((-s, int(v)) for j, s in zip(near, score) for v in members[j])[:k + 1]
        out += [(key, v, -s) for s, v in entries]
    return out


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
           n_pivots: int = 256, prefix: int = 128, rerank_share: float = 0.15, rerank_least: int = 200,
           block_rows: int = 2048, query_rows: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of every row that ``is_query`` marks (a condition
    on the id column), by cosine in double precision, ties to the smaller id, never the query itself.

    The pivots are a bounded sample (``n_pivots`` distinct vectors by a hash of the id); every vector is indexed.
    Equal vectors share one index entry with their ``k`` + 1 smallest ids, which is all a result can show
    of them, so copies of one vector never meet in one task. Blocks of entries meet blocks of queries.
    Unusable vectors take no part; shorter vectors read as padded with zeros; of several rows with one id
    the smallest vector counts; a null id is dropped; with no other vector a query has no rows."""
    rows = (vectors.filter(usable(vec_col) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), is_query.alias("is_q"))
            .groupBy("id").agg(F.min("vec").alias("vec"), F.max("is_q").alias("is_q")))
    rows = stage(rows, "op6_rows")
    first = Window.partitionBy("vec").orderBy("id")
    entries = (rows.select("id", "vec").withColumn("rn", F.row_number().over(first)).filter(F.col("rn") <= k + 1)
               .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
               .withColumn("key", F.col("ids")[0]))
    entries = stage(entries, "op6_entries")
    sizes = rows.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim")).first()
    out = "qkey long, vec_id long, score double"
    spark = vectors.sparkSession
    if not sizes["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = sizes["dim"]
    pivots = _unit(_matrix([r["vec"] for r in entries.select("key", "vec").orderBy(F.xxhash64("key"), "key").limit(n_pivots).collect()], dim))
    p, prefix = len(pivots), min(prefix, len(pivots))
    index = stage(nearest_pivots(entries, pivots, prefix), "op6_index")
    asked = (rows.filter("is_q").groupBy("vec").agg(F.min("id").alias("qkey")))
    asked = stage(nearest_pivots(asked, pivots, prefix), "op6_queries")
    n_blocks = -(-index.count() // block_rows)
    n_chunks = max(1, -(-asked.count() // query_rows))
    left = (asked.withColumn("chunk", F.pmod(F.xxhash64("qkey"), F.lit(n_chunks)).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))))
    right = (index.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_blocks)).cast("int"))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1)))))

    def meet(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = search_block(queries, block, dim, p, prefix, rerank_share, rerank_least, k) if len(queries) and len(block) else []
        return pd.DataFrame(found, columns=["qkey", "vec_id", "score"])
    found = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInPandas(meet, out)
    best = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rn", F.row_number().over(best)).filter(F.col("rn") <= k + 1).drop("rn")
    keys = rows.filter("is_q").select(F.col("id").alias("query_id"), "vec").join(asked.select("vec", "qkey"), "vec").drop("vec")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (keys.join(found, "qkey").filter("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
