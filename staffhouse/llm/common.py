"""Shared helpers of the training-data operators."""
from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staffhouse.session import materialise


BATCH_BYTES, SPARK_BATCH = 16 << 20, "67108864b"


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would, once a session, and let Arrow batches be smaller than
    Spark's 64 MB: whole texts go through them, and each is held several times on its way."""
    batch = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(batch, SPARK_BATCH) == SPARK_BATCH:           # another value is the user's
        spark.conf.set(batch, str(BATCH_BYTES))
    sc = spark.sparkContext
    if not any(f.endswith("/staffhouse.zip") for f in sc.listFiles):
        root, target = Path(__file__).resolve().parents[2], f"{tempfile.mkdtemp(prefix='staffhouse-code-')}/staffhouse.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in (root / "staffhouse").rglob("*.py"):
                z.write(f, f.relative_to(root))
        sc.addPyFile(target)        # the driver serves this file as long as the session lasts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of every row; a null text is an empty one. Other columns are left out, so
    their names cannot clash with what an operator adds."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def give_back() -> None:
    """Free memory of this process goes back to the system, also what the C library keeps for later use."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)         # glibc only
    if trim is not None:
        trim(0)


_held: dict[str, dict] = {}


def held(owner: str) -> dict:
    """What an operator's tasks remember in this Python worker. Workers live on from stage to stage, so what another
    operator has remembered is dropped first: memory is one operator's at a time."""
    if owner not in _held:
        _held.clear()
        give_back()
        _held[owner] = {}
    return _held[owner]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that ``df`` has no column of, for what a join adds to it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def own(df: DataFrame, name: str) -> Column:
    """The column of exactly this name."""
    return df["`" + name.replace("`", "``") + "`"]


def stage(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: later steps restart from
    files all executors see, and rows with generated ids stay as they were written."""
    return materialise(df, name, codec=codec)


def remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id's text modulo ``mod``; a null id has none and counts as 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % mod, F.lit(0)).cast("int")


def known_labels(labels: DataFrame, target: str, held_out: Column) -> DataFrame:
    """(doc_id, _y): one label for every id outside the held-out part. Several labels of one id count as their rounded
    mean; null labels and ids are dropped."""
    lab = (labels.select(F.col("doc_id").alias("doc_id"), F.col(target).cast("double").alias("_y"))
           .dropna().groupBy("doc_id").agg(F.round(F.avg("_y")).cast("int").alias("_y")))
    return lab.filter(~held_out)


def label_sample(features: DataFrame, labels: DataFrame, target: str, held_out: Column, bound: int) -> DataFrame:
    """At most about ``bound`` labelled documents outside the held-out part, chosen by a hash of the id.

    Labels are those of ``known_labels``. A document is one row
    however often it is listed; of several texts of one id that with the least hash counts.
    The share to keep follows from a count, so no task sorts or gathers all labelled rows."""
    lab = known_labels(labels, target, held_out)
    n = lab.count()
    if n > bound:
        share = int(bound / n * (1 << 32))
        lab = lab.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < share)
    rows = features.join(F.broadcast(lab), "doc_id")      # bounded above
    rest = [c for c in rows.columns if c not in ("doc_id", "_y")]
    return rows.groupBy("doc_id", "_y").agg(F.min(F.struct(F.xxhash64(*rest).alias("_order"), *rest)).alias("_row")).select("doc_id", *[f"_row.{c}" for c in rest], "_y")
