"""Session construction and cluster-shared locations."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at runtime: a side whose
# measured shuffle output is under the threshold is broadcast, a skewed
# partition of a sort-merge join is split, and small partitions coalesce.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "staffhouse",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Local/test session builder. On a cluster the launcher supplies master and sizing."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder that the cluster names in ``spark.checkpoint.dir``.

    A local session (one machine, as in tests) may go without: it gets a scratch folder. On a
    cluster an unset folder is an error, as a machine's own disk is not seen by the others.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.conf.get("spark.master", "local").split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="staffhouse-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A location under the shared checkpoint folder (for materialised intermediates)."""
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), *parts])


def materialise(df, name: str, run_id: str | None = None, codec: str | None = None):
    """*Action*: write ``df`` as Parquet under the shared checkpoint folder and return
    a DataFrame reading it back. Cuts the lineage (downstream stages restart from the
    files, also after executor loss) and lets several consumers share one
    computation. Each call gets its own folder unless ``run_id`` is given."""
    spark = df.sparkSession
    path = shared_path(spark, "staffhouse-stage", run_id or uuid.uuid4().hex, name)
    df.write.mode("overwrite").option("compression", codec or "snappy").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(spark: SparkSession, run_id: str) -> None:
    """Remove what ``materialise`` wrote under ``run_id``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_path(spark, "staffhouse-stage", run_id))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
