"""Sinks: delimited text by file ending, append-only processed tables, raw-zone
archive, clean-zone overwrite and publishing of checked marts."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_delimited(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """``;``-separated UTF-8 text; other endings than .csv raise."""
    if not path.lower().endswith(".csv") and "." in path.rsplit("/", 1)[-1]:
        raise ValueError(f"unsupported export format: {path}")
    (df.write.mode(mode).option("sep", ";").option("header", str(header).lower())
       .option("encoding", "UTF-8").csv(path))


def archive_raw(df: DataFrame, path: str, partition_col: str = "ingest_file") -> None:
    """Original files (restricted access), one partition per source file. Dynamic partition
    overwrite makes a replayed micro-batch rewrite the same partitions instead of
    appending duplicates."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col).parquet(path))


def write_clean(df: DataFrame, path: str, partition_col: str = "ingest_file") -> None:
    """Replace the anonymised content of the files in this batch only (dynamic
    partition overwrite; other files stay untouched)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(partition_col).parquet(path))


def append_processed(df: DataFrame, path: str, partition_col: str | None = "ingest_file") -> None:
    """Add the rows of new files to the processed table without touching earlier
    files. With ``partition_col`` each file is its own partition written by dynamic
    overwrite, so replaying a micro-batch after a failure is idempotent."""
    if partition_col and partition_col in df.columns:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(partition_col).parquet(path))
    else:
        df.write.mode("append").parquet(path)


def write_state(df: DataFrame, path: str) -> None:
    """The last file of a batch; a replayed batch rewrites its own row."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("seq").parquet(path))


def file_system(spark: SparkSession, path: str):
    """(file system, path) of a name in any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file as a mark that something is done."""
    fs, p = file_system(spark, path)
    fs.create(p, True).close()


def remove_file(spark: SparkSession, path: str) -> None:
    """Remove one landed file; one that is gone already is no error."""
    fs, p = file_system(spark, path)
    fs.delete(p, False)


def publish_path(df: DataFrame, path: str) -> None:
    """Staging -> production as files: full overwrite of one table folder."""
    df.write.mode("overwrite").parquet(path)
