"""Incremental ingest of manual exports with Structured Streaming.

``start_ingest`` watches ``<root>/raw/<name>/``, processes only files not seen before
(the checkpoint is the high-watermark state), and runs ``process_export`` once per
micro-batch via ``foreachBatch``:

  journal -> read by header -> map ids -> mask names -> default id -> fill down -> drop identifiers
  -> archive, clean zone and processed table (dynamic partition overwrite per file) -> state
  -> the raw file is replaced by the anonymised one.

The stream carries file names only, so a file of any ending is seen: an ending that cannot be
read is an error, not a file that is passed over. Headers come from the files' first lines; files of one
header are read together by Spark's CSV reader, columns are taken by name. The processed table keeps
rows strictly between the previous file's date and the file's own; the previous file of the first one
is the last file of the run before, which is kept in ``<root>/state/<name>``.

``trigger(availableNow=True)`` processes what is there and stops, which is the weekday
batch of the source; a second run with no new file processes nothing. Files already
carrying an ``id`` column are skipped.

A batch that failed is replayed with the same result, wherever it stopped. Before anything else its files and
their bounds are written to a journal beside the checkpoint, and a replay takes them from there, not from what is
left in the folder. Raw files are removed last, after a mark that all sinks are written: without
the mark all files are still there and every sink rewrites its own files' partitions, with it
only the removal is taken up again.
"""
from __future__ import annotations

import csv
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.relational import fill_down
from ..session import drop_stage, materialise
from ..sources import sinks
from ..sources.readers import file_ending
from . import anonymise as E


@dataclass
class ExportConf:
    name: str                       # export name, files under <root>/raw/<name>/
    root: str                       # storage root (shared file system / object store)
    checkpoint: str                 # streaming checkpoint (the file high-watermark)
    columns: list[str]              # header of the export (all text), in any order
    left_col: str                   # export column holding the person
    right_col: str                  # mapping column to match it with
    mapping_path: str               # parquet mapping (id, <right_col>, ...)
    del_cols: list[str] = field(default_factory=list)
    fill_down_col: str | None = None
    filter_col: str | None = None
    block_rows: int = 1 << 16       # fill-down block size along the row order


def _escaped(path: str) -> str:
    """A file name as a path pattern that matches it alone."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def headers(spark: SparkSession, files: list[Row]) -> dict[str, list[str]]:
    """The header of every file (path, uri) by uri: the cells of its first line that is not blank. Lines are read in
    splits; only the first of each file reach the driver."""
    lines = spark.read.text([_escaped(f.path) for f in files]).select(
        F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("n"), "value")
    first = lines.where((F.col("start") == 0) & (F.trim("value") != "")).groupBy("uri").agg(F.min_by("value", "n").alias("line"))
    return {r.uri: [c.strip() for c in next(csv.reader([r.line.removeprefix("\ufeff")], delimiter=";"))] for r in first.collect()}


def _problem(ending: str, header: list[str], conf: ExportConf) -> str | None:
    if ending != "csv":
        return f"unsupported file ending {ending}"
    if "id" in header:
        return None
    missing, unknown = [c for c in conf.columns if c not in header], [c for c in header if c and c not in conf.columns]
    if missing or unknown:
        return f"missing columns {', '.join(missing)}" if missing else f"unknown columns {', '.join(unknown)}"
    return None


def read_rows(spark: SparkSession, files: list[Row], conf: ExportConf) -> DataFrame:
    """The export's columns by name, ingest_file and _row (growing with the rows of a file). Files of one header are
    one read; a file is one task, as its cells may hold line breaks."""
    out = None
    for header in sorted({tuple(f.header) for f in files}):
        own = [f for f in files if tuple(f.header) == header]
        names = spark.createDataFrame([(f.uri, f.ingest_file) for f in own], "_uri string, ingest_file string")
        cells = (spark.read.schema(", ".join(f"_c{i} string" for i in range(len(header)))).option("sep", ";").option("header", "true")
                 .option("multiLine", "true").option("escape", '"').option("encoding", "UTF-8").csv([_escaped(f.ingest_file) for f in own]))
        cells = cells.select("*", F.col("_metadata.file_path").alias("_path"), F.monotonically_increasing_id().alias("_row"))
        rows = cells.join(names, F.col("_path") == F.col("_uri")).select(
            "ingest_file", "_row", *[F.nullif(F.col(f"_c{header.index(c)}"), F.lit("")).alias(c) for c in conf.columns])
        out = rows if out is None else out.unionByName(rows)
    return out


def last_state(spark: SparkSession, conf: ExportConf) -> tuple[str | None, int]:
    """The last file processed so far, and the number of the batch that it came with."""
    path = f"{conf.root}/state/{conf.name}"
    if not sinks.exists(spark, path):
        return None, 0
    last = spark.read.schema("last_file string, seq long").parquet(path).agg(F.max_by("last_file", "seq"), F.max("seq")).first()
    return last[0], last[1] or 0


def file_bounds(files: DataFrame, before: str | None) -> DataFrame:
    """ingest_file, _prev: the file before it in name order, ``before`` for the first one. The
    window runs over the file names of one batch."""
    w = Window.orderBy("ingest_file")
    return files.withColumn("_prev", F.coalesce(F.lag("ingest_file").over(w), F.lit(before).cast("string")))


JOURNAL = "ingest_file string, uri string, header array<string>, done boolean, prev string, seq long"


def journal(batch: DataFrame, batch_id: int, conf: ExportConf) -> tuple[str, list[Row]]:
    """*Action*: where this batch's journal is, and its files in order. It is written when the batch is first seen;
    a wrong file stops the batch before that. A replay reads it."""
    spark = batch.sparkSession
    path = f"{conf.checkpoint.rstrip('/')}/journal/{batch_id}"
    if not sinks.exists(spark, f"{path}/_complete"):
        to_uri = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        names = batch.select("path", F.lower(file_ending(F.col("path"))).alias("ending")).distinct().collect()
        files = [Row(path=r.path, ending=r.ending, uri=to_uri(r.path).toUri().toString()) for r in names]
        head = headers(spark, files) if files else {}
        wrong = sorted((f.path, p) for f in files if (p := _problem(f.ending, head.get(f.uri, []), conf)))
        if wrong:
            raise ValueError(f"{len(wrong)} export files cannot be read, first {wrong[0][0]}: {wrong[0][1]}")
        before, seq = last_state(spark, conf)
        known = spark.createDataFrame([(f.path, f.uri, head[f.uri], "id" in head[f.uri]) for f in files], "ingest_file string, uri string, header array<string>, done boolean")
        bounds = file_bounds(known.where("not done"), before).select("ingest_file", F.col("_prev").alias("prev"))
        sinks.publish_path(known.join(bounds, "ingest_file", "left").withColumn("seq", F.lit(seq + 1).cast("long")).coalesce(1), path)
        sinks.touch(spark, f"{path}/_complete")
    return path, sorted(spark.read.schema(JOURNAL).parquet(path).collect())


def process_export(batch: DataFrame, batch_id: int, conf: ExportConf, on_step: Callable[[str], None] = lambda step: None) -> None:
    """One micro-batch of new export files (path). ``on_step`` is told each step that is done."""
    spark = batch.sparkSession
    path, entries = journal(batch, batch_id, conf)
    on_step("journal")
    files = [f for f in entries if not f.done]
    if not files:
        return
    if not sinks.exists(spark, f"{path}/_written"):
        _write(spark, files, conf, on_step)
        sinks.touch(spark, f"{path}/_written")
        on_step("mark")
    for f in files:
        sinks.remove_file(spark, f.ingest_file)
        on_step("remove")


def _write(spark: SparkSession, files: list[Row], conf: ExportConf, on_step: Callable[[str], None]) -> None:
    mapping = spark.read.parquet(conf.mapping_path)
    mapping = mapping.select(F.col("id").cast("string").alias("id"), *[c for c in mapping.columns if c != "id"])
    run = uuid.uuid4().hex
    try:
        rows = materialise(read_rows(spark, files, conf), "ingest_rows", run)
        merged = E.map_ids(rows, mapping, conf.left_col, conf.right_col)
        out = E.mask_values(merged, conf.left_col, conf.right_col, ["ingest_file"])
        if conf.fill_down_col:
            out = E.default_id(out, conf.left_col)
            # rows fanned out by a repeated mapping name follow each other by id, as a merge lists them
            out = out.withColumn("_fan", F.coalesce(F.col("id"), F.lit("")))
            out = fill_down(out, conf.fill_down_col, ["_row", "_fan"], F.floor(F.col("_row") / conf.block_rows), ["ingest_file"]).drop("_fan")
        out = E.drop_identifiers(out, conf.del_cols, [c for c in mapping.columns if c != "id"])
        out = materialise(out.drop("_row"), "ingest_clean", run)
        content = spark.read.format("binaryFile").load([_escaped(f.ingest_file) for f in files])
        sinks.archive_raw(content.select(F.col("path").alias("ingest_file"), "content"), f"{conf.root}/archive/{conf.name}")
        on_step("archive")
        sinks.write_clean(out, f"{conf.root}/clean/{conf.name}")
        on_step("clean")
        proc = out
        if conf.filter_col:
            bounds = spark.createDataFrame([(f.ingest_file, f.prev) for f in files], "ingest_file string, _prev string")
            proc = out.join(bounds, "ingest_file")
            lo = F.coalesce(E.date_from_name(F.col("_prev")), F.lit(""))
            proc = E.slice_between(proc, conf.filter_col, lo, E.date_from_name(F.col("ingest_file"))).drop("_prev")
        sinks.append_processed(proc, f"{conf.root}/processed/{conf.name}")
        on_step("processed")
        state = spark.createDataFrame([(files[-1].ingest_file, files[-1].seq)], "last_file string, seq long")
        sinks.write_state(state, f"{conf.root}/state/{conf.name}")
        on_step("state")
    finally:
        drop_stage(spark, run)


def start_ingest(spark: SparkSession, conf: ExportConf, on_step: Callable[[str], None] = lambda step: None) -> StreamingQuery:
    """*Action*: process every new export file once and stop."""
    # a replayed batch may name files that are removed already; only names are taken from the stream
    # a pattern, not the folder: Spark would refuse a checkpoint whose last batch was read where the root lay before
    stream = (spark.readStream.format("binaryFile").option("ignoreMissingFiles", "true").schema("path string, modificationTime timestamp, length long, content binary")
              .load(f"{conf.root}/raw/{conf.name}/*").select("path"))
    return (stream.writeStream.foreachBatch(lambda df, bid: process_export(df, bid, conf, on_step))
            .option("checkpointLocation", conf.checkpoint)
            .trigger(availableNow=True).start())
