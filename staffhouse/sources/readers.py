"""Readers for landed record streams and file exports, and the slice-key operators
that turn parent records into child request keys."""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import named
from .schemas import LOADER_COLUMNS, SHEETS, STREAMS


def read_stream(spark: SparkSession, name: str, path: str, multi_line: bool = False) -> DataFrame:
    """A landed record stream with its fixed schema: JSON lines (splittable, the
    default) or, with ``multi_line=True``, one top-level JSON array per file.
    A malformed record fails the read. ``active_employees`` applies the source record
    filter; ``custom_tables_val`` turns open attributes into the ``col_val`` map."""
    if name == "custom_tables_val":
        raw = spark.read.option("wholetext", str(multi_line).lower()).text(path)
        if multi_line:
            raw = raw.select(F.explode(F.from_json("value", "array<string>", {"mode": "FAILFAST"})).alias("value"))
        return custom_value_records(raw.where(F.trim("value") != ""), "value")
    schema = STREAMS[name]
    df = spark.read.schema(schema).option("multiLine", str(multi_line).lower()).option("mode", "FAILFAST").json(path)
    if name == "active_employees":
        df = record_filter(df, F.col("terminated_on").isNull())
    return df


def custom_value_records(raw: DataFrame, col: str) -> DataFrame:
    """Record text with open attribute keys -> id, employee_id, table_id and the map of the rest."""
    types = {"id": "bigint", "employee_id": "bigint", "table_id": "bigint"}
    out = dynamic_columns_to_map(raw, col, list(types), "col_val", types)
    return out.select(*[f.name for f in STREAMS["custom_tables_val"].fields])


def extract_records(raw: DataFrame, col: str, schema: T.StructType) -> DataFrame:
    """Response bodies whose top level *is* the record list -> one row per record; a
    malformed body fails."""
    records = F.from_json(F.col(col), T.ArrayType(schema), {"mode": "FAILFAST"})
    return raw.select(F.explode(records).alias("r")).select("r.*")


def read_sheet(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A sheet export (CSV, header) read with every declared column as text; a declared
    column that the file lacks is an error."""
    df = spark.read.option("header", "true").option("multiLine", "true").csv(path)
    wanted = SHEETS.get(name)
    return drop_loader_columns(df if not wanted else df.select(*wanted))


def loader_name(header: str) -> str:
    """A header as the warehouse loader names its column: other characters than ASCII letters and
    digits become underscores."""
    return re.sub(r"[^0-9A-Za-z]", "_", header)


def read_processed(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The processed table that ``streaming.ingest`` adds to, as the models read it: the column sets of all its files
    merged (a file without a column has nulls there), headers named as by the loader, every
    declared column as text. A declared column that no file has is an error."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    found: dict[str, list[str]] = {}
    for c in df.columns:
        found.setdefault(loader_name(c).lower(), []).append(c)
    missing = [c for c in SHEETS[name] if c.lower() not in found]
    if missing:
        raise ValueError(f"no file of {path} has the columns {', '.join(missing)}")
    return df.select(*[F.coalesce(*[named(x).cast("string") for x in found[c.lower()]]).alias(c) for c in SHEETS[name]])


def read_export(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A manual export by file ending: ``.csv`` -> ``;``-separated UTF-8 with header and
    multi-line cells (break cells hold line breaks). Other endings raise."""
    ending = path.rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
    if ending != "csv":
        raise ValueError(f"unsupported export format: {ending!r} ({path})")
    r = (spark.read.option("sep", ";").option("header", "true").option("multiLine", "true")
         .option("encoding", "UTF-8"))
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def file_ending(path: Column) -> Column:
    """Text after the last '.' of a path column."""
    return F.substring_index(path, ".", -1)


def drop_loader_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in LOADER_COLUMNS if c in df.columns])


def record_filter(df: DataFrame, cond: Column) -> DataFrame:
    """Keep records matching ``cond`` (source-side filter)."""
    return df.where(cond)


def array_parent_keys(df: DataFrame, col: str, as_: str, parent_key: str | None = None) -> DataFrame:
    """One child key per element of an id array; null and empty arrays give no key."""
    cols = ([F.col(parent_key)] if parent_key else []) + [F.explode(F.col(col)).alias(as_)]
    return df.select(*cols)


def parent_keys(df: DataFrame, key: str, as_: str) -> DataFrame:
    """One slice per parent record."""
    return df.select(F.col(key).alias(as_))


def dynamic_columns_to_map(df: DataFrame, raw: str, keep: Sequence[str], as_: str = "col_val",
                           key_types: dict[str, str] | None = None) -> DataFrame:
    """JSON record text with open keys -> the fixed ``keep`` fields plus one
    ``map<string,string>`` of every other attribute (null values kept)."""
    parsed = F.from_json(F.col(raw), T.MapType(T.StringType(), T.StringType()), {"mode": "FAILFAST"})
    keep_arr = F.array(*[F.lit(k) for k in keep])
    other = F.map_filter(parsed, lambda k, _v: ~F.array_contains(keep_arr, k))
    key_types = key_types or {}
    fixed = [F.element_at(parsed, F.lit(k)).cast(key_types.get(k, "string")).alias(k) for k in keep]
    rest = [c for c in df.columns if c != raw]
    return df.select(*rest, *fixed, other.alias(as_))


def choice_options(fields: DataFrame) -> DataFrame:
    """Custom-field definitions -> one row per choice option (fields without options
    give no row)."""
    return (fields.select(F.col("id").alias("field_id"), F.col("label").alias("field_label"),
                          F.explode("choice_options").alias("o"))
            .select("field_id", "field_label", F.col("o.id").alias("option_id"), F.col("o.label").alias("label"),
                    F.col("o.value").alias("value"), F.col("o.is_active").alias("is_active")))
