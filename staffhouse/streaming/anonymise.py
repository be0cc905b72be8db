"""Export anonymisation operators: map people to ids, mask names, default ids for
unknown people, forward-fill ids, drop identifying columns, date slicing by file name.

Masking covers the whole file, as in the source job: every name matched anywhere in it is
removed from every row. Cells and names are joined on words, so no pattern over all names
is built on the driver.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import named

# fixed value: the date in a file name
DATE_IN_NAME = r"(\d{4}-\d{2}-\d{2})"


def map_ids(df: DataFrame, mapping: DataFrame, left_col: str, right_col: str) -> DataFrame:
    """Left join on ``left_col = right_col``; duplicate mapping names fan out (as a
    pandas merge does). The mapping side is measured by AQE and broadcast when small."""
    return df.join(mapping.withColumn("_match", named(right_col)), named(left_col) == F.col("_match"), "left").drop("_match")


def _words(c: Column) -> Column:
    return F.filter(F.split(c, r"[^\p{L}\p{N}_]+"), lambda w: w != "")


def matched_names(merged: DataFrame, ref_col: str, file_cols: Sequence[str] = ()) -> DataFrame:
    """The distinct reference values that a file's rows were matched with."""
    return (merged.where(named(ref_col).isNotNull() & (named(ref_col) != ""))
            .select(*file_cols, named(ref_col).alias("_name")).distinct())


def mask_values(df: DataFrame, col: str, ref_col: str, file_cols: Sequence[str] = ()) -> DataFrame:
    """null -> '' and remove every name matched anywhere in the file from every row of it,
    at word boundaries (quoted, so regex characters in names are literal; of overlapping
    names the longer one).

    Cells meet names on a word they have in common: the words of the distinct cells are
    joined with the rarest word of the file's names, so no pattern over all names is built,
    and a name is compared with those cells only that hold its rarest word.
    A cell text is masked once for each file (``file_cols``).
    """
    text = F.coalesce(named(col).cast("string"), F.lit(""))
    df = df.withColumn(col, text)
    names = matched_names(df, ref_col, file_cols)
    # a name is looked up by that of its words which the fewest names have
    by_word = names.withColumn("_word", F.explode(F.array_distinct(_words(F.col("_name")))))
    often = by_word.groupBy(*file_cols, "_word").agg(F.count("*").alias("_n"))
    names = (by_word.join(often, [*file_cols, "_word"]).groupBy(*file_cols, "_name")
             .agg(F.min(F.struct("_n", "_word")).alias("_w")).select(*file_cols, "_name", F.col("_w._word").alias("_word")))
    cells = df.select(*file_cols, named(col).alias("_text")).distinct()
    met = (cells.withColumn("_word", F.explode(F.array_distinct(_words(F.col("_text")))))
           .join(names, [*file_cols, "_word"]).where(F.col("_text").contains(F.col("_name")))
           .groupBy(*file_cols, "_text")
           .agg(F.collect_set("_name").alias("_names")))      # bounded by the words of one cell
    by_length = F.transform(F.array_sort(F.transform("_names", lambda n: F.struct((-F.length(n)).alias("l"), n.alias("n")))), lambda x: x["n"])
    quoted = F.array_join(F.transform(by_length, lambda n: F.concat(F.lit(r"\Q"), F.replace(n, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))), "|")
    masked = met.select(*[F.col(c).alias(f"_in_{c}") for c in file_cols], "_text",
                        F.regexp_replace("_text", F.concat(F.lit(r"(?<![\p{L}\p{N}_])("), quoted, F.lit(r")(?![\p{L}\p{N}_])")), F.lit("")).alias("_masked"))
    cond = named(col) == F.col("_text")
    for c in file_cols:
        cond = cond & (F.col(c) == F.col(f"_in_{c}"))
    out = df.join(masked, cond, "left")
    return out.select(*[F.coalesce(F.col("_masked"), named(c)).alias(c) if c == col else named(c) for c in df.columns])


def default_id(df: DataFrame, col: str, id_col: str = "id", default: str = "0") -> DataFrame:
    """An unmapped person header ('Last, First' still present after masking) gets the
    default id so the fill-down does not hand it the previous person's id."""
    i = F.col(id_col)
    missing = i.isNull() | (i.cast("string") == "")
    return df.withColumn(id_col, F.when(missing & named(col).contains(","), F.lit(default)).otherwise(i))


def drop_identifiers(df: DataFrame, cols: Sequence[str], mapping_cols: Sequence[str] = ("troi_name", "email")) -> DataFrame:
    return df.drop(*[c for c in list(cols) + list(mapping_cols) if c in df.columns])


def date_from_name(path: Column) -> Column:
    """First ``yyyy-MM-dd`` in a file name, plus one day, as ``'yyyy-MM-dd 00:00:00'``."""
    d = F.to_date(F.regexp_extract(path, DATE_IN_NAME, 1), "yyyy-MM-dd")
    return F.concat(F.date_format(F.date_add(d, 1), "yyyy-MM-dd"), F.lit(" 00:00:00"))


def slice_between(df: DataFrame, col: str, lo: Column, hi: Column, inclusive_hi: bool = False) -> DataFrame:
    """Rows with ``lo < col < hi`` compared as text (header and blank rows drop out).

    ``inclusive_hi=True`` gives the half-open ``(lo, hi]`` form that loses no row at a
    file boundary; the default keeps the source behaviour.
    """
    c = named(col)
    upper = (c <= hi) if inclusive_hi else (c < hi)
    return df.where((c > lo) & upper)
