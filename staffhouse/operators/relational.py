"""Relational building blocks: unions by name, first row per key, pivot/unpivot,
row-generating operators (month and day series, map/array explosion), name mapping
and forward fill.

Scale notes
-----------
* ``first_per_key`` is a hash/sort aggregate with a map-side partial step, so a key
  holding a third of all rows is pre-reduced on every mapper before the shuffle.
* ``fill_down`` never windows over a whole partition key: rows are cut into blocks
  along the ordering, filled inside each block, and the carry between blocks comes
  from windows over one summary row per block, inside groups of bounded size.
* Series operators generate rows inside the task that owns the input row (``explode``);
  month steps are a closed form (no array folds). A small input is cut into pieces and
  rebalanced before such a row-multiplying generator.
* ``distinct_series`` finds out which input rows can give equal rows at all before any
  series is generated; the series of the others are never shuffled.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ColumnOrName, _c, named
from ..session import materialise


# ---------------------------------------------------------------- unions

def union_relations(dfs: Mapping[str, DataFrame] | Sequence[DataFrame], source_col: str | None = None,
                    types: str = "widen") -> DataFrame:
    """Union by column name; a column missing from a relation becomes null.

    ``source_col`` adds the relation name as a first column. ``types='widen'`` lets
    Spark widen shared columns to a common type; ``types='first'`` casts every shared
    column to the type it has in the first relation that carries it.
    """
    items = list(dfs.items()) if isinstance(dfs, Mapping) else [(f"rel_{i}", d) for i, d in enumerate(dfs)]
    if not items:
        raise ValueError("union_relations needs at least one relation")
    order: list[str] = []
    first_type: dict[str, T.DataType] = {}
    for _, d in items:
        for f in d.schema.fields:
            key = f.name.lower()
            if key not in first_type:
                order.append(f.name)
                first_type[key] = f.dataType
    out = None
    for name, d in items:
        present = {f.name.lower(): f.name for f in d.schema.fields}
        cols = []
        for c in order:
            k = c.lower()
            if k in present:
                col = F.col(present[k])
                if types == "first":
                    col = col.cast(first_type[k])
            else:
                col = F.lit(None).cast(first_type[k])
            cols.append(col.alias(c))
        if source_col:
            cols = [F.lit(name).alias(source_col)] + cols
        part = d.select(*cols)
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- one row per key

def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key combination: the row that is smallest by ``order`` (then by the
    remaining columns). Deterministic replacement for ``DISTINCT ON`` without ORDER BY.

    Planned as an aggregate with a partial (map-side) step: skew on a key costs one
    row per key per mapper after the partial step.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in (order or []) if c in rest]
    packed = order + [c for c in rest if c not in order]
    agg = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in packed])).alias("_first"))
    return agg.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])


# ---------------------------------------------------------------- pivot / unpivot

def column_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values of ``col``, as rows: the domain may be of any size."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


MAX_PIVOT = 10_000      # columns that a pivot may find by itself


def pivot_no_agg(df: DataFrame, keys: Sequence[str], col: str, val: str, values: Sequence | None = None) -> DataFrame:
    """Attribute-value rows -> one column per attribute of ``values``, taking the (single)
    value with ``max`` so text stays text. Without ``values`` (*action*) the attributes are those of ``column_values``
    in order; more than ``MAX_PIVOT`` of them are an error, such a domain is kept as rows or
    by ``attributes_map``."""
    if values is None:
        found = column_values(df, col).limit(MAX_PIVOT + 1).collect()
        if len(found) > MAX_PIVOT:
            raise ValueError(f"{col} has more than {MAX_PIVOT} values")
        values = sorted(r[0] for r in found)
    return df.groupBy(*keys).pivot(col, list(values)).agg(F.max(val))


def attributes_map(df: DataFrame, keys: Sequence[str], col: str, val: str) -> DataFrame:
    """The pivot of an open attribute domain: one map per key; one value per attribute (the
    greatest), attributes of one key bounded by what one record holds."""
    single = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.max(val).alias("_v"))
    return single.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(col), F.col("_v"))))).alias("attributes"))


def unpivot_measures(df: DataFrame, ids: Sequence[str], groups: Mapping[str, Sequence[ColumnOrName]],
                     name_col: str, value_cols: Sequence[str]) -> DataFrame:
    """Several measure groups -> rows, in one pass (``inline(array(struct ...))``).

    ``groups = {'A': [a_hours, a_days], 'B': [b_hours, b_days]}`` with
    ``value_cols = ['hours', 'days']`` yields one row per input row and group.
    """
    structs = []
    for name, cols in groups.items():
        if len(cols) != len(value_cols):
            raise ValueError(f"group {name!r} needs {len(value_cols)} columns")
        structs.append(F.struct(F.lit(name).alias(name_col),
                                *[_c(c).alias(v) for c, v in zip(cols, value_cols)]))
    return df.select(*ids, F.inline(F.array(*structs)))


# ---------------------------------------------------------------- row generators

def unpack_map(df: DataFrame, col: str, key: str = "col_id", value: str = "val") -> DataFrame:
    """One row per map entry (null values kept, empty/null maps give no row)."""
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.explode(col).alias(key, value))


def explode_ids(df: DataFrame, col: str, as_: str) -> DataFrame:
    """One row per array element; null or empty arrays give no row."""
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.explode(col).alias(as_))


def split_lines(df: DataFrame, col: str, as_: str, sep: str = "\n") -> DataFrame:
    """One row per line of a text cell; null cells give no row."""
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.explode(F.split(F.col(col), sep)).alias(as_))


def _first_offset_to(month_set: set[int]) -> list[int]:
    """For a start month 1..12, the number of months until the next month in ``month_set``."""
    return [next(j for j in range(1, 13) if ((m0 - 1 + j) % 12) + 1 in month_set) for m0 in range(1, 13)]


# months with 30 days; their distance from every start month is derived by rule
_THIRTY_DAY_MONTHS = {4, 6, 9, 11}


def _is_leap(y: Column) -> Column:
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


def _month_step_parts(start: ColumnOrName) -> dict[str, Column]:
    """Per-start constants of the drifting month series (day of step k = the running minimum of the start day and
    the month lengths passed; it drops at the first 30-day month, the first February and the
    first non-leap February only)."""
    s = _c(start)
    m0, y0 = F.month(s), F.year(s)
    j_feb = ((F.lit(2) - m0 + 11) % 12) + 1
    feb_leap = _is_leap(y0 + F.floor((m0 - 1 + j_feb) / 12).cast("int"))
    return {
        "_ms_first": F.trunc(s, "month"),
        "_ms_day0": F.dayofmonth(s),
        "_ms_j30": F.element_at(F.array(*[F.lit(v) for v in _first_offset_to(_THIRTY_DAY_MONTHS)]), m0),
        "_ms_jfeb": j_feb,
        "_ms_febdays": F.when(feb_leap, 29).otherwise(28),
        "_ms_jnl": F.when(feb_leap, j_feb + 12).otherwise(j_feb),
    }


def _month_step_from_parts(k: Column) -> tuple[Column, Column]:
    day = F.least(F.col("_ms_day0"), F.when(k >= F.col("_ms_j30"), 30).otherwise(31),
                  F.when(k >= F.col("_ms_jfeb"), F.col("_ms_febdays")).otherwise(31),
                  F.when(k >= F.col("_ms_jnl"), 28).otherwise(31))
    return F.add_months(F.col("_ms_first"), k.cast("int")), day


PIECE = 256         # months of a series that one task is given at a time, at most


def _months_between(s: Column, e: Column) -> Column:
    return (F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)


def _with_last_step(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows that have a series, with its constants and ``_n``, its last step: the step into the end's month counts if
    its day is not after the end. No row of the series has to be compared with the end then."""
    s, e = F.col(start), F.col(end)
    spans = df.where(e >= s).select("*", _months_between(s, e).alias("_ms_n"), *[v.alias(k) for k, v in _month_step_parts(start).items()])
    _, day = _month_step_from_parts(F.col("_ms_n"))
    return spans.withColumn("_n", F.col("_ms_n") - (day > F.dayofmonth(e)).cast("int")).drop("_ms_n")


def month_series(df: DataFrame, start: str, end: str, as_: str = "date",
                 spread_by: Sequence[str] | None = None) -> DataFrame:
    """One row per month from ``start`` to ``end`` for every input row, each step added
    to the previous value (the warehouse's generate_series). ``end < start`` gives no
    rows. Rows are generated in the task that owns the input row and every date is a
    scalar expression (whole-stage codegen, no array folds).

    ``spread_by``: the input of a series is small beside what it makes, so it would sit in few partitions. Its spans
    are cut into pieces of ``PIECE`` months first and rebalanced by these columns and the piece; how many
    partitions that gives is left to AQE, and a long span is not one task's."""
    spans = _with_last_step(df, start, end)
    if spread_by:
        spans = spans.withColumn("_from", F.explode(F.sequence(F.lit(0), F.col("_n"), F.lit(PIECE))))
        spans = spans.hint("rebalance", *spread_by, "_from")
        steps = F.sequence("_from", F.least(F.col("_n"), F.col("_from") + PIECE - 1))
    else:
        steps = F.sequence(F.lit(0), "_n")
    # per input row: the series constants; per generated row: comparisons and one addition of months
    month, day = _month_step_from_parts(F.col("_k"))
    return spans.withColumn("_k", F.explode(steps)).select(*df.columns, F.date_add(month, day - 1).alias(as_))


def month_span(df: DataFrame, start: str, end: str, first: str = "first_month", last: str = "last_month") -> DataFrame:
    """The first and last month in which ``month_series`` gives a row, in closed form, of the rows of which it gives
    any. The months between have one row each."""
    return _with_last_step(df, start, end).select(*df.columns, F.col("_ms_first").alias(first), F.add_months("_ms_first", F.col("_n")).alias(last))


def distinct_series(df: DataFrame, start: str, end: str, keys: Sequence[str], order: Sequence[str], as_: str = "date",
                    stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> tuple[DataFrame, DataFrame]:
    """The month series of ``df`` with one row per (``keys``, date): of several, the one whose input row is
    smallest by ``order`` (nulls first; its first column an integer). In two parts: the input rows whose series can meet
    that of no other, which needs no de-duplication, and the de-duplicated rows of the others.

    Only rows with the same keys and day of the month can meet in a date (a day after the 28th may become any
    from there on), so what is grouped before any series is generated are the input
    rows; series rows are grouped for the others alone, by (keys, date), which spreads a hot key over its
    months. Winners are the least of one fixed-width number (a hash aggregate) and their other columns are
    joined back from the input rows.

    Both parts, and the rows that the second one is made of, come from one marking of the input: ``stage(df, name)`` is
    called for the marked rows and for the second part, and may write them, so that no reader makes them again."""
    marked = [f"_key{i}" for i in range(len(keys))]
    day = F.least(F.dayofmonth(start), F.lit(28))
    peers = (df.where(F.col(end) >= F.col(start)).groupBy(*[F.col(k).alias(m) for k, m in zip(keys, marked)], day.alias("_day"))
             .agg(F.count(F.lit(1)).alias("_peers")).where("_peers > 1"))
    same = F.lit(True)
    for k, m in zip(keys, marked):
        same = same & F.col(k).eqNullSafe(F.col(m))
    tagged = stage(df.join(peers, same & (day == F.col("_day")), "left").select(*df.columns, F.col("_peers").isNotNull().alias("_shared")), "tagged")
    single = tagged.where(~F.col("_shared")).select(*df.columns)
    several = tagged.where("_shared").select(*df.columns).distinct()
    rest = [c for c in order[1:]] or [start, end]
    place = F.row_number().over(Window.partitionBy(*keys, order[0]).orderBy(*rest))
    number = F.coalesce(F.col(order[0]).cast("decimal(20,0)"), F.lit(-1 << 63).cast("decimal(20,0)")) * F.lit(10 ** 15).cast("decimal(16,0)") + place
    several = several.withColumn("_ord", number.cast("decimal(38,0)"))
    # a winner is told by its keys as well: the number is one within them
    rows = month_series(several.select("_ord", start, end, *keys), start, end, "_date", spread_by=["_ord", *keys])
    least = rows.groupBy(*[F.col(k).alias(m) for k, m in zip(keys, marked)], F.col("_date").alias(as_)).agg(F.min("_ord").alias("_least"))
    won = least.join(several, same & (F.col("_least") == F.col("_ord"))).select(*df.columns, as_)
    return single, stage(won, "several")


def date_spine(df: DataFrame, start: str, end: str, as_: str = "date") -> DataFrame:
    """One row per day from ``start`` to ``end`` (empty when end < start)."""
    s, e = F.col(start), F.col(end)
    days = F.when(e >= s, F.sequence(s, e, F.expr("INTERVAL 1 DAY")))
    return df.withColumn(as_, F.explode(days))


# ---------------------------------------------------------------- mapping and fill

def map_names(df: DataFrame, mapping: DataFrame, key: str, value: str, map_key: str | None = None) -> DataFrame:
    """Left join of ``df`` with the distinct ``(key, value)`` pairs of ``mapping``
    (value not null). A key with two values fans out, as in the source models."""
    mk = map_key or key
    pairs = (mapping.where(F.col(value).isNotNull())
             .select(F.col(mk).alias("_map_key"), F.col(value)).distinct())
    # rows without a key match nothing: they bypass the join, where all of them would meet in one task
    known = df.where(F.col(key).isNotNull())
    out = known.join(pairs, known[key] == pairs["_map_key"], "left").drop("_map_key")
    none = df.where(F.col(key).isNull()).withColumn(value, F.lit(None).cast(pairs.schema[value].dataType))
    return out.unionByName(none)


def row_numbers(df: DataFrame, order: Sequence[str], as_: str = "_rn") -> tuple[DataFrame, int]:
    """*Action*: (``df`` with ``as_``, the number of its rows): 0, 1, 2, ... in ``order``.

    The rows are dealt to ranges of the whole order, sorted there and written; a row's number is its place in
    its range plus the rows of the ranges before, a prefix sum over one count a range. No task sees more
    than a range, also where all rows share the leading column. ``order`` has to tell rows apart: rows equal in it are
    numbered in any order."""
    at = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    at = materialise(at, "row_numbers").withColumn("_range", F.shiftright("_at", 33))
    before, total = [], 0
    for r in sorted(at.groupBy("_range").count().collect()):        # a row a range
        before.append((r["_range"], total))
        total += r["count"]
    starts = df.sparkSession.createDataFrame(before, "_range bigint, _before bigint")
    numbered = at.join(F.broadcast(starts), "_range")
    return numbered.select(*map(named, df.columns), (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias(as_)), total


FILL_BLOCK, FILL_FANOUT, FILL_LEVELS = 1 << 16, 1 << 16, 4       # 2^64 blocks: every bigint block number


def fill_down(df: DataFrame, col: str, order: Sequence[str], block: Column | None = None, partition: Sequence[str] = (),
              as_: str | None = None, block_rows: int = FILL_BLOCK) -> DataFrame:
    """Forward fill: every null of ``col`` takes the last non-null value before it in
    ``order`` within ``partition``. Only nulls are filled ('' stops the fill).

    Rows are filled inside each (partition, block). The carry from earlier blocks comes from one summary
    row per block: blocks are grouped by ``FILL_FANOUT`` numbers, groups again, and a
    window only ever runs over the members of one group, so no task holds more than a
    block's rows or ``FILL_FANOUT`` summary rows, whatever the length of the table.

    Without ``block`` the rows are numbered first (``row_numbers``, an action) and a block is ``block_rows`` of them, so that
    blocks are of one size whatever the keys are, and there are no more levels than these need. A ``block`` that is
    given must be a non-negative integer column that is non-decreasing along ``order``.
    """
    out_col = as_ or col
    part = list(partition)
    columns, levels = df.columns, FILL_LEVELS
    if block is None:
        df, total = row_numbers(df, [*part, *order])
        order, block, levels = ["_rn"], F.floor(F.col("_rn") / block_rows), 1
        while total // block_rows >= FILL_FANOUT ** levels:
            levels += 1
    b = df.withColumn("_blk0", block.cast("bigint"))
    w_in = Window.partitionBy(*part, "_blk0").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = b.withColumn("_local", F.last(col, ignorenulls=True).over(w_in))
    order_struct = F.struct(*[F.col(o) for o in order])
    # one row per block with its last non-null value (null when it has none)
    level = (b.groupBy(*part, "_blk0")
             .agg(F.max_by(F.col(col), F.when(F.col(col).isNotNull(), order_struct)).alias("_last")))
    starts = None
    for k in range(levels):
        own, up = f"_blk{k}", f"_blk{k + 1}"
        level = level.withColumn(up, F.floor(F.col(own) / FILL_FANOUT).cast("bigint"))
        before = Window.partitionBy(*part, up).orderBy(own).rowsBetween(Window.unboundedPreceding, -1)
        carried = level.withColumn(f"_c{k}", F.last("_last", ignorenulls=True).over(before)).drop("_last")
        starts = carried if starts is None else starts.join(carried, [*part, own], "left")
        level = level.groupBy(*part, up).agg(
            F.max_by(F.col("_last"), F.when(F.col("_last").isNotNull(), F.col(own))).alias("_last"))
    carry = F.coalesce(*[F.col(f"_c{k}") for k in range(levels)])
    out = filled.join(starts.select(*part, "_blk0", carry.alias("_carry")), [*part, "_blk0"], "left")
    res = out.withColumn(out_col, F.coalesce(F.col("_local"), F.col("_carry")))
    return res.select(*map(named, columns if out_col in columns else [*columns, out_col]))
