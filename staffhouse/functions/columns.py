"""Column -> Column helpers. All are native Spark expressions (whole-stage codegen, no UDFs).

Semantics follow the source warehouse (PostgreSQL) where Spark differs; each such
spot is named in the docstring.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def named(name: str) -> Column:
    """The column of exactly this name, also where it holds dots or back quotes (headers of exports do)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- text -> number

def clean_number(c: ColumnOrName, strict: bool = True) -> Column:
    """Locale text (``'1,50'``) to double: ``''`` -> null, decimal comma -> dot.

    ``strict`` raises on malformed text under ANSI mode (as the warehouse cast does);
    ``strict=False`` gives null instead.
    """
    s = F.replace(F.nullif(_c(c), F.lit("")), F.lit(","), F.lit("."))
    return s.cast("double") if strict else s.try_cast("double")


def int_from_text(c: ColumnOrName) -> Column:
    """``'12.0'`` -> 12: integer part before the first dot (split_part semantics)."""
    return F.split_part(_c(c), F.lit("."), F.lit(1)).cast("int")


def hhmm_to_hours(c: ColumnOrName) -> Column:
    """``'08:20'`` -> 8.33 hours as decimal(6,2). Only 5-character values convert; others -> null.

    Hours and the minute fraction are each rounded to 2 decimals before adding.
    """
    s = _c(c)
    hours = F.substring(s, 1, 2).cast("int").cast("decimal(5,2)")
    minutes = (F.substring(s, 4, 2).cast("int").cast("decimal(10,0)") / F.lit(60)).cast("decimal(5,2)")
    return F.when(F.length(s) == 5, (hours + minutes).cast("decimal(6,2)"))


def hhmm_minutes(c: ColumnOrName) -> Column:
    """``'HH:MM'`` -> minutes since midnight; empty/missing -> null."""
    s = F.nullif(F.trim(_c(c)), F.lit(""))
    return (F.split_part(s, F.lit(":"), F.lit(1)).cast("int") * 60
            + F.split_part(s, F.lit(":"), F.lit(2)).cast("int"))


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Difference of two ``HH:MM`` texts in minutes (end - start)."""
    return hhmm_minutes(end) - hhmm_minutes(start)


def minutes_to_hhmm(c: ColumnOrName) -> Column:
    """Minutes -> ``'HH:MM'``. Negative values give null (the warehouse renders them in a
    form that is not 5 characters long, which later converts to null); so do values of
    100 hours or more."""
    n = _c(c)
    return F.when((n >= 0) & (n < 6000),
                  F.format_string("%02d:%02d", F.floor(n / 60).cast("int"), (n % 60).cast("int")))


def minutes_to_hours(c: ColumnOrName) -> Column:
    """``hhmm_to_hours(minutes_to_hhmm(n))`` without the text round trip: the text is
    5 characters exactly when 0 <= n < 6000, hours and the minute fraction are each
    rounded to 2 decimals."""
    n = _c(c)
    hours = F.floor(n / 60).cast("int").cast("decimal(5,2)")
    minutes = ((n % 60).cast("decimal(10,0)") / F.lit(60)).cast("decimal(5,2)")
    return F.when((n >= 0) & (n < 6000), (hours + minutes).cast("decimal(6,2)"))


# ---------------------------------------------------------------- PostgreSQL string semantics

def pg_left(c: ColumnOrName, n: ColumnOrName | int) -> Column:
    """``left(s, n)``; negative n drops the last |n| characters (Spark returns '')."""
    s, k = _c(c), (F.lit(n) if isinstance(n, int) else _c(n))
    keep = F.when(k >= 0, k).otherwise(F.greatest(F.length(s) + k, F.lit(0)))
    return F.when(s.isNotNull() & k.isNotNull(), F.substring(s, F.lit(1), keep))


def pg_right(c: ColumnOrName, n: ColumnOrName | int) -> Column:
    """``right(s, n)``; negative n drops the first |n| characters."""
    s, k = _c(c), (F.lit(n) if isinstance(n, int) else _c(n))
    start = F.when(k >= 0, F.greatest(F.length(s) - k + 1, F.lit(1))).otherwise(-k + 1)
    length = F.when(k >= 0, F.least(k, F.length(s))).otherwise(F.greatest(F.length(s) + k, F.lit(0)))
    return F.when(s.isNotNull() & k.isNotNull(), F.substring(s, start, length))


def split_pair(c: ColumnOrName, sep: str = "/") -> tuple[Column, Column]:
    """``'1,00 / 8,00'`` -> (first, second) as doubles, cut at ``position(sep) - 1``
    characters from each end, exactly like the source model (see README for the
    format assumption this inherits)."""
    s = _c(c)
    n = F.locate(sep, s) - 1
    return clean_number(pg_left(s, n)), clean_number(pg_right(s, n))


# ---------------------------------------------------------------- null-safe arithmetic, money

def safe_add(*cols: ColumnOrName) -> Column:
    """Sum treating null as 0."""
    out = None
    for c in cols:
        term = F.coalesce(_c(c), F.lit(0))
        out = term if out is None else out + term
    return out


def safe_subtract(a: ColumnOrName, *cols: ColumnOrName) -> Column:
    """``a - b - ...`` treating null as 0."""
    out = F.coalesce(_c(a), F.lit(0))
    for c in cols:
        out = out - F.coalesce(_c(c), F.lit(0))
    return out


def div_cents(c: ColumnOrName, exact: bool = False) -> Column:
    """Cents -> units. Default: integer division truncating toward zero, as the warehouse
    does on integer columns (1999 -> 19). ``exact=True`` keeps the cents as decimal."""
    x = _c(c)
    if exact:
        return (x.cast("decimal(20,0)") / 100).cast("decimal(20,2)")
    return int_div(x.cast("bigint"), 100)


def int_div(x: Column, d: int) -> Column:
    """Integer division truncating toward zero (PostgreSQL ``int / int``), exact for bigint."""
    return ((x - x % d).cast("decimal(38,0)") / d).cast("bigint")


def round_half_up_ratio(num: ColumnOrName, den: ColumnOrName, scale_units: int = 100) -> Column:
    """Exact ``round(num / den, log10(scale_units))`` for integers, half away from zero,
    returned as decimal(20,2) when scale_units=100. Integer arithmetic avoids the
    double/decimal rounding differences between engines."""
    n, d = _c(num).cast("decimal(38,0)"), _c(den).cast("decimal(38,0)")
    sign = F.signum(n) * F.signum(d)
    an, ad = F.abs(n), F.abs(d)
    q = F.floor((an * (2 * scale_units) + ad) / (ad * 2))
    return F.when(ad != 0, (sign * q).cast("decimal(38,0)") / F.lit(scale_units)).cast("decimal(20,2)")


def hourly_rate(amount: ColumnOrName, hours: ColumnOrName, frequency: ColumnOrName) -> Column:
    """Hourly salary: monthly -> round((3 * amount / 13) / hours, 2); hourly -> amount.

    Computed exactly on integers (amount, hours in whole units). Zero hours give null
    instead of a division error (documented deviation).
    """
    a, h, f = _c(amount), _c(hours), _c(frequency)
    monthly = round_half_up_ratio(a * 3, h * 13)
    return (F.when(f == "monthly", monthly)
             .when(f == "hourly", a.cast("decimal(20,2)")))


# ---------------------------------------------------------------- calendar

def isodow(c: ColumnOrName) -> Column:
    """ISO day of week, Monday=1 .. Sunday=7."""
    return (F.weekday(_c(c)) + 1).cast("int")


def iso_week(c: ColumnOrName) -> Column:
    return F.weekofyear(_c(c)).cast("int")


def day_name(c: ColumnOrName, pad: int = 9) -> Column:
    """English day name blank-padded to ``pad`` characters (``to_char(d, 'Day')``)."""
    return F.rpad(F.date_format(_c(c), "EEEE"), pad, " ")


def week_year(c: ColumnOrName) -> Column:
    """Two-digit ISO week followed by the *calendar* year: 2024-12-30 -> '012024'."""
    d = _c(c)
    return F.concat(F.lpad(F.weekofyear(d).cast("string"), 2, "0"), F.year(d).cast("string"))


def is_weekend(c: ColumnOrName) -> Column:
    return isodow(c) > 5


def month_start(c: ColumnOrName) -> Column:
    """``date_trunc('month', d)`` that stays a DATE."""
    return F.trunc(_c(c), "month")


def year_start(c: ColumnOrName) -> Column:
    return F.trunc(_c(c), "year")


def add_years(c: ColumnOrName, n: int) -> Column:
    """``d + interval 'n year'`` (Feb 29 clamps to Feb 28)."""
    return F.add_months(_c(c), 12 * n)


# ---------------------------------------------------------------- bands and flags

def band(c: ColumnOrName, edges: Sequence[float], labels: Sequence, null_label=None) -> Column:
    """Right-closed banding: ``c <= edges[0] -> labels[0]``, ..., ``> edges[-1] -> labels[-1]``.

    ``len(labels) == len(edges) + 1``. Null input gives ``null_label``.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    x = _c(c)
    expr = None
    for e, lab in zip(edges, labels):
        cond = x <= F.lit(e)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    expr = expr.when(x > F.lit(edges[-1]), F.lit(labels[-1]))
    if null_label is not None:
        expr = expr.otherwise(F.lit(null_label))
    return expr


def legal_break_hours(worked: ColumnOrName) -> Column:
    """Statutory break for a day's worked hours: <=6 h -> 0, <=9 h -> 0.5, above -> 0.75."""
    return band(worked, [6, 9], [0, 0.5, 0.75]).cast("decimal(3,2)")


def compliance(required: ColumnOrName, actual: ColumnOrName) -> Column:
    """'O' when the actual break (a missing one counts as none) covers the required one,
    else 'X'; null when nothing is known to be required."""
    r = _c(required)
    return F.when(r.isNotNull(), F.when(F.coalesce(_c(actual), F.lit(0)) >= r, "O").otherwise("X"))


def rating_digit(c: ColumnOrName) -> Column:
    """Leading digit of a rating text such as ``'4 🙂'`` or ``'3-MEDIUM'``."""
    return pg_left(c, 1).cast("int")
