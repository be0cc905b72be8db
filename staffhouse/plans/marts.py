"""The reporting models: one pure function per model, source-shaped DataFrames in,
DataFrame out. ``as_of`` replaces the warehouse's ``current_date`` everywhere.

Base models (projection/cleaning) -> intermediate models (time tracking, custom
tables, payments) -> dimensions and facts. Names of inputs follow the sources.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import intervals as I
from ..operators import relational as R
from ..sources.schemas import COMPENSATION, CONTRACT, CUSTOM_TABLE, CUSTOM_TABLE_COL, EMPLOYEE, SHEETS, TEAM


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


# ====================================================================== base models

EMPLOYEE_COLUMNS = [f.name for f in EMPLOYEE.fields]


def active_employees(employees: DataFrame) -> DataFrame:
    """M1: projection of the active-employee stream (source filter: no termination)."""
    return employees.where(F.col("terminated_on").isNull()).select(*EMPLOYEE_COLUMNS)


def terminated_employees(employees: DataFrame) -> DataFrame:
    """M2: only non-personal columns survive for people with a termination date
    (a future date counts as terminated)."""
    return (employees.where(F.col("terminated_on").isNotNull())
            .select("id", "terminated_on", "termination_reason", "termination_reason_type",
                    "termination_observations"))


def _projection(schema, cents: Sequence[str] = ()) -> list[Column]:
    """Every declared column (one that the input lacks is an error); ``cents`` -> whole units."""
    return [C.div_cents(f.name).alias(f.name) if f.name in cents else F.col(f.name) for f in schema.fields]


def base_contracts(contracts: DataFrame) -> DataFrame:
    """M3: projection; salary cents and hundredths of hours -> whole units (integer division)."""
    return contracts.select(*_projection(CONTRACT, ["salary_amount", "working_hours"]))


def base_compensation(compensation: DataFrame) -> DataFrame:
    """M4: projection; amount cents -> whole units (integer division)."""
    return compensation.select(*_projection(COMPENSATION, ["amount"]))


def base_custom_tables(df: DataFrame) -> DataFrame:
    """M5."""
    return df.select(*_projection(CUSTOM_TABLE))


def base_custom_tables_col(df: DataFrame) -> DataFrame:
    """M6."""
    return df.select(*_projection(CUSTOM_TABLE_COL))


def base_custom_tables_val(df: DataFrame) -> DataFrame:
    """M7."""
    return df.select("id", "employee_id", "col_val", "table_id")


def base_teams(df: DataFrame) -> DataFrame:
    """M8."""
    return df.select(*_projection(TEAM))


def mood_survey_answers(df: DataFrame) -> DataFrame:
    """M9: cast the answer date."""
    return df.select(*SHEETS["mood_survey_answers"]).withColumn("date", F.col("date").cast("date"))


def name_mapping_pto(df: DataFrame) -> DataFrame:
    """The two lumped mapping sheets, id and year typed."""
    return df.select(F.col("id").cast("int").alias("id"), "email", "troi_name",
                     F.col("jahr").cast("date").alias("jahr"), "name", "urlaubsanspruch_pt", "resturlaub_vorjahr")


def _float_to_int(c: Column) -> Column:
    # the warehouse rounds (half to even) when casting float to integer; Spark truncates
    return F.bround(c, 0).cast("int")


def processed_lunchit(df: DataFrame) -> DataFrame:
    """Meal-benefit export, locale numbers -> double, German dates -> date."""
    return df.select(
        F.col("Lunchit_Beleg_ID").alias("lunchit_beleg_id"),
        C.clean_number("Lunchit_1_2").alias("lunchit_1_2"),
        C.clean_number("Lunchit_2_2").alias("lunchit_2_2"),
        C.clean_number("Eingereichter_Betrag").alias("eingereichter_betrag"),
        C.clean_number("Erstattungsbetrag").alias("erstattungsbetrag"),
        C.clean_number("Zuzahlung").alias("zuzahlung"),
        _float_to_int(C.clean_number("id")).alias("id"),
        F.to_date(F.nullif(F.col("Abrechnungsmonat"), F.lit("")), "dd.MM.yyyy").alias("abrechnungsmonat"),
        F.to_date(F.nullif(F.col("Datum"), F.lit("")), "dd.MM.yyyy").alias("datum"))


# fixed value: shape of a day row's month cell
DAY_ROW = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def processed_troi(df: DataFrame) -> DataFrame:
    """Time-tracking export: rename, locale numbers -> double, id '12.0' -> 12,
    keep day rows only (timestamp-shaped month cell)."""
    out = df.select(
        F.col("Monat").alias("monat"), F.col("Checked_In").alias("checked_in"),
        F.col("Checked_Out").alias("checked_out"), F.col("Pausenzeiten").alias("pausenzeiten"),
        F.col("Arbeitszeit").alias("arbeitszeit"),
        C.clean_number("erfasste_Stunden").alias("erfasste_stunden"),
        F.col("Urlaub__PT___Std__").alias("urlaub"), F.col("krank__PT___Std__").alias("krank"),
        F.col("Kurzarbeit__PT___Std__").alias("kurzarbeit"),
        F.col("Abwesenheiten__PT___Std__").alias("abwesenheiten"),
        C.clean_number("Gesamt").alias("gesamt"), C.clean_number("WB").alias("wb"),
        C.clean_number("NWB").alias("nwb"), C.clean_number("wb_nwb").alias("wb_nwb"),
        C.clean_number("an_ab").alias("an_ab"), C.clean_number("Soll").alias("soll"),
        C.clean_number("Saldo").alias("saldo"),
        C.int_from_text("id").alias("id"))
    return out.where((F.col("monat") != "") & F.coalesce(F.col("monat").rlike(DAY_ROW), F.lit(False)))


# ====================================================================== time tracking

def map_names_troi(troi: DataFrame, mapping: DataFrame) -> DataFrame:
    """Tracking rows + the person's tracking name (distinct (id, name) pairs)."""
    return R.map_names(troi, mapping, "id", "troi_name")


def industrial_working_hours(mapped: DataFrame) -> DataFrame:
    """Rename, working time 'HH:MM' -> decimal hours, day from the month cell."""
    return mapped.select(
        F.col("pausenzeiten").alias("break_time_period"), F.col("urlaub").alias("paid_absence"),
        F.col("krank").alias("sick_leave"), F.col("kurzarbeit").alias("short_working"),
        F.col("abwesenheiten").alias("absence_time"), "wb", "nwb", F.col("soll").alias("planned_amount"),
        "troi_name", F.col("monat").cast("date").alias("date"),
        C.hhmm_to_hours("arbeitszeit").alias("industrial_working_hours"))


def break_hours(iwh: DataFrame) -> DataFrame:
    """Break cells ('HH:MM - HH:MM' per line) -> hours per person and day.

    Each break is rounded to 2 decimals before summing; a break ending before it
    starts (or without an end) contributes nothing.
    """
    lines = R.split_lines(iwh.select("date", "troi_name", "break_time_period"), "break_time_period", "value")
    single = lines.where(F.col("value") != "").select("date", "troi_name", F.trim("value").alias("brk"))
    # staged projections: each intermediate is computed once
    ends = single.select("date", "troi_name",
                         F.trim(F.split_part(F.col("brk"), F.lit("-"), F.lit(1))).alias("_start"),
                         F.trim(F.split_part(F.col("brk"), F.lit("-"), F.lit(2))).alias("_end"))
    mins = ends.select("date", "troi_name", C.minutes_between("_start", "_end").alias("_min"))
    hours = mins.select("date", "troi_name", C.minutes_to_hours("_min").alias("h"))
    return hours.groupBy("date", "troi_name").agg(F.sum("h").cast("decimal(16,2)").alias("break_amount"))


ABSENCE_TYPES = ["paid_absence", "sick_leave", "short_working", "absence_time"]


def cleaned_absences(iwh: DataFrame) -> DataFrame:
    """The four 'mandays / hours' cells -> eight doubles."""
    # the cut position of each cell is computed once (staged projection)
    pos = iwh.select("*", *[(F.locate("/", F.col(t)) - 1).alias(f"_n_{t}") for t in ABSENCE_TYPES])
    cols = []
    for t in ABSENCE_TYPES:
        n = F.col(f"_n_{t}")
        cols += [C.clean_number(C.pg_right(t, n)).alias(f"{t}_hours"),
                 C.clean_number(C.pg_left(t, n)).alias(f"{t}_mandays")]
    return pos.select("date", "break_time_period", *cols, "wb", "nwb", "planned_amount", "troi_name",
                      "industrial_working_hours")


# ====================================================================== custom tables

def unpack_custom_values(vals: DataFrame) -> DataFrame:
    """One row per (record, column id) of the dynamic value map."""
    u = R.unpack_map(vals.select("id", "employee_id", "table_id", "col_val"), "col_val", "_k", "val")
    return u.select("id", "employee_id", "table_id", F.col("_k").cast("int").alias("col_id"), "val")


def label_custom_values(unpacked: DataFrame, tables: DataFrame, cols: DataFrame) -> DataFrame:
    """Attach table name and column label (inner joins: unknown ids drop out).
    Header tables are small; AQE turns these into broadcast joins after measuring them."""
    t = tables.select(F.col("id").alias("_tid"), F.col("name").alias("table_name"))
    c = cols.select(F.col("id").alias("_cid"), F.col("label").alias("col_name"))
    j = (unpacked.join(t, unpacked["table_id"] == t["_tid"], "inner")
         .join(c, unpacked["col_id"] == c["_cid"], "inner"))
    return j.select("id", F.col("employee_id").alias("factorial_id"), "table_id", "table_name", "col_id",
                    "col_name", "val")


def pivot_custom_table(mapped: DataFrame, table_pattern: str, labels: Sequence[str]) -> DataFrame:
    """Rows of custom tables whose name matches ``%pattern%`` pivoted to one column per
    given label."""
    f = mapped.where(F.col("table_name").contains(table_pattern))
    return R.pivot_no_agg(f, ["factorial_id", "id"], "col_name", "val", labels)


def inflation_payment(mapped: DataFrame) -> DataFrame:
    """Inflation-compensation rows -> payments (cents -> units, integer division)."""
    p = pivot_custom_table(mapped, "Inflation", ["Datum", "Betrag"])
    return p.select("factorial_id", F.col("Datum").cast("date").alias("date"), F.lit("Inflation").alias("type"),
                    F.lit("Inflation").alias("name"),
                    C.int_div(F.col("Betrag").cast("int"), 100).cast("int").alias("amount"))


def fct_trainings(mapped: DataFrame) -> DataFrame:
    """Training rows; missing end date falls back to the start date."""
    p = pivot_custom_table(mapped, "Weiterbildung", ["Titel", "Datum", "Typ", "Enddatum", "Kosten"])
    d = F.col("Datum").cast("date")
    return p.select("factorial_id", F.col("Titel").alias("title"), d.alias("date"), F.col("Typ").alias("type"),
                    F.coalesce(F.col("Enddatum").cast("date"), d).alias("end_date"),
                    C.int_div(F.col("Kosten").cast("int"), 100).cast("int").alias("cost"))


# ====================================================================== payments

Series = tuple[DataFrame, DataFrame]        # see relational.distinct_series
Stage = Callable[[DataFrame, str], DataFrame]


def _lazy(df: DataFrame, name: str) -> DataFrame:
    return df


def fill_contract_dates(contracts_base: DataFrame, dim_emp: DataFrame, as_of=None) -> DataFrame:
    """Contract versions with filled end dates (see ``intervals.fill_end_dates``)."""
    return I.fill_end_dates(contracts_base, dim_emp.select("factorial_id", "termination_date"), _as_of(as_of))


def salary_series(filled: DataFrame, stage: Stage = _lazy) -> Series:
    """Contracts whose months need no de-duplication, and the salary months of those listed several times
    (a contract of a person with two entries): one row per (contract, month). ``stage`` may write what both
    ``salary_payment`` and ``payment_averages`` read."""
    base = filled.select("contract_id", "employee_id", "salary_amount", "date", "end_date").withColumnRenamed("date", "_start")
    return R.distinct_series(base, "_start", "end_date", ["contract_id"], ["employee_id", "salary_amount", "_start", "end_date"],
                             stage=lambda df, name: stage(df, f"salary_{name}"))


def salary_payment(filled: DataFrame, series: Series | None = None) -> DataFrame:
    """One salary row per contract and month (drifting month steps), one row per
    (contract, month); see ``salary_series``."""
    single, several = series or salary_series(filled)
    rows = R.month_series(single, "_start", "end_date", "date", spread_by=["contract_id"]).unionByName(several)
    return rows.select(F.col("employee_id").alias("factorial_id"), "contract_id", F.col("salary_amount").alias("amount"), "date",
                       F.lit("Salary").alias("type"), F.lit("Salary").alias("name"))


def benefit_series(comp_base: DataFrame, filled: DataFrame, stage: Stage = _lazy) -> Series:
    """Compensations of a contract from their start (or the contract's) to the contract end, without zero or missing
    amounts: those whose months need no de-duplication, and the de-duplicated months of the
    others: one row per (date, taxonomy, person, amount), lowest compensation id kept. ``stage`` as for salaries."""
    f = filled.select(F.col("contract_id").alias("_cid"), "end_date", "employee_id",
                      F.col("date").alias("contract_start"))
    j = (comp_base.where(F.col("amount").isNotNull() & (F.col("amount") != 0))
         .join(f, F.col("contract_version_id") == F.col("_cid"), "inner"))
    base = j.select("id", "amount", "description", "contract_version_id", "contracts_taxonomy_id", "end_date",
                    "employee_id", F.coalesce(F.col("starts_on"), F.col("contract_start")).alias("_start"))
    return R.distinct_series(base, "_start", "end_date", ["contracts_taxonomy_id", "employee_id", "amount"],
                             ["id", "end_date", "description", "contract_version_id", "_start"],
                             stage=lambda df, name: stage(df, f"benefit_{name}"))


def benefit_payment(comp_base: DataFrame, filled: DataFrame, series: Series | None = None) -> DataFrame:
    """The months of ``benefit_series``."""
    single, several = series or benefit_series(comp_base, filled)
    rows = R.month_series(single, "_start", "end_date", "date", spread_by=["id"]).unionByName(several)
    return rows.select(F.col("employee_id").alias("factorial_id"), "amount", "date", "end_date", F.lit("Benefit").alias("type"),
                       F.col("description").alias("name"), "contract_version_id", "contracts_taxonomy_id", F.col("id").alias("compensation_id"))


def map_lunchit(lunchit: DataFrame, mapping: DataFrame) -> DataFrame:
    """Meal rows + e-mail of the person (an id with two e-mails fans out)."""
    return R.map_names(lunchit, mapping, "id", "email")


def lunchit_payment(mapped: DataFrame, active: DataFrame) -> DataFrame:
    """Meal subsidy booked in the month before the settlement month, only for
    active employees matched by e-mail, positive amounts only."""
    p = (mapped.where(F.col("abrechnungsmonat").isNotNull())
         .select("email", C.month_start(F.add_months(F.col("abrechnungsmonat"), -1)).alias("date"),
                 C.safe_add("lunchit_1_2", "lunchit_2_2").alias("zuzahlung")))
    a = active.select(F.col("email").alias("_email"), F.col("id").alias("factorial_id"))
    j = p.join(a, p["email"] == a["_email"], "inner")
    return (j.where(F.col("zuzahlung") > 0)
            .select("date", F.col("zuzahlung").alias("amount"), F.lit("Benefit").alias("type"),
                    F.lit("Lunchit").alias("name"), "factorial_id"))


def payments_union(salary: DataFrame, lunchit: DataFrame, inflation: DataFrame, benefit: DataFrame) -> DataFrame:
    """The four kinds of payment by column name, fact columns only; amounts as doubles, as the source holds them."""
    rels = {name: df.withColumn("amount", F.col("amount").cast("double"))
            for name, df in (("salary_payment", salary), ("lunchit_payment", lunchit),
                             ("inflation_payment", inflation), ("benefit_payment", benefit))}
    return R.union_relations(rels, source_col="_source_relation").select("factorial_id", "amount", "date", "type", "name")


def payment_averages(filled: DataFrame, comp_base: DataFrame, lunchit: DataFrame, inflation: DataFrame,
                     salary: Series | None = None, benefit: Series | None = None) -> DataFrame:
    """month, type, average_amount: the month's average per-person total of each type of payment, from the
    spans of contracts and compensations before any month of theirs is generated
    (``intervals.span_averages``). One row per (month, type) -- bounded by the calendar. ``salary`` and
    ``benefit``: the series of both, where they are made already."""
    cols = ["type", "factorial_id", "amount", "first_month", "last_month"]
    spans = None
    for type_, amount, (single, several) in (("Salary", "salary_amount", salary or salary_series(filled)),
                                              ("Benefit", "amount", benefit or benefit_series(comp_base, filled))):
        named = [F.lit(type_).alias("type"), F.col("employee_id").alias("factorial_id"), F.col(amount).cast("double").alias("amount")]
        ranges = R.month_span(single, "_start", "end_date").select(*named, "first_month", "last_month")
        month = C.month_start("date")
        part = ranges.unionByName(several.select(*named, month.alias("first_month"), month.alias("last_month")))
        spans = part if spans is None else spans.unionByName(part)
    for rows in (lunchit, inflation):
        month = C.month_start("date")
        spans = spans.unionByName(rows.select("type", "factorial_id", F.col("amount").cast("double").alias("amount"),
                                              month.alias("first_month"), month.alias("last_month")).select(*cols))
    return I.span_averages(spans, "type", "factorial_id", "amount")


def fct_payments(union: DataFrame, averages: DataFrame) -> DataFrame:
    """All payments (``payments_union``) with the month's average per-person total of their type
    (``payment_averages``, broadcast: bounded by the calendar). The union is read once."""
    u = union.withColumn("month", C.month_start("date"))
    j = u.join(F.broadcast(averages), ["month", "type"], "left")
    return j.select("factorial_id", "amount", "date", "type", "name", "average_amount")


# ====================================================================== dimensions

def dim_employees(terminated: DataFrame, active: DataFrame, contracts_base: DataFrame) -> DataFrame:
    """Terminated and active people by name, with their first contract start
    (people without a contract drop out)."""
    u = R.union_relations({"terminated": terminated, "active": active})
    starts = contracts_base.groupBy("employee_id").agg(F.min("starts_on").alias("start_date"))
    j = u.join(starts, u["id"] == starts["employee_id"], "inner")
    return j.select(F.col("id").alias("factorial_id"), F.col("company_identifier").alias("employee_id"), "email",
                    "first_name", "last_name", "full_name", F.col("birthday_on").alias("birthdate"), "gender",
                    F.col("terminated_on").alias("termination_date"), "start_date")


def employee_copy(dim_emp: DataFrame) -> DataFrame:
    """The report's second employee table for salary comparison: key and name."""
    return dim_emp.select("factorial_id", "full_name")


def dim_contracts(contracts_base: DataFrame, dim_emp: DataFrame, as_of=None) -> DataFrame:
    """Contract versions with hourly rate, full/part-time band, latest-version flag
    and first start in the job role."""
    t = dim_emp.select(F.col("factorial_id").alias("employee_id"), "termination_date")
    c = contracts_base.join(t, "employee_id", "left")
    c = c.withColumn("salary_hour", C.hourly_rate("salary_amount", "working_hours", "salary_frequency"))
    c = c.withColumn("working_hours_type",
                     F.when(F.col("working_hours") == 40, "Vollzeit")
                      .when(F.col("working_hours").isNotNull(), "Teilzeit").otherwise("Nicht definiert"))
    c = I.latest_flag(c, "employee_id", "effective_on", "termination_date", _as_of(as_of), "latest_contract")
    c = I.first_start_per(c, ["employee_id", "job_title"], "effective_on", "start_date_jobrole")
    return c.select(F.col("id").alias("contract_id"), F.col("employee_id").alias("factorial_id"), "job_title",
                    F.col("effective_on").alias("start_date"), F.col("ends_on").alias("end_date"),
                    "salary_amount", "salary_hour", "salary_frequency", "working_hours",
                    "working_hours_frequency", "working_hours_type", "latest_contract", "start_date_jobrole")


def dim_date_table(dim_emp: DataFrame, as_of=None) -> DataFrame:
    """Calendar from the earliest start to two years after ``as_of``.
    A single range row is exploded (bounded by the calendar)."""
    rng = dim_emp.agg(F.min("start_date").alias("s")).select("s", C.add_years(_as_of(as_of), 2).alias("e"))
    days = R.date_spine(rng, "s", "e", "date")
    return days.select("date", C.isodow("date").alias("day_of_week"), C.iso_week("date").alias("week"),
                       C.day_name("date").alias("day_of_week_name"), C.week_year("date").alias("week_year"))


def dim_name_mapping(mapping: DataFrame) -> DataFrame:
    """M28."""
    return mapping.where(F.col("troi_name").isNotNull()).select("email", "troi_name")


def dim_teams(teams: DataFrame) -> DataFrame:
    """One row per team member (null/empty member lists give no row)."""
    members = teams.select(F.col("name").alias("team_name"), F.explode("employee_ids").alias("_member"))
    return members.select("team_name", F.col("_member").cast("int").alias("factorial_id"))


# ====================================================================== facts

def fct_absences(cleaned: DataFrame) -> DataFrame:
    """Four absence types as rows; 'other' = total - named types (null-safe);
    only positive hours."""
    named_h = C.safe_add("paid_absence_hours", "sick_leave_hours", "short_working_hours")
    named_d = C.safe_add("paid_absence_mandays", "sick_leave_mandays", "short_working_mandays")
    x = cleaned.select("*", C.safe_subtract("absence_time_hours", named_h).alias("other_hours"),
                       C.safe_subtract("absence_time_mandays", named_d).alias("other_mandays"))
    u = R.unpivot_measures(
        x.withColumnRenamed("troi_name", "full_name"), ["date", "full_name"],
        {"Urlaub": ["paid_absence_hours", "paid_absence_mandays"],
         "Krank": ["sick_leave_hours", "sick_leave_mandays"],
         "Kurzarbeit": ["short_working_hours", "short_working_mandays"],
         "Anderes": ["other_hours", "other_mandays"]},
        "absence_type", ["duration_hours", "duration_mandays"])
    return u.where(F.col("duration_hours").isNotNull() & (F.col("duration_hours") > 0))


def fct_absence_length(cleaned: DataFrame) -> DataFrame:
    """Sick-leave spells in business days, without a person key."""
    isl = I.business_day_islands(cleaned, "troi_name", "date", "sick_leave_mandays")
    return isl.select("interval_start_date", "interval_end_date", "consecutive_days")


def fct_working_hours(cleaned: DataFrame, breaks: DataFrame) -> DataFrame:
    """Worked vs planned hours per person-day with the statutory break check."""
    b = breaks.select(F.col("troi_name").alias("_tn"), F.col("date").alias("_d"), "break_amount")
    j = cleaned.join(b, (cleaned["troi_name"] == b["_tn"]) & (cleaned["date"] == b["_d"]), "left")
    filt = C.safe_add("industrial_working_hours", "break_amount", "planned_amount", "wb", "nwb",
                      "absence_time_hours")
    total = C.safe_add("industrial_working_hours", "absence_time_hours")
    diff = F.round(C.safe_subtract(total, "planned_amount").cast("decimal(38,15)"), 2).cast("decimal(20,2)")
    # staged: the statutory break is computed once and read by the compliance flag
    staged = j.where(filt > 0).select(
        "date", F.col("troi_name").alias("full_name"), F.col("industrial_working_hours").alias("worked_amount"),
        "break_amount", "planned_amount", diff.alias("difference"), "wb", "nwb",
        C.legal_break_hours("industrial_working_hours").alias("legal_break_time"))
    return staged.withColumn("compliance_break_time", C.compliance("legal_break_time", "break_amount"))


def fct_pto_entitlement(mapping: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Yearly leave entitlement per tracking name with the leave days taken.

    The source's full join + non-null filter on the entitlement side is a left join;
    both mapping sheets are filtered before their self join on id.
    """
    nm = mapping.where(F.col("troi_name").isNotNull()).select(F.col("id").alias("_id"), "troi_name")
    pto = mapping.where(F.col("jahr").isNotNull()).select(
        F.col("id").alias("_id"), F.col("jahr").cast("date").alias("year"),
        F.col("urlaubsanspruch_pt").alias("amount"), F.col("resturlaub_vorjahr").alias("rest_amount_previous_year"))
    names = nm.join(pto, "_id", "inner")
    taken = (cleaned.groupBy(F.col("troi_name").alias("_tn"), C.year_start("date").alias("_y"))
             .agg(F.sum("paid_absence_mandays").alias("_taken")))
    j = names.join(taken, (names["troi_name"] == taken["_tn"]) & (names["year"] == taken["_y"]), "left")
    return j.select("year", F.col("troi_name").alias("full_name"), "amount", "rest_amount_previous_year",
                    F.coalesce(F.col("_taken"), F.lit(0.0)).alias("taken_pto"))


def fct_mood_survey(answers: DataFrame) -> DataFrame:
    """Rating digit and whether any feedback text exists."""
    return answers.select("date", C.rating_digit("rating").alias("rating"), "feedback", "feedback_bad_rating",
                          F.when(F.col("feedback").isNull() & F.col("feedback_bad_rating").isNull(), 0)
                           .otherwise(1).alias("feedback_exists"))
