"""Registered queries: every mart / operator run on the driver tables through the
adapters, with its oracle SQL (``plans/oracle.py``) under the same key."""
from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import measures as MS
from ..operators import quality as Q
from ..operators import relational as R
from ..session import materialise
from ..sources import readers as S
from ..streaming import anonymise as E
from ..streaming import ingest as IN
from . import adapters as A
from . import build as B
from . import checks as K
from . import marts as M
from . import oracle as O


class Lineage:
    """Lazily built models for one (session, data folder); each attribute is a
    DataFrame plan, nothing runs until an action, but for the series of salaries and benefits and
    what is made from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.run = spark, sf_dir, uuid.uuid4().hex

    def once(self, df: DataFrame, name: str) -> DataFrame:
        """*Action*: what several parts of a query read is written once."""
        return materialise(df, name, self.run)

    def t(self, name: str) -> DataFrame:
        return A.table(self.spark, self.sf_dir, name)

    # sources
    @cached_property
    def employees_src(self): return A.employees(self.t("customer"))
    @cached_property
    def active(self): return M.active_employees(self.employees_src)
    @cached_property
    def terminated(self): return M.terminated_employees(self.employees_src)
    @cached_property
    def contracts_base(self): return M.base_contracts(A.contracts(self.t("orders")))
    @cached_property
    def dim_employees(self):
        return M.dim_employees(self.terminated, self.active, self.contracts_base)
    @cached_property
    def filled(self):
        return M.fill_contract_dates(self.contracts_base, self.dim_employees, F.lit(A.AS_OF_ORDERS).cast("date"))
    @cached_property
    def filled_once(self): return self.once(self.filled, "fill_contract_dates")
    @cached_property
    def salary_series(self): return M.salary_series(self.filled_once, self.once)
    @cached_property
    def salary(self): return M.salary_payment(self.filled_once, self.salary_series)
    @cached_property
    def comp_base(self): return M.base_compensation(A.compensation(self.t("lineitem")))
    @cached_property
    def benefit_series(self): return M.benefit_series(self.comp_base, self.filled_once, self.once)
    @cached_property
    def benefit(self): return M.benefit_payment(self.comp_base, self.filled_once, self.benefit_series)
    @cached_property
    def mapping(self): return M.name_mapping_pto(A.name_mapping(self.t("customer")))
    @cached_property
    def lunchit(self): return M.processed_lunchit(A.lunchit_export(self.t("lineitem")))
    @cached_property
    def lunchit_mapped(self): return M.map_lunchit(self.lunchit, self.mapping)
    @cached_property
    def lunchit_pay(self): return M.lunchit_payment(self.lunchit_mapped, self.active)
    @cached_property
    def unpacked(self): return M.unpack_custom_values(M.base_custom_tables_val(A.custom_values(self.t("part"))))
    @cached_property
    def mapped_custom(self):
        return M.label_custom_values(self.unpacked, M.base_custom_tables(A.custom_tables(self.spark)),
                                     M.base_custom_tables_col(A.custom_columns(self.spark)))
    @cached_property
    def inflation(self): return M.inflation_payment(self.mapped_custom)
    @cached_property
    def payments(self):
        lunchit, inflation = self.once(self.lunchit_pay, "lunchit_payment"), self.once(self.inflation, "inflation_payment")
        averages = self.once(M.payment_averages(self.filled_once, self.comp_base, lunchit, inflation, self.salary_series, self.benefit_series), "payment_averages")
        return M.fct_payments(M.payments_union(self.salary, lunchit, inflation, self.benefit), averages)
    @cached_property
    def troi(self): return M.processed_troi(A.troi_export(self.t("events")))
    @cached_property
    def troi_mapped(self): return M.map_names_troi(self.troi, self.mapping)
    @cached_property
    def iwh(self): return M.industrial_working_hours(self.troi_mapped)
    @cached_property
    def breaks(self): return M.break_hours(self.iwh)
    @cached_property
    def cleaned(self): return M.cleaned_absences(self.iwh)

    def staged_models(self) -> dict[str, DataFrame]:
        """*Action*: the production build over the driver tables, shared models and report tables
        written once (``plans/build.py``)."""
        src = {"employees": self.employees_src, "contracts": A.contracts(self.t("orders")),
               "compensation": A.compensation(self.t("lineitem")), "teams": A.teams(self.t("customer")),
               "custom_tables": A.custom_tables(self.spark), "custom_tables_col": A.custom_columns(self.spark),
               "custom_tables_val": A.custom_values(self.t("part")), "mood_survey_answers": A.mood_answers(self.t("orders")),
               "name_mapping": A.name_mapping(self.t("customer")), "processed_lunchit": A.lunchit_export(self.t("lineitem")),
               "processed_troi": A.troi_export(self.t("events"))}
        run = uuid.uuid4().hex
        return B.build_models(src, F.lit(A.AS_OF_ORDERS).cast("date"), lambda df, name: materialise(df, name, run))


def _l(spark, sf_dir) -> Lineage:
    return Lineage(spark, sf_dir)


# ------------------------------------------------------------------ query functions

def q_contract_end_dates(spark, d): return _l(spark, d).filled
def q_salary_months(spark, d): return _l(spark, d).salary
def q_salary_months_repeated(spark, d):
    """Salary months where every seventh contract is listed again with another amount and a later end, every
    fourteenth a third time for another person: one row per (contract, month) of rows that really repeat."""
    lin = _l(spark, d)
    once = lin.filled_once
    again = once.where("contract_id % 7 = 0").withColumns({"salary_amount": F.col("salary_amount") + 100, "end_date": F.add_months("end_date", 3)})
    other = once.where("contract_id % 14 = 0").withColumn("employee_id", F.col("employee_id") - 1)
    filled = once.unionByName(again).unionByName(other)
    return M.salary_payment(filled, M.salary_series(filled, lin.once))


def q_benefit_months(spark, d):
    """Only the marked rows are read twice here; the de-duplicated ones stay in the plan."""
    lin = _l(spark, d)
    series = M.benefit_series(lin.comp_base, lin.filled_once, lambda df, name: lin.once(df, name) if name == "benefit_tagged" else df)
    return M.benefit_payment(lin.comp_base, lin.filled_once, series)


def q_payments_fact(spark, d): return _l(spark, d).payments
def q_employees_dim(spark, d): return _l(spark, d).dim_employees


def q_contracts_dim(spark, d):
    lin = _l(spark, d)
    return M.dim_contracts(lin.contracts_base, lin.dim_employees, F.lit(A.AS_OF_ORDERS).cast("date"))


def q_date_dim(spark, d):
    return M.dim_date_table(_l(spark, d).dim_employees, F.lit(A.AS_OF_ORDERS).cast("date"))


def q_date_dim_previous(spark, d):
    return MS.previous_period(q_date_dim(spark, d).select("date", "week_year"))


def q_union_relations(spark, d):
    lin = _l(spark, d)
    cust = lin.t("customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                    F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("mktsegment"))
    supp = lin.t("supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                                    F.col("s_acctbal").alias("acctbal"))
    return R.union_relations({"customer": cust, "supplier": supp}, source_col="_source_relation")


def q_teams_dim(spark, d): return M.dim_teams(M.base_teams(A.teams(_l(spark, d).t("customer"))))
def q_name_mapping_dim(spark, d): return M.dim_name_mapping(_l(spark, d).mapping)
def q_tracking_names(spark, d): return _l(spark, d).troi_mapped
def q_meal_export_clean(spark, d): return _l(spark, d).lunchit
def q_tracking_export_clean(spark, d): return _l(spark, d).troi
def q_meal_names(spark, d): return _l(spark, d).lunchit_mapped
def q_industrial_hours(spark, d): return _l(spark, d).iwh
def q_break_hours(spark, d): return _l(spark, d).breaks
def q_absence_pairs(spark, d): return _l(spark, d).cleaned
def q_absences_unpivot(spark, d): return M.fct_absences(_l(spark, d).cleaned)
def q_absence_islands(spark, d): return M.fct_absence_length(_l(spark, d).cleaned)


def q_working_hours(spark, d):
    lin = _l(spark, d)
    return M.fct_working_hours(lin.cleaned, lin.breaks)


def q_pto_entitlement(spark, d):
    lin = _l(spark, d)
    return M.fct_pto_entitlement(lin.mapping, lin.cleaned)


def q_mood_survey(spark, d):
    return M.fct_mood_survey(M.mood_survey_answers(A.mood_answers(_l(spark, d).t("orders"))))


def q_dynamic_map_unpack(spark, d):
    recs = A.event_records(_l(spark, d).t("events"))
    m = S.dynamic_columns_to_map(recs, "raw", ["id", "employee_id"], key_types={"id": "bigint", "employee_id": "bigint"})
    return R.unpack_map(m, "col_val", "attribute", "val")


def q_custom_values_unpacked(spark, d): return _l(spark, d).unpacked
def q_custom_values_labelled(spark, d): return _l(spark, d).mapped_custom


def q_custom_pivot(spark, d):
    lin = _l(spark, d)
    return R.pivot_no_agg(lin.mapped_custom, ["factorial_id", "id"], "col_name", "val")


def q_trainings(spark, d):
    lin = _l(spark, d)
    return M.fct_trainings(lin.mapped_custom)


def q_inflation_payment(spark, d): return _l(spark, d).inflation
def q_meal_payment(spark, d): return _l(spark, d).lunchit_pay



def _lists_as_text(df: DataFrame) -> DataFrame:
    """Id lists as comma-separated text, every other column as it is."""
    return df.select(*[F.array_join(c, ",").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])


def q_active_employees(spark, d):
    lin = _l(spark, d)
    return _lists_as_text(M.active_employees(S.record_filter(lin.employees_src, F.col("terminated_on").isNull())))


def q_contracts_base(spark, d): return _lists_as_text(_l(spark, d).contracts_base)
def q_teams_base(spark, d): return _lists_as_text(M.base_teams(A.teams(_l(spark, d).t("customer"))))
def q_employee_copy(spark, d): return M.employee_copy(_l(spark, d).dim_employees)


def q_custom_values_raw(spark, d):
    """Landed value records (text with open attribute keys) -> map -> rows."""
    raw = A.custom_value_records(_l(spark, d).t("part"))
    return M.unpack_custom_values(M.base_custom_tables_val(S.custom_value_records(raw, "raw")))


def q_record_extract(spark, d):
    """Response bodies (one JSON array for each nation and hundred keys) -> records."""
    c = _l(spark, d).t("customer")
    body = c.groupBy("c_nationkey", F.floor(F.col("c_custkey") / 100)).agg(
        F.to_json(F.collect_list(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))).alias("body"))
    return S.extract_records(body, "body", T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]))


def q_parent_slices(spark, d):
    return S.parent_keys(A.teams(_l(spark, d).t("customer")), "id", "team_id")


def q_terminated_employees(spark, d): return _l(spark, d).terminated


def q_compensation_keys(spark, d):
    lin = _l(spark, d)
    ids = (lin.t("lineitem").groupBy("l_orderkey")
           .agg(F.collect_list((F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint")).alias("compensation_ids")))
    contracts = A.contracts(lin.t("orders")).drop("compensation_ids")
    withids = contracts.join(ids, contracts["id"] == ids["l_orderkey"], "left")
    return S.array_parent_keys(withids, "compensation_ids", "compensation_id", parent_key="id")


def q_first_per_key(spark, d):
    li = _l(spark, d).t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    return R.first_per_key(li, ["l_orderkey"], order=["l_linenumber"])


def _raw_export(lin: Lineage) -> DataFrame:
    """A time-tracking export before anonymisation: one header row per order carrying
    the person's name (an unknown 'Last, First' name for every 13th), then its lines as
    day rows, some of them a note that holds another person's name; row order (k, line)."""
    o = lin.t("orders").select(
        F.col("o_orderkey").alias("k"), F.lit(0).alias("line"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit("Unbekannt, Person"))
         .otherwise(F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))).alias("Monat"),
        F.lit("").alias("Arbeitszeit"))
    li = lin.t("lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"),
        F.when((F.col("l_linenumber") == 2) & (F.col("l_orderkey") % 5 == 0),
               F.concat(F.lit("Vertretung Customer#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"), F.lit(" (halbtags)")))
         .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("Monat"), F.lit("08:00").alias("Arbeitszeit"))
    return o.unionByName(li)


def q_export_anonymise(spark, d):
    lin = _l(spark, d)
    # a name with two entries has two ids here: its rows fan out and are filled in the order of the ids
    other = F.when(F.col("email").startswith("alt"), F.col("id") + 1_000_000).otherwise(F.col("id"))
    mapping = lin.mapping.where(F.col("troi_name").isNotNull()).select(other.cast("string").alias("id"), "troi_name", "email")
    merged = E.map_ids(_raw_export(lin), mapping, "Monat", "troi_name")
    masked = E.mask_values(merged, "Monat", "troi_name")
    ided = E.default_id(masked, "Monat").withColumn("fan", F.coalesce("id", F.lit("")))
    filled = R.fill_down(ided, "id", ["k", "line", "fan"])
    return E.drop_identifiers(filled, ["fan"])


def q_fill_down(spark, d):
    lin = _l(spark, d)
    o = lin.t("orders").select(F.col("o_orderkey").alias("k"), F.lit(0).alias("line"),
                               F.col("o_custkey").alias("v"))
    li = lin.t("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"),
                                  F.lit(None).cast("bigint").alias("v"))
    return R.fill_down(o.unionByName(li), "v", ["k", "line"])


def q_watermark_slice(spark, d):
    """Events as export rows of weekly files: a row is kept when it lies strictly
    between the previous file's date + 1 day and its own file's date + 1 day."""
    ev = _l(spark, d).t("events")
    week = F.date_trunc("week", F.col("ts")).cast("date")
    f = ev.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Monat"),
                  F.concat(F.lit("raw/troi/export_"), F.date_format(F.date_add(week, 6), "yyyy-MM-dd"),
                           F.lit(".csv")).alias("file"),
                  F.concat(F.lit("raw/troi/export_"), F.date_format(F.date_sub(week, 1), "yyyy-MM-dd"),
                           F.lit(".csv")).alias("prev_file"))
    lo, hi = E.date_from_name(F.col("prev_file")), E.date_from_name(F.col("file"))
    return E.slice_between(f, "Monat", lo, hi)


def q_export_increment(spark, d):
    """Cumulative weekly files (a week and the one before it): the processed rows are those
    after the previous file's date, whichever run that file came with."""
    ev = _l(spark, d).t("events")
    name = lambda day: F.concat(F.lit("raw/troi/export_"), F.date_format(day, "yyyy-MM-dd"), F.lit(".csv"))
    week = F.date_trunc("week", F.col("ts")).cast("date")
    rows = ev.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Monat"), F.explode(F.array(
        name(F.date_add(week, 6)), name(F.date_add(week, 13)))).alias("file"))
    files = ev.select(name(F.date_add(week, 6)).alias("ingest_file")).distinct()
    first = files.agg(F.min("ingest_file").alias("ingest_file")).withColumn("_prev", F.lit(None).cast("string"))
    # a run takes one new file; the one before it is the last file of the run before
    later = IN.file_bounds(files, None).where(F.col("_prev").isNotNull())
    bounds = first.unionByName(later).withColumnRenamed("ingest_file", "file")
    out = E.slice_between(rows.join(bounds, "file"), "Monat", F.coalesce(E.date_from_name(F.col("_prev")), F.lit("")),
                          E.date_from_name(F.col("file")))
    return out.select("event_id", "Monat", "file")


def _contract_checks(lin: Lineage):
    dc = M.dim_contracts(lin.contracts_base, lin.dim_employees, F.lit(A.AS_OF_ORDERS).cast("date"))
    return dc, Q.TableChecks(
        not_null=["contract_id", "factorial_id", "job_title", "start_date", "start_date_jobrole",
                  "working_hours_type", "latest_contract", "salary_hour"],
        unique=["contract_id", "job_title"],
        accepted={"working_hours_type": ["Vollzeit", "Teilzeit", "Nicht definiert"], "latest_contract": [1, 0],
                  "job_title": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]},
        pair_ge=[("start_date", "start_date_jobrole"), ("start_date_jobrole", "end_date")])


def q_dq_contracts_dim(spark, d):
    lin = _l(spark, d)
    dc, checks = _contract_checks(lin)
    return Q.run_checks({"dim_contracts": (dc, checks)})


def q_dq_foreign_keys(spark, d):
    """All declared references between the report tables."""
    return Q.run_checks(K.reference_suite(_l(spark, d).staged_models()))


def q_employee_measures(spark, d):
    de = _l(spark, d).dim_employees
    a = F.lit(A.AS_OF_ORDERS).cast("date")
    return de.select(
        "factorial_id", "full_name",
        MS.age("birthdate", a).alias("age"), MS.age_upcoming("birthdate", a).alias("age_upcoming"),
        MS.tenure_years("start_date", "termination_date", a).alias("company_affiliation_years"),
        MS.tenure_text("start_date", "termination_date", a).alias("company_affiliation_years_months"),
        (MS.tenure_years("start_date", "termination_date", a) + 1).alias("company_affiliation_years_upcoming"),
        MS.next_anniversary("start_date", a).alias("anniversary"),
        MS.birthday_in_year("birthdate", F.year(a)).alias("birthday_this_year"),
        MS.next_birthday("birthdate", a).alias("next_birthday"))


# model -> its CTE
_SUITE_MODELS = {
    "factorial_active_employees": "active",
    "factorial_compensation": "comp_base",
    "factorial_contracts": "contracts_base",
    "factorial_custom_tables": "custom_tables",
    "factorial_custom_tables_col": "custom_cols",
    "factorial_custom_tables_val": "custom_vals_model",
    "factorial_teams": "teams_src",
    "factorial_terminated_employees": "terminated",
    "mood_survey_answers": "mood_answers",
    "processed_lunchit": "lunchit",
    "processed_troi": "troi",
    "factorial_map_custom_tables": "mapped_custom",
    "factorial_unpack_custom_table_val": "unpacked",
    "map_names_troi": "troi_mapped",
    "industrial_working_hours": "iwh",
    "industrial_break_time": "breaks",
    "cleaned_absences": "cleaned",
    "fill_contract_dates": "filled",
    "salary_payment": "salary",
    "benefit_payment": "benefit",
    "inflation_payment": "inflation",
    "lunchit_payment": "lunchit_pay",
    "dim_contracts": "contracts_dim",
    "dim_date_table": "date_dim",
    "dim_employees": "dim_employees",
    "dim_name_mapping": "name_mapping_dim",
    "dim_teams": "teams_dim",
    "fct_absence_length": "islands",
    "fct_absences": "absences",
    "fct_mood_survey": "mood",
    "fct_payments": "payments",
    "fct_pto_entitlement": "pto",
    "fct_trainings": "trainings",
    "fct_working_hours": "working",
}


def q_dq_declared_suite(spark, d):
    """All declared model tests over the marts built from the driver tables."""
    models = _l(spark, d).staged_models()
    return Q.run_checks(K.declared_suite({name: models[name] for name in _SUITE_MODELS}))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "contract_end_dates": q_contract_end_dates,
    "salary_months": q_salary_months,
    "salary_months_repeated": q_salary_months_repeated,
    "benefit_months": q_benefit_months,
    "payments_fact": q_payments_fact,
    "union_relations": q_union_relations,
    "employees_dim": q_employees_dim,
    "contracts_dim": q_contracts_dim,
    "date_dim": q_date_dim,
    "date_dim_previous": q_date_dim_previous,
    "teams_dim": q_teams_dim,
    "name_mapping_dim": q_name_mapping_dim,
    "tracking_names": q_tracking_names,
    "meal_export_clean": q_meal_export_clean,
    "tracking_export_clean": q_tracking_export_clean,
    "meal_names": q_meal_names,
    "industrial_hours": q_industrial_hours,
    "break_hours": q_break_hours,
    "absence_pairs": q_absence_pairs,
    "absences_unpivot": q_absences_unpivot,
    "absence_islands": q_absence_islands,
    "working_hours": q_working_hours,
    "pto_entitlement": q_pto_entitlement,
    "mood_survey": q_mood_survey,
    "dynamic_map_unpack": q_dynamic_map_unpack,
    "custom_values_unpacked": q_custom_values_unpacked,
    "custom_values_labelled": q_custom_values_labelled,
    "custom_pivot": q_custom_pivot,
    "trainings": q_trainings,
    "inflation_payment": q_inflation_payment,
    "meal_payment": q_meal_payment,
    "active_employees": q_active_employees,
    "contracts_base": q_contracts_base,
    "teams_base": q_teams_base,
    "employee_copy": q_employee_copy,
    "custom_values_raw": q_custom_values_raw,
    "record_extract": q_record_extract,
    "parent_slices": q_parent_slices,
    "export_increment": q_export_increment,
    "terminated_employees": q_terminated_employees,
    "compensation_keys": q_compensation_keys,
    "first_per_key": q_first_per_key,
    "export_anonymise": q_export_anonymise,
    "fill_down": q_fill_down,
    "watermark_slice": q_watermark_slice,
    "dq_contracts_dim": q_dq_contracts_dim,
    "dq_foreign_keys": q_dq_foreign_keys,
    "employee_measures": q_employee_measures,
    "dq_declared_suite": q_dq_declared_suite,
}


# ------------------------------------------------------------------ oracle SQL (DuckDB)

def _salary_hour_sql() -> str:
    num, den = "(3 * salary_amount)", "(13 * working_hours)"
    return (f"case when salary_frequency = 'monthly' then cast(sign({num}) * sign({den}) * "
            f"((200 * abs({num}) + abs({den})) // (2 * abs({den}))) / 100.0 as decimal(20,2)) "
            f"when salary_frequency = 'hourly' then cast(salary_amount as decimal(20,2)) end")


_CONTRACTS_DIM = f"""
select c.id as contract_id, c.employee_id as factorial_id, c.job_title, c.effective_on as start_date,
       c.ends_on as end_date, c.salary_amount, {_salary_hour_sql()} as salary_hour, c.salary_frequency,
       c.working_hours, c.working_hours_frequency,
       case when c.working_hours = 40 then 'Vollzeit' when c.working_hours is not null then 'Teilzeit'
            else 'Nicht definiert' end as working_hours_type,
       case when c.termination_date is not null then 0
            when c.effective_on = max(case when c.effective_on <= {O.AS_OF_ORDERS} then c.effective_on end)
                                  over (partition by c.employee_id) then 1 else 0 end as latest_contract,
       j.start_date_jobrole
from (select cb.*, e.termination_date from contracts_base cb
      left join dim_employees e on cb.employee_id = e.factorial_id) c
join (select employee_id, job_title, min(effective_on) as start_date_jobrole from contracts_base
      group by employee_id, job_title) j
  on c.employee_id = j.employee_id and c.job_title = j.job_title"""

O.cte("contracts_dim", _CONTRACTS_DIM, "contracts_base", "dim_employees")

O.cte("date_dim", f"""
select cast(d as date) as date, cast(isodow(d) as integer) as day_of_week, cast(week(d) as integer) as week,
       rpad(dayname(d), 9, ' ') as day_of_week_name, strftime(d, '%V') || cast(year(d) as varchar) as week_year
from (select unnest(generate_series(cast(min(start_date) as timestamp),
                                    cast({O.AS_OF_ORDERS} + interval 2 year as timestamp), interval 1 day)) as d
      from dim_employees) x""", "dim_employees")

O.cte("raw_export", """
select o_orderkey as k, 0 as line,
       case when o_orderkey % 13 = 0 then 'Unbekannt, Person' else 'Customer#' || lpad(cast(o_custkey as varchar), 9, '0') end
           as Monat, '' as Arbeitszeit
from orders
union all
select l_orderkey, l_linenumber,
       case when l_linenumber = 2 and l_orderkey % 5 = 0
            then 'Vertretung Customer#' || lpad(cast(l_suppkey as varchar), 9, '0') || ' (halbtags)'
            else strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') end, '08:00' from lineitem""")

O.cte("export_masked", r"""
with m as (select cast(case when starts_with(email, 'alt') then id + 1000000 else id end as varchar) as id, troi_name
           from mapping where troi_name is not null),
     found as (select distinct r.Monat as name from raw_export r where r.Monat in (select troi_name from m))
select k, line, Monat, Arbeitszeit, coalesce(mid, '') as fan,
       case when (mid is null or mid = '') and contains(Monat, ',') then '0' else mid end as id
from (select r.k, r.line, r.Arbeitszeit, m.id as mid,
             case when regexp_extract(r.Monat, 'Customer#\d+') in (select name from found)
                  then replace(r.Monat, regexp_extract(r.Monat, 'Customer#\d+'), '') else r.Monat end as Monat
      from raw_export r left join m on r.Monat = m.troi_name) x""", "raw_export", "mapping")

_CHECKS_CONTRACTS = """
select 'dim_contracts' as "table", "check", "column", cast(violations as bigint) as violations from (
  select 'not_null' as "check", 'contract_id' as "column", count_if(contract_id is null) as violations from contracts_dim
  union all select 'not_null', 'factorial_id', count_if(factorial_id is null) from contracts_dim
  union all select 'not_null', 'job_title', count_if(job_title is null) from contracts_dim
  union all select 'not_null', 'start_date', count_if(start_date is null) from contracts_dim
  union all select 'not_null', 'start_date_jobrole', count_if(start_date_jobrole is null) from contracts_dim
  union all select 'not_null', 'working_hours_type', count_if(working_hours_type is null) from contracts_dim
  union all select 'not_null', 'latest_contract', count_if(latest_contract is null) from contracts_dim
  union all select 'not_null', 'salary_hour', count_if(salary_hour is null) from contracts_dim
  union all select 'accepted_values', 'working_hours_type',
                   count_if(not (working_hours_type in ('Vollzeit', 'Teilzeit', 'Nicht definiert'))) from contracts_dim
  union all select 'accepted_values', 'latest_contract', count_if(not (latest_contract in (1, 0))) from contracts_dim
  union all select 'accepted_values', 'job_title',
                   count_if(not (job_title in ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED'))) from contracts_dim
  union all select 'pair_ge', 'start_date>=start_date_jobrole', count_if(not (start_date >= start_date_jobrole))
            from contracts_dim
  union all select 'pair_ge', 'start_date_jobrole>=end_date', count_if(not (start_date_jobrole >= end_date))
            from contracts_dim
  union all select 'unique', 'contract_id', count(*) from (select contract_id from contracts_dim
            where contract_id is not null group by contract_id having count(*) > 1) u1
  union all select 'unique', 'job_title', count(*) from (select job_title from contracts_dim
            where job_title is not null group by job_title having count(*) > 1) u2) s"""

# report table -> its CTE
_REPORT_CTES = {
    "dim_contracts": "contracts_dim", "dim_employees": "dim_employees", "_dim_employees": "dim_employees",
    "dim_date_table": "date_dim", "dim_date_table_previous": "date_dim", "dim_teams": "teams_dim", "dim_name_mapping": "name_mapping_dim",
    "fct_payments": "payments", "fct_trainings": "trainings", "fct_mood_survey": "mood", "fct_working_hours": "working",
    "fct_absences": "absences", "fct_absence_length": "islands", "fct_pto_entitlement": "pto"}

_MEASURES = f"""
select factorial_id, full_name,
       cast(year(a) - year(birthdate) - case when month(a) * 100 + day(a) < month(birthdate) * 100 + day(birthdate)
            then 1 else 0 end as integer) as age,
       cast(year(a) - year(birthdate) - case when month(a) * 100 + day(a) < month(birthdate) * 100 + day(birthdate)
            then 1 else 0 end as integer) + 1 as age_upcoming,
       cast(year(t) - year(start_date) - case when month(t) * 100 + day(t) < month(start_date) * 100 + day(start_date)
            then 1 else 0 end as integer) as company_affiliation_years,
       printf('%d Jahre, %d Monate', cast(floor(m / 12) as integer), cast(m % 12 as integer))
           as company_affiliation_years_months,
       cast(year(t) - year(start_date) - case when month(t) * 100 + day(t) < month(start_date) * 100 + day(start_date)
            then 1 else 0 end as integer) + 1 as company_affiliation_years_upcoming,
       case when cast(start_date + to_months(12 * greatest(year(a) - year(start_date), 0)) as date) >= a
            then cast(start_date + to_months(12 * greatest(year(a) - year(start_date), 0)) as date)
            else cast(start_date + to_months(12 * (greatest(year(a) - year(start_date), 0) + 1)) as date) end
           as anniversary,
       cast(birthdate + to_months(12 * (year(a) - year(birthdate))) as date) as birthday_this_year,
       case when cast(birthdate + to_months(12 * greatest(year(a) - year(birthdate), 0)) as date) >= a
            then cast(birthdate + to_months(12 * greatest(year(a) - year(birthdate), 0)) as date)
            else cast(birthdate + to_months(12 * (greatest(year(a) - year(birthdate), 0) + 1)) as date) end
           as next_birthday
from (select *, {O.AS_OF_ORDERS} as a, coalesce(termination_date, {O.AS_OF_ORDERS}) as t,
             cast((year(coalesce(termination_date, {O.AS_OF_ORDERS})) - year(start_date)) * 12
                  + month(coalesce(termination_date, {O.AS_OF_ORDERS})) - month(start_date)
                  - case when day(coalesce(termination_date, {O.AS_OF_ORDERS})) < day(start_date) then 1 else 0 end
                  as integer) as m
      from dim_employees) x"""

_DYN = r"""
select id, employee_id, k as attribute, json_extract_string(raw, '$."' || k || '"') as val
from (select cast(json_extract_string(raw, '$.id') as bigint) as id,
             cast(json_extract_string(raw, '$.employee_id') as bigint) as employee_id, raw,
             unnest(json_keys(raw)) as k
      from (select '{"id": ' || cast(event_id as varchar) || ', "employee_id": ' || cast(user_id as varchar) || ', '
                   || substr(props, 2, length(props) - 2) || ', "' || event_type || '": "'
                   || cast(cast(value as decimal(12,2)) as varchar) || '"}' as raw
            from events) e) x
where k not in ('id', 'employee_id')"""

ORACLE: dict[str, str] = {
    "contract_end_dates": O.sql("select * from filled", "filled"),
    "salary_months": O.sql("select * from salary", "salary"),
    "salary_months_repeated": O.sql("""
select employee_id as factorial_id, contract_id, salary_amount as amount, d as date, 'Salary' as type, 'Salary' as name
from (select *, row_number() over (partition by contract_id, d order by employee_id, salary_amount, date, end_date) as rn
      from (select contract_id, employee_id, salary_amount, date, end_date,
                   cast(unnest(generate_series(cast(date as timestamp), cast(end_date as timestamp), interval 1 month)) as date) as d
            from (select contract_id, employee_id, salary_amount, date, end_date from filled
                  union all select contract_id, employee_id, salary_amount + 100, date, cast(end_date + interval 3 month as date) from filled where contract_id % 7 = 0
                  union all select contract_id, employee_id - 1, salary_amount, date, end_date from filled where contract_id % 14 = 0) a) b) c
where rn = 1""", "filled"),
    "benefit_months": O.sql("select * from benefit", "benefit"),
    "payments_fact": O.sql("select * from payments", "payments"),
    "union_relations": """
select 'customer' as _source_relation, c_custkey as key, c_name as name, c_acctbal as acctbal,
       c_mktsegment as mktsegment from customer
union all
select 'supplier', s_suppkey, s_name, s_acctbal, null from supplier""",
    "employees_dim": O.sql("select * from dim_employees", "dim_employees"),
    "contracts_dim": O.sql("select * from contracts_dim", "contracts_dim"),
    "date_dim": O.sql("select * from date_dim", "date_dim"),
    "date_dim_previous": O.sql("select date, week_year, cast(date - interval 12 month as date) as previous_date "
                               "from date_dim", "date_dim"),
    "teams_dim": """
select 'Team ' || cast(c_nationkey as varchar) || '-' || cast(c_custkey // 100 as varchar) as team_name,
       cast(c_custkey as integer) as factorial_id
from customer""",
    "name_mapping_dim": O.sql("select email, troi_name from mapping where troi_name is not null", "mapping"),
    "tracking_names": O.sql("select * from troi_mapped", "troi_mapped"),
    "meal_export_clean": O.sql("select * from lunchit", "lunchit"),
    "tracking_export_clean": O.sql("select * from troi", "troi"),
    "meal_names": O.sql("select * from lunchit_mapped", "lunchit_mapped"),
    "industrial_hours": O.sql("select * from iwh", "iwh"),
    "break_hours": O.sql("select * from breaks", "breaks"),
    "absence_pairs": O.sql("select * from cleaned", "cleaned"),
    "absences_unpivot": O.sql("select * from absences", "absences"),
    "absence_islands": O.sql("select * from islands", "islands"),
    "working_hours": O.sql("select * from working", "working"),
    "pto_entitlement": O.sql("select * from pto", "pto"),
    "mood_survey": """
select cast(strftime(o_orderdate, '%Y-%m-%d') as date) as date, cast(left(o_orderpriority, 1) as integer) as rating,
       case when o_orderkey % 3 = 0 then o_orderstatus end as feedback,
       case when o_orderkey % 5 = 0 then 'zu laut' end as feedback_bad_rating,
       case when (case when o_orderkey % 3 = 0 then o_orderstatus end) is null and o_orderkey % 5 <> 0 then 0
            else 1 end as feedback_exists
from orders""",
    "dynamic_map_unpack": _DYN,
    "custom_values_unpacked": O.sql("select * from unpacked", "unpacked"),
    "custom_values_labelled": O.sql("select * from mapped_custom", "mapped_custom"),
    "custom_pivot": O.sql("select * from pivot_all", "pivot_all"),
    "trainings": O.sql("select * from trainings", "trainings"),
    "inflation_payment": O.sql("select * from inflation", "inflation"),
    "meal_payment": O.sql("select * from lunchit_pay", "lunchit_pay"),
    "active_employees": O.sql("select * from active_full", "active_full"),
    "contracts_base": O.sql("select * from contracts_full", "contracts_full"),
    "teams_base": O.sql("select * from teams_full", "teams_full"),
    "employee_copy": O.sql("select factorial_id, full_name from dim_employees", "dim_employees"),
    "custom_values_raw": O.sql("select * from unpacked", "unpacked"),
    "record_extract": "select c_custkey as id, c_name as name from customer",
    "parent_slices": O.sql("select id as team_id from teams_src", "teams_src"),
    "export_increment": """
with w as (select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as Monat, cast(date_trunc('week', ts) as date) as wk from events),
     f as (select wk, lag(wk) over (order by wk) as prev from (select distinct wk from w) x),
     r as (select event_id, Monat, wk from w union all select event_id, Monat, wk + 7 from w)
select r.event_id, r.Monat, 'raw/troi/export_' || strftime(f.wk + 6, '%Y-%m-%d') || '.csv' as file
from r join f on r.wk = f.wk
where r.Monat < strftime(f.wk + 7, '%Y-%m-%d') || ' 00:00:00'
  and r.Monat > coalesce(strftime(f.prev + 7, '%Y-%m-%d') || ' 00:00:00', '')""",
    "terminated_employees": O.sql("select * from terminated", "terminated"),
    "compensation_keys": """
select o_orderkey as id, l_orderkey * 8 + l_linenumber as compensation_id
from orders join lineitem on l_orderkey = o_orderkey""",
    "first_per_key": """
select l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate
from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_quantity, l_shipdate) as rn from lineitem) x
where rn = 1""",
    "export_anonymise": O.sql("""
select k, line, Monat, Arbeitszeit,
       last_value(id ignore nulls) over (order by k, line, fan rows between unbounded preceding and current row) as id
from export_masked""", "export_masked"),
    "fill_down": """
select k, line, last_value(v ignore nulls) over (order by k, line rows between unbounded preceding and current row) as v
from (select o_orderkey as k, 0 as line, o_custkey as v from orders
      union all select l_orderkey, l_linenumber, null::bigint from lineitem) x""",
    "watermark_slice": """
select event_id, Monat, file, prev_file from (
  select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as Monat,
         'raw/troi/export_' || strftime(cast(date_trunc('week', ts) as date) + 6, '%Y-%m-%d') || '.csv' as file,
         'raw/troi/export_' || strftime(cast(date_trunc('week', ts) as date) - 1, '%Y-%m-%d') || '.csv' as prev_file,
         strftime(cast(date_trunc('week', ts) as date) + 7, '%Y-%m-%d') || ' 00:00:00' as hi,
         strftime(cast(date_trunc('week', ts) as date), '%Y-%m-%d') || ' 00:00:00' as lo
  from events) x
where Monat > lo and Monat < hi""",
    "dq_contracts_dim": O.sql(_CHECKS_CONTRACTS, "contracts_dim"),
    "dq_foreign_keys": O.sql("select \"table\", \"check\", \"column\", cast(violations as bigint) as violations from ("
                             + K.reference_sql(_REPORT_CTES) + ") s", *sorted(set(_REPORT_CTES.values()))),
    "employee_measures": O.sql(_MEASURES, "dim_employees"),
    "dq_declared_suite": O.sql(K.declared_sql(_SUITE_MODELS), *_SUITE_MODELS.values()),
}
