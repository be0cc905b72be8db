"""Production build of the report tables from source DataFrames.

base models -> shared intermediates written to shared storage (lineage cut, reused by
several marts, survives executor loss) -> dimensions and facts, written as a new version of the report
-> declared data tests on these very tables as a gate -> one pointer moved to the version.

Inputs are keyed by source name: ``employees, contracts, compensation, teams,
custom_tables, custom_tables_col, custom_tables_val, mood_survey_answers,
name_mapping, processed_lunchit, processed_troi``.
"""
from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..functions import measures as MS
from ..operators import quality as Q
from ..session import drop_stage, materialise
from ..sources import published as P
from ..sources import sinks
from . import checks as K
from . import marts as M


# models written before others read them: several readers, or shared with the checks. The months of salaries and benefits are not:
# what they are made from is written (``marts.salary_series``), and a reader makes them again in less time than it would read them
STAGED = ["dim_employees", "fill_contract_dates", "factorial_map_custom_tables", "industrial_working_hours", "industrial_break_time",
          "cleaned_absences", "processed_lunchit", "inflation_payment", "lunchit_payment"]


def build_models(src: Mapping[str, DataFrame], as_of=None, stage=lambda df, name: df) -> dict[str, DataFrame]:
    """All models as DataFrames. ``stage(df, name)`` is called for the models in ``STAGED``, for the series of salaries
    and benefits and for the report tables; without it nothing runs while the models are built."""
    m: dict[str, DataFrame] = {}

    def add(name: str, df: DataFrame) -> None:
        m[name] = stage(df, name) if name in STAGED or name in REPORT_TABLES else df
    add("factorial_active_employees", M.active_employees(src["employees"]))
    add("factorial_terminated_employees", M.terminated_employees(src["employees"]))
    add("factorial_contracts", M.base_contracts(src["contracts"]))
    add("factorial_compensation", M.base_compensation(src["compensation"]))
    add("factorial_custom_tables", M.base_custom_tables(src["custom_tables"]))
    add("factorial_custom_tables_col", M.base_custom_tables_col(src["custom_tables_col"]))
    add("factorial_custom_tables_val", M.base_custom_tables_val(src["custom_tables_val"]))
    add("factorial_teams", M.base_teams(src["teams"]))
    add("mood_survey_answers", M.mood_survey_answers(src["mood_survey_answers"]))
    add("name_mapping_pto", M.name_mapping_pto(src["name_mapping"]))
    add("processed_lunchit", M.processed_lunchit(src["processed_lunchit"]))
    add("processed_troi", M.processed_troi(src["processed_troi"]))

    add("dim_employees", M.dim_employees(m["factorial_terminated_employees"], m["factorial_active_employees"], m["factorial_contracts"]))
    add("_dim_employees", M.employee_copy(m["dim_employees"]))
    add("fill_contract_dates", M.fill_contract_dates(m["factorial_contracts"], m["dim_employees"], as_of))
    add("factorial_unpack_custom_table_val", M.unpack_custom_values(m["factorial_custom_tables_val"]))
    add("factorial_map_custom_tables", M.label_custom_values(
        m["factorial_unpack_custom_table_val"], m["factorial_custom_tables"], m["factorial_custom_tables_col"]))

    add("map_names_troi", M.map_names_troi(m["processed_troi"], m["name_mapping_pto"]))
    add("industrial_working_hours", M.industrial_working_hours(m["map_names_troi"]))
    add("industrial_break_time", M.break_hours(m["industrial_working_hours"]))
    add("cleaned_absences", M.cleaned_absences(m["industrial_working_hours"]))

    # read by the payments and their averages
    salary = M.salary_series(m["fill_contract_dates"], stage)
    benefit = M.benefit_series(m["factorial_compensation"], m["fill_contract_dates"], stage)
    add("salary_payment", M.salary_payment(m["fill_contract_dates"], salary))
    add("benefit_payment", M.benefit_payment(m["factorial_compensation"], m["fill_contract_dates"], benefit))
    add("inflation_payment", M.inflation_payment(m["factorial_map_custom_tables"]))
    add("map_lunchit", M.map_lunchit(m["processed_lunchit"], m["name_mapping_pto"]))
    add("lunchit_payment", M.lunchit_payment(m["map_lunchit"], m["factorial_active_employees"]))
    add("payments_union", M.payments_union(m["salary_payment"], m["lunchit_payment"], m["inflation_payment"], m["benefit_payment"]))

    add("dim_contracts", M.dim_contracts(m["factorial_contracts"], m["dim_employees"], as_of))
    add("dim_date_table", M.dim_date_table(m["dim_employees"], as_of))
    add("dim_date_table_previous", MS.previous_period(m["dim_date_table"].select("date")))
    add("dim_name_mapping", M.dim_name_mapping(m["name_mapping_pto"]))
    add("dim_teams", M.dim_teams(m["factorial_teams"]))
    add("payment_averages", M.payment_averages(m["fill_contract_dates"], m["factorial_compensation"], m["lunchit_payment"], m["inflation_payment"],
                                                 salary, benefit))
    add("fct_payments", M.fct_payments(m["payments_union"], m["payment_averages"]))
    add("fct_absences", M.fct_absences(m["cleaned_absences"]))
    add("fct_absence_length", M.fct_absence_length(m["cleaned_absences"]))
    add("fct_working_hours", M.fct_working_hours(m["cleaned_absences"], m["industrial_break_time"]))
    add("fct_pto_entitlement", M.fct_pto_entitlement(m["name_mapping_pto"], m["cleaned_absences"]))
    add("fct_mood_survey", M.fct_mood_survey(m["mood_survey_answers"]))
    add("fct_trainings", M.fct_trainings(m["factorial_map_custom_tables"]))
    return m


REPORT_TABLES = ["dim_employees", "_dim_employees", "dim_contracts", "fct_payments", "dim_teams", "fct_trainings", "fct_mood_survey",
                 "fct_working_hours", "fct_absences", "fct_absence_length", "dim_name_mapping", "dim_date_table",
                 "dim_date_table_previous", "fct_pto_entitlement"]

# which models each report table is made from: a failing check holds these back
_FEEDS = {
    "dim_employees": ["factorial_active_employees", "factorial_terminated_employees", "factorial_contracts"],
    "_dim_employees": ["dim_employees"], "dim_contracts": ["factorial_contracts", "dim_employees"],
    "fill_contract_dates": ["factorial_contracts", "dim_employees"], "salary_payment": ["fill_contract_dates"],
    "benefit_payment": ["factorial_compensation", "fill_contract_dates"], "inflation_payment": ["factorial_map_custom_tables"],
    "lunchit_payment": ["processed_lunchit", "factorial_active_employees"],
    "fct_payments": ["salary_payment", "benefit_payment", "inflation_payment", "lunchit_payment"],
    "factorial_map_custom_tables": ["factorial_unpack_custom_table_val", "factorial_custom_tables", "factorial_custom_tables_col"],
    "factorial_unpack_custom_table_val": ["factorial_custom_tables_val"], "fct_trainings": ["factorial_map_custom_tables"],
    "dim_teams": ["factorial_teams"], "fct_mood_survey": ["mood_survey_answers"],
    "map_names_troi": ["processed_troi"], "industrial_working_hours": ["map_names_troi"],
    "industrial_break_time": ["industrial_working_hours"], "cleaned_absences": ["industrial_working_hours"],
    "fct_working_hours": ["cleaned_absences", "industrial_break_time"], "fct_absences": ["cleaned_absences"],
    "fct_absence_length": ["cleaned_absences"], "fct_pto_entitlement": ["cleaned_absences"],
    "dim_date_table": ["dim_employees"], "dim_date_table_previous": ["dim_date_table"],
}


def held_back(failed: set[str]) -> set[str]:
    """The failed models and everything made from them."""
    out = set(failed)
    while True:
        more = {t for t, feeds in _FEEDS.items() if t not in out and out.intersection(feeds)}
        if not more:
            return out
        out |= more


def build_and_publish(spark: SparkSession, src: Mapping[str, DataFrame], target: str, as_of=None, gate: bool = True) -> DataFrame:
    """*Action*: build, run the declared tests and references on the written tables, and publish
    these very files under ``target`` (``sources/published.py``) by moving its pointer once.

    With ``gate`` a failing check holds back its table and the tables made from it: readers keep the version
    they had, the other tables change together, and an error says which checks failed. The results of all
    checks are under ``target/checks/<run>``. Shared intermediates are removed at the end, and if
    the run fails before the pointer is moved, what it wrote as well."""
    run = uuid.uuid4().hex
    moved = False

    def stage(df: DataFrame, name: str) -> DataFrame:
        if name not in REPORT_TABLES:
            return materialise(df, name, run)
        path = P.version_path(target, run, name)
        sinks.publish_path(df, path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        models = build_models(src, as_of, stage)
        results = Q.run_checks(K.whole_suite(models))
        path = f"{target.rstrip('/')}/checks/{run}"
        results.write.parquet(path)
        results = spark.read.parquet(path)
        bad = [r for r in results.where("violations > 0").collect()]       # one row a declared check
        back = held_back({r["table"] for r in bad}) if gate else set()
        P.move_pointer(spark, target, {name: run for name in REPORT_TABLES if name not in back})
        moved = True
        P.drop_old_versions(spark, target)
    finally:
        drop_stage(spark, run)
        if not moved:
            P.drop_version(spark, target, run)
    if gate:
        Q.assert_clean(results)
    return results
