"""Typed schemas of the record streams (landed as JSON) and column lists of the
untyped file/sheet inputs. Money is integer cents, working hours are hundredths."""
from __future__ import annotations

from pyspark.sql import types as T

L, S, B, D, TS = T.LongType(), T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType()


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


EMPLOYEE = _schema(
    ("id", L, False), ("first_name", S, True), ("last_name", S, True), ("full_name", S, True),
    ("email", S, True), ("birthday_on", D, True), ("terminated_on", D, True),
    ("termination_reason", S, True), ("termination_reason_type", S, True),
    ("termination_observations", S, True), ("termination_type_description", S, True),
    ("identifier", S, True), ("identifier_type", S, True), ("gender", S, True), ("nationality", S, True),
    ("bank_number", S, True), ("swift_bic", S, True), ("bank_number_format", S, True), ("country", S, True),
    ("city", S, True), ("state", S, True), ("postal_code", S, True), ("address_line_1", S, True),
    ("address_line_2", S, True), ("company_id", L, True), ("legal_entity_id", L, True),
    ("created_at", TS, True), ("updated_at", TS, True), ("manager_id", L, True), ("location_id", L, True),
    ("timeoff_manager_id", L, True), ("social_security_number", S, True), ("tax_id", S, True),
    ("timeoff_policy_id", L, True), ("team_ids", T.ArrayType(L), True), ("phone_number", S, True),
    ("company_identifier", S, True), ("contact_name", S, True), ("contact_number", S, True),
)

CONTRACT = _schema(
    ("id", L, False), ("employee_id", L, False), ("country", S, True), ("job_title", S, True),
    ("role", S, True), ("level", S, True), ("effective_on", D, False), ("starts_on", D, False),
    ("ends_on", D, True), ("has_payroll", B, True), ("salary_amount", L, True),
    ("salary_frequency", S, True), ("working_week_days", S, True), ("working_hours", L, True),
    ("working_hours_frequency", S, True), ("trial_period_ends_on", D, True),
    ("es_has_teleworking_contract", B, True), ("es_cotization_group", L, True),
    ("es_contract_observations", S, True), ("es_job_description", S, True),
    ("es_contract_type_id", L, True), ("es_working_day_type_id", L, True),
    ("es_education_level_id", L, True), ("es_professional_category_id", L, True),
    ("fr_employee_type", S, True), ("fr_forfait_jours", B, True), ("fr_jours_par_an", L, True),
    ("fr_coefficient", L, True), ("fr_contract_type_id", L, True), ("fr_level_id", L, True),
    ("fr_step_id", L, True), ("fr_mutual_id", L, True), ("fr_professional_category_id", L, True),
    ("fr_work_type_id", L, True), ("de_contract_type_id", L, True), ("pt_contract_type_id", L, True),
    ("compensation_ids", T.ArrayType(L), True), ("created_at", TS, True), ("updated_at", TS, True),
)

COMPENSATION = _schema(
    ("id", L, False), ("contract_version_id", L, False), ("description", S, True),
    ("compensation_type", S, True), ("amount", L, True), ("recurrence", S, True),
    ("first_payment_on", D, True), ("sync_with_supplements", B, True), ("contracts_taxonomy_id", L, False),
    ("payroll_policy_id", L, True), ("recurrence_count", L, True), ("starts_on", D, True),
    ("unit", S, True), ("calculation", S, True),
)

TEAM = _schema(
    ("company_id", L, True), ("id", L, False), ("name", S, True), ("employee_ids", T.ArrayType(L, True), True),
    ("lead_ids", T.ArrayType(L, True), True), ("description", S, True), ("avatar", S, True),
)

CUSTOM_TABLE = _schema(
    ("id", L, False), ("name", S, True), ("created_at", TS, True), ("topic_name", S, True),
    ("custom_resources_topic_id", L, True), ("reportable", B, True), ("hidden", B, True),
)

CUSTOM_TABLE_COL = _schema(("id", L, False), ("label", S, True), ("position", L, True))

CUSTOM_TABLE_VAL = _schema(
    ("id", L, False), ("employee_id", L, True), ("col_val", T.MapType(S, S, True), True), ("table_id", L, True),
)

CUSTOM_FIELD = _schema(
    ("id", L, False), ("label", S, True), ("position", L, True), ("required", B, True),
    ("field_type", S, True), ("min_value", L, True), ("max_value", L, True),
    ("choice_options", T.ArrayType(_schema(("id", L, True), ("label", S, True), ("value", S, True),
                                           ("is_active", B, True))), True),
)

CUSTOM_FIELD_VAL = _schema(
    ("id", L, False), ("label", S, True), ("value", S, True), ("field_id", L, True),
    ("required", B, True), ("instance_id", L, True),
)

STREAMS = {
    "employees": EMPLOYEE, "active_employees": EMPLOYEE, "contracts": CONTRACT,
    "compensation": COMPENSATION, "teams": TEAM, "custom_tables": CUSTOM_TABLE,
    "custom_tables_col": CUSTOM_TABLE_COL, "custom_tables_val": CUSTOM_TABLE_VAL,
    "custom_fields": CUSTOM_FIELD, "custom_fields_val": CUSTOM_FIELD_VAL,
}

# Untyped sheet / file inputs (every column read as text).
SHEETS = {
    "mood_survey_answers": ["response_id", "date", "rating", "feedback", "feedback_bad_rating", "__PowerAppsId__"],
    "name_mapping": ["id", "jahr", "name", "email", "troi_name", "urlaubsanspruch_pt", "resturlaub_vorjahr"],
    "processed_lunchit": ["Abrechnungsmonat", "Datum", "Eingereichter_Betrag", "Erstattungsbetrag", "Zuzahlung",
                          "Lunchit_1_2", "Lunchit_2_2", "Lunchit_Beleg_ID", "id"],
    "processed_troi": ["Monat", "Checked_In", "Checked_Out", "Pausenzeiten", "Arbeitszeit", "erfasste_Stunden",
                       "Urlaub__PT___Std__", "krank__PT___Std__", "Kurzarbeit__PT___Std__",
                       "Abwesenheiten__PT___Std__", "Gesamt", "WB", "NWB", "wb_nwb", "an_ab", "Soll", "Saldo", "id"],
}

# fixed values: loader metadata columns that base models never project.
LOADER_COLUMNS = ("_airbyte_raw_id", "_airbyte_extracted_at", "_airbyte_meta", "_ab_source_file_last_modified")
