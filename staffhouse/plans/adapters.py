"""Adapters: project the driver tables into the shape of the HR sources, so the
marts run unchanged on data that grows with the scale factor.

Every adapter is a plain projection (plus unions / bounded groupings); the matching
DuckDB text lives in ``plans/oracle.py`` under the same name.

Mapping (driver table -> source):
  customer  -> employees stream, name-mapping sheets, teams
  orders    -> contracts stream, survey answers
  lineitem  -> compensation stream, meal-benefit export
  events    -> time-tracking export, dynamic custom-value records
  part      -> custom-table value records
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.schemas import COMPENSATION, CONTRACT, CUSTOM_TABLE, CUSTOM_TABLE_COL, EMPLOYEE, TEAM

# fixed values: as-of dates for the two time domains of the driver data
AS_OF_ORDERS = "2001-06-01"
AS_OF_EVENTS = "2024-01-31"

# fixed values: custom-table headers and column labels used by the EAV adapter
CUSTOM_TABLES = [(1, "Weiterbildung 2024"), (2, "Inflationsausgleich"), (3, "Sonstiges")]
CUSTOM_COLUMNS = [(11, "Titel"), (12, "Datum"), (13, "Typ"), (14, "Enddatum"), (15, "Kosten"),
                  (21, "Datum"), (22, "Betrag"), (31, "Notiz")]
PIVOT_LABELS = sorted({label for _, label in CUSTOM_COLUMNS})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _typed_nulls(schema, present: dict) -> list:
    return [present[f.name].alias(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields]


def _comma(c) -> "F.Column":
    """decimal(12,2) text with a decimal comma."""
    return F.replace(c.cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(","))


# ---------------------------------------------------------------- customer

def employees(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    term = k % 10 == 0
    present = {
        "id": k,
        "first_name": F.concat(F.lit("Vorname"), k.cast("string")),
        "last_name": F.concat(F.lit("Nachname"), k.cast("string")),
        "full_name": F.col("c_name"),
        "email": F.concat(F.lit("c"), k.cast("string"), F.lit("@corp.test")),
        "birthday_on": F.date_add(F.lit("1960-01-01").cast("date"), ((k * 37) % 14000).cast("int")),
        "terminated_on": F.when(term, F.date_add(F.lit("1998-01-01").cast("date"), (k % 1000).cast("int"))),
        "termination_reason": F.when(term, F.col("c_mktsegment")),
        "gender": F.when(F.col("c_nationkey") % 2 == 0, "female").otherwise("male"),
        "company_identifier": F.concat(F.lit("E"), k.cast("string")),
    }
    return customer.select(*_typed_nulls(EMPLOYEE, present))


def name_mapping(customer: DataFrame) -> DataFrame:
    """The two lumped sheets: names/e-mails per id (a second e-mail for every 50th
    person) and one leave-entitlement row per id."""
    k = F.col("c_custkey")
    ks = k.cast("string")
    null_s = F.lit(None).cast("string")
    null_d = F.lit(None).cast("double")
    names = customer.select(ks.alias("id"), null_s.alias("jahr"), null_s.alias("name"),
                            F.concat(F.lit("c"), ks, F.lit("@corp.test")).alias("email"),
                            F.col("c_name").alias("troi_name"), null_d.alias("urlaubsanspruch_pt"),
                            null_d.alias("resturlaub_vorjahr"))
    alt = customer.where(k % 50 == 0).select(
        ks.alias("id"), null_s.alias("jahr"), null_s.alias("name"),
        F.concat(F.lit("alt"), ks, F.lit("@corp.test")).alias("email"),
        F.col("c_name").alias("troi_name"), null_d.alias("urlaubsanspruch_pt"), null_d.alias("resturlaub_vorjahr"))
    pto = customer.select(ks.alias("id"), F.concat((F.lit(2020) + k % 5).cast("string"), F.lit("-01-01")).alias("jahr"),
                          F.col("c_name").alias("name"), null_s.alias("email"), null_s.alias("troi_name"),
                          (F.lit(20) + k % 11).cast("double").alias("urlaubsanspruch_pt"),
                          (k % 5).cast("double").alias("resturlaub_vorjahr"))
    return names.unionByName(alt).unionByName(pto)


def teams(customer: DataFrame) -> DataFrame:
    """Teams of at most 100 people (nation x key block); the member array of a team is
    bounded by construction."""
    blk = F.floor(F.col("c_custkey") / 100)
    ids = F.sort_array(F.collect_list("c_custkey"))
    g = customer.groupBy(F.col("c_nationkey"), blk.alias("blk")).agg(ids.alias("employee_ids"))
    present = {
        "id": (F.col("c_nationkey") * 1_000_000 + F.col("blk")).cast("bigint"),
        "name": F.concat(F.lit("Team "), F.col("c_nationkey").cast("string"), F.lit("-"), F.col("blk").cast("string")),
        "employee_ids": F.col("employee_ids"),
        "avatar": F.concat(F.lit("team-"), F.col("blk").cast("string"), F.lit(".png")),
    }
    return g.select(*_typed_nulls(TEAM, present))


# ---------------------------------------------------------------- orders

def contracts(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    eff = F.col("o_orderdate").cast("date")
    present = {
        "id": k, "employee_id": F.col("o_custkey"), "job_title": F.col("o_orderpriority"),
        "effective_on": eff, "starts_on": eff,
        "ends_on": F.when(k % 11 == 0, F.date_add(eff, 180)),
        "salary_amount": F.when(k % 9 != 0, F.floor("o_totalprice").cast("bigint")),
        "salary_frequency": F.when(k % 2 == 0, "monthly").otherwise("hourly"),
        "working_hours": F.when(k % 3 == 0, F.lit(4000).cast("bigint")).when(k % 3 == 1, F.lit(3200).cast("bigint")),
        "working_hours_frequency": F.lit("weekly"),
        "country": F.when(k % 4 == 0, "de").otherwise("es"),
        "es_has_teleworking_contract": k % 5 == 0,
        "de_contract_type_id": F.when(k % 4 == 0, k % 7),
    }
    return orders.select(*_typed_nulls(CONTRACT, present))


def mood_answers(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.select(k.cast("string").alias("response_id"),
                         F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                         F.col("o_orderpriority").alias("rating"),
                         F.when(k % 3 == 0, F.col("o_orderstatus")).alias("feedback"),
                         F.when(k % 5 == 0, F.lit("zu laut")).alias("feedback_bad_rating"),
                         F.concat(F.lit("pa"), k.cast("string")).alias("__PowerAppsId__"))


# ---------------------------------------------------------------- lineitem

def compensation(lineitem: DataFrame) -> DataFrame:
    ln = F.col("l_linenumber")
    present = {
        "id": (F.col("l_orderkey") * 8 + ln).cast("bigint"),
        "contract_version_id": F.col("l_orderkey"),
        "description": F.concat(F.lit("Zulage "), F.col("l_returnflag"), F.col("l_linestatus")),
        "compensation_type": F.lit("fixed"),
        "amount": F.when(ln != 7, F.floor(F.col("l_quantity") * 50).cast("bigint")),
        "recurrence": F.lit("monthly"),
        "sync_with_supplements": F.lit(False),
        "contracts_taxonomy_id": (F.col("l_suppkey") % 5).cast("bigint"),
        "starts_on": F.when(ln % 2 == 0, F.col("l_shipdate").cast("date")),
    }
    return lineitem.select(*_typed_nulls(COMPENSATION, present))


def lunchit_export(lineitem: DataFrame) -> DataFrame:
    ln = F.col("l_linenumber")
    day = F.date_format("l_shipdate", "dd.MM.yyyy")
    return lineitem.select(
        day.alias("Abrechnungsmonat"), day.alias("Datum"),
        _comma(F.col("l_extendedprice")).alias("Eingereichter_Betrag"),
        _comma(F.col("l_quantity")).alias("Erstattungsbetrag"),
        F.when(ln == 3, F.lit("")).otherwise(_comma(F.col("l_quantity"))).alias("Zuzahlung"),
        _comma(F.col("l_tax") * 100).alias("Lunchit_1_2"),
        _comma(F.col("l_discount") * 100).alias("Lunchit_2_2"),
        F.when(ln == 5, F.lit("")).otherwise(
            F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), ln.cast("string"))).alias("Lunchit_Beleg_ID"),
        F.when(ln == 6, F.lit("")).otherwise(F.concat(F.col("l_partkey").cast("string"), F.lit(",0"))).alias("id"))


# ---------------------------------------------------------------- events

def troi_export(events: DataFrame) -> DataFrame:
    """Time-tracking export rows (all text). One row per event; 'signup' rows become
    summary rows that the day-row filter removes."""

    def hhmm(m):
        return F.format_string("%02d:%02d", F.floor(m / 60).cast("int"), (m % 60).cast("int"))

    # staged projections: shared parts are computed once per row
    base = events.select("ts", "user_id", "value", F.col("event_type").alias("et"),
                         F.floor("value").cast("bigint").alias("v"),
                         (F.hour("ts") * 60 + F.minute("ts")).alias("st"))
    v, et, start = F.col("v"), F.col("et"), F.col("st")
    parts = base.select("*",
                        F.format_string("%s - %s", hhmm(start), hhmm((start + v % 50) % 1440)).alias("b1"),
                        F.format_string("%s - %s", hhmm((start + 60) % 1440), hhmm((start + 75) % 1440)).alias("b2"))
    breaks = (F.when(et == "click", F.concat(F.col("b1"), F.lit("\n"), F.col("b2")))
               .when(et == "purchase", F.lit(""))
               .otherwise(F.col("b1")))
    work = (F.when(et == "view", F.lit(""))
             .when(et == "error", F.format_string("%d:%02d", (v % 10).cast("int"), F.minute("ts")))
             .otherwise(F.format_string("%02d:%02d", (v % 12).cast("int"), F.minute("ts"))))
    urlaub = F.when(v % 3 == 0, F.concat((v % 2).cast("string"), F.lit(",50 / "), (v % 9).cast("string"), F.lit(",00"))) \
              .otherwise(F.lit(""))
    krank = F.when(et == "error", F.concat((v % 2).cast("string"),
                                           F.when(v % 4 == 0, F.lit(",50")).otherwise(F.lit(",00")),
                                           F.lit(" / "), (v % 9).cast("string"), F.lit(",00"))).otherwise(F.lit(""))
    kurz = F.when(v % 7 == 0, F.lit("1,00 / 10,00")).otherwise(F.lit(""))
    abw = F.when(v % 13 == 0, F.lit("5,00")).otherwise(
        F.concat((v % 3).cast("string"), F.lit(",00 / "), (v % 9 + 2).cast("string"), F.lit(",50")))
    monat = F.when(et == "signup", F.lit("Summe")).otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" 00:00:00")))
    return parts.select(
        monat.alias("Monat"), F.date_format("ts", "HH:mm").alias("Checked_In"), F.lit("").alias("Checked_Out"),
        breaks.alias("Pausenzeiten"), work.alias("Arbeitszeit"), _comma(F.col("value")).alias("erfasste_Stunden"),
        urlaub.alias("Urlaub__PT___Std__"), krank.alias("krank__PT___Std__"), kurz.alias("Kurzarbeit__PT___Std__"),
        abw.alias("Abwesenheiten__PT___Std__"), F.lit("").alias("Gesamt"),
        F.concat((v % 4).cast("string"), F.lit(",25")).alias("WB"),
        F.concat((v % 2).cast("string"), F.lit(",5")).alias("NWB"),
        F.lit("").alias("wb_nwb"), F.lit("").alias("an_ab"),
        F.when(et == "view", F.lit("")).otherwise(F.lit("8,00")).alias("Soll"), F.lit("").alias("Saldo"),
        F.concat(F.col("user_id").cast("string"), F.lit(".0")).alias("id"))


def event_records(events: DataFrame) -> DataFrame:
    """Raw JSON record text with fixed keys (id, employee_id) and open keys (the event
    type and the keys inside ``props``)."""
    inner = F.expr("substring(props, 2, length(props) - 2)")
    raw = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"),
                   F.lit(', "employee_id": '), F.col("user_id").cast("string"),
                   F.lit(", "), inner,
                   F.lit(', "'), F.col("event_type"), F.lit('": "'),
                   F.col("value").cast("decimal(12,2)").cast("string"), F.lit('"}'))
    return events.select(raw.alias("raw"))


# ---------------------------------------------------------------- part

def custom_values(part: DataFrame) -> DataFrame:
    """Custom-table value records: table by part size, dynamic keys are column ids."""
    k = F.col("p_partkey")
    tid = (F.col("p_size") % 3 + 1).cast("bigint")
    d1 = F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), (k % 365).cast("int")), "yyyy-MM-dd")
    d2 = F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), (k % 365 + F.col("p_size")).cast("int")),
                       "yyyy-MM-dd")
    cents = ((k * 7) % 100000).cast("string")
    end_txt = F.when(k % 4 == 0, F.lit("null")).otherwise(F.concat(F.lit('"'), d2, F.lit('"')))
    t1 = F.concat(F.lit('{"11": "'), F.col("p_name"), F.lit('", "12": "'), d1, F.lit('", "13": "'), F.col("p_type"),
                  F.lit('", "14": '), end_txt, F.lit(', "15": "'), cents, F.lit('", "99": "x"}'))
    t2 = F.concat(F.lit('{"21": "'), d1, F.lit('", "22": "'), cents, F.lit('"}'))
    t3 = F.concat(F.lit('{"31": "'), F.col("p_brand"), F.lit('"}'))
    raw = F.when(tid == 1, t1).when(tid == 2, t2).otherwise(t3)
    from pyspark.sql import types as T
    return part.select(k.alias("id"), k.alias("employee_id"),
                       F.from_json(raw, T.MapType(T.StringType(), T.StringType())).alias("col_val"),
                       tid.alias("table_id"))


def custom_value_records(part: DataFrame) -> DataFrame:
    """The same records as landed: JSON text, fixed keys and open attribute keys side by side."""
    v = custom_values(part)
    body = F.to_json("col_val", {"ignoreNullFields": "false"})
    return v.select(F.concat(F.lit('{"id": '), F.col("id").cast("string"), F.lit(', "employee_id": '), F.col("employee_id").cast("string"),
                             F.lit(', "table_id": '), F.col("table_id").cast("string"), F.lit(", "), F.substr(body, F.lit(2))).alias("raw"))


def custom_tables(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(CUSTOM_TABLES, "id bigint, name string")
    return df.select(*_typed_nulls(CUSTOM_TABLE, {c: F.col(c) for c in df.columns}))


def custom_columns(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(CUSTOM_COLUMNS, "id bigint, label string")
    return df.select(*_typed_nulls(CUSTOM_TABLE_COL, {c: F.col(c) for c in df.columns}))
