import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from staffhouse.operators import quality as Q
from staffhouse.plans import adapters as A
from staffhouse.plans import build as BU
from staffhouse.plans import checks as K
from staffhouse.plans import marts as M
from staffhouse.plans.build import REPORT_TABLES, build_and_publish, build_models
from staffhouse.session import ensure_checkpoint_dir
from staffhouse.sources import published as P
from staffhouse.sources import readers as S
from staffhouse.sources import sinks
from staffhouse.sources.schemas import CONTRACT, TEAM
from staffhouse.streaming.ingest import ExportConf, start_ingest

SF = "/root/testdata/sf0.001"


def test_declared_suite_has_all_tests():
    assert K.count_declared() == 141


def _sources(spark):
    t = lambda n: A.table(spark, SF, n)
    return {
        "employees": A.employees(t("customer")), "contracts": A.contracts(t("orders")),
        "compensation": A.compensation(t("lineitem")), "teams": A.teams(t("customer")),
        "custom_tables": A.custom_tables(spark), "custom_tables_col": A.custom_columns(spark),
        "custom_tables_val": A.custom_values(t("part")), "mood_survey_answers": A.mood_answers(t("orders")),
        "name_mapping": A.name_mapping(t("customer")), "processed_lunchit": A.lunchit_export(t("lineitem")),
        "processed_troi": A.troi_export(t("events")),
    }


AS_OF = "2001-06-01"         # marts take a text too


def test_build_and_publish(spark):
    src = _sources(spark)
    target = tempfile.mkdtemp(prefix="publish-")
    res = build_and_publish(spark, src, target, as_of=AS_OF, gate=False)
    got = {(r.table, r.check, r.column): r.violations for r in res.collect()}
    assert len(got) == 141 + len(K.REFERENCES) and len(K.REFERENCES) == 17
    assert got[("fct_payments", "not_null", "amount")] == 0
    assert got[("factorial_compensation", "not_null", "first_payment_on")] > 0   # adapter leaves it empty
    assert set(P.current(spark, target)) == set(REPORT_TABLES)
    # published is what was staged and tested, not a second computation
    models = build_models(src, AS_OF)
    for name in ("fct_payments", "dim_contracts"):
        a, b = P.read_published(spark, target, name), models[name]
        assert a.exceptAll(b).count() == 0 and a.count() == b.count()
    # a failing check holds back its table's dependants and only those: readers keep the version before
    before = P.current(spark, target)
    with pytest.raises(AssertionError):
        build_and_publish(spark, src, target, as_of=AS_OF, gate=True)
    after = P.current(spark, target)
    assert after["fct_payments"] == before["fct_payments"] and after["dim_employees"] != before["dim_employees"]
    assert P.read_published(spark, target, "fct_payments").count() == models["fct_payments"].count()
    assert spark.read.parquet(f"{target}/checks/*").count() == 2 * len(got)


def test_months_of_salaries_and_benefits_are_written_once(spark):
    """they are part of the payments; before, they were also written as models of their own."""
    written = []
    models = build_models(_sources(spark), AS_OF, lambda df, name: written.append(name) or df)
    assert {"salary_tagged", "benefit_tagged", "fct_payments"} <= set(written) and not {"salary_payment", "benefit_payment"} & set(written)
    assert len(written) == len(set(written))
    months = models["salary_payment"].count() + models["benefit_payment"].count()
    assert months > 0 and models["fct_payments"].where("name != 'Lunchit' and type != 'Inflation'").count() == months


def test_a_crash_between_two_tables_leaves_the_old_report_whole(spark, monkeypatch):
    src = _sources(spark)
    small = {"dim_teams": M.dim_teams(M.base_teams(src["teams"])), "dim_name_mapping": M.dim_name_mapping(M.name_mapping_pto(src["name_mapping"]))}
    monkeypatch.setattr(BU, "REPORT_TABLES", list(small))
    monkeypatch.setattr(BU, "build_models", lambda s, as_of, stage: {n: stage(df.limit(s["rows"]) if s["rows"] else df, n) for n, df in small.items()})
    monkeypatch.setattr(K, "whole_suite", lambda models: {n: (df, Q.TableChecks(not_null=[df.columns[0]])) for n, df in models.items()})
    target = tempfile.mkdtemp(prefix="publish-")
    staged = os.path.join(ensure_checkpoint_dir(spark), "staffhouse-stage")
    build_and_publish(spark, {"rows": 0}, target)
    whole = {n: P.read_published(spark, target, n).count() for n in small}
    left = set(os.listdir(staged)) if os.path.exists(staged) else set()
    written = []

    def fails(df, path, own=sinks.publish_path):
        if len(written) == 1:
            raise RuntimeError("the driver is lost")
        written.append(path)
        own(df, path)
    with monkeypatch.context() as m:
        m.setattr(sinks, "publish_path", fails)
        with pytest.raises(RuntimeError, match="lost"):
            build_and_publish(spark, {"rows": 3}, target)
    assert written and not os.path.exists(written[0])
    assert {n: P.read_published(spark, target, n).count() for n in small} == whole
    assert (set(os.listdir(staged)) if os.path.exists(staged) else set()) == left
    # a driver that is killed removes nothing: the pointer alone says what is read
    sinks.publish_path(small["dim_teams"].limit(1), P.version_path(target, "killed", "dim_teams"))
    assert {n: P.read_published(spark, target, n).count() for n in small} == whole
    # the next run changes all tables at once, and versions that no pointer of the last two names go
    runs = [P.current(spark, target)["dim_teams"]]
    for n in (3, 4, 5):
        build_and_publish(spark, {"rows": n}, target)
        runs.append(P.current(spark, target)["dim_teams"])
        assert {P.read_published(spark, target, t).count() for t in small} == {n}
    assert sorted(set(os.listdir(f"{target}/versions")) - {"killed"}) == sorted(runs[-2:])
    with pytest.raises(ValueError, match="not published"):
        P.read_published(spark, target, "fct_payments")


TROI = ["Monat", "Checked In", "Checked Out", "Pausenzeiten", "Arbeitszeit", "erfasste Stunden", "Urlaub (PT / Std.)", "krank (PT / Std.)",
        "Kurzarbeit (PT / Std.)", "Abwesenheiten (PT / Std.)", "Gesamt", "WB", "NWB", "wb/nwb", "an/ab", "Soll", "Saldo"]
LUNCHIT = ["Abrechnungsmonat", "Datum", "Eingereichter Betrag", "Erstattungsbetrag", "Zuzahlung", "Lunchit 1/2", "Lunchit 2/2", "Lunchit Beleg-ID", "E-Mail-Adresse"]


def test_ingested_exports_feed_the_report(spark):
    """Landed files to a published report: nothing in between is written by hand."""
    root = tempfile.mkdtemp(prefix="report-")
    src = _sources(spark)
    src["name_mapping"].select(F.col("id").cast("long").alias("id"), "troi_name", "email").where("troi_name is not null").write.parquet(f"{root}/mapping")
    person = src["name_mapping"].where("troi_name is not null and email like 'c%'").orderBy(F.col("id").cast("int")).first()
    other = src["employees"].where("terminated_on is null").orderBy("id").first()

    def land(name, file, header, rows):
        os.makedirs(f"{root}/raw/{name}", exist_ok=True)
        with open(f"{root}/raw/{name}/{file}", "w", encoding="utf-8") as f:
            f.write("\n".join(";".join(r) for r in [header, *rows]) + "\n")
    day = lambda d, worked, away: [f"2024-01-{d:02d} 08:00:00", "08:00", "17:00", '"12:00 - 12:30\n15:00 - 15:10"', worked, "8,50", away, "", "", "2,00 / 10,50", "", "1,25", "0,5", "", "", "8,00", ""]
    # the first file lacks a column that came later
    land("troi", "export_2024-01-08.csv", TROI[:-1], [[person.troi_name] + [""] * 15, day(8, "08:30", "1,50 / 4,00")[:-1]])
    land("lunchit", "export_2024-02-05.csv", LUNCHIT, [["01.02.2024", "15.01.2024", "10,00", "6,57", "3,10", "3,10", "2,05", "B-1", other.email]])
    common = dict(root=root, mapping_path=f"{root}/mapping")
    start_ingest(spark, ExportConf(name="troi", checkpoint=f"{root}/_t", columns=TROI[:-1], left_col="Monat", right_col="troi_name", fill_down_col="id", filter_col="Monat", **common)).awaitTermination()
    land("troi", "export_2024-01-10.csv", TROI, [[person.troi_name] + [""] * 16, day(8, "08:30", ""), day(9, "07:15", "")])
    start_ingest(spark, ExportConf(name="troi", checkpoint=f"{root}/_t", columns=TROI, left_col="Monat", right_col="troi_name", fill_down_col="id", filter_col="Monat", **common)).awaitTermination()
    start_ingest(spark, ExportConf(name="lunchit", checkpoint=f"{root}/_l", columns=LUNCHIT, left_col="E-Mail-Adresse", right_col="email", del_cols=["E-Mail-Adresse"], **common)).awaitTermination()
    for name in ("troi", "lunchit"):
        src[f"processed_{name}"] = S.read_processed(spark, f"processed_{name}", f"{root}/processed/{name}")
    assert sorted((r.Monat, r.id, r.Saldo, r.Checked_In) for r in src["processed_troi"].collect()) == [(f"2024-01-{d:02d} 08:00:00", person.id, None, "08:00") for d in (8, 9)]
    with pytest.raises(ValueError, match="no file .* Erstattungsbetrag"):
        S.read_processed(spark, "processed_lunchit", f"{root}/processed/troi")
    build_and_publish(spark, src, f"{root}/report", as_of=AS_OF, gate=False)
    hours = P.read_published(spark, f"{root}/report", "fct_working_hours").where(F.col("full_name") == person.troi_name).collect()
    assert {r.date.day for r in hours} == {8, 9}
    meals = P.read_published(spark, f"{root}/report", "fct_payments").where("name = 'Lunchit'").collect()
    assert [(r.factorial_id, r.amount, r.date.isoformat()) for r in meals] == [(other.id, 3.1 + 2.05, "2024-01-01")]


def test_staging_needs_a_shared_folder_on_a_cluster():
    class Conf(dict):
        def get(self, k, d=None): return dict.get(self, k, d)

    class Session:
        conf = Conf({"spark.master": "yarn"})
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_missing_columns_and_bad_records_fail(spark):
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        M.base_contracts(A.contracts(A.table(spark, SF, "orders")).drop("de_contract_type_id"))
    d = tempfile.mkdtemp(prefix="bad-")
    with open(os.path.join(d, "teams.json"), "w") as f:
        f.write('{"id": 1, "name": "A"}\n{"id": 2, "na\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        S.read_stream(spark, "teams", d).collect()


def test_custom_values_are_read_from_landed_records(spark):
    d = tempfile.mkdtemp(prefix="vals-")
    with open(os.path.join(d, "v.json"), "w") as f:
        f.write('{"id": 1, "employee_id": 5, "table_id": 2, "7": "x", "8": null}\n')
    r = S.read_stream(spark, "custom_tables_val", d).first()
    assert (r.id, r.employee_id, r.table_id, r.col_val) == (1, 5, 2, {"7": "x", "8": None})


def test_read_stream_and_slices(spark):
    d = tempfile.mkdtemp(prefix="streams-")
    with open(os.path.join(d, "teams.json"), "w") as f:
        for rec in [{"id": 1, "company_id": 9, "name": "A", "employee_ids": [1, 2, None]},
                    {"id": 2, "company_id": 9, "name": "B", "employee_ids": []},
                    {"id": 3, "company_id": 9, "name": "C", "employee_ids": None}]:
            f.write(json.dumps(rec) + "\n")
    teams = S.read_stream(spark, "teams", d)
    assert teams.schema["employee_ids"].dataType == TEAM["employee_ids"].dataType
    keys = S.array_parent_keys(teams, "employee_ids", "employee_id", parent_key="id").collect()
    assert sorted((r.id, r.employee_id if r.employee_id is not None else -1) for r in keys) == [(1, -1), (1, 1), (1, 2)]
    assert [r.team_id for r in S.parent_keys(teams, "id", "team_id").orderBy("team_id").collect()] == [1, 2, 3]


def test_extract_records_and_dynamic_map(spark):
    raw = spark.createDataFrame([('[{"id": 1, "employee_id": 5, "table_id": 2, "7": "x", "8": null}]',)], "body string")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("employee_id", T.LongType())])
    assert S.extract_records(raw, "body", schema).collect()[0].employee_id == 5
    rec = spark.createDataFrame([('{"id": 1, "employee_id": 5, "table_id": 2, "7": "x", "8": null}',)], "raw string")
    m = S.dynamic_columns_to_map(rec, "raw", ["id", "employee_id", "table_id"],
                                 key_types={"id": "bigint", "employee_id": "bigint", "table_id": "bigint"}).first()
    assert m.table_id == 2 and m.col_val == {"7": "x", "8": None}


def test_read_export_rejects_unknown_ending(spark):
    with pytest.raises(ValueError):
        S.read_export(spark, "/tmp/x.xlsx")


def test_read_export_multiline(spark):
    d = tempfile.mkdtemp(prefix="exp-")
    p = os.path.join(d, "e.csv")
    with open(p, "w") as f:
        f.write('Monat;Pausenzeiten\n2024-01-02 00:00:00;"12:00 - 12:30\n13:00 - 13:05"\n')
    rows = S.read_export(spark, p).collect()
    assert len(rows) == 1 and rows[0].Pausenzeiten == "12:00 - 12:30\n13:00 - 13:05"


def test_contract_schema_fields():
    assert CONTRACT["salary_amount"].dataType.typeName() == "long"


def test_read_sheet_keeps_declared_columns(spark):
    d = tempfile.mkdtemp(prefix="sheet-")
    with open(os.path.join(d, "mood.csv"), "w") as f:
        f.write("response_id,date,rating,feedback,feedback_bad_rating,__PowerAppsId__,_airbyte_raw_id\n")
        f.write('1,2024-01-05,4 x,"ok",,abc,zzz\n')
    df = S.read_sheet(spark, "mood_survey_answers", d)
    assert "_airbyte_raw_id" not in df.columns and df.first().rating == "4 x"
