import os
import shutil
import tempfile

from pyspark.sql import functions as F

from staffhouse.streaming.anonymise import date_from_name, default_id, mask_values
from staffhouse.streaming.ingest import ExportConf, start_ingest

HEADER = ["Monat", "Arbeitszeit", "Pausenzeiten"]


def _write(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write(";".join(HEADER) + "\n")
        for r in rows:
            f.write(";".join(r) + "\n")


def test_anonymise_columns(spark):
    df = spark.createDataFrame([("Doe, Jane", "Doe, Jane", None), ("Roe, Rick", None, None),
                                ("2024-01-02 00:00:00", None, None)], "Monat string, troi_name string, id string")
    out = default_id(mask_values(df, "Monat", "troi_name"), "Monat").collect()
    assert {r.Monat: r.id for r in out} == {"": None, "Roe, Rick": "0", "2024-01-02 00:00:00": None}


def test_names_are_masked_in_the_whole_file(spark):
    df = spark.createDataFrame([("f", "Doe, Jane", "Doe, Jane"), ("f", "Doe, Jane (Vertretung)", None), ("f", "Doe, Janet", None),
                                ("f", "mit Doe, Jane Ann", None), ("f", "Doe, Jane Ann", "Doe, Jane Ann"), ("f", "a.b", "a.b"), ("f", "axb", None),
                                ("g", "Doe, Jane", None), ("f", None, None)], "file string, Monat string, troi_name string")
    got = sorted((r.file, r.Monat) for r in mask_values(df, "Monat", "troi_name", ["file"]).collect())
    assert got == sorted([("f", ""), ("f", " (Vertretung)"), ("f", "Doe, Janet"), ("f", "mit "), ("f", ""), ("f", ""), ("f", "axb"), ("g", "Doe, Jane"), ("f", "")])


def _ingest(spark, root, **more):
    conf = ExportConf(name="troi", root=root, checkpoint=f"{root}/_ckpt", columns=HEADER, left_col="Monat",
                      right_col="troi_name", mapping_path=f"{root}/mapping", fill_down_col="id", filter_col="Monat", **more)
    start_ingest(spark, conf).awaitTermination()


def test_cumulative_files_in_two_runs_give_each_row_once(spark):
    root = tempfile.mkdtemp(prefix="ingest-")
    os.makedirs(f"{root}/raw/troi")
    spark.createDataFrame([(7, "Doe, Jane", "j@x")], "id long, troi_name string, email string").write.parquet(f"{root}/mapping")
    days = lambda *n: [("Doe, Jane", "", "")] + [(f"2024-01-{d:02d} 08:00:00", "08:00", "") for d in n]
    _write(f"{root}/raw/troi/export_2024-01-10.csv", days(9, 10))
    _ingest(spark, root)
    assert os.listdir(f"{root}/raw/troi") == []             # no names are left where they landed
    _write(f"{root}/raw/troi/export_2024-01-12.csv", days(9, 10, 12))
    _ingest(spark, root)
    got = sorted(r.Monat for r in spark.read.parquet(f"{root}/processed/troi").collect())
    assert got == ["2024-01-09 08:00:00", "2024-01-10 08:00:00", "2024-01-12 08:00:00"]


class Killed(Exception):
    pass


def _conf(root):
    return ExportConf(name="troi", root=root, checkpoint=f"{root}/_ckpt", columns=HEADER, left_col="Monat",
                      right_col="troi_name", mapping_path=f"{root}/mapping", fill_down_col="id", filter_col="Monat")


def _outputs(spark, root):
    """What the sinks hold, by file name."""
    out = []
    for zone in ("archive", "clean", "processed"):
        df = spark.read.parquet(f"{root}/{zone}/troi")
        cols = sorted(c for c in df.columns if c != "ingest_file")
        out.append(sorted(tuple(str(r[c]) for c in cols) + (r.ingest_file.rsplit("/", 1)[-1],) for r in df.collect()))
    return out, os.listdir(f"{root}/raw/troi")


def _landing(spark):
    root = tempfile.mkdtemp(prefix="ingest-")
    os.makedirs(f"{root}/raw/troi")
    spark.createDataFrame([(7, "Doe, Jane", "j@x"), (8, r"Roe\E, Rick", "r@x")], "id long, troi_name string, email string").write.parquet(f"{root}/mapping")
    days = lambda *n: [("Doe, Jane", "", "")] + [(f"2024-01-{d:02d} 08:00:00", "08:00", r"mit Roe\E, Rick") for d in n] + [(r"Roe\E, Rick", "", "")]
    _write(f"{root}/raw/troi/export_2024-01-08.csv", days(7, 8))
    _ingest(spark, root)
    _write(f"{root}/raw/troi/export 2024-01-10 [a].csv", days(7, 8, 9, 10))
    _write(f"{root}/raw/troi/export_2024-01-12.csv", days(9, 10, 11, 12))
    return root


def test_a_run_killed_after_any_step_is_replayed_with_the_same_result(spark):
    import pytest
    landed, seen = _landing(spark), []
    root = shutil.copytree(landed, f"{landed}-whole")
    start_ingest(spark, _conf(root), seen.append).awaitTermination()
    want = _outputs(spark, root)
    assert seen == ["journal", "archive", "clean", "processed", "state", "mark", "remove", "remove"]
    # rows strictly between the files' dates, each file bounded by the one before it
    assert sorted((r[-1], next(x for x in r if x.startswith("2024"))) for r in want[0][2]) == sorted(
        (name, f"2024-01-{d:02d} 08:00:00") for name, days in (("export_2024-01-08.csv", (7, 8)), ("export 2024-01-10 [a].csv", (9, 10)), ("export_2024-01-12.csv", (11, 12))) for d in days)
    assert want[1] == []
    for stop in range(len(seen)):
        root, steps = shutil.copytree(landed, f"{landed}-{stop}"), []

        def kill(step):
            steps.append(step)
            if len(steps) == stop + 1:
                raise Killed(step)
        with pytest.raises(Exception, match="Killed"):
            start_ingest(spark, _conf(root), kill).awaitTermination()
        _ingest(spark, root)
        assert _outputs(spark, root) == want, seen[stop]


def test_columns_are_read_by_name_and_others_refused(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="ingest-")
    os.makedirs(f"{root}/raw/troi")
    spark.createDataFrame([(7, "Doe, Jane", "j@x"), (9, "Doe, Jane", "k@x")], "id long, troi_name string, email string").write.parquet(f"{root}/mapping")
    with open(f"{root}/raw/troi/export_2024-01-31.csv", "w") as f:
        f.write('Arbeitszeit;Pausenzeiten;Monat\n"08;00";"say ""hi""";Doe, Jane\n;;2024-01-30 00:00:00\n')
    _ingest(spark, root)
    rows = spark.read.parquet(f"{root}/clean/troi").collect()
    assert sorted((r.Monat, r.id) for r in rows) == [("", "7"), ("", "9"), ("2024-01-30 00:00:00", "9")]
    assert {(r.Arbeitszeit, r.Pausenzeiten) for r in rows} == {("08;00", 'say "hi"'), (None, None)}
    for name, text in (("export_2024-02-01.xlsx", "x"), ("export_2024-02-02.csv", "Monat;Arbeitszeit;Neu\n"), ("export_2024-02-03.csv", "Monat\n")):
        with open(f"{root}/raw/troi/{name}", "w") as f:
            f.write(text)
        with pytest.raises(Exception, match="cannot be read"):
            _ingest(spark, root)
        os.remove(f"{root}/raw/troi/{name}")
    d = spark.range(1).select(date_from_name(F.lit("raw/troi/export_2024-01-31.csv")).alias("d")).first().d
    assert d == "2024-02-01 00:00:00"


def test_available_now_ingest_runs_once(spark):
    root = tempfile.mkdtemp(prefix="ingest-")
    os.makedirs(f"{root}/raw/troi")
    spark.createDataFrame([(7, "Doe, Jane", "j@x"), (8, "Roe, Rick", "r@x")],
                          "id long, troi_name string, email string").write.parquet(f"{root}/mapping")
    _write(f"{root}/raw/troi/export_2024-01-31.csv", [
        ("Doe, Jane", "", ""),
        ("2024-01-30 00:00:00", "08:00", '"12:00 - 12:30\n15:00 - 15:10"'),
        ("2024-01-31 00:00:00", "07:30", ""),
        ("Unknown, Person", "", ""),
        ("2024-01-31 00:00:00", "06:00", ""),
    ])
    conf = ExportConf(name="troi", root=root, checkpoint=f"{root}/_ckpt", columns=HEADER, left_col="Monat",
                      right_col="troi_name", mapping_path=f"{root}/mapping", fill_down_col="id",
                      filter_col="Monat")
    start_ingest(spark, conf).awaitTermination()
    clean = spark.read.parquet(f"{root}/clean/troi").collect()
    ids = sorted((r.Monat, r.id) for r in clean)
    assert ("", "7") in ids and ("Unknown, Person", "0") in ids
    assert ("2024-01-30 00:00:00", "7") in ids and ("2024-01-31 00:00:00", "0") in ids
    assert all("troi_name" not in r.asDict() and "email" not in r.asDict() for r in clean)
    processed = spark.read.parquet(f"{root}/processed/troi")
    assert processed.count() == 3               # day rows strictly before 2024-02-01
    # a second run with no new file processes nothing
    start_ingest(spark, conf).awaitTermination()
    assert spark.read.parquet(f"{root}/processed/troi").count() == 3


MEAL_HEADER = ["Abrechnungsmonat", "Datum", "Lunchit_1_2", "Personalnummer", "E-Mail-Adresse"]


def test_meal_export_config_and_guard(spark):
    root = tempfile.mkdtemp(prefix="ingest-meal-")
    os.makedirs(f"{root}/raw/lunchit")
    spark.createDataFrame([(7, "Doe, Jane", "jane@x.test")], "id long, troi_name string, email string") \
        .write.parquet(f"{root}/mapping")
    with open(f"{root}/raw/lunchit/export_2024-02-01.csv", "w") as f:
        f.write(";".join(MEAL_HEADER) + "\n")
        f.write("01.02.2024;15.01.2024;3,10;P-1;jane@x.test\n")
        f.write("01.02.2024;16.01.2024;2,00;P-2;nobody@x.test\n")
    with open(f"{root}/raw/lunchit/export_2024-02-02.csv", "w") as f:   # already clean: skipped
        f.write("Abrechnungsmonat;Datum;Lunchit_1_2;id\n01.02.2024;17.01.2024;1,00;7\n")
    conf = ExportConf(name="lunchit", root=root, checkpoint=f"{root}/_ckpt", columns=MEAL_HEADER,
                      left_col="E-Mail-Adresse", right_col="email", mapping_path=f"{root}/mapping",
                      del_cols=["Personalnummer", "E-Mail-Adresse"])
    start_ingest(spark, conf).awaitTermination()
    out = spark.read.parquet(f"{root}/processed/lunchit").collect()
    assert sorted((r.Datum, r.id) for r in out) == [("15.01.2024", "7"), ("16.01.2024", None)]
    assert all("E-Mail-Adresse" not in r.asDict() and "Personalnummer" not in r.asDict() for r in out)


def test_choice_options(spark):
    from staffhouse.sources.readers import choice_options
    df = spark.createDataFrame(
        [(1, "Size", [(10, "S", "s", True), (11, "M", "m", False)]), (2, "Free", [])],
        "id long, label string, choice_options array<struct<id:long,label:string,value:string,is_active:boolean>>")
    rows = sorted(tuple(r) for r in choice_options(df).collect())
    assert rows == [(1, "Size", 10, "S", "s", True), (1, "Size", 11, "M", "m", False)]


def test_write_delimited_roundtrip(spark):
    from staffhouse.sources.readers import read_export
    from staffhouse.sources.sinks import write_delimited
    d = tempfile.mkdtemp(prefix="sink-")
    df = spark.createDataFrame([("a", "1,5"), ("b", "2")], "x string, y string")
    write_delimited(df, f"{d}/out.csv")
    back = read_export(spark, f"{d}/out.csv")
    assert sorted(tuple(r) for r in back.collect()) == [("a", "1,5"), ("b", "2")]
