import datetime as dt

from pyspark.sql import Row
from pyspark.sql import Window
from pyspark.sql import functions as F

from staffhouse.operators import intervals as I
from staffhouse.operators import quality as Q
from staffhouse.operators import relational as R

D = dt.date


def test_month_series_drifts_like_the_warehouse(spark):
    df = spark.createDataFrame([(D(2024, 1, 31), D(2024, 6, 30)), (D(2023, 1, 15), D(2023, 3, 15)),
                                (D(2024, 3, 1), D(2024, 2, 1))], "s date, e date")
    rows = R.month_series(df, "s", "e", "m").groupBy("s").agg(F.sort_array(F.collect_list("m")).alias("ms")).collect()
    got = {r.s: r.ms for r in rows}
    assert got[D(2024, 1, 31)] == [D(2024, 1, 31), D(2024, 2, 29), D(2024, 3, 29), D(2024, 4, 29),
                                   D(2024, 5, 29), D(2024, 6, 29)]
    assert got[D(2023, 1, 15)] == [D(2023, 1, 15), D(2023, 2, 15), D(2023, 3, 15)]
    assert D(2024, 3, 1) not in got          # end before start: no rows, no error


def test_first_per_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "z"), (1, 3, "a"), (2, 9, "q")], "k int, o int, v string")
    out = sorted(tuple(r) for r in R.first_per_key(df, ["k"], order=["o"]).collect())
    assert out == [(1, 3, "a"), (2, 9, "q")]


def test_union_relations_by_name(spark):
    a = spark.createDataFrame([(1, 10)], "id bigint, amount bigint")
    b = spark.createDataFrame([(2.5, 2, "x")], "amount double, id bigint, extra string")
    u = R.union_relations({"a": a, "b": b}, source_col="src")
    assert u.columns == ["src", "id", "amount", "extra"]
    assert dict(u.dtypes)["amount"] == "double"
    rows = sorted(tuple(r) for r in u.collect())
    assert rows == [("a", 1, 10.0, None), ("b", 2, 2.5, "x")]
    first = R.union_relations({"a": a, "b": b}, types="first")
    assert dict(first.dtypes)["amount"] == "bigint"


def test_pivot_and_unpivot(spark):
    df = spark.createDataFrame([(1, "Titel", "A"), (1, "Datum", "2024-01-01"), (2, "Titel", "B")],
                               "k int, col_name string, val string")
    p = R.pivot_no_agg(df, ["k"], "col_name", "val", ["Datum", "Titel", "Kosten"])
    assert sorted(tuple(r) for r in p.collect()) == [(1, "2024-01-01", "A", None), (2, None, "B", None)]
    w = spark.createDataFrame([(1, 1.0, 2.0, 3.0, 4.0)], "k int, a double, b double, c double, d double")
    u = R.unpivot_measures(w, ["k"], {"X": ["a", "b"], "Y": ["c", "d"]}, "t", ["h", "m"])
    assert sorted(tuple(r) for r in u.collect()) == [(1, "X", 1.0, 2.0), (1, "Y", 3.0, 4.0)]


def test_explode_drops_null_and_empty(spark):
    df = spark.createDataFrame([(1, [1, None]), (2, []), (3, None)], "t int, ids array<bigint>")
    got = sorted(((r.t, -1 if r.i is None else r.i) for r in R.explode_ids(df, "ids", "i").collect()))
    assert got == [(1, -1), (1, 1)]


def test_fill_down_blocks_equal_plain_window(spark, monkeypatch):
    rows = [(k, str(k) if k % 7 == 0 else None) for k in range(1, 400)]
    rows[10] = (11, "")                       # '' is a value and stops the fill
    df = spark.createDataFrame(rows, "k int, v string").withColumn("g", F.lit(1))
    w = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    plain = {r.k: r.v for r in df.withColumn("v", F.last("v", ignorenulls=True).over(w)).collect()}
    blocked = {r.k: r.v for r in R.fill_down(df, "v", ["k"], F.floor(F.col("k") / 16)).collect()}
    assert plain == blocked
    monkeypatch.setattr(R, "FILL_FANOUT", 3)      # several levels of carries
    monkeypatch.setattr(R, "FILL_LEVELS", 6)
    levels = {r.k: r.v for r in R.fill_down(df, "v", ["k"], F.floor(F.col("k") / 2), ["g"]).collect()}
    assert plain == levels
    assert blocked[12] == "" and blocked[6] is None and blocked[13] == "" and blocked[15] == "14"


def test_next_in_order_handles_ties(spark):
    df = spark.createDataFrame([(1, 1, D(2020, 1, 1)), (1, 2, D(2020, 1, 1)), (1, 3, D(2020, 3, 1)),
                                (2, 4, D(2021, 1, 1))], "emp int, id int, d date")
    got = {r.id: r.nxt for r in I.next_in_order(df, "emp", "d", "id", "nxt").collect()}
    assert got == {1: D(2020, 1, 1), 2: D(2020, 3, 1), 3: None, 4: None}


def test_fill_end_dates_priorities(spark):
    c = spark.createDataFrame([
        Row(id=1, employee_id=1, job_title="a", effective_on=D(2020, 1, 1), ends_on=None, salary_amount=10,
            salary_frequency="monthly", working_hours=40, working_hours_frequency="weekly"),
        Row(id=2, employee_id=1, job_title="a", effective_on=D(2020, 6, 1), ends_on=None, salary_amount=None,
            salary_frequency="monthly", working_hours=40, working_hours_frequency="weekly"),
        Row(id=3, employee_id=1, job_title="a", effective_on=D(2021, 1, 1), ends_on=None, salary_amount=10,
            salary_frequency="monthly", working_hours=40, working_hours_frequency="weekly"),
        Row(id=4, employee_id=2, job_title="b", effective_on=D(2030, 1, 1), ends_on=None, salary_amount=10,
            salary_frequency="monthly", working_hours=40, working_hours_frequency="weekly"),
        Row(id=5, employee_id=3, job_title="b", effective_on=D(2019, 1, 1), ends_on=D(2019, 5, 1), salary_amount=10,
            salary_frequency="monthly", working_hours=40, working_hours_frequency="weekly"),
    ])
    t = spark.createDataFrame([(1, D(2022, 12, 31))], "factorial_id long, termination_date date")
    out = {r.contract_id: r.end_date for r in I.fill_end_dates(c, t, F.lit("2024-01-01").cast("date")).collect()}
    # null-salary version 2 is removed but still closes version 1
    assert out == {1: D(2020, 5, 31), 3: D(2022, 12, 31), 4: D(2031, 1, 1), 5: D(2019, 5, 1)}


def test_business_day_islands(spark):
    # Thu 2024-01-04, Fri 05, Sat 06, Sun 07 (weekend rows present), Mon 08: one spell of 3 business days
    days = [(D(2024, 1, 4), 1.0), (D(2024, 1, 5), 0.5), (D(2024, 1, 6), None), (D(2024, 1, 7), None),
            (D(2024, 1, 8), 0.0), (D(2024, 1, 10), 1.0),
            (D(2024, 1, 13), None), (D(2024, 1, 14), None)]      # weekend only: dropped
    df = spark.createDataFrame([("p", d, m) for d, m in days], "n string, d date, m double")
    out = sorted(tuple(r)[:3] for r in I.business_day_islands(df, "n", "d", "m").collect())
    assert out == [(D(2024, 1, 4), D(2024, 1, 8), 3), (D(2024, 1, 10), D(2024, 1, 10), 1)]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", 5, 3), (1, None, 2, 3), (2, "z", None, 1)], "id int, v string, a int, b int")
    res = {(r.check, r.column): r.violations for r in Q.table_check_counts(
        "t", df, Q.TableChecks(not_null=["v"], unique=["id"], accepted={"v": ["a"]}, pair_ge=[("a", "b")])).collect()}
    assert res == {("not_null", "v"): 1, ("unique", "id"): 1, ("accepted_values", "v"): 1, ("pair_ge", "a>=b"): 1}
    ref = spark.createDataFrame([(1,)], "id int")
    assert Q.foreign_key(df, "id", ref, "id").count() == 1


def test_null_keys_bypass_the_mapping(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "id int, x string")
    m = spark.createDataFrame([(1, "n1"), (1, "n2"), (2, "z"), (None, "never")], "id int, name string")
    got = sorted((r.x, r.name or "") for r in R.map_names(df, m, "id", "name").collect())
    assert got == [("a", "n1"), ("a", "n2"), ("b", ""), ("c", "")]


def test_attributes_map(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", None), (1, "a", "y"), (2, None, "z")], "k int, c string, v string")
    got = {r.k: r.attributes for r in R.attributes_map(df, ["k"], "c", "v").collect()}
    assert got == {1: {"a": "y", "b": None}}


def test_rows_that_no_check_speaks_of_make_no_entries(spark):
    """the condition of the entries is one of the scan, so whole groups of clean rows are skipped there."""
    a = spark.createDataFrame([(1, "x"), (None, "y"), (3, None), (None, None)], "i int, s string")
    checks = Q.TableChecks(not_null=["i", "s"], accepted={"s": ["x"]})
    got = Q.run_checks({"a": (a, checks)})
    assert {(r["check"], r["column"]): r.violations for r in got.collect()} == {("not_null", "i"): 2, ("not_null", "s"): 2, ("accepted_values", "s"): 1}
    plan = a.sparkSession.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = Q.run_checks({"orders": (plan, Q.TableChecks(not_null=["o_custkey", "o_orderdate"]))})._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(IsNull(o_custkey),IsNull(o_orderdate))]" in text


def test_references_compare_whole_numbers_of_any_width_and_text(spark):
    """keys are compared as what they are; where the types differ, as text."""
    from staffhouse.operators import quality as Q
    a = spark.createDataFrame([(1, "1", None), (2, "x", 5), (None, None, 6)], "i int, s string, n bigint")
    b = spark.createDataFrame([(1, 5), (1, 6)], "k bigint, m smallint")
    got = {r["column"]: r.violations for r in Q.run_checks({"a": (a, Q.TableChecks(unique=["i"], foreign_keys=[("i", b, "k", "b"), ("s", b, "k", "b"), ("n", b, "m", "b")]))}).collect()}
    assert got == {"i": 0, "i>b.k": 1, "s>b.k": 1, "n>b.m": 0}
