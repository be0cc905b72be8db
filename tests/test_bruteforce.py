"""Skew-safe rewrites checked against plain windows / brute force on random data
with many ties and one hot key."""
import calendar
import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from staffhouse.operators import intervals as I
from staffhouse.operators import relational as R

D0 = dt.date(2023, 12, 1)


def _rows(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rnd.random() < 0.4 else rnd.randint(1, 8)        # key 0 is hot
        rows.append((key, i, D0 + dt.timedelta(days=rnd.randint(0, 60)), rnd.choice([None, 0.0, 0.5, 1.0])))
    return rows


def test_next_in_order_equals_lead(spark):
    df = spark.createDataFrame(_rows(1), "k int, id int, d date, m double")
    w = Window.partitionBy("k").orderBy("d", "id")
    plain = {r.id: r.nxt for r in df.withColumn("nxt", F.lead("d").over(w)).collect()}
    fast = {r.id: r.nxt for r in I.next_in_order(df, "k", "d", "id", "nxt").collect()}
    assert plain == fast


def _islands_brute(rows):
    by = {}
    for k, _i, d, m in rows:
        if d.isoweekday() > 5:
            m = 1.0
        if m is not None:
            by.setdefault(k, []).append(d)
    out = []
    for k, ds in by.items():
        ds.sort()
        ranks, groups = {}, {}
        for pos, d in enumerate(ds):
            ranks.setdefault(d, pos + 1)
        for d in ds:
            g = d - dt.timedelta(days=ranks[d])
            groups.setdefault(g, []).append(d)
        for members in groups.values():
            s, e = min(members), max(members)
            days = 1 + (e - s).days - sum(1 for d in members if d.isoweekday() > 5)
            if days <= 0:
                continue
            s2 = s + dt.timedelta(days={6: 2, 7: 1}.get(s.isoweekday(), 0))
            e2 = e - dt.timedelta(days={6: 1, 7: 2}.get(e.isoweekday(), 0))
            out.append((s2, e2, days, k))
    return sorted(out)


def test_business_day_islands_brute_force(spark):
    rows = _rows(2)
    df = spark.createDataFrame(rows, "k int, id int, d date, m double")
    got = sorted(tuple(r) for r in I.business_day_islands(df, "k", "d", "m").collect())
    assert got == _islands_brute(rows)


def test_month_step_matches_iterated_addition(spark):
    starts = [dt.date(y, m, d) for y in (2023, 2024) for m in range(1, 13) for d in (1, 15, 28, 29, 30, 31)
              if d <= calendar.monthrange(y, m)[1]]
    df = spark.createDataFrame([(s, dt.date(2027, 3, 31)) for s in starts], "s date, e date")
    got = {}
    for r in R.month_series(df, "s", "e", "m").collect():
        got.setdefault(r.s, []).append(r.m)

    def add_month(d):
        y, m = (d.year + 1, 1) if d.month == 12 else (d.year, d.month + 1)
        return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))

    for s in starts:
        exp, d = [], s
        while d <= dt.date(2027, 3, 31):
            exp.append(d)
            d = add_month(d)
        assert sorted(got[s]) == exp, s


def _span_rows(seed, n=300):
    rnd = random.Random(seed)
    day = lambda: dt.date(2021, 1, 1) + dt.timedelta(days=rnd.randint(0, 900))
    return [(i, rnd.choice([None, 1, 1, 1, 2, 3, 4]), rnd.choice(["a", "b"]), rnd.choice([None, 0.1, 2.675, 100.0, -3.5, round(rnd.random() * 99, 3), round(rnd.random() * 99, 3)]), day(), rnd.choice([None, day(), day()])) for i in range(n)]


def test_distinct_series_equals_generating_all_rows(spark):
    for seed in (1, 2):
        rows = _span_rows(seed)
        rows += [(*r[:3], r[3], r[4], r[5]) for r in rows[:40]]         # whole repeats
        df = spark.createDataFrame(rows, "id bigint, person bigint, kind string, amount double, s date, e date")
        single, several = R.distinct_series(df, "s", "e", ["person", "kind", "amount"], ["id", "s", "e"], "date")
        got = R.month_series(single, "s", "e", "date", spread_by=["id"]).unionByName(several)
        w = Window.partitionBy("person", "kind", "amount", "date").orderBy("id", "s", "e")
        plain = R.month_series(df, "s", "e", "date").withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
        as_text = lambda d: sorted(str(tuple(r)) for r in d.select("id", "person", "kind", "amount", "s", "e", "date").collect())
        assert as_text(got) == as_text(plain)
        assert several.count() > 50 and single.count() > 5


def test_only_series_of_the_same_day_are_deduplicated(spark):
    """rows of one key that start on other days of the month never meet; days after the 28th may."""
    day = dt.date
    rows = [(1, "a", day(2021, 1, 5), day(2021, 6, 30)), (2, "a", day(2021, 2, 6), day(2021, 6, 30)), (3, "a", day(2021, 1, 31), day(2021, 6, 30)),
            (4, "b", day(2021, 1, 5), day(2021, 3, 31)), (5, "b", day(2020, 12, 5), day(2021, 2, 28)), (6, "c", day(2021, 1, 31), day(2021, 5, 31)),
            (7, "c", day(2021, 3, 28), day(2021, 6, 30)), (8, "c", day(2020, 1, 29), day(2021, 3, 31)), (9, "d", day(2021, 3, 9), day(2021, 2, 9)),
            (10, "d", day(2021, 1, 9), day(2021, 2, 9)), (11, None, day(2021, 1, 9), day(2021, 2, 9)), (12, None, day(2021, 2, 9), day(2021, 2, 9)), (13, "e", None, day(2021, 2, 9)), (14, "e", None, None)]
    df = spark.createDataFrame(rows, "id bigint, k string, s date, e date")
    single, several = R.distinct_series(df, "s", "e", ["k"], ["id", "s", "e"], "date")
    assert {r.id for r in R.month_series(single, "s", "e", "date").collect()} == {1, 2, 3, 10} and {r.id for r in several.collect()} == {4, 5, 6, 7, 8, 11}
    got = R.month_series(single, "s", "e", "date").unionByName(several)
    first = R.month_series(df, "s", "e", "date").withColumn("rn", F.row_number().over(Window.partitionBy("k", "date").orderBy("id", "s", "e"))).where("rn = 1").drop("rn")
    assert sorted(map(str, got.collect())) == sorted(map(str, first.collect()))


def test_span_averages_equal_averages_of_generated_rows(spark):
    df = spark.createDataFrame(_span_rows(5), "id bigint, person bigint, kind string, amount double, s date, e date")
    spans = R.month_span(df, "s", "e")
    got = {(r.kind, r.month): r.average_amount for r in I.span_averages(spans, "kind", "person", "amount").collect()}
    paid = {}
    for r in R.month_series(df, "s", "e", "date").collect():
        paid.setdefault((r.kind, r.date.replace(day=1)), {}).setdefault(r.person, []).append(r.amount)
    want = {}
    for key, people in paid.items():
        amounts = [Decimal(str(a)) for own in people.values() for a in own if a is not None]
        want[key] = (sum(amounts) / len(people)).quantize(Decimal("0.01"), ROUND_HALF_UP) if amounts else None
    assert got == want and len(want) > 40


def test_long_spans_are_cut_into_pieces(spark):
    df = spark.createDataFrame([(1, dt.date(1, 1, 31), dt.date(9999, 12, 31)), (2, dt.date(2000, 1, 1), dt.date(1999, 1, 1)), (3, None, dt.date(1999, 1, 1))], "id int, s date, e date")
    whole, cut = R.month_series(df, "s", "e", "m"), R.month_series(df, "s", "e", "m", spread_by=["id"])
    assert cut.count() == 9999 * 12 and whole.exceptAll(cut).count() == 0
    # AQE is free to deal the pieces to tasks: the span is no longer one task's
    with_conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in with_conf.items():
        spark.conf.set(k, v)
    try:
        shares = [r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k in with_conf:
            spark.conf.unset(k)
    assert len(shares) > 1 and max(shares) < 0.6 * sum(shares)


def test_row_numbers_and_fill_down_with_one_hot_key(spark):
    rnd = random.Random(9)
    rows = [(7, i, rnd.choice([None, None, None, "", "x", "y"]) if i > 50 else None) for i in range(20_000)]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "k int, line int, v string").repartition(8)
    numbered, total = R.row_numbers(df, ["k", "line"])
    assert total == len(rows)
    assert numbered.where("line <> _rn").count() == 0
    # ranges of the whole order: the one key is over all tasks
    shares = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
    assert len(shares) > 1 or spark.conf.get("spark.sql.shuffle.partitions") == "1" or numbered.rdd.getNumPartitions() == 1
    got = {r.line: r.v for r in R.fill_down(df, "v", ["k", "line"], block_rows=512).collect()}
    last, want = None, {}
    for _, i, v in rows:
        last = v if v is not None else last
        want[i] = last
    assert got == want


def test_a_series_is_marked_once_for_all_its_readers(spark):
    """What a de-duplicated series is made of is written once, and payments and averages read that."""
    from staffhouse.plans import marts as M
    filled = spark.createDataFrame([(1, 7, 100, dt.date(2021, 1, 31), dt.date(2021, 3, 31)), (1, 8, 90, dt.date(2021, 2, 1), dt.date(2021, 4, 1)), (2, 7, 50, dt.date(2021, 2, 1), dt.date(2021, 1, 1))],
                                   "contract_id bigint, employee_id bigint, salary_amount bigint, date date, end_date date")
    names = []

    def stage(df, name):
        names.append(name)
        return spark.createDataFrame(df.collect(), df.schema)
    series = M.salary_series(filled, stage)
    assert names == ["salary_tagged", "salary_several"]
    got = M.salary_payment(filled, series)
    assert sorted((r.factorial_id, r.contract_id, r.amount, str(r.date)) for r in got.collect()) == [
        (7, 1, 100, "2021-01-31"), (7, 1, 100, "2021-02-28"), (7, 1, 100, "2021-03-28"), (8, 1, 90, "2021-02-01"), (8, 1, 90, "2021-03-01"), (8, 1, 90, "2021-04-01")]
    assert names == ["salary_tagged", "salary_several"]


def test_amounts_of_equal_spans_are_added_up_exactly(spark):
    """spans of the same months are one before their ends are made; the sum keeps eight decimals and ends after the span."""
    month = lambda m: dt.date(2021, m, 1)
    rows = [("a", i % 3, x, month(1), month(2)) for i, x in enumerate([0.00000001, 10.0 ** 9, 2.5, None, 0.1, 0.2])] + [("a", 9, None, month(4), month(4)), ("a", 9, 1.0, month(6), month(5))]
    spans = spark.createDataFrame(rows, "kind string, person bigint, amount double, first_month date, last_month date")
    got = {r.month: r.average_amount for r in I.span_averages(spans, "kind", "person", "amount").collect()}
    mean = (Decimal("1000000002.80000001") / 3).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert got == {month(1): mean, month(2): mean, month(4): None}
