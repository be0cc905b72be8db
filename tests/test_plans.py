"""Plan properties the scale design relies on."""
import contextlib
import io
import re

from pyspark.sql import functions as F

from staffhouse.operators import quality as Q
from staffhouse.plans import catalog as C
from staffhouse.plans import marts as M

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_series_of_contracts_are_neither_grouped_nor_sorted(spark):
    txt = _plan(C.Lineage(spark, SF).salary)
    assert "SortAggregate" not in txt
    # pieces of spans are rebalanced, to as many partitions as AQE finds right
    assert re.search(r"Exchange hashpartitioning\(contract_id#\d+L?, _from#\d+, \d+\), REBALANCE_PARTITIONS_BY_COL", txt)
    assert "REPARTITION_BY_NUM" not in txt


def test_benefits_have_no_window_by_id_over_all_rows(spark):
    txt = _plan(C.q_benefit_months(spark, SF))
    assert "SortAggregate" not in txt
    # the only window is that over rows which share taxonomy, person and amount with others
    assert re.search(r"row_number\(\) windowspecdefinition\(contracts_taxonomy_id#", txt) and not re.search(r"windowspecdefinition\(id#", txt)


def test_payments_broadcasts_only_the_averages(spark):
    union = spark.createDataFrame([], "factorial_id bigint, amount double, date date, type string, name string")
    averages = spark.createDataFrame([], "month date, type string, average_amount decimal(20,2)")
    txt = _plan(M.fct_payments(union, averages))
    assert txt.count("BroadcastHashJoin") == 1 and txt.count("Scan") == 2
    assert "Window" not in txt and "Aggregate" not in txt          # the union is read once and not grouped


def test_the_suite_scans_a_table_once(spark):
    df = spark.read.parquet(f"{SF}/customer.parquet")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    checks = Q.TableChecks(not_null=["c_name"], unique=["c_custkey", "c_name", "c_mktsegment"], accepted={"c_nationkey": [1, 2]})
    txt = _plan(Q.run_checks({"customer": (df, checks), "orders": (orders, Q.TableChecks(foreign_keys=[("o_custkey", df, "c_custkey", "customer")]))}))
    assert txt.count("FileScan parquet") == 2 and txt.count("HashAggregate") == 4 and "SortAggregate" not in txt


def test_no_single_partition_and_no_sorted_deduplication(spark):
    assert "SinglePartition" not in _plan(C.q_fill_down(spark, SF))
    assert "RoundRobin" not in _plan(C.q_fill_down(spark, SF))


def test_scan_pruning_and_pushdown(spark):
    lin = C.Lineage(spark, SF)
    txt = _plan(lin.t("customer").where(F.col("c_nationkey") == 3).select("c_custkey"))
    assert "PushedFilters: [IsNotNull(c_nationkey), EqualTo(c_nationkey,3)]" in txt
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in txt
