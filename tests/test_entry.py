import sys
from importlib.util import find_spec

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from staffhouse.plans.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry(spark)
    assert set(df.columns) == {"factorial_id", "amount", "date", "type", "name", "average_amount"}
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


def test_core_queries_do_without_what_the_others_need(monkeypatch):
    if find_spec("staffhouse.llm") is None:
        pytest.skip("the subpackage is not there")
    monkeypatch.setitem(sys.modules, "staffhouse.llm.queries", None)        # its import fails
    with pytest.warns(UserWarning, match="left out"):
        assert set(queries()) == set(QUERIES)
    with pytest.warns(UserWarning, match="left out"):
        assert set(oracle_sql()) == set(ORACLE)


@pytest.mark.parametrize("key", ["salary_months_repeated", "contract_end_dates", "salary_months", "absence_islands", "working_hours",
                                 "custom_pivot", "export_anonymise", "dq_contracts_dim"])
def test_query_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in ["customer", "supplier", "part", "orders", "lineitem", "events"]:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    sdf = queries()[key](spark, SF)
    res = con.execute(oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    srows = sdf.collect()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)

    def canon(cols, rows):
        idx = sorted(range(len(cols)), key=lambda i: cols[i])
        return sorted((tuple(str(r[i]) for i in idx) for r in rows))
    assert canon(sdf.columns, [tuple(r) for r in srows]) == canon(dcols, drows)
