"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_check  # noqa: E402

from pricelake.plans import catalog  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_check.duck(SF)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_against_oracle(spark, con, name):
    fn = catalog.QUERIES[name]
    sql = catalog.SQL.get(name)
    if sql is None:
        assert fn(spark, SF).count() >= 1
        return
    res = oracle_check.compare(spark, con, name, fn, sql, SF)
    assert res["ok"], res


def test_entry_smoke(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("conf", [
    {"spark.sql.ansi.enabled": "false", "spark.sql.adaptive.enabled": "false"},
    {"spark.sql.session.timeZone": "America/Los_Angeles"},
])
def test_results_do_not_depend_on_session_settings(spark, con, conf):
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for name in ["stg_prices", "fct_prices", "recent_queries", "hourly_usage", "csv_rejects"]:
            res = oracle_check.compare(spark, con, name, catalog.QUERIES[name],
                                       catalog.SQL[name], SF)
            assert res["ok"], (conf, res)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
