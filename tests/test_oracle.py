"""Spark queries against their DuckDB SQL twins on the sf0.001 tables."""

import pytest

from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
KEYS = ["hourly_mean", "hourly_grid", "interpolate_linear", "lag_supervised", "sliding_windows",
        "split_train_test", "zscore_train", "summary_stats", "gap_runs", "append_hours_dedup",
        "climatology_forecast", "ar1_forecast", "autonomy_test", "daily_forecast", "monthly_refresh"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(spark, con, key):
    import __spark_entry__ as E
    got = E.queries()[key](spark, SF).toPandas()
    exp = con.execute(E.oracle_sql()[key]).df()
    assert compare(got, exp) is None


def test_every_sql_key_has_a_query():
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "run_utc" in df.columns
