"""Plan checks: ordered operators never gather a series into one partition,
and SQL-only paths stay in the JVM (no Python evaluation)."""

import pytest

SF = "/root/testdata/sf0.001"
KEYS = ["interpolate_linear", "lag_supervised", "sliding_windows", "split_train_test", "gap_runs",
        "undifference", "ar1_forecast", "daily_forecast", "append_hours_dedup"]


@pytest.mark.parametrize("key", KEYS)
def test_no_single_partition_and_no_python(spark, key):
    import __spark_entry__ as E
    df = E.queries()[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_incremental_scan_pushes_the_mark(spark):
    import __spark_entry__ as E
    plan = E.queries()["incremental_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan
