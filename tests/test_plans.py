"""Physical plans: native expressions only, map-side reductions, lazy fit."""

import pytest

from cadence.plans.model import fit
from cadence.plans.queries import F1, F2, registry
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry()))
def test_no_python_in_any_plan(spark, name):
    df = registry()[name](spark, SF_SMALL)
    text = plan_text(df)
    assert not any(node in text for node in PYTHON_NODES), name


def test_fit_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    tx = F2.load(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("fit-check", "fit must be lazy")
    model = fit(tx)            # reference date from the data: a scalar subquery, not a collect
    model.predict_long(F2.begin, F2.end)
    assert tracker.getJobIdsForGroup("fit-check") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_last_payments_use_partial_top_k_before_the_shuffle(spark):
    model = fit(F1.load(spark, SF_SMALL), F1.as_of)
    text = plan_text(model.patterns)
    assert "WindowGroupLimit" in text and "Partial" in text


def test_reversals_are_an_anti_join_and_activity_a_semi_join(spark):
    model = fit(F1.load(spark, SF_SMALL), F1.as_of)
    text = model.patterns._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in text
    assert "LeftSemi" in text


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """The rows as a plain parquet table, like a production input."""
    path = str(tmp_path_factory.mktemp("tx") / "transactions.parquet")
    F1.load(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def exchange_keys(df):
    return [line.split("hashpartitioning(")[1] for line in plan_text(df).split("\n") if "Exchange hashpartitioning" in line]


def test_fit_shuffles_the_rows_for_the_join_and_the_day_aggregate(spark, table):
    """Above the reversal join: the day aggregate, and its result by pair; every
    later step of the pattern statistics runs on that partitioning."""
    days = fit(table, F1.as_of).days
    rest = [k for k in exchange_keys(days) if "operation1_id" not in k]
    assert len(rest) == 2 and sum("operation_date" in k for k in rest) == 1, rest
    assert plan_text(days).count("FileScan parquet") == 2      # the rows, and their reversals


def test_row_level_queries_read_the_rows_once(spark, table):
    """The rows, their reversals, and the dates of the activity filter."""
    text = plan_text(fit(table, F1.as_of).active_blocks())
    assert text.count("LeftAnti") == 1 and text.count("FileScan parquet") == 3


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_the_lazy_forecast_evaluates_the_day_groups_once(spark, table, reuse):
    """The raw rows are aggregated to day groups in one place, whatever Spark
    reuses, and the pattern rows are computed once for both calendars."""
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        forecast = fit(table, F1.as_of).forecast(F1.begin, F1.end)
        initial = plan_text(forecast)
        assert initial.count("partial_sum(transaction_amount#") == 1 and "Union" not in initial
        # The rows and their reversals, for the day groups and for the last amounts, and the dates of the activity filter.
        assert initial.count("FileScan parquet") == 5
        forecast.collect()
        assert plan_text(forecast).split("== Initial Plan ==")[0].count("partial_sum(transaction_amount#") == 1
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
        spark.conf.set("spark.sql.debug.maxToStringFields", "25")


def test_the_pattern_rows_are_one_sort_of_the_days(spark, table):
    from cadence.operators import patterns
    days = fit(table, F1.as_of, checkpoint=False).days
    text = plan_text(patterns.pattern_statistics(days, extras=True))
    above = text[:text.index("HashAggregate")]
    assert above.count("Sort [") == 1 and "Exchange" not in above
