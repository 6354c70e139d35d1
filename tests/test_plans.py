"""Physical plans: no table product, no single-task sort of rows, no broadcast that grows with the data."""

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tidemark.config import ORDERS_AS_OF, TEST_THRESHOLDS
from tidemark.functions.frames import rank_global
from tidemark.plans import bi, views
from tidemark.sources.tables import load_mirror


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return load_mirror(spark, DATA)


@pytest.mark.parametrize("build", [views.business_kpi, bi.exec_kpi, bi.business_summary])
def test_kpis_never_join_tables(tables, build):
    text = plan(build(tables, ORDERS_AS_OF, TEST_THRESHOLDS))
    assert "NestedLoop" not in text and "Cartesian" not in text and "SortMergeJoin" not in text


def test_no_cross_joins_anywhere(spark):
    """Uncorrelated values come in as scalar subqueries."""
    import __spark_entry__ as entry
    from tidemark.registry import QUERIES
    for name, run in entry.queries().items():
        if name not in QUERIES:
            continue
        text = plan(run(spark, DATA))
        assert "NestedLoop" not in text and "Cartesian" not in text, name


def test_rank_windows_are_bucketed(spark, tables):
    text = plan(rank_global(tables["SalesOrderHeader"].select("SalesOrderID", "SubTotal"), "SubTotal", "r"))
    windows = [line for line in text.splitlines() if "Window [" in line]
    # one window per bucket of values, and one over the bucket sizes
    assert any("bucket" in w.split("windowspecdefinition(")[1].split(",")[0] for w in windows)
    single = [i for i, line in enumerate(text.splitlines()) if "Exchange SinglePartition" in line]
    for i in single:  # only aggregates meet in one task
        assert any("HashAggregate" in line or "ObjectHashAggregate" in line or "Limit" in line or "TakeOrdered" in line
                   for line in text.splitlines()[i + 1:i + 3])


def test_lines_are_reduced_before_the_join(tables):
    text = plan(views.order_analysis(tables, ORDERS_AS_OF, TEST_THRESHOLDS)).splitlines()
    scan = next(i for i, line in enumerate(text) if "l_orderkey" in line and "FileScan" in line)
    above = "\n".join(text[max(0, scan - 6):scan])
    assert "HashAggregate(keys=[SalesOrderID" in above  # partial aggregation sits on the scan


def test_scans_read_only_needed_columns(tables):
    text = plan(views.customer_360(tables, ORDERS_AS_OF, TEST_THRESHOLDS))
    orders = next(line for line in text.splitlines() if "FileScan" in line and "o_custkey" in line)
    assert "o_orderpriority" not in orders and "o_orderstatus" not in orders


def test_date_range_reaches_the_scan(tables):
    text = plan(bi.daily_sales(tables, ORDERS_AS_OF, TEST_THRESHOLDS))
    assert "GreaterThanOrEqual(o_orderdate" in text


def test_filter_on_status_needs_no_shuffle(tables):
    df = tables["SalesOrderHeader"].filter(F.col("Status") == 5).select("SalesOrderID")
    assert "Exchange" not in plan(df)
