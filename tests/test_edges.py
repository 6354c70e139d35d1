"""Hand-written scenario and edge cases."""

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import NOW
from pyspark.sql import functions as F

from tidemark.functions.frames import date_dim
from tidemark.operators import audit, changes, monitor, softdelete
from tidemark.plans import bi, views
from tidemark.sources.tables import load_mirror, snapshot, table_inventory


def rows(df, key):
    return {r[key]: r for r in df.collect()}


def test_scenario_totals(demo):
    heads = rows(bi.order_headers(demo, NOW), "SalesOrderID")
    assert [heads[i].CalculatedTotal for i in (1, 2, 3)] == [Decimal("281.23"), Decimal("992.49"), Decimal("673.82")]
    gaps = rows(audit.reconcile_header_detail(demo), "SalesOrderID")
    assert gaps[3].LineSum == Decimal("812.348500") and gaps[3].Reconciliation == "SMALL_GAP"
    assert gaps[1].Reconciliation == gaps[2].Reconciliation == "MATCH"


def test_scenario_updates_and_deletes(demo):
    goods = demo["Product"]
    for factor, cond in (("0.75", F.col("ProductID") == 1), ("0.85", F.col("ProductCategoryID") == 4)):
        goods = changes.update_where(goods, cond, {"ListPrice": F.col("ListPrice") * F.lit(Decimal(factor))}, NOW)
    assert goods.filter("ProductID = 1").first().ListPrice == Decimal("127.4936")  # 199.99 * 0.75 = 149.9925, * 0.85
    gone = goods.filter(F.col("ProductID").isin(1, 3, 5)).select("ProductID")
    goods = changes.soft_delete(goods, gone, "ProductID", NOW, "ops")
    assert sorted(r.ProductID for r in goods.filter("IsDeleted").collect()) == [1, 3, 5]
    assert changes.active_view(goods).count() == 2 and "IsDeleted" not in changes.active_view(goods).columns
    assert goods.count() == 5
    kept = softdelete.soft_delete_summary({**demo, "Product": goods})
    assert rows(kept, "TableName")["Product"].DeletedRecords == 3


def test_customer_whose_only_order_is_deleted(demo):
    keys = demo["SalesOrderHeader"].filter("SalesOrderID = 1").select("SalesOrderID")
    t = {**demo, "SalesOrderHeader": changes.soft_delete(demo["SalesOrderHeader"], keys, "SalesOrderID", NOW, "ops")}
    row = rows(views.customer_360(t, NOW), "CustomerID")[1]
    assert (row.TotalOrders, row.CustomerSegment, row.LastOrderDate, row.AverageOrderValue) == (0, "Prospect", NOW, 0.0)
    assert rows(views.customer_summary(t, NOW), "CustomerID")[1].TotalOrders == 1
    assert rows(views.order_analysis(t, NOW), "SalesOrderID")[1].OrderStatus == "CANCELLED"
    sold = rows(views.product_performance(t, NOW), "ProductID")[1]
    assert (sold.TimesSold, sold.LastSaleDate) == (1, sold.SellStartDate)  # the line counts, its date does not
    assert rows(views.product_performance(t, NOW, active_only=True), "ProductID")[1].TimesSold == 0


def test_default_thresholds(demo):
    out = rows(views.customer_360(demo, NOW), "CustomerID")
    assert [out[i].CustomerSegment for i in (1, 2, 3)] == ["Basic", "Standard", "Standard"]
    assert out[2].FullName == "Dee Eck" and out[2].CustomerType == "B2C"


def test_zero_cost_has_no_margin(demo):
    t = {**demo, "Product": demo["Product"].withColumn("StandardCost", F.lit(0).cast("decimal(19,4)"))}
    assert {float(r.ProfitMarginPercent) for r in views.product_performance(t, NOW).collect()} == {0.0}


def test_category_without_products(demo):
    got = rows(views.category_performance(demo, NOW), "CategoryName")["Empty"]
    assert (got.TotalProducts, got.ActiveProducts, got.MinPrice, got.TotalUnitsSold) == (0, 1, None, 0)
    fixed = rows(views.category_performance(demo, NOW, fanout="corrected"), "CategoryName")["Empty"]
    assert fixed.ActiveProducts == 0


def test_single_month_trend_is_negative(demo):
    got = bi.sales_performance(demo, NOW).collect()
    assert len(got) == 1 and got[0].MoM_Trend == "Negative" and got[0].MoM_Growth_Percent is None
    assert got[0].YTD_Revenue == got[0].TotalRevenue


@pytest.mark.parametrize("empty", [["Customer"], ["SalesOrderHeader"], ["Product"], ["Customer", "SalesOrderHeader"],
                                   ["Customer", "SalesOrderHeader", "Product"]])
def test_kpi_with_empty_tables(demo, empty):
    """Sides of the table product may be empty; compared with the literal joins."""
    t = {**demo, **{n: demo[n].limit(0) for n in empty}}
    got = views.business_kpi(t, NOW).first()
    c = t["Customer"].select(F.col("CustomerID").alias("c"))
    o = t["SalesOrderHeader"].select(F.col("CustomerID").alias("oc"), "SalesOrderID", "OrderDate", "IsDeleted",
                                     (F.col("SubTotal") + F.col("TaxAmt") + F.col("Freight")).alias("due"))
    p = t["Product"].select(F.col("ProductID").alias("p"))
    both = c.join(o, F.col("c") == F.col("oc"), "full_outer").join(p, F.lit(True), "full_outer")
    recent = (F.col("OrderDate") >= "2025-06-01") & ~F.col("IsDeleted")
    want = both.agg(F.sum("due").alias("total"), F.sum(F.when(recent, F.col("due")).otherwise(0)).alias("r"),
                    F.count_distinct("c").alias("c"), F.count_distinct("p").alias("p"), F.avg("due").alias("a")).first()
    assert (got.TotalRevenue, got.Revenue_Last30Days, got.TotalCustomers, got.TotalProducts) == (want.total, want.r, want.c, want.p)
    assert (got.AverageOrderValue is None) == (want.a is None)
    if want.a is not None:
        assert abs(got.AverageOrderValue - float(want.a)) < 1e-3


def test_blank_and_null_email(demo):
    got = rows(views.data_quality(demo, NOW), "TableName")["Customer"]
    assert (got.MissingEmailRecords, got.MissingPhoneRecords, got.TotalRecords) == (2, 1, 3)


def test_calendar_has_no_length_limit(spark):
    days = date_dim(spark, datetime(2000, 1, 1).date(), datetime(2025, 6, 30))
    assert days.count() == 9678 and days.agg(F.max("Date")).first()[0] == datetime(2026, 6, 30).date()
    saturday = days.filter("Date = DATE'2000-01-01'").first()
    assert (saturday.WeekOfYear, saturday.WeekdayName, saturday.WeekdayNumber) == (1, "Saturday", 7)


def test_reconcile_finds_each_difference(demo):
    mirror = demo["Customer"].filter("CustomerID < 3").withColumn(
        "Phone", F.when(F.col("CustomerID") == 2, "new").otherwise(F.col("Phone"))).unionByName(
        demo["Customer"].filter("CustomerID = 1").withColumn("CustomerID", F.lit(9).cast("long")))
    got = monitor.reconcile(demo["Customer"], mirror, "CustomerID").first()
    assert (got.SourceRows, got.MirrorRows, got.MissingRows, got.ExtraRows, got.ChangedRows) == (3, 3, 1, 1, 1)
    assert monitor.reconcile(demo["Customer"], demo["Customer"], "CustomerID").first().InSync


def facts(spark, **over):
    base = dict(TotalTables=5, EnabledTables=5, FailingTables=0, LongSessions=0, BlockedEvents=0, UsedPercent=10.0)
    base.update(over)
    return spark.createDataFrame([tuple(base.values())], list(base))


@pytest.mark.parametrize("over,score,status,advice", [
    ({}, 100, "EXCELLENT", "Mirroring is healthy"),
    ({"EnabledTables": 4}, 94, "EXCELLENT", "Configure more tables for mirroring"),
    ({"FailingTables": 1}, 80, "GOOD", "Resolve Change Feed exceptions"),
    ({"UsedPercent": 80.0}, 90, "EXCELLENT", "Monitor transaction log space"),
    ({"EnabledTables": 0, "FailingTables": 1, "UsedPercent": 80.0}, 0, "CRITICAL", "Enable Change Feed for mirroring")])
def test_health(spark, over, score, status, advice):
    got = monitor.health_score(facts(spark, **over)).first()
    assert (got.TotalHealthScore, got.HealthStatus, got.PrimaryRecommendation) == (score, status, advice)


def test_alerts(spark):
    calm = monitor.alerts(facts(spark)).collect()
    assert [(a.Priority, a.Category, a.ActionTimeline) for a in calm] == [(1, "INFO", "For information only")]
    busy = monitor.alerts(facts(spark, EnabledTables=0, UsedPercent=80.0, BlockedEvents=2)).collect()
    assert [(a.Priority, a.Category) for a in busy] == [(1, "CRITICAL"), (3, "MEDIUM"), (5, "LOW")]


def test_metric_rollup_without_samples_gives_no_row(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), "click", 1.0)], "ts timestamp, event_type string, value double")
    assert monitor.metric_rollup(df, datetime(2024, 2, 1), {"click": "cpu"}).count() == 0
    assert monitor.metric_rollup(df, datetime(2024, 1, 1, 1), {"click": "cpu"}).first().max_cpu == Decimal("1.00")


def test_usage_bands(spark):
    df = spark.createDataFrame([(95.0, 100.0), (80.0, 100.0), (60.0, 100.0), (10.0, 100.0)], "u double, t double")
    got = monitor.usage_bands(df, F.col("u"), F.col("t")).collect()
    assert [r.HealthStatus for r in got] == ["CRITICAL", "WARNING", "CAUTION", "HEALTHY"]


def test_purge_follows_links_to_the_last_step(demo):
    kept = changes.purge(demo, {"Customer": F.col("CustomerID") == 3}, [
        ("SalesOrderDetail", "SalesOrderHeader", "SalesOrderID"), ("SalesOrderHeader", "Customer", "CustomerID"),
        ("CustomerAddress", "Customer", "CustomerID")])
    assert {n: df.count() for n, df in kept.items()} == {
        "Customer": 2, "Product": 5, "ProductCategory": 5, "ProductModel": 5, "SalesOrderHeader": 2, "SalesOrderDetail": 3,
        "CustomerAddress": 1}


def test_truncate_binary(spark):
    df = spark.createDataFrame([(1, b"x" * 10), (2, b"y" * 3)], "id int, body binary")
    got = rows(audit.truncate_binary(df, "body", 4), "id")
    assert (len(got[1].body), got[1].OriginalBytes, got[1].Truncated, got[2].Truncated) == (4, 10, True, False)


def test_convert_counts_rejects(spark):
    out, rejects = audit.convert(spark.createDataFrame([("1",), ("x",), (None,)], "v string"), {"v": "int"})
    assert [r.v for r in out.collect()] == [1, None, None] and rejects.first().RejectedRows == 1


def test_key_audit(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    got = audit.key_audit(df, ["k"], "t").first()
    assert (got.Rows, got.NullKeys, got.DuplicateKeys, got.SurplusRows, got.Issue) == (4, 1, 1, 1, "Missing Primary Key")
    assert audit.key_audit(df.limit(0), ["k"], "t").first().Issue == "OK"


def test_snapshot_and_views(spark, demo, fresh):
    snapshot(demo, fresh)
    back = {n: spark.read.schema(df.schema).parquet(f"{fresh}/{n}") for n, df in demo.items()}
    assert {r.TableName: r.RowCount for r in table_inventory(back).collect()} == {n: df.count() for n, df in demo.items()}
    names = views.deploy_views(back, NOW)
    assert spark.table("CustomerLifetimeValue").count() == 3 and len(names) == 9
    for n in [*names, *back]:
        spark.catalog.dropTempView(n)


def test_schemas_are_declared(spark):
    from conftest import DATA
    from tidemark.sources.schemas import MONEY
    t = load_mirror(spark, DATA)
    assert t["SalesOrderHeader"].schema["SubTotal"].dataType == MONEY
    assert t["SalesOrderDetail"].schema["UnitPrice"].dataType == MONEY


def test_reconcile_sees_moved_values_null_and_repeated_keys(spark):
    schema = "k long, a string, b string"

    def counts(left, right, key="k"):
        r = monitor.reconcile(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), key).first()
        return r.SourceRows, r.MirrorRows, r.MissingRows, r.ExtraRows, r.ChangedRows, r.InSync

    assert counts([(1, None, "x")], [(1, "x", None)]) == (1, 1, 0, 0, 1, False)
    assert counts([(None, "a", "b")], [(None, "a", "b")]) == (1, 1, 0, 0, 0, True)
    assert counts([(1, "a", None), (1, "a", None)], [(1, "a", None), (1, "a", None)]) == (2, 2, 0, 0, 0, True)
    assert counts([(1, "a", None), (1, "b", None)], [(1, "a", None), (1, "c", None), (1, "d", None)]) == (2, 3, 0, 1, 1, False)
    assert counts([(1, "a", None), (1, "a", None)], [(1, "a", None), (2, "a", None)], None) == (2, 2, 1, 1, 0, False)
    assert counts([], []) == (0, 0, 0, 0, 0, True)


def test_equal_business_keys_get_different_keys(spark):
    from tidemark.operators import changes
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("a", 3), ("c", 4), ("a", 3)], "name string, v long")
    got = changes.assign_keys(rows.withColumn("id", rows.v), spark.createDataFrame([(10,)], "id long"), "id", "name").collect()
    assert sorted((r.id, r.name) for r in got) == [(11, "a"), (12, "a"), (13, "a"), (14, "b"), (15, "c")]


def test_lag_percentiles_are_exact(spark):
    from datetime import datetime, timedelta

    from tidemark.streaming import windows
    start = datetime(2024, 1, 1)
    rows = [("t", start, start + timedelta(seconds=s)) for s in [*range(1, 100), 5000]] + [("u", start, start + timedelta(seconds=7)), ("u", start, None)]
    got = {r.table_name: r for r in windows.replication_lag(spark.createDataFrame(rows, "table_name string, ts timestamp, arrived timestamp")).collect()}
    assert (got["t"].MedianLagSeconds, got["t"].P95LagSeconds, got["t"].MaxLagSeconds, got["t"].Changes) == (50, 95, 5000, 100)
    assert (got["u"].MedianLagSeconds, got["u"].AvgLagSeconds, got["u"].Changes) == (7, 7.0, 2)


def test_scratch_folders_can_be_removed(spark, monkeypatch):
    import os

    from tidemark import config
    monkeypatch.setattr(config, "_MADE", [])  # folders of other tests stay
    kept = config.materialize(spark.range(3), "scratch-test")
    path = config._MADE[0].removeprefix("file://")
    assert kept.count() == 3 and os.path.isdir(path)
    assert config.remove_scratch(spark) == 1 and not os.path.exists(path)
