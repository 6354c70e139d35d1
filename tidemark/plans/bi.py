"""Report queries over the analytics views and the mirrored tables.

Windows without a partition key appear only over frames whose size the calendar or the list of categories bounds
(months, 90 days, statuses). Row-level rankings go through ``rank_global``.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Thresholds, materialize
from tidemark.functions.columns import (
    at, avg_int, band, concat_nullable, datediff_sql, days_old, flag_is, format_n0, half_up, int_div, is_active,
    is_deleted, line_total, mean, pct_change, percent, ratio, shift, total_due,
)
from tidemark.functions.frames import (
    date_dim, quantile_scores, rank_global, rank_many, share_of_total,
)
from tidemark.plans import views
from tidemark.plans.views import customer_type, joined_orders, multiplied, weighted_mean, weighted_sum
from tidemark.sources.tables import Tables

DEFAULTS = Thresholds()


def _count(cond: Column) -> Column:
    return F.count_if(cond)


# --- executive ------------------------------------------------------------------------------------------------------

def exec_kpi(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    """Headline cards. "This month" is the trailing month and "YTD" the trailing year; sums carry the product multiple
    of the underlying table product, ``*_corrected`` columns do not."""
    now = at(as_of)
    m1, m2, y1 = shift(now, months=-1), shift(now, months=-2), shift(now, years=-1)
    live, due, placed = flag_is("IsDeleted", False), F.col("TotalDue"), F.col("OrderDate")
    this, last, year = live & (placed >= m1), live & (placed >= m2) & (placed < m1), live & (placed >= y1)
    gone = flag_is("IsDeleted", True)
    parts = views.kpi_parts(
        tables,
        [F.sum(F.when(this, due)).alias("r1"), F.sum(F.when(last, due)).alias("r2"),
         F.sum(F.when(year, due)).alias("ry"), _count(this).alias("n1"), _count(last).alias("n2"),
         mean(F.when(this, due)).alias("aov")],
        [_count(live & (F.col("ModifiedDate") >= m1)).alias("fresh"), _count(live).alias("live"),
         _count(gone).alias("gone")],
        [_count(live).alias("live"), _count(gone).alias("gone")],
    )
    zero = F.lit(0).cast("decimal(19,4)")
    return parts.select(
        multiplied("r1").alias("Revenue_ThisMonth"), multiplied("r2").alias("Revenue_LastMonth"),
        multiplied("ry").alias("Revenue_YTD"), F.col("n1").alias("Orders_ThisMonth"),
        F.col("n2").alias("Orders_LastMonth"), F.col("c.fresh").alias("NewCustomers_ThisMonth"),
        F.col("c.live").alias("TotalActiveCustomers"), F.col("c.gone").alias("ChurnedCustomers"),
        F.col("p.live").alias("ActiveProducts"), F.col("p.gone").alias("DiscontinuedProducts"),
        F.coalesce(pct_change(F.coalesce("r1", zero), F.col("r2")), F.lit(0)).alias("Revenue_MoM_Growth_Percent"),
        F.col("aov").alias("AOV_ThisMonth"),
        F.coalesce("r1", zero).alias("Revenue_ThisMonth_corrected"),
        F.coalesce("r2", zero).alias("Revenue_LastMonth_corrected"),
        F.coalesce("ry", zero).alias("Revenue_YTD_corrected"),
    )


def monthly_revenue_trend(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS,
                          fanout: str = "reference") -> DataFrame:
    keep = flag_is("IsDeleted", False) & (F.col("OrderDate") >= shift(at(as_of), years=-2))
    month = F.trunc("OrderDate", "month")
    totals = joined_orders(tables, fanout, keep).groupBy(month.alias("MonthYear")).agg(
        weighted_sum("SubTotal").alias("Revenue"), weighted_sum("TaxAmt").alias("Tax"),
        weighted_sum("Freight").alias("Shipping"), weighted_sum("TotalDue").alias("GrandTotal"),
        F.count("*").alias("OrderCount"), F.count_distinct("CustomerID").alias("UniqueCustomers"),
        F.sum("Units").alias("TotalUnits"), weighted_mean("TotalDue").alias("AverageOrderValue"))
    by_month = Window.orderBy("MonthYear")  # at most 25 rows
    return totals.select(
        F.year("MonthYear").alias("OrderYear"), F.month("MonthYear").alias("OrderMonth"), "MonthYear",
        F.date_format("MonthYear", "MMMM yyyy").alias("MonthName"), "Revenue", "Tax", "Shipping", "GrandTotal",
        "OrderCount", "UniqueCustomers", "TotalUnits", "AverageOrderValue",
        ratio(F.col("Revenue"), F.col("TotalUnits")).alias("RevenuePerUnit"),
        F.lag("GrandTotal", 1).over(by_month).alias("PreviousMonthRevenue"),
        F.lag("GrandTotal", 12).over(by_month).alias("SameMonthLastYearRevenue"),
    ).orderBy(F.desc("MonthYear"))


# --- customers ------------------------------------------------------------------------------------------------------

def segment_overview(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    engaged, kind = F.col("EngagementStatus"), F.col("CustomerType")
    segments = views.customer_360(tables, as_of, th).groupBy("CustomerSegment").agg(
        F.count("*").alias("CustomerCount"), F.sum("TotalRevenue").alias("SegmentRevenue"),
        mean("TotalRevenue").alias("AvgRevenuePerCustomer"), avg_int("TotalOrders").alias("AvgOrdersPerCustomer"),
        mean(half_up("AverageOrderValue", 4)).alias("AvgOrderValue"),
        _count(engaged == "ACTIVE").alias("ActiveCustomers"), _count(engaged == "AT_RISK").alias("AtRiskCustomers"),
        _count(engaged == "CHURNED").alias("ChurnedCustomers"),
        _count(kind == "B2B").alias("B2B_Count"), _count(kind == "B2C").alias("B2C_Count"))
    total = F.sum("SegmentRevenue").over(Window.partitionBy())  # at most five segments
    return (segments.withColumn("SegmentRevenuePercent", percent(F.col("SegmentRevenue"), total))
            .orderBy(F.desc("SegmentRevenue")))


def top_customers(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    profile = views.customer_360(tables, as_of, th)
    base = (views.ltv_from(profile).filter(F.col("HistoricalCLV") > 0)
            .join(tables["Customer"].select("CustomerID", "EmailAddress", "Phone",
                                            F.col("ModifiedDate").alias("RegistrationDate")), "CustomerID"))
    stored = materialize(base, "top-customers")
    return (rank_global(stored, "HistoricalCLV", "RevenueRank")
            .drop("CustomerLifespanDays", "AvgDaysBetweenOrders").orderBy(F.desc("PredictedCLV")))


def rfm_base(tables: Tables, as_of: datetime, n: int = 5) -> DataFrame:
    """[Ours] Recency, frequency and money per customer with live orders, each scored 1..n by global rank.

    Customers with equal values share a score; a low recency scores high.
    """
    spend = (tables["SalesOrderHeader"].filter(is_active()).groupBy("CustomerID")
             .agg(F.max("OrderDate").alias("_last"), F.count("*").alias("Frequency"), F.sum("SubTotal").alias("Monetary"))
             .select("CustomerID", days_old("_last", as_of).alias("Recency"), "Frequency",
                     F.col("Monetary").cast("decimal(29,4)").alias("Monetary")))
    scored = quantile_scores(materialize(spend, "rfm"), [
        ("Recency", "R_Score", False), ("Frequency", "F_Score", True), ("Monetary", "M_Score", True)], n, key="CustomerID")
    r, f, m = F.col("R_Score"), F.col("F_Score"), F.col("M_Score")
    label = (F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions").when((f >= 4) & (m >= 3), "Loyal")
             .when((r >= 4) & (f <= 2), "New").when((r <= 2) & (f >= 3), "At Risk")
             .when((r <= 2) & (f <= 2), "Lost").otherwise("Regular"))
    return scored.select("CustomerID", "Recency", "Frequency", "Monetary", "R_Score", "F_Score", "M_Score",
                         label.alias("CustomerSegment"))


def rfm_segments(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    out = rfm_base(tables, as_of).groupBy("CustomerSegment").agg(
        F.count("*").alias("CustomerCount"), avg_int("Recency").alias("AvgRecency"),
        avg_int("Frequency").alias("AvgFrequency"), mean("Monetary").alias("AvgMonetary"),
        avg_int("R_Score").alias("AvgRecencyScore"), avg_int("F_Score").alias("AvgFrequencyScore"),
        avg_int("M_Score").alias("AvgMonetaryScore"), F.min("Monetary").alias("MinSpent"),
        F.max("Monetary").alias("MaxSpent"), F.min("Frequency").alias("MinOrders"),
        F.max("Frequency").alias("MaxOrders"), F.sum("Monetary").alias("TotalSegmentRevenue"))
    total = F.sum("TotalSegmentRevenue").over(Window.partitionBy())  # six segments
    return (out.withColumn("RevenuePercent", percent(F.col("TotalSegmentRevenue"), total))
            .orderBy(F.desc("TotalSegmentRevenue")))


# --- products -------------------------------------------------------------------------------------------------------

def product_overview(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    base = views.product_performance(tables, as_of, th).filter(
        (F.col("TotalRevenue") > 0) | (F.col("ProductStatus") == "ACTIVE"))
    ranked = materialize(base, "product-overview")
    total = ranked.agg(F.sum("TotalRevenue")).scalar()
    ranked = rank_many(ranked, [("TotalRevenue", "RevenueRank", False), ("TotalUnitsSold", "VolumeRank", False),
                                ("ProfitMarginPercent", "MarginRank", False)], key="ProductID")
    return ranked.select(
        "ProductID", "ProductName", "ProductNumber", "Color", "Size", "CategoryName", "ProductStatus", "ListPrice",
        "StandardCost", "ProfitMarginPercent", "TimesSold", "TotalUnitsSold", "TotalRevenue", "AverageSellingPrice",
        "LastSaleDate", "PerformanceCategory", "ProductLifespanDays", "InventoryClassification", "RevenueRank",
        "VolumeRank", "MarginRank",
        percent(F.col("TotalRevenue"), total).alias("RevenueContributionPercent")).orderBy(F.desc("TotalRevenue"))


def category_analysis(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS,
                      fanout: str = "reference") -> DataFrame:
    """Category ratios, ranks and health. [Ours] health = 100 × (half the active share + 0.3 × margin share capped at 1
    + 0.2 × revenue share)."""
    all_rows = Window.partitionBy()  # one row per category
    base = views.category_performance(tables, as_of, th, fanout).withColumn(
        "_share", ratio(F.col("TotalRevenue"), F.sum("TotalRevenue").over(all_rows)))
    health = (ratio(F.col("ActiveProducts"), F.col("TotalProducts")) * 50
              + F.least(F.col("AverageMarginPercent") / 100, F.lit(1.0)) * 30 + F.col("_share") * 20)
    scored = base.withColumn("CategoryHealthScore", half_up(health, 2))
    return scored.select(
        "CategoryName", "TotalProducts", "ActiveProducts", "DiscontinuedProducts", "TotalRevenue", "TotalUnitsSold",
        "AverageProductPrice", "MinPrice", "MaxPrice", "AverageMarginPercent", "UniqueCustomers",
        "CategoryHealthScore",
        half_up(ratio(F.col("TotalRevenue"), F.col("TotalProducts")), 2).alias("RevenuePerProduct"),
        int_div(F.col("TotalUnitsSold"), F.col("TotalProducts")).alias("UnitsPerProduct"),
        half_up(ratio(F.col("TotalRevenue"), F.col("UniqueCustomers")), 2).alias("RevenuePerCustomer"),
        F.rank().over(Window.orderBy(F.desc("TotalRevenue"))).alias("RevenueRank"),
        F.rank().over(Window.orderBy(F.desc("CategoryHealthScore"))).alias("HealthRank"),
        half_up(F.col("_share") * 100, 2).alias("PortfolioContribution")).orderBy(F.desc("TotalRevenue"))


def top_products_by_category(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    base = (views.product_performance(tables, as_of, th).filter(F.col("TotalRevenue") > 0)
            .select("CategoryName", "ProductID", "ProductName", "ProductNumber", "Color", "ListPrice", "TotalRevenue",
                    "TotalUnitsSold", "ProfitMarginPercent", "PerformanceCategory", "ProductStatus"))
    stored = materialize(base, "products-by-category")
    ranked = rank_many(stored, [("TotalRevenue", "CategoryRank", False)], ["CategoryName"], key="ProductID")
    return (share_of_total(ranked, "TotalRevenue", "CategoryContribution", by="CategoryName")
            .orderBy("CategoryName", "CategoryRank"))


def portfolio(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    out = views.product_performance(tables, as_of, th).groupBy("CategoryName", "ProductStatus").agg(
        F.count("*").alias("ProductCount"), F.sum("TotalRevenue").alias("CategoryStatusRevenue"),
        mean("ListPrice").alias("AvgPrice"), mean("ProfitMarginPercent").alias("AvgMargin"),
        F.sum("TotalUnitsSold").alias("TotalUnits"))
    rich, big = F.col("AvgMargin") >= th.portfolio_margin, F.col("CategoryStatusRevenue") >= th.portfolio_revenue
    group = Window.partitionBy("CategoryName")  # at most three statuses per category
    return out.select(
        "*",
        percent(F.col("CategoryStatusRevenue"), F.sum("CategoryStatusRevenue").over(group)).alias("CategoryContribution"),
        percent(F.col("ProductCount"), F.sum("ProductCount").over(group)).alias("ProductCountPercent"),
        F.when(rich & big, "Star Products").when(rich, "Question Marks").when(big, "Cash Cows").otherwise("Dogs")
        .alias("BCGClassification")).orderBy("CategoryName", F.desc("CategoryStatusRevenue"))


# --- sales ----------------------------------------------------------------------------------------------------------

def sales_performance(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS,
                      fanout: str = "reference") -> DataFrame:
    trend = views.sales_trend(tables, as_of, th, fanout)
    by_month = Window.orderBy("OrderYear", "OrderMonth")  # one row per month of history
    in_year = Window.partitionBy("OrderYear").orderBy("OrderMonth").rowsBetween(Window.unboundedPreceding, 0)
    revenue = F.col("TotalRevenue")
    previous, year_ago = F.lag("TotalRevenue", 1).over(by_month), F.lag("TotalRevenue", 12).over(by_month)
    return (trend.withColumn("_p", previous).withColumn("_y", year_ago)
            .select("OrderYear", "OrderMonth", "MonthYear", "TotalOrders", "UniqueCustomers", "UniqueProductsSold",
                    "TotalRevenue", "AverageOrderValue", "TotalQuantitySold", "GrandTotal",
                    pct_change(revenue, F.col("_p")).alias("MoM_Growth_Percent"),
                    pct_change(revenue, F.col("_y")).alias("YoY_Growth_Percent"),
                    F.when(revenue >= F.col("_p"), "Positive").otherwise("Negative").alias("MoM_Trend"),
                    F.sum("TotalRevenue").over(in_year).alias("YTD_Revenue"))
            .orderBy(F.desc("OrderYear"), F.desc("OrderMonth")))


def order_status_report(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    def tally(column: str, value: str, out: str) -> Column:
        return _count(F.col(column) == value).alias(out)

    out = views.order_analysis(tables, as_of, th).groupBy("OrderStatus").agg(
        F.count("*").alias("OrderCount"), F.sum("TotalDue").alias("TotalRevenue"),
        mean("TotalDue").alias("AvgOrderValue"), avg_int("LineItemCount").alias("AvgItemsPerOrder"),
        avg_int("TotalQuantity").alias("AvgQuantityPerOrder"), avg_int("DaysToShip").alias("AvgDaysToShip"),
        tally("DeliveryPerformance", "ON_TIME", "OnTimeOrders"), tally("DeliveryPerformance", "LATE", "LateOrders"),
        tally("DeliveryPerformance", "OVERDUE", "OverdueOrders"), tally("OrderSize", "LARGE", "LargeOrders"),
        tally("OrderSize", "MEDIUM", "MediumOrders"), tally("OrderSize", "SMALL", "SmallOrders"),
        tally("OrderType", "B2B", "B2B_Orders"), tally("OrderType", "B2C", "B2C_Orders"))
    total = F.sum("OrderCount").over(Window.partitionBy())  # at most seven statuses
    shipped = F.col("OnTimeOrders") + F.col("LateOrders")
    return (out.withColumn("OrderStatusPercent", percent(F.col("OrderCount"), total))
            .withColumn("OnTimeDeliveryPercent", percent(F.col("OnTimeOrders"), shipped))
            .orderBy(F.desc("OrderCount")))


def daily_sales(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS, fanout: str = "reference") -> DataFrame:
    keep = flag_is("IsDeleted", False) & (F.col("OrderDate") >= shift(at(as_of), days=-90))
    days = joined_orders(tables, fanout, keep).groupBy(F.to_date("OrderDate").alias("OrderDate")).agg(
        F.count("*").alias("OrderCount"), F.count_distinct("CustomerID").alias("UniqueCustomers"),
        weighted_sum("TotalDue").alias("DailyRevenue"), weighted_mean("TotalDue").alias("AvgOrderValue"),
        F.sum("Units").alias("TotalUnits"))
    by_day = Window.orderBy("OrderDate")  # at most 91 rows
    revenue = F.col("DailyRevenue").cast("double")
    usual = ratio(F.sum("DailyRevenue").over(Window.partitionBy()), F.count("*").over(Window.partitionBy()))
    return days.select(
        "OrderDate", F.date_format("OrderDate", "EEEE").alias("DayOfWeek"), "OrderCount", "UniqueCustomers",
        "DailyRevenue", "AvgOrderValue", "TotalUnits",
        F.lag("DailyRevenue", 1).over(by_day).alias("PreviousDayRevenue"),
        F.lag("DailyRevenue", 7).over(by_day).alias("SameDayLastWeekRevenue"),
        F.when(revenue >= usual * 1.5, "High").when(revenue >= usual * 0.8, "Normal").otherwise("Low")
        .alias("DayPerformance")).orderBy(F.desc("OrderDate"))


def channel_performance(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS,
                        fanout: str = "reference") -> DataFrame:
    keep = flag_is("IsDeleted", False) & (F.col("OrderDate") >= shift(at(as_of), years=-1))
    ship_days = datediff_sql("day", F.col("OrderDate"), F.col("ShipDate"))
    flag = F.col("OnlineOrderFlag").cast("boolean")
    out = (joined_orders(tables, fanout, keep).withColumn("_ship", ship_days)
           .groupBy(flag.alias("_flag")).agg(
        F.count("*").alias("OrderCount"), F.count_distinct("CustomerID").alias("UniqueCustomers"),
        weighted_sum("TotalDue").alias("TotalRevenue"), weighted_mean("TotalDue").alias("AvgOrderValue"),
        F.sum("Units").alias("TotalUnits"), int_div(F.sum("Units"), F.sum("Lines")).alias("AvgQuantityPerOrder"),
        ratio(F.sum("DiscountSum"), F.sum("Lines")).alias("AvgDiscountRate"),
        int_div(weighted_sum("_ship"), F.sum(F.when(F.col("_ship").isNotNull(), F.col("w"))))
        .alias("AvgShippingDays")))
    out = out.select(F.when(F.col("_flag"), "Online").otherwise("Offline").alias("SalesChannel"), *[c for c in out.columns if c != "_flag"])
    both = Window.partitionBy()  # two channels, and a row of its own for orders without flag
    return (out.withColumn("OrderShare", percent(F.col("OrderCount"), F.sum("OrderCount").over(both)))
            .withColumn("RevenueShare", percent(F.col("TotalRevenue"), F.sum("TotalRevenue").over(both)))
            .orderBy(F.desc("TotalRevenue")))


# --- quality and summaries ------------------------------------------------------------------------------------------

# Points taken off per table for (first defect, second defect, soft deletes).
QUALITY_WEIGHTS = {"Customer": (30, 20, 10), "Product": (40, 30, 5), "SalesOrderHeader": (35, 25, 10)}


def dq_scores(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    rows = F.col("TotalRecords")

    def weight(i: int) -> Column:
        out = F.lit(QUALITY_WEIGHTS["SalesOrderHeader"][i])
        for table in ("Product", "Customer"):
            out = F.when(F.col("TableName") == table, QUALITY_WEIGHTS[table][i]).otherwise(out)
        return out

    loss = [ratio(F.col(c) * weight(i), rows) for i, c in
            enumerate(("MissingEmailRecords", "MissingPhoneRecords", "SoftDeletedRecords"))]
    return views.data_quality(tables, as_of, th).select(
        "TableName", "TotalRecords", "SoftDeletedRecords",
        percent(F.col("SoftDeletedRecords"), rows).alias("SoftDeletePercent"), "MissingEmailRecords",
        "MissingPhoneRecords", "AvgDaysOld",
        half_up(F.lit(100.0) - loss[0] - loss[1] - loss[2], 2).alias("DataQualityScore"),
        band("AvgDaysOld", [(30, "Fresh"), (90, "Moderate")], "Stale", op="<=").alias("DataFreshness"),
    ).orderBy(F.desc("DataQualityScore"))


def business_summary(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    """Four metric rows unpivoted from the one KPI row, which is computed once."""
    kpi = views.business_kpi(tables, as_of, th)
    usd = lambda c: F.concat(F.lit("$"), format_n0(F.col(c)))
    text = lambda c: format_n0(F.col(c))
    growth = lambda new, old: F.coalesce(pct_change(F.col(new), F.col(old), 1), F.lit(0)).cast("double")
    trend = lambda new, old: F.when(F.col(new) >= F.col(old), "Positive").otherwise("Negative")
    kept = ratio(F.col("ActiveCustomers"), F.col("TotalCustomers"))
    kept_trend = F.when(kept >= 0.8, "Positive").when(kept >= 0.6, "Neutral").otherwise("Negative")
    rows = [
        ("Revenue", usd("Revenue_Last30Days"), usd("Revenue_Previous30Days"),
         growth("Revenue_Last30Days", "Revenue_Previous30Days"), trend("Revenue_Last30Days", "Revenue_Previous30Days")),
        ("Orders", text("Orders_Last30Days"), text("Orders_Previous30Days"),
         growth("Orders_Last30Days", "Orders_Previous30Days"), trend("Orders_Last30Days", "Orders_Previous30Days")),
        ("Average Order Value", usd("AOV_Last30Days"), usd("AverageOrderValue"),
         growth("AOV_Last30Days", "AverageOrderValue"), trend("AOV_Last30Days", "AverageOrderValue")),
        ("Active Customers", text("ActiveCustomers"), text("TotalCustomers"),
         half_up(kept * 100, 1).cast("double"), kept_trend),
    ]
    names = ("MetricType", "CurrentValue", "PreviousValue", "GrowthPercent", "Trend")
    lines = F.array(*[F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(n) for n, v in zip(names, row)])
                      for row in rows])
    return kpi.select(F.inline(lines))


# --- cohorts --------------------------------------------------------------------------------------------------------

def customer_months(tables: Tables) -> DataFrame:
    """One row per customer and order month, live orders only."""
    return (tables["SalesOrderHeader"].filter(is_active() & F.col("OrderDate").isNotNull())
            .groupBy("CustomerID", F.trunc("OrderDate", "month").alias("Month"))
            .agg(F.count("*").alias("Orders"), F.sum("SubTotal").alias("Revenue")))


def cohort_base(tables: Tables, as_of: datetime) -> DataFrame:
    """[Ours] Cohorts by first order month; a customer with orders in two or more months is retained."""
    people = customer_months(tables).groupBy("CustomerID").agg(
        F.min("Month").alias("CohortMonth"), F.count("*").alias("Months"), F.sum("Orders").alias("Orders"),
        F.sum("Revenue").alias("Revenue"))
    kept = F.count_if(F.col("Months") >= 2)
    return people.groupBy("CohortMonth").agg(
        F.count("*").alias("CohortSize"), F.sum("Revenue").alias("CohortRevenue"),
        mean("Revenue").alias("AvgRevenuePerCustomer"), mean("Orders").alias("AvgOrdersPerCustomer"),
        kept.alias("RetainedCustomers"), percent(kept, F.count("*")).alias("RetentionRate"))


def cohort_retention(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    return cohort_base(tables, as_of).filter(F.col("CohortSize") >= th.cohort_min_size).select(
        "CohortMonth", F.date_format("CohortMonth", "MMM yyyy").alias("CohortLabel"), "CohortSize", "CohortRevenue",
        "AvgRevenuePerCustomer", "AvgOrdersPerCustomer", "RetainedCustomers", "RetentionRate",
        band("RetentionRate", [(60, "High Retention"), (40, "Medium Retention")], "Low Retention")
        .alias("RetentionClass"),
        half_up(ratio(F.col("CohortRevenue"), F.col("RetainedCustomers")), 2).alias("RevenuePerRetainedCustomer"),
        datediff_sql("month", F.col("CohortMonth"), at(as_of)).alias("CohortAgeMonths"),
    ).orderBy(F.desc("CohortMonth"))


def cohort_matrix(tables: Tables, as_of: datetime, horizon: int | None = None) -> DataFrame:
    """[Ours] Active customers per cohort and month offset, up to ``horizon`` months if given. A customer's partition
    holds one row per month at most."""
    first = F.min("Month").over(Window.partitionBy("CustomerID"))
    placed = (customer_months(tables).withColumn("CohortMonth", first)
              .withColumn("MonthOffset", datediff_sql("month", F.col("CohortMonth"), F.col("Month"))))
    if horizon is not None:
        placed = placed.filter(F.col("MonthOffset") <= horizon)
    return (placed.groupBy("CohortMonth", "MonthOffset")
            .agg(F.count("*").alias("ActiveCustomers"), F.sum("Revenue").alias("Revenue")))


# --- measures -------------------------------------------------------------------------------------------------------

def measure_growth(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    now, due = at(as_of), total_due()
    m1, m2 = shift(now, months=-1), shift(now, months=-2)
    placed = F.col("OrderDate")
    sums = (tables["SalesOrderHeader"].filter(is_active() & (placed >= m2))
            .agg(F.sum(F.when(placed >= m1, due)).alias("new"), F.sum(F.when(placed < m1, due)).alias("old")))
    return sums.select(F.coalesce(half_up(ratio(F.col("new") - F.col("old"), F.col("old")) * 100, 2), F.lit(0))
                       .alias("RevenueGrowthPercent"))


def measure_retention(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    repeat = F.count_if(F.col("TotalOrders") >= 2)
    return views.customer_360(tables, as_of, th).agg(
        F.coalesce(percent(repeat, F.count("*")), F.lit(0)).alias("CustomerRetentionRate"))


def measure_ship_days(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    return views.order_analysis(tables, as_of, th).agg(mean("DaysToShip").alias("AverageDaysToShip"))


# --- listings -------------------------------------------------------------------------------------------------------

def category_breakdown(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    """Products, price and units per category over the joined lines: a product counts once per line it has."""
    sold = tables["SalesOrderDetail"].groupBy("ProductID").agg(
        F.count("*").alias("lines"), F.sum("OrderQty").alias("units"))
    dims = tables["ProductCategory"].select("ProductCategoryID", F.col("Name").alias("CategoryName"))
    w = F.greatest(F.coalesce("lines", F.lit(1)), F.lit(1))
    return (tables["Product"].join(dims, "ProductCategoryID").join(sold, "ProductID", "left").withColumn("w", w)
            .groupBy("ProductCategoryID", "CategoryName")
            .agg(F.sum("w").alias("NewProducts"), weighted_mean("ListPrice").alias("AvgPrice"),
                 F.sum(F.coalesce("units", F.lit(0))).alias("TotalUnitsSold"))
            .drop("ProductCategoryID").orderBy(F.desc("NewProducts")))


def _name(first: str = "FirstName", last: str = "LastName") -> Column:
    return concat_nullable(F.col(first), F.lit(" "), F.col(last))


def customer_spend(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    spend = views.orders_per_customer(tables["SalesOrderHeader"], total_due())
    return tables["Customer"].join(spend, "CustomerID", "left").select(
        "CustomerID", _name().alias("CustomerName"), "CompanyName",
        F.coalesce("_revenue", F.lit(0).cast("decimal(19,4)")).alias("TotalSpent"),
        F.coalesce("TotalOrders", F.lit(0)).alias("OrdersPlaced"), customer_type().alias("CustomerType"),
    ).orderBy(F.desc("TotalSpent"))


def order_headers(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    people = tables["Customer"].select("CustomerID", _name().alias("CustomerName"), "CompanyName")
    cents = lambda c: c.cast("decimal(10,2)")
    return (tables["SalesOrderHeader"].join(people, "CustomerID")
            .select("SalesOrderID", "CustomerID", "CustomerName", "CompanyName", "OrderDate", "DueDate",
                    cents(F.col("SubTotal")).alias("SubTotal"), cents(F.col("TaxAmt")).alias("TaxAmt"),
                    cents(F.col("Freight")).alias("Freight"), cents(total_due()).alias("CalculatedTotal"),
                    "ShipMethod").orderBy("SalesOrderID"))


def order_lines(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    goods = tables["Product"].select("ProductID", F.col("Name").alias("ProductName"), "ProductNumber")
    return (tables["SalesOrderDetail"].join(goods, "ProductID")
            .select("SalesOrderID", "ProductID", "ProductName", "ProductNumber", "OrderQty",
                    F.col("UnitPrice").cast("decimal(10,2)").alias("UnitPrice"),
                    F.col("UnitPriceDiscount").cast("decimal(4,2)").alias("DiscountPercent"),
                    line_total().cast("decimal(10,2)").alias("LineTotal")).orderBy("SalesOrderID", "ProductID"))


def order_rollup(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    per_order = views.lines_per_order(tables["SalesOrderDetail"])
    people = tables["Customer"].select("CustomerID", F.concat("FirstName", F.lit(" "), "LastName").alias("CustomerName"),
                                       "CompanyName")
    return (tables["SalesOrderHeader"].join(per_order, "SalesOrderID").join(people, "CustomerID")
            .select("SalesOrderID", "CustomerName", "CompanyName", F.col("Lines").alias("ItemsOrdered"),
                    F.col("Units").alias("TotalQuantity"),
                    ratio(F.col("DiscountSum"), F.col("Lines")).alias("AvgDiscount"),
                    total_due().alias("CalculatedTotal")).orderBy("SalesOrderID"))


def price_margin(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    dims = tables["ProductCategory"].select("ProductCategoryID", F.col("Name").alias("Category"))
    return (tables["Product"].join(dims, "ProductCategoryID")
            .select("ProductID", "Name", F.col("ListPrice").alias("CurrentPrice"), "StandardCost", "Category",
                    percent(F.col("ListPrice") - F.col("StandardCost"), F.col("StandardCost")).alias("MarginPercent"),
                    F.col("ModifiedDate").alias("LastPriceChange")).orderBy(F.desc("LastPriceChange")))


def product_lifecycle(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    status = (F.when(is_deleted(), "DISCONTINUED").when(F.col("SellEndDate").isNotNull(), "END_OF_LIFE")
              .otherwise("ACTIVE"))
    return tables["Product"].select(
        "ProductID", "Name", "ProductNumber", status.alias("ProductStatus"), "SellStartDate",
        F.coalesce("DeletedDate", "SellEndDate").alias("DiscontinuedDate"),
        views.product_lifespan(as_of).alias("ProductLifespanDays"),
        F.col("ListPrice").cast("decimal(10,2)").alias("LastKnownPrice")).orderBy(F.desc("ProductLifespanDays"))


def customer_retention(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    spend = views.orders_per_customer(tables["SalesOrderHeader"].filter(flag_is("IsDeleted", False)), total_due())
    closed = is_deleted()
    return tables["Customer"].join(spend, "CustomerID", "left").select(
        "CustomerID", _name().alias("CustomerName"), "CompanyName",
        F.when(closed, "ACCOUNT_CLOSED").otherwise("ACTIVE").alias("AccountStatus"),
        F.coalesce("TotalOrders", F.lit(0)).alias("TotalOrders"),
        F.coalesce("_revenue", F.lit(0).cast("decimal(19,4)")).alias("TotalRevenue"),
        F.col("_last").alias("LastOrderDate"), F.col("DeletedDate").alias("AccountClosedDate"),
        F.when(closed & F.col("DeletedDate").isNotNull(), datediff_sql("day", F.col("_last"), F.col("DeletedDate")))
        .alias("DaysBetweenLastOrderAndClosure")).orderBy(F.desc("TotalRevenue"))


def orders_of_deleted_customers(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    gone = tables["Customer"].filter(flag_is("IsDeleted", True)).select("CustomerID")
    return (tables["SalesOrderHeader"].join(gone, "CustomerID", "left_semi")
            .select("SalesOrderID", "CustomerID", "OrderDate", total_due().cast("decimal(10,2)").alias("TotalDue"),
                    F.lit("Historical Order (Customer Deleted)").alias("Note")).orderBy("OrderDate"))


def calendar_orders(tables: Tables, as_of: datetime, start: date | None = None) -> DataFrame:
    """The calendar from the first order day on, with the live orders and amount of each day."""
    orders = tables["SalesOrderHeader"]
    first = F.lit(start) if start else orders.agg(F.min(F.to_date("OrderDate"))).scalar()
    per_day = (orders.filter(is_active()).groupBy(F.to_date("OrderDate").alias("Date"))
               .agg(F.count("*").alias("Orders"), F.sum("SubTotal").alias("Revenue")))
    return (date_dim(orders.sparkSession, first, as_of).join(per_day, "Date", "left")
            .withColumn("Orders", F.coalesce("Orders", F.lit(0))))
