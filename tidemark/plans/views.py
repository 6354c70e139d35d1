"""Analytics views over the mirrored sales tables.

Every view is a function ``(tables, as_of, th)`` returning a lazy frame. Details are always reduced to one row per
order or per product before they meet another table: the reduction combines map-side, so an order or product that owns
a large part of all rows is a single row by the time it is shuffled.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import Thresholds
from tidemark.functions.columns import (
    at, avg_int, band, datediff_sql, days_old, flag_is, full_name, half_up, is_active, is_blank, is_deleted,
    line_total, margin_ratio, mean, ratio, shift, total_due, value_map,
)
from tidemark.sources.tables import Tables

DEFAULTS = Thresholds()

# The source's order status codes.
ORDER_STATUS = {1: "IN_PROCESS", 2: "APPROVED", 3: "BACKORDERED", 4: "REJECTED", 5: "SHIPPED", 6: "CANCELLED"}


def orders_per_customer(orders: DataFrame, amount: Column) -> DataFrame:
    return orders.groupBy("CustomerID").agg(
        F.count("SalesOrderID").alias("TotalOrders"),
        F.sum(amount).alias("_revenue"),
        F.max("OrderDate").alias("_last"),
        F.min("OrderDate").alias("_first"),
    )


def lines_per_order(lines: DataFrame) -> DataFrame:
    """One row per order: line count, units, and the sums the averages are taken from."""
    return lines.groupBy("SalesOrderID").agg(
        F.count("ProductID").alias("Lines"),
        F.sum("OrderQty").alias("Units"),
        F.sum("UnitPrice").alias("PriceSum"),
        F.sum("UnitPriceDiscount").alias("DiscountSum"),
        F.sum(line_total()).alias("LineRevenue"),
    )


def lines_per_product(lines: DataFrame) -> DataFrame:
    return lines.groupBy("ProductID").agg(
        F.count("ProductID").alias("TimesSold"),
        F.sum("OrderQty").alias("_units"),
        F.sum(line_total()).alias("_revenue"),
        mean("UnitPrice").alias("_price"),
    )


def customer_type() -> Column:
    return F.when(F.col("CompanyName").isNotNull(), "B2B").otherwise("B2C")


def customer_360(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    """Profile, order totals, segment and engagement of every customer; only orders not deleted count."""
    spend = orders_per_customer(tables["SalesOrderHeader"].filter(is_active()), F.col("SubTotal"))
    now = at(as_of)
    vip, premium, standard = th.customer
    d1, d2, d3 = th.engagement_days
    base = (tables["Customer"].filter(F.col("CustomerID").isNotNull())
            .join(spend, "CustomerID", "left")
            .withColumn("TotalRevenue", F.coalesce("_revenue", F.lit(0).cast("decimal(19,4)")))
            .withColumn("LastOrderDate", F.coalesce("_last", "ModifiedDate"))
            .withColumn("FirstOrderDate", F.coalesce("_first", "ModifiedDate")))
    engagement = (F.when(is_deleted(), "CHURNED")
                  .otherwise(band("LastOrderDate", [(shift(now, days=-d1), "ACTIVE"), (shift(now, days=-d2), "AT_RISK"),
                                                    (shift(now, days=-d3), "DORMANT")], "INACTIVE")))
    segment = (F.when(F.col("TotalRevenue") <= 0, "Prospect")
               .otherwise(band("TotalRevenue", [(vip, "VIP"), (premium, "Premium"), (standard, "Standard")], "Basic")))
    return base.select(
        "CustomerID", "FirstName", "MiddleName", "LastName", full_name().alias("FullName"),
        "EmailAddress", "Phone", "CompanyName",
        F.when(is_deleted(), "CLOSED").otherwise("ACTIVE").alias("AccountStatus"),
        F.col("DeletedDate").alias("AccountClosedDate"), F.col("DeletedBy").alias("ClosedBy"),
        F.coalesce("TotalOrders", F.lit(0)).alias("TotalOrders"),
        "TotalRevenue",
        F.coalesce(ratio(F.col("_revenue"), F.col("TotalOrders")), F.lit(0.0)).alias("AverageOrderValue"),
        "LastOrderDate", "FirstOrderDate",
        segment.alias("CustomerSegment"), customer_type().alias("CustomerType"),
        engagement.alias("EngagementStatus"),
        days_old("ModifiedDate", as_of).alias("DaysSinceRegistration"),
        days_old("LastOrderDate", as_of).alias("DaysSinceLastActivity"),
    )


def customer_summary(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    """Short form: deleted orders count too and customers without orders keep nulls."""
    spend = orders_per_customer(tables["SalesOrderHeader"], F.col("SubTotal"))
    return tables["Customer"].join(spend, "CustomerID", "left").select(
        "CustomerID", full_name(middle=None).alias("FullName"), "EmailAddress",
        F.coalesce("TotalOrders", F.lit(0)).alias("TotalOrders"), F.col("_revenue").alias("TotalRevenue"),
        ratio(F.col("_revenue"), F.col("TotalOrders")).alias("AverageOrderValue"), F.col("_last").alias("LastOrderDate"),
        days_old("_last", as_of).alias("DaysSinceLastOrder"), "IsDeleted", "DeletedDate",
    )


def customer_ltv(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    return ltv_from(customer_360(tables, as_of, th))


def ltv_from(profile: DataFrame) -> DataFrame:
    """Lifetime value, churn risk and order rhythm from the customer profile."""
    orders, engaged = F.col("TotalOrders"), F.col("EngagementStatus")
    factor = band(orders, [(5, "1.5"), (2, "1.2")], "0.8").cast("decimal(2,1)")
    lifespan = datediff_sql("day", F.col("FirstOrderDate"), F.col("LastOrderDate"))
    medium = (engaged == "AT_RISK") | ((engaged == "ACTIVE") & (orders == 1))
    return profile.select(
        "CustomerID", "FullName", "CompanyName", "CustomerSegment", "CustomerType", "AccountStatus",
        F.col("TotalRevenue").alias("HistoricalCLV"), "TotalOrders", "AverageOrderValue",
        F.when(F.col("AccountStatus") == "ACTIVE", F.col("TotalRevenue") * factor)
        .otherwise(F.col("TotalRevenue")).alias("PredictedCLV"),
        F.when(engaged.isin("CHURNED", "DORMANT"), "HIGH_RISK").when(medium, "MEDIUM_RISK")
        .otherwise("LOW_RISK").alias("ChurnRisk"),
        lifespan.alias("CustomerLifespanDays"),
        F.when((orders > 1) & (F.col("FirstOrderDate") != F.col("LastOrderDate")), ratio(lifespan, orders - 1))
        .alias("AvgDaysBetweenOrders"),
        "DaysSinceLastActivity", "EngagementStatus",
    )


def product_status() -> Column:
    return (F.when(is_deleted(), "DISCONTINUED").when(F.col("SellEndDate").isNotNull(), "END_OF_LIFE")
            .when(F.col("DiscontinuedDate").isNotNull(), "DISCONTINUED").otherwise("ACTIVE"))


def product_lifespan(as_of: datetime) -> Column:
    end = F.when(is_deleted(), F.col("DeletedDate")).otherwise(F.coalesce("SellEndDate", at(as_of)))
    return datediff_sql("day", F.col("SellStartDate"), end)


def with_dimensions(products: DataFrame, tables: Tables) -> DataFrame:
    """Left chain product → category → model."""
    category = tables["ProductCategory"].select("ProductCategoryID", F.col("Name").alias("CategoryName"))
    model = tables["ProductModel"].select("ProductModelID", F.col("Name").alias("ModelName"))
    return products.join(category, "ProductCategoryID", "left").join(model, "ProductModelID", "left")


def inventory_class() -> Column:
    """Movement class by units sold. Consumed by the product overview, which is the only place that names it."""
    return band("TotalUnitsSold", [(1000, "FAST"), (500, "MEDIUM"), (1, "SLOW")], "NONE")


def product_performance(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS,
                        active_only: bool = False) -> DataFrame:
    """Sales, price, status and lifespan of every product.

    Lines of deleted orders count in units and revenue; only the last sale date looks at the order flag. With
    ``active_only`` those lines are left out everywhere.
    """
    lines = tables["SalesOrderDetail"]
    live = tables["SalesOrderHeader"].filter(is_active()).select("SalesOrderID", "OrderDate")
    if active_only:
        lines = lines.join(live.select("SalesOrderID"), "SalesOrderID", "left_semi")
    last_sale = (lines.select("SalesOrderID", "ProductID").join(live, "SalesOrderID")
                 .groupBy("ProductID").agg(F.max("OrderDate").alias("_last")))
    top, high, medium = th.product
    base = (with_dimensions(tables["Product"], tables)
            .join(lines_per_product(lines), "ProductID", "left")
            .join(last_sale, "ProductID", "left")
            .withColumn("TotalRevenue", F.coalesce("_revenue", F.lit(0).cast("decimal(19,4)")))
            .withColumn("TotalUnitsSold", F.coalesce("_units", F.lit(0))))
    category = (F.when(F.col("TotalRevenue") <= 0, "NO_SALES")
                .otherwise(band("TotalRevenue", [(top, "TOP_PERFORMER"), (high, "HIGH_PERFORMER"),
                                                 (medium, "MEDIUM_PERFORMER")], "LOW_PERFORMER")))
    return base.select(
        "ProductID", F.col("Name").alias("ProductName"), "ProductNumber", "Color", "Size", "Weight",
        "CategoryName", "ModelName", product_status().alias("ProductStatus"), "StandardCost", "ListPrice",
        half_up(margin_ratio("ListPrice", "StandardCost"), 2).alias("ProfitMarginPercent"),
        F.coalesce("TimesSold", F.lit(0)).alias("TimesSold"), "TotalUnitsSold", "TotalRevenue",
        F.coalesce("_price", F.col("ListPrice").cast("double")).alias("AverageSellingPrice"),
        F.coalesce("_last", "SellStartDate").alias("LastSaleDate"), category.alias("PerformanceCategory"),
        "SellStartDate", "SellEndDate", "DiscontinuedDate", "DeletedDate",
        product_lifespan(as_of).alias("ProductLifespanDays"),
        inventory_class().alias("InventoryClassification"),
    )


def product_performance_by_count(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    """Short form: bands by number of lines sold, nulls kept where nothing was sold."""
    sold = F.coalesce("TimesSold", F.lit(0))
    category = (F.when(is_deleted(), "Discontinued").when(sold == 0, "No Sales").when(sold < 5, "Low Performer")
                .when(sold >= 20, "Top Performer").otherwise("Medium Performer"))
    dims = tables["ProductCategory"].select("ProductCategoryID", F.col("Name").alias("CategoryName"))
    return (tables["Product"].join(dims, "ProductCategoryID", "left")
            .join(lines_per_product(tables["SalesOrderDetail"]), "ProductID", "left")
            .select("ProductID", "Name", "ProductNumber", "Color", "ListPrice", "CategoryName",
                    sold.alias("TimesSold"), F.col("_units").alias("TotalQuantitySold"),
                    F.col("_revenue").alias("TotalRevenue"), F.col("_price").alias("AverageSellingPrice"),
                    "IsDeleted", category.alias("PerformanceCategory")))


def category_performance(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS,
                         fanout: str = "reference") -> DataFrame:
    """Totals per category.

    ``fanout="reference"`` counts a product once per line it has (once if it has none) in the product counts and price
    means, as a join of products with lines does; ``"corrected"`` counts each product once. Either way the work is
    done on one row per product carrying its weight, never on the joined rows.
    """
    lines = tables["SalesOrderDetail"]
    sold = lines_per_product(lines).withColumnRenamed("ProductID", "_pid")
    product = tables["Product"].select("ProductID", "ProductCategoryID", "IsDeleted", "ListPrice", "StandardCost")
    weight = F.greatest(F.coalesce("TimesSold", F.lit(0)), F.lit(1)) if fanout == "reference" else F.lit(1)
    weighed = product.join(sold, F.col("ProductID") == F.col("_pid"), "left").withColumn("w", weight.cast("bigint"))
    margin = margin_ratio("ListPrice", "StandardCost").cast("decimal(20,6)")
    per_category = weighed.groupBy("ProductCategoryID").agg(
        F.sum("w").alias("TotalProducts"),
        F.sum(F.when(is_active(), F.col("w")).otherwise(0)).alias("ActiveProducts"),
        F.sum(F.when(is_deleted(), F.col("w")).otherwise(0)).alias("DiscontinuedProducts"),
        ratio(F.sum(F.col("ListPrice") * F.col("w")), F.sum("w")).alias("AverageProductPrice"),
        F.min("ListPrice").alias("MinPrice"), F.max("ListPrice").alias("MaxPrice"),
        ratio(F.sum(margin * F.col("w").cast("decimal(12,0)")), F.sum("w")).alias("AverageMarginPercent"),
        F.sum("_units").alias("_units"), F.sum("_revenue").alias("_revenue"),
    )
    live = tables["SalesOrderHeader"].filter(is_active()).select("SalesOrderID", "CustomerID")
    reach = (lines.join(product.select("ProductID", "ProductCategoryID"), "ProductID")
             .select("ProductCategoryID", "SalesOrderID").distinct()
             .join(live, "SalesOrderID", "left")
             .groupBy("ProductCategoryID")
             .agg(F.count("SalesOrderID").alias("_orders"), F.count_distinct("CustomerID").alias("_customers")))
    zero = F.lit(0).cast("bigint")
    return (tables["ProductCategory"]
            .join(per_category, "ProductCategoryID", "left").join(reach, "ProductCategoryID", "left")
            .select("ProductCategoryID", F.col("Name").alias("CategoryName"),
                    F.coalesce("TotalProducts", zero).alias("TotalProducts"),
                    # a category without products still makes one joined row, whose missing flag reads as active
                    F.coalesce("ActiveProducts", F.lit(1 if fanout == "reference" else 0)).alias("ActiveProducts"),
                    F.coalesce("DiscontinuedProducts", zero).alias("DiscontinuedProducts"),
                    "AverageProductPrice", "MinPrice", "MaxPrice",
                    F.coalesce("AverageMarginPercent", F.lit(0.0)).alias("AverageMarginPercent"),
                    F.coalesce("_units", zero).alias("TotalUnitsSold"),
                    F.coalesce("_revenue", F.lit(0).cast("decimal(19,4)")).alias("TotalRevenue"),
                    F.coalesce("_orders", zero).alias("OrdersWithCategory"),
                    F.coalesce("_customers", zero).alias("UniqueCustomers")))


def joined_orders(tables: Tables, fanout: str, keep: Column) -> DataFrame:
    """Kept orders that have lines, each with ``w``: how often its header amounts count (once per line, or once)."""
    per_order = lines_per_order(tables["SalesOrderDetail"])
    weight = F.col("Lines") if fanout == "reference" else F.lit(1).cast("bigint")
    return (tables["SalesOrderHeader"].filter(keep).join(per_order, "SalesOrderID")
            .withColumn("TotalDue", total_due()).withColumn("w", weight))


def weighted_sum(c: str) -> Column:
    return F.sum(F.col(c) * F.col("w"))


def weighted_mean(c: str) -> Column:
    return ratio(weighted_sum(c), F.sum("w"))


def sales_trend(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS, fanout: str = "reference") -> DataFrame:
    """Monthly orders, customers, products, amounts and volume of orders not deleted."""
    orders = joined_orders(tables, fanout, is_active() & F.col("OrderDate").isNotNull())
    month = F.trunc("OrderDate", "month")
    totals = orders.groupBy(month.alias("MonthYear")).agg(
        F.count("*").alias("TotalOrders"), F.count_distinct("CustomerID").alias("UniqueCustomers"),
        weighted_sum("SubTotal").alias("TotalRevenue"), weighted_mean("SubTotal").alias("AverageOrderValue"),
        weighted_sum("TaxAmt").alias("TotalTax"), weighted_sum("Freight").alias("TotalShipping"),
        weighted_sum("TotalDue").alias("GrandTotal"), F.sum("Units").alias("TotalQuantitySold"),
        # mean units per line, cut to an integer
        F.call_function("div", F.sum("Units"), F.sum("Lines")).alias("AverageQuantityPerOrder"),
    )
    months = (tables["SalesOrderHeader"].filter(is_active() & F.col("OrderDate").isNotNull())
              .select("SalesOrderID", month.alias("MonthYear")))
    products = (tables["SalesOrderDetail"].select("SalesOrderID", "ProductID").distinct()
                .join(months, "SalesOrderID").select("MonthYear", "ProductID").distinct()
                .groupBy("MonthYear").agg(F.count("ProductID").alias("UniqueProductsSold")))
    return totals.join(products, "MonthYear").select(
        F.year("MonthYear").alias("OrderYear"), F.month("MonthYear").alias("OrderMonth"), "MonthYear",
        "TotalOrders", "UniqueCustomers", "UniqueProductsSold", "TotalRevenue", "AverageOrderValue", "TotalTax",
        "TotalShipping", "GrandTotal", "TotalQuantitySold", "AverageQuantityPerOrder")


def sales_trend_short(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS,
                      fanout: str = "reference") -> DataFrame:
    """Short form: orders whose flag is set to not deleted, without products, tax and freight."""
    orders = joined_orders(tables, fanout, flag_is("IsDeleted", False))
    return orders.groupBy(F.year("OrderDate").alias("OrderYear"), F.month("OrderDate").alias("OrderMonth")).agg(
        F.count("*").alias("TotalOrders"), F.count_distinct("CustomerID").alias("UniqueCustomers"),
        weighted_sum("SubTotal").alias("TotalRevenue"), weighted_mean("SubTotal").alias("AverageOrderValue"),
        F.sum("Units").alias("TotalQuantitySold"))


def order_status() -> Column:
    return F.when(is_deleted(), "CANCELLED").otherwise(value_map("Status", ORDER_STATUS, "UNKNOWN"))


def delivery_performance(as_of: datetime) -> Column:
    """[Ours] On time, late, overdue or pending; the status report reads this column but nothing defines it."""
    return (F.when(F.col("ShipDate") <= F.col("DueDate"), "ON_TIME").when(F.col("ShipDate").isNotNull(), "LATE")
            .when(F.col("DueDate") < at(as_of), "OVERDUE").otherwise("PENDING"))


def order_analysis(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    """One row per order that has lines: status, totals, item mix, size and delivery."""
    large, medium = th.order
    per_order = lines_per_order(tables["SalesOrderDetail"])
    people = tables["Customer"].select("CustomerID", "FirstName", "LastName", "CompanyName")
    return (tables["SalesOrderHeader"].join(per_order, "SalesOrderID").join(people, "CustomerID")
            .withColumn("TotalDue", total_due())
            .select("SalesOrderID", "CustomerID",
                    F.concat("FirstName", F.lit(" "), "LastName").alias("CustomerName"), "CompanyName",
                    "OrderDate", "DueDate", "ShipDate", order_status().alias("OrderStatus"),
                    "SubTotal", "TaxAmt", "Freight", "TotalDue",
                    F.col("Lines").alias("LineItemCount"), F.col("Units").alias("TotalQuantity"),
                    ratio(F.col("PriceSum"), F.col("Lines")).alias("AverageItemPrice"),
                    ratio(F.col("DiscountSum"), F.col("Lines")).alias("AverageDiscount"),
                    customer_type().alias("OrderType"),
                    band("TotalDue", [(large, "LARGE"), (medium, "MEDIUM")], "SMALL").alias("OrderSize"),
                    datediff_sql("day", F.col("OrderDate"), F.col("ShipDate")).alias("DaysToShip"),
                    delivery_performance(as_of).alias("DeliveryPerformance")))


def data_quality(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    """Row, delete and defect counts of three tables; the two defect columns mean something else per table."""
    def counted(cond: Column) -> Column:
        return F.sum(F.when(cond, 1).otherwise(0))

    checks = {
        "Customer": (is_blank("EmailAddress"), is_blank("Phone")),
        "Product": (is_blank("Name"), F.col("StandardCost").isNull() | (F.col("StandardCost") <= 0)),
        "SalesOrderHeader": (F.col("CustomerID").isNull(), F.col("SubTotal").isNull() | (F.col("SubTotal") <= 0)),
    }
    rows = [tables[name].agg(F.count("*").alias("TotalRecords"), counted(is_deleted()).alias("SoftDeletedRecords"),
                             counted(first).alias("MissingEmailRecords"), counted(second).alias("MissingPhoneRecords"),
                             avg_int(days_old("ModifiedDate", as_of)).alias("AvgDaysOld"))
            .select(F.lit(name).alias("TableName"), "*") for name, (first, second) in checks.items()]
    return reduce(DataFrame.union, rows)


def kpi_parts(tables: Tables, order_aggs: list[Column], customer_aggs: list[Column],
              product_aggs: list[Column]) -> DataFrame:
    """One row of order aggregates with the customer and product aggregates beside it.

    Stands in for (customers ⟗ orders) × products: each order meets each product once there, so a sum over the product
    of tables equals the order sum times ``greatest(products, 1)``, while means and distinct counts do not change.
    """
    orders = tables["SalesOrderHeader"].withColumn("TotalDue", total_due())
    customers = tables["Customer"].agg(F.struct(F.count("*").alias("rows"), *customer_aggs)).scalar()
    products = tables["Product"].agg(F.struct(F.count("*").alias("rows"), *product_aggs)).scalar()
    return (orders.agg(F.count("*").alias("_orders"), *order_aggs)
            .withColumn("c", customers).withColumn("p", products)
            .withColumn("_times", F.greatest(F.col("p.rows"), F.lit(1)))
            .withColumn("_any", F.col("_orders") + F.col("c.rows") + F.col("p.rows") > 0))


def multiplied(c: str) -> Column:
    """Conditional sum as the table product gives it: 0 when no order qualifies, null only when all tables are empty."""
    zero = F.lit(0).cast("decimal(19,4)")
    return F.when(F.col("_any"), F.coalesce(c, zero) * F.col("_times").cast("decimal(12,0)"))


def business_kpi(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    """One row of headline numbers; sums carry the product multiple, ``*_corrected`` columns do not."""
    now = at(as_of)
    d30, d60 = shift(now, days=-30), shift(now, days=-60)
    live, due, placed = is_active(), F.col("TotalDue"), F.col("OrderDate")
    recent, previous = live & (placed >= d30), live & (placed >= d60) & (placed < d30)
    parts = kpi_parts(
        tables,
        [F.count_if(recent).alias("n30"), F.sum(F.when(recent, due)).alias("r30"),
         F.count_if(previous).alias("n60"), F.sum(F.when(previous, due)).alias("r60"),
         F.sum(due).alias("rall"), mean(due).alias("aov"), mean(F.when(recent, due)).alias("aov30")],
        [F.count_if((F.col("ModifiedDate") >= d30) & live).alias("fresh"), F.count_if(live).alias("live")],
        [F.count_if(live).alias("live")],
    )
    return parts.select(
        F.col("n30").alias("Orders_Last30Days"), F.col("c.fresh").alias("NewCustomers_Last30Days"),
        multiplied("r30").alias("Revenue_Last30Days"), F.col("n60").alias("Orders_Previous30Days"),
        multiplied("r60").alias("Revenue_Previous30Days"), F.col("c.rows").alias("TotalCustomers"),
        F.col("c.live").alias("ActiveCustomers"), F.col("p.rows").alias("TotalProducts"),
        F.col("p.live").alias("ActiveProducts"), F.col("_orders").alias("TotalOrders"),
        (F.col("rall") * F.col("_times").cast("decimal(12,0)")).alias("TotalRevenue"),
        F.col("aov").alias("AverageOrderValue"), F.col("aov30").alias("AOV_Last30Days"),
        F.coalesce("r30", F.lit(0).cast("decimal(19,4)")).alias("Revenue_Last30Days_corrected"),
        F.coalesce("r60", F.lit(0).cast("decimal(19,4)")).alias("Revenue_Previous30Days_corrected"),
        F.col("rall").alias("TotalRevenue_corrected"),
    )


# The published catalogue of views.
VIEW_CATALOG = [
    ("CustomerAnalytics", "Complete customer profile with transaction summary and segmentation",
     "Customer 360, Segmentation, CLV Analysis"),
    ("CustomerLifetimeValue", "Customer lifetime value analysis with churn risk assessment",
     "CLV Prediction, Churn Analysis, Customer Retention"),
    ("ProductPerformance", "Product sales performance and lifecycle analysis",
     "Product Analytics, Inventory Management, Pricing Strategy"),
    ("CategoryPerformance", "Product category performance with health scoring",
     "Category Management, Portfolio Analysis, Strategic Planning"),
    ("SalesTrendAnalysis", "Monthly sales trends with growth metrics",
     "Sales Forecasting, Trend Analysis, Performance Tracking"),
    ("OrderAnalysis", "Detailed order analysis with fulfillment metrics",
     "Order Management, Fulfillment Analysis, Customer Service"),
    ("DataQualityDashboard", "Data quality monitoring across all tables",
     "Data Governance, Quality Assurance, Data Management"),
    ("BusinessKPIDashboard", "Key business performance indicators",
     "Executive Dashboards, Performance Monitoring, Strategic Planning"),
]

VIEWS = {
    "CustomerAnalytics": customer_360,
    "CustomerLifetimeValue": customer_ltv,
    "ProductPerformance": product_performance,
    "CategoryPerformance": category_performance,
    "SalesTrendAnalysis": sales_trend,
    "OrderAnalysis": order_analysis,
    "DataQualityDashboard": data_quality,
    "BusinessKPIDashboard": business_kpi,
}


def view_catalog(spark) -> DataFrame:
    return spark.createDataFrame(VIEW_CATALOG, "ViewName string, Description string, UseCases string").orderBy("ViewName")


def view_catalog_status(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> DataFrame:
    """The catalogue with the columns each view exposes on the given tables and the rows of its driving table."""
    spark = tables["Customer"].sparkSession
    driving = {"CustomerAnalytics": "Customer", "CustomerLifetimeValue": "Customer", "ProductPerformance": "Product",
               "CategoryPerformance": "ProductCategory", "SalesTrendAnalysis": "SalesOrderHeader",
               "OrderAnalysis": "SalesOrderHeader", "DataQualityDashboard": "Customer",
               "BusinessKPIDashboard": "SalesOrderHeader"}
    counts = [tables[t].agg(F.count("*").alias("SourceRows")).select(F.lit(t).alias("SourceTable"), "SourceRows")
              for t in sorted(set(driving.values()))]
    source = spark.createDataFrame(list(driving.items()), "ViewName string, SourceTable string")
    return (view_catalog(spark).join(source, "ViewName").join(reduce(DataFrame.union, counts), "SourceTable")
            .select("ViewName", "Description", "UseCases", "SourceTable", "SourceRows").orderBy("ViewName"))


def deploy_views(tables: Tables, as_of: datetime, th: Thresholds = DEFAULTS) -> list[str]:
    """Register base tables and all views by name in the session, replacing earlier ones."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    for name, build in VIEWS.items():
        build(tables, as_of, th).createOrReplaceTempView(name)
    view_catalog(tables["Customer"].sparkSession).createOrReplaceTempView("ViewCatalog")
    return [*VIEWS, "ViewCatalog"]
