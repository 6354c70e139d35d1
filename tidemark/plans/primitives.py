"""The relational building blocks, each as one small query over the mirrored tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import TEST_THRESHOLDS, materialize, shared_dir
from tidemark.functions.columns import (
    at, avg_int, band, concat_nullable, datediff_sql, fiscal_year, format_n0, full_name, half_up, is_active, is_blank,
    is_deleted, line_total, matches_any, mean, pct_change, ratio, shift, total_due, value_map,
    week_of_year_sql,
)
from tidemark.functions.frames import (
    date_dim, neighbour, quantile_scores, rank_in_groups, rank_many, running_sums, share_of_total,
)
from tidemark.operators import changes
from tidemark.plans import views
from tidemark.sources.tables import Tables, append_rows, drop_views, table_inventory


def scan_project(t: Tables, as_of: datetime) -> DataFrame:
    return t["SalesOrderDetail"].select(
        "SalesOrderID", "ProductID", "OrderQty", (F.col("OrderQty") * F.col("UnitPrice")).alias("Gross"),
        line_total().alias("LineTotal"), line_total().cast("bigint").alias("WholeUnits"),
        (F.col("UnitPriceDiscount").cast("double") * 100).alias("DiscountPercent"))


def inventory(t: Tables, as_of: datetime) -> DataFrame:
    return table_inventory(t)


def literal_rows(t: Tables, as_of: datetime) -> DataFrame:
    """Literal status rows beside the orders that carry each status."""
    spark = t["Customer"].sparkSession
    codes = spark.createDataFrame(list(views.ORDER_STATUS.items()), "Status int, StatusName string")
    return codes.join(t["SalesOrderHeader"].groupBy("Status").agg(F.count("*").alias("n")), "Status", "left").select(
        "Status", "StatusName", F.coalesce("n", F.lit(0)).alias("Orders")).orderBy("Status")


def view_stack(t: Tables, as_of: datetime) -> DataFrame:
    """Lifetime value read through registered views on views, then removed again."""
    spark, prefix = t["Customer"].sparkSession, "stacked_"
    views.customer_360(t, as_of, TEST_THRESHOLDS).createOrReplaceTempView(f"{prefix}profile")
    views.ltv_from(spark.table(f"{prefix}profile")).createOrReplaceTempView(f"{prefix}ltv")
    out = spark.sql(f"SELECT CustomerSegment, ChurnRisk, count(*) AS Customers, sum(HistoricalCLV) AS Revenue,"
                    f" sum(PredictedCLV) AS Predicted FROM {prefix}ltv GROUP BY CustomerSegment, ChurnRisk")
    drop_views(spark, ["ltv", "profile"], prefix)
    return out


def date_spine(t: Tables, as_of: datetime) -> DataFrame:
    """Shipments per day of the calendar, with days without any."""
    spark, orders = t["Customer"].sparkSession, t["SalesOrderHeader"]
    first = orders.agg(F.min(F.to_date("OrderDate"))).scalar()
    shipped = orders.groupBy(F.to_date("ShipDate").alias("Date")).agg(F.count("*").alias("n"))
    return (date_dim(spark, first, as_of).join(shipped, "Date", "left")
            .select("Date", "Quarter", "WeekOfYear", "MonthName", "WeekdayName", "FiscalYear",
                    F.coalesce("n", F.lit(0)).alias("Shipments")))


def temp_result(t: Tables, as_of: datetime) -> DataFrame:
    """Rule results gathered in one small frame, then filtered like any table."""
    rules = [("email", "Customer", is_blank("EmailAddress")), ("phone", "Customer", is_blank("Phone")),
             ("cost", "Product", F.col("StandardCost") <= 0), ("amount", "SalesOrderHeader", F.col("SubTotal") <= 0)]
    found = reduce(DataFrame.union, [t[n].agg(F.count_if(c).alias("Hits")).select(
        F.lit(rule).alias("Rule"), F.lit(n).alias("TableName"), "Hits") for rule, n, c in rules])
    return found.filter(F.col("Hits") > 0)


def append(t: Tables, as_of: datetime) -> DataFrame:
    """A snapshot of live customers, deleted ones appended later, read back."""
    path = shared_dir(t["Customer"].sparkSession, "append")
    rows = t["Customer"].select("CustomerID", "LastName", "EmailAddress", "IsDeleted")
    append_rows(rows.filter(is_active()), path)
    append_rows(rows.filter(is_deleted()), path)
    return t["Customer"].sparkSession.read.schema(rows.schema).parquet(path)


def case_bands(t: Tables, as_of: datetime) -> DataFrame:
    size = band("SubTotal", [(375000, "LARGE"), (125000, "MEDIUM")], "SMALL")
    urgency = F.when(F.col("OnlineOrderFlag"), band("SubTotal", [(300000, "NOW")], "SOON")).otherwise(
        F.when(F.col("ShipDate").isNull(), "WAIT").otherwise("DONE"))
    carrier = value_map("ShipMethod", {"EXPEDITED": "air", "TRUCK GROUND": "road"}, "other")
    return t["SalesOrderHeader"].select("SalesOrderID", size.alias("Size"), views.order_status().alias("OrderStatus"),
                                        urgency.alias("Urgency"), carrier.alias("Carrier"))


def null_rules(t: Tables, as_of: datetime) -> DataFrame:
    return t["Customer"].select(
        "CustomerID", full_name().alias("FullName"),
        F.concat("FirstName", F.lit(" "), "MiddleName").alias("StrictName"),
        concat_nullable(F.col("FirstName"), F.col("MiddleName")).alias("LooseName"),
        F.coalesce("CompanyName", F.lit("private")).alias("Company"),
        F.nullif("EmailAddress", F.lit("")).alias("Email"), is_blank("EmailAddress").alias("NoEmail"),
        F.coalesce("DeletedDate", "ModifiedDate").alias("LastTouch"), is_active().alias("Active"))


def predicates(t: Tables, as_of: datetime) -> DataFrame:
    placed, method = F.col("OrderDate"), F.col("ShipMethod")
    in_year = (placed >= "1999-01-01") & (placed < "2000-01-01")
    picked = method.isin("EXPEDITED", "TRUCK GROUND") & ~F.col("Status").isin(4, 6)
    named = matches_any("PurchaseOrderNumber", ["PO-1%5", "PO-__7"]) & ~F.col("AccountNumber").like("ACC-1%")
    return t["SalesOrderHeader"].filter((in_year & picked & is_active()) | (named & F.col("ShipDate").isNotNull())).select(
        "SalesOrderID", "OrderDate", "ShipMethod", "Status", "PurchaseOrderNumber")


def key_set(t: Tables, as_of: datetime) -> DataFrame:
    keys = t["Customer"].filter(is_deleted() & F.col("CompanyName").isNull()).select("CustomerID")
    return t["SalesOrderHeader"].join(keys, "CustomerID", "left_semi").select("SalesOrderID", "CustomerID", "SubTotal")


def exists(t: Tables, as_of: datetime) -> DataFrame:
    """Products with and without a line of 50 units, and whether they are the dearest of their category and model."""
    big_lines = t["SalesOrderDetail"].filter(F.col("OrderQty") >= 50).select("ProductID").distinct()
    keys = ["ProductCategoryID", "ProductModelID"]
    goods = t["Product"].select("ProductID", *keys, "ListPrice")
    top = goods.groupBy(*keys).agg(F.max("ListPrice").alias("TopPrice"))
    have = goods.join(big_lines, "ProductID", "left_semi").withColumn("LargeLines", F.lit("YES"))
    lack = goods.join(big_lines, "ProductID", "left_anti").withColumn("LargeLines", F.lit("NO"))
    return have.union(lack).join(top, keys).select(
        "ProductID", "LargeLines", (F.col("ListPrice") == F.col("TopPrice")).alias("Dearest"))


def scalar_subquery(t: Tables, as_of: datetime) -> DataFrame:
    """Orders above both the overall mean and their customer's mean."""
    orders = t["SalesOrderHeader"]
    overall = orders.agg(mean("SubTotal")).scalar()
    own = orders.groupBy("CustomerID").agg(mean("SubTotal").alias("CustomerMean"))
    amount = F.col("SubTotal").cast("double")
    return orders.filter(amount > overall).join(own, "CustomerID").filter(amount > F.col("CustomerMean")).select(
        "SalesOrderID", "CustomerID", "SubTotal", "CustomerMean")


def inner_join(t: Tables, as_of: datetime) -> DataFrame:
    people = t["Customer"].select("CustomerID", "LastName", "CompanyName")
    heads = t["SalesOrderHeader"].select("SalesOrderID", "CustomerID", "OrderDate")
    return t["SalesOrderDetail"].join(heads, "SalesOrderID").join(people, "CustomerID").select(
        "SalesOrderID", "ProductID", "OrderQty", "CustomerID", "LastName", "CompanyName", "OrderDate")


def left_join_on_filter(t: Tables, as_of: datetime) -> DataFrame:
    """Products with their dimensions and last live sale; products never sold stay."""
    live = t["SalesOrderHeader"].filter(is_active()).select("SalesOrderID", "OrderDate")
    sold = (t["SalesOrderDetail"].select("SalesOrderID", "ProductID").join(live, "SalesOrderID")
            .groupBy("ProductID").agg(F.count("*").alias("n"), F.max("OrderDate").alias("LastLiveSale")))
    return views.with_dimensions(t["Product"], t).join(sold, "ProductID", "left").select(
        "ProductID", "CategoryName", "ModelName", F.coalesce("n", F.lit(0)).alias("LiveLines"), "LastLiveSale")


def full_outer(t: Tables, as_of: datetime) -> DataFrame:
    gone = t["Customer"].filter(is_deleted()).select(F.col("CustomerID").alias("c"), "DeletedDate")
    cancelled = (t["SalesOrderHeader"].filter(is_deleted()).groupBy(F.col("CustomerID").alias("o"))
                 .agg(F.count("*").alias("n"), F.sum("SubTotal").alias("s")))
    return gone.join(cancelled, F.col("c") == F.col("o"), "full_outer").select(
        F.coalesce("c", "o").alias("CustomerID"), F.col("DeletedDate").alias("ClosedOn"),
        F.coalesce("n", F.lit(0)).alias("DeletedOrders"), F.col("s").alias("DeletedAmount"))


def theta_full_outer(t: Tables, as_of: datetime) -> DataFrame:
    """Size and amount of (customers ⟗ orders) × products, from per-table numbers only."""
    orders = t["SalesOrderHeader"]
    idle = t["Customer"].join(orders.select("CustomerID").distinct(), "CustomerID", "left_anti").agg(F.count("*")).scalar()
    goods = t["Product"].agg(F.count("*")).scalar()
    left = F.col("n") + idle
    return (orders.agg(F.count("*").alias("n"), F.sum(total_due()).alias("due"))
            .select(left.alias("LeftRows"), goods.alias("ProductRows"),
                    F.when(left == 0, goods).otherwise(left * F.greatest(goods, F.lit(1))).alias("JoinedRows"),
                    (F.col("due") * F.greatest(goods, F.lit(1)).cast("decimal(12,0)")).alias("JoinedAmount")))


def lateral_max(t: Tables, as_of: datetime) -> DataFrame:
    """Latest order per customer, with the next free order key."""
    orders = t["SalesOrderHeader"]
    last = F.struct("OrderDate", "SalesOrderID")
    return orders.groupBy("CustomerID").agg(F.max(last).alias("last")).select(
        "CustomerID", F.col("last.SalesOrderID").alias("LastOrderID"), F.col("last.OrderDate").alias("LastOrderDate"),
        (orders.agg(F.max("SalesOrderID")).scalar() + 1).alias("NextOrderID"))


def update_from(t: Tables, as_of: datetime) -> DataFrame:
    """Orders of closed customers put on hold."""
    closed = t["Customer"].filter(is_deleted()).select("CustomerID", "DeletedDate")
    out = changes.update_from(t["SalesOrderHeader"], closed, "CustomerID",
                              {"ShipMethod": F.lit("HOLD"), "DueDate": F.greatest("DueDate", "_dim_DeletedDate")}, as_of)
    return out.select("SalesOrderID", "CustomerID", "ShipMethod", "DueDate", "ModifiedDate")


def delete_from(t: Tables, as_of: datetime) -> DataFrame:
    """What is left per product once lines of deleted orders and of named products are removed."""
    doomed = t["SalesOrderHeader"].filter(is_deleted()).select("SalesOrderID")
    named = t["Product"].filter(F.col("Name").like("%bolt%")).select("ProductID")
    kept = t["SalesOrderDetail"].join(doomed, "SalesOrderID", "left_anti").join(named, "ProductID", "left_anti")
    return kept.groupBy("ProductID").agg(F.count("*").alias("Lines"), F.sum("OrderQty").alias("Units"))


def agg_basic(t: Tables, as_of: datetime) -> DataFrame:
    o = t["SalesOrderHeader"]
    return (o.groupBy(F.year("OrderDate").alias("Year"), F.month("OrderDate").alias("Month"))
            .agg(F.count("*").alias("Orders"), F.count("ShipDate").alias("Shipped"), F.sum("SubTotal").alias("Amount"),
                 F.min("SubTotal").alias("Smallest"), F.max("SubTotal").alias("Largest"), mean("SubTotal").alias("Mean"),
                 avg_int("Status").alias("MeanStatus"))
            .filter(F.col("Orders") > 20))


def agg_conditional(t: Tables, as_of: datetime) -> DataFrame:
    """Per ship method: conditional counts, sums and means, and a ratio of two sums."""
    amount, live = F.col("SubTotal"), is_active()
    shipped = F.col("Status") == 5
    zero = F.lit(0).cast("decimal(19,4)")
    return t["SalesOrderHeader"].groupBy("ShipMethod").agg(
        F.count_distinct(F.when(shipped, F.col("CustomerID"))).alias("ShippedCustomers"),
        F.sum(F.when(live, 1).otherwise(0)).alias("LiveOrders"),
        F.sum(F.when(F.col("OrderDate") >= "2001-01-01", amount).otherwise(zero)).alias("AmountThisYear"),
        mean(F.when(shipped, amount)).alias("MeanShipped"),
        mean(F.when(shipped, amount).otherwise(zero)).alias("MeanShippedOrZero"),
        ratio(F.sum(F.when(shipped, amount)), F.sum(amount)).alias("ShippedShare"))


def distinct_per_group(df: DataFrame, group: str, columns: dict[str, str]) -> DataFrame:
    """Several distinct counts per group, one deduplication per column instead of one multiplied row set."""
    out = df.select(F.col(group).alias("g")).distinct()
    for column, name in columns.items():
        part = (df.select(F.col(group).alias("h"), column).distinct().groupBy("h").agg(F.count(column).alias(name)))
        out = out.join(part, F.col("g").eqNullSafe(F.col("h")), "left").drop("h")
    return out.withColumnRenamed("g", group)


def agg_distinct(t: Tables, as_of: datetime) -> DataFrame:
    return distinct_per_group(t["SalesOrderHeader"].withColumn("Day", F.to_date("OrderDate")), "ShipMethod",
                              {"CustomerID": "Customers", "Day": "Days", "ShipDate": "ShipDates"})


def agg_global_having(t: Tables, as_of: datetime) -> DataFrame:
    """A global aggregate that gives a row for a filled range and none for an empty one."""
    def over(label: str, start: str) -> DataFrame:
        return (t["SalesOrderHeader"].filter(F.col("OrderDate") >= F.lit(start).cast("timestamp"))
                .agg(F.count("*").alias("Samples"), mean("SubTotal").alias("Mean"), F.max("SubTotal").alias("Peak"),
                     F.min("OrderDate").alias("RangeStart"), F.max("OrderDate").alias("RangeEnd"))
                .filter(F.col("Samples") > 0).select(F.lit(label).alias("RangeName"), "*"))
    return over("recent", "2001-07-01").union(over("future", "2100-01-01"))


def ranked_global(t: Tables, as_of: datetime) -> DataFrame:
    orders = t["SalesOrderHeader"].select("SalesOrderID", "SubTotal", "OrderDate")
    timed = orders.withColumn("_micros", F.unix_micros("OrderDate"))
    return rank_many(timed, [("SubTotal", "AmountRank", False), ("_micros", "DateRank", True)], key="SalesOrderID").drop("_micros")


def ranked_partition(t: Tables, as_of: datetime) -> DataFrame:
    orders = t["SalesOrderHeader"].select("SalesOrderID", "ShipMethod", "SubTotal")
    return rank_in_groups(orders, "ShipMethod", "SubTotal", "MethodRank")


def monthly(t: Tables) -> DataFrame:
    return (t["SalesOrderHeader"].filter(is_active()).groupBy(F.trunc("OrderDate", "month").alias("Month"))
            .agg(F.sum("SubTotal").alias("Amount"), F.count("*").alias("Orders")))


def lag(t: Tables, as_of: datetime) -> DataFrame:
    by_month = Window.orderBy("Month")  # one row per month
    return (monthly(t).withColumn("Previous", F.lag("Amount", 1).over(by_month))
            .withColumn("YearAgo", F.lag("Amount", 12).over(by_month))
            .withColumn("GrowthPercent", pct_change(F.col("Amount"), F.col("Previous"))))


def lag_calendar(t: Tables, as_of: datetime) -> DataFrame:
    """The same month a year ago by the calendar, whatever months are missing."""
    m = monthly(t)
    past = m.select(F.to_date(F.add_months("Month", 12)).alias("Month"), F.col("Amount").alias("YearAgo"))
    return m.join(past, "Month", "left").select("Month", "Amount", "YearAgo")


def lag_partition(t: Tables, as_of: datetime) -> DataFrame:
    orders = t["SalesOrderHeader"].select("SalesOrderID", "CustomerID", "OrderDate", "SubTotal")
    return neighbour(orders, ["CustomerID"], ["OrderDate", "SalesOrderID"], F.col("SubTotal"), "PreviousSubTotal")


def running_sum(t: Tables, as_of: datetime) -> DataFrame:
    in_year = (Window.partitionBy(F.year("Month")).orderBy("Month")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return monthly(t).withColumn("YearToDate", F.sum("Amount").over(in_year))


def prefix_sums(t: Tables, as_of: datetime) -> DataFrame:
    """Revenue of each product up to each of its orders, and of everything up to each order line, in the order of the orders."""
    sold = t["SalesOrderDetail"].groupBy("ProductID", "SalesOrderID").agg(F.sum(line_total()).alias("Revenue"))
    sold = materialize(sold, "sold")
    by_product = running_sums(sold, ["ProductID"], ["SalesOrderID"], {"ProductToDate": F.col("Revenue")})
    return running_sums(materialize(by_product, "to-date"), [], ["SalesOrderID", "ProductID"], {"TotalToDate": F.col("Revenue")})


def share(t: Tables, as_of: datetime) -> DataFrame:
    """Revenue of category and model: share of all, share of the category, and standing against the mean."""
    goods = t["Product"].select("ProductID", "ProductCategoryID", "ProductModelID")
    sold = views.lines_per_product(t["SalesOrderDetail"]).select("ProductID", F.col("_revenue").alias("r"))
    cells = goods.join(sold, "ProductID").groupBy("ProductCategoryID", "ProductModelID").agg(F.sum("r").alias("Revenue"))
    usual = cells.agg(mean("Revenue")).scalar()
    out = share_of_total(cells, "Revenue", "ShareOfAll")
    out = share_of_total(out, "Revenue", "ShareOfCategory", by="ProductCategoryID")
    return out.withColumn("Standing", F.when(F.col("Revenue").cast("double") >= usual * 1.5, "High")
                          .when(F.col("Revenue").cast("double") >= usual * 0.8, "Normal").otherwise("Low"))


def ntile_bands(t: Tables, as_of: datetime) -> DataFrame:
    spend = t["SalesOrderHeader"].groupBy("CustomerID").agg(F.sum("SubTotal").cast("decimal(29,4)").alias("Spend"))
    return quantile_scores(materialize(spend, "spend"), [("Spend", "Quintile", True)])


def top_k(t: Tables, as_of: datetime) -> DataFrame:
    return (t["SalesOrderHeader"].select("SalesOrderID", "CustomerID", "SubTotal", "OrderDate")
            .orderBy(F.desc("SubTotal"), "SalesOrderID").limit(10))


def unpivot(t: Tables, as_of: datetime) -> DataFrame:
    """Metric rows from one row of totals."""
    totals = t["SalesOrderHeader"].agg(F.sum("SubTotal").alias("SubTotal"), F.sum("TaxAmt").alias("TaxAmt"),
                                       F.sum("Freight").alias("Freight"))
    return totals.unpivot([], ["SubTotal", "TaxAmt", "Freight"], "Metric", "Amount")


def strings_dates(t: Tables, as_of: datetime) -> DataFrame:
    placed, due, now = F.col("OrderDate"), F.col("DueDate"), at(as_of)
    touched = shift(placed, hours=1, minutes=1) + F.make_dt_interval(mins=(F.col("SalesOrderID") % 1440).cast("int"))
    return t["SalesOrderHeader"].select(
        "SalesOrderID", F.replace(F.replace(F.col("PurchaseOrderNumber"), F.lit("PO-"), F.lit("P")), F.lit("1"), F.lit("I"))
        .alias("Code"), F.date_format(touched, "yyyy-MM-dd HH:mm:ss").alias("Stamp"),
        F.concat("PurchaseOrderNumber", F.lit("-"), F.date_format(now, "yyyyMMddHHmmss")).alias("UniqueCode"),
        format_n0(F.col("SubTotal")).alias("Shown"), F.date_format(placed, "MMM yyyy").alias("MonthLabel"),
        shift(placed, months=-1).alias("MonthBefore"), shift(placed, years=1, days=-30).alias("YearAfter"),
        datediff_sql("day", placed, due).alias("DaysDue"), datediff_sql("hour", placed, touched).alias("Hours"),
        datediff_sql("minute", placed, touched).alias("Minutes"), datediff_sql("month", placed, now).alias("Months"),
        datediff_sql("year", placed, now).alias("Years"), datediff_sql("quarter", placed, now).alias("Quarters"),
        datediff_sql("week", placed, now).alias("Weeks"), F.to_date(touched).alias("Day"),
        half_up(F.col("SubTotal") / 3, 1).alias("Third"), week_of_year_sql(placed).alias("Week"),
        fiscal_year(placed).alias("FiscalYear"), F.col("DeletedBy").alias("Actor"),
        F.col("SubTotal").cast("string").alias("Text"))


def lateral_top(t: Tables, as_of: datetime) -> DataFrame:
    """The three largest lines of every live order."""
    # the outer key has a name that no frame under the lines holds, or it would be taken for the lines' own
    orders = t["SalesOrderHeader"].filter(is_active()).select(F.col("SalesOrderID").alias("_outer"), "CustomerID")
    lines = t["SalesOrderDetail"].select("SalesOrderID", "ProductID", "OrderQty", line_total().alias("LineTotal"))
    largest = (lines.filter(F.col("SalesOrderID") == F.col("_outer").outer()).orderBy(F.desc("LineTotal"), "ProductID", "OrderQty").limit(3)
               .select("ProductID", "OrderQty", "LineTotal"))
    return orders.lateralJoin(largest).withColumnRenamed("_outer", "SalesOrderID")


def self_join(t: Tables, as_of: datetime) -> DataFrame:
    """Each order beside the order with the key before it, kept without one."""
    o = t["SalesOrderHeader"].select("SalesOrderID", "CustomerID", "SubTotal")
    parent = o.select((F.col("SalesOrderID") + 1).alias("SalesOrderID"), F.col("CustomerID").alias("ParentCustomerID"),
                      F.col("SubTotal").alias("ParentSubTotal"))
    return o.join(parent, "SalesOrderID", "left").withColumn("Larger", F.col("SubTotal") > F.col("ParentSubTotal"))


PRIMITIVES = {
    "op_scan_project": scan_project, "op_inventory": inventory, "op_literal_rows": literal_rows,
    "op_view_stack": view_stack, "op_date_spine": date_spine, "op_temp_result": temp_result, "op_append": append,
    "op_case_bands": case_bands, "op_null_rules": null_rules, "op_predicates": predicates, "op_key_set": key_set,
    "op_exists": exists, "op_scalar_subquery": scalar_subquery, "op_inner_join": inner_join,
    "op_left_join_on_filter": left_join_on_filter, "op_full_outer": full_outer, "op_theta_full_outer": theta_full_outer,
    "op_self_join": self_join, "op_lateral_max": lateral_max, "op_update_from": update_from,
    "op_delete_from": delete_from, "op_agg_basic": agg_basic, "op_agg_conditional": agg_conditional,
    "op_agg_distinct": agg_distinct, "op_agg_global_having": agg_global_having, "op_rank_global": ranked_global,
    "op_rank_partition": ranked_partition, "op_lag": lag, "op_lag_calendar": lag_calendar,
    "op_lag_partition": lag_partition, "op_running_sum": running_sum, "op_prefix_sums": prefix_sums, "op_lateral_top": lateral_top, "op_share": share, "op_ntile_bands": ntile_bands,
    "op_top_k": top_k, "op_unpivot": unpivot, "op_strings_dates": strings_dates,
}
