"""Reference SQL for the report queries."""

from tidemark.oracle.base import (
    DUE, LINE, NOW, avg, avgi, big, dd, div, gone, growth, live, mirror_sql, pct, rnd, ts, usd,
)
from tidemark.oracle.views import C360, CAT, CAT_FIXED, DQ, KPI, LTV, ORDERS, PERF, TREND, TREND_FIXED

KEPT = "o.IsDeleted = FALSE"
M1, M2, Y1, Y2 = (f"({NOW} - INTERVAL {x})" for x in ("1 MONTH", "2 MONTH", "1 YEAR", "2 YEAR"))
T1 = f"{KEPT} AND o.OrderDate >= {M1}"
T2 = f"{KEPT} AND o.OrderDate >= {M2} AND o.OrderDate < {M1}"

MONTHS = f"""
SELECT date_trunc('month', o.OrderDate) AS m, sum(o.SubTotal) AS rev, sum(o.TaxAmt) AS tax, sum(o.Freight) AS ship,
  sum({DUE}) AS due, count(DISTINCT o.SalesOrderID) AS n, count(DISTINCT o.CustomerID) AS c, sum(l.OrderQty) AS u, {avg(DUE)} AS aov
FROM m_order o JOIN m_line l USING (SalesOrderID) WHERE {KEPT} AND o.OrderDate >= {Y2} GROUP BY 1"""

RFM_RAW = f"""
SELECT o.CustomerID, {dd('max(o.OrderDate)', NOW)} AS Recency, count(*) AS Frequency, sum(o.SubTotal) AS Monetary
FROM m_order o WHERE {live('o')} GROUP BY 1"""
RFM_SCORED = """
SELECT *, (rank() OVER (ORDER BY Recency DESC) - 1) * 5 // count(*) OVER () + 1 AS r,
  (rank() OVER (ORDER BY Frequency) - 1) * 5 // count(*) OVER () + 1 AS f,
  (rank() OVER (ORDER BY Monetary) - 1) * 5 // count(*) OVER () + 1 AS m FROM raw"""
RFM = """
SELECT *, CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'Champions' WHEN f >= 4 AND m >= 3 THEN 'Loyal'
  WHEN r >= 4 AND f <= 2 THEN 'New' WHEN r <= 2 AND f >= 3 THEN 'At Risk' WHEN r <= 2 AND f <= 2 THEN 'Lost'
  ELSE 'Regular' END AS seg FROM scored"""

COHORT = f"""
SELECT CohortMonth, count(*) AS n, sum(rev) AS rev, {avg('rev')} AS per, {avg('k')} AS orders, count(*) FILTER (months >= 2) AS kept
FROM (SELECT o.CustomerID, date_trunc('month', min(o.OrderDate)) AS CohortMonth, sum(o.SubTotal) AS rev, count(*) AS k,
        count(DISTINCT date_trunc('month', o.OrderDate)) AS months FROM m_order o WHERE {live('o')} GROUP BY 1) GROUP BY 1"""

DAYS = f"""
SELECT date_trunc('day', o.OrderDate) AS d, count(DISTINCT o.SalesOrderID) AS n, count(DISTINCT o.CustomerID) AS c,
  sum({DUE}) AS due, {avg(DUE)} AS aov, sum(l.OrderQty) AS u
FROM m_order o JOIN m_line l USING (SalesOrderID) WHERE {KEPT} AND o.OrderDate >= {NOW} - INTERVAL 90 DAY GROUP BY 1"""

CHANNEL = f"""
SELECT CASE WHEN o.OnlineOrderFlag THEN 'Online' ELSE 'Offline' END AS SalesChannel, count(DISTINCT o.SalesOrderID) AS n,
  count(DISTINCT o.CustomerID) AS c, sum({DUE}) AS due, {avg(DUE)} AS aov, sum(l.OrderQty) AS u, {avgi('l.OrderQty')} AS q,
  {avg('l.UnitPriceDiscount')} AS disc, {avgi(dd('o.OrderDate', 'o.ShipDate'))} AS ship
FROM m_order o JOIN m_line l USING (SalesOrderID) WHERE {KEPT} AND o.OrderDate >= {Y1} GROUP BY o.OnlineOrderFlag"""


# once-per-order forms: header amounts from the orders alone, volumes from the lines
HAS_LINES = "EXISTS (SELECT 1 FROM m_line l WHERE l.SalesOrderID = o.SalesOrderID)"


def once(group: str, heads: str, volumes: str, since: str) -> str:
    keep = f"{KEPT} AND o.OrderDate >= {since}"
    return f"""SELECT * FROM (SELECT {group} AS g, {heads} FROM m_order o WHERE {keep} AND {HAS_LINES} GROUP BY 1)
      JOIN (SELECT {group} AS g, {volumes} FROM m_order o JOIN m_line l USING (SalesOrderID) WHERE {keep} GROUP BY 1) USING (g)"""


_HEADS = f"count(*) AS n, count(DISTINCT o.CustomerID) AS c, sum({DUE}) AS due, {avg(DUE)} AS aov"
MONTHS_ONCE = "SELECT g AS m, * FROM (" + once(
    "date_trunc('month', o.OrderDate)", f"sum(o.SubTotal) AS rev, sum(o.TaxAmt) AS tax, sum(o.Freight) AS ship, {_HEADS}",
    "sum(l.OrderQty) AS u", Y2) + ")"
DAYS_ONCE = "SELECT g AS d, * FROM (" + once("date_trunc('day', o.OrderDate)", _HEADS, "sum(l.OrderQty) AS u", f"{NOW} - INTERVAL 90 DAY") + ")"
CHANNEL_ONCE = "SELECT CASE WHEN g = 1 THEN 'Online' ELSE 'Offline' END AS SalesChannel, * FROM (" + once(
    "CASE WHEN o.OnlineOrderFlag THEN 1 WHEN NOT o.OnlineOrderFlag THEN 0 ELSE -1 END", f"{_HEADS}, {avgi(dd('o.OrderDate', 'o.ShipDate'))} AS ship",
    f"sum(l.OrderQty) AS u, {avgi('l.OrderQty')} AS q, {avg('l.UnitPriceDiscount')} AS disc", Y1) + ")"


def n0(x: str) -> str:
    return f"format('{{:,}}', CAST(round(CAST({x} AS DECIMAL(28,10)), 0) AS BIGINT))"


_q = "100.0::DOUBLE - " + " - ".join(
    div(f"({col} * CASE TableName WHEN 'Customer' THEN {a} WHEN 'Product' THEN {b} ELSE {c} END)", "TotalRecords")
    for col, a, b, c in (("MissingEmailRecords", 30, 40, 35), ("MissingPhoneRecords", 20, 30, 25),
                         ("SoftDeletedRecords", 10, 5, 10)))
_kept = div("clive", "call")
_trend = "CASE WHEN {0} >= {1} THEN 'Positive' ELSE 'Negative' END"
_health = (f"{div('ActiveProducts', 'TotalProducts')} * 50 + least(AverageMarginPercent / 100, 1.0::DOUBLE) * 30"
           f" + {div('revenue', 'sum(revenue) OVER ()')} * 20")

_MONTHLY = f"""
      SELECT {big('year(m)')} AS OrderYear, {big('month(m)')} AS OrderMonth, {ts('m')} AS MonthYear, strftime(m, '%B %Y') AS MonthName,
        {usd('rev')} AS Revenue, {usd('tax')} AS Tax, {usd('ship')} AS Shipping, {usd('due')} AS GrandTotal, n AS OrderCount,
        c AS UniqueCustomers, {big('u')} AS TotalUnits, aov AS AverageOrderValue, {div('rev', 'u')} AS RevenuePerUnit,
        {usd('lag(due, 1) OVER (ORDER BY m)')} AS PreviousMonthRevenue, {usd('lag(due, 12) OVER (ORDER BY m)')} AS SameMonthLastYearRevenue
      FROM t"""

_CATEGORY = f"""
      SELECT CategoryName, {big('TotalProducts')} AS TotalProducts, {big('ActiveProducts')} AS ActiveProducts,
        {big('DiscontinuedProducts')} AS DiscontinuedProducts, {usd('revenue')} AS TotalRevenue, {big('units')} AS TotalUnitsSold,
        AverageProductPrice, {usd('MinPrice')} AS MinPrice, {usd('MaxPrice')} AS MaxPrice, AverageMarginPercent,
        {big('customers')} AS UniqueCustomers, h AS CategoryHealthScore, {rnd(div('revenue', 'TotalProducts'))} AS RevenuePerProduct,
        {big('units // TotalProducts')} AS UnitsPerProduct, {rnd(div('revenue', 'customers'))} AS RevenuePerCustomer,
        rank() OVER (ORDER BY revenue DESC) AS RevenueRank, rank() OVER (ORDER BY h DESC) AS HealthRank,
        {pct('revenue', 'sum(revenue) OVER ()')} AS PortfolioContribution
      FROM (SELECT *, {rnd(_health)} AS h FROM cat)"""

_SALES = f"""
      SELECT {big('year(MonthYear)')} AS OrderYear, {big('month(MonthYear)')} AS OrderMonth, {ts('MonthYear')} AS MonthYear, TotalOrders,
        UniqueCustomers, UniqueProductsSold, {usd('TotalRevenue')} AS TotalRevenue, AverageOrderValue, {big('TotalQuantitySold')} AS TotalQuantitySold,
        {usd('GrandTotal')} AS GrandTotal, {growth('TotalRevenue', 'p')} AS MoM_Growth_Percent, {growth('TotalRevenue', 'y')} AS YoY_Growth_Percent,
        CASE WHEN TotalRevenue >= p THEN 'Positive' ELSE 'Negative' END AS MoM_Trend, {usd('ytd')} AS YTD_Revenue
      FROM (SELECT *, lag(TotalRevenue) OVER (ORDER BY MonthYear) AS p, lag(TotalRevenue, 12) OVER (ORDER BY MonthYear) AS y,
              sum(TotalRevenue) OVER (PARTITION BY year(MonthYear) ORDER BY MonthYear ROWS UNBOUNDED PRECEDING) AS ytd FROM t)"""

_DAILY = f"""
      SELECT {ts('d')} AS OrderDate, dayname(d) AS DayOfWeek, n AS OrderCount, c AS UniqueCustomers, {usd('due')} AS DailyRevenue, aov AS AvgOrderValue,
        {big('u')} AS TotalUnits, {usd('lag(due, 1) OVER (ORDER BY d)')} AS PreviousDayRevenue, {usd('lag(due, 7) OVER (ORDER BY d)')} AS SameDayLastWeekRevenue,
        CASE WHEN CAST(due AS DOUBLE) >= usual * 1.5::DOUBLE THEN 'High' WHEN CAST(due AS DOUBLE) >= usual * 0.8::DOUBLE THEN 'Normal' ELSE 'Low' END AS DayPerformance
      FROM t, (SELECT {avg('due')} AS usual FROM t)"""

_CHANNEL = f"""
      SELECT SalesChannel, n AS OrderCount, c AS UniqueCustomers, {usd('due')} AS TotalRevenue, aov AS AvgOrderValue, {big('u')} AS TotalUnits,
        q AS AvgQuantityPerOrder, disc AS AvgDiscountRate, ship AS AvgShippingDays, {pct('n', 'sum(n) OVER ()')} AS OrderShare,
        {pct('due', 'sum(due) OVER ()')} AS RevenueShare FROM t"""

SQL = {
    "exec_kpi": mirror_sql(f"""
      SELECT {usd('r1 * greatest(p, 1)')} AS Revenue_ThisMonth, {usd('r2 * greatest(p, 1)')} AS Revenue_LastMonth,
        {usd('ry * greatest(p, 1)')} AS Revenue_YTD, n1 AS Orders_ThisMonth, n2 AS Orders_LastMonth,
        cn AS NewCustomers_ThisMonth, cl AS TotalActiveCustomers, cg AS ChurnedCustomers, pl AS ActiveProducts,
        pg AS DiscontinuedProducts, coalesce({growth('r1', 'r2')}, 0) AS Revenue_MoM_Growth_Percent, aov AS AOV_ThisMonth,
        {usd('r1')} AS Revenue_ThisMonth_corrected, {usd('r2')} AS Revenue_LastMonth_corrected, {usd('ry')} AS Revenue_YTD_corrected
      FROM (SELECT coalesce(sum({DUE}) FILTER ({T1}), 0) AS r1, coalesce(sum({DUE}) FILTER ({T2}), 0) AS r2,
              coalesce(sum({DUE}) FILTER ({KEPT} AND o.OrderDate >= {Y1}), 0) AS ry, count(*) FILTER ({T1}) AS n1,
              count(*) FILTER ({T2}) AS n2, {div(f'sum({DUE}) FILTER ({T1})', f'count(*) FILTER ({T1})')} AS aov FROM m_order o),
        (SELECT count(*) FILTER (IsDeleted = FALSE AND ModifiedDate >= {M1}) AS cn, count(*) FILTER (IsDeleted = FALSE) AS cl,
              count(*) FILTER (IsDeleted = TRUE) AS cg FROM m_customer),
        (SELECT count(*) AS p, count(*) FILTER (NOT IsDeleted) AS pl, count(*) FILTER (IsDeleted) AS pg FROM m_product)"""),
    "monthly_revenue_trend": mirror_sql(_MONTHLY, t=MONTHS),
    "monthly_revenue_trend_corrected": mirror_sql(_MONTHLY, t=MONTHS_ONCE),
    "segment_overview": mirror_sql(f"""
      SELECT CustomerSegment, count(*) AS CustomerCount, {usd('sum(TotalRevenue)')} AS SegmentRevenue, {avg('TotalRevenue')} AS AvgRevenuePerCustomer,
        {avgi('TotalOrders')} AS AvgOrdersPerCustomer, {avg('round(CAST(AverageOrderValue AS DECIMAL(28,10)), 4)')} AS AvgOrderValue,
        count(*) FILTER (EngagementStatus = 'ACTIVE') AS ActiveCustomers, count(*) FILTER (EngagementStatus = 'AT_RISK') AS AtRiskCustomers,
        count(*) FILTER (EngagementStatus = 'CHURNED') AS ChurnedCustomers, count(*) FILTER (CustomerType = 'B2B') AS B2B_Count,
        count(*) FILTER (CustomerType = 'B2C') AS B2C_Count,
        {pct('sum(TotalRevenue)', '(SELECT sum(TotalRevenue) FROM c360)')} AS SegmentRevenuePercent FROM c360 GROUP BY 1""", c360=C360),
    "top_customers": mirror_sql(f"""
      SELECT v.CustomerID, v.FullName, v.CompanyName, v.CustomerType, v.CustomerSegment, v.AccountStatus, {usd('v.HistoricalCLV')} AS HistoricalCLV,
        {usd('v.PredictedCLV')} AS PredictedCLV, {big('v.TotalOrders')} AS TotalOrders, v.AverageOrderValue, v.ChurnRisk, v.EngagementStatus,
        v.DaysSinceLastActivity, rank() OVER (ORDER BY v.HistoricalCLV DESC) AS RevenueRank, c.EmailAddress, c.Phone,
        c.ModifiedDate AS RegistrationDate
      FROM ltv v JOIN m_customer c USING (CustomerID) WHERE v.HistoricalCLV > 0""", c360=C360, ltv=LTV),
    "rfm_base": mirror_sql(f"""SELECT CustomerID, Recency, Frequency, {usd('Monetary')} AS Monetary, {big('r')} AS R_Score, {big('f')} AS F_Score,
      {big('m')} AS M_Score, seg AS CustomerSegment FROM rfm""", raw=RFM_RAW, scored=RFM_SCORED, rfm=RFM),
    "rfm_segments": mirror_sql(f"""
      SELECT seg AS CustomerSegment, count(*) AS CustomerCount, {avgi('Recency')} AS AvgRecency, {avgi('Frequency')} AS AvgFrequency,
        {avg('Monetary')} AS AvgMonetary, {avgi('r')} AS AvgRecencyScore, {avgi('f')} AS AvgFrequencyScore, {avgi('m')} AS AvgMonetaryScore,
        {usd('min(Monetary)')} AS MinSpent, {usd('max(Monetary)')} AS MaxSpent, min(Frequency) AS MinOrders, max(Frequency) AS MaxOrders,
        {usd('sum(Monetary)')} AS TotalSegmentRevenue, {pct('sum(Monetary)', '(SELECT sum(Monetary) FROM raw)')} AS RevenuePercent
      FROM rfm GROUP BY 1""", raw=RFM_RAW, scored=RFM_SCORED, rfm=RFM),
    "product_overview": mirror_sql(f"""
      SELECT ProductID, ProductName, ProductNumber, Color, Size, CategoryName, ProductStatus, {usd('ListPrice')} AS ListPrice,
        {usd('StandardCost')} AS StandardCost, {usd('ProfitMarginPercent')} AS ProfitMarginPercent, {big('TimesSold')} AS TimesSold,
        {big('TotalUnitsSold')} AS TotalUnitsSold, {usd('TotalRevenue')} AS TotalRevenue, AverageSellingPrice, LastSaleDate,
        PerformanceCategory, ProductLifespanDays, InventoryClassification, rank() OVER (ORDER BY TotalRevenue DESC) AS RevenueRank,
        rank() OVER (ORDER BY TotalUnitsSold DESC) AS VolumeRank, rank() OVER (ORDER BY ProfitMarginPercent DESC) AS MarginRank,
        {pct('TotalRevenue', 'sum(TotalRevenue) OVER ()')} AS RevenueContributionPercent
      FROM perf WHERE TotalRevenue > 0 OR ProductStatus = 'ACTIVE'""", perf=PERF),
    "category_analysis": mirror_sql(_CATEGORY, cat=CAT),
    "category_analysis_corrected": mirror_sql(_CATEGORY, cat=CAT_FIXED),
    "top_products_by_category": mirror_sql(f"""
      SELECT CategoryName, ProductID, ProductName, ProductNumber, Color, {usd('ListPrice')} AS ListPrice, {usd('TotalRevenue')} AS TotalRevenue,
        {big('TotalUnitsSold')} AS TotalUnitsSold, {usd('ProfitMarginPercent')} AS ProfitMarginPercent, PerformanceCategory, ProductStatus,
        rank() OVER (PARTITION BY CategoryName ORDER BY TotalRevenue DESC) AS CategoryRank,
        {pct('TotalRevenue', 'sum(TotalRevenue) OVER (PARTITION BY CategoryName)')} AS CategoryContribution
      FROM perf WHERE TotalRevenue > 0""", perf=PERF),
    "portfolio": mirror_sql(f"""
      SELECT CategoryName, ProductStatus, n AS ProductCount, {usd('rev')} AS CategoryStatusRevenue, price AS AvgPrice, margin AS AvgMargin,
        {big('u')} AS TotalUnits, {pct('rev', 'sum(rev) OVER (PARTITION BY CategoryName)')} AS CategoryContribution,
        {pct('n', 'sum(n) OVER (PARTITION BY CategoryName)')} AS ProductCountPercent,
        CASE WHEN rev >= 1000 THEN (CASE WHEN margin >= 30 THEN 'Star Products' ELSE 'Cash Cows' END)
             WHEN margin >= 30 THEN 'Question Marks' ELSE 'Dogs' END AS BCGClassification
      FROM (SELECT CategoryName, ProductStatus, count(*) n, sum(TotalRevenue) rev, {avg('ListPrice')} price,
              {avg('ProfitMarginPercent')} margin, sum(TotalUnitsSold) u FROM perf GROUP BY 1, 2)""", perf=PERF),
    "sales_performance": mirror_sql(_SALES, t=TREND),
    "sales_performance_corrected": mirror_sql(_SALES, t=TREND_FIXED),
    "order_status": mirror_sql(f"""
      SELECT OrderStatus, n AS OrderCount, {usd('rev')} AS TotalRevenue, aov AS AvgOrderValue, items AS AvgItemsPerOrder, qty AS AvgQuantityPerOrder,
        sd AS AvgDaysToShip, ok AS OnTimeOrders, late AS LateOrders, od AS OverdueOrders, lg AS LargeOrders, md AS MediumOrders, sm AS SmallOrders,
        b2b AS B2B_Orders, b2c AS B2C_Orders, {pct('n', 'sum(n) OVER ()')} AS OrderStatusPercent, {pct('ok', '(ok + late)')} AS OnTimeDeliveryPercent
      FROM (SELECT OrderStatus, count(*) n, sum(TotalDue) rev, {avg('TotalDue')} aov, {avgi('LineItemCount')} items, {avgi('TotalQuantity')} qty,
        {avgi('DaysToShip')} sd, count(*) FILTER (DeliveryPerformance = 'ON_TIME') ok, count(*) FILTER (DeliveryPerformance = 'LATE') late,
        count(*) FILTER (DeliveryPerformance = 'OVERDUE') od, count(*) FILTER (OrderSize = 'LARGE') lg, count(*) FILTER (OrderSize = 'MEDIUM') md,
        count(*) FILTER (OrderSize = 'SMALL') sm, count(*) FILTER (OrderType = 'B2B') b2b, count(*) FILTER (OrderType = 'B2C') b2c
        FROM oa GROUP BY 1)""", oa=ORDERS),
    "daily_sales": mirror_sql(_DAILY, t=DAYS),
    "daily_sales_corrected": mirror_sql(_DAILY, t=DAYS_ONCE),
    "channel_performance": mirror_sql(_CHANNEL, t=CHANNEL),
    "channel_performance_corrected": mirror_sql(_CHANNEL, t=CHANNEL_ONCE),
    "dq_scores": mirror_sql(f"""
      SELECT TableName, TotalRecords, SoftDeletedRecords, {pct('SoftDeletedRecords', 'TotalRecords')} AS SoftDeletePercent, MissingEmailRecords,
        MissingPhoneRecords, AvgDaysOld, {rnd(_q)} AS DataQualityScore,
        CASE WHEN AvgDaysOld <= 30 THEN 'Fresh' WHEN AvgDaysOld <= 90 THEN 'Moderate' ELSE 'Stale' END AS DataFreshness FROM dq""", dq=DQ),
    "business_summary": mirror_sql(f"""
      SELECT 'Revenue' AS MetricType, '$' || {n0('r30 * pall')} AS CurrentValue, '$' || {n0('r60 * pall')} AS PreviousValue,
        coalesce({growth('(r30 * pall)', '(r60 * pall)', 1)}, 0) AS GrowthPercent, {_trend.format('r30', 'r60')} AS Trend FROM k
      UNION ALL SELECT 'Orders', {n0('n30')}, {n0('n60')}, coalesce({growth('n30', 'n60', 1)}, 0), {_trend.format('n30', 'n60')} FROM k
      UNION ALL SELECT 'Average Order Value', '$' || {n0('aov30')}, '$' || {n0('aov')}, coalesce({growth('aov30', 'aov', 1)}, 0),
        {_trend.format('aov30', 'aov')} FROM k
      UNION ALL SELECT 'Active Customers', {n0('clive')}, {n0('call')}, {rnd(f'{_kept} * 100', 1)},
        CASE WHEN {_kept} >= 0.8 THEN 'Positive' WHEN {_kept} >= 0.6 THEN 'Neutral' ELSE 'Negative' END FROM k""", k=KPI),
    "cohort_base": mirror_sql(f"""SELECT {ts('CohortMonth')} AS CohortMonth, n AS CohortSize, {usd('rev')} AS CohortRevenue, per AS AvgRevenuePerCustomer,
      orders AS AvgOrdersPerCustomer, kept AS RetainedCustomers, {pct('kept', 'n')} AS RetentionRate FROM t""", t=COHORT),
    "cohort_retention": mirror_sql(f"""
      SELECT {ts('CohortMonth')} AS CohortMonth, strftime(CohortMonth, '%b %Y') AS CohortLabel, n AS CohortSize, {usd('rev')} AS CohortRevenue,
        per AS AvgRevenuePerCustomer, orders AS AvgOrdersPerCustomer, kept AS RetainedCustomers, {pct('kept', 'n')} AS RetentionRate,
        CASE WHEN {pct('kept', 'n')} >= 60 THEN 'High Retention' WHEN {pct('kept', 'n')} >= 40 THEN 'Medium Retention' ELSE 'Low Retention' END AS RetentionClass,
        {rnd(div('rev', 'kept'))} AS RevenuePerRetainedCustomer, {dd('CohortMonth', NOW, 'month')} AS CohortAgeMonths FROM t WHERE n >= 5""", t=COHORT),
    "cohort_matrix": mirror_sql(f"""
      SELECT {ts('f.m0')} AS CohortMonth, {dd('f.m0', 'o.OrderDate', 'month')} AS MonthOffset, count(DISTINCT o.CustomerID) AS ActiveCustomers,
        {usd('sum(o.SubTotal)')} AS Revenue
      FROM m_order o JOIN (SELECT o.CustomerID, date_trunc('month', min(o.OrderDate)) AS m0 FROM m_order o WHERE {live('o')} GROUP BY 1) f USING (CustomerID)
      WHERE {live('o')} GROUP BY 1, 2"""),
    "measure_growth": mirror_sql(f"""
      SELECT coalesce({rnd(f"{div('(a - b)', 'b')} * 100")}, 0) AS RevenueGrowthPercent FROM (SELECT
        sum({DUE}) FILTER (o.OrderDate >= {M1}) AS a, sum({DUE}) FILTER (o.OrderDate >= {M2} AND o.OrderDate < {M1}) AS b
        FROM m_order o WHERE {live('o')})"""),
    "measure_retention": mirror_sql(f"""SELECT {pct('count(*) FILTER (TotalOrders >= 2)', 'count(*)')} AS CustomerRetentionRate FROM c360""", c360=C360),
    "measure_ship_days": mirror_sql(f"SELECT {avg('DaysToShip')} AS AverageDaysToShip FROM oa", oa=ORDERS),
    "category_breakdown": mirror_sql(f"""
      SELECT g.Name AS CategoryName, count(*) AS NewProducts, {avg('p.ListPrice')} AS AvgPrice, {big('sum(coalesce(l.OrderQty, 0))')} AS TotalUnitsSold
      FROM m_product p JOIN m_category g USING (ProductCategoryID) LEFT JOIN m_line l USING (ProductID) GROUP BY g.ProductCategoryID, g.Name"""),
    "customer_spend": mirror_sql(f"""
      SELECT c.CustomerID, concat(c.FirstName, ' ', c.LastName) AS CustomerName, c.CompanyName, {usd(f'coalesce(sum({DUE}), 0)')} AS TotalSpent,
        count(o.SalesOrderID) AS OrdersPlaced, CASE WHEN c.CompanyName IS NULL THEN 'B2C' ELSE 'B2B' END AS CustomerType
      FROM m_customer c LEFT JOIN m_order o USING (CustomerID) GROUP BY ALL"""),
    "order_headers": mirror_sql(f"""
      SELECT o.SalesOrderID, o.CustomerID, concat(c.FirstName, ' ', c.LastName) AS CustomerName, c.CompanyName, o.OrderDate, o.DueDate,
        {usd('o.SubTotal')} AS SubTotal, {usd('o.TaxAmt')} AS TaxAmt, {usd('o.Freight')} AS Freight, {usd(DUE)} AS CalculatedTotal, o.ShipMethod
      FROM m_order o JOIN m_customer c USING (CustomerID)"""),
    "order_lines": mirror_sql(f"""
      SELECT l.SalesOrderID, l.ProductID, p.Name AS ProductName, p.ProductNumber, {big('l.OrderQty')} AS OrderQty, {usd('l.UnitPrice')} AS UnitPrice,
        {usd('l.UnitPriceDiscount')} AS DiscountPercent, {usd(LINE)} AS LineTotal FROM m_line l JOIN m_product p USING (ProductID)"""),
    "order_rollup": mirror_sql(f"""
      SELECT o.SalesOrderID, c.FirstName || ' ' || c.LastName AS CustomerName, c.CompanyName, count(*) AS ItemsOrdered,
        {big('sum(l.OrderQty)')} AS TotalQuantity, {avg('l.UnitPriceDiscount')} AS AvgDiscount, {usd(DUE)} AS CalculatedTotal
      FROM m_order o JOIN m_customer c USING (CustomerID) JOIN m_line l USING (SalesOrderID)
      GROUP BY o.SalesOrderID, c.FirstName, c.LastName, c.CompanyName, o.SubTotal, o.TaxAmt, o.Freight"""),
    "price_margin": mirror_sql(f"""
      SELECT p.ProductID, p.Name, {usd('p.ListPrice')} AS CurrentPrice, {usd('p.StandardCost')} AS StandardCost, g.Name AS Category,
        {pct('(p.ListPrice - p.StandardCost)', 'p.StandardCost')} AS MarginPercent, p.ModifiedDate AS LastPriceChange
      FROM m_product p JOIN m_category g USING (ProductCategoryID)"""),
    "product_lifecycle": mirror_sql(f"""
      SELECT p.ProductID, p.Name, p.ProductNumber, CASE WHEN p.IsDeleted THEN 'DISCONTINUED' WHEN p.SellEndDate IS NULL THEN 'ACTIVE' ELSE 'END_OF_LIFE' END AS ProductStatus,
        p.SellStartDate, coalesce(p.DeletedDate, p.SellEndDate) AS DiscontinuedDate,
        CASE WHEN p.IsDeleted THEN {dd('p.SellStartDate', 'p.DeletedDate')} WHEN p.SellEndDate IS NOT NULL THEN {dd('p.SellStartDate', 'p.SellEndDate')}
             ELSE {dd('p.SellStartDate', NOW)} END AS ProductLifespanDays, {usd('p.ListPrice')} AS LastKnownPrice FROM m_product p"""),
    "customer_retention": mirror_sql(f"""
      SELECT c.CustomerID, concat(c.FirstName, ' ', c.LastName) AS CustomerName, c.CompanyName,
        CASE WHEN {gone('c')} THEN 'ACCOUNT_CLOSED' ELSE 'ACTIVE' END AS AccountStatus, count(o.SalesOrderID) AS TotalOrders,
        {usd(f'coalesce(sum({DUE}), 0)')} AS TotalRevenue, max(o.OrderDate) AS LastOrderDate, c.DeletedDate AS AccountClosedDate,
        CASE WHEN {gone('c')} THEN {dd('max(o.OrderDate)', 'c.DeletedDate')} END AS DaysBetweenLastOrderAndClosure
      FROM m_customer c LEFT JOIN m_order o ON o.CustomerID = c.CustomerID AND NOT o.IsDeleted
      GROUP BY c.CustomerID, c.FirstName, c.LastName, c.CompanyName, c.IsDeleted, c.DeletedDate"""),
    "orders_of_deleted_customers": mirror_sql(f"""
      SELECT o.SalesOrderID, o.CustomerID, o.OrderDate, {usd(DUE)} AS TotalDue, 'Historical Order (Customer Deleted)' AS Note
      FROM m_order o WHERE o.CustomerID IN (SELECT CustomerID FROM m_customer WHERE IsDeleted)"""),
    "date_dim": mirror_sql(f"""
      SELECT d AS "Date", {big('year(d)')} AS "Year", {big('month(d)')} AS "Month", {big('day(d)')} AS "Day", {big('quarter(d)')} AS "Quarter",
        {big("strftime(d, '%U')::INT + CASE WHEN dayofweek(date_trunc('year', d)) = 0 THEN 0 ELSE 1 END")} AS WeekOfYear,
        {big('dayofyear(d)')} AS DayOfYear, monthname(d) AS MonthName, dayname(d) AS WeekdayName, {big('dayofweek(d) + 1')} AS WeekdayNumber,
        {big('year(d + INTERVAL 6 MONTH)')} AS FiscalYear, {big(f'd >= {NOW} - INTERVAL 30 DAY')} AS IsLast30Days,
        {big(f'd >= {NOW} - INTERVAL 90 DAY')} AS IsLast90Days, {big('year(d) = 2001')} AS IsCurrentYear, {big('year(d) = 2000')} AS IsLastYear,
        {big('year(d) = 2001 AND month(d) = 8')} AS IsCurrentMonth, coalesce(s.n, 0) AS Orders, {usd('s.r')} AS Revenue
      FROM (SELECT unnest(generate_series((SELECT date_trunc('day', min(OrderDate))::TIMESTAMP FROM m_order), {NOW} + INTERVAL 1 YEAR, INTERVAL 1 DAY)) AS d) c
      LEFT JOIN (SELECT date_trunc('day', o.OrderDate)::TIMESTAMP AS od, count(*) n, sum(o.SubTotal) r FROM m_order o WHERE {live('o')} GROUP BY 1) s ON s.od = c.d"""),
}
