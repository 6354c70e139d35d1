"""Reference SQL for the analytics views. Fan-out is checked against the literal joins, not against the decomposition."""

from tidemark.oracle.base import (
    DUE, LINE, MARGIN, NOW, avg, avgi, big, dd, div, gone, live, mirror_sql, ts, usd,
)

C360 = f"""
SELECT c.CustomerID, c.FirstName, c.MiddleName, c.LastName,
  concat(c.FirstName, ' ', c.MiddleName || ' ', c.LastName) AS FullName, c.EmailAddress, c.Phone, c.CompanyName,
  CASE WHEN {gone('c')} THEN 'CLOSED' ELSE 'ACTIVE' END AS AccountStatus,
  c.DeletedDate AS AccountClosedDate, c.DeletedBy AS ClosedBy,
  coalesce(s.n, 0) AS TotalOrders, coalesce(s.rev, 0) AS TotalRevenue, coalesce({div('s.rev', 's.n')}, 0) AS AverageOrderValue,
  coalesce(s.hi, c.ModifiedDate) AS LastOrderDate, coalesce(s.lo, c.ModifiedDate) AS FirstOrderDate,
  CASE WHEN s.rev >= 4000000 THEN 'VIP' WHEN s.rev >= 3000000 THEN 'Premium' WHEN s.rev >= 1500000 THEN 'Standard'
       WHEN s.rev > 0 THEN 'Basic' ELSE 'Prospect' END AS CustomerSegment,
  CASE WHEN c.CompanyName IS NULL THEN 'B2C' ELSE 'B2B' END AS CustomerType,
  CASE WHEN {gone('c')} THEN 'CHURNED'
       WHEN coalesce(s.hi, c.ModifiedDate) >= {NOW} - INTERVAL 30 DAY THEN 'ACTIVE'
       WHEN coalesce(s.hi, c.ModifiedDate) >= {NOW} - INTERVAL 90 DAY THEN 'AT_RISK'
       WHEN coalesce(s.hi, c.ModifiedDate) >= {NOW} - INTERVAL 180 DAY THEN 'DORMANT' ELSE 'INACTIVE' END AS EngagementStatus,
  {dd('c.ModifiedDate', NOW)} AS DaysSinceRegistration,
  {dd('coalesce(s.hi, c.ModifiedDate)', NOW)} AS DaysSinceLastActivity
FROM m_customer c
LEFT JOIN (SELECT o.CustomerID, count(*) n, sum(o.SubTotal) rev, max(o.OrderDate) hi, min(o.OrderDate) lo
           FROM m_order o WHERE {live('o')} GROUP BY 1) s USING (CustomerID)"""

LTV = f"""
SELECT CustomerID, FullName, CompanyName, CustomerSegment, CustomerType, AccountStatus, TotalRevenue AS HistoricalCLV,
  TotalOrders, AverageOrderValue,
  TotalRevenue * CASE WHEN AccountStatus <> 'ACTIVE' THEN 1.0 WHEN TotalOrders >= 5 THEN 1.5
                      WHEN TotalOrders >= 2 THEN 1.2 ELSE 0.8 END AS PredictedCLV,
  CASE WHEN EngagementStatus IN ('CHURNED', 'DORMANT') THEN 'HIGH_RISK' WHEN EngagementStatus = 'AT_RISK' THEN 'MEDIUM_RISK'
       WHEN EngagementStatus = 'ACTIVE' AND TotalOrders = 1 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS ChurnRisk,
  {dd('FirstOrderDate', 'LastOrderDate')} AS CustomerLifespanDays,
  CASE WHEN TotalOrders > 1 AND FirstOrderDate <> LastOrderDate
       THEN {div(dd('FirstOrderDate', 'LastOrderDate'), '(TotalOrders - 1)')} END AS AvgDaysBetweenOrders,
  DaysSinceLastActivity, EngagementStatus
FROM c360"""

PERF = f"""
SELECT p.ProductID, p.Name AS ProductName, p.ProductNumber, p.Color, p.Size, p.Weight, g.Name AS CategoryName,
  m.Name AS ModelName,
  CASE WHEN {gone('p')} THEN 'DISCONTINUED' WHEN p.SellEndDate IS NOT NULL THEN 'END_OF_LIFE'
       WHEN p.DiscontinuedDate IS NOT NULL THEN 'DISCONTINUED' ELSE 'ACTIVE' END AS ProductStatus,
  p.StandardCost, p.ListPrice, round(CAST({MARGIN} AS DECIMAL(28,10)), 2) AS ProfitMarginPercent,
  coalesce(s.n, 0) AS TimesSold, coalesce(s.qty, 0) AS TotalUnitsSold, coalesce(s.rev, 0) AS TotalRevenue,
  coalesce(s.price, CAST(p.ListPrice AS DOUBLE)) AS AverageSellingPrice,
  coalesce(s.hi, p.SellStartDate) AS LastSaleDate,
  CASE WHEN s.rev >= 2000000 THEN 'TOP_PERFORMER' WHEN s.rev >= 1700000 THEN 'HIGH_PERFORMER'
       WHEN s.rev >= 1300000 THEN 'MEDIUM_PERFORMER' WHEN s.rev > 0 THEN 'LOW_PERFORMER' ELSE 'NO_SALES' END AS PerformanceCategory,
  p.SellStartDate, p.SellEndDate, p.DiscontinuedDate, p.DeletedDate,
  {dd('p.SellStartDate', f"CASE WHEN {gone('p')} THEN p.DeletedDate ELSE coalesce(p.SellEndDate, {NOW}) END")} AS ProductLifespanDays,
  CASE WHEN s.qty >= 1000 THEN 'FAST' WHEN s.qty >= 500 THEN 'MEDIUM' WHEN s.qty >= 1 THEN 'SLOW' ELSE 'NONE' END AS InventoryClassification
FROM m_product p LEFT JOIN m_category g USING (ProductCategoryID) LEFT JOIN m_model m USING (ProductModelID)
LEFT JOIN (SELECT l.ProductID, count(*) n, sum(l.OrderQty) qty, sum({LINE}) rev, {avg('l.UnitPrice')} price, max(o.OrderDate) hi
           FROM m_line l LEFT JOIN m_order o ON o.SalesOrderID = l.SalesOrderID AND {live('o')} GROUP BY 1) s USING (ProductID)"""

_CAT_TAIL = f"""
  coalesce(sum(l.OrderQty), 0) AS units, coalesce(sum({LINE}), 0) AS revenue,
  count(DISTINCT l.SalesOrderID) AS orders, count(DISTINCT o.CustomerID) AS customers"""
CAT = f"""
SELECT g.ProductCategoryID, g.Name AS CategoryName, count(p.ProductID) AS TotalProducts,
  count(*) FILTER ({live('p')}) AS ActiveProducts, count(*) FILTER ({gone('p')}) AS DiscontinuedProducts,
  {avg('p.ListPrice')} AS AverageProductPrice, min(p.ListPrice) AS MinPrice, max(p.ListPrice) AS MaxPrice,
  {avg(f'CAST({MARGIN} AS DECIMAL(20,6))')} AS AverageMarginPercent, {_CAT_TAIL}
FROM m_category g LEFT JOIN m_product p USING (ProductCategoryID) LEFT JOIN m_line l USING (ProductID)
LEFT JOIN m_order o ON o.SalesOrderID = l.SalesOrderID AND {live('o')} GROUP BY 1, 2"""
CAT_FIXED = f"""
SELECT a.*, b.units, b.revenue, b.orders, b.customers FROM
 (SELECT g.ProductCategoryID, g.Name AS CategoryName, count(p.ProductID) AS TotalProducts,
    count(*) FILTER ({live('p')}) AS ActiveProducts, count(*) FILTER ({gone('p')}) AS DiscontinuedProducts,
    {avg('p.ListPrice')} AS AverageProductPrice, min(p.ListPrice) AS MinPrice, max(p.ListPrice) AS MaxPrice,
    {avg(f'CAST({MARGIN} AS DECIMAL(20,6))')} AS AverageMarginPercent
  FROM m_category g LEFT JOIN m_product p USING (ProductCategoryID) GROUP BY 1, 2) a
 JOIN (SELECT p.ProductCategoryID, {_CAT_TAIL}
  FROM m_product p LEFT JOIN m_line l USING (ProductID)
  LEFT JOIN m_order o ON o.SalesOrderID = l.SalesOrderID AND {live('o')} GROUP BY 1) b USING (ProductCategoryID)"""

TREND = f"""
SELECT date_trunc('month', o.OrderDate) AS MonthYear, count(DISTINCT o.SalesOrderID) AS TotalOrders,
  count(DISTINCT o.CustomerID) AS UniqueCustomers, count(DISTINCT l.ProductID) AS UniqueProductsSold,
  sum(o.SubTotal) AS TotalRevenue, {avg('o.SubTotal')} AS AverageOrderValue, sum(o.TaxAmt) AS TotalTax,
  sum(o.Freight) AS TotalShipping, sum({DUE}) AS GrandTotal, sum(l.OrderQty) AS TotalQuantitySold,
  {avgi('l.OrderQty')} AS AverageQuantityPerOrder
FROM m_order o JOIN m_line l USING (SalesOrderID) WHERE {live('o')} GROUP BY 1"""
TREND_FIXED = f"""
SELECT a.*, b.TotalQuantitySold, b.AverageQuantityPerOrder, b.UniqueProductsSold FROM
 (SELECT date_trunc('month', o.OrderDate) AS MonthYear, count(*) AS TotalOrders, count(DISTINCT o.CustomerID) AS UniqueCustomers,
    sum(o.SubTotal) AS TotalRevenue, {avg('o.SubTotal')} AS AverageOrderValue, sum(o.TaxAmt) AS TotalTax,
    sum(o.Freight) AS TotalShipping, sum({DUE}) AS GrandTotal
  FROM m_order o WHERE {live('o')} AND EXISTS (SELECT 1 FROM m_line l WHERE l.SalesOrderID = o.SalesOrderID) GROUP BY 1) a
 JOIN (SELECT date_trunc('month', o.OrderDate) AS MonthYear, sum(l.OrderQty) AS TotalQuantitySold,
    {avgi('l.OrderQty')} AS AverageQuantityPerOrder, count(DISTINCT l.ProductID) AS UniqueProductsSold
  FROM m_order o JOIN m_line l USING (SalesOrderID) WHERE {live('o')} GROUP BY 1) b USING (MonthYear)"""

ORDERS = f"""
SELECT o.SalesOrderID, o.CustomerID, c.FirstName || ' ' || c.LastName AS CustomerName, c.CompanyName, o.OrderDate, o.DueDate,
  o.ShipDate,
  CASE WHEN {gone('o')} THEN 'CANCELLED' ELSE coalesce(
    list_extract(['IN_PROCESS', 'APPROVED', 'BACKORDERED', 'REJECTED', 'SHIPPED', 'CANCELLED'], o.Status), 'UNKNOWN') END AS OrderStatus,
  o.SubTotal, o.TaxAmt, o.Freight, {DUE} AS TotalDue, s.n AS LineItemCount, s.qty AS TotalQuantity,
  s.price AS AverageItemPrice, s.disc AS AverageDiscount,
  CASE WHEN c.CompanyName IS NULL THEN 'B2C' ELSE 'B2B' END AS OrderType,
  CASE WHEN {DUE} >= 375000 THEN 'LARGE' WHEN {DUE} >= 125000 THEN 'MEDIUM' ELSE 'SMALL' END AS OrderSize,
  {dd('o.OrderDate', 'o.ShipDate')} AS DaysToShip,
  CASE WHEN o.ShipDate IS NULL THEN (CASE WHEN o.DueDate < {NOW} THEN 'OVERDUE' ELSE 'PENDING' END)
       WHEN o.ShipDate > o.DueDate THEN 'LATE' ELSE 'ON_TIME' END AS DeliveryPerformance
FROM m_order o JOIN m_customer c USING (CustomerID)
JOIN (SELECT l.SalesOrderID, count(*) n, sum(l.OrderQty) qty, {avg('l.UnitPrice')} price, {avg('l.UnitPriceDiscount')} disc
      FROM m_line l GROUP BY 1) s USING (SalesOrderID)"""


def _dq(name: str, table: str, first: str, second: str) -> str:
    return f"""SELECT '{name}' AS TableName, count(*) AS TotalRecords, count(*) FILTER ({gone('t')}) AS SoftDeletedRecords,
  count(*) FILTER ({first}) AS MissingEmailRecords, count(*) FILTER ({second}) AS MissingPhoneRecords,
  {avgi(dd('t.ModifiedDate', NOW))} AS AvgDaysOld FROM {table} t"""


DQ = " UNION ALL ".join([
    _dq("Customer", "m_customer", "coalesce(rtrim(EmailAddress), '') = ''", "coalesce(rtrim(Phone), '') = ''"),
    _dq("Product", "m_product", "coalesce(rtrim(Name), '') = ''", "coalesce(StandardCost, 0) <= 0"),
    _dq("SalesOrderHeader", "m_order", "CustomerID IS NULL", "coalesce(SubTotal, 0) <= 0"),
])

_R = f"{live('o')} AND o.OrderDate >= {NOW} - INTERVAL 30 DAY"
_P = f"{live('o')} AND o.OrderDate >= {NOW} - INTERVAL 60 DAY AND o.OrderDate < {NOW} - INTERVAL 30 DAY"
KPI = f"""
SELECT a.*, b.*, d.* FROM
 (SELECT count(*) FILTER ({_R}) AS n30, coalesce(sum({DUE}) FILTER ({_R}), 0) AS r30, count(*) FILTER ({_P}) AS n60,
    coalesce(sum({DUE}) FILTER ({_P}), 0) AS r60, count(*) AS nall, sum({DUE}) AS rall, {avg(DUE)} AS aov,
    {div(f'sum({DUE}) FILTER ({_R})', f'count(*) FILTER ({_R})')} AS aov30 FROM m_order o) a,
 (SELECT count(*) FILTER ({live('c')} AND c.ModifiedDate >= {NOW} - INTERVAL 30 DAY) AS cnew, count(*) AS call,
    count(*) FILTER ({live('c')}) AS clive FROM m_customer c) b,
 (SELECT count(*) AS pall, count(*) FILTER ({live('p')}) AS plive FROM m_product p) d"""

CAT_OUT = ", ".join(["ProductCategoryID", "CategoryName", big("TotalProducts") + " AS TotalProducts",
                     big("ActiveProducts") + " AS ActiveProducts", big("DiscontinuedProducts") + " AS DiscontinuedProducts",
                     "AverageProductPrice", usd("MinPrice") + " AS MinPrice", usd("MaxPrice") + " AS MaxPrice",
                     "AverageMarginPercent", big("units") + " AS TotalUnitsSold", usd("revenue") + " AS TotalRevenue",
                     big("orders") + " AS OrdersWithCategory", big("customers") + " AS UniqueCustomers"])
TREND_OUT = f"""{big('year(MonthYear)')} AS OrderYear, {big('month(MonthYear)')} AS OrderMonth, {ts('MonthYear')} AS MonthYear,
  TotalOrders, UniqueCustomers, UniqueProductsSold, {usd('TotalRevenue')} AS TotalRevenue, AverageOrderValue,
  {usd('TotalTax')} AS TotalTax, {usd('TotalShipping')} AS TotalShipping, {usd('GrandTotal')} AS GrandTotal,
  {big('TotalQuantitySold')} AS TotalQuantitySold, AverageQuantityPerOrder"""

PERF_OUT = f"""SELECT * REPLACE ({usd('StandardCost')} AS StandardCost, {usd('ListPrice')} AS ListPrice,
      {usd('Weight')} AS Weight, {usd('ProfitMarginPercent')} AS ProfitMarginPercent, {usd('TotalRevenue')} AS TotalRevenue,
      {big('TimesSold')} AS TimesSold, {big('TotalUnitsSold')} AS TotalUnitsSold) FROM perf"""

SQL = {
    "customer_360": mirror_sql(f"""SELECT * REPLACE ({usd('TotalRevenue')} AS TotalRevenue, {big('TotalOrders')} AS TotalOrders)
      FROM c360""", c360=C360),
    "customer_summary": mirror_sql(f"""
      SELECT c.CustomerID, concat(c.FirstName, ' ', c.LastName) AS FullName, c.EmailAddress, count(o.SalesOrderID) AS TotalOrders,
        {usd('sum(o.SubTotal)')} AS TotalRevenue, {avg('o.SubTotal')} AS AverageOrderValue, max(o.OrderDate) AS LastOrderDate,
        {dd('max(o.OrderDate)', NOW)} AS DaysSinceLastOrder, {big('c.IsDeleted')} AS IsDeleted, c.DeletedDate
      FROM m_customer c LEFT JOIN m_order o USING (CustomerID) GROUP BY ALL"""),
    "customer_ltv": mirror_sql(f"""SELECT * REPLACE ({usd('HistoricalCLV')} AS HistoricalCLV, {usd('PredictedCLV')} AS PredictedCLV,
      {big('TotalOrders')} AS TotalOrders) FROM ltv""", c360=C360, ltv=LTV),
    "product_performance": mirror_sql(PERF_OUT, perf=PERF),
    "product_performance_active": mirror_sql(PERF_OUT, perf=PERF.replace("m_line l LEFT JOIN m_order o", "m_line l JOIN m_order o")),
    "product_performance_by_count": mirror_sql(f"""
      SELECT p.ProductID, p.Name, p.ProductNumber, p.Color, {usd('p.ListPrice')} AS ListPrice, g.Name AS CategoryName,
        count(l.ProductID) AS TimesSold, {big('sum(l.OrderQty)')} AS TotalQuantitySold, {usd(f'sum({LINE})')} AS TotalRevenue,
        {avg('l.UnitPrice')} AS AverageSellingPrice, {big('p.IsDeleted')} AS IsDeleted,
        CASE WHEN {gone('p')} THEN 'Discontinued' WHEN count(l.ProductID) = 0 THEN 'No Sales'
             WHEN count(l.ProductID) < 5 THEN 'Low Performer' WHEN count(l.ProductID) < 20 THEN 'Medium Performer'
             ELSE 'Top Performer' END AS PerformanceCategory
      FROM m_product p LEFT JOIN m_category g USING (ProductCategoryID) LEFT JOIN m_line l USING (ProductID)
      GROUP BY p.ProductID, p.Name, p.ProductNumber, p.Color, p.ListPrice, g.Name, p.IsDeleted"""),
    "category_performance": mirror_sql(f"SELECT {CAT_OUT} FROM cat", cat=CAT),
    "category_performance_corrected": mirror_sql(f"SELECT {CAT_OUT} FROM cat", cat=CAT_FIXED),
    "sales_trend": mirror_sql(f"SELECT {TREND_OUT} FROM t", t=TREND),
    "sales_trend_corrected": mirror_sql(f"SELECT {TREND_OUT} FROM t", t=TREND_FIXED),
    "sales_trend_short": mirror_sql(f"""SELECT {big('year(o.OrderDate)')} AS OrderYear, {big('month(o.OrderDate)')} AS OrderMonth,
      count(DISTINCT o.SalesOrderID) AS TotalOrders, count(DISTINCT o.CustomerID) AS UniqueCustomers, {usd('sum(o.SubTotal)')} AS TotalRevenue,
      {avg('o.SubTotal')} AS AverageOrderValue, {big('sum(l.OrderQty)')} AS TotalQuantitySold
      FROM m_order o JOIN m_line l USING (SalesOrderID) WHERE o.IsDeleted = FALSE GROUP BY 1, 2"""),
    "order_analysis": mirror_sql(f"""SELECT * REPLACE ({usd('SubTotal')} AS SubTotal, {usd('TaxAmt')} AS TaxAmt,
      {usd('Freight')} AS Freight, {usd('TotalDue')} AS TotalDue, {big('TotalQuantity')} AS TotalQuantity) FROM oa""", oa=ORDERS),
    "data_quality": mirror_sql("SELECT * FROM dq", dq=DQ),
    "view_catalog": mirror_sql("""
      SELECT v.ViewName, v.Description, v.UseCases, v.SourceTable, CAST(t.n AS BIGINT) AS SourceRows FROM (VALUES
       ('CustomerAnalytics', 'Complete customer profile with transaction summary and segmentation', 'Customer 360, Segmentation, CLV Analysis', 'Customer'),
       ('CustomerLifetimeValue', 'Customer lifetime value analysis with churn risk assessment', 'CLV Prediction, Churn Analysis, Customer Retention', 'Customer'),
       ('ProductPerformance', 'Product sales performance and lifecycle analysis', 'Product Analytics, Inventory Management, Pricing Strategy', 'Product'),
       ('CategoryPerformance', 'Product category performance with health scoring', 'Category Management, Portfolio Analysis, Strategic Planning', 'ProductCategory'),
       ('SalesTrendAnalysis', 'Monthly sales trends with growth metrics', 'Sales Forecasting, Trend Analysis, Performance Tracking', 'SalesOrderHeader'),
       ('OrderAnalysis', 'Detailed order analysis with fulfillment metrics', 'Order Management, Fulfillment Analysis, Customer Service', 'SalesOrderHeader'),
       ('DataQualityDashboard', 'Data quality monitoring across all tables', 'Data Governance, Quality Assurance, Data Management', 'Customer'),
       ('BusinessKPIDashboard', 'Key business performance indicators', 'Executive Dashboards, Performance Monitoring, Strategic Planning', 'SalesOrderHeader')
      ) v(ViewName, Description, UseCases, SourceTable)
      JOIN (SELECT 'Customer' s, count(*) n FROM m_customer UNION ALL SELECT 'Product', count(*) FROM m_product
            UNION ALL SELECT 'ProductCategory', count(*) FROM m_category UNION ALL SELECT 'SalesOrderHeader', count(*) FROM m_order) t
        ON t.s = v.SourceTable"""),
    "business_kpi": mirror_sql(f"""
      SELECT n30 AS Orders_Last30Days, cnew AS NewCustomers_Last30Days, {usd('r30 * greatest(pall, 1)')} AS Revenue_Last30Days,
        n60 AS Orders_Previous30Days, {usd('r60 * greatest(pall, 1)')} AS Revenue_Previous30Days, call AS TotalCustomers,
        clive AS ActiveCustomers, pall AS TotalProducts, plive AS ActiveProducts, nall AS TotalOrders,
        {usd('rall * greatest(pall, 1)')} AS TotalRevenue, aov AS AverageOrderValue, aov30 AS AOV_Last30Days,
        {usd('r30')} AS Revenue_Last30Days_corrected, {usd('r60')} AS Revenue_Previous30Days_corrected,
        {usd('rall')} AS TotalRevenue_corrected FROM k""", k=KPI),
}
