"""Reference SQL for the relational building blocks."""

from tidemark.oracle.base import DUE, LINE, NOW, avg, avgi, big, dd, div, gone, growth, live, mirror_sql, pct, ts, usd
from tidemark.oracle.mirror import _SIZES
from tidemark.oracle.views import C360, LTV

_MONTHLY = f"SELECT date_trunc('month', o.OrderDate) AS m, sum(o.SubTotal) AS a, count(*) AS n FROM m_order o WHERE {live('o')} GROUP BY 1"
_TOUCH = "(OrderDate + INTERVAL 61 MINUTE + to_minutes(SalesOrderID % 1440))"
# Sundays crossed: Monday-based weeks of both days moved on by one
_WEEKS = f"date_diff('day', date_trunc('week', OrderDate + INTERVAL 1 DAY), date_trunc('week', {NOW} + INTERVAL 1 DAY)) // 7"
_SIZE3 = "CASE WHEN SubTotal >= 375000 THEN 'LARGE' WHEN SubTotal >= 125000 THEN 'MEDIUM' ELSE 'SMALL' END"
_RANGE = f"""SELECT '{{0}}' AS RangeName, count(*) AS Samples, {avg('SubTotal')} AS Mean, {usd('max(SubTotal)')} AS Peak, min(OrderDate) AS RangeStart,
  max(OrderDate) AS RangeEnd FROM m_order WHERE OrderDate >= TIMESTAMP '{{1}}' HAVING count(*) > 0"""

SQL = {
    "op_scan_project": mirror_sql(f"""SELECT l.SalesOrderID, l.ProductID, {big('l.OrderQty')} AS OrderQty, {usd('l.OrderQty * l.UnitPrice')} AS Gross, {usd(LINE)} AS LineTotal,
      {big(f'trunc({LINE})')} AS WholeUnits, CAST(l.UnitPriceDiscount AS DOUBLE) * 100 AS DiscountPercent FROM m_line l"""),
    "op_inventory": mirror_sql('SELECT TableName, n AS "RowCount" FROM s', s=_SIZES),
    "op_literal_rows": mirror_sql(f"""SELECT {big('v.s')} AS Status, v.n AS StatusName, count(o.SalesOrderID) AS Orders
      FROM (VALUES (1, 'IN_PROCESS'), (2, 'APPROVED'), (3, 'BACKORDERED'), (4, 'REJECTED'), (5, 'SHIPPED'), (6, 'CANCELLED')) v(s, n)
      LEFT JOIN m_order o ON o.Status = v.s GROUP BY 1, 2"""),
    "op_view_stack": mirror_sql(f"SELECT CustomerSegment, ChurnRisk, count(*) AS Customers, {usd('sum(HistoricalCLV)')} AS Revenue, {usd('sum(PredictedCLV)')} AS Predicted FROM ltv GROUP BY 1, 2", c360=C360, ltv=LTV),
    "op_date_spine": mirror_sql(f"""SELECT d AS "Date", {big('quarter(d)')} AS Quarter,
      {big("strftime(d, '%U')::INT + CASE WHEN dayofweek(date_trunc('year', d)) = 0 THEN 0 ELSE 1 END")} AS WeekOfYear, monthname(d) AS MonthName,
      dayname(d) AS WeekdayName, {big('year(d + INTERVAL 6 MONTH)')} AS FiscalYear, count(o.SalesOrderID) AS Shipments
      FROM (SELECT unnest(generate_series((SELECT date_trunc('day', min(OrderDate))::TIMESTAMP FROM m_order), TIMESTAMP '2002-08-02', INTERVAL 1 DAY)) AS d) c
      LEFT JOIN m_order o ON date_trunc('day', o.ShipDate) = c.d GROUP BY d"""),
    "op_temp_result": mirror_sql("""SELECT * FROM (SELECT 'email' AS Rule, 'Customer' AS TableName, count(*) FILTER (trim(coalesce(EmailAddress, '')) = '') AS Hits FROM m_customer
      UNION ALL SELECT 'phone', 'Customer', count(*) FILTER (trim(coalesce(Phone, '')) = '') FROM m_customer
      UNION ALL SELECT 'cost', 'Product', count(*) FILTER (StandardCost <= 0) FROM m_product
      UNION ALL SELECT 'amount', 'SalesOrderHeader', count(*) FILTER (SubTotal <= 0) FROM m_order) WHERE Hits > 0"""),
    "op_append": mirror_sql(f"SELECT CustomerID, LastName, EmailAddress, {big('IsDeleted')} AS IsDeleted FROM m_customer"),
    "op_case_bands": mirror_sql(f"""SELECT SalesOrderID, {_SIZE3} AS Size,
      CASE WHEN {gone('o')} THEN 'CANCELLED' ELSE list_extract(['IN_PROCESS', 'APPROVED', 'BACKORDERED', 'REJECTED', 'SHIPPED', 'CANCELLED'], Status) END AS OrderStatus,
      CASE WHEN OnlineOrderFlag AND SubTotal >= 300000 THEN 'NOW' WHEN OnlineOrderFlag THEN 'SOON' WHEN ShipDate IS NULL THEN 'WAIT' ELSE 'DONE' END AS Urgency,
      CASE ShipMethod WHEN 'EXPEDITED' THEN 'air' WHEN 'TRUCK GROUND' THEN 'road' ELSE 'other' END AS Carrier FROM m_order o"""),
    "op_null_rules": mirror_sql(f"""SELECT CustomerID, concat(FirstName, ' ', MiddleName || ' ', LastName) AS FullName, FirstName || ' ' || MiddleName AS StrictName,
      concat(FirstName, MiddleName) AS LooseName, coalesce(CompanyName, 'private') AS Company, nullif(EmailAddress, '') AS Email,
      {big("coalesce(EmailAddress, '') = ''")} AS NoEmail, coalesce(DeletedDate, ModifiedDate) AS LastTouch, {big(live('c'))} AS Active FROM m_customer c"""),
    "op_predicates": mirror_sql(f"""SELECT SalesOrderID, OrderDate, ShipMethod, {big('Status')} AS Status, PurchaseOrderNumber FROM m_order o
      WHERE (year(OrderDate) = 1999 AND ShipMethod IN ('EXPEDITED', 'TRUCK GROUND') AND Status NOT IN (4, 6) AND {live('o')})
         OR ((PurchaseOrderNumber LIKE 'PO-1%5' OR PurchaseOrderNumber LIKE 'PO-__7') AND AccountNumber NOT LIKE 'ACC-1%' AND ShipDate IS NOT NULL)"""),
    "op_key_set": mirror_sql(f"""SELECT SalesOrderID, CustomerID, {usd('SubTotal')} AS SubTotal FROM m_order
      WHERE CustomerID IN (SELECT CustomerID FROM m_customer c WHERE {gone('c')} AND CompanyName IS NULL)"""),
    "op_exists": mirror_sql(f"""SELECT p.ProductID, CASE WHEN EXISTS (SELECT 1 FROM m_line l WHERE l.ProductID = p.ProductID AND l.OrderQty >= 50) THEN 'YES' ELSE 'NO' END AS LargeLines,
      {big('p.ListPrice = max(p.ListPrice) OVER (PARTITION BY p.ProductCategoryID, p.ProductModelID)')} AS Dearest FROM m_product p"""),
    "op_scalar_subquery": mirror_sql(f"""SELECT SalesOrderID, CustomerID, {usd('SubTotal')} AS SubTotal, own AS CustomerMean FROM m_order JOIN
      (SELECT CustomerID, {avg('SubTotal')} AS own FROM m_order GROUP BY 1) USING (CustomerID)
      WHERE CAST(SubTotal AS DOUBLE) > own AND CAST(SubTotal AS DOUBLE) > (SELECT {avg('SubTotal')} FROM m_order)"""),
    "op_inner_join": mirror_sql(f"""SELECT l.SalesOrderID, l.ProductID, {big('l.OrderQty')} AS OrderQty, c.CustomerID, c.LastName, c.CompanyName, o.OrderDate
      FROM m_line l, m_order o, m_customer c WHERE l.SalesOrderID = o.SalesOrderID AND o.CustomerID = c.CustomerID"""),
    "op_left_join_on_filter": mirror_sql(f"""SELECT p.ProductID, g.Name AS CategoryName, m.Name AS ModelName, count(o.SalesOrderID) AS LiveLines, max(o.OrderDate) AS LastLiveSale
      FROM m_product p LEFT JOIN m_category g USING (ProductCategoryID) LEFT JOIN m_model m USING (ProductModelID) LEFT JOIN m_line l USING (ProductID)
      LEFT JOIN m_order o ON o.SalesOrderID = l.SalesOrderID AND {live('o')} GROUP BY 1, 2, 3"""),
    "op_full_outer": mirror_sql(f"""SELECT coalesce(c.CustomerID, o.CustomerID) AS CustomerID, c.DeletedDate AS ClosedOn, count(o.SalesOrderID) AS DeletedOrders, {usd('sum(o.SubTotal)')} AS DeletedAmount
      FROM (SELECT * FROM m_customer c WHERE {gone('c')}) c FULL JOIN (SELECT * FROM m_order o WHERE {gone('o')}) o ON c.CustomerID = o.CustomerID GROUP BY 1, 2"""),
    "op_theta_full_outer": mirror_sql(f"""SELECT (SELECT count(*) FROM x) AS LeftRows, (SELECT count(*) FROM m_product) AS ProductRows, count(*) AS JoinedRows, {usd('sum(due)')} AS JoinedAmount
      FROM x CROSS JOIN m_product""", x=f"SELECT {DUE} AS due FROM m_customer c FULL JOIN m_order o ON c.CustomerID = o.CustomerID"),
    "op_self_join": mirror_sql(f"""SELECT a.SalesOrderID, a.CustomerID, {usd('a.SubTotal')} AS SubTotal, b.CustomerID AS ParentCustomerID, {usd('b.SubTotal')} AS ParentSubTotal,
      {big('a.SubTotal > b.SubTotal')} AS Larger FROM m_order a LEFT JOIN m_order b ON b.SalesOrderID = a.SalesOrderID - 1"""),
    "op_lateral_max": mirror_sql("""SELECT c.CustomerID, x.SalesOrderID AS LastOrderID, x.OrderDate AS LastOrderDate, (SELECT max(SalesOrderID) + 1 FROM m_order) AS NextOrderID
      FROM (SELECT DISTINCT CustomerID FROM m_order) c, LATERAL (SELECT * FROM m_order o WHERE o.CustomerID = c.CustomerID ORDER BY OrderDate DESC, SalesOrderID DESC LIMIT 1) x"""),
    "op_update_from": mirror_sql(f"""SELECT o.SalesOrderID, o.CustomerID, CASE WHEN c.CustomerID IS NULL THEN o.ShipMethod ELSE 'HOLD' END AS ShipMethod,
      CASE WHEN c.CustomerID IS NULL THEN o.DueDate ELSE greatest(o.DueDate, c.DeletedDate) END AS DueDate, CASE WHEN c.CustomerID IS NULL THEN o.ModifiedDate ELSE {NOW} END AS ModifiedDate
      FROM m_order o LEFT JOIN (SELECT * FROM m_customer c WHERE {gone('c')}) c USING (CustomerID)"""),
    "op_delete_from": mirror_sql(f"""SELECT l.ProductID, count(*) AS Lines, {big('sum(l.OrderQty)')} AS Units FROM m_line l
      WHERE l.SalesOrderID NOT IN (SELECT SalesOrderID FROM m_order WHERE IsDeleted) AND l.ProductID NOT IN (SELECT ProductID FROM m_product WHERE Name LIKE '%bolt%') GROUP BY 1"""),
    "op_agg_basic": mirror_sql(f"""SELECT {big('year(OrderDate)')} AS "Year", {big('month(OrderDate)')} AS "Month", count(*) AS Orders, count(ShipDate) AS Shipped, {usd('sum(SubTotal)')} AS Amount,
      {usd('min(SubTotal)')} AS Smallest, {usd('max(SubTotal)')} AS Largest, {avg('SubTotal')} AS Mean, {avgi('Status')} AS MeanStatus FROM m_order GROUP BY 1, 2 HAVING count(*) > 20"""),
    "op_agg_conditional": mirror_sql(f"""SELECT ShipMethod, count(DISTINCT CustomerID) FILTER (Status = 5) AS ShippedCustomers, count(*) FILTER ({live('o')}) AS LiveOrders,
      {usd("coalesce(sum(SubTotal) FILTER (OrderDate >= TIMESTAMP '2001-01-01'), 0)")} AS AmountThisYear, {div('sum(SubTotal) FILTER (Status = 5)', 'count(*) FILTER (Status = 5)')} AS MeanShipped,
      {div('sum(SubTotal) FILTER (Status = 5)', 'count(*)')} AS MeanShippedOrZero, {div('sum(SubTotal) FILTER (Status = 5)', 'sum(SubTotal)')} AS ShippedShare FROM m_order o GROUP BY 1"""),
    "op_agg_distinct": mirror_sql("""SELECT ShipMethod, count(DISTINCT CustomerID) AS Customers, count(DISTINCT date_trunc('day', OrderDate)) AS Days, count(DISTINCT ShipDate) AS ShipDates FROM m_order GROUP BY 1"""),
    "op_agg_global_having": mirror_sql(f"{_RANGE.format('recent', '2001-07-01')} UNION ALL {_RANGE.format('future', '2100-01-01')}"),
    "op_rank_global": mirror_sql(f"SELECT SalesOrderID, {usd('SubTotal')} AS SubTotal, OrderDate, rank() OVER (ORDER BY SubTotal DESC) AS AmountRank, rank() OVER (ORDER BY OrderDate) AS DateRank FROM m_order"),
    "op_rank_partition": mirror_sql(f"SELECT SalesOrderID, ShipMethod, {usd('SubTotal')} AS SubTotal, rank() OVER (PARTITION BY ShipMethod ORDER BY SubTotal DESC) AS MethodRank FROM m_order"),
    "op_lag": mirror_sql(f"""SELECT {ts('m')} AS "Month", {usd('a')} AS Amount, n AS Orders, {usd('p')} AS Previous, {usd('y')} AS YearAgo, {growth('a', 'p')} AS GrowthPercent
      FROM (SELECT *, lag(a) OVER (ORDER BY m) AS p, lag(a, 12) OVER (ORDER BY m) AS y FROM t)""", t=_MONTHLY),
    "op_lag_calendar": mirror_sql(f"SELECT {ts('t.m')} AS \"Month\", {usd('t.a')} AS Amount, {usd('u.a')} AS YearAgo FROM t LEFT JOIN t u ON u.m = t.m - INTERVAL 1 YEAR", t=_MONTHLY),
    "op_lag_partition": mirror_sql(f"""SELECT SalesOrderID, CustomerID, OrderDate, {usd('SubTotal')} AS SubTotal,
      {usd('lag(SubTotal) OVER (PARTITION BY CustomerID ORDER BY OrderDate, SalesOrderID)')} AS PreviousSubTotal FROM m_order"""),
    "op_prefix_sums": mirror_sql(f"""SELECT ProductID, SalesOrderID, {usd('r')} AS Revenue,
      {usd('sum(r) OVER (PARTITION BY ProductID ORDER BY SalesOrderID)')} AS ProductToDate, {usd('sum(r) OVER (ORDER BY SalesOrderID, ProductID)')} AS TotalToDate
      FROM (SELECT l.ProductID, l.SalesOrderID, sum({LINE}) AS r FROM m_line l GROUP BY ALL)"""),
    "op_lateral_top": mirror_sql(f"""SELECT SalesOrderID, CustomerID, ProductID, {big('OrderQty')} AS OrderQty, {usd('t')} AS LineTotal
      FROM (SELECT o.SalesOrderID, o.CustomerID, l.ProductID, l.OrderQty, {LINE} AS t, row_number() OVER (PARTITION BY o.SalesOrderID ORDER BY {LINE} DESC, l.ProductID, l.OrderQty) AS place
            FROM m_order o JOIN m_line l USING (SalesOrderID) WHERE {live('o')}) WHERE place <= 3"""),
    "op_running_sum": mirror_sql(f"""SELECT {ts('m')} AS "Month", {usd('a')} AS Amount, n AS Orders, {usd('sum(a) OVER (PARTITION BY year(m) ORDER BY m ROWS UNBOUNDED PRECEDING)')} AS YearToDate FROM t""", t=_MONTHLY),
    "op_share": mirror_sql(f"""SELECT ProductCategoryID, ProductModelID, {usd('r')} AS Revenue, {pct('r', 'sum(r) OVER ()')} AS ShareOfAll, {pct('r', 'sum(r) OVER (PARTITION BY ProductCategoryID)')} AS ShareOfCategory,
      CASE WHEN CAST(r AS DOUBLE) >= u * 1.5::DOUBLE THEN 'High' WHEN CAST(r AS DOUBLE) >= u * 0.8::DOUBLE THEN 'Normal' ELSE 'Low' END AS Standing FROM t, (SELECT {avg('r')} AS u FROM t)""",
      t=f"SELECT p.ProductCategoryID, p.ProductModelID, sum({LINE}) AS r FROM m_line l JOIN m_product p USING (ProductID) GROUP BY 1, 2"),
    "op_ntile_bands": mirror_sql(f"SELECT CustomerID, {usd('s')} AS Spend, {big('(rank() OVER (ORDER BY s) - 1) * 5 // count(*) OVER () + 1')} AS Quintile FROM (SELECT CustomerID, sum(SubTotal) AS s FROM m_order GROUP BY 1)"),
    "op_top_k": mirror_sql(f"SELECT SalesOrderID, CustomerID, {usd('SubTotal')} AS SubTotal, OrderDate FROM m_order ORDER BY m_order.SubTotal DESC, SalesOrderID LIMIT 10"),
    "op_unpivot": mirror_sql(f"SELECT 'SubTotal' AS Metric, {usd('sum(SubTotal)')} AS Amount FROM m_order UNION ALL SELECT 'TaxAmt', {usd('sum(TaxAmt)')} FROM m_order UNION ALL SELECT 'Freight', {usd('sum(Freight)')} FROM m_order"),
    "op_strings_dates": mirror_sql(f"""SELECT SalesOrderID, replace(replace(PurchaseOrderNumber, 'PO-', 'P'), '1', 'I') AS Code, strftime({_TOUCH}, '%Y-%m-%d %H:%M:%S') AS Stamp,
      PurchaseOrderNumber || '-20010802000000' AS UniqueCode, format('{{:,}}', CAST(round(SubTotal, 0) AS BIGINT)) AS Shown, strftime(OrderDate, '%b %Y') AS MonthLabel,
      OrderDate - INTERVAL 1 MONTH AS MonthBefore, OrderDate + INTERVAL 1 YEAR - INTERVAL 30 DAY AS YearAfter, {dd('OrderDate', 'DueDate')} AS DaysDue,
      {dd('OrderDate', _TOUCH, 'hour')} AS Hours, {dd('OrderDate', _TOUCH, 'minute')} AS Minutes, {dd('OrderDate', NOW, 'month')} AS Months, {dd('OrderDate', NOW, 'year')} AS Years,
      {dd('OrderDate', NOW, 'quarter')} AS Quarters, {_WEEKS} AS Weeks, {ts(f"date_trunc('day', {_TOUCH})")} AS Day,
      CAST(round(CAST(CAST(SubTotal AS DOUBLE) / 3 AS DECIMAL(28,10)), 1) AS DOUBLE) AS Third,
      {big("strftime(OrderDate, '%U')::INT + CASE WHEN dayofweek(date_trunc('year', OrderDate)) = 0 THEN 0 ELSE 1 END")} AS Week,
      {big('year(OrderDate) + CASE WHEN month(OrderDate) >= 7 THEN 1 ELSE 0 END')} AS FiscalYear, DeletedBy AS Actor, CAST(SubTotal AS VARCHAR) AS Text FROM m_order"""),
}
