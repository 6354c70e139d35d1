"""Reference SQL for the change, stream, audit and monitoring operators."""

from tidemark.oracle.base import DUE, ENOW, LINE, NOW, big, dd, div, gone, live, mirror_sql, pct, ts, usd
from tidemark.sources.mapping import MIRROR
from tidemark.sources.schemas import DECLARED, KEYS, RAW

AUDIT = "IsDeleted, DeletedDate, DeletedBy"
FLAG = f"{big('IsDeleted')} AS IsDeleted"
VIEW = {"Customer": "m_customer", "Product": "m_product", "ProductCategory": "m_category", "ProductModel": "m_model",
        "SalesOrderHeader": "m_order", "SalesOrderDetail": "m_line", "CustomerAddress": "m_address"}
P_OUT = f"{usd('Weight')} AS Weight, {usd('StandardCost')} AS StandardCost, {usd('ListPrice')} AS ListPrice"
O_OUT = (f"{big('Status')} AS Status, {big('OnlineOrderFlag')} AS OnlineOrderFlag, {usd('SubTotal')} AS SubTotal,"
         f" {usd('TaxAmt')} AS TaxAmt, {usd('Freight')} AS Freight")

REOPENED = f"""
SELECT (SELECT max(CustomerID) FROM m_customer) + row_number() OVER (ORDER BY LastName) AS CustomerID, Title, 'Reopened' AS FirstName,
  MiddleName, LastName, CompanyName, EmailAddress, Phone, {NOW} AS ModifiedDate, FALSE AS IsDeleted,
  CAST(NULL AS TIMESTAMP) AS DeletedDate, CAST(NULL AS VARCHAR) AS DeletedBy
FROM m_customer WHERE coalesce(IsDeleted, FALSE)"""


def stamped(table: str, key: str, hit: str, flag: str, when: str, who: str) -> str:
    def pick(new, old):
        return f"CASE WHEN {hit} THEN {new} ELSE {old} END"
    return f"""SELECT {key}, {big(pick(flag, 'IsDeleted'))} AS IsDeleted, {pick(when, 'DeletedDate')} AS DeletedDate,
      {pick(who, 'DeletedBy')} AS DeletedBy, {pick(NOW, 'ModifiedDate')} AS ModifiedDate FROM {table}"""


FOLD = """
SELECT table_name, "key", arg_max(set_value, seq) FILTER (set_value IS NOT NULL) AS set_value,
  arg_max(set_props, seq) FILTER (set_props IS NOT NULL) AS set_props,
  coalesce(max(seq) FILTER (op = 'D'), -1) > coalesce(max(seq) FILTER (op = 'R'), -1) AS gone,
  arg_max(ts, seq) FILTER (op = 'D') AS dts, arg_max(actor, seq) FILTER (op = 'D') AS dby, arg_max(ts, seq) AS mts, max(seq) AS last
FROM m_change GROUP BY 1, 2"""
FOLDED = f"""SELECT table_name, "key", set_value, set_props, {big('gone')} AS IsDeleted, CASE WHEN gone THEN dts END AS DeletedDate,
  CASE WHEN gone THEN dby END AS DeletedBy, mts AS ModifiedDate, last AS LastSeq FROM f"""

COUNTS = """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS WindowStart, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS WindowEnd, table_name,
  count(*) FILTER (op = 'I') AS Inserts, count(*) FILTER (op = 'U') AS Updates, count(*) FILTER (op = 'D') AS Deletes,
  count(*) FILTER (op = 'R') AS Restores, count(*) AS Changes,
  CASE WHEN count(*) > 1000 THEN 'HIGH' WHEN count(*) > 100 THEN 'MEDIUM' ELSE 'LOW' END AS ActivityLevel
FROM m_change GROUP BY 1, 2, 3"""
ARRIVED = "SELECT *, ts + to_minutes(seq % 97) AS arrived FROM m_change"

SESSIONS = f"""
SELECT user_id, min(ts) AS SessionStart, max(ts) AS LastEvent, count(*) AS Events, count(*) FILTER (event_type = 'error') AS Errors,
  CASE WHEN max(ts) <= {ENOW} - INTERVAL 240 MINUTE THEN max(ts) END AS SessionEnd
FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid FROM
  (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 240 MINUTE THEN 0 ELSE 1 END AS fresh
   FROM events)) GROUP BY user_id, sid"""
SESSION_COLS = f"""user_id, SessionStart, SessionEnd, Events, Errors,
  {dd('SessionStart', f'coalesce(SessionEnd, {ENOW})', 'minute')} AS DurationMinutes, LastEvent,
  CASE WHEN SessionEnd IS NULL THEN 'OPEN' ELSE 'CLOSED' END AS SessionState"""

WAITS = """
SELECT p_id AS BlockingEvent, event_id AS BlockedEvent, user_id, p_type AS BlockingType, w AS WaitSeconds,
  CASE WHEN w > 30 THEN 'CRITICAL' WHEN w > 10 THEN 'HIGH' WHEN w > 5 THEN 'MEDIUM' ELSE 'LOW' END AS ImpactLevel
FROM (SELECT *, lag(event_id) OVER o AS p_id, lag(event_type) OVER o AS p_type, date_diff('second', lag(ts) OVER o, ts) AS w
      FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE event_type = 'error'"""

MIRRORED = {
    "Customer": "SELECT * REPLACE (coalesce(EmailAddress, '') AS EmailAddress) FROM m_customer WHERE Phone IS NOT NULL "
                "UNION ALL SELECT * REPLACE (CustomerID + 1000000000000 AS CustomerID) FROM m_customer WHERE Title IS NOT NULL",
    "Product": "SELECT * FROM m_product", "ProductCategory": "SELECT * FROM m_category",
    "SalesOrderHeader": "SELECT * FROM m_order WHERE NOT IsDeleted",
    "SalesOrderDetail": "SELECT * FROM m_line WHERE OrderQty > 2 UNION ALL SELECT * FROM m_line WHERE OrderQty = 50",
}


def recon(name: str) -> str:
    view, key = VIEW[name], KEYS[name]
    mirror = MIRRORED.get(name, f"SELECT * FROM {view} WHERE FALSE")
    if key is None:
        return f"""SELECT '{name}' AS TableName, (SELECT count(*) FROM {view}) AS SourceRows, (SELECT count(*) FROM ({mirror})) AS MirrorRows,
          (SELECT count(*) FROM (SELECT * FROM {view} EXCEPT ALL ({mirror}))) AS MissingRows,
          (SELECT count(*) FROM (({mirror}) EXCEPT ALL SELECT * FROM {view})) AS ExtraRows, CAST(0 AS BIGINT) AS ChangedRows, {name in MIRRORED} AS Enabled"""
    return f"""SELECT '{name}' AS TableName, count(k) AS SourceRows, count(k2) AS MirrorRows, count(*) FILTER (k2 IS NULL) AS MissingRows,
      count(*) FILTER (k IS NULL) AS ExtraRows, count(*) FILTER (k = k2 AND a <> b) AS ChangedRows, {name in MIRRORED} AS Enabled
      FROM (SELECT s.{key} AS k, to_json(s) AS a FROM {view} s) x FULL JOIN (SELECT d.{key} AS k2, to_json(d) AS b FROM ({mirror}) d) y ON k = k2"""


RECON = " UNION ALL ".join(recon(n) for n in KEYS)
RECON_FLAGGED = "SELECT *, MissingRows + ExtraRows + ChangedRows = 0 AS InSync FROM r"

USED = "event_type IN ('click', 'view', 'purchase')"
V = "CAST(value AS DECIMAL(18,2))"
FACTS = f"""
SELECT (SELECT count(*) FROM q) AS total, (SELECT count(*) FROM q WHERE Enabled) AS enabled,
  (SELECT count(*) FROM q WHERE Enabled AND NOT InSync) AS failing,
  (SELECT count(*) FROM s WHERE SessionEnd IS NULL AND date_diff('minute', SessionStart, {ENOW}) > 30) AS longs,
  (SELECT count(*) FROM w WHERE ImpactLevel = 'CRITICAL') AS blocked,
  (SELECT {pct(f'sum({V}) FILTER ({USED})', f'sum({V})')} FROM events) AS used"""
FACT_PARTS = {"r": RECON, "q": RECON_FLAGGED, "s": SESSIONS, "w": WAITS, "f": FACTS}

_TRY = {"int": "BIGINT", "smallint": "INTEGER", "bit": "BOOLEAN", "money": "DECIMAL(19,4)", "nvarchar": "VARCHAR", "xml": "VARCHAR"}
# columns of the mirrored views, needed to tell which declared columns exist
_HAVE = {
    "Customer": {"CustomerID", "FirstName", "MiddleName", "LastName", "CompanyName", "EmailAddress", "Phone"},
    "Product": {"ProductID", "Name", "ProductNumber", "Size", "StandardCost", "ListPrice"},
    "ProductCategory": {"ProductCategoryID", "Name"}, "ProductModel": {"ProductModelID", "Name"},
    "SalesOrderHeader": {"SalesOrderID", "OnlineOrderFlag", "PurchaseOrderNumber", "AccountNumber"},
    "SalesOrderDetail": {"SalesOrderID", "ProductID", "OrderQty"}, "CustomerAddress": {"CustomerID", "AddressType"},
}


def _class(kind, udt, computed):
    return "COMPUTED" if computed else "XML" if kind == "xml" else "UDT" if udt else "STANDARD"


def _profile() -> str:
    parts = []
    for t, cols in DECLARED.items():
        for c, (kind, udt, computed, _, _) in cols.items():
            head = f"SELECT '{t}' AS TableName, '{c}' AS ColumnName, '{_class(kind, udt, computed)}' AS TypeClass, "
            if c in _HAVE[t]:
                parts.append(head + f"count(*) FILTER ({c} IS NULL) AS NullCount, max(length(CAST({c} AS VARCHAR))) AS MaxLength, "
                             f"count(*) FILTER ({c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS {_TRY[kind]}) IS NULL) AS CastFailures FROM {VIEW[t]}")
            else:
                parts.append(head + "CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)")
    return " UNION ALL ".join(parts)


def _proposals() -> str:
    parts = []
    for t, cols in DECLARED.items():
        for c, (kind, udt, _, _, n) in cols.items():
            if udt and c in _HAVE[t]:
                kind_text = {"nvarchar": f"NVARCHAR({n})", "bit": "BIT"}[kind]
                long = f" OR length({c}) > {n}" if n else ""
                parts.append(f"""SELECT '{t}' AS TableName, '{c}' AS ColumnName, '{kind_text}' AS ProposedStandardType, count(*) AS "Rows",
                  count(*) FILTER (({c} IS NOT NULL AND TRY_CAST({c} AS {_TRY[kind]}) IS NULL){long}) AS FailedRows FROM {VIEW[t]}""")
    return " UNION ALL ".join(parts)


def _conformance() -> str:
    parts = []
    for t, cols in DECLARED.items():
        for c, (_, _, computed, nullable, n) in cols.items():
            if c in _HAVE[t] and not computed and (n or not nullable):
                nulls = "CAST(0 AS BIGINT)" if nullable else f"count(*) FILTER ({c} IS NULL)"
                longs = f"count(*) FILTER (length({c}) > {n})" if n else "CAST(0 AS BIGINT)"
                parts.append(f"SELECT '{t}' AS TableName, '{c}' AS ColumnName, {nulls} AS NullViolations, {longs} AS LengthViolations FROM {VIEW[t]}")
    return " UNION ALL ".join(parts)


def _keys() -> str:
    natural = {"SalesOrderDetail": ["SalesOrderID", "ProductID"], "CustomerAddress": ["CustomerID", "AddressType"]}
    parts = []
    for t, k in KEYS.items():
        cols = [k] if k else natural[t]
        null = " OR ".join(f"{c} IS NULL" for c in cols)
        parts.append(f"""SELECT '{t}' AS TableName, '{','.join(cols)}' AS KeyColumns, {big('sum(n)')} AS "Rows",
          {big(f'coalesce(sum(n) FILTER ({null}), 0)')} AS NullKeys, count(*) FILTER (n > 1 AND NOT ({null})) AS DuplicateKeys,
          {big(f'coalesce(sum(n - 1) FILTER (n > 1 AND NOT ({null})), 0)')} AS SurplusRows
          FROM (SELECT {', '.join(cols)}, count(*) n FROM {VIEW[t]} GROUP BY ALL)""")
    return " UNION ALL ".join(parts)


PROFILE, KEY_ROWS = _profile(), _keys()
ISSUE = "CASE WHEN NullKeys > 0 OR DuplicateKeys > 0 THEN 'Missing Primary Key' ELSE 'OK' END"


def _orphans() -> str:
    edges = [("SalesOrderDetail", "SalesOrderHeader", "SalesOrderID"), ("SalesOrderDetail", "Product", "ProductID"),
             ("SalesOrderHeader", "Customer", "CustomerID"), ("Product", "ProductCategory", "ProductCategoryID"),
             ("Product", "ProductModel", "ProductModelID"), ("CustomerAddress", "Customer", "CustomerID"),
             ("SalesOrderHeader", "SalesOrderDetail", "SalesOrderID"), ("Customer", "SalesOrderHeader", "CustomerID")]
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS FromTable, '{b}' AS ToTable, '{k}' AS KeyColumn, count(*) AS Orphans FROM {VIEW[a]} x
            WHERE NOT EXISTS (SELECT 1 FROM {VIEW[b]} y WHERE y.{k} = x.{k})""" for a, b, k in edges)


def per_table(select: str, names=("Customer", "Product", "SalesOrderHeader")) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS TableName, {select} FROM {VIEW[n]}" for n in names)


_REMOVED = f"""
  SELECT 'Customer' AS TableName, (SELECT count(*) FROM m_customer WHERE coalesce(EmailAddress, 'x') <> '') AS kept
  UNION ALL SELECT 'Product', (SELECT count(*) FROM m_product WHERE Name NOT LIKE '%bolt%')
  UNION ALL SELECT 'ProductCategory', (SELECT count(*) FROM m_category)
  UNION ALL SELECT 'ProductModel', (SELECT count(*) FROM m_model)
  UNION ALL SELECT 'SalesOrderHeader', (SELECT count(*) FROM ko)
  UNION ALL SELECT 'SalesOrderDetail', (SELECT count(*) FROM m_line JOIN ko USING (SalesOrderID) JOIN m_product p USING (ProductID) WHERE p.Name NOT LIKE '%bolt%')
  UNION ALL SELECT 'CustomerAddress', (SELECT count(*) FROM m_address JOIN m_customer c USING (CustomerID) WHERE coalesce(c.EmailAddress, 'x') <> '')"""
_KEPT_ORDERS = """SELECT o.SalesOrderID FROM m_order o JOIN m_customer c USING (CustomerID)
  WHERE coalesce(c.EmailAddress, 'x') <> '' AND NOT (o.IsDeleted AND coalesce(o.ShipMethod, '') = 'EXPEDITED')"""
_SIZES = " UNION ALL ".join(f"SELECT '{n}' AS TableName, count(*) AS n FROM {v}" for n, v in VIEW.items())
_COUNT3 = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {VIEW[n]}" for n in ("Customer", "Product", "SalesOrderHeader"))
_MONTH = f"{NOW} - INTERVAL 720 HOUR"

SQL = {
    "assign_keys": mirror_sql("SELECT CustomerID, LastName FROM x", x=REOPENED),
    "insert_rows": mirror_sql(f"SELECT * REPLACE ({FLAG}) FROM (SELECT * FROM m_customer UNION ALL BY NAME SELECT * FROM x)", x=REOPENED),
    "update_by_key": mirror_sql(f"""
      SELECT ProductID, CASE WHEN Color = 'Black' THEN Name || ' sale' ELSE Name END AS Name,
        {usd("CASE WHEN Color = 'Black' THEN ListPrice * 0.75 ELSE ListPrice END")} AS ListPrice, {usd('StandardCost')} AS StandardCost, {FLAG},
        CASE WHEN Color = 'Black' THEN {NOW} ELSE ModifiedDate END AS ModifiedDate FROM m_product"""),
    "bulk_update": mirror_sql(f"""
      SELECT SalesOrderID, {big('Status')} AS Status, ShipMethod,
        CASE WHEN Status IN (5, 6) THEN DueDate ELSE {NOW} + to_days(CASE ShipMethod WHEN 'EXPEDITED' THEN 3 WHEN 'STANDARD GROUND' THEN 7
          WHEN 'TRUCK GROUND' THEN 10 ELSE 5 END) END AS DueDate, CASE WHEN Status IN (5, 6) THEN ModifiedDate ELSE {NOW} END AS ModifiedDate
      FROM m_order"""),
    "update_from": mirror_sql(f"""
      SELECT p.ProductID, p.ProductCategoryID, {usd("CAST(p.StandardCost * CASE g.Name WHEN 'LARGE' THEN 0.95 WHEN 'SMALL' THEN 1.02 WHEN 'PROMO' THEN 0.98 ELSE 1.00 END AS DECIMAL(19,4))")} AS StandardCost,
        {usd('p.ListPrice')} AS ListPrice, CASE WHEN g.Name IS NULL THEN p.ModifiedDate ELSE {NOW} END AS ModifiedDate
      FROM m_product p LEFT JOIN m_category g USING (ProductCategoryID)"""),
    "soft_delete": mirror_sql(stamped("m_customer c", "CustomerID",
      f"NOT EXISTS (SELECT 1 FROM m_order o WHERE o.CustomerID = c.CustomerID AND {live('o')} AND o.OrderDate >= TIMESTAMP '2001-01-01')",
      "TRUE", NOW, "'auditor'")),
    "bulk_soft_delete": mirror_sql(stamped("m_product", "ProductID", "StandardCost = 0", "TRUE", NOW, "'auditor'")),
    "undelete": mirror_sql(stamped("m_customer c", "CustomerID",
      f"{gone('c')} AND EXISTS (SELECT 1 FROM m_order o WHERE o.CustomerID = c.CustomerID AND {live('o')} AND o.OrderDate >= TIMESTAMP '2001-06-01')",
      "FALSE", "NULL", "NULL")),
    "purge": mirror_sql("""SELECT a.TableName, a.n AS RowsBefore, b.kept AS RowsAfter, CASE WHEN a.n = b.kept THEN 'OK' ELSE 'MISMATCH' END AS Status
      FROM sizes a JOIN kept b USING (TableName)""", ko=_KEPT_ORDERS, kept=_REMOVED, sizes=_SIZES),
    "affected_counts": mirror_sql("""
      SELECT 'cancel_expedited' AS Statement, count(*) FILTER (IsDeleted AND ShipMethod = 'EXPEDITED') AS AffectedRows FROM m_order
      UNION ALL SELECT 'reschedule_open', count(*) FILTER (Status NOT IN (5, 6)) FROM m_order
      UNION ALL SELECT 'restore_shipped', count(*) FILTER (IsDeleted AND Status = 5) FROM m_order"""),
    "with_audit_columns": mirror_sql("SELECT *, CAST(0 AS BIGINT) AS IsDeleted, CAST(NULL AS TIMESTAMP) AS DeletedDate, CAST(NULL AS VARCHAR) AS DeletedBy FROM m_address"),
    "active_customers": mirror_sql(f"SELECT * EXCLUDE ({AUDIT}) FROM m_customer c WHERE {live('c')}"),
    "active_products": mirror_sql(f"SELECT * EXCLUDE ({AUDIT}) REPLACE ({P_OUT}) FROM m_product p WHERE {live('p')}"),
    "active_orders": mirror_sql(f"SELECT * EXCLUDE ({AUDIT}) REPLACE ({O_OUT}) FROM m_order o WHERE {live('o')}"),
    "historical_customers": mirror_sql(f"""SELECT * REPLACE ({FLAG}), CASE WHEN {gone('c')} THEN 'DELETED' ELSE 'ACTIVE' END AS RecordStatus,
      CASE WHEN {gone('c')} THEN {dd('ModifiedDate', 'DeletedDate')} END AS DaysActive FROM m_customer c"""),
    "historical_products": mirror_sql(f"""SELECT * REPLACE ({FLAG}, {P_OUT}), CASE WHEN {gone('p')} THEN 'DELETED' ELSE 'ACTIVE' END AS RecordStatus,
      CASE WHEN {gone('p')} THEN {dd('SellStartDate', 'coalesce(SellEndDate, DeletedDate)')} END AS ProductLifespanDays FROM m_product p"""),
    "soft_delete_summary": mirror_sql(per_table("count(*) AS TotalRecords, count(*) FILTER (coalesce(IsDeleted, FALSE)) AS DeletedRecords, count(*) FILTER (NOT coalesce(IsDeleted, FALSE)) AS ActiveRecords")),
    "recently_deleted": mirror_sql(f"""
      SELECT 'Product' AS RecordType, CAST(ProductID AS VARCHAR) AS RecordID, Name AS RecordName, DeletedDate, DeletedBy FROM m_product WHERE IsDeleted AND DeletedDate >= {_MONTH}
      UNION ALL SELECT 'Customer', CAST(CustomerID AS VARCHAR), concat(FirstName, ' ', LastName), DeletedDate, DeletedBy FROM m_customer WHERE IsDeleted AND DeletedDate >= {_MONTH}
      UNION ALL SELECT 'SalesOrder', CAST(SalesOrderID AS VARCHAR), 'Order #' || SalesOrderID, DeletedDate, DeletedBy FROM m_order WHERE IsDeleted AND DeletedDate >= {_MONTH}"""),
    "preserved_value": mirror_sql(f"""
      SELECT {usd(f'coalesce(sum({DUE}), 0)')} AS PreservedRevenue, count(*) AS PreservedOrders,
        (SELECT count(*) FROM m_customer WHERE IsDeleted AND DeletedDate >= {_MONTH}) AS PreservedCustomers,
        (SELECT count(*) FROM m_product WHERE IsDeleted AND DeletedDate >= {_MONTH}) AS PreservedProducts
      FROM m_order o JOIN m_customer c USING (CustomerID) WHERE c.IsDeleted AND c.DeletedDate >= {_MONTH}"""),
    "update_impact": mirror_sql(f"""
      SELECT 'Customer' AS TableName, count(*) FILTER (ModifiedDate >= {_MONTH}) AS UpdatedRows, CAST(NULL AS DOUBLE) AS AvgListPrice FROM m_customer
      UNION ALL SELECT 'Product', count(*) FILTER (ModifiedDate >= {_MONTH}), {div(f'sum(ListPrice) FILTER (ModifiedDate >= {_MONTH})', f'count(*) FILTER (ModifiedDate >= {_MONTH})')} FROM m_product
      UNION ALL SELECT 'SalesOrderHeader', count(*) FILTER (ModifiedDate >= {_MONTH}), NULL FROM m_order"""),
    "profile_columns": mirror_sql("SELECT * FROM x", x=PROFILE),
    "type_proposals": mirror_sql("SELECT * FROM x", x=_proposals()),
    "convert_types": mirror_sql(" UNION ALL ".join(
        f"SELECT '{c}' AS ColumnName, count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL) AS RejectedRows FROM m_customer"
        for c, t in (("EmailAddress", "INTEGER"), ("Phone", "INTEGER"), ("MiddleName", "BOOLEAN"), ("LastName", "BIGINT")))),
    "conformance": mirror_sql("SELECT * FROM x", x=_conformance()),
    "key_audit": mirror_sql(f"SELECT *, {ISSUE} AS Issue FROM x", x=KEY_ROWS),
    "backfill": mirror_sql("SELECT CustomerID, coalesce(Title, 'n/a') AS Title, CAST(coalesce(IsDeleted, FALSE) AS BIGINT) AS IsDeleted, coalesce(Phone, '') AS Phone FROM m_customer"),
    **{name: f"""SELECT page_id, {big('octet_length(b)')} AS OriginalBytes, {big(f'least(octet_length(b), {n})')} AS KeptBytes,
      md5(b[1:{n}]) AS KeptHash, {big(f'octet_length(b) > {n}')} AS Truncated FROM (SELECT page_id, encode(html) AS b FROM pages)"""
       for name, n in (("truncate_binary", 1 << 20), ("truncate_binary_small", 2048))},
    "issue_summary": mirror_sql(f"""
      SELECT count(DISTINCT TableName) FILTER (TypeClass = 'UDT') AS UDTIssues, count(DISTINCT TableName) FILTER (TypeClass = 'COMPUTED') AS ComputedIssues,
        count(DISTINCT TableName) FILTER (TypeClass = 'XML') AS XMLIssues, count(DISTINCT TableName) FILTER (CastFailures > 0) AS CastIssues,
        {big('sum(NullCount)')} AS NullValues, (SELECT count(*) FROM k WHERE {ISSUE} <> 'OK') AS KeyIssues FROM x""", x=PROFILE, k=KEY_ROWS),
    "row_count_integrity": mirror_sql("""SELECT TableName, n AS RowsBefore, n - CASE WHEN TableName = 'SalesOrderHeader' THEN d ELSE 0 END AS RowsAfter,
      CASE WHEN TableName = 'SalesOrderHeader' AND d > 0 THEN 'MISMATCH' ELSE 'OK' END AS Status
      FROM s, (SELECT count(*) AS d FROM m_order WHERE IsDeleted)""", s=_SIZES),
    "reconcile_header_detail": mirror_sql(f"""
      SELECT o.SalesOrderID, {usd('o.SubTotal')} AS SubTotal, {usd('s.t')} AS LineSum, {usd('o.SubTotal - s.t')} AS Difference,
        CASE WHEN s.t IS NULL THEN 'NO_LINES' WHEN abs(o.SubTotal - s.t) <= 0.01 THEN 'MATCH' WHEN abs(o.SubTotal - s.t) >= 100000 THEN 'LARGE_GAP'
             WHEN abs(o.SubTotal - s.t) >= 1000 THEN 'GAP' ELSE 'SMALL_GAP' END AS Reconciliation
      FROM m_order o LEFT JOIN (SELECT l.SalesOrderID, sum({LINE}) AS t FROM m_line l GROUP BY 1) s USING (SalesOrderID)"""),
    "referential": mirror_sql("SELECT * FROM x", x=_orphans()),
    "find_records": mirror_sql("""
      SELECT 'Customer' AS TableName, count(*) FILTER (EmailAddress LIKE 'c1%@example.com' OR EmailAddress LIKE '%99@%' OR CompanyName LIKE '%BUILD%' OR FirstName = 'SoftDelete') AS MatchedRows, count(*) AS TotalRows FROM m_customer
      UNION ALL SELECT 'Product', count(*) FILTER (Name LIKE '%bolt%' OR Name LIKE 'small %' OR ProductNumber LIKE 'P-%7' OR Color = 'Silver'), count(*) FROM m_product
      UNION ALL SELECT 'SalesOrderHeader', count(*) FILTER (PurchaseOrderNumber ILIKE 'PO-1__' OR AccountNumber ILIKE 'acc-7%'), count(*) FROM m_order"""),
    "freshness": mirror_sql(f"""SELECT *, {dd('LastModified', NOW, 'minute')} AS MinutesSinceLastUpdate,
      CASE WHEN {dd('LastModified', NOW, 'minute')} <= 5 THEN 'Real-time' WHEN {dd('LastModified', NOW, 'minute')} <= 30 THEN 'Near Real-time'
           WHEN {dd('LastModified', NOW, 'minute')} <= 60 THEN 'Delayed' ELSE 'Stale' END AS DataFreshness FROM x""",
      x=per_table("count(*) AS RecordCount, max(ModifiedDate) AS LastModified")),
    "reconcile": mirror_sql(f"SELECT * REPLACE ({big('Enabled')} AS Enabled, {big('InSync')} AS InSync) FROM q", r=RECON, q=RECON_FLAGGED),
    "failing_items": mirror_sql(f"""SELECT TableName, {big('Enabled')} AS Enabled, {big('InSync')} AS InSync,
      CASE WHEN Enabled THEN MissingRows || ' missing, ' || ExtraRows || ' extra, ' || ChangedRows || ' changed' END AS ExceptionMessage,
      CASE WHEN Enabled THEN 'ERROR' ELSE 'NOT_ENABLED' END AS Status FROM q WHERE NOT (Enabled AND InSync)""", r=RECON, q=RECON_FLAGGED),
    "cdc_fold": mirror_sql(FOLDED, f=FOLD),
    "cdc_apply": mirror_sql(FOLDED, f=FOLD),
    "feed_dedupe": mirror_sql("SELECT table_name, op, count(*) AS Changes FROM m_change GROUP BY 1, 2"),
    "change_counts": mirror_sql("SELECT * FROM x", x=COUNTS),
    "change_counts_stream": mirror_sql("SELECT * FROM x", x=COUNTS),
    "late_changes": mirror_sql("""
      SELECT date_trunc('hour', a.arrived) AS WindowStart, a.table_name, count(*) AS Changes, count(*) FILTER (a.ts < m.mark) AS LateChanges
      FROM a LEFT JOIN (SELECT table_name, h, max(newest) OVER (PARTITION BY table_name ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR AS mark
         FROM (SELECT table_name, date_trunc('hour', arrived) AS h, max(ts) AS newest FROM a GROUP BY 1, 2)) m
        ON m.table_name = a.table_name AND m.h = date_trunc('hour', a.arrived) GROUP BY 1, 2""", a=ARRIVED),
    "replication_lag": mirror_sql(f"""
      SELECT {ts("date_trunc('day', ts)")} AS WindowStart, table_name, count(*) AS Changes, {div('sum(lag)', 'count(*)')} AS AvgLagSeconds,
        quantile_disc(lag, 0.5) AS MedianLagSeconds, quantile_disc(lag, 0.95) AS P95LagSeconds, max(lag) AS MaxLagSeconds
      FROM (SELECT *, date_diff('second', ts, arrived) AS lag FROM a) GROUP BY 1, 2""", a=ARRIVED),
    "history": mirror_sql(f"""
      SELECT table_name, "key", seq, op, last_value(set_value IGNORE NULLS) OVER o AS set_value, last_value(set_props IGNORE NULLS) OVER o AS set_props,
        ts AS valid_from, lead(ts) OVER w AS valid_to, {big('lead(ts) OVER w IS NULL')} AS is_current
      FROM m_change WINDOW w AS (PARTITION BY table_name, "key" ORDER BY seq),
        o AS (PARTITION BY table_name, "key" ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    "price_history": mirror_sql("""SELECT table_name, "key", seq, ts, set_value, lag(set_value) OVER (PARTITION BY table_name, "key" ORDER BY seq) AS PreviousPrice
      FROM m_change WHERE set_value IS NOT NULL"""),
    "sessions": mirror_sql(f"SELECT {SESSION_COLS} FROM s", s=SESSIONS),
    "band_durations": mirror_sql(f"""SELECT {SESSION_COLS}, {dd('SessionStart', ENOW, 'second')} AS DurationSeconds,
      CASE WHEN {dd('SessionStart', ENOW, 'second')} > 300 THEN 'LONG_RUNNING' WHEN {dd('SessionStart', ENOW, 'second')} > 60 THEN 'MODERATE' ELSE 'SHORT' END AS Classification
      FROM s WHERE SessionEnd IS NULL AND SessionStart < {ENOW} - INTERVAL 1 MINUTE""", s=SESSIONS),
    "session_activity": mirror_sql(f"""SELECT user_id, SessionStart, SessionEnd, LastEvent, DurationMinutes,
      CASE WHEN LastEvent >= {ENOW} - INTERVAL 5 MINUTE THEN 'ACTIVE' WHEN LastEvent >= {ENOW} - INTERVAL 30 MINUTE THEN 'RECENT' ELSE 'IDLE' END AS ActivityStatus
      FROM (SELECT {SESSION_COLS} FROM s) WHERE SessionStart >= {ENOW} - INTERVAL 48 HOUR ORDER BY SessionStart DESC, user_id LIMIT 10""", s=SESSIONS),
    "error_sessions": mirror_sql(f"SELECT user_id, SessionStart, SessionEnd, Events, Errors, DurationMinutes FROM (SELECT {SESSION_COLS} FROM s) WHERE Errors > 0", s=SESSIONS),
    "change_activity": mirror_sql(f"""
      SELECT table_name AS TableName, n AS CurrentRows, m AS TotalModifications, last AS LastChange, {pct('m', 'n')} AS ModificationRatePercent,
        CASE WHEN m > n * 0.5 THEN 'VERY_HIGH' WHEN m > n * 0.2 THEN 'HIGH' WHEN m > n * 0.05 THEN 'MEDIUM' ELSE 'LOW' END AS ActivityClassification,
        CASE WHEN m > 10000 THEN 'High' WHEN m > 1000 THEN 'Medium' WHEN m > 100 THEN 'Low' ELSE 'Minimal' END
          || ' mirroring load' || CASE WHEN m > 100 THEN ' expected' ELSE '' END AS MirroringImpact
      FROM c3 JOIN (SELECT table_name, count(*) AS m, max(ts) AS last FROM m_change WHERE ts >= {ENOW} - INTERVAL 24 HOUR GROUP BY 1) USING (table_name)""", c3=_COUNT3),
    "activity_levels": mirror_sql(f"""
      SELECT s.TableName, s.n AS CurrentRows, coalesce(r, 0) AS ModifiedRecently, last AS LastChange,
        CASE WHEN s.TableName IN ('Customer', 'Product', 'ProductCategory', 'SalesOrderHeader', 'SalesOrderDetail') THEN 'YES' ELSE 'NO' END AS IsMirrored,
        CASE WHEN r > 1000 THEN 'HIGH' WHEN r > 100 THEN 'MEDIUM' WHEN r > 0 THEN 'LOW' ELSE 'NONE' END AS ActivityLevel
      FROM sizes s LEFT JOIN (SELECT table_name AS TableName, count(*) FILTER (ts >= {ENOW} - INTERVAL 24 HOUR) AS r, max(ts) AS last FROM m_change GROUP BY 1) USING (TableName)""", sizes=_SIZES),
    "metric_rollup": "SELECT count(*) AS Samples, min(ts) AS SampleTimeStart, max(ts) AS SampleTimeEnd, " + ", ".join(
        f"{div(f'sum({V}) FILTER (event_type = {k!r})', f'count(*) FILTER (event_type = {k!r})')} AS avg_{n}, {usd(f'max({V}) FILTER (event_type = {k!r})')} AS max_{n}"
        for k, n in (("click", "cpu_percent"), ("view", "data_io_percent"), ("purchase", "log_write_percent"), ("signup", "memory_percent"))
    ) + f" FROM events WHERE ts >= {ENOW} - INTERVAL 24 HOUR HAVING count(*) > 0",
    "usage_bands": f"""SELECT user_id, {usd('u')} AS UsedSpace, {usd('t')} AS TotalSpace, p AS UsedPercent, CAST(100 - CAST(p AS DECIMAL(10,2)) AS DOUBLE) AS AvailablePercent,
      CASE WHEN p > 90 THEN 'CRITICAL' WHEN p > 75 THEN 'WARNING' WHEN p > 50 THEN 'CAUTION' ELSE 'HEALTHY' END AS HealthStatus
      FROM (SELECT user_id, sum({V}) FILTER ({USED}) AS u, sum({V}) AS t, {pct(f'sum({V}) FILTER ({USED})', f'sum({V})')} AS p FROM events GROUP BY 1)""",
    "wait_chains": mirror_sql("SELECT * FROM w", w=WAITS),
    "health_score": mirror_sql("""
      SELECT a + b + c + d AS TotalHealthScore, a AS FeedScore, b AS CoverageScore, c AS ErrorScore, d AS CapacityScore,
        CASE WHEN a + b + c + d >= 90 THEN 'EXCELLENT' WHEN a + b + c + d >= 75 THEN 'GOOD' WHEN a + b + c + d >= 60 THEN 'FAIR'
             WHEN a + b + c + d >= 40 THEN 'POOR' ELSE 'CRITICAL' END AS HealthStatus,
        CASE WHEN a = 0 THEN 'Enable Change Feed for mirroring' WHEN b < 30 THEN 'Configure more tables for mirroring'
             WHEN c = 0 THEN 'Resolve Change Feed exceptions' WHEN d = 0 THEN 'Monitor transaction log space' ELSE 'Mirroring is healthy' END AS PrimaryRecommendation
      FROM (SELECT CAST(CASE WHEN enabled > 0 THEN 40 ELSE 0 END AS BIGINT) AS a, CAST(enabled * 30 // total AS BIGINT) AS b,
        CAST(CASE WHEN failing = 0 THEN 20 ELSE 0 END AS BIGINT) AS c, CAST(CASE WHEN used < 75 THEN 10 ELSE 0 END AS BIGINT) AS d FROM f)""", **FACT_PARTS),
    "alerts": mirror_sql("""
      SELECT CAST(Priority AS BIGINT) AS Priority, Category, Recommendation, CASE Category WHEN 'CRITICAL' THEN 'Immediate action required' WHEN 'HIGH' THEN 'Address within 24 hours'
        WHEN 'MEDIUM' THEN 'Address within a week' WHEN 'LOW' THEN 'Monitor and address as needed' ELSE 'For information only' END AS ActionTimeline
      FROM (SELECT 1 AS Priority, 'CRITICAL' AS Category, 'No table is mirrored. Enable the change feed.' AS Recommendation FROM f WHERE enabled = 0
       UNION ALL SELECT 2, 'HIGH', 'Some mirrored tables are out of step. Review their rows and types.' FROM f WHERE failing > 0
       UNION ALL SELECT 3, 'MEDIUM', 'Log usage is high. Look for long-running work.' FROM f WHERE used > 75
       UNION ALL SELECT 4, 'MEDIUM', 'Long-running sessions found. They may slow mirroring.' FROM f WHERE longs > 0
       UNION ALL SELECT 5, 'LOW', 'Blocked work found. It may delay mirroring.' FROM f WHERE blocked > 0
       UNION ALL SELECT 1, 'INFO', 'All mirrored tables are enabled and in step, and no limit is exceeded.' FROM f
         WHERE enabled > 0 AND failing = 0 AND used <= 75 AND longs = 0 AND blocked = 0)""", **FACT_PARTS),
}
SQL |= {"late_changes_stream": SQL["late_changes"], "session_stream": SQL["sessions"], "feed_dedupe_stream": SQL["feed_dedupe"],
        "late_dedupe_stream": SQL["feed_dedupe"], "cdc_snapshot": SQL["cdc_fold"], "history_incremental": SQL["history"]}
_WITH_PURGES = "SELECT * REPLACE (CASE WHEN op = 'D' AND seq % 4 = 0 THEN 'P' ELSE op END AS op) FROM m_change"
_PURGES = """SELECT table_name, "key", max(seq) AS purged FROM x WHERE op = 'P' GROUP BY 1, 2"""
_LIVING = """SELECT x.* FROM x LEFT JOIN p USING (table_name, "key") WHERE op <> 'P' AND (purged IS NULL OR seq > purged)"""
_MIDDLE = "(SELECT (min(seq) + max(seq)) // 2 FROM m_change)"
SQL |= {
    "cdc_purge": mirror_sql(FOLDED, x=_WITH_PURGES, p=_PURGES, l=_LIVING, f=FOLD.replace("m_change", "l")),
    "cdc_evolve": mirror_sql(FOLDED, f=FOLD.replace("set_props IS NOT NULL", f"set_props IS NOT NULL AND seq > {_MIDDLE}")),
    "evolved_rows": mirror_sql(f"""SELECT CustomerID, LastName, CASE WHEN CustomerID % 2 <> 0 THEN Phone END AS Phone, ModifiedDate,
      {big('CASE WHEN CustomerID % 2 <> 0 THEN coalesce(IsDeleted, FALSE) ELSE FALSE END')} AS IsDeleted,
      CASE WHEN CustomerID % 2 <> 0 THEN DeletedDate END AS DeletedDate, CASE WHEN CustomerID % 2 <> 0 THEN DeletedBy END AS DeletedBy FROM m_customer"""),
    "purge_counts": mirror_sql("SELECT a.TableName, a.n AS RowsBefore, b.kept AS RowsAfter, a.n - b.kept AS RowsRemoved FROM sizes a JOIN kept b USING (TableName)",
                               ko=_KEPT_ORDERS, kept=_REMOVED, sizes=_SIZES),
    "feed_counts_stream": mirror_sql("""SELECT count(*) FILTER (op = 'I') AS Inserts, count(*) FILTER (op = 'U') AS Updates,
      count(*) FILTER (op = 'D') AS Deletes, count(*) FILTER (op = 'R') AS Restores FROM m_change"""),
}


def _differing(name: str) -> str:
    view, key = VIEW[name], KEYS[name]
    columns = [e.split(" AS ")[-1] for e in MIRROR[name][1]]
    named = ", ".join(f"CASE WHEN x.{c} IS DISTINCT FROM y.{c} THEN '{c}' END" for c in columns if c != key)
    changed = " OR ".join(f"x.{c} IS DISTINCT FROM y.{c}" for c in columns if c != key)
    return f"""SELECT '{name}' AS TableName, CAST(coalesce(x.{key}, y.{key}) AS VARCHAR) AS KeyValue,
      CASE WHEN y.{key} IS NULL THEN 'MISSING' WHEN x.{key} IS NULL THEN 'EXTRA' ELSE 'CHANGED' END AS Difference,
      CASE WHEN x.{key} = y.{key} THEN concat_ws(',', {named}) END AS "Columns"
      FROM {view} x FULL JOIN ({MIRRORED[name]}) y ON x.{key} = y.{key} WHERE x.{key} IS NULL OR y.{key} IS NULL OR {changed}"""


def _catalogued(table: str) -> str:
    types = {"LongType()": "bigint", "IntegerType()": "int", "DoubleType()": "double", "StringType()": "string", "TimestampType()": "timestamp"}
    return " UNION ALL ".join(
        f"SELECT '{table}' AS TableName, '{f.name}' AS ColumnName, CAST({i} AS BIGINT) AS Position, '{types[repr(f.dataType)]}' AS DataType,"
        f" count(*) AS \"RowCount\", count(*) - count({f.name}) AS NullCount FROM {table}" for i, f in enumerate(RAW[table], 1))


_DIALLED = "SELECT * REPLACE (CASE WHEN CustomerID % 5 <> 0 THEN substr(Phone, 5, 12) ELSE Phone END AS Phone) FROM m_customer"
_FITS = {"LastName": "BIGINT", "Phone": "INTEGER", "MiddleName": "BOOLEAN"}
_SPARK = {"LastName": "bigint", "Phone": "int", "MiddleName": "boolean"}
_MISFIT = {c: f"({c} IS NOT NULL AND TRY_CAST({c} AS {t}) IS NULL)" for c, t in _FITS.items()} | {"CompanyName": "length(CompanyName) > 12"}
SQL |= {
    "reconcile_rows": mirror_sql("SELECT * FROM q", q=" UNION ALL ".join(_differing(n) for n in MIRRORED if KEYS[n])),
    "converted_rows": mirror_sql(f"""SELECT CustomerID, CAST(LastName AS BIGINT) AS LastName, CAST(Phone AS BIGINT) AS Phone,
      CAST(CAST(MiddleName AS BOOLEAN) AS BIGINT) AS MiddleName, CompanyName FROM x WHERE NOT coalesce({' OR '.join(_MISFIT.values())}, FALSE)""", x=_DIALLED),
    "rejected_values": mirror_sql(" UNION ALL ".join(
        f"SELECT CustomerID, '{c}' AS ColumnName, {c} AS RejectedValue, '{_SPARK.get(c, 'string(12)')}' AS TargetType, '{'CAST' if c in _FITS else 'LENGTH'}' AS Reason FROM x WHERE {m}"
        for c, m in _MISFIT.items()), x=_DIALLED),
    "catalog_inventory": " UNION ALL ".join(map(_catalogued, ("customer", "part", "orders", "lineitem", "events"))),
}
SQL |= {"purge_rows": mirror_sql("""
  SELECT 'Customer' AS TableName, CAST(CustomerID AS VARCHAR) AS RowName FROM m_customer WHERE coalesce(EmailAddress, 'x') <> ''
  UNION ALL SELECT 'Product', CAST(ProductID AS VARCHAR) FROM m_product WHERE Name NOT LIKE '%bolt%'
  UNION ALL SELECT 'ProductCategory', CAST(ProductCategoryID AS VARCHAR) FROM m_category
  UNION ALL SELECT 'ProductModel', CAST(ProductModelID AS VARCHAR) FROM m_model
  UNION ALL SELECT 'SalesOrderHeader', CAST(SalesOrderID AS VARCHAR) FROM ko
  UNION ALL SELECT 'SalesOrderDetail', concat(l.SalesOrderID, '|', l.ProductID, '|', l.OrderQty) FROM m_line l JOIN ko USING (SalesOrderID)
    JOIN m_product p USING (ProductID) WHERE p.Name NOT LIKE '%bolt%'
  UNION ALL SELECT 'CustomerAddress', concat(a.CustomerID, '|', a.AddressType) FROM m_address a JOIN m_customer c USING (CustomerID)
    WHERE coalesce(c.EmailAddress, 'x') <> ''""", ko=_KEPT_ORDERS)}
