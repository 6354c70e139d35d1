"""Projection of the raw order tables onto the mirrored sales tables.

Each list holds select expressions valid in Spark SQL and in ANSI SQL engines alike, so the test oracle reads the very
same mirrored rows. The expressions add the nulls, blanks, deletes and zero costs that the raw tables lack. Money is
exact decimal; a unit price is the line's gross amount over its quantity, cut (not rounded) to four decimals.
"""

EPOCH = "DATE '2001-08-01'"

CUSTOMER = [
    "c_custkey AS CustomerID",
    "CASE WHEN c_custkey % 41 = 0 THEN 'Mr.' END AS Title",
    "'Customer' AS FirstName",
    "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE substr(c_mktsegment, 1, 1) END AS MiddleName",
    "substr(c_name, 10) AS LastName",
    "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN concat(c_mktsegment, ' CO') END"
    " AS CompanyName",
    "CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN ''"
    " ELSE concat('c', CAST(c_custkey AS STRING), '@example.com') END AS EmailAddress",
    "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat('555-', CAST(c_custkey AS STRING)) END AS Phone",
    f"CAST({EPOCH} - CAST(c_custkey % 400 AS INT) AS TIMESTAMP) AS ModifiedDate",
    "CASE WHEN c_custkey % 37 = 5 THEN NULL ELSE c_custkey % 20 = 0 END AS IsDeleted",
    f"CASE WHEN c_custkey % 20 = 0 AND c_custkey % 37 <> 5"
    f" THEN CAST({EPOCH} - CAST(c_custkey % 90 AS INT) AS TIMESTAMP) END AS DeletedDate",
    "CASE WHEN c_custkey % 20 = 0 AND c_custkey % 37 <> 5 THEN 'ops' END AS DeletedBy",
]

PRODUCT = [
    "p_partkey AS ProductID",
    "p_name AS Name",
    "concat('P-', CAST(p_partkey AS STRING)) AS ProductNumber",
    "CASE p_partkey % 4 WHEN 0 THEN 'Black' WHEN 1 THEN 'Red' WHEN 2 THEN 'Silver' END AS Color",
    "CAST(p_size AS STRING) AS Size",
    "CAST(p_size AS DECIMAL(8,2)) AS Weight",
    "CAST(ascii(p_type) * 100 + length(p_type) AS BIGINT) AS ProductCategoryID",
    "CAST(substr(p_brand, 7) AS BIGINT) AS ProductModelID",
    "CASE WHEN p_partkey % 97 = 0 THEN CAST(0 AS DECIMAL(19,4))"
    " ELSE CAST(CAST(p_retailprice AS DECIMAL(9,2)) * CAST(50 + p_partkey % 40 AS DECIMAL(4,0))"
    " * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(19,4)) END AS StandardCost",
    "CAST(p_retailprice AS DECIMAL(19,4)) AS ListPrice",
    "CAST(DATE '1995-01-01' + CAST(p_partkey % 365 AS INT) AS TIMESTAMP) AS SellStartDate",
    "CASE WHEN p_partkey % 17 = 0 THEN CAST(DATE '2000-01-01' + CAST(p_partkey % 365 AS INT) AS TIMESTAMP) END"
    " AS SellEndDate",
    "CASE WHEN p_partkey % 19 = 0 THEN CAST(DATE '2000-06-01' AS TIMESTAMP) END AS DiscontinuedDate",
    "p_partkey % 23 = 0 AS IsDeleted",
    "CASE WHEN p_partkey % 23 = 0 THEN CAST(DATE '2001-07-01' + CAST(p_partkey % 30 AS INT) AS TIMESTAMP) END"
    " AS DeletedDate",
    "CASE WHEN p_partkey % 23 = 0 THEN 'ops' END AS DeletedBy",
    f"CAST({EPOCH} - CAST(p_partkey % 200 AS INT) AS TIMESTAMP) AS ModifiedDate",
]

ORDER_HEADER = [
    "o_orderkey AS SalesOrderID",
    "o_custkey AS CustomerID",
    "o_orderdate AS OrderDate",
    "CAST(CAST(o_orderdate AS DATE) + 12 AS TIMESTAMP) AS DueDate",
    "CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INT) AS TIMESTAMP) END"
    " AS ShipDate",
    "CAST(CASE WHEN o_orderstatus = 'F' THEN 5 WHEN o_orderstatus = 'O' THEN 1 + o_orderkey % 2"
    " WHEN o_orderkey % 10 = 0 THEN 6 WHEN o_orderkey % 10 = 1 THEN 4 ELSE 3 END AS INT) AS Status",
    "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS OnlineOrderFlag",
    "concat('PO-', CAST(o_orderkey AS STRING)) AS PurchaseOrderNumber",
    "concat('ACC-', CAST(o_custkey AS STRING)) AS AccountNumber",
    "CASE o_orderkey % 4 WHEN 0 THEN 'EXPEDITED' WHEN 1 THEN 'STANDARD GROUND' WHEN 2 THEN 'TRUCK GROUND' END"
    " AS ShipMethod",
    "CAST(o_totalprice AS DECIMAL(19,4)) AS SubTotal",
    "CAST(CAST(o_totalprice AS DECIMAL(13,2)) * CAST(0.08 AS DECIMAL(3,2)) AS DECIMAL(19,4)) AS TaxAmt",
    "CAST(CAST(o_totalprice AS DECIMAL(13,2)) * CAST(0.02 AS DECIMAL(3,2)) AS DECIMAL(19,4)) AS Freight",
    "o_orderkey % 25 = 0 AS IsDeleted",
    "CASE WHEN o_orderkey % 25 = 0 THEN CAST(CAST(o_orderdate AS DATE) + 3 AS TIMESTAMP) END AS DeletedDate",
    "CASE WHEN o_orderkey % 25 = 0 THEN 'ops' END AS DeletedBy",
    "CAST(CAST(o_orderdate AS DATE) + 1 AS TIMESTAMP) AS ModifiedDate",
]

ORDER_DETAIL = [
    "l_orderkey AS SalesOrderID",
    "l_partkey AS ProductID",
    "CAST(l_quantity AS INT) AS OrderQty",
    "CAST(CAST(floor(floor(l_extendedprice * 100 + 0.5) * 100 / l_quantity) AS DECIMAL(14,0))"
    " * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(19,4)) AS UnitPrice",
    "CAST(l_discount AS DECIMAL(4,2)) AS UnitPriceDiscount",
]

CUSTOMER_ADDRESS = [
    "c_custkey AS CustomerID",
    "CASE WHEN c_custkey % 5 = 0 THEN 'Shipping' ELSE 'Main Office' END AS AddressType",
]

CHANGE = [
    "event_id AS seq",
    "user_id AS key",
    "ts",
    "CASE WHEN user_id % 3 = 0 THEN 'Customer' WHEN user_id % 3 = 1 THEN 'Product' ELSE 'SalesOrderHeader' END"
    " AS table_name",
    "CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' WHEN 'purchase' THEN 'R' ELSE 'U' END AS op",
    "concat('user', CAST(user_id % 7 AS STRING)) AS actor",
    "CASE WHEN event_type IN ('signup', 'click') THEN value END AS set_value",
    "CASE WHEN event_type IN ('signup', 'view') THEN props END AS set_props",
]

# mirrored table -> (raw table, select list, distinct rows only)
MIRROR = {
    "Customer": ("customer", CUSTOMER, False),
    "Product": ("part", PRODUCT, False),
    "ProductCategory": (
        "part", ["CAST(ascii(p_type) * 100 + length(p_type) AS BIGINT) AS ProductCategoryID", "p_type AS Name"], True),
    "ProductModel": ("part", ["CAST(substr(p_brand, 7) AS BIGINT) AS ProductModelID", "p_brand AS Name"], True),
    "SalesOrderHeader": ("orders", ORDER_HEADER, False),
    "SalesOrderDetail": ("lineitem", ORDER_DETAIL, False),
    "CustomerAddress": ("customer", CUSTOMER_ADDRESS, False),
}
