"""Declared schemas. Nothing here is ever inferred from files."""

from pyspark.sql import types as T

_L, _I, _S, _D, _TS, _B = (
    T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.TimestampType(), T.BooleanType())
MONEY = T.DecimalType(19, 4)


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


CUSTOMER_IN = _struct(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D), ("c_mktsegment", _S))
PART_IN = _struct(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S), ("p_size", _I),
                  ("p_retailprice", _D))
ORDERS_IN = _struct(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _D),
                    ("o_orderdate", _TS), ("o_orderpriority", _S))
LINEITEM_IN = _struct(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
                      ("l_quantity", _D), ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D),
                      ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _TS))
EVENTS_IN = _struct(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S), ("value", _D), ("props", _S))

RAW = {"customer": CUSTOMER_IN, "part": PART_IN, "orders": ORDERS_IN, "lineitem": LINEITEM_IN, "events": EVENTS_IN}

AUDIT_COLUMNS = {"IsDeleted": _B, "DeletedDate": _TS, "DeletedBy": _S}

# Key of each mirrored table; None where the table has no key of its own.
KEYS = {
    "Customer": "CustomerID",
    "Product": "ProductID",
    "ProductCategory": "ProductCategoryID",
    "ProductModel": "ProductModelID",
    "SalesOrderHeader": "SalesOrderID",
    "SalesOrderDetail": None,
    "CustomerAddress": None,
}

# Column metadata as declared at the source: (type name, user defined, computed definition, nullable, max length).
# They restate the declared source types.
DECLARED = {
    "Customer": {
        "CustomerID": ("int", False, None, False, None),
        "NameStyle": ("bit", True, None, False, None),
        "FirstName": ("nvarchar", True, None, False, 50),
        "MiddleName": ("nvarchar", True, None, True, 50),
        "LastName": ("nvarchar", True, None, False, 50),
        "CompanyName": ("nvarchar", False, None, True, 128),
        "EmailAddress": ("nvarchar", False, None, True, 50),
        "Phone": ("nvarchar", True, None, True, 25),
    },
    "Product": {
        "ProductID": ("int", False, None, False, None),
        "Name": ("nvarchar", True, None, False, 50),
        "ProductNumber": ("nvarchar", False, None, False, 25),
        "Size": ("nvarchar", False, None, True, 5),
        "StandardCost": ("money", False, None, False, None),
        "ListPrice": ("money", False, None, False, None),
    },
    "ProductCategory": {
        "ProductCategoryID": ("int", False, None, False, None),
        "Name": ("nvarchar", True, None, False, 50),
    },
    "ProductModel": {
        "ProductModelID": ("int", False, None, False, None),
        "Name": ("nvarchar", True, None, False, 50),
        "CatalogDescription": ("xml", False, None, True, None),
    },
    "SalesOrderHeader": {
        "SalesOrderID": ("int", False, None, False, None),
        "OnlineOrderFlag": ("bit", True, None, False, None),
        "PurchaseOrderNumber": ("nvarchar", True, None, True, 25),
        "AccountNumber": ("nvarchar", True, None, True, 15),
        "SalesOrderNumber": ("nvarchar", False, "'SO' + SalesOrderID", True, 25),
        "TotalDue": ("money", False, "SubTotal + TaxAmt + Freight", True, None),
    },
    "SalesOrderDetail": {
        "SalesOrderID": ("int", False, None, False, None),
        "ProductID": ("int", False, None, False, None),
        "OrderQty": ("smallint", False, None, False, None),
        "LineTotal": ("money", False, "OrderQty * UnitPrice * (1 - UnitPriceDiscount)", True, None),
    },
    "CustomerAddress": {
        "CustomerID": ("int", False, None, False, None),
        "AddressType": ("nvarchar", True, None, False, 50),
    },
}
