import os
import sys
import tempfile
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tidemark.config import build_session  # noqa: E402
from tidemark.operators.changes import with_audit_columns  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-tests-"))
    yield session
    session.stop()


@pytest.fixture()
def fresh(tmp_path):
    """A new empty folder path."""
    return str(tmp_path)


NOW = datetime(2025, 6, 30, 12, 0, 0)


def demo_tables(spark):
    """Three customers, five products, three orders and six lines of the hand-written scenario."""
    ts = F.lit(NOW).cast("timestamp")

    def frame(rows, schema):
        df = spark.createDataFrame(rows, schema)
        money = [f.name for f in df.schema if f.name in
                 ("StandardCost", "ListPrice", "SubTotal", "TaxAmt", "Freight", "UnitPrice")]
        for c in money:
            df = df.withColumn(c, F.col(c).cast("decimal(19,4)"))
        return df

    people = frame([(1, "Ann", "B", "Cole", "Cole Ltd", "a@x.com", "555-1"), (2, "Dee", None, "Eck", None, "", None),
                    (3, "Fay", "G", "Hale", "Hale Inc", None, "555-3")],
                   "CustomerID long, FirstName string, MiddleName string, LastName string, CompanyName string,"
                   " EmailAddress string, Phone string").withColumn("ModifiedDate", ts)
    goods = frame([(i, f"Item {i}", f"N-{i}", Decimal(c), Decimal(p), g, i) for i, c, p, g in
                   [(1, "89.50", "199.99", 4), (2, "450.75", "899.99", 1), (3, "12.30", "34.99", 32),
                    (4, "75.25", "149.99", 31), (5, "18.75", "49.99", 4)]],
                  "ProductID long, Name string, ProductNumber string, StandardCost decimal(19,4), ListPrice decimal(19,4),"
                  " ProductCategoryID long, ProductModelID long")
    goods = (goods.withColumn("Color", F.lit("Red")).withColumn("Size", F.lit("M"))
             .withColumn("Weight", F.lit(1).cast("decimal(8,2)")).withColumn("SellStartDate", ts - F.expr("INTERVAL 10 DAY"))
             .withColumn("SellEndDate", F.lit(None).cast("timestamp"))
             .withColumn("DiscontinuedDate", F.lit(None).cast("timestamp")).withColumn("ModifiedDate", ts))
    heads = frame([(1, 1, Decimal("249.98"), Decimal("18.75"), Decimal("12.50"), True, 2),
                   (2, 2, Decimal("899.99"), Decimal("67.50"), Decimal("25.00"), True, 5),
                   (3, 3, Decimal("584.95"), Decimal("43.87"), Decimal("45.00"), False, 3)],
                  "SalesOrderID long, CustomerID long, SubTotal decimal(19,4), TaxAmt decimal(19,4), Freight decimal(19,4),"
                  " OnlineOrderFlag boolean, Status int")
    heads = (heads.withColumn("OrderDate", ts).withColumn("DueDate", ts + F.expr("INTERVAL 7 DAY"))
             .withColumn("ShipDate", F.lit(None).cast("timestamp")).withColumn("ModifiedDate", ts)
             .withColumn("PurchaseOrderNumber", F.lit("PO")).withColumn("AccountNumber", F.lit("ACC"))
             .withColumn("ShipMethod", F.lit("EXPEDITED")))
    lines = frame([(1, 1, 1, Decimal("199.99"), Decimal("0.00")), (1, 5, 1, Decimal("49.99"), Decimal("0.00")),
                   (2, 2, 1, Decimal("899.99"), Decimal("0.00")), (3, 3, 10, Decimal("34.99"), Decimal("0.10")),
                   (3, 4, 2, Decimal("149.99"), Decimal("0.05")), (3, 5, 5, Decimal("49.99"), Decimal("0.15"))],
                  "SalesOrderID long, ProductID long, OrderQty int, UnitPrice decimal(19,4), UnitPriceDiscount decimal(4,2)")
    return {
        "Customer": with_audit_columns(people), "Product": with_audit_columns(goods),
        "ProductCategory": spark.createDataFrame([(4, "Accessories"), (1, "Bikes"), (32, "Hydration"), (31, "Stands"),
                                                  (9, "Empty")], "ProductCategoryID long, Name string"),
        "ProductModel": spark.createDataFrame([(i, f"Model {i}") for i in range(1, 6)], "ProductModelID long, Name string"),
        "SalesOrderHeader": with_audit_columns(heads), "SalesOrderDetail": lines,
        "CustomerAddress": spark.createDataFrame([(1, "Main"), (3, "Main")], "CustomerID long, AddressType string"),
    }


@pytest.fixture()
def demo(spark):
    return demo_tables(spark)
