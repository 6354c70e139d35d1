"""Reports on soft-deleted rows."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import at, concat_nullable, flag_is, is_active, is_deleted, mean, shift, total_due
from tidemark.sources.tables import Tables

AUDITED = ("Customer", "Product", "SalesOrderHeader")


def soft_delete_summary(tables: Tables) -> DataFrame:
    rows = [tables[n].agg(F.count("*").alias("TotalRecords"), F.count_if(is_deleted()).alias("DeletedRecords"),
                          F.count_if(is_active()).alias("ActiveRecords"))
            .select(F.lit(n).alias("TableName"), "*") for n in AUDITED]
    return reduce(DataFrame.union, rows).orderBy("TableName")


def _recent(df: DataFrame, as_of: datetime, hours: int) -> DataFrame:
    return df.filter(flag_is("IsDeleted", True) & (F.col("DeletedDate") >= shift(at(as_of), hours=-hours)))


def recently_deleted(tables: Tables, as_of: datetime, hours: int = 1) -> DataFrame:
    """Rows of three entities deleted within the look-back, in one common shape."""
    shapes = {
        "Product": ("ProductID", "Product", F.col("Name")),
        "Customer": ("CustomerID", "Customer", concat_nullable(F.col("FirstName"), F.lit(" "), F.col("LastName"))),
        "SalesOrderHeader": ("SalesOrderID", "SalesOrder",
                             F.concat(F.lit("Order #"), F.col("SalesOrderID").cast("string"))),
    }
    rows = [_recent(tables[n], as_of, hours).select(
        F.lit(kind).alias("RecordType"), F.col(key).cast("string").alias("RecordID"), label.alias("RecordName"),
        "DeletedDate", "DeletedBy") for n, (key, kind, label) in shapes.items()]
    return reduce(DataFrame.union, rows).orderBy(F.desc("DeletedDate"))


def preserved_value(tables: Tables, as_of: datetime, hours: int = 1) -> DataFrame:
    """One row: revenue and orders of recently closed customers, and closed customers and products, all still kept."""
    gone = _recent(tables["Customer"], as_of, hours)
    products = _recent(tables["Product"], as_of, hours).agg(F.count("*")).scalar()
    return (tables["SalesOrderHeader"].join(gone.select("CustomerID"), "CustomerID", "left_semi")
            .agg(F.coalesce(F.sum(total_due()), F.lit(0).cast("decimal(19,4)")).alias("PreservedRevenue"),
                 F.count("SalesOrderID").alias("PreservedOrders"))
            .withColumn("PreservedCustomers", gone.agg(F.count("*")).scalar())
            .withColumn("PreservedProducts", products))


def update_impact(tables: Tables, as_of: datetime, minutes: int = 30) -> DataFrame:
    """Rows modified within the look-back per table, with the mean list price of the products touched."""
    since = shift(at(as_of), minutes=-minutes)
    touched = F.col("ModifiedDate") >= since
    rows = []
    for name in AUDITED:
        price = mean(F.when(touched, F.col("ListPrice"))) if name == "Product" else F.lit(None).cast("double")
        rows.append(tables[name].agg(F.count_if(touched).alias("UpdatedRows"), price.alias("AvgListPrice"))
                    .select(F.lit(name).alias("TableName"), "*"))
    return reduce(DataFrame.union, rows)
