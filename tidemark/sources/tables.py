"""Readers, writers and the table catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import mapping, schemas

Tables = dict[str, DataFrame]


def read_raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(schemas.RAW[name]).parquet(f"{folder}/{name}.parquet")


def load_mirror(spark: SparkSession, folder: str) -> Tables:
    """All mirrored tables as lazy projections over the raw parquet; filters and column choice reach the scan."""
    tables = {}
    for name, (raw, exprs, distinct) in mapping.MIRROR.items():
        df = read_raw(spark, folder, raw).selectExpr(*exprs)
        tables[name] = df.distinct() if distinct else df
    return tables


def load_changes(spark: SparkSession, folder: str) -> DataFrame:
    return read_raw(spark, folder, "events").selectExpr(*mapping.CHANGE)


def stream_events(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """The event table as a file stream, whether it is one file, several, or folders of part files."""
    reader = spark.readStream.schema(schemas.EVENTS_IN)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{folder}/events*.parquet")


def stream_changes(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """The change feed of ``load_changes`` as a file stream."""
    return stream_events(spark, folder, files_per_trigger).selectExpr(*mapping.CHANGE)


def register_views(tables: Tables, prefix: str = "") -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def drop_views(spark: SparkSession, names, prefix: str = "") -> None:
    for name in names:
        spark.catalog.dropTempView(f"{prefix}{name}")


def table_inventory(tables: Tables) -> DataFrame:
    """One row per table with its row count; counts come from parquet footers where the scan allows it."""
    counts = [df.agg(F.count("*").alias("RowCount")).select(F.lit(name).alias("TableName"), "RowCount")
              for name, df in sorted(tables.items())]
    return reduce(DataFrame.union, counts).orderBy("TableName")


def register_raw(spark: SparkSession, folder: str, names: list[str], prefix: str) -> None:
    """Tables of a folder as views the catalogue lists, read so that counts are answered from file footers."""
    sources = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(sources)
    spark.conf.set(sources, ",".join(s for s in before.split(",") if s != "parquet"))
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        for name in names:
            read_raw(spark, folder, name).createOrReplaceTempView(f"{prefix}{name}")
    finally:
        spark.conf.set(sources, before)


def catalog_scan(spark: SparkSession, prefix: str = "") -> DataFrame:
    """Every column of every table the catalogue lists under a name that starts with ``prefix``: its place, type, and how many of the
    table's rows it is null in. Over files with statistics no row is read."""
    parts = []
    for table in spark.catalog.listTables():
        if table.name.startswith(prefix):
            columns = spark.catalog.listColumns(table.name)
            cells = [F.struct(F.lit(table.name.removeprefix(prefix)).alias("TableName"), F.lit(c.name).alias("ColumnName"), F.lit(place).alias("Position"),
                              F.lit(c.dataType).alias("DataType"), F.col("n").alias("RowCount"), (F.col("n") - F.col(f"c{place}")).alias("NullCount"))
                     for place, c in enumerate(columns, 1)]
            counts = spark.table(table.name).agg(F.count("*").alias("n"), *[F.count(f"`{c.name}`").alias(f"c{place}") for place, c in enumerate(columns, 1)])
            parts.append(counts.select(F.inline(F.array(*cells))))
    return reduce(DataFrame.union, parts)


def append_rows(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def snapshot(tables: Tables, root: str, partition_by: dict[str, list[str]] | None = None) -> None:
    """Initial full copy of the chosen tables."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        keys = (partition_by or {}).get(name)
        if keys:
            writer = writer.partitionBy(*keys)
        writer.parquet(f"{root}/{name}")


def merged_schema(spark: SparkSession, root: str) -> T.StructType:
    """The union of the columns of all files below ``root``; a column that changed its type is an error that names it."""
    try:
        return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(root).schema
    except Exception as err:
        told = str(err)
        if "CANNOT_MERGE_SCHEMAS" not in told:
            raise
        raise ValueError(f"the files below {root} hold one column with several types: {told[told.index('CANNOT_MERGE_SCHEMAS'):].split('SQLSTATE')[0]}") from err


def read_evolving(spark: SparkSession, root: str) -> DataFrame:
    """All files below ``root`` by the union of their columns: a file from before a column was added gives nulls for it."""
    return spark.read.schema(merged_schema(spark, root)).option("recursiveFileLookup", "true").parquet(root)
