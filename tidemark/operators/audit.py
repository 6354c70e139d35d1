"""Compatibility and data audits before and after mirroring. Each table is read once per audit, whatever its width."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import band, line_total, matches_any
from tidemark.sources import schemas
from tidemark.sources.tables import Tables

# Declared type name -> engine type a value must convert to.
BASE_TYPES = {"int": "bigint", "smallint": "int", "bit": "boolean", "money": "decimal(19,4)", "nvarchar": "string",
              "xml": "string"}


def type_class(kind: str, user_defined: bool, computed: str | None) -> str:
    if computed:
        return "COMPUTED"
    if kind == "xml":
        return "XML"
    return "UDT" if user_defined else "STANDARD"


def proposed_type(kind: str, length: int | None) -> str:
    """Standard type to replace a user-defined one, by base type name; unknown names become NVARCHAR(50)."""
    rules = {"nvarchar": f"NVARCHAR({length})", "bit": "BIT", "int": "INT", "smallint": "INT", "money": "DECIMAL(19,4)",
             "decimal": "DECIMAL(19,4)"}
    return rules.get(kind, "NVARCHAR(50)")


def profile_columns(tables: Tables, declared: dict = schemas.DECLARED) -> DataFrame:
    """One row per declared column: type class, and null, length and conversion facts where the column is mirrored."""
    parts = []
    for name, columns in declared.items():
        df, cells = tables[name], []
        for column, (kind, udt, computed, _, _) in columns.items():
            present = column in df.columns
            text = F.col(column).cast("string") if present else None
            missing = F.lit(None).cast("bigint")
            cells.append(F.struct(
                F.lit(name).alias("TableName"), F.lit(column).alias("ColumnName"),
                F.lit(type_class(kind, udt, computed)).alias("TypeClass"),
                (F.count_if(F.col(column).isNull()) if present else missing).alias("NullCount"),
                (F.max(F.length(text)).cast("bigint") if present else missing).alias("MaxLength"),
                (F.count_if(text.isNotNull() & text.try_cast(BASE_TYPES[kind]).isNull()) if present else missing)
                .alias("CastFailures")))
        parts.append(df.agg(F.array(*cells).alias("c")).select(F.inline("c")))
    return reduce(DataFrame.union, parts)


def type_proposals(tables: Tables, declared: dict = schemas.DECLARED) -> DataFrame:
    """Every user-defined column with its standard type and the rows that would not fit it."""
    parts = []
    for name, columns in declared.items():
        df, cells = tables[name], []
        for column, (kind, udt, _, _, length) in columns.items():
            if udt and column in df.columns:
                text = F.col(column).cast("string")
                bad = text.isNotNull() & text.try_cast(BASE_TYPES[kind]).isNull()
                if length:
                    bad = bad | (F.length(text) > length)
                cells.append(F.struct(F.lit(name).alias("TableName"), F.lit(column).alias("ColumnName"),
                                      F.lit(proposed_type(kind, length)).alias("ProposedStandardType"),
                                      F.count("*").alias("Rows"), F.count_if(bad).alias("FailedRows")))
        if cells:
            parts.append(df.agg(F.array(*cells).alias("c")).select(F.inline("c")))
    return reduce(DataFrame.union, parts)


def convert(df: DataFrame, target: dict[str, T.DataType | str]) -> tuple[DataFrame, DataFrame]:
    """Convert columns, turning values that do not fit into null; with the count of such values per column."""
    out = df.select(*[F.col(c).try_cast(target[c]).alias(c) if c in target else F.col(c) for c in df.columns])
    cells = [F.struct(F.lit(c).alias("ColumnName"),
                      F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias("RejectedRows"))
             for c, t in target.items()]
    return out, df.agg(F.array(*cells).alias("c")).select(F.inline("c"))


def quarantine(df: DataFrame, key: list[str], target: dict[str, T.DataType | str], longest: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows whose every value fits, converted, and the values that do not: (key columns, ColumnName, RejectedValue, TargetType, Reason).

    A row with any such value is in the second frame only, once per value. ``longest`` bounds texts of the named columns. Each
    frame is one pass over the table without a shuffle."""
    cells, longest = [], longest or {}
    for c in dict.fromkeys([*target, *longest]):
        text = F.col(c).cast("string")
        kind = target.get(c, df.schema[c].dataType)
        name = kind if isinstance(kind, str) else kind.simpleString()
        bad = F.when(text.isNotNull() & F.col(c).try_cast(kind).isNull(), "CAST")
        if c in longest:
            bad = bad.when(F.length(text) > longest[c], "LENGTH")
            name = f"{name}({longest[c]})"
        cells.append(F.when(bad.isNotNull(), F.struct(F.lit(c).alias("ColumnName"), text.alias("RejectedValue"), F.lit(name).alias("TargetType"), bad.alias("Reason"))))
    marked = df.withColumn("_bad", F.array_compact(F.array(*cells)))
    good = marked.filter(F.size("_bad") == 0).select(*[F.col(c).try_cast(target[c]).alias(c) if c in target else F.col(c) for c in df.columns])
    return good, marked.filter(F.size("_bad") > 0).select(*key, F.inline("_bad"))


def conformance(tables: Tables, declared: dict = schemas.DECLARED) -> DataFrame:
    """Violations of declared nullability and length."""
    parts = []
    for name, columns in declared.items():
        df, cells = tables[name], []
        for column, (_, _, computed, nullable, length) in columns.items():
            if column in df.columns and not computed and (length or not nullable):
                c = F.col(column)
                cells.append(F.struct(
                    F.lit(name).alias("TableName"), F.lit(column).alias("ColumnName"),
                    F.count_if(c.isNull() & F.lit(not nullable)).alias("NullViolations"),
                    F.count_if(F.length(c.cast("string")) > (length or 2**31 - 1)).alias("LengthViolations")))
        if cells:
            parts.append(df.agg(F.array(*cells).alias("c")).select(F.inline("c")))
    return reduce(DataFrame.union, parts)


def key_audit(df: DataFrame, key: list[str], name: str) -> DataFrame:
    """Rows, rows with a null in the key, keys held by several rows, and rows beyond the first of their key."""
    groups = df.groupBy(*key).agg(F.count("*").alias("n"))
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    twice = ~null & (F.col("n") > 1)
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("Rows"), F.coalesce(F.sum(F.when(null, F.col("n"))), F.lit(0)).alias("NullKeys"),
        F.count_if(twice).alias("DuplicateKeys"),
        F.coalesce(F.sum(F.when(twice, F.col("n") - 1)), F.lit(0)).alias("SurplusRows"),
    ).select(F.lit(name).alias("TableName"), F.lit(",".join(key)).alias("KeyColumns"), "*",
             F.when((F.col("NullKeys") > 0) | (F.col("DuplicateKeys") > 0), "Missing Primary Key").otherwise("OK")
             .alias("Issue"))


def key_audits(tables: Tables) -> DataFrame:
    natural = {"SalesOrderDetail": ["SalesOrderID", "ProductID"], "CustomerAddress": ["CustomerID", "AddressType"]}
    parts = [key_audit(tables[n], [k] if k else natural[n], n) for n, k in schemas.KEYS.items()]
    return reduce(DataFrame.union, parts)


def backfill(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Nulls of the named columns replaced by their defaults, cast to the column's type."""
    return df.select(*[F.coalesce(c, F.lit(defaults[c]).cast(df.schema[c].dataType)).alias(c) if c in defaults
                       else F.col(c) for c in df.columns])


def truncate_binary(df: DataFrame, column: str, limit: int = 1 << 20) -> DataFrame:
    """Cut a binary column to what the mirror stores (1 MiB), keeping the original size beside it."""
    size = F.octet_length(column)
    return df.select(*[c for c in df.columns if c != column], F.substring(F.col(column), 1, limit).alias(column),
                     size.alias("OriginalBytes"), (size > limit).alias("Truncated"))


def issue_summary(tables: Tables) -> DataFrame:
    """One row: tables affected per class of issue."""
    profile, keys = profile_columns(tables), key_audits(tables)
    broken = keys.agg(F.count_if(F.col("Issue") != "OK")).scalar()
    name, kind = F.col("TableName"), F.col("TypeClass")
    return profile.agg(
        F.count_distinct(F.when(kind == "UDT", name)).alias("UDTIssues"),
        F.count_distinct(F.when(kind == "COMPUTED", name)).alias("ComputedIssues"),
        F.count_distinct(F.when(kind == "XML", name)).alias("XMLIssues"),
        F.count_distinct(F.when(F.col("CastFailures") > 0, name)).alias("CastIssues"),
        F.sum("NullCount").alias("NullValues")).withColumn("KeyIssues", broken)


def row_count_integrity(before: Tables, after: Tables) -> DataFrame:
    """Row counts of each table on both sides of a conversion."""
    parts = [before[n].agg(F.count("*").alias("RowsBefore"))
             .select(F.lit(n).alias("TableName"), "RowsBefore", after[n].agg(F.count("*")).scalar().alias("RowsAfter"))
             for n in before]
    return reduce(DataFrame.union, parts).withColumn(
        "Status", F.when(F.col("RowsBefore") == F.col("RowsAfter"), "OK").otherwise("MISMATCH"))


def reconcile_header_detail(tables: Tables, tolerance: str = "0.01") -> DataFrame:
    """Stored order subtotal against the sum of its lines."""
    sums = tables["SalesOrderDetail"].groupBy("SalesOrderID").agg(F.sum(line_total()).alias("LineSum"))
    gap = F.abs(F.col("SubTotal") - F.col("LineSum"))
    state = (F.when(F.col("LineSum").isNull(), "NO_LINES").when(gap <= F.lit(tolerance).cast("decimal(5,2)"), "MATCH")
             .otherwise(band(gap, [(100000, "LARGE_GAP"), (1000, "GAP")], "SMALL_GAP")))
    return (tables["SalesOrderHeader"].join(sums, "SalesOrderID", "left")
            .select("SalesOrderID", "SubTotal", "LineSum", (F.col("SubTotal") - F.col("LineSum")).alias("Difference"),
                    state.alias("Reconciliation")))


EDGES = [("SalesOrderDetail", "SalesOrderHeader", "SalesOrderID"), ("SalesOrderDetail", "Product", "ProductID"),
         ("SalesOrderHeader", "Customer", "CustomerID"), ("Product", "ProductCategory", "ProductCategoryID"),
         ("Product", "ProductModel", "ProductModelID"), ("CustomerAddress", "Customer", "CustomerID"),
         ("SalesOrderHeader", "SalesOrderDetail", "SalesOrderID"), ("Customer", "SalesOrderHeader", "CustomerID")]


def referential(tables: Tables, edges: list[tuple[str, str, str]] = EDGES) -> DataFrame:
    """Rows of the first table without a partner in the second, per edge. Partner keys are deduplicated map-side, so a
    key held by very many partner rows costs one row in the join."""
    parts = [tables[a].select(k).join(tables[b].select(k).distinct(), k, "left_anti").agg(F.count("*").alias("Orphans"))
             .select(F.lit(a).alias("FromTable"), F.lit(b).alias("ToTable"), F.lit(k).alias("KeyColumn"), "Orphans")
             for a, b, k in edges]
    return reduce(DataFrame.union, parts)


def find_records(tables: Tables, rules: dict[str, Column]) -> DataFrame:
    """Rows per table that meet a rule built from patterns, and what part of the table they are."""
    parts = [tables[n].agg(F.count_if(rule).alias("MatchedRows"), F.count("*").alias("TotalRows"))
             .select(F.lit(n).alias("TableName"), "*") for n, rule in rules.items()]
    return reduce(DataFrame.union, parts)


def pattern_rule(columns: dict[str, list[str]], values: dict[str, list] | None = None, ci: bool = False) -> Column:
    """OR of LIKE pattern groups and value lists."""
    tests = [matches_any(c, p, ci) for c, p in columns.items()]
    tests += [F.col(c).isin(v) for c, v in (values or {}).items()]
    return reduce(lambda a, b: a | b, tests)
