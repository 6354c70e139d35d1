"""Checksums that narrow down, prefix sums over large keys, rejected values, catalogue scans and lateral joins."""

from decimal import Decimal

import pandas as pd
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tidemark.functions import frames
from tidemark.operators import audit, monitor
from tidemark.plans import mirror_queries, primitives
from tidemark.sources import schemas
from tidemark.sources.tables import load_mirror


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def moved(df):
    """Rows that went through shuffles, by the plan's own metrics."""
    df.collect()
    total = 0
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        for i in range(node.children().size()):
            todo.append(node.children().apply(i))
    return total


def test_sides_in_step_move_checksums_only(spark):
    tables = load_mirror(spark, DATA)
    pairs = {n: (tables[n], tables[n], schemas.KEYS[n]) for n in ("Customer", "SalesOrderHeader", "SalesOrderDetail")}
    rows = monitor._sides(pairs)
    sums = monitor._checksums(rows)
    stored = monitor.materialize(sums, "test")
    assert stored.where(monitor._differs()).count() == 0
    assert monitor._open_rows(rows, stored).count() == 0
    out = monitor._reconciled(pairs)
    assert all(r.InSync for r in out.collect())
    assert moved(out) < 100  # nothing but one row per table and task


def test_few_differences_open_few_buckets(spark):
    """Two rows of 40,000 differ: the rest stays where it is."""
    left = spark.range(40_000).selectExpr("id as k", "id % 7 as a", "cast(id as string) as b")
    right = left.withColumn("b", F.when(F.col("k") == 77, "other").otherwise(F.col("b"))).where("k <> 4000")
    rows = monitor._sides({"t": (left, right, "k")})
    sums = monitor.materialize(monitor._checksums(rows), "test")
    assert sums.where(monitor._differs()).count() == 2 and monitor._open_rows(rows, sums).count() < 100
    got = monitor.reconcile(left, right, "k").first()
    assert (got.SourceRows, got.MirrorRows, got.MissingRows, got.ExtraRows, got.ChangedRows) == (40_000, 39_999, 1, 0, 1)


def test_differing_keys_and_columns(spark, demo):
    people = demo["Customer"]
    mirror = people.where("CustomerID < 3").withColumn("Phone", F.when(F.col("CustomerID") == 1, F.lit(None)).otherwise(F.col("Phone"))).withColumn(
        "LastName", F.when(F.col("CustomerID") == 1, "New").otherwise(F.col("LastName")))
    mirror = mirror.union(people.where("CustomerID = 2").withColumn("CustomerID", F.lit(8).cast("long"))).union(people.where("CustomerID = 2"))
    mirror = mirror.union(people.where("CustomerID = 2").withColumn("CustomerID", F.lit(None).cast("long")))
    got = {(r.KeyValue, r.Difference, r.Columns) for r in monitor.reconcile_rows({"Customer": people}, {"Customer": mirror}).collect()}
    assert got == {("1", "CHANGED", "LastName,Phone"), ("3", "MISSING", None), ("8", "EXTRA", None), ("2", "REPEATED", None), (None, "EXTRA", None)}


# ---- prefix sums

@pytest.mark.parametrize("buckets", [2, 16, 64])
def test_prefix_sums_when_one_key_holds_half(spark, buckets):
    n = 4000
    rows = pd.DataFrame({"id": range(n), "k": [0 if i % 2 else i % 37 for i in range(n)], "o": [(i * 7919) % 300 for i in range(n)],
                         "v": [None if i % 5 == 0 else i % 11 for i in range(n)]})
    df = spark.createDataFrame(rows).withColumn("v", F.when(F.isnan("v"), None).otherwise(F.col("v")).cast("decimal(12,2)"))
    out = frames.running_sums(df, ["k"], ["o", "id"], {"s": F.col("v"), "c": F.lit(1)}, buckets=buckets)
    got = {r.id: (r.s, r.c) for r in out.collect()}
    want, total = {}, {}
    for r in rows.sort_values(["k", "o", "id"]).itertuples():
        s, c = total.get(r.k, (None, 0))
        if r.v == r.v and r.v is not None:
            s = (s or 0) + Decimal(int(r.v))
        total[r.k] = (s, c + 1)
        want[r.id] = total[r.k]
    assert got == want


def test_prefix_sums_of_everything(spark):
    df = spark.range(5000).withColumn("v", F.col("id") % 3)
    out = frames.running_sums(df, [], ["id"], {"s": F.col("v")}, buckets=32).orderBy("id").collect()
    total = 0
    for r in out:
        total += r.id % 3
        assert r.s == total
    split = frames._stretches(df.select(F.struct(F.lit(0).alias("all")).alias("_key"), "id"), ["id"], 32).groupBy("_chunk").count()
    assert split.count() > 16 and split.agg(F.max("count")).first()[0] < 5000 / 4
    assert frames.running_sums(df.limit(0), [], ["id"], {"s": F.col("v")}).count() == 0


# ---- rejects

def test_rows_are_converted_or_rejected_never_both(spark):
    rows = [(1, "12", "true", "abc"), (2, "x", "maybe", "abc"), (3, None, None, None), (4, "99999999999", "false", "abcdef"), (None, "7", "1", "abcd")]
    df = spark.createDataFrame(rows, "id long, n string, b string, s string")
    good, bad = audit.quarantine(df, ["id"], {"n": "int", "b": "boolean"}, {"s": 4})
    assert sorted((r.id or 0, r.n, r.b, r.s) for r in good.collect()) == [(0, 7, True, "abcd"), (1, 12, True, "abc"), (3, None, None, None)]
    assert sorted(tuple(r) for r in bad.collect()) == [(2, "b", "maybe", "boolean", "CAST"), (2, "n", "x", "int", "CAST"),
                                                       (4, "n", "99999999999", "int", "CAST"), (4, "s", "abcdef", "string(4)", "LENGTH")]
    assert "Exchange" not in plan(good) and "Exchange" not in plan(bad)
    assert audit.quarantine(df.limit(0), ["id"], {"n": "int"})[1].count() == 0


def test_all_customers_are_accounted_for(spark):
    tables = load_mirror(spark, DATA)
    good, bad = mirror_queries.quarantined(tables)
    rejected = bad.select("CustomerID").distinct().count()
    assert rejected > 0 and good.count() > 0 and good.count() + rejected == tables["Customer"].count()


# ---- catalogue, lateral join

def test_catalogue_counts_come_from_footers(spark):
    out = mirror_queries.catalog_inventory(spark, DATA)
    text = plan(out)
    assert text.count("PushedAggregation: [COUNT(*)") >= 5 and "FileScan" not in text
    assert out.count() == sum(len(schemas.RAW[t]) for t in ("customer", "part", "orders", "lineitem", "events"))
    for name in ("customer", "part", "orders", "lineitem", "events"):
        spark.catalog.dropTempView(f"listed_{name}")


def test_lateral_join_needs_no_nested_loop(spark):
    text = plan(primitives.lateral_top(load_mirror(spark, DATA), None))
    assert "NestedLoop" not in text and "Cartesian" not in text and "WindowGroupLimit" in text
