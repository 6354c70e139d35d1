"""Exactness of the split operators when one key or value holds a third of all rows."""

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import frames
from tidemark.plans.primitives import distinct_per_group


@pytest.fixture(scope="module")
def rows():
    n = 3000
    return pd.DataFrame({
        "id": range(n), "k": [0 if i % 3 == 0 else i % 40 for i in range(n)],
        "v": [5 if i % 3 == 1 else (i * 7919) % 500 for i in range(n)],
        "o": [(i * 104729) % 900 for i in range(n)]})


def test_rank_global_with_heavy_ties(spark, rows):
    for ascending in (False, True):
        got = frames.rank_global(spark.createDataFrame(rows), "v", "r", buckets=16, ascending=ascending).toPandas()
        want = rows.v.rank(method="min", ascending=ascending).astype(int)
        assert got.set_index("id").r.sort_index().tolist() == want.tolist()


def test_rank_many_in_one_pass(spark, rows):
    df = spark.createDataFrame(rows).withColumn("m", (F.col("v") / 7).cast("decimal(12,3)"))
    got = frames.rank_many(df, [("v", "a", True), ("m", "d", False), ("o", "e", False)], buckets=32).toPandas().sort_values("id")
    assert got.a.tolist() == rows.v.rank(method="min").astype(int).tolist()
    assert got.d.tolist() == got.m.astype(float).rank(method="min", ascending=False).astype(int).tolist()
    assert got.e.tolist() == rows.o.rank(method="min", ascending=False).astype(int).tolist()


def test_buckets_are_balanced_and_monotone(spark):
    df = spark.range(20000).withColumn("v", F.col("id") * F.col("id"))
    got = frames.with_bucket(df, "v", "b", 64).groupBy("b").agg(F.count("*").alias("n"), F.min("v").alias("lo"),
                                                                 F.max("v").alias("hi")).orderBy("b").collect()
    assert len(got) == 64 and max(r.n for r in got) < 20000 / 64 * 8
    assert all(a.hi < b.lo for a, b in zip(got, got[1:]))


def test_rank_global_with_nulls_and_one_value(spark):
    df = spark.createDataFrame([(1, None), (2, 3), (3, 3), (4, 1)], "id int, v int")
    got = {r.id: r.r for r in frames.rank_global(df, "v", "r").collect()}
    assert got == {2: 1, 3: 1, 4: 3, 1: 4}
    up = {r.id: r.r for r in frames.rank_global(df, "v", "r", ascending=True).collect()}
    assert up == {1: 1, 4: 2, 2: 3, 3: 3}
    assert frames.rank_global(df.filter("id > 9"), "v", "r").count() == 0


def test_rank_in_groups(spark, rows):
    got = frames.rank_in_groups(spark.createDataFrame(rows), "k", "v", "r").toPandas().set_index("id").r.sort_index()
    want = rows.groupby("k").v.rank(method="min", ascending=False).astype(int)
    assert got.tolist() == want.tolist()


def test_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None, 1, 10), (None, 2, 20), (1, 1, 5), (None, 3, 30)], "k int, o int, v int")
    got = {(r.k, r.o): r.p for r in frames.neighbour(df, ["k"], ["o"], F.col("v"), "p", buckets=2).collect()}
    assert got == {(None, 1): None, (None, 2): 10, (None, 3): 20, (1, 1): None}
    ranks = {(r.k, r.o): r.r for r in frames.rank_in_groups(df, "k", "v", "r", buckets=2).collect()}
    assert ranks == {(None, 3): 1, (None, 2): 2, (None, 1): 3, (1, 1): 1}


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("chunks", [2, 8, 64])
def test_neighbour_equals_shift(spark, rows, forward, chunks):
    got = frames.neighbour(spark.createDataFrame(rows), ["k"], ["o", "id"], F.col("v"), "p", forward, chunks).toPandas()
    ordered = rows.sort_values(["k", "o", "id"])
    want = ordered.groupby("k").v.shift(-1 if forward else 1).reindex(rows.index)
    pd.testing.assert_series_equal(got.set_index("id").p.sort_index().astype(float), want, check_names=False)


def test_neighbour_keeps_null_values_apart_from_missing(spark):
    df = spark.createDataFrame([(1, 1, 10), (1, 2, None), (1, 3, 30)], "k int, o int, v int")
    got = {r.o: r.p for r in frames.neighbour(df, ["k"], ["o"], F.col("v"), "p", buckets=2).collect()}
    assert got == {1: None, 2: 10, 3: None}


def test_carry_forward(spark, rows):
    holes = rows.assign(v=[float(x) if i % 4 == 0 else None for i, x in enumerate(rows.v)])
    df = spark.createDataFrame(holes).withColumn("v", F.when(F.isnan("v"), None).otherwise(F.col("v")))
    got = frames.ordered_pass(df, ["k"], ["o", "id"], fill=["v"], buckets=8).toPandas()
    want = holes.sort_values(["k", "o", "id"]).groupby("k").v.ffill().reindex(rows.index)
    pd.testing.assert_series_equal(got.set_index("id").v.sort_index(), want, check_names=False)


def test_dense_positions_on_text(spark):
    df = spark.createDataFrame([(f"k{i:04d}"[::-1],) for i in range(500)], "b string")
    got = frames.dense_positions(df, "b", "n", F.lit(100), buckets=8).toPandas().sort_values("b").n.tolist()
    assert got == list(range(101, 601))


def test_quantile_scores(spark, rows):
    got = frames.quantile_scores(spark.createDataFrame(rows), [("v", "s", True)]).toPandas().set_index("id").s.sort_index()
    want = (rows.v.rank(method="min").astype(int) - 1) * 5 // len(rows) + 1
    assert got.tolist() == want.tolist()


def test_sessions_equal_gap_scan(spark, rows):
    from datetime import datetime, timedelta
    from tidemark.streaming.windows import sessions
    t0 = datetime(2024, 1, 1)
    log = pd.DataFrame({"user_id": rows.k, "ts": [t0 + timedelta(seconds=int(o) * 61 + i % 7) for i, o in enumerate(rows.o)]})
    got = sessions(spark.createDataFrame(log), datetime(2024, 1, 3), gap_minutes=5).toPandas()
    ordered = log.sort_values(["user_id", "ts"])
    new = ordered.groupby("user_id").ts.diff().isna() | (ordered.groupby("user_id").ts.diff() >= pd.Timedelta(minutes=5))
    want = ordered.assign(s=new.cumsum()).groupby("s").agg(u=("user_id", "first"), a=("ts", "min"), z=("ts", "max"), n=("ts", "size"))
    assert sorted(zip(got.user_id, got.SessionStart, got.LastEvent, got.Events)) == sorted(zip(want.u, want.a, want.z, want.n))


def test_distinct_per_group_with_null_group(spark):
    df = spark.createDataFrame([(None, 1, 1), (None, 1, 2), ("a", 2, None)], "g string, x int, y int")
    got = {r.g: (r.nx, r.ny) for r in distinct_per_group(df, "g", {"x": "nx", "y": "ny"}).collect()}
    assert got == {None: (1, 2), "a": (1, 0)}


def test_bunched_and_tied_rows_of_a_hot_key_are_split(spark):
    """Half of a key's rows inside one hour, many at one instant: no stretch holds more than a few times its share."""
    from tidemark.functions import frames
    n, buckets = 40_000, 64
    rows = spark.range(n).select(
        F.lit(1).alias("user"), F.when(F.col("id") % 2 == 0, F.lit(7_000_000) + F.col("id") % 3).otherwise(F.col("id") * 1000).alias("t"), "id")
    out = frames.neighbour(rows, ["user"], ["t", "id"], F.col("id"), "prev", buckets=buckets)
    want = rows.withColumn("prev", F.lag("id").over(Window.partitionBy("user").orderBy("t", "id")))
    assert out.select("id", "prev").exceptAll(want.select("id", "prev")).count() == 0 and out.count() == n
    parts = frames._stretches(rows.select(F.struct("user").alias("_key"), "t", "id"), ["t", "id"], buckets).groupBy("_chunk").count()
    assert parts.count() > buckets // 2 and parts.agg(F.max("count")).first()[0] < 8 * n // buckets
