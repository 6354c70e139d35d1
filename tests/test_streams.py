"""Streams in state, purges through the feed, history by batches, stores that evolve and compact, observed counts."""

import os
import random
from datetime import datetime, timedelta

import pytest
from conftest import DATA
from pyspark.sql import functions as F
from test_fold import COLS, ROWS, SCHEMA, T0, feed_files, make, new_store, seen

from tidemark.operators import changes
from tidemark.sources.tables import load_changes, read_evolving
from tidemark.streaming import observed
from tidemark.streaming.cdc import ChangeStore, start_cdc
from tidemark.streaming.dedupe import DedupedFeed
from tidemark.streaming.versions import HistoryStore


def rows_of(df, *columns):
    return sorted(str(tuple(r)) for r in df.select(*(columns or df.columns)).collect())


# ---- deduplication in state

def test_kept_and_late_rows_make_up_the_feed(spark, fresh):
    """Eight interleaved files, one per batch, stopped after three and started again; every change is delivered twice."""
    home = feed_files(spark, fresh, 8)
    log = load_changes(spark, DATA)
    once = spark.read.schema(load_schema()).parquet(f"{home}/events*.parquet")
    assert once.count() == log.count()
    from tidemark.sources.tables import stream_changes
    feed = DedupedFeed(spark, f"{fresh}/deduped", log.schema, "6 hours")

    def twice(stream):
        return stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")

    names = sorted(os.listdir(home))
    for name in names[3:]:
        os.rename(f"{home}/{name}", f"{fresh}/{name}")
    feed.start(twice(stream_changes(spark, home, 1)), f"{fresh}/cp").awaitTermination()
    first = feed.whole().count()
    for name in names[3:]:
        os.rename(f"{fresh}/{name}", f"{home}/{name}")
    feed.start(twice(stream_changes(spark, home, 1)), f"{fresh}/cp").awaitTermination()
    assert 0 < first < log.count()
    assert rows_of(feed.whole(), *log.columns) == rows_of(log)
    late, kept = feed.late(), feed.kept()
    assert late.count() > 0 and kept.count() + late.count() == log.count()
    assert kept.dropDuplicates(["table_name", "key", "seq"]).count() == kept.count()
    # the state alone would have lost them
    assert rows_of(kept, *log.columns) != rows_of(log)


def load_schema():
    from tidemark.sources import schemas
    return schemas.EVENTS_IN


def test_rows_without_time_or_key_are_not_lost(spark, fresh):
    schema = "table_name string, key long, seq long, ts timestamp, op string"
    rows = [("A", None, 1, T0, "U"), ("A", None, 1, T0, "U"), ("A", 2, 2, None, "U"), (None, 3, 3, T0 + timedelta(days=2), "D"), ("A", 4, 4, T0, "U")]
    for i, part in enumerate((rows[:4], rows[4:], rows[:3])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{fresh}/in/{i}")
        feed = DedupedFeed(spark, f"{fresh}/out", spark.createDataFrame([], schema).schema)
        feed.start(spark.readStream.schema(schema).parquet(f"{fresh}/in/*"), f"{fresh}/cp").awaitTermination()
    assert rows_of(feed.whole()) == sorted({str(tuple(spark.createDataFrame([r], schema).first())) for r in rows})


# ---- purges

def purge_replay(rows):
    state = {}
    for table, key, seq, ts, op, actor, a, b, mask in sorted(rows, key=lambda r: r[2]):
        if op == "P":
            state.pop((table, key), None)
            continue
        cur = state.setdefault((table, key), {"a": None, "b": None, "gone": False, "dts": None, "dby": None})
        cur.update({c: v for c, v in (("a", a), ("b", b)) if c in mask})
        if op == "D":
            cur.update(gone=True, dts=ts, dby=actor)
        if op == "R":
            cur.update(gone=False)
        cur.update(mod=ts, seq=seq)
    return {k: (v["a"], v["b"], v["gone"], v["dts"] if v["gone"] else None, v["dby"] if v["gone"] else None, v["mod"], v["seq"]) for k, v in state.items()}


@pytest.mark.parametrize("seed", range(4))
def test_purge_beats_what_was_set_before_in_any_order(spark, fresh, seed):
    rng = random.Random(seed)
    rows = make([(rng.choice(["Customer", "Product"]), rng.randrange(3), rng.choice("IUUDRP"), float(rng.randrange(9)), rng.choice("xy"),
                  rng.sample(COLS, rng.randrange(3))) for _ in range(40)])
    want = purge_replay(rows)
    store, parts = new_store(spark, f"{fresh}/state"), [rows[i::3] for i in range(3)]
    rng.shuffle(parts)
    for i, part in enumerate([*parts, parts[0]]):
        store.apply(spark.createDataFrame(part, SCHEMA), i)
        if i == 1:
            assert store.compact() == 2
    assert seen(store.current()) == want
    store.compact()
    assert seen(store.current()) == want
    # tombstones stay until the horizon passes them
    tombs = lambda: store.deltas().where("purge_seq is not null").count()
    assert tombs() == len({(r[0], r[1]) for r in rows if r[4] == "P"})
    store.compact(horizon=100)
    assert tombs() == 0 and seen(store.current()) == want


# ---- snapshots and compaction

def test_snapshots_of_several_tables_keep_their_stamps(spark, fresh):
    store = new_store(spark, f"{fresh}/state")
    old = changes.current_rows(changes.fold_changes(spark.createDataFrame(ROWS, SCHEMA), COLS, mask="mask"), COLS)
    other = old.withColumn("table_name", F.lit("Product"))
    store.seed(old, T0, "IsDeleted", "Customer", "LastSeq")
    store.seed(other, T0, "IsDeleted", "Product")
    got = seen(store.current())
    want = seen(old)
    assert {k: v for k, v in got.items() if k[0] == "Customer"} == want
    assert {k[1]: v[:6] for k, v in got.items() if k[0] == "Product"} == {k[1]: v[:6] for k, v in want.items()}
    store.seed(old.select("table_name", "key", *COLS).withColumn("table_name", F.lit("Bare")), T0, name="Bare")
    bare = {k[1]: v for k, v in seen(store.current()).items() if k[0] == "Bare"}
    assert all(v[2:6] == (False, None, None, T0) for v in bare.values()) and len(bare) == len(want)


def test_compaction_while_a_feed_goes_on(spark, fresh):
    """Batches after the compaction, one delivered again, and one that was never finished."""
    store = new_store(spark, f"{fresh}/state")
    for i in range(3):
        store.apply(spark.createDataFrame(ROWS[i * 15:(i + 1) * 15], SCHEMA), i)
    store.deltas().limit(1).write.parquet(f"{fresh}/state/run=direct/batch=9/_temporary/0/task")
    assert store.compact() == 3
    assert os.path.exists(f"{fresh}/state/run=direct/batch=9") and not os.path.exists(f"{fresh}/state/run=direct/batch=0")
    store.apply(spark.createDataFrame(ROWS[45:], SCHEMA), 3)
    store.apply(spark.createDataFrame(ROWS[:15], SCHEMA), 0)
    from test_fold import replay
    assert seen(store.current()) == replay(ROWS)
    assert store.compact() == 3 and store.compact() == 1 and seen(store.current()) == replay(ROWS)
    assert new_store(spark, f"{fresh}/empty").compact() == 0


# ---- columns that come later

def test_a_column_added_by_a_later_batch(spark, fresh):
    narrow = spark.createDataFrame(ROWS, SCHEMA).drop("b")
    store = ChangeStore(spark, f"{fresh}/state", narrow.schema, ["a"], mask="mask")
    for i in range(3):
        store.apply(narrow.where(f"seq % 6 = {i}"), i)
    new_store(spark, f"{fresh}/state").apply(spark.createDataFrame(ROWS, SCHEMA).where("seq % 6 >= 3"), 3)
    wide = store.evolved()
    assert wide.columns == COLS and store.columns == ["a"]
    from test_fold import replay
    want = replay([(*r[:7], None, [c for c in r[8] if c == "a"]) if r[2] % 6 < 3 else r for r in ROWS])
    assert seen(wide.current()) == want
    assert {k: v[0] for k, v in ((r.key, (r.a,)) for r in store.current().collect())} == {k[1]: v[0] for k, v in want.items()}
    wide.compact()
    assert seen(wide.current()) == want


def test_a_column_with_two_types_is_named(spark, fresh):
    spark.range(3).selectExpr("id", "cast(id as string) as extra").write.parquet(f"{fresh}/t/a")
    spark.range(3).selectExpr("id", "array(id) as extra").write.parquet(f"{fresh}/t/b")
    with pytest.raises(ValueError, match="several types"):
        read_evolving(spark, f"{fresh}/t")


# ---- history by batches

def plain_history(spark, rows):
    df = changes.history(spark.createDataFrame(rows, SCHEMA).drop("mask"), COLS, buckets=4)
    return rows_of(df, "table_name", "key", "seq", "op", *COLS, "valid_from", "valid_to", "is_current")


@pytest.mark.parametrize("seed", range(3))
def test_history_by_batches_in_any_order(spark, fresh, seed):
    rng = random.Random(seed)
    rows = [r if r[1] != 4 else (r[0], None, *r[2:]) for r in ROWS]
    rng.shuffle(rows)
    log = spark.createDataFrame(rows, SCHEMA).drop("mask")
    store, cuts = HistoryStore(spark, f"{fresh}/h", log.schema, COLS, buckets=4), sorted(rng.sample(range(60), 3))
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 60])]
    done = []
    for i, part in enumerate([*parts, parts[1], []]):
        store.apply(spark.createDataFrame(part, SCHEMA), i)
        done += [r for r in part if r not in done]
        if i < 2:
            assert rows_of(store.history()) == plain_history(spark, done)
    assert rows_of(store.history()) == plain_history(spark, rows)


def test_a_batch_in_order_writes_little(spark, fresh):
    """One new change writes itself and the version it ends; a late one writes the versions from the one it splits on."""
    log = spark.createDataFrame(ROWS, SCHEMA).drop("mask")
    store = HistoryStore(spark, f"{fresh}/h", log.schema, COLS)
    late = log.where("seq = 30")
    store.apply(log.where("seq <> 30 and seq < 55"), 0)
    store.apply(log.where("seq = 57"), 1)
    wrote = lambda n: spark.read.parquet(f"{fresh}/h/run=history/batch={n}").count()
    assert wrote(1) == 2
    store.apply(late, 2)
    key = late.first().key
    assert wrote(2) == 1 + log.where((F.col("key") == key) & F.col("seq").between(25, 54) & (F.col("seq") != 30)).count()
    store.apply(late, 2)  # again
    assert rows_of(store.history()) == rows_of(changes.history(log.where("seq < 55 or seq = 57"), COLS))
    assert wrote(2) < 15


# ---- observed counts

def test_counts_of_a_purge_without_a_second_scan(spark, demo, fresh):
    rules = {"Customer": F.col("EmailAddress") == "", "Product": F.col("ProductID") == 99}
    links = [("SalesOrderDetail", "SalesOrderHeader", "SalesOrderID"), ("SalesOrderHeader", "Customer", "CustomerID")]
    counts = {r.TableName: (r.RowsBefore, r.RowsAfter, r.RowsRemoved) for r in observed.purge_counted(spark, demo, rules, links, f"{fresh}/kept").collect()}
    assert counts["Customer"] == (3, 2, 1) and counts["SalesOrderHeader"] == (3, 2, 1) and counts["SalesOrderDetail"] == (6, 5, 1)
    assert counts["Product"] == (5, 5, 0) and set(counts) == set(demo)
    assert spark.read.parquet(f"{fresh}/kept/Customer").count() == 2
    assert rows_of(spark.read.parquet(f"{fresh}/kept/_counts")) == sorted(str((n, *c)) for n, c in counts.items())


def test_every_batch_is_observed(spark, fresh):
    from tidemark.sources.tables import stream_changes
    feed = stream_changes(spark, feed_files(spark, fresh, 4), 1)
    listener = observed.BatchCounts("watch")
    spark.streams.addListener(listener)
    try:
        store = ChangeStore(spark, f"{fresh}/state", feed.schema, ["set_value"])
        batches = observed.drain(start_cdc(observed.watched(feed, "watch", {"n": F.lit(True), "d": F.col("op") == "D"}), store, f"{fresh}/cp"), listener)
    finally:
        spark.streams.removeListener(listener)
    log = load_changes(spark, DATA)
    assert len(batches) == 4 and sum(b["n"] for b in batches.values()) == log.count()
    assert sum(b["d"] for b in batches.values()) == log.where("op = 'D'").count()
    assert datetime.now() > T0
