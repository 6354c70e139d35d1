"""The change fold against a sequential replay, under any batch split, arrival order and redelivery."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import changes
from tidemark.streaming.cdc import BatchFolders, ChangeStore, append_batches, start_cdc

SCHEMA = ("table_name string, key long, seq long, ts timestamp, op string, actor string, a double, b string,"
          " mask array<string>")
COLS = ["a", "b"]
T0 = datetime(2024, 1, 1)


def replay(rows):
    """Plain one-at-a-time application in sequence order."""
    state = {}
    for r in sorted(rows, key=lambda r: r[2]):
        table, key, seq, ts, op, actor, a, b, mask = r
        cur = state.setdefault((table, key), {"a": None, "b": None, "gone": False, "dts": None, "dby": None})
        if "a" in mask:
            cur["a"] = a
        if "b" in mask:
            cur["b"] = b
        if op == "D":
            cur.update(gone=True, dts=ts, dby=actor)
        if op == "R":
            cur.update(gone=False)
        cur.update(mod=ts, seq=seq)
    return {k: (v["a"], v["b"], v["gone"], v["dts"] if v["gone"] else None, v["dby"] if v["gone"] else None, v["mod"], v["seq"])
            for k, v in state.items()}


def seen(df):
    return {(r.table_name, r.key): (r.a, r.b, r.IsDeleted, r.DeletedDate, r.DeletedBy, r.ModifiedDate, r.LastSeq)
            for r in df.collect()}


def make(ops):
    return [(t, k, i, T0 + timedelta(minutes=i), op, f"u{i % 3}", a if "a" in mask else None, b if "b" in mask else None, mask)
            for i, (t, k, op, a, b, mask) in enumerate(ops)]


OPS = st.lists(st.tuples(
    st.sampled_from(["Customer", "Product"]), st.integers(0, 3), st.sampled_from("IUUUDR"),
    st.one_of(st.none(), st.integers(0, 9).map(float)), st.one_of(st.none(), st.sampled_from(["x", "y"])),
    st.lists(st.sampled_from(COLS), unique=True)), min_size=1, max_size=25)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(ops=OPS, seed=st.integers(0, 99))
def test_fold_equals_replay_in_any_split_and_order(spark, ops, seed):
    rows = make(ops)
    want = replay(rows)
    frame = lambda part: spark.createDataFrame(part, SCHEMA)
    assert seen(changes.current_rows(changes.fold_changes(frame(rows), COLS, mask="mask"), COLS)) == want
    shuffled = rows + rows[: len(rows) // 2]  # some delivered twice
    random.Random(seed).shuffle(shuffled)
    cut = seed % len(shuffled)
    state = changes.fold_changes(frame(shuffled[:cut]), COLS, mask="mask")
    state = changes.apply_changes(state, frame(shuffled[cut:]), COLS, mask="mask")
    assert seen(changes.current_rows(state, COLS)) == want


ROWS = make([("Customer", i % 5, "IUDRU"[i % 5] if i > 4 else "I", float(i), str(i), COLS[: i % 3]) for i in range(60)])


def new_store(spark, path):
    return ChangeStore(spark, path, spark.createDataFrame([], SCHEMA).schema, COLS, mask="mask")


def test_store_applies_batches_in_any_arrival_and_repetition(spark, fresh):
    store = new_store(spark, f"{fresh}/state")
    parts = [ROWS[40:], ROWS[:20], ROWS[20:40]]  # later changes arrive first
    for i, part in enumerate([*parts, parts[1]]):
        store.apply(spark.createDataFrame(part, SCHEMA), i)
    store.apply(spark.createDataFrame(parts[0], SCHEMA), 0)  # delivered again
    assert seen(store.current()) == replay(ROWS)


def test_store_survives_a_failed_batch(spark, fresh):
    store = new_store(spark, f"{fresh}/state")
    store.apply(spark.createDataFrame(ROWS[:30], SCHEMA), 0)
    before = seen(store.current())
    # a write that broke off: files of a task attempt, never committed
    store.deltas().limit(1).write.parquet(f"{fresh}/state/run=direct/batch=1/_temporary/0/task")
    assert seen(store.current()) == before
    store.apply(spark.createDataFrame(ROWS[30:], SCHEMA), 1)
    assert seen(store.current()) == replay(ROWS)


def test_batches_write_in_proportion_to_themselves(spark, fresh):
    store = new_store(spark, f"{fresh}/state")
    store.apply(spark.createDataFrame(ROWS, SCHEMA), 0)
    store.apply(spark.createDataFrame(make([("Customer", 1, "D", None, None, [])]), SCHEMA), 1)
    assert spark.read.parquet(f"{fresh}/state/run=direct/batch=1").count() == 1


def test_snapshot_then_changes_equals_one_fold(spark, fresh):
    store = new_store(spark, f"{fresh}/state")
    old = changes.current_rows(changes.fold_changes(spark.createDataFrame(ROWS[:30], SCHEMA), COLS, mask="mask"), COLS)
    store.seed(old, T0, "IsDeleted")
    assert {k: v[:3] for k, v in seen(store.current()).items()} == {k: v[:3] for k, v in replay(ROWS[:30]).items()}
    store.apply(spark.createDataFrame(ROWS[30:], SCHEMA), 0)
    whole = {k: v[:3] for k, v in replay(ROWS).items()}
    assert {k: v[:3] for k, v in seen(store.current()).items()} == whole
    assert store.compact() == 2
    assert store.deltas().count() == len(whole) and {k: v[:3] for k, v in seen(store.current()).items()} == whole


def feed_files(spark, fresh, n, folder=False):
    """The change feed cut into interleaved files, as files or as one folder of part files."""
    import os

    from conftest import DATA
    from tidemark.sources.tables import read_raw
    events = read_raw(spark, DATA, "events").toPandas().sample(frac=1.0, random_state=7)
    home = f"{fresh}/feed/events.parquet" if folder else f"{fresh}/feed"
    os.makedirs(home)
    for i in range(n):
        spark.createDataFrame(events.iloc[i::n]).coalesce(1).write.mode("overwrite").parquet(f"{fresh}/part{i}")
        name = next(f for f in os.listdir(f"{fresh}/part{i}") if f.endswith(".parquet"))
        os.link(f"{fresh}/part{i}/{name}", f"{home}/{'part' if folder else 'events'}-{i}.parquet")
    return f"{fresh}/feed"


@pytest.mark.parametrize("folder", [False, True])
def test_streams_count_every_row(spark, fresh, folder):
    """Counts, late changes, sessions and deduplication of eight interleaved files equal those of the whole table."""
    from conftest import DATA
    from pyspark.sql import functions as F
    from tidemark.config import EVENTS_AS_OF
    from tidemark.plans.mirror_queries import arrivals
    from tidemark.sources.tables import load_changes, read_raw, stream_changes, stream_events
    from tidemark.streaming import windows
    feed, log, events = feed_files(spark, fresh, 8, folder), load_changes(spark, DATA), read_raw(spark, DATA, "events")

    def drain(stream, part, name):
        folders = BatchFolders(spark, f"{fresh}/{name}", part(stream).schema)
        query = append_batches(stream, folders, f"{fresh}/{name}-cp", part)
        query.awaitTermination()
        assert len([p for p in query.recentProgress if p.numInputRows]) == 4
        return folders.read()

    def same(a, b):
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))

    same(windows.count_whole(drain(stream_changes(spark, feed, 2), windows.count_part, "counts")), windows.change_counts(log))
    same(windows.late_whole(drain(arrivals(stream_changes(spark, feed, 2)), windows.late_part, "late")), windows.late_changes(arrivals(log)))
    slots = drain(stream_events(spark, feed, 2), windows.session_part, "slots")
    same(windows.session_whole(slots, EVENTS_AS_OF), windows.sessions(events, EVENTS_AS_OF))
    once = changes.dedupe_feed(drain(stream_changes(spark, feed, 2).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))), lambda x: x.drop("copy"), "once"))
    same(once, log)


def test_within_watermark_dedupe_on_a_stream(spark, fresh):
    from conftest import DATA
    from tidemark.sources.tables import load_changes, stream_changes
    stream = changes.dedupe_feed(stream_changes(spark, feed_files(spark, fresh, 2), 2), "40 days")
    (stream.writeStream.outputMode("append").format("parquet").option("path", f"{fresh}/once").option("checkpointLocation", f"{fresh}/cp")
     .trigger(availableNow=True).start().awaitTermination())
    got = spark.read.schema(stream.schema).parquet(f"{fresh}/once")
    assert sorted(map(str, got.collect())) == sorted(map(str, load_changes(spark, DATA).collect()))


def test_empty_batch(spark, fresh):
    store = new_store(spark, f"{fresh}/state")
    assert store.current().count() == 0
    store.apply(spark.createDataFrame([], SCHEMA), 0)
    assert store.current().count() == 0


def test_stream_of_shuffled_files_equals_fold(spark, fresh):
    """Six files in a random arrival order, one per micro-batch; then a new checkpoint, whose batches count from 0 again."""
    from conftest import DATA
    from tidemark.plans.mirror_queries import PAYLOAD
    from tidemark.sources.tables import load_changes, stream_changes
    feed = stream_changes(spark, feed_files(spark, fresh, 6), 1)
    store = ChangeStore(spark, f"{fresh}/state", feed.schema, PAYLOAD)
    query = start_cdc(feed, store, f"{fresh}/checkpoint")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) == 6
    want = sorted(map(str, changes.current_rows(changes.fold_changes(load_changes(spark, DATA), PAYLOAD), PAYLOAD).collect()))
    assert sorted(map(str, store.current().collect())) == want
    # the same feed started again finds nothing to do
    start_cdc(feed, store, f"{fresh}/checkpoint").awaitTermination()
    assert sorted(map(str, store.current().collect())) == want
    # a first half under one checkpoint and the rest under another end up in one state
    other = ChangeStore(spark, f"{fresh}/other", feed.schema, PAYLOAD)
    for name, half in (("a", "seq % 2 = 0"), ("b", "seq % 2 = 1")):
        start_cdc(feed.filter(half), other, f"{fresh}/checkpoint-{name}").awaitTermination()
    assert sorted(map(str, other.current().collect())) == want


def test_history_versions(spark):
    df = changes.history(spark.createDataFrame(ROWS, SCHEMA), COLS, buckets=4)
    rows = sorted(df.filter("key = 1").collect(), key=lambda r: r.seq)
    assert [r.valid_to for r in rows[:-1]] == [r.valid_from for r in rows[1:]] and rows[-1].is_current
    last = replay(ROWS)[("Customer", 1)]
    kept = [r for r in ROWS if r[1] == 1 and r[6] is not None]
    assert rows[-1].a == (kept[-1][6] if kept else None) and rows[-1].seq == last[6]


@pytest.mark.parametrize("stamp", [True, False])
def test_delete_twice_then_restore(spark, demo, stamp):
    day = [datetime(2025, 7, d) for d in (1, 2, 3, 4)]
    keys = demo["Customer"].filter("CustomerID = 2").select("CustomerID")
    once = changes.soft_delete(demo["Customer"], keys, "CustomerID", day[0], "a")
    twice = changes.soft_delete(once, keys, "CustomerID", day[1], "b")
    row = twice.filter("CustomerID = 2").first()
    assert (row.IsDeleted, row.DeletedDate, row.DeletedBy, row.ModifiedDate) == (True, day[1], "b", day[1])
    assert twice.filter("IsDeleted").count() == 1
    changed = changes.update_where(twice, twice.CustomerID == 2, {"Phone": twice.LastName}, day[2])
    row = changed.filter("CustomerID = 2").first()
    assert (row.IsDeleted, row.DeletedDate, row.Phone) == (True, day[1], "Eck")  # an update leaves the flag alone
    back = changes.undelete(changed, keys, "CustomerID", day[3], stamp).filter("CustomerID = 2").first()
    assert (back.IsDeleted, back.DeletedDate, back.DeletedBy) == (False, None, None)
    assert back.ModifiedDate == (day[3] if stamp else day[2])
    none = changes.soft_delete(demo["Customer"], keys.limit(0), "CustomerID", day[0], "a")
    assert none.filter("IsDeleted").count() == 0
