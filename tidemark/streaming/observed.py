"""Row counts observed while rows are written: no second scan.

A batch write observes the rows of each of its statements; a stream observes each micro-batch and a listener keeps what
it sees. Counts are stored beside what they count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark.operators.changes import purge
from tidemark.sources.tables import Tables

COUNTS = "TableName string, RowsBefore long, RowsAfter long, RowsRemoved long"


def purge_counted(spark: SparkSession, tables: Tables, predicates: dict[str, Column], links: list[tuple[str, str, str]], root: str) -> DataFrame:
    """Write the tables a purge leaves below ``root``, and beside them, in ``_counts``, the rows each lost, as observed by its write.

    Returns the counts. A table that keeps all its rows is written and counted too."""
    seen: dict[str, tuple[Observation, Observation]] = {}
    watched = {}
    for name, df in tables.items():
        seen[name] = Observation(f"{name}-before"), Observation(f"{name}-after")
        watched[name] = df.observe(seen[name][0], F.count(F.lit(1)).alias("n"))
    # the doomed keys come from the unwatched tables, so that a watched one is read by its own write alone
    kept = purge(tables, predicates, links, rows=watched)
    for name, df in kept.items():
        df.observe(seen[name][1], F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{root}/{name}")
    rows = []
    for name, (before, after) in seen.items():
        a, b = before.get["n"], after.get["n"]
        rows.append((name, a, b, a - b))
    counts = spark.createDataFrame(rows, COUNTS)
    counts.coalesce(1).write.mode("overwrite").parquet(f"{root}/_counts")
    return spark.read.schema(COUNTS).parquet(f"{root}/_counts")


class BatchCounts(StreamingQueryListener):
    """What the micro-batches of one named stream observed, in order."""

    def __init__(self, name: str):
        self.name, self.batches, self.ended = name, {}, set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None and event.progress.numInputRows:
            self.batches[event.progress.batchId] = seen.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))


def watched(stream: DataFrame, name: str, counts: dict[str, Column]) -> DataFrame:
    """A stream whose every micro-batch counts the rows that meet each condition."""
    return stream.observe(name, *[F.count_if(cond).alias(label) for label, cond in counts.items()])


def drain(query: StreamingQuery, listener: BatchCounts, seconds: float = 60.0) -> dict[int, dict]:
    """Wait for the stream's end and for its last event to arrive."""
    import time

    query.awaitTermination()
    limit = time.monotonic() + seconds
    while query.id not in listener.ended and time.monotonic() < limit:
        time.sleep(0.05)
    return listener.batches
