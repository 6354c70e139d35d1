"""Each change of a stream once, in bounded state, and none lost for coming late.

Spark's state store keeps the identities seen within the watermark and drops rows behind it without a trace. Here the stream meets
its own deduplicated form in every micro-batch: rows behind the newest change of all earlier batches by more than the
allowed delay, and not among the batch's kept ones, go to a side output. That holds every row the state dropped as late, and copies
of kept rows, which readers tell apart by identity. So what is kept and what came late make up the whole feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.streaming.cdc import BatchFolders, run_name

IDENTITY = ["table_name", "key", "seq"]


class DedupedFeed:
    """The kept rows, the late ones and the newest change per batch, below one folder."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, delay: str = "1 hour", ts: str = "ts"):
        self.delay, self.ts = delay, ts
        self.kept_rows, self.suspects = (BatchFolders(spark, f"{root}/{part}", schema) for part in ("kept", "late"))
        self.newest = BatchFolders(spark, f"{root}/newest", T.StructType([
            T.StructField("run", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("newest", T.TimestampType())]))

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        dated = stream.withWatermark(self.ts, self.delay)
        # a row without a time has no place in the watermark: it goes the way of late ones
        once = dated.where(F.col(self.ts).isNotNull()).dropDuplicatesWithinWatermark(IDENTITY).withColumn("_kept", F.lit(True))
        both = once.unionByName(dated.withColumn("_kept", F.lit(False)))

        def each(batch: DataFrame, batch_id: int) -> None:
            self._write(batch.persist(), run_name(batch.sparkSession, checkpoint), batch_id)
            batch.unpersist()

        return both.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()

    def _write(self, batch: DataFrame, run: str, batch_id: int) -> None:
        kept, rows = (batch.where(F.col("_kept") == flag).drop("_kept") for flag in (True, False))
        mark = self.newest.read().where((F.col("run") != run) | (F.col("batch") < batch_id)).agg(F.max("newest")).first()[0]
        behind = F.col(self.ts).isNull()
        if mark is not None:
            behind = behind | (F.col(self.ts) <= F.lit(mark) - F.expr(f"INTERVAL {self.delay}"))
        self.kept_rows.write(kept, run, batch_id)
        self.suspects.write(_without(rows.where(behind).dropDuplicates(IDENTITY), kept), run, batch_id)
        self.newest.write(rows.agg(F.max(self.ts).alias("newest")).select(F.lit(run).alias("run"), F.lit(batch_id).cast("bigint").alias("batch"), "newest"), run, batch_id)

    def kept(self) -> DataFrame:
        return self.kept_rows.read()

    def late(self) -> DataFrame:
        """Changes that only the side output holds, each once."""
        return _without(self.suspects.read().dropDuplicates(IDENTITY), self.kept())

    def whole(self) -> DataFrame:
        """Every change of the feed once."""
        return self.kept().unionByName(self.suspects.read()).dropDuplicates(IDENTITY)


def _without(rows: DataFrame, others: DataFrame) -> DataFrame:
    """``rows`` whose identity is not among ``others``; missing parts of an identity compare equal."""
    side = others.select(*[F.col(c).alias(f"_{c}") for c in IDENTITY])
    same = F.lit(True)
    for c in IDENTITY:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.join(side, same, "left_anti")
