"""Continuous application of a change stream: each micro-batch appends its folded changes, readers fold what is there.

Layout below ``state_dir``::

    run=<run>/batch=<batch>/…    state-shaped rows, one per key the batch touched

A batch writes only its own folder, in as many tasks as it has data for, and overwrites it when it comes again. The fold is
associative, commutative and idempotent, so the order of batches, their repetition and the number of feeds do not matter, and the state is
the fold of all folders. ``run`` names a checkpoint: a renewed checkpoint counts its batches from 0 again, but in
folders of its own. Snapshots enter as rows older than any change, a folder per table. Compaction folds the folders that are
complete into one and then removes just those, while feeds go on writing theirs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.columns import at
from tidemark.operators.changes import KEY, current_rows, fold_changes, merge_deltas, outlive_purge
from tidemark.sources.tables import merged_schema

#: Sequence number of snapshot rows that do not say theirs: below that of every change.
SNAPSHOT_SEQ = -(1 << 62)


class BatchFolders:
    """Rows appended batch by batch, a folder each. Reading shows every batch that was written in full."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def write(self, rows: DataFrame, run: str, batch_id: int, partition_by: list[str] | None = None) -> None:
        writer = rows.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.root}/run={run}/batch={batch_id}")

    def read(self) -> DataFrame:
        """Columns of the declared schema; a file from before a column was added gives nulls for it."""
        try:
            # a folder whose write broke off holds only temporary files, which readers skip
            return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.root)
        except AnalysisException as err:
            if "PATH_NOT_FOUND" not in str(err):
                raise
            return self.spark.createDataFrame([], self.schema)

    def _glob(self, pattern: str) -> list[str]:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}")
        return [s.getPath().toString() for s in path.getFileSystem(conf).globStatus(path) or []]

    def complete(self) -> list[str]:
        """Folders of the batches written in full."""
        return [marker.rsplit("/", 1)[0] for marker in self._glob("run=*/batch=*/_SUCCESS")]

    def read_only(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(*folders)

    def remove(self, folders: list[str]) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """The stream's id, which a checkpoint gets when it is first used and keeps for its life."""
    line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return line.split('"id":"')[1].split('"')[0]


def append_batches(stream: DataFrame, folders: BatchFolders, checkpoint: str, reduce: Callable[[DataFrame], DataFrame],
                   trigger: dict | None = None) -> StreamingQuery:
    """Reduce every micro-batch and append it; by default everything available now, in as many batches as the source cuts."""
    def each(batch: DataFrame, batch_id: int) -> None:
        folders.write(reduce(batch), run_name(batch.sparkSession, checkpoint), batch_id)

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


class ChangeStore:
    """Folded state of any number of feeds, optionally on top of snapshots."""

    def __init__(self, spark: SparkSession, state_dir: str, changes_schema: T.StructType, columns: list[str],
                 key: list[str] = KEY, mask: str | None = None):
        self.spark, self.columns, self.key, self.mask, self.changes_schema = spark, columns, key, mask, changes_schema
        empty = spark.createDataFrame([], changes_schema)
        self.folders = BatchFolders(spark, state_dir, fold_changes(empty, columns, key, mask).schema)

    def evolved(self) -> ChangeStore:
        """This store with every payload column that some batch holds, also those added by other feeds since."""
        schema = merged_schema(self.spark, self.folders.root)
        names = [f.name for f in schema if f"{f.name}__seq" in schema.names]
        added = [c for c in names if c not in self.columns]
        wider = T.StructType([*self.changes_schema.fields, *[schema[c] for c in added if c not in self.changes_schema.names]])
        return ChangeStore(self.spark, self.folders.root, wider, [*self.columns, *added], self.key, self.mask)

    def deltas(self) -> DataFrame:
        return self.folders.read()

    def state(self) -> DataFrame:
        return merge_deltas(self.deltas(), self.columns, self.key)

    def current(self) -> DataFrame:
        return current_rows(self.state(), self.columns, self.key)

    def reduce(self, batch: DataFrame) -> DataFrame:
        return fold_changes(batch, self.columns, self.key, self.mask)

    def apply(self, batch: DataFrame, batch_id: int, run: str = "direct") -> None:
        self.folders.write(self.reduce(batch), run, batch_id)

    def seed(self, snapshot: DataFrame, as_of: datetime, deleted: str | None = None, name: str = "all", seq: str | None = None) -> None:
        """Rows of a full copy (keys and columns) as the oldest state, in a folder of that ``name``: give every copied table its own.

        ``deleted`` names a flag that may mark some as deleted. Audit columns that the copy has (DeletedDate, DeletedBy,
        ModifiedDate) are kept; ``as_of`` stands where they are absent or null. ``seq`` names the sequence number of the last change
        a row holds, if the copy says so."""
        has = set(snapshot.columns)
        gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
        number = F.col(seq) if seq else F.lit(SNAPSHOT_SEQ)

        def stamp(column: str):
            return F.coalesce(F.col(column), at(as_of)) if column in has else at(as_of)

        rows = snapshot.select(
            *self.key, *self.columns, *[F.when(F.col(c).isNotNull(), number).alias(f"{c}__seq") for c in self.columns],
            F.when(gone, number).alias("delete_seq"), F.lit(None).cast("bigint").alias("restore_seq"), F.when(gone, stamp("DeletedDate")).alias("delete_ts"),
            F.when(gone, F.col("DeletedBy") if "DeletedBy" in has else F.lit(None)).cast("string").alias("delete_actor"),
            F.lit(None).cast("bigint").alias("purge_seq"), number.alias("last_seq"), stamp("ModifiedDate").alias("last_ts"))
        self.folders.write(merge_deltas(rows, self.columns, self.key), f"snapshot-{name}", 0)

    def compact(self, horizon: int | None = None) -> int:
        """Fold the folders that are complete now into one and remove them; returns how many there were.

        Batches that arrive meanwhile stay as they are. Between the write and the removal readers see both, which the
        fold does not mind. ``horizon`` is a sequence number below which no change can come any more: tombstones up to it go."""
        folders = self.folders.complete()
        if folders:
            state = outlive_purge(merge_deltas(self.folders.read_only(folders), self.columns, self.key), self.columns, horizon)
            self.folders.write(state, f"compacted-{uuid.uuid4().hex}", 0)
            self.folders.remove(folders)
        return len(folders)


def start_cdc(changes: DataFrame, store: ChangeStore, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return append_batches(changes, store.folders, checkpoint, store.reduce, trigger)
