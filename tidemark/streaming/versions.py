"""Version history kept up to date batch by batch: only the end of a key's history that a batch can change is written again.

A change ends the version before it and hands its values on to the versions after it, until they are set anew. So a batch affects,
per key, the last stored version before its earliest change and all that follow; in order of arrival that is one
version. These are computed again from the values they set and the values in force before them, and appended as a folder with a
higher number; of a version stored several times the highest counts. Changes delivered again are known by their sequence number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import materialize
from tidemark.functions.frames import ordered_pass
from tidemark.operators.changes import KEY
from tidemark.streaming.cdc import BatchFolders

#: Parts of the keys, by hash: a batch reads the parts its keys lie in.
PARTS = 16


class HistoryStore:
    """One writer applies batches numbered in rising order; a batch applied again replaces what it wrote."""

    def __init__(self, spark: SparkSession, root: str, changes_schema: T.StructType, columns: list[str], key: list[str] = KEY, buckets: int | None = None):
        self.spark, self.columns, self.key, self.buckets = spark, columns, key, buckets
        kinds = {f.name: f.dataType for f in changes_schema}
        self.schema = T.StructType([
            *[T.StructField(c, kinds[c]) for c in (*key, "seq", "op")], *[T.StructField(c, kinds[c]) for c in columns],
            *[T.StructField(f"set_{c}", kinds[c]) for c in columns], T.StructField("valid_from", kinds["ts"]), T.StructField("valid_to", kinds["ts"]),
            T.StructField("is_last", T.BooleanType()), T.StructField("version", T.LongType())])
        self.folders = BatchFolders(spark, root, T.StructType([*self.schema.fields, T.StructField("part", T.IntegerType())]))

    def _stored(self, before: int | None = None, parts: list[int] | None = None) -> DataFrame:
        """Every version as last written, by batches numbered below ``before``, of some parts."""
        try:
            rows = self.spark.read.schema(self.folders.schema).option("basePath", self.folders.root).parquet(f"{self.folders.root}/run=history/batch=*")
        except Exception as err:
            if "PATH_NOT_FOUND" not in str(err):
                raise
            rows = self.spark.createDataFrame([], self.folders.schema)
        if before is not None:
            rows = rows.where(F.col("version") < before)
        if parts is not None:
            rows = rows.where(F.col("part").isin(parts))
        newest = Window.partitionBy(*self.key, "seq").orderBy(F.desc("version"))
        return rows.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").select(*self.schema.names)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        part = F.pmod(F.xxhash64(*self.key), F.lit(PARTS)).cast("int")
        changes = batch.select(*self.key, "seq", "ts", "op", *self.columns).dropDuplicates([*self.key, "seq"])
        touched = [r[0] for r in changes.select(part.alias("p")).distinct().collect()]  # at most PARTS
        packed = F.struct(*self.key).alias("_key")  # missing parts of a key compare equal
        stored = self._stored(batch_id, touched).select(packed, "*")
        known = stored.select("_key", "seq").withColumn("_known", F.lit(True))
        fresh = materialize(changes.select(packed, "*").join(known, ["_key", "seq"], "left").where("_known is null").drop("_known"), "fresh")
        first = fresh.groupBy("_key").agg(F.min("seq").alias("_first"))
        reach = stored.join(first, "_key")
        cut = reach.where(F.col("seq") < F.col("_first")).groupBy("_key").agg(F.max("seq").alias("_cut"))
        tail = reach.join(cut, "_key", "left").where(F.col("_cut").isNull() | (F.col("seq") >= F.col("_cut")))
        carried = F.col("seq") == F.col("_cut")
        old = tail.select(*self.key, "seq", F.col("valid_from").alias("ts"), "op", *[F.when(carried, F.col(c)).otherwise(F.col(f"set_{c}")).alias(c) for c in self.columns],
                          *[f"set_{c}" for c in self.columns])
        new = fresh.select(*self.key, "seq", "ts", "op", *self.columns, *[F.col(c).alias(f"set_{c}") for c in self.columns])
        versions = ordered_pass(materialize(old.unionByName(new), "affected"), self.key, ["seq"], fill=self.columns,
                                lead={"_next": F.struct(F.col("ts").alias("at"))}, buckets=self.buckets)
        rows = versions.select(*self.key, "seq", "op", *self.columns, *[f"set_{c}" for c in self.columns], F.col("ts").alias("valid_from"),
                               F.col("_next")["at"].alias("valid_to"), F.col("_next").isNull().alias("is_last"),
                               F.lit(batch_id).cast("bigint").alias("version"), part.alias("part"))
        # balanced by size: a part with a hot key is split, small ones share a file
        self.folders.write(rows.hint("rebalance", "part"), "history", batch_id, ["part"])

    def history(self) -> DataFrame:
        """As ``changes.history`` over all changes applied."""
        return self._stored().select(*self.key, "seq", "op", *self.columns, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"))
