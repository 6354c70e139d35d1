"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import materialize

__all__ = ["materialize", "docs_of", "small_batches", "bounded_batches", "crc_fold", "shuffle_width", "longs", "without_ids", "located", "on_shelf", "Memo", "Recalled", "lots", "byte_letters"]

#: Ids that are broadcast rather than shuffled against texts: at most so many, some 100 MB.
BROADCAST_IDS = 2_000_000


def docs_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on, so that no further column can clash; null texts become empty."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of few rows: texts can be long, and a batch is held in a Python worker as a whole."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def bounded_batches(spark: SparkSession, rows: int = 1000, size: str = "32m") -> None:
    """As ``small_batches``, and few bytes: rows of many megabytes come alone."""
    small_batches(spark, rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def located(path: str | Callable[[], str]) -> str:
    """A path, or what a function called in the worker says it is there."""
    return path() if callable(path) else path


def on_shelf(name: str, make: Callable):
    """What ``make`` gives, made once per worker process. Functions of this subpackage travel by value, and their globals with
    them, so what outlives a task is kept in a module of the worker's own."""
    import sys
    import types

    shelf = sys.modules.setdefault("_tidemark_worker_shelf", types.ModuleType("_tidemark_worker_shelf")).__dict__
    if name not in shelf:
        shelf[name] = make()
    return shelf[name]


class Memo:
    """Values of keys met lately, in two generations of ``room`` / 2 keys: when the younger is full the older is dropped, so
    keys in use stay and the rest is forgotten. The keys of one call may go beyond that."""

    def __init__(self, room: int):
        self.room, self.young, self.old = room, {}, {}

    def of(self, keys: set, learn: Callable[[list], Iterable]) -> dict:
        """A dict that holds every one of ``keys``; ``learn`` gives the values of a list of unknown ones."""
        missing = keys.difference(self.young)
        if missing and len(self.young) + len(missing) > self.room // 2:
            self.old, self.young, missing = self.young, {}, keys
        known = {k for k in missing if k in self.old}
        self.young.update((k, self.old[k]) for k in known)
        new = list(missing.difference(known))
        if new:
            self.young.update(zip(new, learn(new), strict=True))
        return self.young


class Recalled(dict):
    """As ``Memo``, key by key: what is not known is learned when it is looked up. ``turn``, called now and then, lets a generation go."""

    def __init__(self, room: int, learn: Callable):
        super().__init__()
        self.room, self.learn, self.old = room, learn, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.learn(key)
        self[key] = value
        return value

    def turn(self) -> None:
        if len(self) > self.room // 2:
            self.old = dict(self)
            self.clear()


def lots(batches: Iterator[pd.DataFrame], columns: list[str], size: Callable[[tuple], int], room: int) -> Iterator[list[tuple]]:
    """Rows in lots of about ``room``, as ``size`` counts them; a row beyond that comes at the end of its lot."""
    lot, left = [], room
    for batch in batches:
        for row in zip(*[batch[c] for c in columns], strict=True):
            lot.append(row)
            left -= size(row)
            if left <= 0:
                yield lot
                lot, left = [], room
    if lot:
        yield lot


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def crc_fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id written as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def longs(values: Iterable) -> pd.array:
    """Ids that travelled as text (a null would turn a column of numbers into floats) as nullable integers."""
    return pd.array([None if v is None or v is pd.NA else int(v) for v in values], "Int64")


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in the one column of ``ids``. Few ids travel to the texts, many meet them in a shuffle."""
    ids = materialize(ids.toDF("gone"), "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, docs[id_col] == ids["gone"], "left_anti")
