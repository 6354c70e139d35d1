"""Ranked lexical search of stated items over all documents: term at a time, with limited accumulators.

One pass cuts every document into terms and keeps the counts of those that some item asks for. Document counts of terms and the
table's totals come from it by aggregation. A second pass holds the postings of a block of documents and answers every item there:
its terms come rarest first, and each adds its weight to the accumulators of the documents that hold it. Once the bounds of
the terms still to come cannot lift a new document to the k-th partial score, no accumulator is created any more; those
that exist are continued exactly. The best k of each block meet in two rounds of top-k, so that no task sees more than its share.

Scores are whole numbers: an item's term weighs floor(1000 ln((2N+2)/(2df+1))) and adds weight * ((10^9 tf) div (1000 tf + 8m)),
m = 10 + (90 n N) div L, for a document of n terms, N documents with L terms.

Defined cases: null and empty texts hold no term and count nowhere; items without terms, or whose terms occur nowhere, give no
rows; rows that share an item id are one item; rows that repeat a document id are ranked each; equal scores go by id, null last;
empty tables give no rows. Texts count whole. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, longs, materialize

#: Letters, digits and all beyond ASCII, on lower-cased UTF-8: lower() of bytes touches A-Z alone.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Bytes of item texts searched in one pass over the documents.
ITEM_BYTES = 8_000_000
#: Postings and documents of a block.
BLOCK_POSTINGS, BLOCK_DOCS = 2_000_000, 200_000
#: Groups that the blocks' best are cut into before the last round.
ROUNDS = 64


def terms_of(text: bytes) -> list[bytes]:
    return TERM.findall(text.lower())


def _item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[dict]:
    """Items and their distinct terms, as many at a time as ITEM_BYTES allow. The driver holds one block."""
    rows = items.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), F.col(f"`{text_col}`").cast("binary").alias("text")).where("text is not null")
    block, room = {}, ITEM_BYTES
    for row in rows.orderBy("item_id").toLocalIterator():
        # a block ends between two items, never inside one
        if room <= 0 and row.item_id not in block:
            yield block
            block, room = {}, ITEM_BYTES
        block.setdefault(row.item_id, set()).update(terms_of(bytes(row.text)))
        room -= len(row.text)
    if block:
        yield block


class Item:
    """An item's terms that occur, rarest first."""

    def __init__(self, item_id: int | None, terms: list[int]):
        self.item_id, self.terms = item_id, terms


class Block:
    """Postings of some documents, by term. A document is a place in ``ids``."""

    def __init__(self, ids: list, places: np.ndarray, terms: np.ndarray, gains: np.ndarray):
        self.ids = np.array([np.iinfo(np.int64).max if i is None else i for i in ids], np.int64)
        self.nulls = np.array([i is None for i in ids])
        order = np.argsort(terms, kind="stable")
        terms, self.places, self.gains = terms[order], places[order], gains[order]
        known, starts = np.unique(terms, return_index=True)
        ends = np.append(starts[1:], len(terms))
        tops = np.maximum.reduceat(self.gains, starts) if len(starts) else starts
        self.spans = {int(t): (int(a), int(b), int(top)) for t, a, b, top in zip(known, starts, ends, tops, strict=True)}
        self.scores, self.held = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids), bool)

    def best(self, terms: list[int], k: int) -> list[tuple[int, int]]:
        """(place, score) of the k highest; equal scores by id."""
        lists = [self.spans[t] for t in terms if t in self.spans and self.spans[t][2] > 0]
        left, found, creating, scores, held = sum(top for _, _, top in lists), [], True, self.scores, self.held
        created = 0
        for start, end, top in lists:
            places, gains = self.places[start:end], self.gains[start:end]
            if creating and created >= k:
                partial = scores[np.concatenate(found)] if len(found) > 1 else scores[found[0]]
                # a new document could at best reach what is left; equal scores may win by id
                creating = np.partition(partial, -k)[-k] <= left
            if creating:
                new = places[~held[places]]
                held[new] = True
                scores[places] += gains
                found.append(new)
                created += len(new)
            else:
                old = held[places]
                scores[places[old]] += gains[old]
            left -= top
        if not found:
            return []
        every = np.concatenate(found)
        total = scores[every]
        if len(every) > k:
            keep = total >= np.partition(total, -k)[-k]
            some, total = every[keep], total[keep]
        else:
            some = every
        order = np.lexsort((self.ids[some], self.nulls[some], -total))[:k]
        out = [(int(p), int(s)) for p, s in zip(some[order], total[order], strict=True) if s > 0]
        scores[every], held[every] = 0, False
        return out


def _counted(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Per document with terms: their number, and the asked ones with their counts."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = numbers.get
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                words = terms_of(text)
                if words:
                    held = Counter(map(number, words))
                    held.pop(None, None)
                    rows.append((doc_id, len(words), list(held.keys()), list(held.values())))
            if rows:
                ids, sizes, terms, times = zip(*rows, strict=True)
                yield pd.DataFrame({"doc_id": longs(ids), "n": sizes, "terms": terms, "times": times})

    return docs.mapInPandas(cut, "doc_id long, n long, terms array<int>, times array<int>")


def _answered(stored: DataFrame, asked: list[Item], weights: np.ndarray, documents: int, length: int, k: int) -> DataFrame:
    def answer(ids: list, sizes: list, terms: list, times: list) -> pd.DataFrame:
        places = np.repeat(np.arange(len(ids), dtype=np.int32), [len(t) for t in terms])
        term = np.concatenate(terms).astype(np.int64)
        tf = np.concatenate(times).astype(np.int64)
        m = 10 + (90 * np.array(sizes, np.int64) * documents) // length
        block = Block(ids, places, term, weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[places])))
        rows = [(item.item_id, ids[p], score) for item in asked for p, score in block.best(item.terms, k)]
        item_ids, doc_ids, scores = zip(*rows, strict=True) if rows else ((), (), ())
        return pd.DataFrame({"item_id": longs(item_ids), "doc_id": longs(doc_ids), "score": np.array(scores, np.int64)})

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, postings = ([], [], [], []), 0
        for batch in batches:
            for row in zip(*[batch[c] for c in ("doc_id", "n", "terms", "times")], strict=True):
                if len(row[2]):
                    for column, value in zip(held, (None if row[0] is None else int(row[0]), *row[1:]), strict=True):
                        column.append(value)
                    postings += len(row[2])
                    if postings >= BLOCK_POSTINGS or len(held[0]) >= BLOCK_DOCS:
                        yield answer(*held)
                        held, postings = ([], [], [], []), 0
        if postings:
            yield answer(*held)

    # ids as text: a null would turn a column of numbers into floats
    rows = stored.where(F.size("terms") > 0).withColumn("doc_id", F.col("doc_id").cast("string"))
    return rows.mapInPandas(blocks, "item_id long, doc_id long, score long")


def _top(rows: DataFrame, k: int) -> DataFrame:
    """The k best of each item: first within parts of the blocks, then of those."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    parts = rows.withColumn("part", F.spark_partition_id() % ROUNDS)
    first = parts.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "part").orderBy(*order))).where(F.col("rank") <= k)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k)
    return last.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col(f"`{id_col}`").cast("string").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text")).where("text is not null")
    found = None
    for block in _item_blocks(items, item_col, item_text_col):
        numbers = {t: i for i, t in enumerate(sorted(set().union(*block.values())))}
        stored = materialize(_counted(texts, numbers), "postings")
        documents, length = stored.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        counts = np.zeros(len(numbers), np.int64)
        for row in stored.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():  # one row per term asked
            counts[row["term"]] = row["count"]
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in counts], np.int64)
        asked = [Item(i, sorted((numbers[t] for t in terms if counts[numbers[t]]), key=lambda t: (counts[t], t))) for i, terms in block.items()]
        top = _top(_answered(stored, [i for i in asked if i.terms], weights, documents, length, k), k)
        found = top if found is None else found.unionByName(top)
    return found if found is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
