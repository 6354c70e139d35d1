"""Document fingerprints from SpotSigs.

A common word (an *anchor*) and the next ``CHAIN`` content words form one signature. A fingerprint is the multiset of
a text's signatures, kept as sorted 32-bit hashes (the n-th repeat of a signature hashes with its number), written as
base64. Likeness is the Jaccard coefficient of two such sets.

Defined cases: null and empty texts have the empty fingerprint; the start of a text counts as an anchor, so a text of
few words still has one; a text without any content word is fingerprinted by its words alone; two empty fingerprints
have likeness 1, an empty one and any other 0. Documents with equal ids follow each other in the order of their
text's hash; a null id comes before all others; rows alike in both follow each other in any order. An empty table gives
no row. Very long texts are read whole; only the id and text columns are read, so no further column can clash.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.common import bounded_batches, docs_of, longs, materialize, shuffle_width

#: Common words of English, German, French and Spanish.
ANCHORS = frozenset("""
the a an of and to in is that was for with he she it be on as at by are this from or had not but they his her which
der die das und den zu des dem ein eine für von mit sich ist im nicht auf als auch es an er so
de la le les et un une du en que qui dans il au ce ne sur pas plus par
el los las y del se por con una su para como más o lo al
""".split())
CHAIN = 2
TOKEN = re.compile(r"\w+")
MEMO_ROOM = 500_000
MIN_KEY = -(1 << 63)
#: Rows of one id that may stay together in one run.
RUN_ROWS = 1000


class _Memo(dict):
    """Word -> hash shifted left by one, the lowest bit set for anchors. Emptied when full: only a cache."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_ROOM:
            self.clear()
        code = zlib.crc32(word.encode("utf-8", "surrogatepass")) << 1 | (word in ANCHORS)
        self[word] = code
        return code


_memo = _Memo()


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def signatures(text: str) -> np.ndarray:
    """Sorted distinct 32-bit hashes of the numbered signatures of a text."""
    words = TOKEN.findall(text.lower())
    if not words:
        return np.array([zlib.crc32(text.encode("utf-8", "surrogatepass"))], np.uint32) if text else np.empty(0, np.uint32)
    codes = np.array([_memo[w] for w in words], np.uint64)
    anchor = (codes & np.uint64(1)).astype(bool)
    content = codes[~anchor]
    if len(content):
        before = np.cumsum(~anchor)[anchor]                   # content words before each anchor
        at = np.concatenate(([0], before))                    # the text's start is an anchor too
        head = np.concatenate((np.zeros(1, np.uint64), codes[anchor]))
        padded = np.concatenate((content, np.zeros(CHAIN, np.uint64)))
        keep = at < len(content)
        at, sig = at[keep], _mix(head[keep] + np.uint64(1))
        for step in range(CHAIN):
            sig = _mix(sig + padded[at + step])
    else:
        sig = _mix(codes)
    sig.sort()
    first = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
    repeat = np.arange(len(sig)) - np.repeat(first, np.diff(np.append(first, len(sig))))
    return np.unique((_mix(sig + repeat.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32))


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard of two signature sets; 0.0 without comparing if the lengths alone keep it below ``at_least``."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if not small or small < at_least * large:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (small + large - both)


def encode(sig: np.ndarray) -> str:
    return base64.b64encode(sig.astype("<u4").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_signatures, fingerprint of every whole text."""
    bounded_batches(docs.sparkSession)

    @pandas_udf("fingerprint string, n_signatures int")
    def marks(text: pd.Series) -> pd.DataFrame:
        sets = [signatures(t) for t in text]
        return pd.DataFrame({"fingerprint": [encode(s) for s in sets], "n_signatures": [len(s) for s in sets]})

    return docs_of(docs, id_col, text_col).withColumn("m", marks("text")).select("doc_id", "m.*")


def near_pairs(prints: DataFrame, at_least: float = 0.75) -> DataFrame:
    """Pairs (a, b, likeness) of different fingerprints with a likeness of at least ``at_least``, a < b; and the smallest id stands for
    all documents with one fingerprint.

    Fingerprints are cut into length classes so that partners lie in one class or the next; inside, only sets that
    share one of their rarest-by-hash signatures (the prefix a pair must share) meet, and the length bound and the
    Jaccard are checked on those.
    """
    spark = prints.sparkSession
    one = prints.where("n_signatures > 0").groupBy("fingerprint", "n_signatures").agg(F.min("doc_id").alias("id"))
    # classes grow by 1/at_least, hence a partner is at most one class away
    one = one.withColumn("band", F.floor(F.log("n_signatures") / F.log(F.lit(1 / at_least))).cast("int"))

    @pandas_udf("array<long>")
    def prefix(fingerprint: pd.Series) -> pd.Series:
        def cut(f: str) -> list[int]:
            s = decode(f)
            return s[:len(s) - int(np.ceil(at_least * len(s) - 1e-9)) + 1].astype(np.int64).tolist()
        return fingerprint.map(cut)

    keyed = one.withColumn("key", F.explode(prefix("fingerprint")))
    probe = keyed.withColumn("meets", F.explode(F.array("band", F.col("band") + 1)))
    a = probe.select(F.col("id").alias("a"), F.col("n_signatures").alias("na"), "key", F.col("meets").alias("band"), F.col("band").alias("own"))
    b = keyed.select(F.col("id").alias("b"), F.col("n_signatures").alias("nb"), "key", "band")
    met = a.join(b, ["key", "band"]).where(
        (F.col("a") != F.col("b")) & (F.least("na", "nb") >= at_least * F.greatest("na", "nb"))
        & ((F.col("own") != F.col("band")) | (F.col("a") < F.col("b"))))
    met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    f = one.select("id", "fingerprint")
    full = (met.join(f.withColumnsRenamed({"id": "a", "fingerprint": "fa"}), "a")
            .join(f.withColumnsRenamed({"id": "b", "fingerprint": "fb"}), "b"))

    @pandas_udf("double")
    def compare(fa: pd.Series, fb: pd.Series) -> pd.Series:
        return pd.Series([likeness(decode(x), decode(y), at_least) for x, y in zip(fa, fb, strict=True)], dtype="float64")

    bounded_batches(spark)
    return full.select("a", "b", compare("fa", "fb").alias("likeness")).where(F.col("likeness") >= at_least)


def _keyed(rows: DataFrame, blocks: int) -> DataFrame:
    """Adds the order by which runs are cut: the id (k), and for ids that hold more than a run's share of all rows also the
    text's hash (h) and a number of the row's own (t), so that such an id spans many runs. Those rows are stored, as their
    numbers must not change; they are fewer than ``blocks`` ids."""
    rows = rows.withColumn("k", F.coalesce(F.col("doc_id").cast("long"), F.lit(MIN_KEY)))
    share = max(RUN_ROWS, rows.count() // blocks)
    hot = [r.k for r in rows.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > share).collect()]
    zero = F.lit(0).cast("long")
    plain = rows.withColumns({"h": zero, "t": zero})
    if not hot:
        return plain
    many = rows.where(F.col("k").isin(hot)).withColumns({"h": F.xxhash64("text"), "t": F.monotonically_increasing_id()})
    return plain.where(~F.col("k").isin(hot)).unionByName(materialize(many, "hot-ids"))


def _heads(rows: DataFrame, blocks: int) -> list[tuple[int, int, int]]:
    """The first key of each of at most ``blocks`` runs: one key per run comes to the driver."""
    runs = rows.select("k", "h", "t").repartitionByRange(blocks, "k", "h", "t").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("k", "h", "t")).alias("first"))
    return sorted(tuple(r.first) for r in runs.select("first").collect())


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """Fingerprint of every text and of its edited form, and the likeness to that form and to the next document.

    Ids are cut into runs from the id column alone; an id with more rows than a run may hold is cut by its texts' hashes and
    row numbers as well. Each text then moves once, to the task of its run; the first document of the following run comes
    along as the last one's neighbour. So no task sees more than its runs.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    width = shuffle_width(spark)
    blocks = blocks or 4 * width
    rows = _keyed(docs_of(docs, id_col, text_col), blocks)
    heads = _heads(rows, blocks)

    @pandas_udf("array<int>")
    def places(k: pd.Series, h: pd.Series, t: pd.Series) -> pd.Series:
        out = []
        for key in zip(k.tolist(), h.tolist(), t.tolist(), strict=True):
            at = bisect_right(heads, key) - 1
            # even: a row of the run; odd: the neighbour that closes the run before
            out.append([2 * at, 2 * ((at - 1) % len(heads)) + 1] if heads[at] == key else [2 * at])
        return pd.Series(out)

    dealt = (rows.withColumn("place", F.explode(places("k", "h", "t")))
             .withColumn("run", F.floor(F.col("place") / 2).cast("int")))
    dealt = dealt.repartition(width, "run").sortWithinPartitions("place", "k", F.xxhash64("text"), "t")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            out = []
            for place, doc_id, text in zip(batch["place"], batch["doc_id"], batch["text"], strict=True):
                run, closing = divmod(place, 2)
                sig = signatures(text)
                if held is not None and held[0] == run:
                    out.append(_row(held, text, sig))
                held = None if closing else (run, None if pd.isna(doc_id) else int(doc_id), text, sig)
            if out:
                yield pd.DataFrame(out, columns=COLUMNS).assign(doc_id=longs(x[0] for x in out))

    return (dealt.select("place", F.col("doc_id").cast("string").alias("doc_id"), "text")
            .mapInPandas(walk, "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
                               " edited_fingerprint string, near_edited double, near_next double, n_signatures int"))


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_signatures"]


def _row(held: tuple, following: str, following_sig: np.ndarray) -> tuple:
    _, doc_id, text, sig = held
    half = len(text) // 2
    edited = text[:len(text) - half] + following[:half]
    mark = signatures(edited)
    return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), encode(sig), encode(mark),
            likeness(sig, mark), likeness(sig, following_sig), len(sig))
