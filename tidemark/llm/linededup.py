"""Line dedup by pairwise alignment.

A shortest run of lines, from a line on or up to a line, with at least ``MIN_WORDS`` words in all is an anchor; anchors are rare where single lines may be common.
Each document meets, for every anchor it shares with an earlier document, the earliest one that holds it. Their
lines are aligned by patience diff, and common blocks of at least ``MIN_WORDS`` words are deleted from the later
document. Where no line is unique on both sides, runs of lines with ``MIN_WORDS`` words are matched in their place. A pair is aligned again without the
found blocks, ``ROUNDS`` times at most, and then every shared anchor of the pair that alignment left is deleted too, so moved passages and lines of few
kinds in turn are found whatever lies around them, in time that grows with the lines. Every
line of a block that a document shares with any earlier one lies in an anchor inside that block (the run from a line on, up to it, or
around it), so meeting the earliest holders misses no line, and pairs stay as few as anchors, however many documents share a passage.
The first document with a line keeps it.

Lines are compared without surrounding white space. Later means the larger doc_id, then the larger hash of the text.

Defined cases: null and empty texts have no line with words and stay as they are; repeated rows (equal id and text) are one document and are cut
alike; a null id is later than all others; other columns pass through; an empty table gives no row.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, bounded_batches

MIN_WORDS = 50
#: Cuts joined as a broadcast table: at most so many documents and lines, some 100 MB; beyond, both sides are shuffled.
BROADCAST_DOCS, BROADCAST_LINES = 500_000, 5_000_000
#: Alignments of one pair; what would take more is cut by the anchors that are left, so the result does not depend on it.
ROUNDS = 8
#: Partners of an early document per task.
PARTNERS = 256
LAST = (1 << 63) - 1


def line_marks(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash and number of words of each line; lines without words have hash 0."""
    import xxhash

    lines = text.split("\n")
    words = [len(x.split()) for x in lines]
    hashes = [xxhash.xxh3_64_intdigest(x.strip().encode("utf-8", "surrogatepass")) >> 1 | 1 if w else 0 for x, w in zip(lines, words, strict=True)]
    return np.array(hashes, np.int64), np.array(words, np.int32)


def word_runs(h: np.ndarray, words: np.ndarray, min_words: int) -> list[tuple[int, int, int]]:
    """Hash, start and end of the shortest runs that reach ``min_words``, from each line on and up to each line. All lines have words."""
    import xxhash

    upto = np.concatenate(([0], np.cumsum(words)))
    ends = np.searchsorted(upto, upto[:-1] + min_words)
    starts = np.searchsorted(upto, upto[1:] - min_words, "right") - 1
    spans = {(i, e) for i, e in enumerate(ends.tolist()) if e < len(upto)} | {(i, e) for e, i in enumerate(starts.tolist(), 1) if i >= 0}
    return [(xxhash.xxh3_64_intdigest(h[i:e].tobytes()) >> 1, i, e) for i, e in spans]


def anchors(hashes: np.ndarray, words: np.ndarray, min_words: int) -> list[int]:
    """Hashes of the runs of lines that reach ``min_words``. Lines without words are passed over."""
    real = np.flatnonzero(words)
    return list({x for x, _, _ in word_runs(hashes[real], words[real], min_words)})


def patience(a: Sequence[int], b: Sequence[int], runs_a: Sequence | None = None, runs_b: Sequence | None = None) -> list[tuple[int, int, int]]:
    """Common blocks (start in a, start in b, length) of two sequences, in order in both. Where no line is unique on both sides, the runs that
    start at the lines (given as a key per line; two successive lines if not given) are looked at instead; a stretch that has no unique run
    either, such as lines of few kinds in turn, is left out."""
    runs_a, runs_b = (list(zip(x, [*x[1:], None])) if r is None else r for x, r in ((a, runs_a), (b, runs_b)))
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            pairs.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            pairs.append((ahi, bhi))
        if alo >= ahi or blo >= bhi:
            continue
        fixed = _unique_in_both(a, alo, ahi, b, blo, bhi) or _unique_in_both(runs_a, alo, ahi, runs_b, blo, bhi)
        x, y = alo, blo
        for i, j in fixed:
            todo.append((x, i, y, j))
            pairs.append((i, j))
            x, y = i + 1, j + 1
        if fixed:
            todo.append((x, ahi, y, bhi))
    blocks: list[list[int]] = []
    for i, j in sorted(pairs):
        if blocks and blocks[-1][0] + blocks[-1][2] == i and blocks[-1][1] + blocks[-1][2] == j:
            blocks[-1][2] += 1
        else:
            blocks.append([i, j, 1])
    return [tuple(x) for x in blocks]


def _unique_in_both(a, alo, ahi, b, blo, bhi) -> list[tuple[int, int]]:
    """Lines found once on either side, thinned to a longest run that rises on both."""
    once_a, once_b = Counter(a[alo:ahi]), Counter(b[blo:bhi])
    place = {x: j for j, x in enumerate(b[blo:bhi], blo) if x is not None and once_b[x] == 1}
    found = [(i, place[x]) for i, x in enumerate(a[alo:ahi], alo) if once_a[x] == 1 and x in place]
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(found)
    for n, (_, j) in enumerate(found):
        at = bisect.bisect_left(tails, j)
        before[n] = ends[at - 1] if at else -1
        tails[at:at + 1] = [j]
        ends[at:at + 1] = [n]
    out, n = [], ends[-1] if ends else -1
    while n >= 0:
        out.append(found[n])
        n = before[n]
    return out[::-1]


def _from_each(runs: list[tuple[int, int, int]], n: int) -> list[int | None]:
    """Per line the key of the longest run that starts there; None, which is never unique, without one."""
    keys: list[int | None] = [None] * n
    for x, i, _ in sorted(runs, key=lambda r: r[2] - r[1]):
        keys[i] = x
    return keys


def common_lines(early: np.ndarray, late: np.ndarray, words: np.ndarray, min_words: int) -> set[int]:
    """Numbers of the later document's lines that lie in a common block of at least ``min_words`` words."""
    rows = np.flatnonzero(words)
    a, b = [x for x in early.tolist() if x], late[rows].tolist()
    weight = words[rows].tolist()
    # equal lines have equally many words; a line of the early document alone is in no shared run, whatever it weighs
    known = dict(zip(b, weight, strict=True))
    early_runs = word_runs(np.array(a, np.int64), np.array([known.get(x, min_words) for x in a], np.int64), min_words)
    held = {x for x, _, _ in early_runs}
    shared = [run for run in word_runs(late[rows], words[rows], min_words) if run[0] in held]
    runs_a, runs_b = _from_each(early_runs, len(a)), _from_each(shared, len(b))
    cut: set[int] = set()
    for _ in range(ROUNDS):
        if all(j in cut for _, i, e in shared for j in (i, e - 1)):
            break
        # what is cut already matches nothing, and neither does what lacks a partner
        masked, runs = ([-1 - j if j in cut else x for j, x in enumerate(keys)] for keys in (b, runs_b))
        new = {j + k for _, j, size in patience(a, masked, runs_a, runs) if sum(weight[j:j + size]) >= min_words for k in range(size)}
        if not new:
            break
        cut |= new
    # runs that the alignments' order or shorter matches crowded out
    for _, i, e in shared:
        cut.update(range(i, e))
    return {int(rows[j]) for j in cut}


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple:
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


def cuts(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """k, h (the document) and ``cut``, the numbers of its lines to delete, for every document that loses lines."""
    bounded_batches(docs.sparkSession)
    k, h = _keyed(docs, id_col, text_col)
    rows = docs.select(k.alias("k"), h.alias("h"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            marks = [line_marks(t) for t in batch["text"]]
            yield pd.DataFrame({"k": batch["k"], "h": batch["h"], "lines": [m[0].tobytes() for m in marks], "words": [m[1].tobytes() for m in marks],
                                "anchors": [anchors(*m, min_words) for m in marks]})

    marked = materialize(rows.mapInPandas(mark, "k long, h long, lines binary, words binary, anchors array<long>"), "line-marks")
    at = marked.select(F.struct("k", "h").alias("doc"), F.explode("anchors").alias("anchor"))
    # an early document with many partners is sent to as many places as they need: a power of two per anchor, by the documents that hold it
    places = F.pow(2, F.greatest(F.ceil(F.log2(F.count("*") / PARTNERS)), F.lit(0))).cast("int")
    first = at.groupBy("anchor").agg(F.min("doc").alias("early"), F.max("doc").alias("last"), places.alias("places")).where("early <> last").drop("last")
    pairs = (at.join(first, "anchor").where("doc <> early").groupBy("doc", "early").agg(F.max("places").alias("places"))
             .select("doc.k", "doc.h", F.col("early.k").alias("ek"), F.col("early.h").alias("eh"), "places")
             .withColumn("place", F.pmod(F.xxhash64("k", "h"), "places").cast("int")))
    slim = marked.select("k", "h", "lines", "words").dropDuplicates(["k", "h"])
    stands = first.select(F.col("early.k").alias("ek"), F.col("early.h").alias("eh"), "places").distinct()
    early = (stands.join(slim.select(F.col("k").alias("ek"), F.col("h").alias("eh"), F.col("lines").alias("early")), ["ek", "eh"])
             .withColumn("place", F.explode(F.sequence(F.lit(0), F.col("places") - 1))))
    both = pairs.join(slim, ["k", "h"]).join(early, ["ek", "eh", "places", "place"]).select("k", "h", "lines", "words", "early")

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sorted(common_lines(np.frombuffer(e, np.int64), np.frombuffer(x, np.int64), np.frombuffer(w, np.int32), min_words))
                     for e, x, w in zip(batch["early"], batch["lines"], batch["words"], strict=True)]
            yield pd.DataFrame({"k": batch["k"], "h": batch["h"], "cut": found})

    # a document has no more partners than anchors, so these lists are bounded by its own length squared at worst
    found = both.mapInPandas(align, "k long, h long, cut array<int>").where(F.size("cut") > 0)
    return found.groupBy("k", "h").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("cut")))).alias("cut"))


def dedupe(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", cut_col: str = "cut_lines") -> DataFrame:
    """``docs`` with shortened texts, and ``cut_col``: the numbers of the deleted lines (empty if none)."""
    table = materialize(cuts(docs, min_words, id_col, text_col), "line-cuts")
    total = table.agg(F.count("*").alias("n"), F.sum(F.size("cut")).alias("lines")).first()
    small = total.n <= BROADCAST_DOCS and (total.lines or 0) <= BROADCAST_LINES
    table = table.select(F.struct("k", "h", "cut").alias("line_cut"))
    k, h = _keyed(docs, id_col, text_col)
    joined = docs.join(F.broadcast(table) if small else table, (k == F.col("line_cut.k")) & (h == F.col("line_cut.h")), "left")
    text, cut = F.col(f"`{text_col}`"), F.col("line_cut.cut")
    shorter = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(cut, i)), "\n")
    columns = [F.when(cut.isNull(), text).otherwise(shorter).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, F.coalesce(cut, F.array().cast("array<int>")).alias(cut_col))
