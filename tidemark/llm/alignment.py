"""Aligning the tokens of two tokenizers over the same bytes, by galloping intersection of their token ends.

A text becomes two rising lists of byte offsets at which a token ends. The shorter list drives: each of its ends gallops into the
longer one, doubling its step until it has passed, then halving between. The ends that meet cut both lists into groups over the
same bytes; the rank each end lands on, less that of the end before, is the range of tokens it overlaps. All ends of a lot of
texts gallop in step, each within its own text's tokens.

One tokenizer (A) takes a blank and the text, its pieces written byte by byte in printable characters; the other (B) adds that blank
itself, writes blanks as U+2581 and unknown bytes as <0xHH>.

The first tokenizer's pre-tokens are merged by rank order of its own vocabulary, in a faster library, for texts of characters that every
library classes alike; the rest, or a vocabulary whose merges are not in the order of its ids, go through the tokenizer itself.

Defined cases: a text that is null or empty, or whose joined token bytes are not the blank and the text, has no tokens and counts
zero everywhere; special tokens written in a text are plain text; repeated rows and ids are rows of their own; an empty table
gives no rows. Texts of any length are encoded whole. Only the two columns named are read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext

from tidemark.llm.common import bounded_batches, byte_letters, docs_of, located, longs, lots, materialize, on_shelf

SPACE = "▁"
#: Characters of text aligned at a time.
LOT = 1_000_000
#: The public pattern that cuts text before merging, and characters that some library may class in another way.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
UNSURE = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xac\xae-\xb1\xb4-\xb8\xba\xbb\xbf-\u017f\u2010-\u2027\u2030-\u205e\u20ac]")
#: Pairs of ids that are broadcast rather than shuffled against links: at most so many, some 200 MB.
BROADCAST_PAIRS = 4_000_000
#: Parts a pair's links are dealt to where they are shuffled.
SALTS = 32
Path = str | Callable[[], str]


def gallop(values: np.ndarray, longer: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each value the first place in ``longer[low:high]`` that is not below it, from the guess ``start``. ``longer`` rises within
    each range and its last element there is not below the value."""
    below = longer[start] < values
    # known bounds of the answer: [left, right]
    left, right = np.where(below, start + 1, low), np.where(below, high - 1, start)
    todo, step = np.flatnonzero(left < right), 1
    while len(todo):  # doubling steps away from the guess
        up = below[todo]
        probe = np.where(up, np.minimum(left[todo] + step - 1, right[todo]), np.maximum(right[todo] - step, left[todo]))
        less = longer[probe] < values[todo]
        left[todo] = np.where(less, probe + 1, left[todo])
        right[todo] = np.where(less, right[todo], np.minimum(probe, right[todo]))
        todo = todo[(up == less) & (left[todo] < right[todo])]
        step *= 2
    todo = np.flatnonzero(left < right)
    while len(todo):  # halving between the last two
        middle = (left[todo] + right[todo]) // 2
        less = longer[middle] < values[todo]
        left[todo] = np.where(less, middle + 1, left[todo])
        right[todo] = np.where(less, right[todo], middle)
        todo = todo[left[todo] < right[todo]]
    return left


class Lot:
    """The aligned tokens of some texts, laid end to end. ``a_at`` and ``b_at`` are where each text's tokens begin (one more at the
    end); ``cut_a`` and ``cut_b`` the places of tokens that end together; ``rank`` the place of each driving token's end among the
    tokens of the other side."""

    def __init__(self, ids_a: np.ndarray, ids_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray):
        self.ids_a, self.ids_b = ids_a, ids_b
        self.a_at, self.b_at = (np.concatenate(([0], np.cumsum(s))) for s in (sizes_a, sizes_b))
        ends_a, ends_b = np.cumsum(len_a), np.cumsum(len_b)
        self.a_drives = sizes_a <= sizes_b
        self.rank_a = self._rank(self.a_drives, ends_a, ends_b, self.a_at, self.b_at)
        self.rank_b = self._rank(~self.a_drives, ends_b, ends_a, self.b_at, self.a_at)
        by_a = self._meeting(self.rank_a, ends_a, ends_b)
        by_b = self._meeting(self.rank_b, ends_b, ends_a)
        cut_a, cut_b = np.concatenate((by_a[0], by_b[1])), np.concatenate((by_a[1], by_b[0]))
        order = np.argsort(cut_a, kind="stable")
        self.cut_a, self.cut_b = cut_a[order], cut_b[order]
        self.groups_at = np.searchsorted(self.cut_a, self.a_at)

    @staticmethod
    def _rank(drives: np.ndarray, ends: np.ndarray, others: np.ndarray, at: np.ndarray, others_at: np.ndarray) -> np.ndarray:
        """Place of each end of the driving texts among the other side's; -1 for texts that do not drive."""
        sizes = np.diff(at)
        mine = np.repeat(drives, sizes)
        rank = np.full(len(ends), -1, np.int64)
        if mine.any():
            low, high, first = (np.repeat(x, sizes)[mine] for x in (others_at[:-1], others_at[1:], at[:-1]))
            width = np.repeat(sizes, sizes)[mine]
            start = low + (np.flatnonzero(mine) - first) * (high - low) // width
            rank[mine] = gallop(ends[mine], others, low, high, start)
        return rank

    @staticmethod
    def _meeting(rank: np.ndarray, ends: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places = np.flatnonzero(rank >= 0)
        places = places[others[rank[places]] == ends[places]]
        return places, rank[places]

    def overlaps(self, text: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last token of the longer side that each token of the shorter side overlaps, counted within the text."""
        drives = self.a_drives[text]
        at, others_at = (self.a_at, self.b_at) if drives else (self.b_at, self.a_at)
        rank = (self.rank_a if drives else self.rank_b)[at[text]:at[text + 1]] - others_at[text]
        cuts = (self.cut_a if drives else self.cut_b)[self.groups_at[text]:self.groups_at[text + 1]] - at[text]
        whole = np.zeros(len(rank), np.int64)
        whole[cuts] = 1
        return np.concatenate(([0], (rank + whole)[:-1])) if len(rank) else rank, rank

    def written(self) -> np.ndarray:
        """Codes of all tokens, group by group, A before B: 2 * id (B's ids after A's WIDTH), and 1 more for a side's last in its group."""
        sizes_a, sizes_b = (np.diff(np.concatenate(([-1], c))) for c in (self.cut_a, self.cut_b))
        codes = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        before_b, upto_a = np.concatenate(([0], self.cut_b[:-1] + 1)), self.cut_a + 1
        a, b = self.ids_a * 2, (self.ids_b + Tokens.WIDTH) * 2
        a[self.cut_a] += 1
        b[self.cut_b] += 1
        codes[np.arange(len(a)) + np.repeat(before_b, sizes_a)] = a
        codes[np.arange(len(b)) + np.repeat(upto_a, sizes_b)] = b
        return codes


class Tokens:
    """Both tokenizers with the bytes of their tokens."""

    #: Ids of A are below this; a pair of ids is a number a * WIDTH + b.
    WIDTH = 1 << 20

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        size = max(self.a.get_vocab().values()) + 1
        self.bytes_a = [b""] * size
        for piece, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(byte_of[c] for c in piece) if all(c in byte_of for c in piece) else piece.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) else piece.replace(SPACE, " ").encode())
        self.fast = self._by_rank(a_path)
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.marks = {}
        for side, size in ((0, len(self.bytes_a)), (self.WIDTH, len(self.bytes_b))):
            for i in range(size):
                self.marks[2 * (side + i)] = f"{i},"
                self.marks[2 * (side + i) + 1] = f"{i};" if side else f"{i}|"

    def _by_rank(self, path: str):
        """The same tokenizer by rank order, or None where its file does not say that this is the same."""
        import tiktoken

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, cut = told["model"], told.get("pre_tokenizer") or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        order = [model["vocab"][left + right] for left, right in merges]
        plain = (told.get("normalizer") is None and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
                 and not model.get("ignore_merges") and not model.get("dropout") and order == sorted(set(order)) and min(order, default=0) >= 256)
        merged = set(order)
        ranks = {self.bytes_a[i]: i for i in model["vocab"].values() if i < 256 or i in merged} if plain else {}
        if len(ranks) != 256 + len(order) or any(bytes([b]) not in ranks for b in range(256)):
            return None
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids_of_a(self, texts: list[str]) -> list[list[int]]:
        sure = [self.fast is not None and not UNSURE.search(t) for t in texts]
        rest = iter(self.a.encode_batch_fast([t for t, s in zip(texts, sure, strict=True) if not s], add_special_tokens=False))
        return [self.fast.encode_ordinary(t) if s else next(rest).ids for t, s in zip(texts, sure, strict=True)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, Lot]:
        """Whether each text has tokens, and the lot of those that have."""
        full = [i for i, t in enumerate(texts) if t]
        coded_a = self.ids_of_a([" " + texts[i] for i in full]) if full else []
        coded_b = self.b.encode([texts[i] for i in full], num_threads=1) if full else []
        whole, lists_a, lists_b = np.zeros(len(texts), bool), [], []
        for i, a, b in zip(full, coded_a, coded_b, strict=True):
            want = (" " + texts[i]).encode()
            if b"".join(map(self.bytes_a.__getitem__, a)) == want and b"".join(map(self.bytes_b.__getitem__, b)) == want:
                whole[i] = True
                lists_a.append(np.array(a, np.int64))
                lists_b.append(np.array(b, np.int64))
        none = np.zeros(0, np.int64)
        ids_a, ids_b = (np.concatenate(x) if x else none for x in (lists_a, lists_b))
        sizes_a, sizes_b = (np.array([len(x) for x in y], np.int64) for y in (lists_a, lists_b))
        return whole, Lot(ids_a, ids_b, sizes_a, sizes_b, self.length_a[ids_a], self.length_b[ids_b])


def tokens(a: Path, b: Path) -> Tokens:
    a, b = located(a), located(b)
    return on_shelf(f"aligned:{a}:{b}", lambda: Tokens(a, b))


def _lots_of(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
    return lots(batches, ["doc_id", "text"], lambda row: len(row[1]), LOT)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs_of(docs, id_col, text_col).select(F.col("doc_id").cast("string"), "text")


def align(docs: DataFrame, a: Path, b: Path, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the ids of both sides, how many tokens of each end with each group, the side that drove, and for each of its tokens
    the first and last token of the other side that it overlaps."""
    def aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = tokens(a, b)
        for lot in _lots_of(batches):
            whole, found = both.encode([t for _, t in lot])
            rows, place = [], 0
            for (doc_id, _), has in zip(lot, whole, strict=True):
                if not has:
                    rows.append((doc_id, [], [], [], [], "a", [], []))
                    continue
                cut = slice(found.groups_at[place], found.groups_at[place + 1])
                first, last = found.overlaps(place)
                rows.append((doc_id, found.ids_a[found.a_at[place]:found.a_at[place + 1]], found.ids_b[found.b_at[place]:found.b_at[place + 1]],
                             found.cut_a[cut] - found.a_at[place] + 1, found.cut_b[cut] - found.b_at[place] + 1,
                             "a" if found.a_drives[place] else "b", first, last))
                place += 1
            out = pd.DataFrame(rows, columns=["doc_id", "a_ids", "b_ids", "a_ends", "b_ends", "shorter", "first", "last"])
            yield out.assign(doc_id=longs(out["doc_id"]))

    schema = "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>, shorter string, first array<int>, last array<int>"
    return _rows(docs, id_col, text_col).mapInPandas(aligned, schema)


_LINKED = "place long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>"


def _linked(docs: DataFrame, a: Path, b: Path, id_col: str, text_col: str) -> DataFrame:
    """Per document its token and group counts, the digest of its groups, and the id pairs of its links with how often each occurs."""
    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both, base, seen = tokens(a, b), TaskContext.get().partitionId() << 40, 0
        for lot in _lots_of(batches):
            whole, found = both.encode([t for _, t in lot])
            texts = list(map(both.marks.__getitem__, found.written().tolist()))
            groups = np.diff(found.groups_at)
            owner = np.repeat(np.arange(len(groups)), groups)
            pair = found.ids_a[found.cut_a] * Tokens.WIDTH + found.ids_b[found.cut_b]
            order = np.lexsort((pair, owner))
            owner, pair = owner[order], pair[order]
            new = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])))) if len(pair) else np.zeros(0, np.int64)
            times, pairs_at = np.diff(np.append(new, len(pair))), np.searchsorted(owner[new], np.arange(len(groups) + 1))
            pair = pair[new]
            starts = found.a_at + found.b_at
            rows, place = [], 0
            for (doc_id, _), has in zip(lot, whole, strict=True):
                if has:
                    digest = hashlib.sha256("".join(texts[starts[place]:starts[place + 1]])[:-1].encode()).hexdigest()
                    cut = slice(pairs_at[place], pairs_at[place + 1])
                    rows.append((base + seen, doc_id, found.a_at[place + 1] - found.a_at[place], found.b_at[place + 1] - found.b_at[place], groups[place],
                                 digest, pair[cut], times[cut]))
                    place += 1
                else:
                    rows.append((base + seen, doc_id, 0, 0, 0, "", [], []))
                seen += 1
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in _LINKED.split(", ")])
            yield out.assign(doc_id=longs(out["doc_id"]))

    return _rows(docs, id_col, text_col).mapInPandas(linked, _LINKED)


def pair_counts(linked: DataFrame) -> DataFrame:
    """pair, count, best (whether the count is its B id's highest) of every pair of ids that some link holds."""
    counts = linked.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"))
    counts = materialize(counts, "pair-counts")
    highest = counts.groupBy((F.col("pair") % Tokens.WIDTH).alias("b")).agg(F.max("count").alias("highest"))
    return counts.join(highest, F.col("pair") % Tokens.WIDTH == F.col("b")).select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def link_report(docs: DataFrame, a: Path, b: Path, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document.

    Pairs of ids number at most the product of the vocabularies, whatever the table: up to BROADCAST_PAIRS of them travel to the
    documents, more meet their links in a shuffle whose every pair is dealt to SALTS parts.
    """
    linked = materialize(_linked(docs, a, b, id_col, text_col), "links")
    pairs = materialize(pair_counts(linked), "pairs")
    links = linked.select("place", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    if pairs.count() <= BROADCAST_PAIRS:
        met = links.join(F.broadcast(pairs), "pair")
    else:
        salted = pairs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = links.withColumn("salt", (F.col("place") % SALTS).cast("int")).join(salted.hint("shuffle_hash"), ["pair", "salt"])
    sums = met.groupBy("place").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"),
                                    F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    none = F.lit(0).cast(T.LongType())
    return linked.drop("pairs", "times").join(sums, "place", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256")
