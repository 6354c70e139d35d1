"""Exact token counts of a vocabulary of scored pieces, by merging arrays of symbols in step.

A text's pre-tokens are the stretches that no merge can cross: white space binds only to what follows it, and a character
in no piece of several is alone. Unknown pre-tokens of a lot are laid out as one ragged array of symbols. In each round
every sequence finds its lowest-ranked pair, and all sequences merge theirs at once; a sequence without a pair is done, and its
surviving symbols are its count.

Merging all places of a sequence's lowest pair at once equals merging them one by one, left to right, as long as no merge
makes a pair that is due before the next place. Products for which some pair is (``eager``) merge their leftmost place only.

Defined cases: null and empty texts have no tokens; control pieces written in a text are plain text, as the library has it;
repeated rows are counted each; an empty table gives no rows. Texts of any length are counted whole. A stretch of over
``LONGEST`` characters without any place that no piece spans would need as many rounds, so a text that holds one is counted
by the library itself. Only the two columns named are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Memo, bounded_batches, docs_of, located, longs, lots, on_shelf

SPACE = "▁"
#: Pre-tokens whose counts a worker remembers.
MEMO_ROOM = 1_000_000
#: Characters of text counted at a time.
LOT = 4_000_000
#: Characters of the longest stretch merged here.
LONGEST = 4096
#: Runs of white space beyond this are cut into whole longest pieces.
LONG_SPACE = 64
NEVER = np.iinfo(np.int32).max


class Merges:
    """Pairs of symbols of a vocabulary, their rank and what they merge to."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(sp.get_piece_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        names = [sp.id_to_piece(i) for i in plain]
        scores = np.array([sp.get_score(i) for i in plain])
        several = [p for p in names if len(p) > 1]
        self.single = {p for p in names if len(p) == 1}
        # characters that only occur inside longer pieces are symbols too, though no pieces
        self.joined = set("".join(several))
        symbols = names + sorted(self.joined - self.single)
        self.number = {p: i for i, p in enumerate(symbols)}
        self.tokens = np.array([1] * len(names) + [len(c.encode()) for c in symbols[len(names):]])
        # equal scores share a rank: the leftmost place then decides
        ranks = np.unique(-scores, return_inverse=True)[1]
        rows, self.eager = [], np.zeros(len(ranks) + 1, bool)
        for name in several:
            whole = self.number[name]
            for cut in range(1, len(name)):
                left, right = self.number.get(name[:cut]), self.number.get(name[cut:])
                if left is not None and right is not None:
                    rows.append((left * len(symbols) + right, ranks[whole], whole))
                    for half in (left, right):
                        if half < len(names) and len(symbols[half]) > 1 and ranks[half] >= ranks[whole]:
                            self.eager[ranks[half]] = True
        rows.sort()
        self.keys, self.ranks, self.products = (np.array(c, np.int64) for c in zip(*rows, strict=True))
        self.width = len(symbols)
        spans = sorted({p[i:i + 2] for p in several for i in range(len(p) - 1)})
        self.spans = set(spans)
        letters = re.escape("".join(sorted(self.joined - {SPACE})))
        self.stretch = re.compile(f"{SPACE}+[{letters}]*|[{letters}]+")
        self.longest_space = max((len(p) for p in names if set(p) == {SPACE}), default=1)
        # runs of white space are eaten from the left in whole longest pieces; if this vocabulary does otherwise, they are not cut
        top = self.longest_space
        runs = self._merge([SPACE * n for n in range(1, 4 * top + 1)])
        self.cut_space = bool((runs[3 * top:] == runs[:top] + 3).all())

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], NEVER).astype(np.int32), np.where(found, self.products[at], 0).astype(np.int32)

    def _parts(self, stretch: str) -> list[str]:
        """A stretch cut where two neighbours stand together in no piece, and its long white space into longest pieces."""
        parts, space = [], len(stretch) - len(stretch.lstrip(SPACE))
        if self.cut_space and space > LONG_SPACE:
            whole = (space - LONG_SPACE) // self.longest_space
            parts, stretch = [SPACE * self.longest_space] * whole, stretch[whole * self.longest_space:]
        start = 0
        for i in range(1, len(stretch)):
            if stretch[i - 1:i + 1] not in self.spans:
                parts.append(stretch[start:i])
                start = i
        parts.append(stretch[start:])
        return parts

    def count(self, stretches: list[str]) -> list[int]:
        """Tokens of each stretch; -1 where a part is too long to be merged here."""
        totals, parts, owner = np.zeros(len(stretches), np.int64), [], []
        for i, stretch in enumerate(stretches):
            cut = [stretch] if len(stretch) == 1 else self._parts(stretch)
            if max(map(len, cut)) > LONGEST:
                totals[i] = -1
                continue
            parts += cut
            owner += [i] * len(cut)
        if parts:
            np.add.at(totals, np.array(owner), self._merge(parts))
        return totals.tolist()

    def _merge(self, parts: list[str]) -> np.ndarray:
        number = self.number
        symbols = np.array([number[c] for p in parts for c in p], np.int32)
        sequence = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p) for p in parts])
        counts = np.zeros(len(parts), np.int64)
        rank, product = np.full(len(symbols), NEVER, np.int32), np.zeros(len(symbols), np.int32)
        inner = np.flatnonzero(sequence[:-1] == sequence[1:])
        rank[inner], product[inner] = self._pairs(symbols[inner], symbols[inner + 1])
        while len(symbols):
            first = np.flatnonzero(np.concatenate(([True], sequence[1:] != sequence[:-1])))
            sizes = np.diff(np.append(first, len(symbols)))
            best = np.minimum.reduceat(rank, first)
            done = best == NEVER
            if done.any():
                over = np.repeat(done, sizes)
                np.add.at(counts, sequence[over], self.tokens[symbols[over]])
                keep = ~over
                symbols, sequence, rank, product = symbols[keep], sequence[keep], rank[keep], product[keep]
                best, sizes = best[~done], sizes[~done]
                if not len(symbols):
                    break
            best = np.repeat(best, sizes)
            places = np.flatnonzero(rank == best)
            new = np.concatenate(([True], sequence[places[1:]] != sequence[places[:-1]]))
            # of places that overlap, every other one from the left
            run = new | np.concatenate(([True], np.diff(places) != 1))
            head = places[np.maximum.accumulate(np.where(run, np.arange(len(places)), 0))]
            places = places[np.where(self.eager[rank[places]], new, (places - head) % 2 == 0)]
            symbols[places] = product[places]
            keep = np.ones(len(symbols), bool)
            keep[places + 1] = False
            at = np.cumsum(keep)[places] - 1
            symbols, sequence, rank, product = symbols[keep], sequence[keep], rank[keep], product[keep]
            changed = np.unique(np.concatenate((at, at[at > 0] - 1)))
            last = np.append(sequence[1:] != sequence[:-1], True)
            ends = changed[last[changed]]
            rank[ends] = NEVER
            changed = changed[~last[changed]]
            rank[changed], product[changed] = self._pairs(symbols[changed], symbols[changed + 1])
        return counts


class Counts:
    """Token counts of texts, pre-token by pre-token."""

    def __init__(self, path: str):
        self.merges = on_shelf(f"merges:{path}", lambda: Merges(path))
        self.memo = on_shelf(f"counts:{path}", lambda: Memo(MEMO_ROOM))
        self.others = on_shelf(f"others:{path}", dict)

    def of(self, texts: list[str]) -> list[int]:
        merges = self.merges
        split = [merges.stretch.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        counts = self.memo.of(set().union(*split), merges.count)
        out = []
        for text, stretches in zip(texts, split, strict=True):
            each = list(map(counts.__getitem__, stretches))
            if -1 in each:
                out.append(len(merges.library.encode(text, num_threads=1)))
            else:
                out.append(sum(each) + self._alone(text, stretches))
        return out

    def _alone(self, text: str, stretches: list[str]) -> int:
        """Tokens of the characters that join with nothing: one each, or one per byte for those that are no piece."""
        if not text or sum(map(len, stretches)) == len(text) + 1:
            return 0
        total = 0
        for char, times in Counter(text).items():
            if char != " " and char not in self.merges.joined:
                if char not in self.others:
                    self.others[char] = 1 if char in self.merges.single else len(char.encode())
                total += times * self.others[char]
        return total


def count_tokens(docs: DataFrame, vocabulary: str | Callable[[], str], limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row. Narrow: nothing is shuffled."""
    bounded_batches(docs.sparkSession)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = Counts(located(vocabulary))
        for lot in lots(batches, ["doc_id", "text", "n_bytes"], lambda row: len(row[1]), LOT):
            ids, texts, sizes = zip(*lot, strict=True)
            yield pd.DataFrame({"doc_id": longs(ids), "n_bytes": sizes, "n_tokens": counts.of(list(texts))})

    rows = docs_of(docs, id_col, text_col).select(F.col("doc_id").cast("string"), "text", F.octet_length("text").cast("long").alias("n_bytes"))
    out = rows.mapInPandas(counted, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
