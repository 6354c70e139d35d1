"""Packing documents into fixed windows: bounded-space, best-fit, online.

Each task reads its documents as a stream and keeps ``OPEN`` windows open. A piece goes into the window whose free room
it fills best. When none has room, the fullest window is closed: if its gap is at least ``MIN_PIECE`` tokens, the piece's head
fills it first, otherwise the gap becomes padding. Windows still open at a task's end are leftovers: they carry their
ids to a merge, where groups of tasks' leftovers are packed alike, in rounds, until one group is left.

Defined cases: null and empty texts are one end token; equal documents and repeated ids are packed one by one; a
document longer than a window is cut at window borders; an empty table gives no sequence.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tidemark.llm.common import Recalled, byte_letters, docs_of, located, longs, materialize, on_shelf, bounded_batches

WINDOW, END, OPEN, MIN_PIECE = 2048, 1, 32, 32
#: Tasks whose leftovers one merge task takes, so that it holds at most FAN_IN x OPEN windows.
FAN_IN = 64
#: Words whose ids a worker remembers, and as many pieces of words; beyond that it forgets those not met lately.
MEMO_ROOM = 1_000_000
#: Characters of text tokenized at a time.
LOT = 1_000_000

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
          " open int, ids binary")


class WordIds:
    """Token ids of texts. This vocabulary's tokenizer splits a text at white space and then into letters, digits and signs
    before all else, so each such piece is encoded once, by the tokenizer itself, and remembered, as are the words made
    of them, for the worker's life. Texts with characters on which two Unicode libraries could differ, or
    with a special token's beginning, are encoded whole."""

    PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
    UNSURE = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u017f\u2010-\u2027\u2030-\u205e\u20ac]|<\|")

    def __init__(self, path: str, room: int | None = None):
        room = room or MEMO_ROOM
        # kept for the worker's life: tasks come and go, workers stay
        self.coder = on_shelf(f"coder:{path}", lambda: self._load(path))
        self.letters = byte_letters()
        self.pieces = on_shelf(f"pieces:{path}:{room}", lambda: Recalled(room, self._piece))
        self.words = on_shelf(f"words:{path}:{room}", lambda: Recalled(room, self._word))

    @staticmethod
    def _load(path: str):
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return Tokenizer.from_file(path)

    def _piece(self, piece: str) -> bytes:
        # pieces are lower case and composed already, so the tokenizer's model may have their bytes directly
        plain = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        return array("I", [t.id for t in self.coder.model.tokenize(plain)]).tobytes()

    def _word(self, word: str) -> bytes:
        parts = self.PIECE.findall(word)
        return self.pieces[parts[0]] if len(parts) == 1 else b"".join(map(self.pieces.__getitem__, parts))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        self.words.turn()
        self.pieces.turn()
        end, of = array("I", [END]).tobytes(), self.words.__getitem__
        return [np.array([*self.coder.encode(text, add_special_tokens=False).ids, END], "<u4") if self.UNSURE.search(text)
                else np.frombuffer(b"".join(map(of, text.lower().split())) + end, "<u4") for text in texts]


class Windows:
    """The open windows of one task. ``put`` places a piece and returns rows of windows that closed."""

    def __init__(self, base: int, keep: int = OPEN):
        self.base, self.keep, self.closed = base, keep, 0
        self.open: list[list] = []  # [used tokens, pieces]

    def put(self, doc_id, start: int, ids: np.ndarray, doc_tokens: int) -> Iterator[tuple]:
        while len(ids):
            if len(ids) >= WINDOW:
                yield from self._close([WINDOW, [(doc_id, start, ids[:WINDOW], doc_tokens)]])
                start, ids = start + WINDOW, ids[WINDOW:]
                continue
            fits = [w for w in self.open if w[0] + len(ids) <= WINDOW]
            if fits:
                into = max(fits, key=lambda w: w[0])
            elif len(self.open) < self.keep:
                into = [0, []]
                self.open.append(into)
            else:
                into = max(self.open, key=lambda w: w[0])
                room = WINDOW - into[0]
                if room >= MIN_PIECE:
                    into[1].append((doc_id, start, ids[:room], doc_tokens))
                    into[0], start, ids = WINDOW, start + room, ids[room:]
                self.open.remove(into)
                yield from self._close(into)
                continue
            into[1].append((doc_id, start, ids, doc_tokens))
            into[0] += len(ids)
            if into[0] == WINDOW:
                self.open.remove(into)
                yield from self._close(into)
            return

    def _close(self, window: list) -> Iterator[tuple]:
        yield from _rows(window, self.base + self.closed)
        self.closed += 1

    def rest(self) -> Iterator[tuple]:
        """Leftovers, marked with their number and carrying their ids."""
        for number, window in enumerate(self.open):
            yield from _rows(window, self.base + self.closed + number, number)

    def last(self) -> Iterator[tuple]:
        for window in self.open:
            yield from self._close(window)


def _rows(window: list, sequence: int, number: int | None = None) -> Iterator[tuple]:
    offset = 0
    for doc_id, start, ids, doc_tokens in window[1]:
        raw = ids.astype("<u4").tobytes()
        yield (doc_id, start, len(ids), zlib.crc32(raw), doc_tokens, sequence, offset, number, None if number is None else raw)
        offset += len(ids)


_NAMES = [c.split()[0] for c in PIECES.split(", ")]


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_NAMES).assign(doc_id=longs(r[0] for r in rows), open=pd.array([r[7] for r in rows], "Int32"))


def _lots(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[str]]]:
    ids, texts, room = [], [], LOT
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            ids.append(None if doc_id is None else int(doc_id))
            texts.append(text)
            room -= len(text)
            if room <= 0:
                yield ids, texts
                ids, texts, room = [], [], LOT
    if ids:
        yield ids, texts


def pack(docs: DataFrame, vocabulary: str | Callable[[], str], id_col: str = "doc_id", text_col: str = "text", memo_room: int | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece. ``memo_room`` bounds the words a worker remembers.

    The pieces and leftovers of the first pass are written once to the shared folder: a lost executor costs the
    tasks it ran. Sequence numbers are the writing task's number and a counter.
    """
    bounded_batches(docs.sparkSession)

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        windows, coder = Windows(TaskContext.get().partitionId() << 32), WordIds(located(vocabulary), memo_room)
        for ids, texts in _lots(batches):
            out: list[tuple] = []
            for doc_id, code in zip(ids, coder.encode(texts), strict=True):
                out += windows.put(doc_id, 0, code, len(code))
            if out:
                yield _frame(out)
        if rest := list(windows.rest()):
            yield _frame(rest)

    rows = docs_of(docs, id_col, text_col).select(F.col("doc_id").cast("string"), "text")
    stored = materialize(rows.mapInPandas(first, PIECES), "pack-0")
    done, rest = stored.where("open is null"), stored.where("open is not null")
    tasks = (rest.agg(F.max(_task())).first()[0] or 0) + 1
    round_ = 0
    while True:
        round_ += 1
        groups = -(-tasks // FAN_IN)
        final = groups == 1
        merged = _merge(rest, round_, final)
        if not final:
            merged = materialize(merged, f"pack-{round_}")
        done = done.unionByName(merged.where("open is null"))
        if final:
            return done.drop("open", "ids")
        rest, tasks = merged.where("open is not null"), groups


def _task():
    """Number of the task that wrote a row; at most 2 ** 20 tasks."""
    return F.shiftright("sequence_id", 32).bitwiseAND(F.lit((1 << 20) - 1))


def _merge(rest: DataFrame, round_: int, final: bool) -> DataFrame:
    """Leftovers of up to FAN_IN tasks into windows; those still open go on to the next round, or out in the last."""
    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        windows = Windows((round_ << 52) | (int(key[0]) << 32))
        group = group.sort_values(["sequence_id", "offset"], kind="stable")
        used = group.groupby("sequence_id")["length"].sum().sort_values(ascending=False, kind="stable")
        by_window = dict(tuple(group.groupby("sequence_id")))
        out: list[tuple] = []
        for sequence in used.index:
            for r in by_window[sequence].itertuples():
                out += windows.put(None if pd.isna(r.doc_id) else int(r.doc_id), r.start, np.frombuffer(r.ids, "<u4"), r.doc_tokens)
        out += windows.last() if final else windows.rest()
        return _frame(out)

    return rest.withColumn("group", F.floor(_task() / FAN_IN)).groupBy("group").applyInPandas(merge, PIECES)
