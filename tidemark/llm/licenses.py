"""License scans by conditional compression.

Around every mention of licensing a narrow and a wide block of words are cut, across line breaks and whatever marks start the lines. Each block is
compressed alone and with every template as a raw zstandard dictionary; the templates that make it smaller are ranked by the reduction. In that
order each is confirmed by exact wording: a stretch of the block that holds a mention and differs from one of the template's notices in few words, none
of them a word that tells licenses apart (a license's name, a version). Of overlapping stretches the closest stays. A mention without a confirmed
notice is explained, unconfirmed, by the template that makes its block smallest, if it saves enough.

Defined cases: null and empty texts have no candidate; a text is read whole however long it or its lines are; a notice over several lines counts at its
first; a line has one row per license; ties in the word difference go to the longer notice, the larger reduction, then the template's name; repeated
rows give their rows again; a null id stays null; other columns are not read, so none can clash; an empty table gives no row.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, docs_of, longs

#: A text is a candidate if it holds one of these, in any case; every notice holds one.
MENTIONS = (r"(?i)licen[cs]|copyright|©|all rights reserved|public domain|warranty|creative commons|cc[ -]by|redistribut|prior written permission"
            r"|is hereby granted")
MENTION = re.compile(MENTIONS, re.ASCII)
LEVEL, MIN_SAVING, MAX_DIFFERENCE = 19, 0.35, 0.25
#: Words on both sides of a mention in its narrow block; the wide one reaches as far as the longest notice.
NARROW = 12

#: Words that tell licenses apart, besides numbers (fixed values: parts of license names).
NAMES = frozenset(
    "academic affero apache artistic attribution attribution-noncommercial attribution-noncommercial-noderivatives"
    " attribution-noncommercial-sharealike attribution-noderivatives attribution-sharealike boost bsd bsd-2-clause bsd-3-clause by by-nc by-nc-nd"
    " by-nc-sa by-nd by-sa 2-clause 3-clause 4-clause cc cc0 cddl cecill clear creative eclipse epl eupl expat free gfdl gpl agpl isc lesser lgpl library"
    " microsoft mit modified mozilla mpl new noderivatives noncommercial odbl ofl open php postgresql python revised ruby sharealike simplified sleepycat sspl"
    " unlicense w3c wtfpl x11 zlib zpl".split())


def creative_commons() -> dict[str, tuple[str, ...]]:
    """The notices of the Creative Commons licenses, by their naming rule."""
    parts = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
    out = {}
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        for version, scope in (("4.0", "International"), ("3.0", "Unported")):
            name = "-".join(parts[p] for p in kind.split("-"))
            out[f"CC-{kind}-{version}"] = (f"Licensed under CC {kind} {version}.",
                                           f"This work is licensed under a Creative Commons {name} {version} {scope} License.")
    return out


def gnu(kind: str, thing: str, version: str, old: bool = False) -> tuple[str, ...]:
    """The notices of a GNU license; those of version 2 set semicolons."""
    a, b = (";", ";") if old else (":", ",")
    return (f"This work is licensed under the GNU {kind}General Public License, version {version}.",
            f"This {thing} is free software{a} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as"
            f" published by the Free Software Foundation{b} either version {version} of the License, or (at your option) any later version.")


#: Notices of common licenses (fixed values: the wording of each license's own notice).
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
        " files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use,"
        " copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
        " Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\""
        " BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "GPL-3.0": gnu("", "program", "3"),
    "GPL-2.0": gnu("", "program", "2", old=True),
    "LGPL-3.0": gnu("Lesser ", "library", "3"),
    "LGPL-2.1": gnu("Lesser ", "library", "2.1", old=True),
    "AGPL-3.0": gnu("Affero ", "program", "3"),
    "BSD-2-Clause": ("Released under the 2-Clause BSD License.", "Released under the Simplified BSD License."),
    "BSD-3-Clause": (
        "Released under the BSD License.",
        "Released under the 3-Clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
        " conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this"
        " software without specific prior written permission.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that"
        " the above copyright notice and this permission notice appear in all copies.",
    ),
    "Zlib": (
        "Released under the zlib License.",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any"
        " damages arising from the use of this software.",
    ),
    "EPL-2.0": (
        "Licensed under the Eclipse Public License 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    ),
    "BSL-1.0": ("Distributed under the Boost Software License, Version 1.0.",),
    "Unlicense": ("Released under the Unlicense.", "This is free and unencumbered software released into the public domain."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License, Version 2.0."),
    **creative_commons(),
    "CC0-1.0": ("This work is dedicated to the public domain under CC0 1.0.",),
    "Proprietary": ("All rights reserved.", "No part of this publication may be reproduced without prior written permission."),
}
WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
NUMBER = re.compile(r"v?(\d+(?:\.\d+)*?)(?:\.0)*")


def token(word: str) -> str:
    """A word as it is compared: lower case; ``v2.0``, ``2.0`` and ``2`` are one."""
    word = word.lower()
    number = NUMBER.fullmatch(word)
    return number[1] if number else word


class Notice:
    """The words of a notice, and which words may not differ: names where it holds one, and numbers where it holds one."""

    def __init__(self, text: str):
        self.words = [token(w) for w in WORD.findall(text)]
        self.counts = Counter(self.words)
        self.slack = int(MAX_DIFFERENCE * len(self.words))
        self.least, self.room = len(self.words) - self.slack, len(self.words) + self.slack
        self.numbered = any(w[0].isdigit() for w in self.words)
        self.named = any(w in NAMES for w in self.words)
        self.telling = sum(map(self.tells, self.words))

    def tells(self, word: str | None) -> bool:
        return bool(word) and (self.numbered and word[0].isdigit() or self.named and word in NAMES)

    def difference(self, words: tuple[str | None, ...]) -> tuple[int, int, int, bool]:
        """Words to change between the notice and the closest stretch of ``words`` from their first common word on, that stretch's bounds, and
        whether all words that tell licenses apart agree. Stretches where they do come first."""
        inside = [m for m in SequenceMatcher(None, self.words, words, autojunk=False).get_matching_blocks() if m.size]
        best, common, told = (True, len(self.words), 0), 0, 0
        for m in inside:
            common += m.size
            told += sum(map(self.tells, self.words[m.a:m.a + m.size]))
            end = m.b + m.size
            alike = told == self.telling == sum(map(self.tells, words[inside[0].b:end]))
            # words of the stretch between its first and last common word, or the notice's, whichever is more
            changed = max(len(self.words), end - inside[0].b) - common
            if (not alike, changed) < (not best[0], best[1]):
                best = (not alike, changed, end)
        return best[1], inside[0].b if inside else 0, best[2], not best[0]

    def stretches(self, block: tuple[str, ...]) -> list[tuple[int, int, int]]:
        """(start, end, changed) of the stretches of a block that confirm the notice."""
        mine = [i for i, w in enumerate(block) if w in self.counts]
        found = []
        for x in range(len(mine) - self.least + 1):
            first = mine[x]
            # a confirmed stretch holds so many words of the notice in so little room
            if mine[x + self.least - 1] - first >= self.room:
                continue
            near = block[first:first + self.room]
            if (Counter(near) & self.counts).total() < self.least:
                continue
            # words that are neither the notice's own nor telling are all alike to it
            changed, start, end, alike = self.difference(tuple(w if w in self.counts or self.tells(w) else None for w in near))
            if alike and changed <= self.slack:
                found.append((first + start, first + end, changed))
        return found


class Scanner:
    """Judges texts against the templates."""

    def __init__(self, templates: dict[str, tuple[str, ...]] = TEMPLATES):
        import zstandard

        self.alone = zstandard.ZstdCompressor(level=LEVEL)
        self.notices = {name: [Notice(n) for n in notices] for name, notices in templates.items()}
        self.with_template = {}
        for name, notices in self.notices.items():
            raw = zstandard.ZstdCompressionDict("\n".join(" ".join(n.words) for n in notices).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            self.with_template[name] = zstandard.ZstdCompressor(dict_data=raw)
        self.wide = max((n.room for notices in self.notices.values() for n in notices), default=NARROW)
        self.ranked = lru_cache(maxsize=20_000)(self.rank)
        self.confirmed = lru_cache(maxsize=20_000)(self.confirm)

    def rank(self, block: tuple[str, ...]) -> list[tuple[str, int, int, float]]:
        """(license, plain, given, saving) of all templates that make a block smaller, the largest reduction first."""
        data = " ".join(block).encode("utf-8", "surrogatepass")
        plain = len(self.alone.compress(data))
        sizes = [(len(by.compress(data)), name) for name, by in self.with_template.items()]
        return [(name, plain, given, 1 - given / plain) for given, name in sorted(sizes) if given < plain]

    def confirm(self, block: tuple[str, ...]) -> list[tuple]:
        """(start, end, license, plain, given, saving, changed, of) of the stretches of a block that confirm a template it ranks."""
        return [(lo, hi, name, plain, given, saving, changed, len(n.words)) for name, plain, given, saving in self.ranked(block)
                for n in self.notices[name] for lo, hi, changed in n.stretches(block)]

    def _nearest(self, block: tuple[str, ...], name: str) -> tuple[int, int]:
        got = [(n.difference(block)[0], len(n.words)) for n in self.notices[name]]
        return min(got, key=lambda g: (g[0] / g[1], g[0]))

    def judge(self, text: str) -> list[tuple]:
        """Rows (line_no, license, saving, plain, given, changed, of, confirmed, line) of a text: its confirmed notices, and the blocks around other
        mentions that a template makes much smaller. A line has one row per license."""
        spans = [(m.start(), m.end()) for m in WORD.finditer(text)]
        starts = [lo for lo, _ in spans]
        words = [token(text[lo:hi]) for lo, hi in spans]
        # the first word that a mention touches
        mentions = sorted({min(max(bisect_right(starts, m.start()) - 1, 0) + (m.group() == "©"), len(spans) - 1) for m in MENTION.finditer(text)}) if spans else []
        blocks = {n: [block_at(n, radius, len(words)) for radius in (NARROW, self.wide)] for n in mentions}
        found = set()
        for lo, hi in {b for two in blocks.values() for b in two}:
            for x, y, name, plain, given, saving, changed, of in self.confirmed(tuple(words[lo:hi])):
                if bisect_left(mentions, lo + x) < bisect_left(mentions, lo + y):
                    found.add((changed / of, -of, -saving, name, lo + x, lo + y, plain, given, changed))
        used = bytearray(len(words))
        taken = []
        for rank in sorted(found):
            lo, hi = rank[4:6]
            if not any(used[lo:hi]):
                used[lo:hi] = b"\1" * (hi - lo)
                taken.append(rank)

        breaks = [-1, *[m.start() for m in re.finditer("\n", text)], len(text)]
        rows: dict[tuple[int, str], tuple] = {}

        def put(lo: int, hi: int, name: str, saving: float, plain: int, given: int, changed: int, of: int, sure: bool) -> None:
            first, last = spans[lo][0], spans[hi - 1][1]
            key = (bisect_left(breaks, first) - 1, name)
            if key not in rows or (not sure, changed / of, -of) < (not rows[key][7], rows[key][5] / rows[key][6], -rows[key][6]):
                rows[key] = (*key, saving, plain, given, changed, of, sure, lines_of(breaks, first, last))

        for _, of, saving, name, lo, hi, plain, given, changed in taken:
            put(lo, hi, name, -saving, plain, given, changed, -of, True)
        explained = sorted((lo, hi) for _, _, _, _, lo, hi, *_ in taken)
        for n in mentions:
            at = bisect_right(explained, (n, len(words)))
            # a confirmed notice explains the mentions in it and in the words beside it
            before = explained[at - 1][1] if at else -NARROW
            after = explained[at][0] if at < len(explained) else len(words) + NARROW
            if n < before + NARROW // 2 or n >= after - NARROW // 2:
                continue
            best = None
            for lo, hi in blocks[n]:
                # what is confirmed speaks for itself only
                lo, hi = max(lo, before), min(hi, after)
                for name, plain, given, saving in self.ranked(tuple(words[lo:hi]))[:1]:
                    if saving >= MIN_SAVING and (best is None or saving > best[0]):
                        best = (saving, name, plain, given, lo, hi)
            if best:
                saving, name, plain, given, lo, hi = best
                changed, of = self._nearest(tuple(words[lo:hi]), name)
                put(n, n + 1, name, saving, plain, given, changed, of, False)
        return [(*rows[k][:-1], text[slice(*rows[k][-1])]) for k in sorted(rows)]


def lines_of(breaks: list[int], lo: int, hi: int) -> tuple[int, int]:
    """Bounds of the whole lines that hold a stretch."""
    return breaks[bisect_left(breaks, lo) - 1] + 1, breaks[bisect_left(breaks, hi)]


def block_at(n: int, radius: int, size: int) -> tuple[int, int]:
    """The words around a mention; mentions close together share a block that reaches as far around each of them."""
    step = max(radius // 2, 1)
    first = n - n % step
    return max(first - radius, 0), min(first + step + radius, size)


SCHEMA = ("doc_id long, line_no int, license string, saving double, plain_bytes int, given_bytes int, changed_words int, template_words int,"
          " confirmed boolean, line string")


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line and license that explains it: doc_id, line_no (from 0, of the first line), license, saving, sizes, word difference, confirmed, lines."""
    bounded_batches(docs.sparkSession)
    texts = docs_of(docs, id_col, text_col).where(F.col("text").rlike(MENTIONS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(templates)
        for batch in batches:
            out = [(doc_id, *row) for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True) for row in scanner.judge(text)]
            if out:
                yield pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")]).assign(doc_id=longs(r[0] for r in out))

    return texts.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, SCHEMA)
