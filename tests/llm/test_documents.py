"""Fingerprints, line dedup, n-gram join and licenses against brute force, and their defined cases."""

import hashlib
import time
from collections import Counter
from random import Random

import numpy as np
from conftest import DATA
from pyspark.sql import functions as F

from tidemark.llm import licenses, linededup, ngramjoin, spotsigs
from tidemark.llm import queries as q

from .conftest import prose


def rows_of(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


# ---- fingerprints

def test_edits_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    order = [(r.doc_id, r.text or "") for r in docs.orderBy("doc_id").collect()]
    got = {r.doc_id: r for r in q.op1_spotsigs(spark, DATA).collect()}
    assert len(got) == len(order)
    for i, (doc_id, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (spotsigs.signatures(t) for t in (text, edited, following))
        assert (r.fingerprint, r.edited_fingerprint) == (spotsigs.encode(a), spotsigs.encode(b))
        for value, other in ((r.near_edited, b), (r.near_next, c)):
            x, y = set(a.tolist()), set(other.tolist())
            assert abs(value - (len(x & y) / len(x | y) if x | y else 1.0)) < 1e-12


def test_edits_on_tricky_rows(tricky, nothing):
    got = spotsigs.with_edits(tricky, blocks=3).collect()
    assert len(got) == tricky.count()
    by_text = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id in (3, 4):
            assert r.n_chars == 0 and r.fingerprint == ""
        by_text.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert by_text[1] == by_text[2] and len(by_text[7]) == 1
    assert spotsigs.with_edits(nothing).count() == 0
    alone = spotsigs.with_edits(tricky.where("doc_id = 1")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_an_id_of_many_rows_spans_runs(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "RUN_ROWS", 5)
    rows = [(None, prose(i, 12)) for i in range(40)] + [(None, "the same text twice")] * 30 + [(i, prose(100 + i, 9)) for i in range(10)] + [(4, prose(7, 5))] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    keyed = spotsigs._keyed(spotsigs.docs_of(df), 12)
    heads = spotsigs._heads(keyed, 12)
    assert sum(h[0] == spotsigs.MIN_KEY for h in heads) > 4                  # the rows without id lie in many runs
    got = spotsigs.with_edits(df, blocks=12).collect()
    assert len(got) == len(rows)
    # rows alike in id and text are interchangeable, so the order of texts is known, whatever the runs
    hashed = df.select("doc_id", "text", spotsigs.F.xxhash64("text").alias("h")).collect()
    order = [r.text for r in sorted(hashed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))]
    want = []
    for text, following in zip(order, order[1:] + order[:1], strict=True):
        half = len(text) // 2
        want.append(hashlib.sha256((text[:len(text) - half] + following[:half]).encode()).hexdigest())
    assert sorted(want) == sorted(r.edited_sha256 for r in got)


def test_near_pairs_against_all_pairs(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    prints = spotsigs.fingerprints(docs)
    one = {}
    for r in prints.where("n_signatures > 0").collect():
        one[r.fingerprint] = min(one.get(r.fingerprint, r.doc_id), r.doc_id)
    sets = sorted((i, set(spotsigs.decode(f).tolist())) for f, i in one.items())
    for bound in (0.75, 0.3):
        want = {(i, j) for n, (i, a) in enumerate(sets) for j, b in sets[n + 1:] if len(a & b) >= bound * len(a | b)}
        got = {(r.a, r.b) for r in spotsigs.near_pairs(prints, bound).collect()}
        assert got == want


# ---- n-gram join

def brute_components(rows):
    def shingles(text):
        words = (text or "").encode().lower().split()
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(i)] = min(low.get(find(i), doc_id), doc_id)
    return sorted(((doc_id, len(s), low.get(find(i)) if s else doc_id) for i, ((doc_id, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def test_ngram_join_against_all_pairs(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(ngramjoin.near_components(docs), "doc_id", "n_shingles", "component_id") == want


def test_ngram_join_on_chains_and_large_groups(spark):
    """Near copies of one text in a chain, each a partner of the next only; and blocks so small that shingles are common."""
    base = prose(3, 120).split()
    rows = []
    for step in range(40):
        words = list(base)
        for k in range(step):
            words[3 * k % 120] = f"edit{k}"
        rows += [(1000 - step, " ".join(words)), (2000 + step, " ".join(words[:100]))]
    rows += [(5000 + i, " ".join(base[:60]) + " " + prose(50 + i, 60)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for chars in (1500, 20_000, 2_000_000):
        assert rows_of(ngramjoin.near_components(docs, block_chars=chars), "doc_id", "n_shingles", "component_id") == brute_components(rows)


def test_ngram_join_on_tricky_rows(tricky, nothing):
    want = brute_components([(r.doc_id, r.text) for r in tricky.collect()])
    assert rows_of(ngramjoin.near_components(tricky), "doc_id", "n_shingles", "component_id") == want
    assert ngramjoin.near_components(nothing).count() == 0


def test_star_components(spark):
    edges = [(i, i + 1) for i in range(0, 200, 2)] + [(i, i + 2) for i in range(0, 100, 2)] + [(500, i) for i in range(501, 560)] + [(7000, 6000), (6000, 6500)]
    got = {r.node: r.comp for r in ngramjoin.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert got == {x: find(x) for x in root if find(x) != x}


def test_byte_planes_round_trip():
    values = np.array([0, 1, 255, 256, 1 << 47, (1 << 48) - 1], np.uint64)
    assert (ngramjoin.unsqueeze(ngramjoin.squeeze(values), np.uint64) == values).all()
    assert (ngramjoin._ungap(ngramjoin._gaps(values)) == values).all()


# ---- line dedup

def runs(lines, min_words):
    """All runs of lines with words that reach ``min_words``, as tuples."""
    real = [x.strip() for x in lines if x.split()]
    out = set()
    for i in range(len(real)):
        total = 0
        for j in range(i, len(real)):
            total += len(real[j].split())
            if total >= min_words:
                out.add(tuple(real[i:j + 1]))
                break
    return out


def test_line_dedup_leaves_no_shared_passage(spark):
    """What is cut stands in an earlier document, and no run of 50 words is left that an earlier original holds."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    got = {r.doc_id: r for r in q.op4_linededup(spark, DATA).collect()}
    assert sorted(got) == sorted(docs)
    earlier_runs, earlier_lines = set(), set()
    for doc_id in sorted(docs):
        lines = docs[doc_id].split("\n")
        cut = [int(x) for x in got[doc_id].cut_lines.split(",") if x]
        assert got[doc_id].text == "\n".join(x for i, x in enumerate(lines) if i not in cut)
        assert all(lines[i].strip() in earlier_lines for i in cut)
        own = runs(lines, 50)
        if not own & earlier_runs:
            assert not cut
        kept, piece = [], []
        for i, x in enumerate([*lines, None]):
            if x is None or i in cut:
                kept.append(piece)
                piece = []
            else:
                piece.append(x)
        assert not any(runs(p, 50) & earlier_runs for p in kept)
        earlier_runs |= own
        earlier_lines |= {x.strip() for x in lines}


def test_line_dedup_finds_moved_and_split_passages(spark):
    a, b, c = prose(1, 30), prose(2, 30), prose(3, 70)
    rows = [(1, "\n".join([a, b, "x", c])), (2, "\n".join([c, "own line", a, "", b])), (3, f"{a}\nother"), (4, f"{b}\n{a}"), (5, f"y\n{c}\nz")]
    out = {r.doc_id: r.text for r in linededup.dedupe(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: rows[0][1], 2: "own line\n", 3: rows[2][1], 4: rows[3][1], 5: "y\nz"}


def test_line_dedup_finds_passages_in_swapped_order():
    def cut(early, late):
        marks = [linededup.line_marks("\n".join(x)) for x in (early, late)]
        return linededup.common_lines(marks[0][0], *marks[1], 50)

    p, q2, short = prose(1, 60), prose(2, 55), ["one two", "three four"]
    assert cut([p, short[0]], [short[0], p]) == {1}
    assert cut([p, *short], [*short, p]) == {2}
    assert cut([p, *short, q2], [q2, "", *short, "own", p]) == {0, 5}
    assert cut([short[0], p], [p, "own", short[0]]) == {0} and cut([prose(3, 30), *short], [*short, prose(3, 30)]) == set()


def test_line_dedup_cuts_whole_blocks_of_any_earlier_document(spark):
    head, tail = prose(1, 60), prose(2, 40)
    rows = [(1, f"{head}\nx"), (2, f"{head}\n{tail}\ny"), (3, f"{head}\n{tail}\nz")]
    out = {r.doc_id: r.text for r in linededup.dedupe(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: rows[0][1], 2: f"{tail}\ny", 3: "z"}

    lines = [prose(20 + i, 1 + 9 * i % 31) for i in range(12)]
    order = np.random.default_rng(5)
    docs = [[lines[i] for i in order.integers(0, 12, 14)] for _ in range(12)]
    docs = [d + docs[i // 2][i % 5:i % 5 + 6] for i, d in enumerate(docs)]
    want = {}
    for n, doc in enumerate(docs):
        spans = [(i, j) for i in range(len(doc)) for j in range(i + 1, len(doc) + 1) if len(" ".join(doc[i:j]).split()) >= 50]
        held = {tuple(d[i:i + k]) for d in docs[:n] for i in range(len(d)) for k in range(1, len(doc) + 1)}
        want[n] = sorted({x for i, j in spans if tuple(doc[i:j]) in held for x in range(i, j)})
    got = linededup.dedupe(spark.createDataFrame([(n, "\n".join(d)) for n, d in enumerate(docs)], "doc_id long, text string"))
    assert {r.doc_id: r.cut_lines for r in got.collect()} == want and sum(map(bool, want.values())) > 5


def test_patience_blocks():
    assert linededup.patience([1, 2, 3, 9, 4, 5], [0, 1, 2, 3, 4, 5, 6]) == [(0, 1, 3), (4, 4, 2)]
    assert linededup.patience([1, 1, 2, 2], [2, 2, 1, 1]) in ([(0, 2, 2)], [(2, 0, 2)])
    assert linededup.patience([], [1]) == []


def test_line_dedup_on_tricky_rows(tricky, nothing):
    out = linededup.dedupe(tricky)
    assert out.columns == [*tricky.columns, "cut_lines"] and out.count() == tricky.count()
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[3] is None and texts[4] == "" and texts[10] == " \n\t " and texts[2] == ""
    assert texts[12] == prose(13, 300) and texts[11].endswith(prose(12, 60))
    assert linededup.dedupe(nothing).count() == 0


def test_line_dedup_shuffles_when_cuts_are_many(tricky, monkeypatch):
    want = rows_of(linededup.dedupe(tricky), "doc_id", "text")
    monkeypatch.setattr(linededup, "BROADCAST_DOCS", -1)
    assert rows_of(linededup.dedupe(tricky), "doc_id", "text") == want


def test_lines_of_two_kinds_in_turn_take_little_time():
    kinds = "alpha beta gamma delta epsilon", "one two three four five six"
    early = "\n".join(kinds[i % 2] for i in range(20_000))
    late = "\n".join(["a head of its own", *(kinds[(i + 1) % 2] for i in range(20_000)), "and a tail"])
    start = time.monotonic()
    got = linededup.common_lines(linededup.line_marks(early)[0], *linededup.line_marks(late), 50)
    assert got == set(range(1, 20_001)) and time.monotonic() - start < 10


def test_an_early_document_with_many_partners(spark, monkeypatch):
    shared = "\n".join(prose(50 + j, 12) for j in range(6))
    rows = [(i, f"{prose(100 + i, 9)}\n{shared}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = rows_of(linededup.dedupe(df), "doc_id", "text")
    monkeypatch.setattr(linededup, "PARTNERS", 4)
    assert rows_of(linededup.dedupe(df), "doc_id", "text") == want
    assert want[0][1] == rows[0][1] and all(text == rows[i][1].split("\n")[0] for i, text in want[1:])


# ---- licenses

def test_license_lines_are_found_and_only_those(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    fixed = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "All rights reserved.": "Proprietary",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    want = sorted((r.doc_id, i, fixed[x]) for r in docs.collect() for i, x in enumerate((r.text or "").split("\n")) if x in fixed)
    got = sorted((r.doc_id, r.line_no, r.license) for r in q.op2_licenses(spark, DATA).where("confirmed").collect())
    assert got == want


def test_license_wording(spark):
    lines = ["Licensed under CC BY 4.0.", "Licensed under CC BY-SA 4.0.", "licensed under the apache license version 2.0",
             "A license to fish is sold at the harbour office every morning before nine.", "words before. Released under the MIT License. " + prose(1, 400)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    got = {r.doc_id: (r.license, r.confirmed) for r in licenses.scan(df).collect()}
    assert got[0] == ("CC-BY-4.0", True) and got[1] == ("CC-BY-SA-4.0", True) and got[2] == ("Apache-2.0", True) and got[4] == ("MIT", True)
    assert not got.get(3, (None, False))[1]


def test_license_in_long_lines_and_all_of_a_line(spark):
    english = "The office of the harbour is open to any person who has the right to use, copy and sell this kind of fish without limitation. " * 80
    lines = [english + "Licensed under CC BY 4.0.", f"Released under the MIT License. {english} Licensed under CC BY-SA 4.0. {english} All rights reserved."]
    got = licenses.scan(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).where("confirmed")
    assert rows_of(got, "doc_id", "license") == [(0, "CC-BY-4.0"), (1, "CC-BY-SA-4.0"), (1, "MIT"), (1, "Proprietary")]


def test_license_notices_over_several_lines(spark):
    rows, want = [], []
    for name, notices in licenses.TEMPLATES.items():
        for notice in notices:
            if len(notice.split()) > 12:
                words = notice.split()
                of = len(licenses.WORD.findall(words[5]))
                words[5] = "changed"
                rows.append((len(rows), "\n".join([prose(1, 30), "", *(" * " + " ".join(words[i:i + 8]) for i in range(0, len(words), 8)), "", prose(2, 30)])))
                want.append((len(want), 2, name, of))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).where("confirmed")
    assert len(want) >= 6 and rows_of(got, "doc_id", "line_no", "license", "changed_words") == sorted(want, key=str)


def test_every_notice_is_found_alone(spark):
    rows = [(i, name, f"{prose(i, 40)}\n{notice}\n{prose(i + 500, 40)}")
            for i, (name, notice) in enumerate((name, n) for name, notices in licenses.TEMPLATES.items() for n in notices)]
    got = licenses.scan(spark.createDataFrame([(i, text) for i, _, text in rows], "doc_id long, text string"))
    assert rows_of(got, "doc_id", "line_no", "license", "changed_words", "confirmed") == sorted(((i, 1, name, 0, True) for i, name, _ in rows), key=str)


def test_another_name_or_version_confirms_nothing(spark):
    lines = ["Released under the Foo License.", "Licensed under CC BY 2.5.", "Licensed under CC BY-XX 4.0.", "Licensed under the EUPL License.",
             "Licensed under the Apache License, Version 1.1.", licenses.TEMPLATES["GPL-3.0"][1].replace("version 3", "version 4"),
             licenses.TEMPLATES["GPL-3.0"][1].replace("GNU General", "GNU Open General"), "Distributed under the Boost Software License, Version 2.0."]
    got = licenses.scan(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"))
    assert got.where("confirmed").count() == 0


def closest_by_brute_force(text):
    """The closest notice of all, over all stretches, by longest common subsequences and without compression: (license, changed words)."""
    words = [licenses.token(w) for w in licenses.WORD.findall(text)]
    found = []
    for name, notices in licenses.TEMPLATES.items():
        for notice in map(licenses.Notice, notices):
            telling = [w for w in notice.words if notice.tells(w)]
            for lo in range(len(words)):
                near = words[lo:lo + notice.room]
                if (Counter(near) & Counter(notice.words)).total() < notice.least:
                    continue
                before = [0] * (len(near) + 1)
                for w in notice.words:
                    now = [0]
                    for j, x in enumerate(near):
                        now.append(before[j] + 1 if w == x else max(before[j + 1], now[j]))
                    before = now
                for hi in range(1, len(near) + 1):
                    changed = max(len(notice.words), hi) - before[hi]
                    if changed <= notice.slack and [w for w in near[:hi] if notice.tells(w)] == telling:
                        found.append((changed / len(notice.words), -len(notice.words), name, changed))
    return min(found)[2:] if found else None


def test_licenses_against_brute_force(spark):
    random = Random(7)
    rows = []
    for name, notices in licenses.TEMPLATES.items():
        for notice in notices:
            words = notice.split()
            for _ in range(random.randrange(1, 1 + max(1, len(words) // 5))):
                at = random.randrange(len(words))
                words[at:at + 1] = random.choice([[], ["strange"], [words[at], "added"]])
            text = " ".join([prose(len(rows), 5), *words, prose(len(rows) + 500, 5)])
            if licenses.MENTION.search(" ".join(words)):
                rows.append((len(rows), text))
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).where("confirmed")
    found = {r.doc_id: (r.license, r.changed_words) for r in got.collect()}
    want = {i: best for i, text in rows if (best := closest_by_brute_force(text))}
    assert len(want) >= 20 and found == want


def test_license_on_tricky_rows(tricky, nothing):
    assert licenses.scan(tricky).count() == 0 and licenses.scan(nothing).count() == 0
    noted = tricky.withColumn("text", F.concat_ws("\n", "text", F.lit("All rights reserved.")))
    assert licenses.scan(noted).where("confirmed").count() == tricky.count()
