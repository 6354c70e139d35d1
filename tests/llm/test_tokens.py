"""Token alignment, token counts and ranked search against plain loops and the libraries themselves."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import DATA
from oracle import compare, connect
from pyspark.sql import functions as F

from tidemark.llm import alignment, search, tokencount
from tidemark.llm import queries as q

from .conftest import prose

A, B = q.public("byte_bpe_50k.json"), q.public("piece_bpe_32k.model")
ODD = ["", " ", "a", "  a\n\n b", "<s>x</s> <unk><|endoftext|>", "▁▁ a", " " * 700, " " * 200 + "word" + " " * 99, "\t\t\tx\u0000y 梦é́\U0001f600",
       "x" * 9000, "ret" * 300, "a" * 3000, "=" * 5000 + "abc", "don't  THE\r\nthe 1234567 café"]


@pytest.fixture(scope="module")
def odd(spark, tricky):
    rows = [(1000 + i, t) for i, t in enumerate(ODD)] + [(1000, "one more with this id"), (2000, "word " * 600_000 + "一" * 1_000_000)]
    return tricky.select("doc_id", "text", "size").unionByName(spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit("x")))


# ---- token counts

def test_counts_equal_the_library(spark, odd, nothing):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=B())
    text = {}
    for r in odd.collect():
        text.setdefault(r.doc_id, []).append(r.text or "")
    got = tokencount.count_tokens(odd, B).collect()
    want = sorted((str(i), len(t.encode()), len(library.encode(t)), len(library.encode(t)) > 4096) for i, ts in text.items() for t in ts)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert tokencount.count_tokens(nothing, B).count() == 0
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in q.op12_tokencount(spark, DATA).collect():
        assert r.n_tokens == len(library.encode(docs[r.doc_id])) and r.n_bytes == len(docs[r.doc_id].encode())


def test_counts_of_random_texts():
    counts, rng = tokencount.Counts(B()), random.Random(5)
    kinds = ["abcdefghijklmnopqrstuvwxyz", "ab etino ", " ▁ a", "retnymhou", "\n\t .,-=<>/0123456789", "".join(map(chr, range(0xa0, 0x600))), "一梦ゼ벨အ\U0001f600 x"]
    texts = ["".join(rng.choice(k) for _ in range(rng.choice([1, 7, 60, 900]))) for k in kinds for _ in range(40)]
    texts += [" " * n + "the" + " " * (n * 7 % 40) for n in range(150)]
    assert counts.of(texts) == [len(x) for x in counts.merges.library.encode(texts)]


def test_memo_keeps_what_is_in_use():
    from tidemark.llm.common import Memo
    memo, learned = Memo(20), Counter()

    def learn(keys):
        learned.update(keys)
        return [k * 2 for k in keys]

    for start in range(0, 300, 5):
        keys = {0, 1, *range(start, start + 5)}
        held = memo.of(keys, learn)
        assert all(held[k] == k * 2 for k in keys)
        assert len(memo.young) + len(memo.old) <= 30
    assert learned[0] == learned[1] == 1 and max(learned.values()) == 1
    assert memo.of(set(range(100)), learn)[99] == 198  # one call may need more than the room


# ---- alignment

def plain_alignment(text):
    """Groups by brute force: the sets of ends."""
    both = alignment.tokens(A, B)
    if not text:
        return None
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    xs, ys = [both.bytes_a[i] for i in a], [both.bytes_b[i] for i in b]
    if b"".join(xs) != (" " + text).encode() or b"".join(ys) != (" " + text).encode():
        return None
    ends_a, ends_b = np.cumsum([len(x) for x in xs]).tolist(), np.cumsum([len(y) for y in ys]).tolist()
    groups, links, i, j = [], [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        to_a, to_b = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append((a[i:to_a], b[j:to_b]))
        links.append((a[to_a - 1], b[to_b - 1]))
        i, j = to_a, to_b
    return a, b, ends_a, ends_b, groups, links


def plain_report(rows):
    found = [(i, plain_alignment(t)) for i, t in rows]
    count = Counter(link for _, f in found if f for link in f[5])
    highest = {}
    for (_, b), n in count.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in f[4])
        out.append((i, len(f[0]), len(f[1]), len(f[4]), len(f[5]), sum(count[k] == highest[k[1]] for k in f[5]), sum(count[k] for k in f[5]),
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(map(str, out))


def shown(df):
    return sorted(str(tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))) for r in df.collect())


@pytest.mark.parametrize("broadcast", [True, False])
def test_report_equals_plain_loops(spark, odd, nothing, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(alignment, "BROADCAST_PAIRS", 0)
    monkeypatch.setattr(alignment, "LOT", 3000)
    small = odd.where("doc_id is null or doc_id <> 2000")
    rows = [(r.doc_id, r.text) for r in small.collect()]
    assert shown(alignment.link_report(small, A, B)) == plain_report(rows)
    assert alignment.link_report(nothing, A, B).count() == 0
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert shown(q.op11_alignment(spark, DATA)) == plain_report(rows)


def test_overlap_ranges(spark, odd):
    for r in alignment.align(odd.where("doc_id is null or doc_id <> 2000"), A, B).collect():
        text = None if r.doc_id != 1 else prose(1, 60)
        if not r.a_ids:
            continue
        both = alignment.tokens(A, B)
        ends_a, ends_b = (np.cumsum([len(t[i]) for i in ids]).tolist() for t, ids in ((both.bytes_a, r.a_ids), (both.bytes_b, r.b_ids)))
        short, long = (ends_a, ends_b) if r.shorter == "a" else (ends_b, ends_a)
        assert len(short) <= len(long)
        if len(short) < 500:
            for k, (first, last) in enumerate(zip(r["first"], r["last"], strict=True)):
                start = short[k - 1] if k else 0
                over = [i for i, e in enumerate(long) if e > start and (long[i - 1] if i else 0) < short[k]]
                assert (first, last) == (over[0], over[-1])
        assert [ends_a[i - 1] for i in r.a_ends] == [ends_b[i - 1] for i in r.b_ends] == sorted(set(ends_a) & set(ends_b))
        if text:
            assert r.a_ids == both.a.encode(" " + text, add_special_tokens=False).ids


def test_one_very_long_text_aligns(spark, odd):
    r = alignment.link_report(odd.where("doc_id = 2000"), A, B).first()
    assert r.n_b >= 1_600_000 and r.n_groups > 600_000 and r.count_sum > 600_000 ** 2


def test_gallop_finds_every_place():
    rng = np.random.default_rng(2)
    for _ in range(50):
        longer = np.unique(rng.integers(0, 400, rng.integers(1, 200)))
        values = np.unique(np.append(rng.integers(0, longer[-1] + 1, 40), longer[-1]))
        n = len(values)
        got = alignment.gallop(values, longer, np.zeros(n, np.int64), np.full(n, len(longer)), rng.integers(0, len(longer), n))
        assert got.tolist() == np.searchsorted(longer, values).tolist()


def test_rank_order_gives_the_tokenizers_ids(spark):
    both, rng = alignment.tokens(A, B), random.Random(8)
    assert both.fast is not None
    kinds = ["abcdefghij ", " \n\t\r", "aé1² '", "'srevmldt ", "".join(map(chr, range(0x20, 0x180))), "a \xa0\x85\x1c\x0b梦٣\U0001f600"]
    texts = ["".join(rng.choice(k) for _ in range(rng.choice([1, 7, 60, 900]))) for k in kinds for _ in range(60)] + ODD[1:]
    texts += [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").where("text is not null").collect()]
    assert both.ids_of_a(texts) == [e.ids for e in both.a.encode_batch(texts, add_special_tokens=False)]


# ---- search

def plain_search(docs, items, k):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(i, Counter(cut(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        if t is not None:
            asked.setdefault(i, set()).update(cut(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(map(str, out))


@pytest.mark.parametrize("blocks", [True, False])
def test_search_equals_plain_loops(spark, odd, nothing, monkeypatch, blocks):
    """Ties, repeats, missing ids, items without terms and items sharing an id; blocks of few postings and few item bytes."""
    if blocks:
        monkeypatch.setattr(search, "BLOCK_POSTINGS", 7)
        monkeypatch.setattr(search, "ITEM_BYTES", 40)
        monkeypatch.setattr(search, "ROUNDS", 3)
    words = [f"w{i}" for i in range(12)]
    rng = random.Random(4)
    docs = [(i if i % 11 else None, " ".join(rng.choice(words[: 2 + i % 11]) for _ in range(i % 9))) for i in range(160)]
    docs += [(r.doc_id, r.text) for r in odd.where("doc_id is null or doc_id <> 2000").collect()]
    items = [(1, "w0 W1 w2 w2"), (2, "w11 w0 w1 w2 w3 w4 w5 w6"), (3, None), (4, "..."), (5, "unheard-of"), (6, prose(7, 30)), (6, "w3"), (None, "the one CAFÉ café x"),
             (7, " ".join(words))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit("x")).withColumn("part", F.lit(1)).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(0))
    for k in (1, 3, 10):
        got = search.search(frame, asked, k)
        assert sorted(str((r.item_id, r["rank"], r.doc_id, r.score)) for r in got.collect()) == plain_search(docs, items, k)
    assert search.search(nothing, asked).count() == 0 and search.search(frame, asked.where("false")).count() == 0


def test_accumulators_stop_growing():
    """A frequent term after rare ones only continues what is there; without the bound it would open all."""
    places = np.concatenate([np.arange(12), np.arange(1000)])
    terms = np.concatenate([np.zeros(12, np.int64), np.ones(1000, np.int64)])
    gains = np.concatenate([np.arange(100, 112), np.full(1000, 5)])
    block, opened = search.Block(list(range(1000)), places, terms, gains), []

    class Watched(np.ndarray):
        def __setitem__(self, at, value):
            if value is True:
                opened.extend(np.asarray(at).tolist())
            super().__setitem__(at, value)

    block.held = block.held.view(Watched)
    assert [s for _, s in block.best([0, 1], 10)] == [x + 5 for x in range(111, 101, -1)]
    assert sorted(opened) == list(range(12))
    assert not block.held.any() and not block.scores.any()
    opened.clear()
    assert len(block.best([0, 1], 13)) == 13 and len(opened) == 1000


def test_search_matches_sql(spark):
    con = connect(DATA)
    assert compare(q.op13_search(spark, DATA), con, q.ORACLE["op13_search"]) is None
