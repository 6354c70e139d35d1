"""Vectors, toxicity, packing, archives, mixing, url rules and the pipeline: brute force, round trips, held-out accuracy, SQL."""

import base64
import hashlib
import io
import zlib

import numpy as np
import pytest
from conftest import DATA
from oracle import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import mixing, packing, toxicity, urlfilter, vectors, warc
from tidemark.llm import queries as q
from tidemark.llm.common import materialize, without_ids

from .conftest import prose

LARGER = "/root/testdata/sf0.01"


# ---- vectors

def exact_nearest(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], float)
    out = {}
    for query in queries:
        d = np.sqrt(((points - points[np.flatnonzero(ids == query)[0]]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != query][:k]
        out[query] = [(int(ids[i]), d[i]) for i in order]
    return out


def test_nearest_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    want = exact_nearest(rows, [i for i, _ in rows if i % 100 == 0], 10)
    point = dict(rows)
    got = {}
    for r in q.op3_vectors(spark, DATA).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert abs(r.score - np.sqrt(((np.array(point[r.vec_id], float) - np.array(point[r.query_id], float)) ** 2).sum())) < 1e-12
    assert sorted(got) == sorted(want) and all(len(v) == 10 for v in got.values())
    assert np.mean([len({i for i, _ in got[x]} & {i for i, _ in want[x]}) / 10 for x in want]) >= 0.9


def test_nearest_exact_when_all_lists_are_probed(spark):
    """Copies, invalid vectors, ids missing; parts and blocks so small that every list is split."""
    rng = np.random.default_rng(3)
    good = [(i, rng.standard_normal(8).tolist()) for i in range(300)]
    good += [(i, good[0][1]) for i in range(300, 420)]
    bad = [(900, None), (1000, [0.0] * 8), (1100, [1.0, None] + [0.0] * 6), (1200, [float("nan")] * 8), (1300, [float("inf")] * 8), (1400, [1.0] * 5), (1500, []), (None, [1.0] * 8)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumn("cell", F.lit("x")).withColumn("v", F.lit(1))
    before = vectors.GROUP_VALUES, vectors.WIDTH
    vectors.GROUP_VALUES, vectors.WIDTH = 24, 20.0
    try:
        out = vectors.nearest(df, F.col("vec_id") % 100 == 0, probes=1.0).orderBy("query_id", "rank").collect()
    finally:
        vectors.GROUP_VALUES, vectors.WIDTH = before
    want = exact_nearest(good, [i for i, _ in good if i % 100 == 0], 10)
    got = {}
    for r in out:
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert {k: [i for i, _ in v] for k, v in got.items()} == {k: [i for i, _ in v] for k, v in want.items()}
    assert [i for i, _ in got[0]] == list(range(300, 310))
    few = spark.createDataFrame(good[:4], "vec_id long, embedding array<double>")
    assert vectors.nearest(few, F.col("vec_id") == 0).count() == 3
    assert vectors.nearest(df.where("false"), F.col("vec_id") == 0).count() == 0


def test_probes_follow_the_data(monkeypatch):
    """As many lists as hold the wanted share of the nearest: few where vectors cluster, many on a sphere."""
    rng = np.random.default_rng(5)
    middles = rng.standard_normal((20, 16)) * 20
    clustered = middles[rng.integers(0, 20, 2000)] + rng.standard_normal((2000, 16))
    sphere = rng.standard_normal((2000, 16))
    monkeypatch.setattr(vectors, "MATRIX_VALUES", 100_000)          # so that pieces are needed
    needed = []
    for points in (clustered, sphere):
        centres = vectors.fit_centres(points, 44)
        needed.append(vectors.probes_needed(points, centres, 10, 0.97))
        home, found = vectors.homes(points, centres), []
        for i in range(vectors.JUDGES):
            d = ((points - points[i]) ** 2).sum(1)
            d[i] = np.inf
            lists = ((centres - points[i]) ** 2).sum(1).argsort()[:needed[-1]]
            found.append(np.isin(home[d.argsort()[:10]], lists).mean())
        assert np.mean(found) >= 0.97 - 1e-9
    assert needed[0] <= 10 < needed[1]
    assert vectors.probes_needed(np.ones((1, 4)), np.ones((1, 4)), 10, 0.97) == 1


def test_recall_on_clusters_with_one_large_one(spark):
    rng = np.random.default_rng(9)
    middles = rng.standard_normal((30, 12)) * 10
    which = np.where(rng.random(3000) < 1 / 3, 0, rng.integers(0, 30, 3000))
    points = middles[which] + rng.standard_normal((3000, 12))
    rows = [(i, p) for i, p in enumerate(points.tolist())]
    got = {}
    for r in vectors.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = exact_nearest(rows, range(0, 3000, 50), 10)
    assert np.mean([len(got[x] & {i for i, _ in want[x]}) / 10 for x in want]) >= 0.9


# ---- toxicity

def test_toxicity_held_out(spark):
    """On the fold that the fit never saw."""
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    rows = q.op5_toxicity(spark, LARGER).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50
    clean = [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)
    toxic, scores = [r.score for r in rows if r.toxic], [r.score for r in clean]
    assert np.mean([(a > b) + (a == b) / 2 for a in toxic for b in scores]) > 0.8


def test_noisy_or_learns_from_documents_and_points_at_sentences(spark):
    texts, labels = [], []
    for i in range(240):
        sentences = [prose(1000 + 7 * i + k, 8) for k in range(6)]
        if i % 3 == 0:
            sentences[i % 6] += " grumblefoot" if i % 2 else " snarlkettles"
        texts.append(". ".join(sentences) + ".")
        labels.append(int(i % 3 == 0))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, y, 0) for i, y in enumerate(labels)], "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, marks)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(got[i].predicted == y for i, y in enumerate(labels))
    assert all(got[i].worst_sentence == i % 6 for i, y in enumerate(labels) if y)
    found = {(r.doc_id, r.sentence) for r in toxicity.offending(docs, model).collect()}
    assert found == {(i, i % 6) for i, y in enumerate(labels) if y}


def test_one_long_text_does_not_empty_the_sample(spark):
    """A text over the bound comes first in the order of the sample, one over a share of it second."""
    order = [r.id for r in spark.range(400).where(toxicity.crc_fold(F.col("id")) != 0).orderBy(F.xxhash64("id"), "id").collect()]
    docs = [(i, f"{prose(3000 + n, 12)} {'grumblefoot' if n % 3 == 0 else 'calm'}") for n, i in enumerate(order)]
    docs[0], docs[1] = (order[0], prose(1, 30_000)), (order[1], prose(2, 5000))
    marks = spark.createDataFrame([(i, int(n % 3 == 0)) for n, i in enumerate(order)], "doc_id long, toxic int")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert len(docs[0][1]) > 200_000 > len(docs[1][1]) + sum(len(t) for _, t in docs[2:])
    model = toxicity.train(frame, marks, chars=200_000)
    got = {r.doc_id: r.predicted for r in toxicity.score(frame, model).collect()}
    assert all(got[i] == int(n % 3 == 0) for n, i in enumerate(order) if n > 1)


def test_toxicity_on_tricky_rows(spark, tricky, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.train(tricky, none).weights == {} and toxicity.train(nothing, none).weights == {}
    model = toxicity.Model(-2.0, {"two": 4.0})
    got = {r.doc_id: r for r in toxicity.score(tricky, model).collect()}
    assert got[3].score == got[4].score == got[10].score == 0.0 and got[8].score == got[9].score > 0.8
    assert toxicity.score(tricky, model).count() == tricky.count() and toxicity.score(nothing, model).count() == 0
    odd = spark.createDataFrame([(1, None), (None, 1), (1, 1), (2, 0)], "doc_id long, toxic int")
    toxicity.train(tricky, odd)


# ---- packing

def check_pieces(rows, texts):
    coder = Tokenizer.from_file(q.vocabulary())
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    want = {}
    for doc_id, text in texts:
        want.setdefault(doc_id, []).append(np.array([*coder.encode(text or "", add_special_tokens=False).ids, 1], "<u4"))
    assert set(by_doc) == set(want)
    for doc_id, codes in want.items():
        assert sum(r.length for r in by_doc[doc_id]) == sum(map(len, codes))
        if len(codes) == 1:
            at = 0
            for r in sorted(by_doc[doc_id], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(codes[0])
                assert r.ids_crc32 == zlib.crc32(codes[0][at:at + r.length].tobytes())
                at += r.length
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= packing.WINDOW
    return sum(r.length for r in rows) / (packing.WINDOW * len(by_sequence))


def test_packing_round_trip(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").repartition(5)
    fill = check_pieces(q.packing.pack(docs, q.vocabulary()).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert fill > 0.97


def test_packing_merges_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 2)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").repartition(7)
    check_pieces(packing.pack(docs, q.vocabulary()).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_packing_on_tricky_rows(tricky, nothing):
    check_pieces(packing.pack(tricky, q.vocabulary()).collect(), [(r.doc_id, r.text) for r in tricky.collect()])
    assert packing.pack(nothing, q.vocabulary()).count() == 0


def test_word_ids_equal_the_tokenizer():
    coder = packing.WordIds(q.vocabulary())
    texts = ["It's NAÏVE\tcafé\n12345 'll ''s", "İstanbul ΣΑΣ ²½ a\x85b\x1cc", "x<|endoftext|>y", "é …“q”—z_1", "", "  "]
    for text, got in zip(texts, coder.encode(texts), strict=True):
        assert got.tolist() == [*coder.coder.encode(text, add_special_tokens=False).ids, 1]


# ---- archives

def sha(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def expected_records(pages):
    first = {}
    for page_id, body in pages:
        key = sha(body or "")
        order = (page_id is None, page_id)
        if key not in first or order < first[key]:
            first[key] = order
    out = []
    for page_id, body in pages:
        answer = first[sha(body or "")][1]
        again = page_id != answer
        out.append((page_id, len((body or "").encode()), sha(body or ""), "revisit" if again else "response", answer if again else None))
    return sorted(out, key=str)


def test_archive_round_trip(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()]
    got = q.op7_warc(spark, DATA)
    assert sorted(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str) == expected_records(pages)
    assert got.where("not intact").count() == 0


@pytest.mark.parametrize("few", [200_000, -1])
def test_archives_of_awkward_pages(spark, monkeypatch, few):
    monkeypatch.setattr(warc, "BROADCAST_REVISITS", few)
    rows = [(5, "http://a/ b\nc", "same"), (3, None, "same"), (9, "http://x", "same"), (3, "http://y", "same"), (1, "http://é/ü", "WARC/1.1\r\n\r\n\r\nfiledesc://x\n1 0\n"),
            (2, "", None), (4, "u", ""), (6, "u", "é€\r\n\r\nlast "), (7, "v", "big " * 200_000), (-8, "v", "neg"), (10, "w", "\n")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_id", F.lit(1)).withColumn("payload", F.lit("p"))
    got = warc.round_trip(df.repartition(3))
    assert sorted(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str) == expected_records([(i, b) for i, _, b in rows])
    assert got.where("not intact").count() == 0
    assert warc.round_trip(df.where("false")).count() == 0


def test_record_ids_agree_between_runs_and_are_unique(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    once = {(r.page_id, r.record_id) for r in warc.round_trip(pages).collect()}
    again = {(r.page_id, r.record_id) for r in warc.round_trip(pages.repartition(5)).collect()}
    assert once == again and len({i for _, i in once}) == len(once) == pages.count()


def test_repeated_rows_have_ids_of_their_own(spark):
    rows = [(1, "http://a", "x")] * 4 + [(3, "http://a", "x")] * 3 + [(None, "http://a", "x"), (None, "http://a", "x"), (5, "http://b", "y")]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert len(got) == 10 == len({r.record_id for r in got}) and all(r.intact for r in got)
    assert sorted(((r.page_id, r.record_type, r.refers_to) for r in got), key=str) == sorted(
        [(1, "response", None)] * 4 + [(3, "revisit", 1)] * 3 + [(None, "revisit", 1)] * 2 + [(5, "response", None)], key=str)


def test_arc_headers_of_both_versions():
    def block(version, line, body, about=None):
        about = about or f"{version} 0 o\n{warc.ARC_FIELDS[version]}\n"
        return f"filedesc://f.arc 0.0.0.0 19970101000000 text/plain {len(about)}\n{about}\n{line}\n{body}\n".encode()

    one = list(warc.read_arc(io.BytesIO(block(1, "http://a/x 1.2.3.4 19960923 text/html 5", "hello")), "f"))
    two = list(warc.read_arc(io.BytesIO(block(2, "http://a/x 1.2.3.4 19960923142103 text/html 200 - - 7 f.arc 5", "hello")), "f"))
    assert one[0]["block"] == two[0]["block"] == b"hello" and two[0]["Result-code"] == "200" and one[0]["URL"] == "http://a/x"
    cut = list(warc.read_arc(io.BytesIO(b"junk line\nhttp://a 1.1.1.1 1996 text/html 50\nshort"), "f"))
    assert len(cut) == 1 and cut[0]["truncated"] and cut[0]["block"] == b"short"
    assert warc.iso_date("19960923") == "1996-09-23T00:00:00Z" and warc.iso_date("19960923142103") == "1996-09-23T14:21:03Z"
    assert warc.split_http(b"HTTP/1.0 200 OK\nA: b\n\nrest") == (b"HTTP/1.0 200 OK\nA: b\n\n", b"rest")


def test_small_payloads_are_never_revisits(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    assert {r.page_id: r.refers_to for r in warc.round_trip(df, 3).collect()} == {1: None, 2: None, 3: None, 4: 3}


# ---- mixing

def fill_targets(sizes, weights, share, most):
    """Water filling, step by step."""
    total, target, free = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while True:
        rest = total - sum(most * sizes[i] for i in range(len(sizes)) if i not in free)
        weight = sum(weights[i] for i in free)
        for i in range(len(sizes)):
            target[i] = weights[i] * rest / weight if i in free else most * sizes[i]
        over = {i for i in free if target[i] > most * sizes[i]}
        if not over:
            return target
        free -= over
        if not free:
            return [most * s for s in sizes]


@pytest.mark.parametrize("name", ["op8_mixing", "op9_urlfilter"])
def test_native_queries_match_sql(spark, name):
    assert compare(q.QUERIES[name](spark, DATA), connect(DATA), q.ORACLE[name]) is None


@pytest.mark.parametrize("name", ["op8_mixing", "op9_urlfilter"])
def test_native_plans_hold_no_python(spark, name):
    plan = q.QUERIES[name](spark, DATA)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_targets_are_filled_like_water(spark):
    sizes = {"a": 1000, "b": 10, "c": 400, "d": 0, "e": 3, "\U0001f600": 50, "￮": 70, None: 90}
    docs = spark.createDataFrame([(i, s, "w " * n) for i, (s, n) in enumerate(sizes.items())], "doc_id long, source string, text string")
    got = {r.doc_id: r.target for r in mixing.mix_report(docs).collect()}
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = fill_targets([sizes[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5, 2.0)
    for i, s in enumerate(sizes):
        assert abs(got[i] - want[names.index(s)]) < 1e-6


def test_mix_comes_near_its_targets(spark):
    docs = spark.createDataFrame([(i, "abc"[i % 3] if i % 2 else "a", "word " * (1 + i % 9)) for i in range(20_000)], "doc_id long, source string, text string")
    report = mixing.mix_report(docs)
    assert report.where("taken > 2 * size").count() == 0
    sums = report.join(docs, "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) < 0.03 * r.target for r in sums)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == report.agg(F.sum("taken")).first()[0]


def test_mixing_on_tricky_rows(tricky, nothing, monkeypatch):
    def rows():
        return sorted(map(tuple, mixing.mix_report(tricky).collect()), key=str)

    want = rows()
    assert len(want) == tricky.count() and rows() == want
    assert {r[0]: r[4] for r in want if r[0] in (3, 4, 10)} == {3: 0, 4: 0, 10: 0}
    assert mixing.mix(tricky).columns == tricky.columns
    assert mixing.mix(nothing).count() == 0 and mixing.mix_report(nothing).count() == 0
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", -1)
    assert rows() == want


# ---- url rules

def test_url_rules_against_plain_matching(spark):
    urls = [None, "", "no scheme", "://", "http://", "http:///p", "https://A.Example.NET/en/x?y#z", "http://example.net/de/", "http://example.net", "http://xexample.net/en/", "http://net/",
            "http://net", "ftp://a.b.org/fr/1", "http://org/fr/", "http://org/fr", "http://example.com/de/?q", "http://EXAMPLE.com/DE/", "http://a..net/x", "http://.net/", "http://example.com:80/de/",
            "http://u?://example.net/en/", "http://é.org/fr/\nx", "http://example.net/en/", "http://example.net/en/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(1)).withColumn("key", F.lit("k")).withColumn("rule", F.lit("r"))

    def plain(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
        fits = [r for r in q.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.key), default=None)
        return host, path, best.key if best else None, best.verdict if best else "allow"

    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, q.RULES).collect()}
    assert got == {i: plain(u) for i, u in enumerate(urls)}
    assert urlfilter.judge(pages.where("false"), q.RULES).count() == 0
    assert {r.verdict for r in urlfilter.judge(pages, []).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "FALSE_RATE", 0.4)  # many false positives, so several levels
    universe = materialize(spark.range(3000).select(F.concat(F.lit("key"), F.col("id").cast("string")).alias("key"), (F.col("id") % 7 == 0).alias("listed")), "test-universe")
    cascade = urlfilter.build_cascade(universe)
    assert len(cascade) > 2
    assert universe.where(urlfilter.contains(F.col("key"), cascade) != F.col("listed")).count() == 0


def test_cascade_refuses_to_outgrow_its_bound(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "MAX_BYTES", 64)
    with pytest.raises(ValueError):
        urlfilter.build_cascade(spark.range(1000).select(F.col("id").cast("string").alias("key"), F.lit(True).alias("listed")))


# ---- pipeline

def test_stages_keep_columns_and_nest(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = materialize(stage(spark, before, DATA), "test-stage")
        assert after.columns == columns and after.dtypes == docs.dtypes, name
        assert after.join(before, "doc_id", "left_anti").count() == 0
        if name == "line_dedup":
            assert after.where("n_chars <> length(text)").count() == 0
        if name == "ngram_join":
            from tidemark.llm import ngramjoin
            left = ngramjoin.near_components(before)
            assert after.count() == left.where("component_id = doc_id").count()
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, DATA)
    assert pieces.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()


def test_stages_on_tricky_rows(spark, tricky, tmp_path):
    spark.createDataFrame([(1, 0, 1), (5, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    plain = tricky.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars"), "score", "cut")
    for docs in (plain, plain.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, str(tmp_path)), "test-stage")


def test_near_copies_leave_one(spark):
    text = prose(1, 40)
    rows = [(4, text), (2, text), (2, text), (9, text + " more"), (7, prose(2, 40)), (7, prose(2, 40)), (None, prose(3, 40)), (11, None), (11, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()), key=str)
    assert got == sorted([2, 7, None, 11, 11], key=str)


def test_near_copies_are_judged_by_row(spark):
    """Different texts under one id or none are documents of their own."""
    a, b, c, d, e = (prose(40 + i, 60) for i in range(5))
    rows = [(1, a), (5, a), (5, b), (7, c), (7, d), (None, e), (None, a), (None, prose(60, 50)), (8, e + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("near", F.lit("x"))
    got = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, [(1, a), (5, b), (7, c), (7, d), (None, prose(60, 50)), (8, e + " more")]))


def test_rows_without_id_meet_their_targets(spark):
    rows = [(None if i % 2 else 7, prose(i, 20 + i % 7), "abc"[i % 3]) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for r in mixing.mix_report(docs).groupBy("target").agg(F.sum("taken").alias("taken")).collect():
        assert abs(r.taken - r.target) < 0.08 * r.target


def test_many_ids_are_shuffled(spark, monkeypatch):
    from tidemark.llm import common
    monkeypatch.setattr(common, "BROADCAST_IDS", -1)
    docs = spark.range(10).withColumnRenamed("id", "doc_id")
    assert without_ids(docs, docs.where("doc_id > 3")).count() == 4
