"""Grouped prefix join of documents on the Jaccard of their word shingles.

Every pair of documents whose sets have a Jaccard of at least 3/4 is found, and documents reachable through such pairs share
a component. Nothing is sampled or capped:

1. Shingles are hashed per block of texts; of equal sets in a block one goes on. Sorted hashes are dealt by
   value to *parts*, a part counts in how many sets each occurs and answers each block with the shared ones only.
2. A set that shares fewer than 3/4 of its shingles with anyone has no partner. The others are ordered by
   (frequency, hash), rarest first: two partners must share a shingle of their prefixes, the first n - ceil(3n/4) + 1.
3. Sets with one prefix and size form a group. Groups meet in the buckets of their prefix shingles; size, position
   and bitmap bounds filter pairs. First each meets its neighbour and the head of its bucket, which already connects copies
   of a text, however many. Large buckets that still hold several components are told apart in place. In the
   others all pairs of groups of different components that pass the filters are expanded to their members
   and verified on the shingles. So a large group of copies never yields all its pairs.
4. Components come from alternating star steps on the links.

Shingles are compared as 48-bit hashes, sets as 64-bit hashes. Jaccard 100 * i >= 75 * u is tested in whole numbers as 7 * i >= 3 * (a + b).

Defined cases: null and empty texts have an empty set, no partner, and are their own component; a text of fewer than five words has
one shingle, all its words; repeated rows and ids each keep their row; a null id never names a component; an empty
table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tidemark.llm.common import docs_of, longs, materialize, shuffle_width, bounded_batches

SHINGLE = 5
TOKEN_BITS = 48
#: Characters of one block, and shingles of one part: what a task holds at a time.
BLOCK_CHARS, PART_TOKENS = 2_000_000, 2_000_000
#: From so many sets of one block on, a shingle's holders stay with the block and only the shingle itself is told.
LOCAL_HOLDERS = 16
COMMON = 1 << 30
BITMAP_WORDS = 8
#: Rows of one bucket that one task compares with each other.
BUCKET_ROWS = 4000
#: Buckets of more sets than this are verified in place, in slices of about so many shingles.
LARGE, SLICE_TOKENS = 64, 4_000_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles. Only A-Z are lower-cased; ASCII white space separates words."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(codes) < SHINGLE:
        h = np.uint64(len(codes))
        with np.errstate(over="ignore"):
            for c in codes:
                h = h * _MULTIPLIER + c
        return _finish(np.array([h], np.uint64))
    n = len(codes) - SHINGLE + 1
    h = codes[:n].copy()
    for k in range(1, SHINGLE):
        h *= _MULTIPLIER
        h += codes[k:n + k]
    return np.unique(_finish(h))


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes."""
    import zstandard

    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(data: bytes, kind: type) -> np.ndarray:
    import zstandard

    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()


def _gaps(tokens: np.ndarray) -> bytes:
    return squeeze(np.diff(tokens, prepend=np.uint64(0)))


def _ungap(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data, np.uint64), dtype=np.uint64)


def needed(n: np.ndarray) -> np.ndarray:
    """Shingles a set of n must share with a partner: ceil(3n/4)."""
    return (3 * n + 3) // 4


# kind 0: a block's documents; 1: shingles and holders for a part; 2: shingles common in a block, for a part; 3: those
# with their holders, for the block
ROUTED = "dest int, block long, kind int, a binary, b binary, c binary"
_ROUTED = [c.split()[0] for c in ROUTED.split(", ")]


def _block_rows(block: int, ids: list, texts: list[str], parts: int) -> Iterator[tuple]:
    sets = [shingle_set(t) for t in texts]
    sizes = np.array([len(s) for s in sets], np.int64)
    import xxhash

    keys = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) >> 1 for s in sets], np.int64)
    known = np.array([i is not None for i in ids], np.int8)
    numbers = np.array([0 if i is None else i for i in ids], np.int64)
    yield block % parts, block, 0, keys.tobytes(), sizes.tobytes(), numbers.tobytes() + known.tobytes()
    first: dict[int, int] = {}
    for i, key in enumerate(keys.tolist()):
        if sizes[i]:
            first.setdefault(key, i)
    one = sorted(first.values())
    if not one:
        return
    tokens = np.concatenate([sets[i] for i in one]) >> np.uint64(64 - TOKEN_BITS)
    holders = np.repeat(np.array(one, np.uint32), sizes[one])
    order = np.argsort(tokens, kind="stable")
    tokens, holders = tokens[order], holders[order]
    starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
    counts = np.diff(np.append(starts, len(tokens)))
    common = np.repeat(counts >= LOCAL_HOLDERS, counts)
    width = np.uint64(-(-(1 << TOKEN_BITS) // parts))
    if common.any():
        yield block % parts, block, 3, _gaps(tokens[common]), squeeze(holders[common]), None
        yield from _by_part(block, 2, np.unique(tokens[common]), None, width)
    yield from _by_part(block, 1, tokens[~common], holders[~common], width)


def _by_part(block: int, kind: int, tokens: np.ndarray, holders: np.ndarray | None, width: np.uint64) -> Iterator[tuple]:
    part = tokens // width
    edges = np.append(np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))), len(part)) if len(part) else np.zeros(1, int)
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(part[lo]), block, kind, _gaps(tokens[lo:hi]), None if holders is None else squeeze(holders[lo:hi]), None


def _blocks(parts: int, block_chars: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, ids, texts, room = TaskContext.get().partitionId() << 24, [], [], block_chars
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids.append(None if doc_id is None else int(doc_id))
                texts.append(text)
                room -= len(text)
                if room <= 0:
                    yield pd.DataFrame(list(_block_rows(block, ids, texts, parts)), columns=_ROUTED)
                    block, ids, texts, room = block + 1, [], [], block_chars
        if ids:
            yield pd.DataFrame(list(_block_rows(block, ids, texts, parts)), columns=_ROUTED)
    return run


ANSWERED = "block long, kind int, a binary, b binary, c binary"
_ANSWERED = [c.split()[0] for c in ANSWERED.split(", ")]


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """One part: tells each block which of its shingles also occur elsewhere, and in how many sets."""
    out = [(r.block, r.kind, r.a, r.b, r.c) for r in group.itertuples() if r.kind in (0, 3)]
    told = [_ungap(r.a) for r in group.itertuples() if r.kind == 2]
    asked = [r for r in group.itertuples() if r.kind == 1]
    if asked:
        arrays = [_ungap(r.a) for r in asked]
        everything = np.concatenate(arrays)
        everything.sort()
        starts = np.flatnonzero(np.concatenate(([True], everything[1:] != everything[:-1])))
        counts = np.diff(np.append(starts, len(everything)))
        distinct = everything[starts]
        if told:
            counts = np.where(np.isin(distinct, np.unique(np.concatenate(told)), assume_unique=True), COMMON, counts)
        keep = counts > 1
        shared, count = distinct[keep], counts[keep].astype(np.uint32)
        if len(shared):
            for r, tokens in zip(asked, arrays, strict=True):
                at = np.minimum(np.searchsorted(shared, tokens), len(shared) - 1)
                hit = shared[at] == tokens
                if hit.any():
                    out.append((r.block, 1, _gaps(tokens[hit]), squeeze(unsqueeze(r.b, np.uint32)[hit]), squeeze(count[at[hit]])))
    return pd.DataFrame(out, columns=_ANSWERED)


SETS = "doc_id long, n_shingles long, key long, single int, prefix array<long>, tokens binary, bits array<long>"


def _survivors(group: pd.DataFrame) -> pd.DataFrame:
    """One block: all its documents; with prefix and shared shingles where three quarters are shared."""
    about = group[group["kind"] == 0].iloc[0]
    keys, sizes = np.frombuffer(about["a"], np.int64), np.frombuffer(about["b"], np.int64)
    n = len(keys)
    numbers, known = np.frombuffer(about["c"][:8 * n], np.int64), np.frombuffer(about["c"][8 * n:], np.int8)
    tokens, holders, counts = [np.empty(0, np.uint64)], [np.empty(0, np.uint32)], [np.empty(0, np.uint32)]
    for r in group.itertuples():
        if r.kind in (1, 3):
            tokens.append(_ungap(r.a))
            holders.append(unsqueeze(r.b, np.uint32))
            counts.append(unsqueeze(r.c, np.uint32) if r.kind == 1 else np.full(len(tokens[-1]), COMMON, np.uint32))
    token, holder, count = np.concatenate(tokens), np.concatenate(holders), np.concatenate(counts)
    shared = np.bincount(holder, minlength=n)
    must = needed(sizes)
    alive = (sizes > 0) & (shared >= must)
    pick = alive[holder]
    token, holder, count = token[pick], holder[pick], count[pick]
    order = np.lexsort((token, count, holder))
    token, holder = token[order].astype(np.int64), holder[order]
    edges = np.searchsorted(holder, np.arange(n + 1))
    rows = []
    for i in range(n):
        row = [None, int(sizes[i]), int(keys[i]) if sizes[i] else None, None, None, None, None]
        if alive[i]:
            own = token[edges[i]:edges[i + 1]]
            row[3] = int(sizes[i]) - len(own)
            row[4] = own[:len(own) - int(must[i]) + 1].tolist()
            own = np.sort(own)
            row[5], row[6] = own.astype("<i8").tobytes(), bitmap(own).tolist()
        rows.append(row)
    return pd.DataFrame(rows, columns=[c.split()[0] for c in SETS.split(", ")]).assign(
        doc_id=longs(int(i) if k else None for i, k in zip(numbers, known, strict=True)), key=longs(r[2] for r in rows), single=pd.array([r[3] for r in rows], "Int32"))


def bitmap(tokens: np.ndarray) -> np.ndarray:
    at = (tokens % (64 * BITMAP_WORDS)).astype(np.int64)
    bits = np.zeros(64 * BITMAP_WORDS, np.uint8)
    bits[at] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def sets_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: n_shingles, key of its set, and for possible partners the prefix and shared shingles. Stored."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs_of(docs, id_col, text_col)
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = max(2 * shuffle_width(spark), math.ceil(size / SHINGLE / PART_TOKENS))
    routed = rows.select(F.col("doc_id").cast("string"), "text").mapInPandas(_blocks(parts, block_chars), ROUTED)
    answered = routed.groupBy("dest").applyInPandas(_answer, ANSWERED)
    return materialize(answered.groupBy("block").applyInPandas(_survivors, SETS), "ngram-sets")


def _whole_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows regrouped so that no bucket is cut between two frames."""
    def mark(frame: pd.DataFrame, at: int) -> tuple:
        row = frame.iloc[at]
        return row["bucket"], row["slice"], row["other"]

    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        if held and mark(held[-1], -1) != mark(batch, 0):
            yield pd.concat(held, ignore_index=True)
            held = []
        last = mark(batch, -1)
        open_ = (batch["bucket"] == last[0]) & (batch["slice"] == last[1]) & (batch["other"] == last[2])
        if not open_.all():
            yield pd.concat([*held, batch[~open_]], ignore_index=True)
            held = []
        held.append(batch[open_])
    if held:
        yield pd.concat(held, ignore_index=True)


def _edges(rows: pd.DataFrame) -> np.ndarray:
    """Where each bucket of a frame starts, and the end."""
    mark = rows[["bucket", "slice", "other"]].to_numpy()
    return np.append(np.flatnonzero(np.concatenate(([True], (mark[1:] != mark[:-1]).any(1)))), len(rows))


def _meet(everyone: bool):
    """Pairs of groups in one bucket that pass the filters: all of different components, or only neighbours and heads."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[int, int]] = set()
        for rows in _whole_buckets(batches):
            yield pd.DataFrame(list(_pairs_of(rows, everyone, seen)), columns=["a", "b"]).astype("int64")
    return run


def _pairs_of(rows: pd.DataFrame, everyone: bool, seen: set) -> Iterator[tuple[int, int]]:
    edges = _edges(rows)
    slices, others = rows["slice"].to_numpy(), rows["other"].to_numpy()
    gid, comp = rows["gid"].to_numpy(), rows["comp"].to_numpy()
    n, place = rows["n"].to_numpy(), rows["place"].to_numpy()
    every, some = rows["all_bits"].to_numpy(), rows["any_bits"].to_numpy()
    home = rows["home"].to_numpy()
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if hi - lo < 2 or (comp[lo:hi] == comp[lo]).all():
            continue
        order = lo + np.lexsort((gid[lo:hi], n[lo:hi]))
        sizes, where, parts = n[order], place[order], comp[order]
        full, loose = (np.stack(x[order]).astype(np.int64).view(np.uint64) for x in (every, some))  # counting bits takes absolute values
        crossing = slices[lo] != others[lo]
        head = 0
        for j in range(1, len(order)):
            if everyone:
                from_ = np.searchsorted(4 * sizes[:j], 3 * sizes[j])
                at = np.arange(from_, j)
                at = at[parts[at] != parts[j]]
                if crossing:
                    at = at[home[order[at]] != home[order[j]]]
            else:
                if 4 * sizes[head] < 3 * sizes[j]:
                    head = j
                at = np.unique([head, j - 1])
                at = at[at < j]
            if not len(at):
                continue
            total = sizes[at] + sizes[j]
            most = 1 + np.minimum(sizes[at] - 1 - where[at], sizes[j] - 1 - where[j])
            apart = np.bitwise_count(full[at] & ~loose[j]).sum(1).astype(int) + np.bitwise_count(full[j] & ~loose[at]).sum(1).astype(int)
            good = at[(4 * sizes[at] >= 3 * sizes[j]) & (7 * most >= 3 * total) & (7 * apart <= total)]
            for i in good.tolist():
                x, y = int(gid[order[i]]), int(gid[order[j]])
                pair = (x, y) if x < y else (y, x)
                if pair not in seen:
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(pair)
                    yield pair


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links among the pairs, thinned to a forest per batch."""
    for batch in batches:
        root: dict[int, int] = {}

        def find(x: int, root=root) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = root.get(up, up)
                x = up
            return x

        out = []
        for r in batch.itertuples():
            x, y = find(r.a), find(r.b)
            if x != y:
                both = len(np.intersect1d(np.frombuffer(r.ta, "<i8"), np.frombuffer(r.tb, "<i8"), assume_unique=True))
                if 7 * both >= 3 * (r.na + r.nb):
                    root[max(x, y)] = min(x, y)
                    out.append((r.a, r.b))
        yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _links_of_bucket(rows: pd.DataFrame) -> Iterator[tuple[int, int]]:
    """Links between different components of one bucket, thinned to a forest, by counting common shingles."""
    order = rows["n"].to_numpy().argsort(kind="stable")
    key, n, comp, home = (rows[c].to_numpy()[order] for c in ("key", "n", "comp", "home"))
    crossing = rows["slice"].iloc[0] != rows["other"].iloc[0]
    own = [np.frombuffer(t, "<i8") for t in rows["tokens"].to_numpy()[order]]
    length = np.array([len(t) for t in own])
    _, number = np.unique(np.concatenate(own), return_inverse=True)
    holder = np.repeat(np.arange(len(own)), length)[number.argsort(kind="stable")]
    start = np.concatenate(([0], np.cumsum(np.bincount(number))))
    at = np.concatenate(([0], np.cumsum(length)))
    names, label = np.unique(comp, return_inverse=True)
    root = np.arange(len(names))
    largest = np.bincount(label).argmax()
    for i in np.flatnonzero(label != largest).tolist():
        tokens = number[at[i]:at[i + 1]]
        common = np.bincount(np.concatenate([holder[start[t]:start[t + 1]] for t in tokens.tolist()]), minlength=len(own))
        good = 7 * common >= 3 * (n + n[i])
        if crossing:
            good &= home != home[i]
        for j in np.flatnonzero(good & (root[label] != root[label[i]])).tolist():
            x, y = root[label[i]], root[label[j]]
            if x != y:
                root[root == max(x, y)] = min(x, y)
                yield int(key[i]), int(key[j])


def _link_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in _whole_buckets(batches):
        edges = _edges(rows)
        out = [pair for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True) for pair in _links_of_bucket(rows.iloc[lo:hi])]
        yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    slim = sets.select("key", "n", "tokens")
    a = slim.withColumnsRenamed({"key": "a", "n": "na", "tokens": "ta"})
    b = slim.withColumnsRenamed({"key": "b", "n": "nb", "tokens": "tb"})
    return pairs.distinct().join(a, "a").join(b, "b").select("a", "b", "na", "nb", "ta", "tb").mapInPandas(_verify, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """node, comp (the smallest node reachable) of every linked node but those smallest ones. Alternating star steps; every round is stored, so lineage stays short.

    Each step groups by node with a partial minimum and joins the minimum back, which splits where a node has very
    many links. Stops when a round changes nothing.
    """
    edges = materialize(edges.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).where("u <> v").distinct(), "star")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges = materialize(small, "star")
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        mark = now


def _sliced(met: DataFrame, slices, who: str, width: int, *columns: str) -> DataFrame:
    """Rows of buckets in slices, each slice beside each, so that every pair meets in one task; sorted by bucket."""
    met = met.withColumn("slices", slices.cast("int")).withColumn("home", F.pmod(F.xxhash64(who), F.col("slices").cast("long")).cast("int"))
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    met = met.select("bucket", F.least("home", "with").alias("slice"), F.greatest("home", "with").alias("other"), "home", *columns)
    return met.repartition(width, "bucket", "slice", "other").sortWithinPartitions("bucket", "slice", "other")


def _bucketed(groups: DataFrame, width: int, most: int | None = None) -> DataFrame:
    """Groups at their prefix shingles, in the buckets with at most ``most`` sets."""
    placed = groups.select("gid", "n", "comp", "members", "all_bits", "any_bits", F.posexplode("prefix").alias("at", "bucket"), "single")
    counts = placed.groupBy("bucket").agg(F.count("*").alias("rows"), F.sum("members").alias("sets")).where("rows > 1")
    met = placed.join(counts if most is None else counts.where(F.col("sets") <= most), "bucket").withColumn("place", F.col("single") + F.col("at"))
    return _sliced(met, F.ceil(F.col("rows") / F.lit(BUCKET_ROWS)), "gid", width, "gid", "n", "place", "comp", "all_bits", "any_bits")


def _large_buckets(sets: DataFrame, width: int) -> DataFrame:
    """Sets with their shingles in the buckets of more than ``LARGE`` sets that hold several components."""
    placed = sets.select("key", "n", "comp", F.explode("prefix").alias("bucket"))
    counts = (placed.groupBy("bucket").agg(F.count("*").alias("sets"), F.sum("n").alias("weight"), F.min("comp").alias("low"), F.max("comp").alias("high"))
              .where((F.col("sets") > LARGE) & (F.col("low") != F.col("high"))).select("bucket", "weight"))
    met = placed.join(counts, "bucket").join(sets.select("key", "tokens"), "key")
    return _sliced(met, F.ceil(F.col("weight") / F.lit(SLICE_TOKENS)), "key", width, "key", "n", "comp", "tokens")


def _grouped(sets: DataFrame) -> DataFrame:
    """Sets of one size, prefix and component as one group."""
    words = range(BITMAP_WORDS)
    one = sets.withColumn("gid", F.xxhash64("n", "prefix", "comp"))
    rows = one.groupBy("gid").agg(
        F.count("*").alias("members"), F.first("n").alias("n"), F.first("comp").alias("comp"), F.first("single").alias("single"), F.first("prefix").alias("prefix"),
        F.array(*[F.bit_and(F.col("bits")[i]) for i in words]).alias("all_bits"), F.array(*[F.bit_or(F.col("bits")[i]) for i in words]).alias("any_bits"))
    return rows


def classes(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """All documents (doc_id, n_shingles, key), and (key, comp) of the sets that have a partner."""
    spark = docs.sparkSession
    stored = sets_of(docs, **options)
    width = shuffle_width(spark)
    sets = (stored.where("prefix is not null").groupBy("key")
            .agg(F.first(F.struct(F.col("n_shingles").alias("n"), "single", "prefix", "tokens", "bits")).alias("s")).select("key", "s.*"))
    sets = materialize(sets, "ngram-survivors")
    # round 1: groups of one size and prefix; members meet their group's first, groups their neighbours
    fresh = sets.withColumn("comp", F.lit(None).cast("long"))
    member = fresh.select("key", F.xxhash64("n", "prefix", "comp").alias("gid"))
    head = member.groupBy("gid").agg(F.min("key").alias("head"))
    inside = member.join(head, "gid").where("key <> head").select(F.col("head").alias("a"), F.col("key").alias("b"))
    by_group = _grouped(fresh.drop("comp").withColumn("comp", F.lit(None).cast("long"))).withColumn("comp", F.col("gid"))
    met = _bucketed(by_group, width).mapInPandas(_meet(False), "a long, b long")
    heads = head.select("gid", "head")
    across = (met.distinct().join(heads.withColumnsRenamed({"gid": "a", "head": "x"}), "a").join(heads.withColumnsRenamed({"gid": "b", "head": "y"}), "b")
              .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    links = materialize(_links(inside.unionByName(across), sets), "ngram-links")
    # round 2: in large buckets, whole components are told apart on the shingles themselves, without a pair leaving
    now = _labelled(sets, components(links))
    links = links.unionByName(materialize(_large_buckets(now, width).mapInPandas(_link_buckets, "a long, b long"), "ngram-links"))
    # round 3: in the others, all pairs of groups of different components that pass the filters
    comp = components(links)
    now = _labelled(sets, comp)
    met = _bucketed(_grouped(now), width, LARGE).mapInPandas(_meet(True), "a long, b long")
    members = now.select(F.xxhash64("n", "prefix", "comp").alias("gid"), "key")
    pairs = (met.distinct().join(members.withColumnsRenamed({"gid": "a", "key": "x"}), "a").join(members.withColumnsRenamed({"gid": "b", "key": "y"}), "b")
             .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))
    more = materialize(_links(pairs, sets), "ngram-links")
    if not more.isEmpty():
        comp = components(links.unionByName(more))
    return stored.select("doc_id", "n_shingles", "key"), comp.select(F.col("node").alias("key"), "comp")


def _labelled(sets: DataFrame, comp: DataFrame) -> DataFrame:
    named = sets.join(comp.withColumnRenamed("node", "key"), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    return materialize(named, "ngram-labelled")


def near_components(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id reachable through links) of every document."""
    rows, comp = classes(docs, **options)
    by_key = rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("low"))
    labelled = by_key.join(comp, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    lowest = labelled.groupBy("comp").agg(F.min("low").alias("component_id"))
    named = labelled.join(lowest, "comp").select("key", "component_id")
    return (rows.join(named, "key", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
