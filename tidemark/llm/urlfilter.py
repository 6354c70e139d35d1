"""URL rules looked up in Bloom filter cascades, in DataFrame operations only.

A rule is a host and the start of a path; its key is both written together. A url's candidate keys are its host's suffixes, each
with the starts of its path that are as long as some rule's path. All distinct candidates of the corpus are the key
universe. A cascade encodes which of them are listed: level 1 holds the listed keys, level 2 the unlisted ones that
level 1 lets through, level 3 the listed ones that level 2 lets through, and so on until none is left. Over that
universe the answer is exact, so the pass over the pages needs no join: each url asks the levels, which travel with
the plan. The levels grow with the listed keys, not with the pages; ``MAX_BYTES`` bounds what may travel.

Defined cases: a null url or one without ``://`` has an empty host and path and meets no rule; without a rule the
verdict is allow (no listed key); an empty table or rule list gives no level at all and every url passes.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Share of foreign keys a level may let through.
FALSE_RATE = 0.02
#: Bytes of all levels of one cascade; beyond that the build stops with an error rather than broadcast more.
MAX_BYTES = 64 << 20
#: Bits of one stored word.
WORD = 64


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: list[int] = field(repr=False)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(_rest(url), r"^[^/?#]*", ""), r"^[^?#]*", 0)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def candidates(host: Column, path: Column, path_lengths: Sequence[int]) -> Column:
    """Keys that a rule fitting this url could have, as an array."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    starts = F.array_compact(F.array(*[F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in path_lengths]))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p))))


def _positions(key: Column, bits: int, hashes: int, level: int) -> list[Column]:
    one, two = (F.pmod(F.xxhash64(key, F.lit(2 * level + n)), F.lit(bits)) for n in (0, 1))
    return [F.pmod(one + i * two, F.lit(bits)) for i in range(hashes)]


def passes(key: Column, level: Level, number: int) -> Column:
    """Whether a level lets the key through: all its bits are set."""
    words = F.lit(level.words)
    hit = F.lit(True)
    for at in _positions(key, level.bits, level.hashes, number):
        hit = hit & (F.getbit(F.element_at(words, (F.floor(at / WORD) + 1).cast("int")), (at % WORD).cast("int")) == 1)
    return hit


def contains(key: Column, cascade: Sequence[Level]) -> Column:
    """Exact for every key of the universe: the first level that stops the key decides by its parity."""
    answer = F.lit(len(cascade) % 2 == 1)
    for number in range(len(cascade), 0, -1):
        answer = F.when(passes(key, cascade[number - 1], number), answer).otherwise(F.lit(number % 2 == 0))
    return answer


def _build_level(keys: DataFrame, n: int, number: int) -> Level:
    hashes = max(1, round(-math.log2(FALSE_RATE)))
    bits = WORD * max(1, math.ceil(n * hashes / math.log(2) / WORD))
    if bits // 8 > MAX_BYTES:
        raise ValueError(f"{n} keys need {bits // 8} bytes of filter; the bound is {MAX_BYTES}")
    # the bitmap functions count from 1: position p + 1 is bit p % 8 of byte p // 8 in a bucket that starts at bit 0
    at = keys.select(F.explode(F.array(*[p + 1 for p in _positions(F.col("key"), bits, hashes, number)])).alias("at"))
    packed = at.groupBy(F.bitmap_bucket_number("at").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map"))
    words = [0] * (bits // WORD)
    for b, blob in packed.collect():  # at most MAX_BYTES
        start = (b - 1) * len(blob) * 8 // WORD
        for i, (word,) in enumerate(struct.iter_unpack("<Q", bytes(blob))):
            if word:
                words[start + i] |= word
    return Level(bits, hashes, [w - (1 << 64) if w >> 63 else w for w in words])


def build_cascade(universe: DataFrame) -> list[Level]:
    """Levels over ``universe`` (key, listed). Each level costs two passes over the keys it concerns."""
    cascade: list[Level] = []
    inside, outside = universe.where("listed"), universe.where("not listed")
    n = inside.count()
    while n:
        level = _build_level(inside, n, len(cascade) + 1)
        cascade.append(level)
        if sum(len(x.words) for x in cascade) * 8 > MAX_BYTES:
            raise ValueError(f"the cascade exceeds {MAX_BYTES} bytes")
        through = outside.where(passes(F.col("key"), level, len(cascade)))
        inside, outside = through, inside
        n = inside.count()
    return cascade


def key_universe(pages: DataFrame, path_lengths: Sequence[int], url_col: str = "url") -> DataFrame:
    """All distinct candidate keys of the corpus."""
    url = F.col(f"`{url_col}`")
    hosts = pages.select(host_of(url).alias("h"), path_of(url).alias("p")).where("h <> '' or p <> ''")
    # most urls differ only behind what matters: cut paths first, so that few rows are exploded
    longest = max(path_lengths, default=0)
    cut = hosts.select("h", F.substring("p", 1, longest).alias("p")).distinct()
    return cut.select(F.explode(candidates(F.col("h"), F.col("p"), path_lengths)).alias("key")).distinct()


def _listed_in(cascade: Sequence[Level]) -> Callable[[Column], Column]:
    return lambda key: contains(key, cascade)


def _as_hit(verdict: str) -> Callable[[Column], Column]:
    return lambda key: F.struct(F.length(key).alias("n"), key.alias("key"), F.lit(verdict).alias("verdict"))


def judge(pages: DataFrame, rules: Sequence[Rule], url_col: str = "url", id_col: str = "page_id", otherwise: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every url. The longest fitting rule decides.

    A key listed with two verdicts is refused; ties cannot arise, since equal long keys of one url are equal only if
    host and path are.
    """
    spark: SparkSession = pages.sparkSession
    by_key = {r.key: r.verdict for r in rules}
    if len(by_key) < len({(r.key, r.verdict) for r in rules}):
        raise ValueError("a rule key has two verdicts")
    lengths = sorted({len(r.path) for r in rules})
    url = F.col(f"`{url_col}`")
    out = pages.select(F.col(f"`{id_col}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    if not rules:
        return out.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(otherwise).alias("verdict"))
    listed = spark.createDataFrame([(r.key, r.verdict) for r in rules], "key string, v string").distinct()
    universe = materialize(key_universe(pages, lengths, url_col).join(listed, "key", "left"), "url-keys")
    cascades = {v: build_cascade(universe.select("key", (F.coalesce(F.col("v") == v, F.lit(False))).alias("listed")))
                for v in sorted({r.verdict for r in rules})}
    keys = candidates(F.col("host"), F.col("path"), lengths)
    hit = F.lit(None).cast("struct<n:int,key:string,verdict:string>")
    for verdict, cascade in cascades.items():
        if cascade:
            found = F.filter(keys, _listed_in(cascade))
            best = F.array_max(F.transform(found, _as_hit(verdict)))
            hit = F.greatest(hit, best)
    has_host = (F.col("host") != "") | (F.col("path") != "")
    return (out.withColumn("hit", F.when(has_host, hit))
            .select("page_id", "host", "path", F.col("hit.key").alias("rule"),
                    F.coalesce(F.col("hit.verdict"), F.lit(otherwise)).alias("verdict")))
