"""Mixing sources to target weights, in DataFrame operations only.

Words are counted per source, weights become word targets, a target above ``most`` times its source is cut there and
the excess shared again by weight (the cut sources are a prefix of the sources ordered by size over weight, so one
running sum finds them). A document then appears floor(rate) times, and once more if a number drawn from the seed and
its id and text falls below the rate's fraction.

Defined cases: null and empty texts have size 0 and are taken with 0 words; a null source is a source of its own, the last in order; an
empty source gets target 0; repeated rows draw alike; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, shuffle_width

WORD = r"[^\x20\x09-\x0D]+"
#: Sources joined as a broadcast table: at most this many rows of some 100 bytes.
BROADCAST_SOURCES = 50_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(source: Column, weights: tuple[int, ...]) -> Column:
    """Weights dealt to the sources in code point order, null last, repeating."""
    at = F.row_number().over(Window.orderBy(source.asc_nulls_last())) - 1
    return F.element_at(F.array(*map(F.lit, weights)), (at % len(weights) + 1).cast("int"))


def targets(per_source: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """source, source_size -> target. One row per source passes through one task; documents never do."""
    rows = per_source.withColumn("w", cycled_weights(F.col("source"), weights))
    rows = rows.withColumn("cap", most * F.col("source_size"))
    by_ratio = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("total", share * F.sum("source_size").over(everything))
    rows = rows.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after))
    # the first source that is not cut sets the level; levels only fall after it
    rows = rows.withColumn("set", F.max(F.when(F.col("cap") > F.col("w") * F.col("level"), F.col("level"))).over(everything))
    cut = F.col("set").isNull() | (F.col("cap") <= F.col("w") * F.col("set"))
    return rows.select("source", "source_size", F.when(cut, F.col("cap")).otherwise(F.col("w") * F.col("set")).alias("target"))


def draw(doc_id: Column, body: Column, seed: str) -> Column:
    """A number in [0, 1) from the seed, the id and the text, the same in every run: 52 bits of an md5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(body, F.lit(""))))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def rated(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix",
          id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with size, source_size, target and copies in one struct column ``mix_plan``."""
    spark = docs.sparkSession
    source = F.col(f"`{source_col}`")
    sizes = docs.select(source.alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"))
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = materialize(targets(per_source, weights, share, most), "mix-targets")
    plan = plan.select(F.struct("source", "source_size", "target").alias("mix_goal"))
    wanted = F.col("mix_goal.source")
    if plan.count() <= BROADCAST_SOURCES:
        joined = docs.join(F.broadcast(plan), source.eqNullSafe(wanted))
    else:
        # many sources: both sides are dealt by (source, salt), each source once per salt
        salts = max(2, shuffle_width(spark) // 4)
        salted = plan.withColumn("mix_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        left = F.struct(source.alias("s"), F.pmod(F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")), F.lit(salts)).cast("int").alias("n"))
        salted = salted.select("mix_goal", F.struct(wanted.alias("s"), F.col("mix_salt").alias("n")).alias("mix_right"))
        joined = (docs.withColumn("mix_left", left).join(salted, F.col("mix_left").eqNullSafe(F.col("mix_right")))
                  .drop("mix_left", "mix_right"))
    size = word_count(F.col(f"`{text_col}`"))
    rate = F.when(F.col("mix_goal.source_size") > 0, F.col("mix_goal.target") / F.col("mix_goal.source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (draw(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), seed) < rate - F.floor(rate)).cast("long")
    return joined.withColumn("mix_plan", F.struct(
        size.alias("size"), F.col("mix_goal.source_size").alias("source_size"), F.col("mix_goal.target").alias("target"),
        copies.alias("copies"))).drop("mix_goal")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every document as many times as it was dealt, with the columns of ``docs``."""
    out = rated(docs, **options).where("mix_plan.copies > 0")
    out = out.withColumn("mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_plan.copies"))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken: what the mix takes of each document."""
    slim = docs.select("doc_id", "text", "source")
    return rated(slim, **options).select(
        "doc_id", "mix_plan.size", "mix_plan.source_size", "mix_plan.target",
        (F.col("mix_plan.size") * F.col("mix_plan.copies")).alias("taken"))
