"""A corpus from raw documents to packed windows: five stages, each an operator of the text subpackage.

``STAGES`` lists (name, function); a function takes (spark, docs, folder) and returns what it keeps, with the columns
of ``documents`` (the last: pieces of windows). ``run`` applies them in order and stores each result once in the shared
folder, so a lost executor never costs more than a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import linededup, mixing, ngramjoin, packing, toxicity
from tidemark.llm.common import materialize, without_ids
from tidemark.llm.queries import table, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents scored below one half by a model of the labelled ones among them."""
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return docs.where(toxicity.scorer(spark, model)(F.coalesce("text", F.lit(""))) < 0.5)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the passages that an earlier document holds; documents of which nothing is left go."""
    out = linededup.dedupe(docs, cut_col="line_dedup_cut").where((F.size("line_dedup_cut") == 0) | F.col("text").rlike(r"\S"))
    columns = [F.when(F.size("line_dedup_cut") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars"
               else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each component of near copies the row with the smallest id, whatever ids the rows share or lack. Rows without words stay."""
    # a number of its own for every row: an id may be missing, or shared by different texts
    numbered = materialize(docs.withColumn("pipeline_row", F.monotonically_increasing_id()), "numbered")
    grouped = ngramjoin.near_components(numbered, id_col="pipeline_row")
    members = grouped.where("n_shingles > 0").select(F.col("doc_id").alias("pipeline_row"), F.col("component_id").alias("near")).join(
        numbered.select("pipeline_row", "doc_id"), "pipeline_row")
    members = materialize(members, "near-members")
    first = members.groupBy("near").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "pipeline_row")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = members.join(first, "near").where("pipeline_row <> first.pipeline_row").select("pipeline_row")
    return without_ids(numbered, later, "pipeline_row").select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as their source's target asks."""
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    # workers of the stages before still hold their models: few words are remembered
    return packing.pack(docs, vocabulary, memo_room=400_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_passages),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: Learned scores, alignments and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
