"""The registered queries of the text operators and their SQL, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, licenses, linededup, mixing, ngramjoin, packing, search, spotsigs, tokencount, toxicity, urlfilter, vectors, warc
from tidemark.llm.common import crc_fold

RULES = [urlfilter.Rule("block", "net", "/"), urlfilter.Rule("allow", "example.net", "/en/"),
         urlfilter.Rule("block", "example.com", "/de/"), urlfilter.Rule("allow", "org", "/fr/")]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def public(name: str):
    """Where a public vocabulary lies, found out in the worker that reads it."""
    def path() -> str:
        import public_tokenizers

        return str(public_tokenizers.path(name))
    return path


vocabulary = public("word_bpe_49k.json")


def op1_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.with_edits(table(spark, folder, "documents"))


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op3_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_linededup(spark: SparkSession, folder: str) -> DataFrame:
    out = linededup.dedupe(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), F.size("cut_lines").alias("n_cut"),
                      F.array_join(F.col("cut_lines").cast("array<string>"), ",").alias("cut_lines"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels"))
    out = toxicity.score(docs, model)
    return out.select("doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted", "worst_sentence", "worst_score")


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), vocabulary)


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(table(spark, folder, "documents"))


def op9_urlfilter(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judge(table(spark, folder, "pages"), RULES)


def op10_ngramjoin(spark: SparkSession, folder: str) -> DataFrame:
    return ngramjoin.near_components(table(spark, folder, "documents"))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.link_report(table(spark, folder, "documents"), public("byte_bpe_50k.json"), public("piece_bpe_32k.model"))


def op12_tokencount(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, folder, "documents"), public("piece_bpe_32k.model"))


def op13_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_spotsigs, op2_licenses, op3_vectors, op4_linededup, op5_toxicity, op6_packing, op7_warc, op8_mixing, op9_urlfilter, op10_ngramjoin,
                                   op11_alignment, op12_tokencount, op13_search)}

WORDS_SQL = r"coalesce(len(regexp_extract_all(text, '[^ \x09-\x0D]+')), 0)::BIGINT"

ORACLE: dict[str, str] = {
    "op8_mixing": f"""
WITH d AS (SELECT doc_id, source, text, {WORDS_SQL} AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
        (CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END)::DOUBLE AS w
      FROM d GROUP BY source),
c AS (SELECT *, 2.0 * source_size AS cap FROM s),
r AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(w) OVER (ORDER BY cap / w, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
t AS (SELECT *, min(CASE WHEN cap > w * level THEN cap / w END) OVER () AS first_free FROM r),
g AS (SELECT source, source_size, cap, w, max(CASE WHEN cap / w = first_free THEN level END) OVER () AS set_level FROM t),
m AS (SELECT source, source_size, CASE WHEN set_level IS NULL OR cap <= w * set_level THEN cap ELSE w * set_level END::DOUBLE AS target FROM g),
j AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
        ('0x' || md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, '')))[1:13])::BIGINT / 4503599627370496.0 AS u
      FROM d JOIN m ON d.source IS NOT DISTINCT FROM m.source)
SELECT doc_id, size, source_size, target, size * (floor(rate) + (u < rate - floor(rate))::INT)::BIGINT AS taken FROM j""",
    "op9_urlfilter": r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT *, (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') AS net,
        (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') AS net_en,
        (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') AS com_de,
        (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') AS org_fr FROM p)
SELECT page_id, host, path,
  CASE WHEN net_en THEN 'example.net/en/' WHEN com_de THEN 'example.com/de/' WHEN org_fr THEN 'org/fr/' WHEN net THEN 'net/' END AS rule,
  CASE WHEN net_en THEN 'allow' WHEN com_de THEN 'block' WHEN org_fr THEN 'allow' WHEN net THEN 'block' ELSE 'allow' END AS verdict
FROM r""",
    "op13_search": r"""
WITH w AS (SELECT rid, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT *, row_number() OVER () AS rid FROM documents)),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
d AS (SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n FROM w GROUP BY rid),
z AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM d),
p AS (SELECT rid, term, count(*) AS tf FROM w WHERE term IN (SELECT term FROM i) GROUP BY rid, term),
f AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight FROM (SELECT term, count(*) AS df FROM p GROUP BY term), z),
s AS (SELECT item_id, rid, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))))::BIGINT AS score
      FROM i JOIN p USING (term) JOIN f USING (term) JOIN d USING (rid), z GROUP BY item_id, rid),
r AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
      FROM s JOIN d USING (rid) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""",
}
