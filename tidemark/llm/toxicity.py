"""Toxicity by multiple-instance learning.

Only documents are labelled, yet sentences offend. A sentence's probability is logistic in the words it holds; a document's is
the noisy-or of its sentences: it is toxic unless every sentence is innocent. The weights are fitted to the document
labels through that noisy-or, and the same sentence scores then point at the offending sentences.

The fit reads at most ``TRAIN_ROWS`` labelled documents and ``TRAIN_CHARS`` characters of them (whole texts in the order of
their ids' hash, very long ones last; one that no longer fits is passed over), on the driver. Scoring reads every whole text.

Defined cases: null and empty texts have no sentence and score 0; a document labelled twice counts as toxic if one
label says so; equal texts score alike; without usable labels of both kinds every score is 0.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.common import crc_fold, docs_of, longs, materialize, bounded_batches

TRAIN_ROWS, TRAIN_CHARS = 6000, 12_000_000
#: A text longer than this part of the characters joins the sample after all others, if room is left.
SHARES = 20
STEPS, RATE, RIDGE = 300, 0.2, 3e-5
#: Weight of a toxic document in the likelihood.
TOXIC_WEIGHT = 3.0
#: A feature is used if it occurs in at least ``MIN_DOCS`` toxic texts, ``LIFT`` times as often (by share) as in the others,
#: and so much more often that the likelihood ratio statistic exceeds ``MIN_GAIN``.
MIN_DOCS, LIFT, MIN_GAIN = 3, 3.0, 8.0
#: Word beginnings used as features beside whole words: inflected forms share them.
STEMS = (4, 5, 6, 7)
SENTENCE = re.compile(r"[.!?\n]+")
TOKEN = re.compile(r"\w+")
MEMO_ROOM = 200_000


def features(word: str) -> list[str]:
    return [word, *[word[:k] + "*" for k in STEMS if len(word) >= k]]


class _Words(dict):
    """Word -> summed weight of its features, computed when first met. Emptied when full: only a cache."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.of = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= MEMO_ROOM:
            self.clear()
        got = self[word] = sum(self.of.get(f, 0.0) for f in features(word))
        return got


class Model:
    def __init__(self, bias: float = -30.0, weights: dict[str, float] | None = None):
        self.bias, self.weights = bias, weights or {}
        self.words = _Words(self.weights)

    def sentence_logits(self, text: str) -> list[float]:
        of, bias = self.words, self.bias
        out = []
        for sentence in SENTENCE.split(text.lower()):
            words = set(TOKEN.findall(sentence))
            if words:
                out.append(bias + sum([of[w] for w in words]))
        return out

    def score(self, text: str) -> tuple[float, int, float]:
        """Noisy-or of the text, number of its worst sentence (from 0, -1 if none), that sentence's probability."""
        z = np.array(self.sentence_logits(text))
        if not len(z):
            return 0.0, -1, 0.0
        worst = int(z.argmax())
        return float(-np.expm1(-np.logaddexp(0, z).sum())), worst, float(1 / (1 + np.exp(-z[worst])))


def _numbered(texts: Iterable[str]) -> tuple[dict[str, int], np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the distinct words, and for every word of every sentence its number, sentence and text."""
    number: dict[str, int] = {}
    word, sentence, doc = array("i"), array("i"), array("i")
    n = 0
    for d, text in enumerate(texts):
        for part in SENTENCE.split(text.lower()):
            if words := set(TOKEN.findall(part)):
                word.extend([number.setdefault(w, len(number)) for w in sorted(words)])
                sentence.extend([n] * len(words))
                doc.append(d)
                n += 1
    return number, np.array(word, np.int32), np.array(sentence, np.int32), np.array(doc, np.int32)


def _telling(words: list[str], word: np.ndarray, starts: np.ndarray, y: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Features that speak for toxicity, and for each word the numbers of its own among them (-1 where there is none)."""
    ids: dict[str, int] = {}
    of = np.full((len(words), 1 + len(STEMS)), -1, np.int32)
    for i, w in enumerate(words):
        for k, f in enumerate(features(w)):
            of[i, k] = ids.setdefault(f, len(ids))
    toxic, other = np.zeros(len(ids), np.int32), np.zeros(len(ids), np.int32)
    for d, label in enumerate(y):
        here = np.unique(of[np.unique(word[starts[d]:starts[d + 1]])])
        (toxic if label else other)[here[here >= 0]] += 1
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    a, b = toxic.astype(float), other.astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 2 * (a * np.log(a * (n1 + n0) / ((a + b) * n1)) + np.where(b > 0, b * np.log(b * (n1 + n0) / ((a + b) * n0)), 0.0))
    keep = (a >= MIN_DOCS) & (a * n0 > LIFT * b * n1) & (gain > MIN_GAIN)
    place = np.where(keep, np.cumsum(keep) - 1, -1).astype(np.int32)
    return [f for f, i in ids.items() if keep[i]], np.where(of >= 0, place[of], -1)


def fit(texts: list[str], labels: list[int]) -> Model:
    """Full-batch Adam on the noisy-or likelihood, with a ridge, over the telling features of distinct texts."""
    label_of: dict[str, int] = {}
    for text, label in zip(texts, labels, strict=True):
        if TOKEN.search(text):
            label_of[text] = max(label_of.get(text, 0), int(label))
    y = np.array(list(label_of.values()), float)
    if not len(y) or y.min() == y.max():
        return Model()
    number, word, sentence, doc = _numbered(label_of)
    starts = np.searchsorted(sentence, np.searchsorted(doc, np.arange(len(y) + 1)))
    names, of = _telling(list(number), word, starts, y)
    col = of[word].ravel()
    sen = np.repeat(sentence, of.shape[1])[col >= 0]
    col = col[col >= 0]
    n_sen, n_voc = len(doc), len(names)
    w, m, v = (np.zeros(n_voc + 1) for _ in range(3))
    w[-1] = -6.0
    for step in range(1, STEPS + 1):
        z = np.bincount(sen, w[col], n_sen) + w[-1]
        p = 1 / (1 + np.exp(-z))
        innocent = np.bincount(doc, np.logaddexp(0, z), len(y))  # -log of the chance that no sentence offends
        odds = 1 / np.maximum(np.expm1(np.minimum(innocent, 500)), 1e-12)
        dz = p * ((1 + (TOXIC_WEIGHT - 1) * y) * (1 - y * (1 + odds)))[doc]
        grad = np.append(np.bincount(col, dz[sen], n_voc), dz.sum()) / len(y)
        grad[:-1] += RIDGE * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Model(float(w[-1]), dict(zip(names, w[:-1].tolist(), strict=True)))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Model:
    """Model of the labelled documents outside the held-out fold. The bound on what comes to the driver is the two parameters."""
    usable = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id")) != 0))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    mixed = F.xxhash64("doc_id")
    chosen = usable.orderBy(mixed, "doc_id").limit(rows)
    one = docs_of(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    one = materialize(one, "labelled-texts")
    # only ids and lengths are ordered, on the driver: at most ``rows`` of them
    sizes = one.select("doc_id", F.length("text").alias("size"), F.xxhash64("doc_id").alias("place")).collect()
    taken, so_far = [], 0
    for r in sorted(sizes, key=lambda r: (r["size"] > chars // SHARES, r["place"], r["doc_id"])):
        if so_far + r["size"] <= chars:
            taken.append((r["doc_id"],))
            so_far += r["size"]
    spark = docs.sparkSession
    ids = spark.createDataFrame(taken, one.select("doc_id").schema)
    sample = one.join(F.broadcast(ids), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").select("text", "toxic").toPandas()
    return fit(sample.pop("text").tolist(), sample["toxic"].tolist())


def scorer(spark: SparkSession, model: Model):
    """A column function: the score of a text."""
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast((model.bias, model.weights))  # at most the words of TRAIN_CHARS characters

    @pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        judge = Model(*shared.value).score
        return pd.Series([judge(t)[0] for t in texts], dtype="float64")

    return of


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted, worst_sentence, worst_score of every whole text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast((model.bias, model.weights))  # at most the words of TRAIN_CHARS characters

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = Model(*shared.value).score
        for batch in batches:
            got = [judge(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": longs(batch["doc_id"]), "score": [g[0] for g in got], "predicted": [int(g[0] >= 0.5) for g in got],
                                "worst_sentence": [g[1] for g in got], "worst_score": [g[2] for g in got]})

    rows = docs_of(docs).select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInPandas(run, "doc_id long, score double, predicted int, worst_sentence int, worst_score double")


def offending(docs: DataFrame, model: Model, at_least: float = 0.5) -> DataFrame:
    """doc_id, sentence (its number from 0), text, probability of the sentences that offend by themselves."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast((model.bias, model.weights))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        logits = Model(*shared.value).sentence_logits
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                spoken = [s for s in SENTENCE.split(text) if TOKEN.search(s)]
                for i, z in enumerate(logits(text)):
                    p = float(1 / (1 + np.exp(-z)))
                    if p >= at_least:
                        out.append((doc_id, i, spoken[i].strip(), p))
            yield pd.DataFrame(out, columns=["doc_id", "sentence", "text", "probability"]).astype({"sentence": "int32", "probability": "float64"}).assign(
                doc_id=longs(x[0] for x in out))

    rows = docs_of(docs).select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInPandas(run, "doc_id long, sentence int, text string, probability double")
