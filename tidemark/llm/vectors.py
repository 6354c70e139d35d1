"""Approximate nearest neighbours: adaptive dimension scan over inverted lists.

Vectors are dealt to the nearest of some centroids (fitted on a bounded sample; every vector is indexed). A query probes the lists of its
nearest centroids: as many as the sample needs for the wanted recall, measured against brute force inside the sample. Neighbours in a
sample lie farther away than in the table, over more lists, so the measure errs to the safe side. Inside a list vectors are rotated at random and kept as blocks of columns: after each block the
distance so far, scaled up, is tested against the distance to beat; a candidate that would lie below it only
with small probability is abandoned. Survivors are measured exactly, in double precision, on the original vectors.
Two rounds: the nearest ``SEED_LISTS`` lists give each query a distance to beat, with which the others are scanned.

Lists grow with the root of the table. A list longer than ``GROUP_VALUES`` numbers is split into parts, and the queries that probe it, if more
than that, into blocks, so that a list holding a third of all vectors, or very many queries, spread over tasks; other lists travel once per
round, and so do their queries.

Defined cases: vectors that are null, of another length than most, all zero, or hold null or non-finite components
take no part, nor do rows without id; equal vectors tie to the smaller id; repeated rows of a query's own id are not its neighbours;
with fewer candidates than ``k`` all are returned; an empty table gives no row; only the id and vector columns are read, so no further
column can clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, materialize

#: Vectors the centroids are fitted on (the first by a hash of their id), at most; of these per list, at least.
SAMPLE, LEAST_PER_LIST = 65_536, 4
#: Share of the nearest in the sample that the probed lists must hold, for so many of its vectors as queries.
RECALL, JUDGES = 0.97, 512
SEED_LISTS = 2
#: Numbers in the vectors of one part of a list, and of one block of queries.
GROUP_VALUES = 1 << 20
#: Numbers in a matrix of distances held at once.
MATRIX_VALUES = 1 << 22
COLUMNS_PER_BLOCK = 16
#: Width of the test: larger abandons less. At 2.1 a true neighbour is lost with a probability of about 1e-3.
WIDTH = 2.1


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v (doubles) of the rows that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & (F.size("v") > 0))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(finite & F.exists("v", lambda x: x != 0))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances to the centres, up to a constant per row."""
    return (centres ** 2).sum(1) - 2 * x @ centres.T


def _pieces(x: np.ndarray, others: int) -> list[np.ndarray]:
    """Rows of ``x`` in pieces whose distances to ``others`` vectors fit in memory."""
    return np.array_split(x, len(x) * others // MATRIX_VALUES + 1)


def homes(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row."""
    return np.concatenate([_squares(part, centres).argmin(1) for part in _pieces(x, len(centres))])


def fit_centres(sample: np.ndarray, lists: int, rounds: int = 10) -> np.ndarray:
    """Lloyd's iterations on the sample; a centre without points stays where it is."""
    rng = np.random.default_rng(7)
    centres = sample[rng.choice(len(sample), lists, replace=False)].copy()
    for _ in range(rounds):
        near = homes(sample, centres)
        count = np.bincount(near, minlength=lists)
        total = np.stack([np.bincount(near, sample[:, j], lists) for j in range(sample.shape[1])], axis=1)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


def probes_needed(sample: np.ndarray, centres: np.ndarray, k: int, recall: float) -> int:
    """Lists to probe so that they hold this share of the ``k`` nearest in the sample, for its first ``JUDGES`` vectors."""
    home, ranks, at = homes(sample, centres), [], 0
    k = min(k, len(sample) - 1)
    if k < 1:
        return 1
    for judges in _pieces(sample[:JUDGES], len(sample)):
        near = _squares(judges, sample)
        near[np.arange(len(judges)), np.arange(at, at + len(judges))] = np.inf
        at += len(judges)
        nearest_k = np.argpartition(near, k - 1, axis=1)[:, :k]
        place = _squares(judges, centres).argsort(axis=1, kind="stable").argsort(axis=1)
        ranks.append(np.take_along_axis(place, home[nearest_k], axis=1).ravel())
    ranks = np.sort(np.concatenate(ranks))
    return int(ranks[math.ceil(recall * len(ranks)) - 1]) + 1


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(11).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def scan_list(ids: np.ndarray, originals: np.ndarray, blocks: list[np.ndarray], query_id: int, query: np.ndarray, turned: np.ndarray,
              bound: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and exact distances of up to ``k`` nearest in one list part that can lie within ``bound``."""
    dims = len(query)
    own = ids != query_id
    head = np.flatnonzero(own)[:4 * k] if math.isinf(bound) else np.empty(0, np.int64)
    exact = np.sqrt(((originals[head] - query) ** 2).sum(1))
    if len(head) >= k:
        bound = float(np.partition(exact, k - 1)[k - 1])
    rest = own.copy()
    rest[head] = False
    alive = np.flatnonzero(rest)
    so_far, seen = np.zeros(len(alive)), 0
    for block in blocks:
        at = turned[seen:seen + block.shape[1]]
        so_far += ((block[alive] - at) ** 2).sum(1)
        seen += block.shape[1]
        # a last test of all columns leaves room for rounding only
        limit = bound * (1 + WIDTH / math.sqrt(seen)) * math.sqrt(seen / dims) if seen < dims else bound * (1 + 1e-4) + 1e-6
        keep = so_far <= limit * limit
        alive, so_far = alive[keep], so_far[keep]
        if not len(alive):
            break
    found = np.concatenate((head, alive))
    distance = np.concatenate((exact, np.sqrt(((originals[alive] - query) ** 2).sum(1))))
    first = np.lexsort((ids[found], distance))[:k]
    return ids[found][first], distance[first]


def nearest(vectors: DataFrame, query_rows, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", probes: float | None = None,
            recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` nearest found. ``query_rows``: condition on vec_id that marks the queries.
    ``probes``: share of the lists to probe; without it, as many as ``recall`` needs."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    valid = usable(vectors, id_col, vector_col)
    shape = valid.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n"), F.count(F.when(query_rows, 1)).alias("q")).orderBy(F.desc("n"), "dims").first()
    result = "query_id long, rank int, vec_id long, score double"
    if shape is None:
        return spark.createDataFrame([], result)
    dims, n, n_queries = shape.dims, shape.n, shape.q
    valid = valid.where(F.size("v") == dims)
    lists = max(1, math.isqrt(n))
    drawn = _matrix(valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(SAMPLE, 64 * lists)).select("v").toPandas()["v"])
    centres = fit_centres(drawn, max(1, min(lists, len(drawn) // LEAST_PER_LIST)))
    turn = rotation(dims)
    probed = probes_needed(drawn, centres, k, recall) if probes is None else max(1, math.ceil(probes * len(centres)))
    group_rows = max(1, GROUP_VALUES // dims)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = _matrix(batch["v"])
                yield batch.assign(cell=homes(x, centres).astype(np.int32), turned=list((x @ turn).astype(np.float32)))

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                cells = [row for part in _pieces(_matrix(batch["v"]), len(centres))
                         for row in np.argsort(_squares(part, centres), axis=1, kind="stable")[:, :probed].astype(np.int32)]
                yield batch.assign(cells=cells)

    index = materialize(valid.mapInPandas(deal, "vec_id long, v array<double>, cell int, turned array<float>"), "vector-index")
    asked = materialize(valid.where(query_rows).mapInPandas(choose, "vec_id long, v array<double>, cells array<int>"), "vector-queries")
    asked = asked.withColumnRenamed("vec_id", "query_id")
    sizes = index.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(group_rows)).cast("int").alias("parts"))

    def scan(key: tuple, rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            ids, originals, turned = rows["vec_id"].to_numpy(), _matrix(rows["v"]), np.stack(rows["turned"].to_numpy())
            columns = [np.ascontiguousarray(turned[:, j:j + COLUMNS_PER_BLOCK]) for j in range(0, dims, COLUMNS_PER_BLOCK)]
            for q, v, bound in zip(queries["query_id"], queries["v"], queries["bound"], strict=True):
                query = np.asarray(v, float)
                got, distance = scan_list(ids, originals, columns, q, query, query @ turn, bound, k)
                out += [(q, i, d) for i, d in zip(got.tolist(), distance.tolist(), strict=True)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    def scanned(queries: DataFrame, turns: Column) -> DataFrame:
        """Each of ``queries`` (with its bound) in its lists of the given turns."""
        # one row per list, fewer than SAMPLE / LEAST_PER_LIST
        probing = asked.select(F.posexplode("cells").alias("at", "cell")).where(turns).groupBy("cell").agg(
            F.ceil(F.count("*") / F.lit(group_rows)).cast("int").alias("blocks"))
        grid = materialize(sizes.join(probing, "cell"), "vector-grid")
        pairs = (queries.select("query_id", "v", "bound", F.posexplode("cells").alias("at", "cell")).where(turns).join(F.broadcast(grid), "cell")
                 .withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks").cast("long")).cast("int"))
                 .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
        dealt = (index.join(F.broadcast(grid), "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts").cast("long")).cast("int"))
                 .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
        group = ["cell", "part", "block"]
        return (dealt.select(*group, "vec_id", "v", "turned").groupBy(*group)
                .cogroup(pairs.select(*group, "query_id", "v", "bound").groupBy(*group)).applyInPandas(scan, "query_id long, vec_id long, score double"))

    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    no_bound = F.lit(float("inf"))
    seeds = materialize(scanned(asked.withColumn("bound", no_bound), F.col("at") < SEED_LISTS), "vector-seeds")
    place = F.row_number().over(ranked)
    bounds = seeds.withColumn("place", place).where(F.col("place") == k).select("query_id", F.col("score").alias("bound"))
    others = scanned(asked.join(bounds, "query_id", "left").withColumn("bound", F.coalesce("bound", no_bound)), F.col("at") >= SEED_LISTS)
    found = seeds.unionByName(others)
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
