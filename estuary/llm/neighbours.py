"""Operator 8: nearest neighbours by learned partitions.

On a bounded sample the graph of nearest neighbours is built and cut into
balanced parts: median splits along principal directions, then moves that
bring neighbours together while no part outgrows its share.  A small network
learns to tell, from a vector, in which parts its neighbours lie.  Every
vector is indexed under its ``HOMES`` likeliest parts; a query visits its
``PROBES`` likeliest parts, where all vectors are compared in double precision.

Parts and the queries that visit them meet in blocks of bounded size, so a
part of any size spreads over tasks.  Equal vectors are one row that keeps
only the ``k + 1`` smallest ids, since no further one can be among the
nearest ``k``; the counting is partial before any shuffle.

``SAMPLE`` bounds what the index is fitted on; every vector is indexed.
Defined results: vectors that are null, all zero, or hold null or non-finite
components take no part, nor do rows without an id, or of another dimension
than most; an id that repeats counts once, with its least vector; with fewer
candidates than ``k`` all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from estuary.llm.common import ship_package, stored, table

K = 20
QUERY_STEP = 20
SAMPLE = 8192
PART_SAMPLE = 128
MAX_PARTS = 64
PROBES = 28
#: Parts that hold each vector.
HOMES = 2
GRAPH_K = 32
BLOCK, QUERY_BLOCK = 4096, 1024


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices of each row's k rows of largest inner product, itself left out."""
    out = np.empty((len(x), k), dtype=np.int64)
    for start in range(0, len(x), 512):
        score = x[start:start + 512] @ x.T
        score[np.arange(len(score)), np.arange(start, start + len(score))] = -np.inf
        out[start:start + 512] = np.argpartition(-score, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, sweeps: int = 12) -> np.ndarray:
    """A part for each row, sizes within a twentieth of their mean."""
    part = np.zeros(len(x), dtype=np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        groups.sort(key=len)
        rows = groups.pop()
        centred = x[rows] - x[rows].mean(axis=0)
        axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = np.argsort(centred @ axis, kind="stable")
        groups += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
    for p, rows in enumerate(groups):
        part[rows] = p
    room = int(np.ceil(1.05 * len(x) / parts))
    size = np.bincount(part, minlength=parts)
    for _ in range(sweeps):
        links = np.zeros((len(x), parts))
        np.add.at(links, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1)
        np.add.at(links, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)
        best = links.argmax(axis=1)
        gain = links[np.arange(len(x)), best] - links[np.arange(len(x)), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable").tolist():
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


class Router:
    """One hidden layer from a vector to the odds of each part."""

    def __init__(self, dim: int, parts: int, hidden: int = 128):
        rng = np.random.default_rng(7)
        self.w = [rng.normal(0, 1 / np.sqrt(dim), (dim, hidden)), np.zeros(hidden),
                  rng.normal(0, 1 / np.sqrt(hidden), (hidden, parts)), np.zeros(parts)]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]

    def fit(self, x: np.ndarray, target: np.ndarray, epochs: int = 15, batch: int = 256) -> None:
        """Cross entropy against the parts of the neighbours, by Adam."""
        rng = np.random.default_rng(11)
        first, second, step = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for rows in np.array_split(order, max(1, len(order) // batch)):
                a, y = x[rows], target[rows]
                hidden = np.maximum(a @ self.w[0] + self.w[1], 0)
                z = hidden @ self.w[2] + self.w[3]
                p = np.exp(z - z.max(axis=1, keepdims=True))
                d = (p / p.sum(axis=1, keepdims=True) - y) / len(rows)
                back = (d @ self.w[2].T) * (hidden > 0)
                step += 1
                for k, g in enumerate([a.T @ back, back.sum(axis=0), hidden.T @ d, d.sum(axis=0)]):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.w[k] = self.w[k] - 2e-3 * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)


def train_router(x: np.ndarray) -> Router:
    """Fit on the sample: graph, balanced parts, classifier."""
    parts = int(max(1, min(MAX_PARTS, len(x) // PART_SAMPLE)))
    router = Router(x.shape[1], parts)
    if parts > 1:
        graph = neighbour_graph(x, min(GRAPH_K, len(x) - 1))
        part = balanced_parts(x, graph, parts)
        target = np.zeros((len(x), parts))
        np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1)
        target[np.arange(len(x)), part] += 1
        router.fit(x, target / target.sum(axis=1, keepdims=True))
    return router


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): ids with a vector that takes part, each once."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & F.exists("v", lambda x: x != 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (sizes[0].n if sizes else 0)).groupBy("id").agg(F.min("v").alias("v"))


def matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def routed(rows: DataFrame, router: Router, probes: int, extra: str, kind: str) -> DataFrame:
    """A row for each of the likeliest parts of a vector, with one further column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            score = router.logits(matrix(batch.column(1), router.w[0].shape[0]))
            best = np.argsort(-score, axis=1, kind="stable")[:, :probes]
            row = pa.array(np.repeat(np.arange(batch.num_rows), best.shape[1]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(best.ravel())],
                                             names=[extra, "v", "part"])

    return rows.select(extra, "v").mapInArrow(run, f"{extra} {kind}, v array<double>, part bigint")


def dealt(rows: DataFrame, own: str, own_size: int, other: DataFrame, other_size: int, mine: str, theirs: str, salt: str) -> DataFrame:
    """Rows with their own block and a copy for each of the other side's blocks of the part."""
    counts = rows.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / own_size).cast("int").alias("n"))
    others = other.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / other_size).cast("int").alias("m"))
    both = F.broadcast(counts.join(others, "part"))  # a row a part, at most MAX_PARTS
    return rows.join(both, "part").select(
        "*", F.pmod(F.xxhash64(salt), F.col("n")).cast("int").alias(mine), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias(theirs)).drop("n", "m")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, probes: int = PROBES,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query, its own row left out."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = stored(usable(vectors, id_col, vec_col), "vectors")
    asked = rows.join(queries.select(F.col(id_col).cast("long").alias("id")).distinct(), "id", "left_semi")
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()  # the bounded training sample
    schema = "query_id bigint, vec_id bigint, score double"
    if not sample:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    router = train_router(np.array([r.v for r in sample]))
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    distinct = rows.withColumn("r", place).where(F.col("r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    index = stored(routed(distinct, router, HOMES, "ids", "array<bigint>"), "index")
    visits = stored(routed(asked, router, probes, "id", "bigint"), "visits")
    here = dealt(index.withColumn("least", F.col("ids")[0]), "n", BLOCK, visits, QUERY_BLOCK, "block", "qblock", "least")
    there = dealt(visits, "n", QUERY_BLOCK, index, BLOCK, "qblock", "block", "id")
    both = here.select("part", "block", "qblock", F.lit(None).cast("long").alias("id"), "ids", "v").union(
        there.select("part", "block", "qblock", "id", F.lit(None).cast("array<long>"), "v"))

    def run(unit: pd.DataFrame) -> pd.DataFrame:
        is_query = unit["id"].notna().to_numpy()
        if is_query.all() or not is_query.any():
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        asked, base = np.stack(unit["v"][is_query].to_list()), np.stack(unit["v"][~is_query].to_list())
        ids, lists = unit["id"][is_query].to_numpy(dtype=np.int64), unit["ids"][~is_query].to_list()
        product = asked @ base.T
        most = min(k + 1, len(base))
        level = -np.partition(-product, most - 1, axis=1)[:, most - 1]
        # the blocked product rounds differently from place to place: keep what may tie, then score in one fixed order
        q, b = np.nonzero(product >= (level - 1e-9 * (1 + np.abs(level)))[:, None])
        score = np.zeros(len(q))
        for d in range(asked.shape[1]):
            score += asked[q, d] * base[b, d]
        n = np.array([len(lists[j]) for j in b])
        row = np.repeat(np.arange(len(q)), n)
        found = np.concatenate([lists[j] for j in b])
        who = ids[q][row]
        keep = found != who
        who, found, score = who[keep], found[keep], score[row][keep]
        order = np.lexsort((found, -score, who))
        who, found, score = who[order], found[order], score[order]
        start = np.flatnonzero(np.append(True, who[1:] != who[:-1])) if len(who) else np.zeros(0, dtype=np.int64)
        rank = np.arange(len(who)) - np.repeat(start, np.diff(np.append(start, len(who))))
        top = rank < k
        return pd.DataFrame({"query_id": who[top], "vec_id": found[top], "score": score[top]})

    partial = both.groupBy("part", "block", "qblock").applyInPandas(run, schema)
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # met in both its homes, a vector has the very same score twice
    return partial.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))


#: Exact on small tables, whose parts are all visited.
OP8_SQL = """
WITH scored AS (
  SELECT q.vec_id AS query_id, e.vec_id, list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS score
  FROM embeddings q, embeddings e WHERE q.vec_id % 20 = 0 AND e.vec_id <> q.vec_id),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 20
"""
