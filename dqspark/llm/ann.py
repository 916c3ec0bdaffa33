"""Approximate nearest neighbours by multiprobe p-stable hashing (operator 6).

Vectors are scaled to length 1, so the nearest by Euclid is the nearest by
cosine. A table hashes a vector to ``HASHES`` cells ``floor((a . v + b) /
WIDTH)`` with normal ``a``; a query visits, per table, its own bucket and the
``PROBES`` - 1 perturbed ones likeliest to hold its neighbours: perturbations
step cells down or up, in order of the summed squared distances to the cell
borders. Candidates of all tables are merged and ranked by the exact cosine in
double precision on the original vectors.

Rows that repeat an id and its vector are one row, with a number. Tables and
visits are pairs of bucket and number; the vectors join them last. These joins
are merge joins: a query's visits are hundreds of rows, which Spark sizes as
its one row and would broadcast. A bucket is met in parts of
about ``PART`` rows, dealt by id and vector, so neither copies of one vector
nor an id of many vectors gather in a task; a part ranks its ids by their best
row, and the k best ids of every part hold the k best of all. A query that finds fewer than ``k`` is searched exactly,
in blocks, against all rows.

Defined cases: vectors that are NULL, empty, zero or hold a NULL or non-finite
component take no part, neither as query nor as candidate; NULL ids take no
part; rows with the query's id are its own; vectors of another length are never
candidates; ties go to the smaller ``vec_id``; rows that repeat an id with
other vectors count by their best score; an empty table gives no row; extra
columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import saved

TABLES = 4
HASHES = 6
WIDTH = 2.2
PROBES = 80
PART = 4000
ASKED = 500
"""Queries whose visits a task makes, about."""
EVERY = 50


def family(dim: int, table: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash functions of a table for vectors of ``dim`` components."""
    rng = np.random.default_rng([dim, table, 20])
    return rng.normal(size=(dim, HASHES)), rng.uniform(0, WIDTH, HASHES)


def scaled(x: np.ndarray) -> np.ndarray:
    """Vectors (last axis) times the power of two that brings their largest
    component to between 1/2 and 1: exact, and squares neither overflow nor
    vanish."""
    _, exponent = np.frexp(np.abs(x).max(axis=-1, keepdims=True))
    return np.ldexp(x, -exponent)


def perturbations(down: np.ndarray, probes: int) -> list[np.ndarray]:
    """Steps (-1, 0, 1 per hash) in order of estimated success; ``down`` holds
    the distances to the lower cell borders, in cells."""
    k = len(down)
    if probes == 1:
        return [np.zeros(k, np.int64)]
    cost = np.concatenate([down ** 2, (1 - down) ** 2])
    order = np.argsort(cost, kind="stable")
    out, heap = [np.zeros(k, np.int64)], [(float(cost[order[0]]), (0,))]
    while heap and len(out) < probes:
        total, chosen = heapq.heappop(heap)
        steps = order[list(chosen)]
        if len(set((steps % k).tolist())) == len(steps):
            step = np.zeros(k, np.int64)
            step[steps % k] = np.where(steps < k, -1, 1)
            out.append(step)
        at = chosen[-1]
        if at + 1 < 2 * k:
            further = float(cost[order[at + 1]])
            heapq.heappush(heap, (total - float(cost[order[at]]) + further, (*chosen[:-1], at + 1)))
            heapq.heappush(heap, (total + further, (*chosen, at + 1)))
    return out


def _hash_rows(probes: int):
    """One row per table and visited bucket: the bucket's name and the vector's number."""

    def run(batches):
        tables: dict = {}
        for batch in batches:
            numbers, vectors = batch.column("row").to_pylist(), batch.column("embedding").to_pylist()
            out_b, out_n = [], []
            for n, v in zip(numbers, vectors):
                x = scaled(np.array(v, float))
                unit, dim = x / np.linalg.norm(x), len(x)
                for t in range(TABLES):
                    if (dim, t) not in tables:
                        tables[dim, t] = family(dim, t)
                    a, b = tables[dim, t]
                    place = (unit @ a + b) / WIDTH
                    cell = np.floor(place).astype(np.int64)
                    for step in perturbations(place - cell, probes):
                        out_b.append(f"{dim}:{t}:" + ",".join(map(str, (cell + step).tolist())))
                        out_n.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(out_b, pa.string()), pa.array(out_n, pa.int64())], names=["bucket", "row"])
    return run


def _hashed(vectors: DataFrame, probes: int) -> DataFrame:
    return vectors.select("row", "embedding").mapInArrow(_hash_rows(probes), "bucket string, row long")


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table.column("embedding").combine_chunks().flatten().to_numpy().astype(np.float64, copy=False)
    return scaled(flat.reshape(len(table), -1))


CELLS = 1_000_000
"""Numbers of a matrix that a task holds at once while it ranks, about."""


def _near(c: np.ndarray, norm: np.ndarray, first: np.ndarray, v: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Of each query (row of ``v``), which ids may be among its k nearest.
    Matrix products differ from row by row sums in the last digits; an id below
    the (k+1)-th best by more than both may err is surely none of the k."""
    score = (v / np.sqrt((v * v).sum(axis=1, keepdims=True))) @ (c / norm[:, None]).T
    if len(first) < len(c):
        score = np.maximum.reduceat(score, first, axis=1)
    score[own] = -np.inf
    if len(first) <= 4 * k:
        return score > -np.inf
    slack = 16 * (c.shape[1] + 8) * np.finfo(float).eps
    edge = -np.partition(-score, k, axis=1)[:, k:k + 1]
    return (score >= edge - slack) & (score > -np.inf)


def _rank(k: int):
    """Of one part of a bucket, each query's k nearest."""

    def run(key, queries, rows):
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not len(queries) or not len(rows):
            return schema.empty_table()
        c, ids = _matrix(rows), rows.column("vec_id").to_numpy()
        norm = np.sqrt((c * c).sum(axis=1))
        # Rows of an id side by side: the cut is among ids, each by its best row.
        order = np.argsort(ids, kind="stable")
        c, norm = c[order], norm[order]
        ids, first, count = np.unique(ids[order], return_index=True, return_counts=True)
        asked, v = queries.column("vec_id").to_numpy(), _matrix(queries)
        step, most = max(1, CELLS // len(c)), max(1, CELLS // c.shape[1])
        out = []
        for at in range(0, len(v), step):
            near = _near(c, norm, first, v[at:at + step], asked[at:at + step, None] == ids, k)
            q, i = np.nonzero(near)
            q += at
            # Every row of these ids, a row by row sum: equal vectors get equal scores wherever they stand.
            pair = np.repeat(np.arange(len(q)), count[i])
            start = np.cumsum(count[i]) - count[i]
            row = first[i][pair] + np.arange(len(pair)) - start[pair]
            score = np.empty(len(pair))
            for a in range(0, len(pair), most):
                x, y = c[row[a:a + most]], v[q[pair[a:a + most]]]
                score[a:a + most] = (x * y).sum(axis=1) / (norm[row[a:a + most]] * np.sqrt((y * y).sum(axis=1)))
            best = np.maximum.reduceat(score, start) if len(q) else score
            best_first = np.lexsort((ids[i], -best, q))
            q, i, best = q[best_first], i[best_first], best[best_first]
            kept = np.arange(len(q)) - np.searchsorted(q, q) < k
            out.append(pa.table([asked[q[kept]], ids[i[kept]], best[kept]], schema=schema))
        return pa.concat_tables(out)
    return run


_RANKED = "query_id long, vec_id long, score double"


def _meet(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """Queries and rows by (bucket, part), ranked within each."""
    return queries.groupBy("bucket", "part").cogroup(rows.groupBy("bucket", "part")).applyInArrow(_rank(k), _RANKED)


def _nearest(ranked: DataFrame, k: int) -> DataFrame:
    best = ranked.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order).cast("int")).filter(f"rank <= {k}").select(
        "query_id", "rank", "vec_id", "score")


def usable(vectors: DataFrame) -> DataFrame:
    """Rows ``vec_id, embedding`` that take part; float components stay float,
    half the bytes of the doubles they become where they are scored."""
    v = F.col("embedding")
    kind = "array<float>" if vectors.select(v).dtypes[0][1] == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast(kind).alias("embedding"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)).filter(finite).filter(
        F.exists(v, lambda x: x != 0))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, probes: int = PROBES) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest found of each query row."""
    def numbered(rows: DataFrame, label: str) -> DataFrame:
        return saved(usable(rows).distinct().withColumn("row", F.monotonically_increasing_id()), label)

    rows, asked = numbered(vectors, "ann-rows"), numbered(queries, "ann-asked")
    index = saved(_hashed(rows, 1), "ann-index")
    parts = index.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))

    def part(n):
        return F.pmod(F.xxhash64("vec_id", "embedding"), n).cast("int").alias("part")

    def with_vectors(places: DataFrame, of: DataFrame) -> DataFrame:
        return places.join(parts.hint("merge"), "bucket").join(of.hint("merge"), "row")

    stored = with_vectors(index, rows).select("bucket", part(F.col("parts")), "vec_id", "embedding")
    visits = with_vectors(_hashed(asked.repartition(-(-asked.count() // ASKED) or 1), probes), asked).select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "vec_id", "embedding")
    found = saved(_nearest(_meet(visits, stored, k), k), "ann-found")

    full = found.filter(f"rank = {k}").select(F.col("query_id").alias("vec_id"))
    short = saved(asked.join(full.hint("merge"), "vec_id", "left_anti"), "ann-short")
    if short.isEmpty():
        return found
    blocks = max(1, -(-rows.count() // PART))
    whole = F.concat(F.size("embedding").cast("string"), F.lit(":all")).alias("bucket")
    exact = _meet(short.select(whole, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("part"), "vec_id", "embedding"),
                  rows.select(whole, part(F.lit(blocks)), "vec_id", "embedding"), k)
    kept = found.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti")
    return kept.unionByName(_nearest(exact, k))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))
