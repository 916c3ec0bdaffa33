"""Toxicity by compression distance (operator 5).

Two zstandard dictionaries of equal size are trained, one on toxic and one on
ordinary text: the character runs of ``GRAM`` bytes whose document counts
speak most clearly for the class (G statistic; at least a tenth of the largest
for the toxic one). A text is read as windows of ``WORDS`` words; a window's
distance is its length compressed with the ordinary dictionary less its length
with the toxic one. Matches shorter than a run are ruled out, so a window that
neither dictionary knows has distance 0. A padding that both dictionaries
hold keeps short windows compressible, so that each match shows.

The largest distance, the sum and number of positive ones and the text's
length give a probability by a logistic curve, calibrated on the same sample
and weighted to the classes' true shares.

The model is fitted on a bounded sample of labelled rows, at most ``SAMPLE``
of each class (those with the smallest hash of id and text).

Defined cases: NULL and empty texts have no window and get the score of a text
without a distance; rows without a label don't train; a row repeated with its
label is drawn once and counts as often as it stands there in the classes'
shares; without both classes every score is the share of toxic
rows (0 if none); repeated rows are scored each; whole texts of any length are
read; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import fold, saved, text_slices

GRAM = 6
WORDS = 8
SAMPLE = 4000
PARTS = 64
FOLDS = 5
LEVEL = 6
MOST_GRAMS = 2000
_PAD = bytes(range(128, 192))
_WHITE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\f\r", b"abcdefghijklmnopqrstuvwxyz     ")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WHITE).split()


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray | None
    share: float


class Distances:
    """Both compressors of a model."""

    def __init__(self, model: Model):
        import zstandard as z

        params = z.ZstdCompressionParameters.from_level(LEVEL, min_match=GRAM)
        self.presses = []
        for content in (model.ordinary, model.toxic):
            d = z.ZstdCompressionDict(content + _PAD, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            self.presses.append(z.ZstdCompressor(dict_data=d, compression_params=params).compress)

    def of(self, text: str | None) -> np.ndarray:
        words, (ordinary, toxic) = words_of(text), self.presses
        out = np.zeros(-(-len(words) // WORDS))
        for k in range(len(out)):
            window = b" " + b" ".join(words[k * WORDS:(k + 1) * WORDS]) + b" " + _PAD
            out[k] = len(ordinary(window)) - len(toxic(window))
        return out

    def features(self, text: str | None) -> list[float]:
        d = self.of(text)
        up = d[d >= 2]
        n = math.log1p(len(d))
        most = float(up.max()) if len(up) else 0.0
        return [1.0, most, min(most, 3.0), math.log1p(up.sum()), math.log1p(len(up)), n, n * math.log1p(len(up))]


def probability(model: Model, features: list[float]) -> float:
    if model.weights is None:
        return model.share
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot(model.weights, features))))))


def _gram_rows(batches):
    """Document counts of a task's runs, by class."""
    counts = {0: Counter(), 1: Counter()}

    def out():
        both = list(set(counts[0]) | set(counts[1]))
        yield pa.RecordBatch.from_arrays([pa.array(both, pa.binary()), *[
            pa.array([counts[k][g] for g in both], pa.int64()) for k in (0, 1)]], names=["gram", "n0", "n1"])
        counts[0].clear(), counts[1].clear()

    for batch in batches:
        for text, kind in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            line = b" " + b" ".join(words_of(text)) + b" "
            counts[kind].update({line[i:i + GRAM] for i in range(len(line) - GRAM + 1)})
            if len(counts[0]) + len(counts[1]) > 1_000_000:
                yield from out()
    yield from out()


def _feature_rows(model: Model):
    def run(batches):
        distances = Distances(model)
        for batch in batches:
            rows = [distances.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(rows, pa.list_(pa.float64()))],
                                             names=["toxic", "features"])
    return run


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = 30, ridge: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(h, x.T @ (w * (y - p)) - ridge * b)
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    return b


def draws(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, draw, toxic, n``: the labelled rows without their texts, which
    stay where they are until the sample is known; equal rows as one, with
    their number."""
    drawn = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("draw"))
    known = labels.filter("toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    return drawn.join(known, "doc_id").groupBy("doc_id", "draw", "toxic").agg(F.count(F.lit(1)).alias("n"))


def first_draws(rows: DataFrame) -> DataFrame:
    """The ``SAMPLE`` smallest draws of each class: first of each of ``PARTS``
    parts, so that no task reads a whole class, then of what these leave."""
    for by in (["toxic", F.pmod("draw", F.lit(PARTS))], ["toxic"]):
        rows = (rows.withColumn("nth", F.row_number().over(W.partitionBy(*by).orderBy("draw", "doc_id")))
                .filter(F.col("nth") <= SAMPLE).drop("nth"))
    return rows.select("doc_id", "draw", "toxic")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on ``doc_id, text`` of ``docs`` and ``doc_id, toxic`` (0 or 1; other labels are left out) of ``labels``."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = saved(draws(docs, labels), "toxicity-draws")
    shares = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.sum("n").alias("n")).collect()}
    total = sum(shares.values())
    share = shares.get(1, 0) / total if total else 0.0
    if len(shares) < 2:
        return Model(b"", b"", None, share)
    chosen = F.broadcast(first_draws(rows))  # 2 * SAMPLE rows of three numbers at most
    sample = saved(docs.withColumn("draw", F.xxhash64("doc_id", "text")).join(chosen, ["doc_id", "draw"])
                   .dropDuplicates(["doc_id", "draw", "toxic"]).select("toxic", "text", "draw"), "toxicity-sample")
    # Copies of a text would count as so many witnesses: one stands for all.
    once = sample.dropDuplicates(["toxic", "text"])
    size = {r.toxic: r["count"] for r in once.groupBy("toxic").count().collect()}
    grams = saved(once.select("text", "toxic").mapInArrow(_gram_rows, "gram binary, n0 long, n1 long").groupBy("gram").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).filter("n0 + n1 > 3"), "toxicity-runs")

    def best(mine: int, other: int) -> list:
        a, b, all_docs = F.col(f"n{mine}"), F.col(f"n{other}"), size[0] + size[1]
        expected = [(a + b) * F.lit(size[k] / all_docs) for k in (mine, other)]
        g = 2 * (a * F.log(a / expected[0]) + F.when(b > 0, b * F.log(b / expected[1])).otherwise(0))
        return (grams.filter(a > 3).filter(a / size[mine] > b / size[other]).select("gram", g.alias("g"))
                .orderBy(F.desc("g"), "gram").limit(MOST_GRAMS).collect())

    toxic = best(1, 0)
    toxic = [bytes(r.gram) for r in toxic if r.g >= max(15.0, toxic[0].g / 10)]
    ordinary = [bytes(r.gram) for r in best(0, 1)][:len(toxic)]
    content = [b"\n".join(reversed(x)) for x in (ordinary, toxic)]  # the clearest last: nearest, so cheapest
    bare = Model(content[0], content[1], None, share)
    got = sample.select("toxic", "text").mapInArrow(_feature_rows(bare), "toxic int, features array<double>").collect()  # 2 * SAMPLE rows at most
    y = np.array([r.toxic for r in got], float)
    drawn = {k: max(1, int((y == k).sum())) for k in (0, 1)}
    w = np.where(y == 1, shares[1] / drawn[1], shares[0] / drawn[0])
    return Model(content[0], content[1], logistic(np.array([r.features for r in got]), y, w / w.mean()), share)


def _score(model: Model):
    def run(batches):
        distances = Distances(model)
        for batch in batches:
            for a, b in text_slices(batch):
                rows = batch.slice(a, b - a)
                p = [probability(model, distances.features(t)) for t in rows.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("held_out"), pa.array(p, pa.float64()),
                     pa.array([int(x >= 0.5) for x in p], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", FOLDS) == 0).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_score(model), "doc_id long, held_out boolean, score double, predicted int")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learn = docs.filter(fold("doc_id", FOLDS) != 0)
    return score(docs, fit(learn, spark.read.parquet(f"{sf_dir}/labels.parquet")))
