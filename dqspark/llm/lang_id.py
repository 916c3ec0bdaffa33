"""Language identification by nearest centroid (operator 2).

A text's letters, lower-cased, give n-grams of one to three characters (word
edges included) hashed into ``DIM`` counts; counts are weighted ``log(1 + c)``
times the inverse document frequency and scaled to length 1. Each language has
``CENTROIDS`` centroids (spherical k-means); a text takes the language of the
centroid with the largest cosine. It is *rejected* when even that cosine is
below the language's limit: ``SLACK`` times the cosine to their own centroids
that all but ``LOWEST`` of the language's training texts reach.

Document frequencies and limits cover all training rows (the limits through
histograms of ``_BIN`` wide bins). The centroids are fitted on a bounded
sample, at most ``PER_LANGUAGE`` distinct rows of each language (those with the
smallest hash of id and text). Only text and lang of training rows are read; a
prediction reads text. Counts are made for at most ``_ROWS`` texts at a time.

Defined cases: NULL text, or text without a letter, is ``und`` with score 0
and rejected; with no training row at all everything is ``und``; ties take the
first language in alphabetical order; repeated rows are predicted each; whole
texts of any length count; an empty table gives no row; extra columns are
ignored by ``predict`` and kept by ``keep_accepted``.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .common import fold, fresh, saved, text_slices, tidy

BITS = 11
DIM = 1 << BITS
CENTROIDS = 4
PER_LANGUAGE = 1500
PARTS = 64
LOWEST = 0.002
SLACK = 0.9
FOLDS = 5
UNKNOWN = "und"
_SLICE = 500_000
_ROWS = 256
_BIN = 1e-3
_LETTER = None


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTER


def ngram_counts(texts: pa.Array) -> np.ndarray:
    """``(len(texts), DIM)`` counts of hashed letter n-grams."""
    rows = [" " + t.lower() + " " if t else " " for t in texts.to_pylist()]
    codes = np.frombuffer("".join(rows).encode("utf-32-le", "replace"), "<u4")
    doc = np.repeat(np.arange(len(rows)), np.fromiter(map(len, rows), np.int64, len(rows)))
    letter = _letters()[codes]
    # Every run of other characters is one word edge.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:]
    x, doc, letter = np.where(letter, codes, 0)[keep].astype(np.uint64), doc[keep], letter[keep]
    out = np.zeros(len(rows) * DIM, np.int64)
    h, some, inside = np.zeros(len(x), np.uint64), np.zeros(len(x), bool), np.ones(len(x), bool)
    with np.errstate(over="ignore"):
        for n in range(3):
            m = len(x) - n
            if m <= 0:
                break
            h = h[:m] * np.uint64(1_000_003) + x[n:] + np.uint64(1)
            some, inside = some[:m] | letter[n:], inside[:m] & (doc[:m] == doc[n:])
            if n == 2:  # a word edge inside a trigram joins two words
                inside &= letter[1:1 + m]
            at = some & inside
            slot = (((h[at] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)
            out += np.bincount(doc[:m][at] * DIM + slot, minlength=len(out))
    return out.reshape(len(rows), DIM)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm > 0, norm, 1)


def cluster(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from farthest-first seeds; at most ``k`` centroids."""
    seeds = [v.mean(axis=0)]
    for _ in range(k - 1):
        seeds.append(v[np.argmin(np.max(v @ np.array(seeds).T, axis=1))])
    c = np.array(seeds)
    for _ in range(rounds):
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        own = np.argmax(v @ c.T, axis=1)
        c = np.array([v[own == i].mean(axis=0) for i in range(len(c)) if (own == i).any()])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Model:
    languages: list[str]     # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    limits: dict[str, float]


def _blocks(batches, column: str = "text"):
    """Slices of few rows and little text each: dense counts stay small."""
    for batch in batches:
        for a, b in text_slices(batch, column, most=_SLICE):
            for first in range(a, b, _ROWS):
                yield batch.slice(first, min(_ROWS, b - first))


def _count_rows(batches):
    for rows in _blocks(batches):
        counts = ngram_counts(rows.column("text")).astype("<u4")
        yield pa.RecordBatch.from_arrays(
            [rows.column("lang"), pa.array([r.tobytes() for r in counts], pa.binary())], names=["lang", "counts"])


def _document_frequency(batches):
    df, n = np.zeros(DIM, np.int64), 0
    for rows in _blocks(batches):
        df += np.count_nonzero(ngram_counts(rows.column("text")), axis=0)
        n += rows.num_rows
    # The last slot holds the number of documents.
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIM + 1)), pa.array(np.append(df, n))], names=["slot", "n"])


def _own_cosines(model: "Model"):
    bins = int(round(1 / _BIN)) + 1

    def run(batches):
        seen = {}
        for rows in _blocks(batches):
            counts = ngram_counts(rows.column("text"))
            cosine = vectors(counts, model.idf) @ model.centroids.T
            has, langs = counts.any(axis=1), np.array(rows.column("lang").to_pylist(), object)
            for lang in set(langs[has]) & set(model.languages):
                own = cosine[:, [x == lang for x in model.languages]].max(axis=1)[has & (langs == lang)]
                seen[lang] = seen.get(lang, 0) + np.bincount(np.clip(own / _BIN, 0, bins - 1).astype(int), minlength=bins)
        for lang, n in seen.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(n[some])],
                                             names=["lang", "bin", "n"])
    return run


def _fit_language(idf: np.ndarray):
    def run(key, table):
        counts = np.array([np.frombuffer(r, "<u4") for r in table.column("counts").to_pylist()])
        v = vectors(counts, idf)
        v = v[np.linalg.norm(v, axis=1) > 0]
        if not len(v):
            return pa.table({"lang": pa.array([], pa.string()), "centroid": pa.array([], pa.binary())})
        c = cluster(v, min(CENTROIDS, len(v)))
        return pa.table({"lang": pa.array([key[0].as_py()] * len(c), pa.string()),
                         "centroid": pa.array([x.astype("<f4").tobytes() for x in c], pa.binary())})
    return run


def fit(train: DataFrame) -> Model:
    """Fit on rows ``doc_id, text, lang``; those without a language are left out."""
    rows = train.filter("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id", "text").alias("draw"))
    first = rows.select("lang", "draw").distinct()   # repeated rows are one draw
    # The first of each part, then of what the parts leave: no task reads a whole language.
    for by in (["lang", F.pmod("draw", F.lit(PARTS))], ["lang"]):
        first = first.withColumn("nth", F.row_number().over(W.partitionBy(*by).orderBy("draw"))).filter(f"nth <= {PER_LANGUAGE}")
    limits_by = {r.lang: r["last"] for r in first.groupBy("lang").agg(F.max("draw").alias("last")).collect()}  # one number per language
    if not limits_by:
        return Model([], np.zeros((0, DIM)), np.ones(DIM), {})
    last = F.create_map(*[F.lit(x) for kv in limits_by.items() for x in kv])
    sample = saved(rows.filter(F.col("draw") <= last[F.col("lang")]).dropDuplicates(["lang", "draw"])
                   .select("lang", "text").mapInArrow(tidy(_count_rows), "lang string, counts binary"), "language-sample")
    texts = rows.select("lang", "text")
    df = np.zeros(DIM + 1)
    for r in texts.mapInArrow(tidy(_document_frequency), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():  # DIM + 1 rows
        df[r.slot] = r.n
    idf = np.log((df[-1] + 1) / (df[:-1] + 1)) + 1
    got = sorted(sample.groupBy("lang").applyInArrow(_fit_language(idf), "lang string, centroid binary")
                 .collect(), key=lambda r: (r.lang, r.centroid))  # CENTROIDS rows per language
    model = Model([r.lang for r in got], np.array([np.frombuffer(r.centroid, "<f4") for r in got], float).reshape(-1, DIM), idf, {})
    bins = texts.mapInArrow(tidy(_own_cosines(model)), "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    seen = defaultdict(dict)
    for r in bins.collect():      # at most 1 / _BIN rows per language
        seen[r.lang][r.bin] = r.n
    return replace(model, limits={lang: SLACK * _low(seen[lang]) for lang in set(model.languages)})


def _low(counts: dict[int, int]) -> float:
    """The value that all but the ``LOWEST`` share reach, from counts by bin."""
    may_miss, done = LOWEST * sum(counts.values()), 0
    for b in sorted(counts):
        done += counts[b]
        if done > may_miss:
            return b * _BIN
    return 0.0


def classify(texts: pa.Array, model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and rejection of each text."""
    counts = ngram_counts(texts)
    has = counts.any(axis=1)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    cosine = vectors(counts, model.idf) @ model.centroids.T
    best = np.argmax(cosine, axis=1)
    names = [model.languages[i] if ok else UNKNOWN for i, ok in zip(best, has)]
    score = np.where(has, np.clip(cosine[np.arange(len(best)), best], 0, 1), 0.0)
    low = np.array([model.limits[model.languages[i]] for i in best])
    return names, score, ~has | (score < low)


def _predict(model: Model, carried: list[str], outputs: dict[str, str]):
    def run(batches):
        for rows in _blocks(batches):
            names, score, rejected = classify(rows.column("text"), model)
            made = {"lang_pred": pa.array(names, pa.string()), "score": pa.array(score), "rejected": pa.array(rejected)}
            yield pa.RecordBatch.from_arrays([rows.column(c) for c in carried] + [made[k] for k in outputs],
                                             names=carried + list(outputs.values()))
    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", FOLDS) == 0).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    out = {k: k for k in ("lang_pred", "score", "rejected")}
    return rows.mapInArrow(tidy(_predict(model, ["doc_id", "held_out"], out)),
                           "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns as they were."""
    name = fresh(docs, "dq_rejected")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.BooleanType())])
    docs_columns = docs.columns
    marked = docs.mapInArrow(tidy(_predict(model, docs_columns, {"rejected": name})), schema)
    return marked.filter(~F.col(name)).select(*docs_columns)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(fold("doc_id", FOLDS) != 0).select("doc_id", "text", "lang")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs, fit(training_rows(docs)))
