"""Quality rules with a hashed n-gram log-likelihood ratio (operator 11).

Two multinomials over ``DIM`` hashed buckets of word 1- and 2-grams (A to Z
lower-cased): one of the trusted target, documents labelled of good quality,
one of the raw corpus, every document. A text's ratio is the mean, over its
n-grams, of ``log(p_target / p_raw)``: its length plays no part. The target's
counts are smoothed towards the raw corpus with the weight of ``PRIOR``
n-grams, so without a trusted document every ratio is 0.

Every document gets a verdict from one threshold, without chance: the ratio
must not lie more than ``SLACK`` below that of the ``LOWEST`` share of trusted
documents. Documents that fail the base rules (few words, or many repeated
ones) are not kept either.

All labelled documents are used, however many there are. One in ``CALIBRATE``
of them, by a hash of the id, sets the threshold (by a histogram of all their
ratios, the same however rows are dealt), all others are the target: a document
scores higher under counts that hold it. Raw counts cover all documents. Ids
meet documents by a join that Spark broadcasts while the ids are few; beyond
that each text is shuffled once, for the counts, and no text for the threshold.

Defined cases: NULL text has no words and fails the base rules; NULL ids are
never trusted; repeated rows count, and are judged, each; a document with
several labels is trusted if any of them says so; ties need no order; texts of
any length are read whole; an empty table gives no row; extra columns are
ignored by ``judge`` and kept by ``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, fresh, saved, text_slices
from .words import WHITE, Words, byte_classes, words

BITS = 16
DIM = 1 << BITS
DRAW_BITS = 16
PRIOR = 20_000.0
CALIBRATE = 4
LOWEST = 0.005
SLACK = 0.07
FOLDS = 5
MIN_WORDS = 20
MOST_REPEATED = 30
WINDOW = 8
NULL_BUCKETS = 4096
_SLICE = 4_000_000
_BIN = 1e-3
_CLASSES = byte_classes(white=WHITE)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


# --- base rules -----------------------------------------------------------------

def repeated_words(codes: np.ndarray, doc: np.ndarray, rows: int, window: int = WINDOW) -> np.ndarray:
    """Per row, the words inside windows of ``window`` (a power of two) words
    that occur at least twice in it. Windows are named exactly, by doubling."""
    name, width = codes.astype(np.int64), 1
    while width < window:
        if len(name) <= width:
            return np.zeros(rows, np.int64)
        name = pd.factorize(name[:-width] * np.int64(len(codes) + 1) + name[width:])[0].astype(np.int64)
        width *= 2
    inside = np.flatnonzero(doc[:len(name)] == doc[window - 1:])
    which = pd.factorize(doc[inside].astype(np.int64) * np.int64(len(codes) + 1) + name[inside])[0]
    again = inside[np.bincount(which)[which] > 1] if len(inside) else inside
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=rows)


def duplicate_lines(texts: pa.Array) -> np.ndarray:
    """Per row, the lines with a word that equal an earlier line of it."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.split_pattern(texts, "\n")
    doc = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    lines = pc.list_flatten(lists)
    some = pc.not_equal(pc.utf8_trim(lines, WHITE.decode()), "").to_numpy(zero_copy_only=False)
    doc, lines = doc[some], lines.filter(pa.array(some))
    code = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = ~pd.Series(doc.astype(np.int64) * np.int64(len(code) + 1) + code).duplicated().to_numpy()
    return np.bincount(doc[~first], minlength=len(texts))


def base_rules(texts: pa.Array, found: Words, codes: np.ndarray) -> dict[str, np.ndarray]:
    rows = len(texts)
    head = (found.data & 0xC0) != 0x80       # bytes that begin a code point
    return {"n_words": found.count(), "word_chars": found.per_row(head & (found.kind == 0)),
            "n_symbols": found.per_row(_SYMBOL[found.data]), "n_dup_lines": duplicate_lines(texts),
            "n_repeat_words": repeated_words(codes, found.doc, rows)}


# --- n-grams ----------------------------------------------------------------------

def ngram_buckets(found: Words, coded: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every 1- and 2-gram."""
    code = coded.indices.to_numpy(zero_copy_only=False)
    distinct = pc.ascii_lower(coded.dictionary).to_numpy(zero_copy_only=False)
    hashed = pd.util.hash_array(distinct, categorize=False) if len(distinct) else np.zeros(0, np.uint64)
    one, doc = hashed[code], found.doc
    with np.errstate(over="ignore"):
        two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]
        both = np.concatenate([one, (two ^ (two >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)])
    same = np.concatenate([np.ones(len(one), bool), doc[:-1] == doc[1:]])
    return (both[same] >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate([doc, doc[:-1]])[same]


def _count(batches):
    raw, target = np.zeros(DIM, np.int64), np.zeros(DIM, np.int64)
    for batch in batches:
        for a, b in text_slices(batch, most=_SLICE):
            part = batch.slice(a, b - a)
            found = words(part.column("text"), _CLASSES)
            bucket, doc = ngram_buckets(found, found.text.dictionary_encode())
            trusted = part.column("trusted").to_numpy(zero_copy_only=False)
            raw += np.bincount(bucket, minlength=DIM)
            target += np.bincount(bucket[trusted[doc]], minlength=DIM)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], names=["bucket", "raw", "target"])


@dataclass(frozen=True)
class Model:
    ratio: np.ndarray        # log(p_target / p_raw) of each bucket


def ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    p_raw = (raw + 1.0) / (raw.sum() + DIM)
    return np.log((target + PRIOR * p_raw) / (target.sum() + PRIOR) / p_raw)


def trusted_ids(labels: DataFrame, most: int | None = None) -> DataFrame:
    """The ids labelled of good quality and not held out, all of them unless a
    caller wants at most ``most``, those with the smallest hash; ``calibrates``
    marks those kept out of the target."""
    ids = (labels.filter("quality = 1 AND doc_id IS NOT NULL").filter(fold("doc_id", FOLDS) != 0)
           .select(F.col("doc_id").cast("long").alias("trusted_id")).distinct().withColumn("draw", F.xxhash64("trusted_id")))
    return saved((ids if most is None else _smallest(ids, most)).select(
        "trusted_id", (F.pmod(F.xxhash64(F.lit(1), "trusted_id"), F.lit(CALIBRATE)) == 0).alias("calibrates")), "trusted")


def _smallest(ids: DataFrame, most: int) -> DataFrame:
    # Hashes fall into bins of equal width; the first bins that hold at most ``most`` ids are taken whole.
    bins = ids.groupBy(F.shiftright("draw", 64 - DRAW_BITS).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
    taken, last = 0, -(1 << DRAW_BITS)
    for r in sorted(bins, key=lambda r: r.bin):
        if taken + r.n > most:
            break
        taken, last = taken + r.n, r.bin
    return ids.filter(F.shiftright("draw", 64 - DRAW_BITS) <= last)


def fit(docs: DataFrame, trusted: DataFrame) -> Model:
    """Count n-grams of all ``docs`` (doc_id, text), and of those in ``trusted``
    that do not calibrate."""
    # NULL ids match nothing; a second join column spreads them over tasks.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn(
        "spread", F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(NULL_BUCKETS))).otherwise(F.lit(0)))
    target = trusted.filter("NOT calibrates").select(F.col("trusted_id").alias("doc_id"), F.lit(0).cast("long").alias("spread"),
                                                     F.lit(True).alias("trusted"))
    marked = rows.join(target, ["doc_id", "spread"], "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    counts = (marked.mapInArrow(_count, "bucket long, raw long, target long").groupBy("bucket")
              .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())      # at most DIM rows
    raw, target = np.zeros(DIM), np.zeros(DIM)
    for r in counts:
        raw[r.bucket], target[r.bucket] = r.raw, r.target
    return Model(ratios(raw, target))


# --- verdicts ---------------------------------------------------------------------

MEASURES = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "ratio": "double"}


def measure(texts: pa.Array, model: Model) -> dict[str, np.ndarray]:
    found = words(texts, _CLASSES)
    coded = found.text.dictionary_encode()
    out = base_rules(texts, found, coded.indices.to_numpy(zero_copy_only=False))
    bucket, doc = ngram_buckets(found, coded)
    n = np.bincount(doc, minlength=len(texts))
    out["ratio"] = np.bincount(doc, model.ratio[bucket], minlength=len(texts)) / np.maximum(n, 1)
    return out


def _measured(model: Model, carried: list[str], text: str, names: dict[str, str]):
    def run(batches):
        for batch in batches:
            for a, b in text_slices(batch, column=text, most=_SLICE):
                part = batch.slice(a, b - a)
                made = measure(part.column(text), model)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in carried] + [pa.array(made[k]) for k in names],
                                                 names=carried + list(names.values()))
    return run


def measures(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and every measure of each document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, " + ", ".join(f"{k} {t}" for k, t in MEASURES.items())
    return rows.mapInArrow(_measured(model, ["doc_id"], "text", {k: k for k in MEASURES}), schema)


def base_failed(n_words="n_words", n_repeat_words="n_repeat_words"):
    return (F.col(n_words) < MIN_WORDS) | (100 * F.col(n_repeat_words) > MOST_REPEATED * F.col(n_words))


def threshold(measured: DataFrame, trusted: DataFrame) -> float:
    """The ratio that all but ``LOWEST`` of the calibrating documents reach, less ``SLACK``."""
    bins = (measured.filter(~base_failed()).join(trusted.filter("calibrates"), F.col("doc_id") == F.col("trusted_id"), "left_semi")
            .groupBy(F.floor(F.col("ratio") / _BIN).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect())
    # A ratio lies between log(PRIOR / (all + PRIOR)) and -log of the smallest p_raw: a few tens of thousands of bins.
    if not bins:
        return float("-inf")
    bins.sort(key=lambda r: r.bin)
    may_fail, seen = LOWEST * sum(r.n for r in bins), 0
    for r in bins:
        seen += r.n
        if seen > may_fail:
            return float(r.bin * _BIN - SLACK)
    return float("-inf")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's measures, ``base_failed``, ``threshold`` and ``kept``."""
    trusted = trusted_ids(labels)
    measured = saved(measures(docs, fit(docs, trusted)), "quality")
    limit = threshold(measured, trusted)
    return measured.select("*", base_failed().alias("base_failed"), F.lit(limit).alias("threshold")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("ratio") >= limit))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were."""
    trusted = trusted_ids(labels)
    model = fit(docs, trusted)
    limit = threshold(saved(measures(docs, model), "quality"), trusted)
    names = {k: fresh(docs, f"dq_{k}") for k in ("n_words", "n_repeat_words", "ratio")}
    text, columns = fresh(docs, "dq_text"), docs.columns
    schema = T.StructType([*docs.schema.fields, *(T.StructField(v, T.DoubleType() if k == "ratio" else T.LongType())
                                                  for k, v in names.items())])
    marked = docs.withColumn(text, F.col("text").cast("string")).mapInArrow(_measured(model, columns, text, names), schema)
    return marked.filter(~base_failed(names["n_words"], names["n_repeat_words"]) & (F.col(names["ratio"]) >= limit)).select(*columns)


def op11_quality_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return judge(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed", "kept", "ratio", "threshold")
