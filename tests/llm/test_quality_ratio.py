"""Operator 11: base rules by brute force, the ratio by plain counts, verdicts
on held-out labels, and the defined cases."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from dqspark.llm import quality_ratio as q
from dqspark.llm.queries import llm_queries
from dqspark.llm.words import WHITE, byte_classes, words

from ..conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, ratio string, dq_text int, trusted boolean"
REPEAT = "a b c d e f g h i " * 4
ODD = [None, "", " \n\t", "one", "one\none\n one\none", REPEAT, REPEAT + "x y z", "w " * 40, "w " * 8, "w " * 9, "é 日本 ## $%&|<>*\x1f\x85 \xa0",
       "l\r\nl\r\nl\n\n \n \n", "x" * 5000, "A a A a A a A a a A a A a A a A", "tail\n" * 30 + "tail"]


def brute(text):
    text = text or ""
    ws = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(ws[i:i + 8]) for i in range(len(ws) - 7))
    repeated = {j for i in range(len(ws) - 7) if windows[tuple(ws[i:i + 8])] > 1 for j in range(i, i + 8)}
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def failed(n, *rest):
    return n < 20 or 100 * rest[-1] > 30 * n


def test_base_rules_equal_brute_force(spark):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    for arr in (pa.array(texts), pa.array(["cut off", *texts]).slice(1), pa.chunked_array([texts]).combine_chunks()):
        got = q.measure(arr, q.Model(np.zeros(q.DIM)))
        assert list(zip(*(got[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")))) == [brute(t) for t in texts]


def test_ratio_equals_plain_counts():
    texts = ["The the cat", "cat THE", "a b c a b", "", "zz"]
    found = words(pa.array(texts), byte_classes(white=WHITE))
    bucket, doc = q.ngram_buckets(found, found.text.dictionary_encode())
    grams = [(i, g) for i, t in enumerate(texts) for ws in [t.lower().split()] for g in [*zip(ws), *zip(ws, ws[1:])]]
    # No two n-grams of these texts share a bucket.
    assert Counter(doc.tolist()) == Counter(i for i, _ in grams) and len(set(bucket.tolist())) == len({g for _, g in grams})
    raw, target = np.bincount(bucket, minlength=q.DIM), np.bincount(bucket[doc < 2], minlength=q.DIM)
    all_, good = Counter(g for _, g in grams), Counter(g for i, g in grams if i < 2)

    def ratio(g):
        p = (all_[g] + 1) / (len(grams) + q.DIM)
        return math.log((good[g] + q.PRIOR * p) / (sum(good.values()) + q.PRIOR) / p)

    got = q.measure(pa.array(texts), q.Model(q.ratios(raw, target)))["ratio"]
    for i in range(len(texts)):
        mine = [ratio(g) for j, g in grams if j == i]
        assert got[i] == pytest.approx(sum(mine) / len(mine) if mine else 0)


def test_query_equals_one_task_and_judges_held_out_labels(spark):
    sf = SMALL.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    rows = {r.doc_id: r for r in llm_queries()["op11_quality_ratio"](spark, sf).collect()}
    assert len(rows) == len(docs)
    trusted = {r.trusted_id: r.calibrates for r in q.trusted_ids(spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert set(trusted) == {r.doc_id for r in labels if r.quality == 1 and zlib.crc32(str(r.doc_id).encode()) % 5}
    texts = pa.array([r.text for r in docs])
    found = words(texts, byte_classes(white=WHITE))
    bucket, doc = q.ngram_buckets(found, found.text.dictionary_encode())
    target = np.array([trusted.get(r.doc_id) is False for r in docs])
    model = q.Model(q.ratios(np.bincount(bucket, minlength=q.DIM), np.bincount(bucket[target[doc]], minlength=q.DIM)))
    want = q.measure(texts, model)
    calibrating = sorted(x for r, x in zip(docs, want["ratio"]) if trusted.get(r.doc_id) and not failed(*brute(r.text)))
    limit = rows[docs[0].doc_id].threshold
    assert limit == pytest.approx(calibrating[int(q.LOWEST * len(calibrating))] - q.SLACK, abs=2 * q._BIN)
    for i, r in enumerate(docs):
        got = rows[r.doc_id]
        assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == brute(r.text)
        assert got.base_failed == failed(*brute(r.text)) and got.ratio == pytest.approx(want["ratio"][i])
        assert got.kept == (not got.base_failed and got.ratio >= limit)
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.doc_id in rows and not rows[r.doc_id].base_failed]
    good, bad = ([rows[r.doc_id].kept for r in held if r.quality == k] for k in (1, 0))
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.2


def test_defined_cases(spark):
    ids = [None if i % 7 == 0 else i // 2 for i in range(len(ODD))]
    docs = spark.createDataFrame([(i, t, "en", "r", 1, None) for i, t in zip(ids, ODD)] * 2, SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 1), (1, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    got = q.judge(docs, labels)
    rows = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got.collect())
    assert rows == Counter((i, *brute(t)) for i, t in zip(ids, ODD) for _ in range(2))
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == got.filter("kept").count()
    no_labels = q.judge(docs, labels.limit(0)).collect()
    assert all(r.ratio == pytest.approx(0) and r.kept != r.base_failed for r in no_labels)
    assert q.judge(docs.limit(0), labels).count() == 0 and q.keep_good(docs.limit(0), labels).count() == 0


def test_trusted_ids_are_bounded(spark):
    labels = spark.range(3000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    every = q.trusted_ids(labels.unionByName(labels))
    assert every.count() == every.select("trusted_id").distinct().count()
    some = {r.trusted_id for r in q.trusted_ids(labels, most=50).collect()}
    assert 45 <= len(some) <= 50 and some <= {r.trusted_id for r in every.collect()}


def test_every_trusted_id_takes_part_without_a_broadcast(spark):
    labels = spark.range(60_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    trusted = q.trusted_ids(labels)
    assert trusted.count() == sum(1 for i in range(60_000) if zlib.crc32(str(i).encode()) % 5) < 50_000
    more = q.trusted_ids(labels.unionByName(labels.selectExpr("doc_id + 60000 AS doc_id", "quality", "toxic")))
    assert more.count() == sum(1 for i in range(120_000) if zlib.crc32(str(i).encode()) % 5) > 90_000
    docs = spark.createDataFrame([(None if i % 3 == 0 else i // 2, f"word{i % 7} word{i % 5} tail") for i in range(300)], "doc_id long, text string")
    want = q.fit(docs, trusted).ratio
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert (q.fit(docs, trusted).ratio == want).all()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
