"""The whole pipeline on odd tables: NULLs, repeated rows, clashing columns, no rows."""

from __future__ import annotations

import os
from collections import Counter

import corpus_pipeline
from dqspark.llm import packing

from ..conftest import SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, dq_rejected boolean, group string"


def written(spark, rows, scratch, name):
    folder = os.path.join(scratch, name)
    spark.createDataFrame(rows, SCHEMA).write.parquet(os.path.join(folder, "documents.parquet"))
    return folder


def test_run_on_odd_rows(spark, scratch):
    real = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    odd = [(i, t, lang, None, None, None, None) for i, t, lang in real] * 2
    odd += [(None, None, None, None, None, None, None), (None, "", None, None, None, None, None), (5000, None, "en", "s", 1, True, "x")] * 3
    odd += [(None, real[0][1], None, None, None, None, None), (5001, "x" * 30_000, "en", None, None, None, None)]
    out = corpus_pipeline.run(spark, written(spark, odd, scratch, "odd")).collect()
    assert out and len({(r.sequence_id, r.offset) for r in out}) == len(out)
    fill = Counter()
    for r in out:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= packing.CAPACITY
    ids = Counter(r.doc_id for r in out if r.piece == 0)
    assert max(ids.values()) == 1          # repeated rows stay once
    assert set(ids) <= {i for i, *_ in odd}


def test_run_on_an_empty_table(spark, scratch):
    assert corpus_pipeline.run(spark, written(spark, [], scratch, "empty")).count() == 0


def test_every_stage_but_the_last_keeps_the_columns(spark, scratch):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta epsilon", "en", "s", 5, None, "g")] * 2, SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, scratch).columns == docs.columns, name
