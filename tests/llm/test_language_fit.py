"""Operator 2's fit: repeated rows, statistics over all rows, a language that was never seen."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dqspark.llm import lang_id

from ..conftest import SMALL

DOCS = f"{SMALL.replace('sf0.001', 'sf0.01')}/documents.parquet"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(DOCS).select("doc_id", "text", "lang")


def plain_model(rows):
    """Document frequencies and limits of all rows, by one dense table."""
    counts = lang_id.ngram_counts(pa.array([r.text for r in rows]))
    return counts, np.log((len(rows) + 1) / ((counts > 0).sum(axis=0) + 1)) + 1


def test_fit_covers_all_rows_and_a_repeated_row_is_one_draw(spark, docs):
    train = lang_id.training_rows(docs).filter("lang IS NOT NULL AND text IS NOT NULL")
    rows = train.collect()
    first = min(rows, key=lambda r: r.doc_id)
    again = train.unionByName(spark.range(2000).select(F.lit(first.doc_id).alias("doc_id"), F.lit(first.text).alias("text"), F.lit(first.lang).alias("lang")))
    model, repeated = lang_id.fit(train), lang_id.fit(again)
    assert len(repeated.languages) == len(model.languages) == 4 * lang_id.CENTROIDS
    counts, idf = plain_model(rows)
    assert np.allclose(model.idf, idf)
    assert not np.allclose(repeated.idf, idf)          # every row counts there
    v = lang_id.vectors(counts, idf)
    for lang in set(model.languages):
        own = v[[r.lang == lang for r in rows]] @ model.centroids[[x == lang for x in model.languages]].T
        low = np.sort(own.max(axis=1)[np.linalg.norm(v[[r.lang == lang for r in rows]], axis=1) > 0])
        assert model.limits[lang] == pytest.approx(lang_id.SLACK * low[int(lang_id.LOWEST * len(low))], abs=2 * lang_id._BIN)


def test_blocks_of_any_size_predict_alike(docs, monkeypatch):
    texts = pa.array([r.text for r in docs.limit(300).collect()])
    model = lang_id.Model(["a", "b"], lang_id.vectors(lang_id.ngram_counts(texts.slice(0, 2)), np.ones(lang_id.DIM)), np.ones(lang_id.DIM), {"a": 0.3, "b": 0.3})
    whole = lang_id.classify(texts, model)
    monkeypatch.setattr(lang_id, "_ROWS", 7)
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    parts = [lang_id.classify(b.column("text"), model) for b in lang_id._blocks([batch])]
    assert max(len(p[0]) for p in parts) == 7
    assert sum((p[0] for p in parts), []) == whole[0] and np.allclose(np.concatenate([p[1] for p in parts]), whole[1])


def test_an_unseen_language_is_mostly_rejected_and_known_ones_stay(spark, docs):
    known = docs.filter("lang IN ('en', 'fr', 'es')")
    model = lang_id.fit(lang_id.training_rows(known))
    marked = lang_id.predict(docs, model).join(docs.select("doc_id", "lang", F.length("text").alias("size")), "doc_id")
    rate = {r.foreign: r.rate for r in marked.filter("size > 100").groupBy((F.col("lang") == "de").alias("foreign"))
            .agg(F.avg(F.col("rejected").cast("int")).alias("rate")).collect()}
    assert rate[True] > 0.5 and rate[False] < 0.02
