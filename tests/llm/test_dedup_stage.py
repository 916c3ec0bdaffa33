"""The deduplication stage: rows kept whole, with and without a broadcast."""

from __future__ import annotations

from collections import Counter

import pytest

from dqspark.llm import exact_dedup

SCHEMA = "doc_id long, text string, dq_id string, dq_drop int, n_chars long"
ROWS = [(1, "a b c", "x", 1, None), (2, "abc", "y", 2, 3), (2, "a  bc ", "z", 3, 4), (2, "abc", "y", 2, 3), (None, "abc", None, None, None),
        (None, None, "n", 0, 0), (None, "", "n", 0, 0), (7, " \n", "w", 1, 1), (8, "only", "o", 1, 1), (9, "twice", "t", 1, 1),
        (9, "twice", "t", 1, 1), (10, "é 日本 " * 500, "u", 1, 1)]


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_kept_rows_are_whole_and_one_of_each_text(spark, broadcast_rows):
    docs = spark.createDataFrame(ROWS * 2, SCHEMA).repartition(4)
    got = exact_dedup.keep_first(docs, broadcast_rows=broadcast_rows)
    assert got.columns == docs.columns
    want = Counter({(2, "a  bc ", "z", 3, 4): 1, (7, " \n", "w", 1, 1): 1, (8, "only", "o", 1, 1): 1, (9, "twice", "t", 1, 1): 1, ROWS[-1]: 1})
    assert Counter(tuple(r) for r in got.collect()) == want


def test_tables_without_copies_pass_unchanged_and_empty_ones_stay_empty(spark):
    docs = spark.createDataFrame([r for r in ROWS if r[0] in (8, 10)], SCHEMA)
    assert Counter(map(tuple, exact_dedup.keep_first(docs).collect())) == Counter(r for r in ROWS if r[0] in (8, 10))
    assert exact_dedup.keep_first(docs.limit(0)).count() == 0


def test_texts_are_not_shuffled(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    plan = exact_dedup.keep_first(docs.filter("doc_id IS NULL OR doc_id IN (1, 7, 8, 10)"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan
