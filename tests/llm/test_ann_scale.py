"""Operator 6 on components near both ends of the double range, and what it does with many rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from dqspark.llm import ann


def test_huge_and_tiny_components_score_their_cosine(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e-200, 0.0]), (3, [0.0, 3e-320]), (4, [1.0, 1.0]), (5, [-1e308, 1e308]), (6, [0.0, 0.0]),
            (7, None), (8, [1.0, float("nan")]), (9, [2e-200, 1e-200])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    unit = {1: (1, 1), 2: (1, 0), 3: (0, 1), 4: (1, 1), 5: (-1, 1), 9: (2, 1)}
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in ann.search(docs, docs).collect()}
    for q, u in unit.items():
        cosine = sorted((-np.dot(u, w) / np.linalg.norm(u) / np.linalg.norm(w), i) for i, w in unit.items() if i != q)
        for rank in range(1, 6):
            i, score = got.pop((q, rank))
            assert abs(score + cosine[rank - 1][0]) < 1e-9
            assert abs(-[c for c, j in cosine if j == i][0] - score) < 1e-9
    assert not got


def test_scaling_changes_no_ordinary_score():
    x = np.random.default_rng(1).normal(size=(100, 16))
    y, v = ann.scaled(x), ann.scaled(x[:1])[0]
    assert np.array_equal((y * v).sum(axis=1) / np.sqrt((y * y).sum(axis=1) * (v * v).sum()),
                          np.array([(a * v).sum() / np.sqrt((a * a).sum() * (v * v).sum()) for a in y]))
    assert np.allclose(y / np.linalg.norm(y, axis=1, keepdims=True), x / np.linalg.norm(x, axis=1, keepdims=True), rtol=0, atol=0)


def test_visits_are_never_broadcast(spark, monkeypatch):
    """Spark sizes a query's hundreds of visits as one row: below the broadcast threshold, all went through the driver."""
    plans, real = {}, ann.saved

    def saved(df, label):
        df.collect()
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, label)

    monkeypatch.setattr(ann, "saved", saved)
    x = np.random.default_rng(2).normal(size=(300, 8))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    got = ann.search(v, v.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    assert len(got) == 30
    assert "MapInArrow" in plans["ann-found"] and "SortMergeJoin" in plans["ann-found"]
    assert not [label for label, plan in plans.items() if "Broadcast" in plan]


def test_float_and_double_vectors_give_the_same_rows(spark):
    x = np.random.default_rng(4).normal(size=(200, 8)).astype(np.float32)
    v = spark.createDataFrame([(i % 150, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    assert ann.usable(v).dtypes[1][1] == "array<float>"
    of = lambda v: sorted(map(tuple, ann.search(v, v.filter("vec_id % 50 = 0")).collect()))
    assert of(v) == of(v.withColumn("embedding", v.embedding.cast("array<double>"))) != []


@pytest.mark.parametrize("cells", [1, 500, 10**6])
@pytest.mark.parametrize("ids", [7, 12, 400])
def test_rank_is_that_of_row_by_row_sums(monkeypatch, cells, ids):
    """Ties (equal vectors of several ids), ids of several vectors, queries that are rows: in blocks of any size."""
    monkeypatch.setattr(ann, "CELLS", cells)
    rng = np.random.default_rng(ids)
    c = rng.integers(-2, 3, size=(500, 6)).astype(float)
    c[:, 0] += 0.1
    c[100:300] = c[7]
    vec_id, asked = rng.integers(0, ids, 500), np.array([3, 3, 5, 900])
    v = np.stack([c[7], c[8], c[200], c[9] * 3])
    table = lambda i, x: pa.table({"vec_id": i, "embedding": x.tolist()})
    got = ann._rank(5)((), table(asked, v), table(vec_id, c))
    want = []
    for q, y in zip(asked.tolist(), ann.scaled(v)):
        x = ann.scaled(c)
        score = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum()))
        best = {}
        for i, s in zip(vec_id.tolist(), score.tolist()):
            best[i] = max(best.get(i, -2), s)
        best.pop(q, None)
        want += [(q, i, best[i]) for i in sorted(best, key=lambda i: (-best[i], i))[:5]]
    assert list(zip(*got.to_pydict().values())) == want
