"""Operator 12 against plain counting and DuckDB."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

from dqspark.llm import phrase_mining as pm
from dqspark.llm.queries import llm_oracle_sql, llm_queries

from ..conftest import SMALL

SCHEMA = "doc_id long, text string, lang string, n long, phrase string, opens int"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def pieces(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return [w for p in re.split(r"[.,;:!?\x0a-\x0d]", low) if (w := re.findall(r"[^\x20\x09]+", p))]


def plain(docs, top=pm.TOP, at_least=pm.AT_LEAST):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    found = {}
    for g, a in f.items():
        if len(g) > 2 and a >= at_least:
            lang, w = g[0], g[1:]
            cuts = [(10 ** 6 * a * a // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w))]
            found[g] = min(cuts)
    gone = {(g[0], *g[i:i + 2]) for g in found if len(g) == 4 for i in (1, 2) if 100 * f[g] >= 50 * f[g[0], *g[i:i + 2]]}
    rows = []
    for lang in n:
        mine = sorted(((-found[g][0], -f[g], " ".join(g[1:]).encode(), g) for g in found if g[0] == lang and g not in gone))
        rows += [(lang, i, " ".join(g[1:]), f[g], found[g][2], found[g][3], n[lang], -s) for i, (s, _, _, g) in enumerate(mine[:top], 1)]
    return rows


def values(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def made(seed=1):
    rng = random.Random(seed)
    vocabulary = ["New", "york", "the", "A", "of", "é", "日本", "x\xa0y", "b-c", "\x1f"]
    out = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ", ", "!?"])
                                                            for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    return [*out, ("en", None), (None, ""), ("en", " .,\n"), ("de", "same words " * 500), ("fr", "only one")] + [("en", "big red dog runs")] * 40


def test_odd_texts(spark):
    docs = made()
    df = spark.createDataFrame([(i % 5 if i % 3 else None, t, lang, 1, "x", 2) for i, (lang, t) in enumerate(docs)], SCHEMA).repartition(3)
    assert values(pm.mine(df)) == sorted(plain(docs))
    assert values(pm.mine(df, top=3, at_least=2)) == sorted(plain(docs, 3, 2))


def test_small_bitmap_changes_nothing(spark):
    docs = made(2)
    df = spark.createDataFrame([(1, t, lang, 1, "x", 2) for lang, t in docs], SCHEMA)
    assert values(pm.mine(df, bits=64)) == sorted(plain(docs))


@pytest.mark.parametrize("every", [1, 2, 6, 10 ** 9])
def test_chunks_hold_each_ngram_once(every):
    docs = made(3)
    want, got = Counter(), Counter()
    for lang, text in docs:
        for w in pieces(text):
            want.update(("und" if lang is None else lang, *w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    table = pm.chunks(pa.array([x for x, _ in docs], pa.string()), pa.array([t for _, t in docs], pa.string()), every)
    for r in table.to_pylist():
        w = r["chunk"].split(" ")
        for k in (1, 2, 3):
            for end in range(0 if r["opens"] else 2, len(w)):
                if end - k + 1 >= 0:
                    got[r["lang"], *w[end - k + 1:end + 1]] += r["n"]
    assert got == want


def test_query_equals_plain_and_sql(spark):
    docs = [(r.lang, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = values(llm_queries()["op12_phrase_mining"](spark, SMALL))
    assert got == sorted(plain(docs))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    assert got == sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({llm_oracle_sql()['op12_phrase_mining']})").fetchall())


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000_000
    grams = spark.createDataFrame([("en", 1, "x", big + 7), ("en", 1, "y", big + 1), ("en", 2, "x y", big)], "lang string, size int, phrase string, n long")
    row = pm.scored(grams).collect()[0]
    assert row.score == 10 ** 6 * big * big // ((big + 7) * (big + 1)) and (row.a, row.l, row.r) == (big, big + 7, big + 1)


def test_empty_table(spark):
    assert pm.mine(spark.createDataFrame([], SCHEMA)).count() == 0
