"""Operator 13 against a plain reading of its definition."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from dqspark.llm import token_alignment as ta
from dqspark.llm.queries import llm_queries
from dqspark.llm.tokens import byte_alphabet, vocabulary_path

from ..conftest import SMALL

SCHEMA = "doc_id long, text string, lang string, part long, slot string, n_a long"
ODD = [None, "", " ", "  ", "a", "\n", "a b", " a  b ", "日本語 テスト é è.", "▁", "a ▁b", "<|endoftext|> x", "don't\t\r\n'll",
       "😀 \u0085x \xa0 y", "x" * 3000, "word " * 2000, "\x00 a\x00", "ﬁ ① Å", "a b"]


def plain(texts):
    """n_a, n_b, n_groups, n_links, n_best, count_sum, digest of each text."""
    import sentencepiece
    from tokenizers import Tokenizer

    tok, back = Tokenizer.from_file(vocabulary_path()), byte_alphabet()
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(ta.PIECES))

    def piece(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    rows, total = [], Counter()
    for t in texts:
        if not t:
            rows.append(([], [], [], ""))
            continue
        a, b = tok.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)
        a_bytes, b_bytes = [bytes(back[c] for c in tok.id_to_token(i)) for i in a], [piece(i) for i in b]
        if b"".join(a_bytes) != (" " + t).encode() or b"".join(b_bytes) != (" " + t).encode():
            rows.append(([], [], [], ""))
            continue
        a_end, b_end = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        links, groups, i, j = [], [], 0, 0
        while i < len(a):
            links.append((a[i], b[j]))
            if a_end[i] == b_end[j]:
                groups.append((a_end[i], i + 1, j + 1))
                i, j = i + 1, j + 1
            elif a_end[i] < b_end[j]:
                i += 1
            else:
                j += 1
        total.update(links)
        text, x, y = [], 0, 0
        for _, i, j in groups:
            text.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
            x, y = i, j
        rows.append((a, b, links, ";".join(text)))
    highest = defaultdict(int)
    for (_, y), n in total.items():
        highest[y] = max(highest[y], n)
    return [(len(a), len(b), g.count(";") + 1 if g else 0, len(links), sum(total[x] == highest[x[1]] for x in links),
             sum(total[x] for x in links), hashlib.sha256(g.encode()).hexdigest() if g else "") for a, b, links, g in rows]


def values(df):
    return [tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]


def by_repr(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("part_pairs", [ta.PART_PAIRS, 5])
def test_odd_texts_in_parts_of_any_size(spark, part_pairs):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choices(list("ab  .'s\n\té!1²　日▁") + ["the", "<s>"], k=rng.randint(0, 30))) for _ in range(200)]
    ids = [None if i % 11 == 0 else i // 2 for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, None, 7, "x", None) for i, t in zip(ids, texts)], SCHEMA).repartition(3)
    got = ta.score(ta.align(docs, part_pairs=part_pairs))
    assert by_repr(values(got)) == by_repr([(i, *x) for i, x in zip(ids, plain(texts))])


def test_query_over_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = [(r.doc_id, *x) for r, x in zip(docs, plain([r.text for r in docs]))]
    assert by_repr(values(llm_queries()["op13_token_alignment"](spark, SMALL))) == by_repr(want)


def test_groups_hold_all_tokens(spark):
    docs = spark.createDataFrame([(1, "Hello, wörld"), (2, None), (3, "a ▁")], "doc_id long, text string")
    rows = {r.doc_id: r for r in ta.groups(docs).collect()}
    assert rows[2].a_ids == [] == rows[3].b_ids
    r = rows[1]
    assert sum(r.a_in_group) == len(r.a_ids) and sum(r.b_in_group) == len(r.b_ids)
    assert r.group_end[-1] == len(" Hello, wörld".encode()) and len(r.group_end) == len(r.a_in_group)
    counts = {(x.a, x.b): x.n for x in ta.pair_counts(ta.align(docs)).collect()}
    assert sum(counts.values()) == plain(["Hello, wörld"])[0][3]


def test_long_texts_are_cut_without_a_trace():
    rng = random.Random(5)
    texts = ["".join(rng.choices(list("abc   .\n,é日") + ["word ", " the "], k=400)) for _ in range(50)]
    whole, cut = ta.PieceEncoder(vocabulary_path(ta.PIECES)), ta.PieceEncoder(vocabulary_path(ta.PIECES), limit=20)
    for x, y in zip(whole.encode_batch(pa.array(texts)), cut.encode_batch(pa.array(texts))):
        assert x.tolist() == y.tolist()


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert ta.score(ta.align(docs)).count() == 0 and ta.groups(docs).count() == 0
