"""Operators 1, 2, 3, 5, 6, 8, 9 and the pipeline: brute force, exact round
trips, held-out accuracy, and the defined cases."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dqspark.llm import ann, common, components, lang_id, lm_lattice, ngram_join, secrets, sp_codec, toxicity
from dqspark.llm.queries import llm_queries

from ..conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double"
ODD = [(1, None), (2, ""), (3, " \n"), (4, "one two three"), (5, "One  TWO\tthree"), (5, "One  TWO\tthree"),
       (None, "alpha beta gamma delta epsilon zeta"), (6, "Alpha beta gamma delta epsilon zeta"), (7, "日本語 ▁ テスト é"),
       (8, "word " * 3000), (9, "word " * 3000 + "end"), (10, "x" * 5000), (None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "s", 1, 0.5) for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


# --- 1 ------------------------------------------------------------------------

def test_lattice_equals_all_segmentations():
    pieces = lm_lattice.pieces_of(lm_lattice.default_vocabulary())
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=lm_lattice.default_vocabulary())
    known = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    logp = np.log(pieces.first)

    def every(word):
        if not word:
            return 1.0, {}
        total, uses = 0.0, defaultdict(float)
        for k in range(1, len(word) + 1):
            if word[:k] in known:
                ids = [known[word[:k]]]
            elif k == 1:
                ids = [pieces.byte[b] for b in word[0].encode()]
            else:
                continue
            p = math.exp(sum(logp[i] for i in ids))
            rest, more = every(word[k:])
            total += p * rest
            for i in ids:
                uses[i] += p * rest
            for i, x in more.items():
                uses[i] += p * x
        return total, uses

    words = ["the", "a", "onthing", "étre", "日本", "qzx", "berzu"]
    got = lm_lattice.word_log_probability(pa.array(words), pieces, logp)
    counts = lm_lattice.expected_counts(pa.array(words), np.ones(len(words)), pieces, logp)
    want = np.zeros(pieces.size)
    for w, lp in zip(words, got):
        total, uses = every("▁" + w)
        assert lp == pytest.approx(math.log(total), rel=1e-9)
        for i, x in uses.items():
            want[i] += x / total
    assert np.allclose(counts, want)


def test_op1_base_score_and_gain(spark, small):
    got = {r.doc_id: r for r in llm_queries()["op1_lattice_score"](spark, SMALL).collect()}
    tokens = {d: WORD.findall(lower(t)) + [None] for d, t in small}
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d in tokens}
    c = defaultdict(int)
    for d, ts in tokens.items():
        if not held[d]:
            for t in ts:
                c[t] += 1
    n, v = sum(c.values()), len(c)
    c = dict(c)
    for d, ts in tokens.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(ts), sum(t in c for t in ts), n)
        assert r.base_score == pytest.approx(sum(math.log10((c.get(t, 0) + 0.1) / (n + 0.1 * (v + 1))) for t in ts))
        assert math.isfinite(r.score) and r.score < 0
    assert len(got) == len(tokens)


def test_op1_long_words_score_their_whole_lattice(spark):
    """Untrained, a document's first word is its lattice value and nothing else."""
    texts = ["q" * 5000, "q" * 150, "ꙮ" * 5000, "q" * 5000 + " " + "q" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").filter("text is not null")
    got = {r.doc_id: r.score for r in lm_lattice.score(docs, folds=1).collect()}
    pieces = lm_lattice.pieces_of(lm_lattice.default_vocabulary())
    logp = np.log(pieces.first)
    lp = lm_lattice.word_log_probability(pa.array(texts[:3]), pieces, logp)
    end = logp[pieces.end] - math.log(pieces.first[pieces.marked].sum() + pieces.first[pieces.end])
    c = lm_lattice.CONCENTRATION
    for i in range(3):
        assert got[i] == pytest.approx((lp[i] + math.log(c / (1 + c)) + end) / math.log(10))
    # The second time the word follows itself: 1 / (1 + c), its own weight is nothing beside 1.
    assert got[3] == pytest.approx((lp[0] - math.log(1 + c) + math.log(c / (2 + c)) + end) / math.log(10))
    assert got[0] < 20 * got[1] < 0


def test_op1_counted_words_are_mixed_in_log_space(spark):
    """A trained document: counts and lattice as in plain doubles, far below them too."""
    t = lm_lattice.Totals({"once_a": 3, "twice_a": 1, "n_a": 9, "v_a": 5}, "a", 2)
    c, below = np.array([0, 1, 4]), np.array([-20.0, -3.0, -9.0])
    plain = np.maximum(c - t.discount, 0) / t.n + t.discount * t.v / t.n * np.exp(below)
    assert np.allclose(np.exp(t.discounted(c, below)), plain)
    assert t.discounted(0, -5000.0) == pytest.approx(-5000 + math.log(t.discount * t.v / t.n))


def test_op1_odd_rows(spark, odd):
    got = lm_lattice.score(odd, rounds=1).collect()
    assert len(got) == len(ODD)
    assert sorted(r.n_tokens for r in got) == sorted(len(WORD.findall(t or "")) + 1 for _, t in ODD)
    assert lm_lattice.score(odd.limit(0), rounds=1).count() == 0


# --- 2 ------------------------------------------------------------------------

def test_op2_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    got = llm_queries()["op2_language_id"](spark, SMALL).join(docs, "doc_id").filter("held_out")
    right, n = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count(F.lit(1))).first()
    assert n > 20 and right / n > 0.95


def test_op2_odd_rows(spark, odd):
    model = lang_id.fit(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang"))
    got = lang_id.predict(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert all((r.lang_pred == "und") == (r.score == 0) for r in got)
    assert sum(r.lang_pred == "und" for r in got) == 4
    none = lang_id.fit(odd.limit(0).select("doc_id", "text", "lang"))
    assert {r.lang_pred for r in lang_id.predict(odd, none).collect()} == {"und"}
    assert lang_id.keep_accepted(odd, model).columns == odd.columns


# --- 3 ------------------------------------------------------------------------

def test_op3_round_trip(spark, small, odd):
    got = {r.doc_id: r for r in llm_queries()["op3_sentencepiece"](spark, SMALL).collect()}
    assert len(got) == len(small)
    for d, t in small:
        assert got[d].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    back = sp_codec.decode(sp_codec.encode(odd)).collect()
    assert sorted(r.decoded for r in back) == sorted(t or "" for _, t in ODD)


def test_viterbi_equals_plain_dynamic_programme():
    codec = sp_codec.codec(sp_codec.default_vocabulary())
    rng = random.Random(5)
    words = sorted({" " + "".join(rng.choices("abethnioré日", k=rng.randint(0, 9))) for _ in range(400)})
    score = {i: s for i, s in codec.pieces.values()}

    def best(word):
        top = [0.0] + [-math.inf] * len(word)
        for end in range(1, len(word) + 1):
            for begin in range(end):
                if word[begin:end] in codec.pieces:
                    top[end] = max(top[end], top[begin] + codec.pieces[word[begin:end]][1])
            if word[end - 1] not in codec.pieces:
                top[end] = max(top[end], top[end - 1] + codec.unknown)
        return top[-1]

    for word, ids in codec.viterbi(words):
        ids = np.frombuffer(ids, "<u4").tolist()
        unknown = sum(c not in codec.pieces for c in word)
        assert sum(score[i] for i in ids if i in score) + unknown * codec.unknown == pytest.approx(best(word))


# --- 5 ------------------------------------------------------------------------

def test_op5_scores_and_separation(spark, odd):
    labels = spark.read.parquet(f"{SMALL}/../sf0.01/labels.parquet")
    got = llm_queries()["op5_toxicity"](spark, f"{SMALL}/../sf0.01").join(labels, "doc_id")
    by = {r.toxic: r.s for r in got.groupBy("toxic").agg(F.avg("score").alias("s")).collect()}
    assert by[1] > by[0] + 0.2
    model = toxicity.Model(b"moron idiot", b"ordinary te", None, 0.25)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(ODD) and {r.score for r in rows} == {0.25}


# --- 6 ------------------------------------------------------------------------

def test_op6_recall_and_exact_scores(spark):
    t = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in t]), np.array([r.embedding for r in t], float)
    norm = np.sqrt((x * x).sum(axis=1))
    got = defaultdict(list)
    for r in llm_queries()["op6_nearest_neighbours"](spark, SMALL).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = (x * x[q]).sum(axis=1) / (norm * norm[q])
        s[q] = -2
        want = set(ids[np.lexsort((ids, -s))[:5]].tolist())
        assert len(got[ids[q]]) == 5
        for v, score in got[ids[q]]:
            assert score == pytest.approx(s[np.flatnonzero(ids == v)[0]], abs=1e-12)
        hits, total = hits + len(want & {v for v, _ in got[ids[q]]}), total + 5
    assert hits / total >= 0.9


def test_op6_odd_vectors_and_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]),
            (6, [None, 1.0]), (7, [-1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (9, [])]
    v = spark.createDataFrame([(i, e, "x") for i, e in rows], "vec_id long, embedding array<double>, score string")
    got = ann.search(v, v.filter("vec_id = 0")).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 1.0), (2, 1.0), (7, -1.0)]
    assert ann.search(v.limit(0), v.limit(0)).count() == 0


@pytest.mark.parametrize("part", [4000, 16])
def test_op6_repeated_neighbour_leaves_room_for_others(spark, monkeypatch, part):
    """Id 7 is nearest and stands 60 times, 30 of them with vectors of their own."""
    monkeypatch.setattr(ann, "PART", part)
    rng = np.random.default_rng(3)
    q = rng.normal(size=8)
    rows = [(0, q)] * 2 + [(7, q * 2)] * 30 + [(7, q + 0.01 * rng.normal(size=8)) for _ in range(30)]
    rows += [(i, q + 0.5 * rng.normal(size=8)) for i in range(20, 60)]
    v = spark.createDataFrame([(i, x.tolist()) for i, x in rows], "vec_id long, embedding array<double>")
    best = {}
    for i, x in rows:
        best[i] = max(best.get(i, -2), float(x @ q / np.sqrt((x @ x) * (q @ q))))
    want = sorted((i for i in best if i), key=lambda i: (-best[i], i))[:5]
    for probes in (ann.PROBES, 1):  # one probe finds fewer than five: searched exactly
        got = ann.search(v, v.filter("vec_id = 0"), probes=probes).orderBy("rank").collect()
        assert len(got) == 5 and got[0].vec_id == 7
        assert all(r.score == pytest.approx(best[r.vec_id]) for r in got)
    ranked = ann._rank(5)((), pa.table({"vec_id": [0], "embedding": [q.tolist()]}), pa.table(
        {"vec_id": [i for i, _ in rows], "embedding": [x.tolist() for _, x in rows]}))
    assert ranked.column("vec_id").to_pylist() == want


def test_perturbations_come_in_order():
    down = np.array([0.1, 0.45, 0.8])
    steps = ann.perturbations(down, 27)
    cost = [sum((down[i] if s < 0 else 1 - down[i]) ** 2 for i, s in enumerate(p) if s) for p in steps]
    assert cost == sorted(cost) and len({tuple(p) for p in steps}) == 27


# --- 8 ------------------------------------------------------------------------

def brute_components(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        x, y = sets[i], sets[j]
        if x and y and 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)):
            inter = len(x & y)
            if 100 * inter >= 75 * (len(x) + len(y) - inter):
                parent[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)),
                  key=lambda r: tuple((x is not None, x or 0) for x in r))


def in_order(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()),
                  key=lambda r: tuple((x is not None, x or 0) for x in r))


def test_op8_equals_brute_force(spark, small):
    got = llm_queries()["op8_ngram_jaccard"](spark, SMALL)
    assert in_order(got) == brute_components(small)


@pytest.mark.parametrize("frequent", [50, 2])
def test_op8_on_edits_with_any_frequent_signatures(spark, monkeypatch, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT_TIMES", frequent)
    rng = random.Random(11)
    rows = list(ODD)
    for base in range(25):
        n = rng.choice([4, 5, 6, 8, 9, 11, 14, 20, 30, 60, 120, 400])
        words = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(n)]
        for _ in range(rng.randint(1, 8)):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, n // 12))):
                copy[rng.randrange(len(copy))] = f"e{rng.randint(0, 10 ** 6)}"
            rows.append((len(rows) + 100, " ".join(copy[: len(copy) - rng.choice([0, 0, n // 6])])))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, class string").repartition(4)
    assert in_order(ngram_join.join(docs)) == brute_components(rows)


def spied_pairs(monkeypatch):
    """Numbers of candidate pairs, round by round."""
    seen, possible = [], ngram_join._possible

    def spy(pairs, classes):
        seen.append(pairs.count())
        return possible(pairs, classes)
    monkeypatch.setattr(ngram_join, "_possible", spy)
    return seen


def test_op8_texts_with_a_common_passage_do_not_meet(spark, monkeypatch):
    """Two thirds of each text are the same: no pair links, and none needs to be looked at."""
    seen, rng = spied_pairs(monkeypatch), random.Random(3)
    passage = [f"p{i}" for i in range(120)]
    rows = [(i, " ".join(passage + [f"w{rng.randint(0, 10 ** 9)}" for _ in range(60)])) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert in_order(ngram_join.join(docs)) == brute_components(rows)
    assert sum(seen) == 0


def test_op8_large_group_of_near_copies(spark, monkeypatch):
    """Copies with edits, some linked and some not: far fewer pairs are looked at than there are."""
    seen, rng = spied_pairs(monkeypatch), random.Random(5)
    monkeypatch.setattr(ngram_join, "CHUNK", 40)
    words, rows = [f"w{i}" for i in range(200)], []
    for i in range(240):
        copy = list(words)
        for k in rng.sample(range(200), rng.randint(2, 9)):
            copy[k] = f"e{rng.randint(0, 10 ** 9)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_components(rows)
    assert 1 < len({c for _, _, c in want}) < 240
    assert in_order(ngram_join.join(docs)) == want
    assert sum(seen) < 240 * 239 // 2 // 3


def test_op8_prefixes_keep_room_for_every_link():
    rng = np.random.default_rng(2)
    universe = np.unique(rng.integers(1, 2 ** 63, 400).astype(np.uint64))
    sets = [np.sort(rng.choice(universe, n, replace=False)) for n in (3, 4, 7, 30)]
    for s in list(sets):
        for _ in range(20):
            kept = s[rng.random(len(s)) < 0.9]
            sets.append(np.unique(np.append(kept, rng.choice(universe, rng.integers(0, 3)))))
    bounds = np.cumsum([0, *(len(s) for s in sets)])
    value = np.concatenate(sets)
    names = ngram_join.counted_names(universe[::3], 5)
    rank = ngram_join.Frequent(names, rng.integers(10, 20, len(names)), 5).ranks(value)
    assert (rank > 0).tolist() == np.isin(value, universe[::3]).tolist()
    held = [{} for _ in sets]
    for r, at, place in zip(*(x.tolist() for x in ngram_join.prefixes(value, bounds, rank))):
        held[r][int(value[at])] = place
    for x, y in itertools.combinations(range(len(sets)), 2):
        n, m, both = len(sets[x]), len(sets[y]), len(np.intersect1d(sets[x], sets[y]))
        if both and 100 * both >= 75 * (n + m - both):
            assert any(7 * held[x][e] <= 4 * n - 3 * m and 7 * held[y][e] <= 4 * m - 3 * n
                       for e in held[x].keys() & held[y].keys())


def test_keep_one_and_empty(spark, odd):
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    assert ngram_join.join(odd.limit(0)).count() == 0
    assert {r.doc_id for r in kept.collect()} >= {1, 2, 3, 4, 7, 10}


def test_connected_components_of_few_and_many_links(spark, monkeypatch):
    rng = random.Random(4)
    links = spark.createDataFrame([(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)], "a long, b long")
    few = sorted(components.connected_components(links).collect())
    monkeypatch.setattr(components, "FEW", -1)
    assert few == sorted(components.connected_components(links).collect())


def tasks_of_stages(spark, run):
    """What ``run`` returns, and the numbers of tasks of the stages it started."""
    sc, group = spark.sparkContext, f"tasks-{random.random()}"
    sc.setJobGroup(group, "counted")
    try:
        got = run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    status = sc.statusTracker()
    stages = {s for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds}
    return got, [info.numTasks for s in stages if (info := status.getStageInfo(s)) and info.numCompletedTasks]


def test_connected_components_of_few_links_need_no_shuffle_partitions(spark):
    """Each stage of a few links is one task, the first and the last too, however many partitions shuffles have."""
    links = common.saved(spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long").coalesce(1), "few")
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got, tasks = tasks_of_stages(spark, lambda: components.connected_components(links).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])
    assert {r.node: r.component for r in got} == {i: 0 for i in range(51)}
    assert len(got) == 51 and tasks and max(tasks) == 1


@pytest.mark.parametrize("few", [-1, 5])
def test_op8_by_broadcasts_and_by_shuffles(spark, monkeypatch, few):
    """Large and small groups of near copies: the same components however many rows are few."""
    monkeypatch.setattr(components, "FEW", few)
    monkeypatch.setattr(ngram_join, "CHUNK", 40)
    monkeypatch.setattr(ngram_join, "PAIRS_A_ROW", 0)
    rng, rows = random.Random(8), list(ODD)
    for base, copies in enumerate((100, 7, 3, 2)):
        words = [f"g{base}w{i}" for i in range(120)]
        for _ in range(copies):
            copy = list(words)
            for k in rng.sample(range(120), rng.randint(1, 5)):
                copy[k] = f"e{rng.randint(0, 10 ** 9)}"
            rows.append((1000 + len(rows), " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert in_order(ngram_join.join(docs)) == brute_components(rows)


def test_connected_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components.connected_components(links).collect()}
    assert got == {i: 0 for i in range(51)} | {100: 100, 101: 100}


# --- 9 ------------------------------------------------------------------------

def test_op9_base_equals_plain_patterns(spark, small):
    got = {r.doc_id: r for r in llm_queries()["op9_secret_scan"](spark, SMALL).collect()}
    for d, t in small:
        spans = [(m.start(), 0, m.end(), "assign") for m in re.finditer(
            r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 8]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        base = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
        assert got[d].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert (got[d].n_assign, got[d].n_access, got[d].n_hex) == tuple(
            sum(x[3] == k for x in spans) for k in ("assign", "access", "hex"))
        assert set(filter(None, base.split(","))) <= set(got[d].spans.split(","))


def test_novel_secrets_and_redaction(spark):
    text = "the client uses credential qX7vTz0LkP93mNwR2sYb to sign in, not credential_provider_identifier_1"
    rows = spark.createDataFrame([(1, text, 5), (2, "plain words only", 16), (3, None, 0), (4, "password=abcdefgh12 é", 21)],
                                 "doc_id long, text string, n_chars long")
    got = {r.doc_id: r.spans for r in secrets.scan(rows).collect()}
    at = text.index("qX7v")
    assert got[1] == f"novel:{at}:{at + 20}" and got[2] == got[3] == "" and got[4] == "assign:0:19"
    out = {r.doc_id: r for r in secrets.redact(rows).collect()}
    assert out[1].text == text.replace("qX7vTz0LkP93mNwR2sYb", "[SECRET]") and out[1].n_chars == len(out[1].text)
    assert out[2].text == "plain words only" and out[2].n_chars == 16 and out[3].text is None
    assert out[4].text == "[SECRET] é"
    assert secrets.scan(rows.limit(0)).count() == 0


def test_digit_poor_keys_are_found_and_words_are_not(spark):
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    keys = ["wJalrXUtnFEMI/K7MDENG/bPxRfiCYzGqTwNvHjK"] + ["".join(rng.choices(letters, k=n)) for n in (16, 20, 24, 32) * 10]
    words = ["authenticationManagerFactory", "user_authentication_backend", "responsibilities", "nichtchzulichein",
             "src/main/java/com/example/security/TokenProvider", "OAuth2ClientCredentials", "4952935900253052"]
    text = [f"the credential {k} is used" for k in keys + words]
    rows = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secrets.scan(rows).collect()}
    assert [got[i] for i in range(len(keys))] == [f"novel:15:{15 + len(k)}" for k in keys]
    assert not any(got[i] for i in range(len(keys), len(text)))
    out = {r.doc_id: r.text for r in secrets.redact(rows).collect()}
    assert all(out[i] == "the credential [SECRET] is used" for i in range(len(keys)))


@pytest.mark.parametrize("gap", [1, 20, 32, 33, 40, 47, 48])
def test_candidates_start_within_reach_of_the_word(gap):
    key = "qX7vTz0LkP93mNwR2sYbA1zE"
    text = "credential" + " " * gap + key + " and a long tail of other text"
    assert secrets.find(text)[1] == [(10 + gap, 34 + gap, text[:10 + gap], key)]
    assert not secrets.find("credential" + " " * 49 + key)[1]
    long = key * 400
    assert [x[3] for x in secrets.find("credential " + long)[1]] == [long]


def test_novelty_is_measured_on_the_value_alone(spark):
    name, rng = "client_credential_private_key", random.Random(8)
    keys = ["".join(rng.choices("ABCDEFGHJKabcdefghjk0123456789", k=n)) for n in range(16, 33)]
    text = [f"{name} is needed: {name}={k}" for k in keys]
    rows = spark.createDataFrame(list(enumerate(text)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secrets.scan(rows).collect()}
    for i, (t, k) in enumerate(zip(text, keys)):
        assert got[i] == f"novel:{t.index(k)}:{len(t)}"
    padded, short = "qX7vTz0LkP93mNwR2sYb==", "private_key=a1b2c3"
    assert [x[3] for x in secrets.find(f"private {padded} ")[1]] == [padded]
    assert [x[3] for x in secrets.find(short)[1]] == [short]


# --- pipeline -----------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k == 1:
            seen = defaultdict(list)
            for d, t in before.items():
                seen["".join((t or "").translate(dict.fromkeys(range(9, 14), " ")).split(" "))].append((-len(t or ""), d))
            assert {r.doc_id for r in docs.collect()} == {min(x)[1] for x in seen.values()}
        if k == 2:
            groups = {c for _, _, c in brute_components(sorted(before.items()))}
            assert {r.doc_id for r in docs.collect()} == groups
        if k == 3:
            assert {r.doc_id for r in docs.collect()} == set(before)
            assert not any(re.search("AKIA[A-Z0-9]{12,}|[0-9a-f]{32,}", r.text) for r in docs.collect())
        if k < 4:
            assert docs.columns == columns
    assert docs.count() >= len(before)
    assert corpus_pipeline.run(spark, SMALL).count() == docs.count()


def test_op5_sample_of_repeated_rows(spark, odd):
    """Equal rows are drawn once, counted as often as they occur; missing labels and ids don't train."""
    labels = spark.createDataFrame([(i, t) for i, t in [(4, 1), (5, 1), (6, 0), (6, 0), (7, None), (8, 2), (None, 1), (99, 0)]],
                                   "doc_id long, toxic int")
    rows = {(r.doc_id, r.toxic): r.n for r in toxicity.draws(odd, labels).collect()}
    assert rows == {(4, 1): 1, (5, 1): 2, (6, 0): 2}
    assert toxicity.fit(odd, labels).share == 3 / 5
    empty = toxicity.fit(odd.limit(0), labels)
    assert empty.share == 0 and {r.score for r in toxicity.score(odd, empty).collect()} == {0.0}


def test_op5_first_draws_are_the_smallest(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE", 7)
    monkeypatch.setattr(toxicity, "PARTS", 3)
    rows = [(i, (i * 7919) % 1009 - 500, i % 2) for i in range(300)]
    got = toxicity.first_draws(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, draw long, toxic int, n long")).collect()
    want = [r for k in (0, 1) for r in sorted((r for r in rows if r[2] == k), key=lambda r: r[1])[:7]]
    assert sorted(tuple(r) for r in got) == sorted(want)
