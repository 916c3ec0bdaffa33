"""Subword lattice likelihood (operator 1).

A word is written as the vocabulary's word mark and its characters. Every way
to cut it into vocabulary pieces is a path of a lattice; its probability is
the product of the pieces' probabilities, and the word's is the sum over all
paths, found by a forward recursion in log space. A word of the training rows
has one arc more, over the whole word: it carries the word's discounted
relative frequency, and the piece paths share the mass the discount frees
(absolute discounting; the discount is estimated from the words seen once and
twice). The training rows' languages each discount their own counts onto that
common measure; a document's language is not looked at but summed over, and
within a language its words follow a Dirichlet-multinomial around the measure
(``CONCENTRATION``), so a word once used is likelier to come again. A document
is its words and then the end.

The vocabulary is fixed: pieces and scores of an existing file. Its scores
(minus the rank) give the first weights, 1 / (1 + rank). ``ROUNDS`` rounds of
expectation maximisation over the counts of all training words re-weight the
pieces, the first weights staying in as a prior of ``PRIOR`` pieces. A
character without a piece of its own is written with the byte pieces.

Spark's share: each task numbers its distinct words and writes its documents
as those numbers; words are counted by a shuffle on the word, where each
distinct word meets its lattice once; counts and probabilities return to the
task's documents by its number (one part holds at most ``PART_WORDS`` distinct
words and one slice of text more). No vocabulary of the corpus is ever
collected or broadcast: only the piece weights are, at most 32,000 numbers.

Defined cases: NULL text is empty and scores its end token; a NULL id counts
as empty text in the fold; repeated rows are scored each; words of any length
are scored whole; an empty table gives no row; with no training row every
count is 0 and pieces keep their first weights; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import fold, saved, split_words, text_slices

ROUNDS = 2
CONCENTRATION = 2000.0
CLASSES = 15
PRIOR = 1000.0
PART_WORDS = 400_000
PART_TOKENS = 20_000_000
"""A part ends with either many words or many tokens: its texts are scored in one task."""
FOLDS = 10
MARK = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 20


class Pieces:
    """The pieces of a vocabulary file, found by a hash of their characters."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size, self.end = sp.get_piece_size(), sp.eos_id()
        self.byte = np.full(256, -1, np.int64)
        rank, texts = np.full(self.size, float(self.size)), {}
        for i in range(self.size):
            if sp.is_byte(i):
                self.byte[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                texts[sp.id_to_piece(i)] = i
                rank[i] = -sp.get_score(i)
        rank[self.end] = 0.0
        self.first = 1.0 / (1.0 + rank)
        self.first /= self.first.sum()
        self.longest = max(map(len, texts))
        self.marked = np.array([i for t, i in texts.items() if t[0] == MARK])
        self.single = np.array(sorted(ord(t) for t in texts if len(t) == 1), np.uint32)
        # Open addressing on the top bits; `probes` is the longest chain.
        self.keys, self.ids, self.probes = np.zeros(1 << _TABLE_BITS, np.uint64), np.full(1 << _TABLE_BITS, -1), 1
        for text, i in texts.items():
            h = 0
            for ch in text:
                h = (h * int(_BASE) + ord(ch) + 1) & (1 << 64) - 1
            slot, chain = (h * 0xD6E8FEB86659FD93 & (1 << 64) - 1) >> (64 - _TABLE_BITS), 1
            while self.ids[slot] >= 0:
                if self.keys[slot] == h:
                    raise ValueError("two pieces share a hash")
                slot, chain = (slot + 1) % (1 << _TABLE_BITS), chain + 1
            self.keys[slot], self.ids[slot] = h, i
            self.probes = max(self.probes, chain)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes, -1 where there is none."""
        slot = ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        out = np.where(self.keys[slot] == h, self.ids[slot], -1)
        for _ in range(self.probes - 1):
            slot = (slot + 1) % (1 << _TABLE_BITS)
            out = np.where((out < 0) & (self.ids[slot] >= 0) & (self.keys[slot] == h), self.ids[slot], out)
        return out


_PIECES: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def default_vocabulary() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def _lattices(words: pa.Array, pieces: Pieces, logp: np.ndarray):
    """For words of one length at a time: their row numbers, the log
    probability of each, and the lattice (edges by end position)."""
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4")
    start = np.cumsum(length) - length
    order = np.argsort(length, kind="stable")
    bounds = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
    for a, b in zip(bounds, bounds[1:]):
        n, block = int(length[order[a]]), max(1, 200_000 // (int(length[order[a]]) + 1))
        for lo in range(a, b, block):
            rows = order[lo:min(lo + block, b)]
            codes = np.empty((len(rows), n + 1), np.uint32)
            codes[:, 0] = ord(MARK)
            codes[:, 1:] = flat[start[rows, None] + np.arange(n)]
            yield rows, *_forward(codes, pieces, logp)


def _forward(codes: np.ndarray, pieces: Pieces, logp: np.ndarray):
    count, n = codes.shape
    alpha = np.full((n + 1, count), -np.inf)
    alpha[0] = 0.0
    plus, edges = codes.astype(np.uint64) + np.uint64(1), []
    unknown = np.isin(codes, pieces.single, invert=True)
    with np.errstate(over="ignore"):
        hashes: list[np.ndarray] = []  # of the substrings that end here, longest first
        for j in range(1, n + 1):
            ch = plus[:, j - 1]
            hashes = [h * _BASE + ch for h in hashes[-(pieces.longest - 1):]] + [ch]
            for i, h in zip(range(j - len(hashes), j), hashes):
                piece = pieces.find(h)
                at = np.flatnonzero(piece >= 0)
                if len(at):
                    piece = piece[at]
                    alpha[j, at] = np.logaddexp(alpha[j, at], alpha[i, at] + logp[piece])
                    edges.append((i, j, at, piece, None))
            at = np.flatnonzero(unknown[:, j - 1])
            if len(at):
                kinds, which = np.unique(codes[at, j - 1], return_inverse=True)
                written = [pieces.byte[list(chr(c).encode())] for c in kinds.tolist()]
                lp = np.array([logp[w].sum() for w in written])[which]
                alpha[j, at] = np.logaddexp(alpha[j, at], alpha[j - 1, at] + lp)
                edges.append((j - 1, j, at, which, written))
    return alpha, edges


LONG = 200
"""Words of more characters are recursed one at a time: their edges are found for
all positions at once, length by length, and only the sums go position by position."""


class LongWord:
    """The lattice of one long word. Edges are sorted by their end."""

    def __init__(self, word: str, pieces: Pieces, logp: np.ndarray):
        codes = np.frombuffer((MARK + word).encode("utf-32-le"), "<u4")
        n, plus = len(codes), codes.astype(np.uint64) + np.uint64(1)
        begins, ends, ids, h = [], [], [], plus
        with np.errstate(over="ignore"):
            for size in range(1, min(pieces.longest, n) + 1):
                if size > 1:
                    h = h[:-1] * _BASE + plus[size - 1:]
                piece = pieces.find(h)
                at = np.flatnonzero(piece >= 0)
                begins.append(at), ends.append(at + size), ids.append(piece[at])
        at = np.flatnonzero(np.isin(codes, pieces.single, invert=True))
        self.kinds, which = np.unique(codes[at], return_inverse=True)
        self.written = [pieces.byte[list(chr(c).encode())] for c in self.kinds.tolist()]
        begins.append(at), ends.append(at + 1), ids.append(-1 - which)      # written byte by byte
        begin, end, ids = (np.concatenate(x) for x in (begins, ends, ids))
        order = np.argsort(end, kind="stable")
        self.n, self.begin, self.end, self.ids = n, begin[order], end[order], ids[order]
        spelt = np.array([logp[w].sum() for w in self.written] or [0.0])
        self.lp = np.where(self.ids >= 0, logp[np.maximum(self.ids, 0)], spelt[np.maximum(-1 - self.ids, 0)])

    def _recursion(self, sources: np.ndarray, targets: np.ndarray, order: np.ndarray, first: int) -> np.ndarray:
        """Log sums over all paths from ``first``, taking edges in ``order``."""
        out, lp = [-math.inf] * (self.n + 1), self.lp
        out[first] = 0.0
        exp, log1p = math.exp, math.log1p
        for i, j, p in zip(sources[order].tolist(), targets[order].tolist(), lp[order].tolist()):
            x, y = out[i] + p, out[j]
            if x > -math.inf:
                out[j] = x if y == -math.inf else (x + log1p(exp(y - x)) if x > y else y + log1p(exp(x - y)))
        return np.array(out)

    def forward(self) -> np.ndarray:
        return self._recursion(self.begin, self.end, np.arange(len(self.end)), 0)

    def backward(self) -> np.ndarray:
        return self._recursion(self.end, self.begin, np.argsort(-self.begin, kind="stable"), self.n)

    def expected(self, out: np.ndarray, weight: float) -> None:
        """Add ``weight`` times the expected uses of each piece to ``out``."""
        alpha, beta = self.forward(), self.backward()
        use = np.exp(alpha[self.begin] + self.lp + beta[self.end] - alpha[-1]) * weight
        known = self.ids >= 0
        out += np.bincount(self.ids[known], use[known], minlength=len(out))
        for ids, share in zip(self.written, np.bincount(-1 - self.ids[~known], use[~known], minlength=len(self.written))):
            np.add.at(out, ids, share)


def _short_and_long(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    return np.flatnonzero(length <= LONG), np.flatnonzero(length > LONG)


def word_log_probability(words: pa.Array, pieces: Pieces, logp: np.ndarray) -> np.ndarray:
    """Natural log of each word's marginal probability."""
    out = np.empty(len(words))
    short, long = _short_and_long(words)
    for rows, alpha, _ in _lattices(words.take(pa.array(short)), pieces, logp):
        out[short[rows]] = alpha[-1]
    for i in long:
        out[i] = LongWord(words[int(i)].as_py(), pieces, logp).forward()[-1]
    return out


def expected_counts(words: pa.Array, weight: np.ndarray, pieces: Pieces, logp: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece over ``weight`` copies of the words."""
    out = np.zeros(pieces.size)
    short, long = _short_and_long(words)
    for i in long:
        LongWord(words[int(i)].as_py(), pieces, logp).expected(out, float(weight[i]))
    weight = weight[short]
    for rows, alpha, edges in _lattices(words.take(pa.array(short)), pieces, logp):
        beta = np.full(alpha.shape, -np.inf)
        beta[-1] = 0.0
        total, w = alpha[-1], weight[rows]
        for i, j, at, piece, written in reversed(edges):
            lp = logp[piece] if written is None else np.array([logp[x].sum() for x in written])[piece]
            use = np.exp(alpha[i, at] + lp + beta[j, at] - total[at]) * w[at]
            beta[i, at] = np.logaddexp(beta[i, at], lp + beta[j, at])
            if written is None:
                out += np.bincount(piece, use, minlength=pieces.size)
            else:
                for k, share in enumerate(np.bincount(piece, use, minlength=len(written))):
                    np.add.at(out, written[k], share)
    return out


# --- Spark jobs -----------------------------------------------------------------

NUMBERED = "part long, doc_id long, held_out boolean, class int, words binary, local int, word string, n_train array<long>"
_NUMBERED = pa.schema([("part", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("class", pa.int32()),
                       ("words", pa.binary()), ("local", pa.int32()), ("word", pa.string()),
                       ("n_train", pa.list_(pa.int64()))])


def _number_words(classes: int):
    """Documents as numbers of their words, and the numbered words with their
    training counts by class, part by part."""

    def run(batches):
        task, k, known, train, tokens = TaskContext.get().partitionId(), 0, {}, np.zeros(0, np.int64), 0
        part = task << 24

        def words_out():
            names, n = list(known), len(known)
            for a in range(0, n, 100_000):
                b = min(a + 100_000, n)
                counts = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * classes),
                                                  pa.array(train[a * classes:b * classes]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b - a, part)), pa.nulls(b - a, pa.int64()), pa.nulls(b - a, pa.bool_()),
                     pa.nulls(b - a, pa.int32()), pa.nulls(b - a, pa.binary()),
                     pa.array(np.arange(a, b, dtype=np.int32)), pa.array(names[a:b]), counts], schema=_NUMBERED)

        for batch in batches:
            for a, b in text_slices(batch):
                rows = batch.slice(a, b - a)
                flat, doc = split_words(rows.column("text"))
                coded = flat.dictionary_encode()
                number = np.fromiter((known.setdefault(w, len(known)) for w in coded.dictionary.to_pylist()), np.int32,
                                     len(coded.dictionary))
                words = number[coded.indices.to_numpy(zero_copy_only=False)] if len(flat) else np.zeros(0, np.int32)
                learn = ~rows.column("held_out").to_numpy(zero_copy_only=False)[doc]
                kind = rows.column("class").to_numpy(zero_copy_only=False)[doc]
                new = np.zeros(len(known) * classes, np.int64)
                new[:len(train)] = train
                train = new + np.bincount(words[learn].astype(np.int64) * classes + kind[learn], minlength=len(new))
                sizes = np.bincount(doc, minlength=b - a)
                ends = np.cumsum(sizes)
                raw = words.astype("<i4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b - a, part)), rows.column("doc_id"), rows.column("held_out"),
                     rows.column("class"),
                     pa.array([raw[4 * (e - s):4 * e] for s, e in zip(sizes.tolist(), ends.tolist())], pa.binary()),
                     pa.nulls(b - a, pa.int32()), pa.nulls(b - a, pa.string()), pa.nulls(b - a, _NUMBERED[-1].type)],
                    schema=_NUMBERED)
                tokens += len(words)
                if len(known) > PART_WORDS or tokens > PART_TOKENS:
                    yield from words_out()
                    known, train, tokens, k = {}, np.zeros(0, np.int64), 0, k + 1
                    part = task << 24 | k
        yield from words_out()
    return run


def _larger(batches, rows: int = 100_000):
    """Batches joined to about ``rows`` rows: lattices of one length are then many at a time."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _expect(path: str, logp: np.ndarray):
    def run(batches):
        pieces, total = pieces_of(path), None
        for batch in _larger(batches):
            got = expected_counts(batch.column("word"), batch.column("c").to_numpy().astype(float), pieces, logp)
            total = got if total is None else total + got
        if total is not None:
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])],
                                             names=["piece", "uses"])
    return run


def _score_words(path: str, logp: np.ndarray):
    def run(batches):
        pieces = pieces_of(path)
        for batch in _larger(batches):
            # Rows come sorted by word: each distinct word of the batch is scored once.
            coded = batch.column("word").dictionary_encode()
            lp = word_log_probability(coded.dictionary, pieces, logp)
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("local"), batch.column("c"),
                 pa.array(lp[coded.indices.to_numpy(zero_copy_only=False)])], names=["part", "local", "c", "lp"])
    return run


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


class Totals:
    """Tokens, distinct tokens, discount and ends of some training rows."""

    def __init__(self, row, kind: str, ends: int):
        once, twice = row[f"once_{kind}"], row[f"twice_{kind}"]
        self.ends, self.n, self.v = ends, row[f"n_{kind}"] + ends, row[f"v_{kind}"] + (ends > 0)
        self.discount = min(0.95, max(0.1, once / max(1, once + 2 * twice)))

    def discounted(self, c, below):
        """Log of the discounted relative frequency of counts, the freed mass
        spread as ``below`` (a log too: long words fall beneath any double)."""
        if not self.n:
            return below
        with np.errstate(divide="ignore"):
            own = np.log(np.maximum(c - self.discount, 0) / self.n)
        return np.logaddexp(own, math.log(self.discount * self.v / self.n) + below)


def _score_documents(every: Totals, kinds: list[Totals], end_lp: float, concentration: float):
    floor = every.n + 0.1 * (every.v + 1)
    prior = np.array([k.ends + 1.0 for k in kinds])
    prior /= prior.sum()
    end_base = math.log10((every.ends + 0.1) / floor)

    def run(key, docs, words):
        local = words.column("local").to_numpy()
        lp, counts = np.zeros(len(local)), np.zeros((len(local), len(kinds)))
        lp[local] = words.column("lp").to_numpy()
        counts[local] = pc.list_flatten(words.column("c")).to_numpy().reshape(-1, len(kinds))
        c = counts.sum(axis=1)
        base, known = np.log10((c + 0.1) / floor), c > 0
        common = every.discounted(c, lp)
        end_common = every.discounted(every.ends, end_lp)

        raw = docs.column("words").combine_chunks()
        w = np.frombuffer(b"".join(raw.to_pylist()), "<i4")
        sizes = pc.binary_length(raw).to_numpy(zero_copy_only=False) // 4
        doc = np.repeat(np.arange(len(raw)), sizes)
        # again: how often the document has had the word before.
        order = np.lexsort((w, doc))
        new = np.ones(len(w), bool)
        new[1:] = (np.diff(w[order]) != 0) | (np.diff(doc[order]) != 0)
        first = np.flatnonzero(new)
        again = np.empty(len(w))
        again[order] = np.arange(len(w)) - np.repeat(first, np.diff(np.append(first, len(w))))
        repeats = np.flatnonzero(again)
        before = np.arange(len(w)) - np.repeat(np.cumsum(sizes) - sizes, sizes)

        def total(x):
            return np.bincount(doc, x, minlength=len(raw))

        told = np.empty((len(kinds), len(raw)))
        for i, kind in enumerate(kinds):
            p = math.log(concentration) + kind.discounted(counts[:, i], common)
            p_end = math.log(concentration) + kind.discounted(kind.ends, end_common)
            each = p[w]
            each[repeats] = np.log(again[repeats] + np.exp(each[repeats]))
            told[i] = math.log(prior[i]) + total(each) + p_end
        told = np.logaddexp.reduce(told, axis=0) - total(np.log(before + concentration)) - np.log(sizes + concentration)
        return pa.table({"doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"),
                         "n_tokens": pa.array(sizes.astype(np.int64) + 1),
                         "n_known": pa.array((total(known[w]) + (every.ends > 0)).astype(np.int64)),
                         "train_tokens": pa.array([every.n] * len(raw), pa.int64()),
                         "base_score": pa.array(total(base[w]) + end_base),
                         "score": pa.array(told / math.log(10))})
    return run


def score(docs: DataFrame, folds: int = FOLDS, vocabulary: str | None = None, rounds: int = ROUNDS,
          concentration: float = CONCENTRATION, classes: int = CLASSES) -> DataFrame:
    """Fit on the rows whose fold is not 0 and score every row. ``classes``
    languages at most (the commonest) have counts of their own; the others and
    rows without one share a further class."""
    path = vocabulary or default_vocabulary()
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       (fold("doc_id", folds) == 0).alias("held_out"), lang.alias("lang"))
    kinds = [r.lang for r in rows.filter("NOT held_out AND lang IS NOT NULL").groupBy("lang").count()
             .orderBy(F.desc("count"), "lang").limit(classes).collect()]
    n_kinds = len(kinds) + 1
    rows = rows.withColumn("class", F.coalesce(F.array_position(F.array(*map(F.lit, kinds)).cast("array<string>"),
                                                                F.col("lang")), F.lit(0)).cast("int")).drop("lang")
    numbered = saved(rows.mapInArrow(_number_words(n_kinds), NUMBERED), "numbered")
    documents = numbered.filter("local IS NULL").select("part", "doc_id", "held_out", "class", "words")
    word = W.partitionBy("word")
    # A word has one row per part, so even the commonest group is the number of parts.
    counted = saved(numbered.filter("local IS NOT NULL").select(
        "part", "local", "word", F.array(*[F.sum(F.col("n_train")[i]).over(word) for i in range(n_kinds)]).alias("c"),
        (F.row_number().over(word.orderBy("part")) == 1).alias("first")), "word-counts")
    distinct = counted.filter("first").select("word", "c", F.aggregate("c", F.lit(0).cast("long"),
                                                                       lambda a, x: a + x).alias("all"))
    parts = {"all": F.col("all")} | {str(i): F.col("c")[i] for i in range(n_kinds)}
    sums = distinct.agg(*[agg for k, c in parts.items() for agg in (
        F.coalesce(F.sum(c), F.lit(0)).alias(f"n_{k}"), F.count_if(c > 0).alias(f"v_{k}"),
        F.count_if(c == 1).alias(f"once_{k}"), F.count_if(c == 2).alias(f"twice_{k}"))]).first()
    ends = {r["class"]: r["count"] for r in documents.filter("NOT held_out").groupBy("class").count().collect()}
    every = Totals(sums, "all", sum(ends.values()))
    by_kind = [Totals(sums, str(i), ends.get(i, 0)) for i in range(n_kinds)]

    pieces = pieces_of(path)
    p = pieces.first
    train = distinct.filter("all > 0").select("word", F.col("all").alias("c"))
    for _ in range(rounds if every.n else 0):
        uses = train.mapInArrow(_expect(path, np.log(p)), "piece int, uses double")
        new = PRIOR * pieces.first
        for r in uses.groupBy("piece").agg(F.sum("uses").alias("uses")).collect():  # at most one row per piece
            new[r.piece] += r.uses
        new[pieces.end] += every.ends
        p = new / new.sum()
    logp = np.log(p)
    # A word or the end follows a word, so the end is one of the pieces that may stand there.
    starts = p[pieces.marked].sum() + p[pieces.end]
    scored = counted.mapInArrow(_score_words(path, logp), "part long, local int, c array<long>, lp double")
    return documents.groupBy("part").cogroup(scored.groupBy("part")).applyInArrow(
        _score_documents(every, by_kind, float(logp[pieces.end]) - math.log(starts), concentration), SCORED)


def op1_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
