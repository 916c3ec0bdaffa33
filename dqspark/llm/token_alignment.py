"""Cross-tokenizer alignment (operator 13), in Arrow.

Two vocabularies encode the same bytes: A a byte-level BPE file, B a
SentencePiece model. Per slice of documents:

1. Ids are Arrow lists; flattened with their parent indices they give one row
   per token, and a cumulative sum of the tokens' byte lengths, segmented by
   document, gives each token's end. Document and end make one key.
2. An Acero full outer hash join on that key brings the ends of A and B
   together. Sorted by key and filled backward, each row is one *link*, an
   A-B pair of overlapping tokens; a row both sides had ends a *group*, the
   smallest run of bytes both cut alike.
3. ``Table.group_by`` counts each document's id pairs. A task collects them
   into *parts* of at most ``PART_PAIRS`` (a document is never split), and
   writes each part's distinct pairs with their partial counts, and its
   documents with places into that list.

Spark adds the partial counts, finds each B id's highest, joins both back to
the parts' pairs, and a cogroup by part scores the documents. Nothing
corpus-wide is broadcast or collected; a pair that every document holds is one
row per part.

Defined cases: a text that is NULL, empty, or not restored by B's bytes (such
as one holding U+2581) has no tokens, thus zeros and an empty digest; NULL,
repeated and non-unique ids are rows like any other and repeated rows count
each; special tokens' strings are plain text; texts of any length are read
whole; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, text_slices
from .tokens import cut_long, encoder, vocabulary_path

PIECES = "piece_bpe_32k.model"
PART_PAIRS = 2_000_000
SLICE = 1_000_000
_END_BITS = 40
_MARK = "▁"


class PieceEncoder:
    """Ids of a SentencePiece model that marks spaces with U+2581 and adds one
    before each text, and the bytes of each piece."""

    def __init__(self, path: str, limit: int = 1_000_000):
        import sentencepiece

        self.sp, self.limit = sentencepiece.SentencePieceProcessor(model_file=path), limit
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.token_bytes = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace(_MARK, " ").encode()
                            for i, p in enumerate(pieces)]
        # No piece has a space after another character, so no piece crosses a safe space.
        self.cuts = not any(_MARK in p.lstrip(_MARK) for p in pieces)

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts = [cut_long(t, self.limit) if self.cuts else [t] for t in texts.to_pylist()]
        ids = self.sp.encode([p for ps in parts for p in ps], num_threads=1)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *map(len, parts)])]
        return np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(sizes.sum())), ends


@dataclass(frozen=True)
class Pair:
    """Both encoders with their tables by id."""
    a: object
    b: PieceEncoder
    a_length: np.ndarray
    b_length: np.ndarray
    b_bytes: pa.Array
    written: pa.Array    # every id as text with each sign that may follow it


@cache
def pair(a_path: str, b_path: str) -> Pair:
    a, b = encoder(a_path, specials=False), PieceEncoder(b_path)
    size_a, size_b = a.size, len(b.token_bytes)
    written = [f"{i}{s}" for i in range(size_a) for s in ",|"] + [f"{i}{s}" for i in range(size_b) for s in (",", ";", "")]
    return Pair(a, b, np.array([len(a.token_bytes.get(i, b"")) for i in range(size_a)]),
                np.array([len(x) for x in b.token_bytes]), pa.array(b.token_bytes, pa.large_binary()),
                pa.array(written, pa.large_string()))


@dataclass(frozen=True)
class Aligned:
    """The documents of one slice that have tokens, in order."""
    rows: np.ndarray          # their places in the slice
    a: pa.Array               # ids per document
    b: pa.Array
    a_last: np.ndarray        # per token: does its group end with it?
    b_last: np.ndarray
    doc: np.ndarray           # per link: its document (a place in ``rows``)
    end: np.ndarray           # the end of its bytes within space + text
    link_a: np.ndarray
    link_b: np.ndarray
    last: np.ndarray          # does its group end with it?


def _per_list(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _restored(ids: np.ndarray, bounds: np.ndarray, enc: Pair, spaced: pa.Array) -> np.ndarray:
    """Whether each text's B tokens, joined, are the text's bytes."""
    size = pc.binary_length(spaced).to_numpy()
    ok = _per_list(enc.b_length[ids], bounds) == size
    joined = enc.b_bytes.take(pa.array(ids))
    if ok.all() and np.array_equal(*(np.frombuffer(x.buffers()[2], np.uint8, int(size.sum())) for x in (joined, spaced))):
        return ok
    wanted = spaced.to_pylist()
    for i in np.flatnonzero(ok):
        ok[i] = b"".join(enc.b.token_bytes[x] for x in ids[bounds[i]:bounds[i + 1]]) == wanted[i].encode()
    return ok


def _ends(lists: pa.Array, length: np.ndarray, name: str) -> pa.Table:
    """One row per token: its document-end key and its id."""
    doc, ids = pc.list_parent_indices(lists).to_numpy(), pc.list_flatten(lists)
    total = np.cumsum(length[ids.to_numpy()])
    count = pc.list_value_length(lists).to_numpy()
    base = np.concatenate([[0], total])[np.cumsum(count) - count]      # bytes before each document
    return pa.table({"key": (doc << _END_BITS) + total - base[doc], name: ids})


def align_texts(texts: pa.Array, enc: Pair) -> Aligned:
    """Align the texts of an Arrow array; those without tokens are left out."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    rows = np.flatnonzero(pc.not_equal(texts, "").to_numpy(zero_copy_only=False))
    full = texts.take(pa.array(rows))
    nothing, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
    spaced = pc.binary_join_element_wise(nothing, full, space)      # a space before each
    a, b = (pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32)))
            for ids, bounds in (enc.a.encode_batch(spaced), enc.b.encode_batch(full)))
    if len(rows):
        ok = _restored(b.values.to_numpy(), b.offsets.to_numpy(), enc, spaced)
        rows, a, b = rows[ok], a.filter(pa.array(ok)), b.filter(pa.array(ok))
    left, right = _ends(a, enc.a_length, "a"), _ends(b, enc.b_length, "b")
    ends = left.join(right, "key", join_type="full outer", use_threads=False)
    key = ends["key"].to_numpy()
    order = np.argsort(key, kind="stable")
    key, ends = key[order], ends.take(pa.array(order))
    a_here, b_here = (ends[c].is_valid().to_numpy() for c in ("a", "b"))
    link_a, link_b = (pc.fill_null_backward(ends[c]).to_numpy() for c in ("a", "b"))
    last = a_here & b_here
    return Aligned(rows, a, b, last[a_here], last[b_here], key >> _END_BITS, key & ((1 << _END_BITS) - 1), link_a, link_b, last)


def written_groups(al: Aligned, enc: Pair) -> list[memoryview]:
    """Each document's groups as ``a1,a2|b1;a3|b2,b3`` (ASCII bytes)."""
    if not len(al.rows):
        return []
    a, b = pc.list_flatten(al.a).to_numpy(), pc.list_flatten(al.b).to_numpy()
    a_ends, b_ends = (np.concatenate([[0], np.flatnonzero(x) + 1]) for x in (al.a_last, al.b_last))  # after each group
    a_group, b_group = np.cumsum(al.a_last) - al.a_last, np.cumsum(al.b_last) - al.b_last
    stop = np.cumsum(pc.list_value_length(al.b).to_numpy())
    b_sign = al.b_last.astype(np.int64)
    b_sign[stop - 1] = 2          # nothing follows a document's last token
    signed = np.empty(len(a) + len(b), np.int64)
    signed[np.arange(len(a)) + b_ends[a_group]] = 2 * a.astype(np.int64) + al.a_last
    signed[np.arange(len(b)) + a_ends[b_group + 1]] = 2 * len(enc.a_length) + 3 * b.astype(np.int64) + b_sign
    text = enc.written.take(pa.array(signed))
    offsets = np.frombuffer(text.buffers()[1], np.int64)[: len(text) + 1]
    tokens = np.cumsum(pc.list_value_length(al.a).to_numpy()) + stop
    cuts = np.concatenate([[0], offsets[tokens]])
    raw = memoryview(text.buffers()[2])
    return [raw[x:y] for x, y in itertools.pairwise(cuts.tolist())]


def _groups(a_path: str, b_path: str):
    """One row per document, its tokens and their groups."""
    names = ["doc_id", "a_ids", "b_ids", "group_end", "a_in_group", "b_in_group"]

    def run(batches):
        enc = pair(a_path, b_path)
        for batch in batches:
            for x, y in text_slices(batch, most=SLICE):
                part = batch.slice(x, y - x)
                al = align_texts(part.column("text"), enc)
                n = y - x

                def placed(values, per_row):
                    sizes = np.zeros(n, np.int64)
                    sizes[al.rows] = per_row
                    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))

                groups = np.bincount(al.doc[al.last], minlength=len(al.rows))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"),
                    placed(pc.list_flatten(al.a).to_numpy(), pc.list_value_length(al.a).to_numpy()),
                    placed(pc.list_flatten(al.b).to_numpy(), pc.list_value_length(al.b).to_numpy()),
                    placed(al.end[al.last], groups),
                    placed(np.diff(np.flatnonzero(al.a_last), prepend=-1).astype(np.int32), groups),
                    placed(np.diff(np.flatnonzero(al.b_last), prepend=-1).astype(np.int32), groups)], names=names)
    return run


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def groups(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """Per document the ids of both vocabularies and, per group, where its bytes
    end in space + text and how many tokens of each it holds."""
    return _rows(docs).mapInArrow(
        _groups(a or vocabulary_path(), b or vocabulary_path(PIECES)),
        "doc_id long, a_ids array<int>, b_ids array<int>, group_end array<long>, a_in_group array<int>, b_in_group array<int>")


_DOC = {"doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
        "groups_sha256": pa.string(), "links": pa.binary()}
_SLOT = {"slot": pa.int32(), "a": pa.int32(), "b": pa.int32(), "n": pa.int64()}
PARTS = ("part long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, "
         "slot int, a int, b int, n long")


def _part_rows(part: int, docs: dict[str, list], pairs: list[pa.Table]):
    """The two kinds of rows of a part: its documents, and its distinct pairs."""
    table = pa.concat_tables(pairs)      # doc, a, b, count_all: documents of the part in order
    counts = table.group_by(["a", "b"], use_threads=False).aggregate([("count_all", "sum")])
    slots = counts.append_column("slot", pa.array(np.arange(counts.num_rows, dtype=np.int32)))
    width = np.int64(1) << 32
    order = np.argsort(slots["a"].to_numpy() * width + slots["b"].to_numpy())
    keys = (slots["a"].to_numpy() * width + slots["b"].to_numpy())[order]
    slot = order[np.searchsorted(keys, table["a"].to_numpy() * width + table["b"].to_numpy())]
    doc, times = table["doc"].to_numpy(), table["count_all"].to_numpy()
    by_doc = np.lexsort((slot, doc))
    packed = np.stack([slot[by_doc], times[by_doc]], axis=1).astype("<u4")
    stops = np.searchsorted(doc[by_doc], np.arange(len(docs["doc_id"]) + 1))
    links = [packed[x:y].tobytes() for x, y in itertools.pairwise(stops.tolist())]

    def batch(n, have):
        fields = {"part": pa.int64(), **_DOC, **_SLOT}
        have = {"part": pa.array(np.full(n, part, np.int64)), **have}
        return pa.RecordBatch.from_arrays([have.get(k, pa.nulls(n, t)) for k, t in fields.items()], names=list(fields))

    yield batch(len(links), {k: pa.array(v, _DOC[k]) for k, v in {**docs, "links": links}.items()})
    yield batch(counts.num_rows, {"slot": slots["slot"].combine_chunks(), "a": counts["a"].combine_chunks(),
                                  "b": counts["b"].combine_chunks(), "n": counts["count_all_sum"].combine_chunks().cast(pa.int64())})


def _aligner(a_path: str, b_path: str, part_pairs: int):
    def run(batches):
        enc, made = pair(a_path, b_path), TaskContext.get().partitionId() << 32
        docs, pairs = {k: [] for k in _DOC if k != "links"}, []
        for batch in batches:
            for x, y in text_slices(batch, most=SLICE):
                part = batch.slice(x, y - x)
                al = align_texts(part.column("text"), enc)
                m, first = len(al.rows), len(docs["doc_id"])
                digests = np.full(y - x, "", object)
                digests[al.rows] = [hashlib.sha256(g).hexdigest() for g in written_groups(al, enc)]
                numbers = {"n_a": pc.list_value_length(al.a).to_numpy(), "n_b": pc.list_value_length(al.b).to_numpy(),
                           "n_groups": np.bincount(al.doc[al.last], minlength=m), "n_links": np.bincount(al.doc, minlength=m)}
                docs["doc_id"] += part.column("doc_id").to_pylist()
                docs["groups_sha256"] += digests.tolist()
                for name, values in numbers.items():
                    all_rows = np.zeros(y - x, np.int64)
                    all_rows[al.rows] = values
                    docs[name] += all_rows.tolist()
                pairs.append(pa.table({"doc": first + al.rows[al.doc], "a": al.link_a, "b": al.link_b}).group_by(
                    ["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")]))
                if sum(p.num_rows for p in pairs) >= part_pairs:
                    yield from _part_rows(made, docs, pairs)
                    docs, pairs, made = {k: [] for k in docs}, [], made + 1
        if docs["doc_id"]:
            yield from _part_rows(made, docs, pairs)
    return run


def align(docs: DataFrame, a: str | None = None, b: str | None = None, part_pairs: int = PART_PAIRS) -> DataFrame:
    """The parts of ``docs`` (doc_id, text), written once into the shared folder:
    rows of documents (``slot`` NULL) and rows of pairs."""
    run = _aligner(a or vocabulary_path(), b or vocabulary_path(PIECES), part_pairs)
    return saved(_rows(docs).mapInArrow(run, PARTS), "aligned")


def pair_counts(parts: DataFrame) -> DataFrame:
    """``a, b, n``: how many links of all documents hold each id pair."""
    return parts.filter("slot IS NOT NULL").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _score(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    out = docs.drop_columns(["part", "links"])
    total = np.zeros(pairs.num_rows, np.int64)
    best = np.zeros(pairs.num_rows, bool)
    slot = pairs["slot"].to_numpy()
    total[slot], best[slot] = pairs["total"].to_numpy(), pairs["best"].to_numpy()
    raw = docs["links"].to_pylist()
    links = np.frombuffer(b"".join(raw), "<u4").reshape(-1, 2).astype(np.int64)
    bounds = np.cumsum([0, *(len(r) // 8 for r in raw)])
    return out.append_column("n_best", pa.array(_per_list(links[:, 1] * best[links[:, 0]], bounds))).append_column(
        "count_sum", pa.array(_per_list(links[:, 1] * total[links[:, 0]], bounds)))


def score(parts: DataFrame) -> DataFrame:
    """Per document its numbers, ``n_best`` and ``count_sum``."""
    counts = pair_counts(parts).withColumnRenamed("n", "total")
    highest = counts.groupBy("b").agg(F.max("total").alias("highest"))
    judged = counts.join(highest, "b").select("a", "b", "total", (F.col("total") == F.col("highest")).alias("best"))
    pairs = parts.filter("slot IS NOT NULL").select(F.col("part").alias("of_part"), "slot", "a", "b").join(
        judged, ["a", "b"]).select("of_part", "slot", "total", "best")
    docs = parts.filter("slot IS NULL").select("part", *_DOC)
    return docs.groupBy("part").cogroup(pairs.groupBy("of_part")).applyInArrow(
        _score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(align(spark.read.parquet(f"{sf_dir}/documents.parquet"))).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
