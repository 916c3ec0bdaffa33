"""N-gram Jaccard join by universe partition (operator 8).

A document's set is its distinct word 5-grams (64-bit hashes). Two documents
link when ``100 * |x & y| >= 75 * |x | y|``. The join is exact:

* **Bound.** Linked sets share at least ``3/7 * (|x| + |y|)`` elements, and the
  smaller has at least 3/4 of the larger's size.
* **Order.** The universe of hashes is put in one order: elements that few sets
  hold first, by hash, then the frequent ones, rarest first. Any order loses no
  link; this one leaves common passages and the shared text of near copies at
  the end.
* **Prefixes.** Counted from either set's start, the first element two linked
  sets share leaves room for all the elements they must share: at place ``i`` of
  ``x``, ``i <= |x| - 3/7 * (|x| + |y|)``. So a set writes its first quarter
  (place ``|x| / 4`` at most), and two sets of an element meet only if both
  places leave that room.
* **Partition.** Written elements are dealt by hash into parts of the universe;
  a part is grouped in one task. Frequent elements are kept out of it, dealt by
  set and met by joins.
* **Frequent elements** come from exact counts over all sets, dealt by hash like
  the partition; the list is bounded by its lowest count. What it leaves out
  is only later in meeting, never lost.
* **Candidates.** Copies of one set are one class from the start. Elements with
  the same classes count as one, with each class's first place. The
  classes of an element first meet a few neighbours in a random order of them
  (a few pairs a row); what links is merged, again while very many pairs are
  left and rounds find links; then all pairs of an element whose classes are
  still in different components meet. Every candidate is verified on the
  whole sets.

Defined cases: NULL and empty texts have the empty set, size 0, and link with
nothing; with fewer than five words the whole sequence is one shingle; rows
that repeat a ``doc_id`` are separate rows (a component's id is a ``doc_id``);
a NULL ``doc_id`` is written as NULL and stands for no component; empty tables
give no row; extra columns are ignored.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_saved, fresh, saved, scan_partitions, text_slices, tidy
from .components import connected_components, is_few

SHINGLE = 5
SLICE = 500_000
"""Bytes of text taken at a time: a worker's arrays are some 40 times that."""
FREQUENT = 200_000
"""Elements kept as frequent, at most (16 bytes each)."""
FREQUENT_TIMES = 10
"""Distinct sets that make an element frequent."""
HELD = 2_000_000
"""Elements a task holds before it passes them on to be counted."""
BUCKET_ROWS = 2_000_000
"""Elements of all sets to a part of the universe, about; a quarter is written."""
TURNS, REACH = 3, 6
"""Rounds of neighbours at most, and the neighbours that follow a class in all but the first."""
PAIRS_A_ROW = 16
"""Pairs left per row, at most, that end the rounds."""
CHUNK = 512
"""Classes of an element that are put in order together, about."""

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


# --- sets -----------------------------------------------------------------------

_BASE = 0xC6A4A7935BD1E995
_BLOCK = 1 << 20
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32


@functools.lru_cache(maxsize=None)
def _powers(base: int) -> np.ndarray:
    """``base ** k`` modulo 2**64 for k below a block, then of whole blocks."""
    def table(b):
        out = np.full(_BLOCK, b, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    with np.errstate(over="ignore"):
        small = table(base)
        return small, table(int(small[-1]) * base & (1 << 64) - 1)


def _power(base: int, k: np.ndarray) -> np.ndarray:
    small, large = _powers(base)
    with np.errstate(over="ignore"):
        return small[k & (_BLOCK - 1)] * large[k >> 20]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (lower-cased in A-Z) and the text of each.

    A word's hash is a polynomial in its bytes, taken from running sums over
    the whole buffer, then mixed with its length."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    texts = pa.concat_arrays([texts])
    offset = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offset[0]:offset[-1]] if data and len(texts) else np.zeros(0, np.uint8)
    offset = offset - offset[0]
    folded = _FOLD[raw]
    inside = folded != 32
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edges = offset[1:-1][offset[1:-1] < len(raw)]
    begin[edges] = inside[edges]  # a text's first character starts a word
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = edges[edges > 0] - 1
    last[cuts] = inside[cuts]
    start, end = np.flatnonzero(begin), np.flatnonzero(last) + 1
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        for a in range(0, len(raw), _BLOCK):  # block by block, to stay small
            b = min(a + _BLOCK, len(raw))
            term = (folded[a:b].astype(np.uint64) + np.uint64(1)) * _power(_BASE, np.arange(a, b))
            sums[a + 1:b + 1] = np.cumsum(term, dtype=np.uint64) + sums[a]
        h = (sums[end] - sums[start]) * _power(pow(_BASE, -1, 1 << 64), start)
        h = mix(h ^ mix((end - start).astype(np.uint64)))
    return h, np.searchsorted(offset, start, side="right") - 1


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' sets, sorted, one after another, and where each begins (one
    more at the end)."""
    n = len(texts)
    h, doc = word_hashes(texts)
    words = np.bincount(doc, minlength=n)
    first = np.cumsum(words) - words
    rolled, short = np.zeros(len(h), np.uint64), {}
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):
            m = len(h) - k
            if m <= 0:
                break
            rolled[:m] = mix(rolled[:m] * np.uint64(0x9E3779B97F4A7C15) + h[k:] + np.uint64(k + 1))
            if k + 1 < SHINGLE:  # texts of k + 1 words are one shingle
                at = np.flatnonzero(words == k + 1)
                short.update(zip(at.tolist(), rolled[first[at]].tolist()))
    grams = np.where(words >= SHINGLE, words - SHINGLE + 1, np.minimum(words, 1))
    ends = np.cumsum(grams)
    at = np.arange(int(ends[-1]) if n else 0) + np.repeat(first - (ends - grams), grams)
    value = rolled[at]
    for row, only in short.items():
        value[ends[row] - 1] = only
    new = np.ones(len(value), bool)
    for p, q in zip((ends - grams).tolist(), ends.tolist()):
        value[p:q].sort()
    new[1:] = value[1:] != value[:-1]
    new[(ends - grams)[grams > 0]] = True
    owner = np.repeat(np.arange(n), grams)
    return value[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=n))])


PER_CELL = 8


def sketches(value: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Per set, how many elements (255 at most) fall into each cell of the
    universe, for as many cells as hold about ``PER_CELL`` elements. Two sets
    differ in at least as many elements as their cells' counts."""
    out, h = [], mix(value + np.uint64(0x5851F42D4C957F2D))
    for p, q in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        bits = max(4, ((q - p) // PER_CELL).bit_length())
        cell = (h[p:q] >> np.uint64(64 - bits)).astype(np.int64)
        out.append(np.minimum(np.bincount(cell, minlength=1 << bits), 255).astype(np.uint8).tobytes())
    return out


def cells_apart(x: bytes, y: bytes) -> int:
    """The least difference two sketches prove; the finer one's cells are joined."""
    x, y = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
    if len(x) > len(y):
        x, y = y, x
    return int(np.abs(x - y.reshape(len(x), -1).sum(axis=1)).sum())


# --- prefixes -------------------------------------------------------------------

def part_of(value: np.ndarray, parts: int) -> np.ndarray:
    """The part of the universe each element falls into; parts ascend with the elements."""
    return (value >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)


def counted_names(value: np.ndarray, parts: int) -> np.ndarray:
    """Elements as they are counted: their part and low 32 bits. Should two
    share a name, they are merely counted as one."""
    return part_of(value, parts) << np.uint64(32) | value & np.uint64(0xFFFFFFFF)


_MAYBE = np.uint64((1 << 22) - 1)


class Frequent:
    """Ranks of the frequent elements, rarest first from 1; 0 for all others."""

    def __init__(self, names: np.ndarray, times: np.ndarray, parts: int):
        rank = np.empty(len(names), np.int64)
        rank[np.lexsort((names, times))] = np.arange(1, len(names) + 1)
        order = np.argsort(names)
        self.names, self.rank, self.parts = names[order], rank[order], parts

    def ranks(self, value: np.ndarray) -> np.ndarray:
        out = np.zeros(len(value), np.int64)
        if not len(self.names):
            return out
        maybe = np.zeros(int(_MAYBE) + 1, bool)  # most elements need no search
        maybe[self.names & _MAYBE] = True
        some = np.flatnonzero(maybe[value & _MAYBE])
        name = counted_names(value[some], self.parts)
        at = np.minimum(np.searchsorted(self.names, name), len(self.names) - 1)
        out[some] = np.where(self.names[at] == name, self.rank[at], 0)
        return out


def prefixes(value: np.ndarray, bounds: np.ndarray, rank: np.ndarray):
    """``(row, at, place)``: the sets' elements (``value[at]``) up to place
    ``size // 4`` of the order by rank, then hash. Sets are sorted by hash."""
    n = np.diff(bounds)
    owner, last = np.repeat(np.arange(len(n)), n), n // 4
    before = np.concatenate([[0], np.cumsum(rank == 0)])
    rare = before[bounds[1:]] - before[bounds[:-1]]
    place = before[:-1] - before[bounds[:-1]][owner]
    first = np.flatnonzero((rank == 0) & (place <= last[owner]))
    # Frequent elements follow, where the others don't fill the prefix.
    more = np.flatnonzero((rank > 0) & (rare <= last)[owner])
    more = more[np.lexsort((value[more], rank[more], owner[more]))]
    own = owner[more]
    follow = rare[own] + np.arange(len(own)) - np.searchsorted(own, own)
    kept = follow <= last[own]
    at = np.concatenate([first, more[kept]])
    return owner[at], at, np.concatenate([place[first], follow[kept]])


# --- Spark jobs -----------------------------------------------------------------

def _class_keys(value, bounds, salt: int):
    """128 bits that name each set: sums of its mixed elements."""
    out = []
    with np.errstate(over="ignore"):
        for k in (2 * salt + 1, 2 * salt + 2):
            c = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(value + np.uint64(k)), dtype=np.uint64)])
            out.append(mix(c[bounds[1:]] - c[bounds[:-1]]).astype(np.int64))
    return out


def _first_of(keys: np.ndarray, size: np.ndarray, seen: set) -> np.ndarray:
    """Rows whose set is not empty and was not seen in this task before."""
    rows = np.sort(np.unique(keys, return_index=True)[1])
    fresh_rows = [r for r, k in zip(rows.tolist(), keys[rows].tolist()) if size[r] and k not in seen]
    seen.update(keys[fresh_rows].tolist())
    return np.array(fresh_rows, np.int64)


def _only(value, bounds, rows):
    n = np.diff(bounds)[rows]
    at = np.repeat(bounds[rows], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return value[at], np.concatenate([[0], np.cumsum(n)])


_DOCUMENT = ["text_key", "doc_id", "n_shingles", "class", "check", "sketch"]
_DOCUMENT_TYPES = "text_key long, doc_id long, n_shingles long, class long, check long, sketch binary"


def _summarise(salt: int, parts: int):
    """Per document its set's size and name (to negative parts, in turn); the
    elements of a task's distinct sets, packed by part of the universe."""

    def packed(held):
        value = np.sort(np.concatenate(held))
        part = part_of(value, parts).astype(np.int64)
        cuts = np.flatnonzero(np.diff(part, prepend=part[:1] - 1, append=part[-1:] + 1))
        low = (value & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        nothing = pa.nulls(len(cuts) - 1, pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(part[cuts[:-1]].astype(np.int32)), *[nothing] * 5, pa.nulls(len(nothing), pa.binary()),
             pa.array([low[p:q].tobytes() for p, q in zip(cuts, cuts[1:])], pa.binary())],
            names=["part", *_DOCUMENT, "elements"])

    def run(batches):
        held, size, seen, done = [], 0, set(), 0
        for batch in batches:
            for a, b in text_slices(batch, most=SLICE):
                rows = batch.slice(a, b - a)
                value, bounds = shingle_sets(rows.column("text"))
                n = np.diff(bounds)
                key, check = _class_keys(value, bounds, salt)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((-1 - np.arange(done, done + b - a) % parts).astype(np.int32)),
                     rows.column("text_key"), rows.column("doc_id"), pa.array(n), pa.array(key), pa.array(check),
                     pa.array(sketches(value, bounds), pa.binary()), pa.nulls(b - a, pa.binary())],
                    names=["part", *_DOCUMENT, "elements"])
                done += b - a
                held.append(_only(value, bounds, _first_of(key, n, seen))[0])
                size += len(held[-1])
                if size > HELD:
                    yield packed(held)
                    held, size = [], 0
        if size:
            yield packed(held)
    return run


def _counted(least: int):
    """Of a part of the universe, the elements that ``least`` sets hold and
    their number; of a negative part, the documents."""

    def run(key, table):
        part = key[0].as_py()
        if part < 0:
            nothing = pa.nulls(table.num_rows, pa.int64())
            return table.select(_DOCUMENT).append_column("element", nothing).append_column("times", nothing)
        low = np.frombuffer(b"".join(table.column("elements").to_pylist()), np.uint32)
        value, times = np.unique(low, return_counts=True)
        value, times = value[times >= least], times[times >= least]
        nothing = pa.nulls(len(value), pa.int64())
        return pa.table([*[nothing] * 5, pa.nulls(len(value), pa.binary()),
                         pa.array(value.astype(np.int64) + (part << 32)), pa.array(times.astype(np.int64))],
                        names=[*_DOCUMENT, "element", "times"])
    return run


def _frequent(counts: DataFrame, parts: int) -> Frequent:
    """The most frequent elements, down to the lowest count that keeps them within ``FREQUENT``."""
    least, total = None, 0
    for r in sorted(counts.groupBy("times").agg(F.count(F.lit(1)).alias("many")).collect(), key=lambda r: -r.times):
        total += r.many
        if total > FREQUENT:
            break
        least = r.times
    if least is None:
        return Frequent(np.zeros(0, np.uint64), np.zeros(0, np.int64), parts)
    found = counts.filter(F.col("times") >= least).select("element", "times").toArrow()
    return Frequent(found.column("element").to_numpy().astype(np.uint64), found.column("times").to_numpy(), parts)


_EMITTED = "part int, elements binary, classes binary, sizes binary, places binary"
_PACKED = [("classes", np.int64), ("sizes", np.uint32), ("places", np.uint16)]


def _emit(frequent: Frequent, parts: int, salt: int):
    """Prefixes of a task's distinct sets, packed by part of the universe, one
    row per part and slice of text. An element is written as 40 bits beside
    its part. Frequent ones go by class, to negative parts, whole: no part
    gathers all of a frequent element. A place past 65,535 is written as that,
    which lets more pairs meet, not fewer."""

    def run(batches):
        seen = set()
        for batch in batches:
            for a, b in text_slices(batch, most=SLICE):
                value, bounds = shingle_sets(batch.slice(a, b - a).column("text"))
                key, _ = _class_keys(value, bounds, salt)
                new = _first_of(key, np.diff(bounds), seen)
                value, bounds = _only(value, bounds, new)
                rank = frequent.ranks(value)
                row, at, place = prefixes(value, bounds, rank)
                if not len(row):
                    continue
                ids, common = key[new][row], rank[at] > 0
                part = part_of(value[at], parts).astype(np.int64)
                part[common] = -1 - (ids[common].view(np.uint64) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                part, short = part[order], value[at][order].view(np.uint8).reshape(-1, 8)
                columns = [ids[order], np.diff(bounds)[row][order].astype(np.uint32),
                           np.minimum(place, 65_535)[order].astype(np.uint16)]
                cuts = np.flatnonzero(np.diff(part, prepend=part[:1] - 1, append=part[-1:] + 1))
                raw = [(short[p:q] if part[p] < 0 else short[p:q, :5]).tobytes() for p, q in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[cuts[:-1]].astype(np.int32)), pa.array(raw, pa.binary()),
                     *[pa.array([x[p:q].tobytes() for p, q in zip(cuts, cuts[1:])], pa.binary()) for x in columns]],
                    names=["part", "elements", *[name for name, _ in _PACKED]])
    return run


def _first_places(s, c, n, place):
    """Rows in the order of ``s``, ``c``, one of each with its smallest place."""
    order = np.lexsort((place, c, s))
    s, c, n, place = s[order], c[order], n[order], place[order]
    first = np.ones(len(s), bool)
    first[1:] = (s[1:] != s[:-1]) | (c[1:] != c[:-1])
    return s[first], c[first], n[first], place[first]


def _shared(key, table):
    """Of one part of the universe, the groups of classes that share an
    element (``signature``); of a negative part, all rows.

    Texts with a passage in common share many elements, all with the same
    classes: a group is named by a hash of its classes and given once, with
    the smallest place of each class. Should two groups have one name, their
    classes merely meet as one group."""
    raw = np.frombuffer(b"".join(table.column("elements").to_pylist()), np.uint8)
    c, n, place = (np.frombuffer(b"".join(table.column(name).to_pylist()), kind) for name, kind in _PACKED)
    if key[0].as_py() < 0:
        s, c, n, place = _first_places(raw.view(np.int64), c, n, place)
    else:
        wide = np.zeros((len(c), 8), np.uint8)
        wide[:, :5] = raw.reshape(-1, 5)
        s, c, n, place = _first_places(wide.view(np.int64).ravel(), c, n, place)  # tasks that hold copies write the same rows
        same = np.zeros(len(s), bool)
        same[1:] = s[1:] == s[:-1]
        same[:-1] |= same[1:]
        s, c, n, place = s[same], c[same], n[same], place[same]
        if len(s):
            starts = np.flatnonzero(np.diff(s, prepend=s[:1] - 1))
            with np.errstate(over="ignore"):
                name = mix(np.add.reduceat(mix(c.view(np.uint64)), starts)).view(np.int64)
            s, c, n, place = _first_places(np.repeat(name, np.diff(np.append(starts, len(s)))), c, n, place)
    return pa.table({"signature": pa.array(s), "class": pa.array(c), "n": pa.array(n.astype(np.int64)),
                     "place": pa.array(place.astype(np.int64))})


BITS_PER_ROW, MOST_BITS = 32, 1 << 26
"""A filter of wanted rows has at most 8 MB, however many there are."""


def _row_filter(wanted: DataFrame, n: int) -> np.ndarray:
    """Bits of the wanted rows' text hashes."""
    bits = 1 << max(10, min(MOST_BITS, n * BITS_PER_ROW).bit_length() - 1)
    slot = F.pmod("text_key", F.lit(bits))
    words = wanted.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("s") % 64).cast("int"))).alias("w")).collect()
    out = np.zeros(bits // 64, np.uint64)
    out[[r.word for r in words]] = np.array([r.w for r in words], np.int64).astype(np.uint64)
    return out


def _set_blobs(wanted: np.ndarray):
    """Sets of the rows that the filter lets through."""

    def run(batches):
        for batch in batches:
            key = np.mod(batch.column("text_key").to_numpy(), len(wanted) * 64)
            through = (wanted[key >> 6] >> (key & 63).astype(np.uint64)) & np.uint64(1)
            batch = batch.filter(pa.array(through.astype(bool)))
            for a, b in text_slices(batch, most=SLICE) if batch.num_rows else []:
                rows = batch.slice(a, b - a)
                value, bounds = shingle_sets(rows.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("id"), rows.column("text_key"),
                     pa.array([value[p:q].tobytes() for p, q in zip(bounds, bounds[1:])], pa.binary())],
                    names=["id", "text_key", "shingles"])
    return run


def _verify(batches):
    for batch in batches:
        ok = np.zeros(batch.num_rows, bool)
        for k, (x, y) in enumerate(zip(batch.column("xs").to_pylist(), batch.column("ys").to_pylist())):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            inter = int((y[at] == x).sum())
            ok[k] = 100 * inter >= 75 * (len(x) + len(y) - inter)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("class").alias("b"), F.col("shingles").alias("xs"))
    right = sets.select(F.col("class").alias("a"), F.col("shingles").alias("ys"))
    if is_few(pairs):
        pairs = F.broadcast(pairs)
    return pairs.join(left, "b").join(right, "a").mapInArrow(tidy(_verify), "a long, b long")


def _possible_rows(batches):
    for batch in batches:
        ok = [7 * cells_apart(x, y) <= n for x, y, n in zip(*(batch.column(c).to_pylist() for c in ("xs", "ys", "n")))]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(
            pa.array(ok, pa.bool_()))


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose cell counts leave room for a link: linked sets differ in at
    most a seventh of their sizes' sum."""
    left = classes.select(F.col("class").alias("b"), F.col("sketch").alias("xs"), F.col("n").alias("n_b"))
    right = classes.select(F.col("class").alias("a"), F.col("sketch").alias("ys"), F.col("n").alias("n_a"))
    return (pairs.join(left, "b").join(right, "a").select("a", "b", "xs", "ys", (F.col("n_a") + F.col("n_b")).alias("n"))
            .mapInArrow(tidy(_possible_rows), "a long, b long"))


def _sets_of(pairs: DataFrame, classes: DataFrame, sets: DataFrame, rows: DataFrame) -> DataFrame:
    """Whole sets, from their texts, of the ``classes`` in ``pairs`` that ``sets`` has not."""
    named = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class")))
    if is_few(pairs):  # joined where the classes are, without a shuffle
        named = F.broadcast(named.coalesce(1).distinct())
        held = F.broadcast(sets.select("class").join(named, "class", "left_semi"))
    else:
        named, held = named.distinct(), sets.select("class")
    wanted = saved(classes.join(named, "class", "left_semi").join(held, "class", "left_anti").select(
        "class", F.coalesce("of.doc_id", F.lit(-1)).alias("id"), F.col("of.text_key").alias("text_key")), "wanted")
    # A NULL id reads as -1: the text's hash still tells such rows apart. Rows
    # that repeat an id and its text give the same set; one is taken.
    texts = rows.select(F.coalesce("doc_id", F.lit(-1)).alias("id"), "text_key", "text")
    some = texts.mapInArrow(tidy(_set_blobs(_row_filter(wanted, wanted.count()))), "id long, text_key long, shingles binary")
    return some.join(wanted, ["id", "text_key"]).dropDuplicates(["id", "text_key"]).select("class", "shingles")


def _room(x: str, y: str) -> str:
    """Whether the places of a shared element leave room for a link."""
    return f"(7 * {x}.place <= 4 * {x}.n - 3 * {y}.n AND 7 * {y}.place <= 4 * {y}.n - 3 * {x}.n)"


def _neighbours(apart: DataFrame, turn: int) -> DataFrame:
    """Pairs of classes in different components that are near each other in a
    random order of a signature's classes. A signature of many classes is put
    in order in several chunks, which no task gathers."""
    dealt = apart.withColumn("h", F.xxhash64("class", "signature", F.lit(turn))).withColumn(
        "chunk", F.pmod("h", F.coalesce(F.ceil(F.col("all") / CHUNK), F.lit(1))))
    order = Window.partitionBy("signature", "chunk").orderBy("h", "class")
    row = F.struct("class", "n", "place", "label")
    next_rows = F.array(*[F.lead(row, k).over(order) for k in range(1, (REACH if turn else 1) + 1)])
    wanted = F.expr(f"filter(next, q -> q IS NOT NULL AND p.label <> q.label AND {_room('p', 'q')})")
    # Dealt by b, as the join that follows needs them: a class has a few neighbours a signature.
    return (dealt.select(row.alias("p"), next_rows.alias("next")).select("p", F.explode(wanted).alias("q"))
            .select(F.least("p.class", "q.class").alias("a"), F.greatest("p.class", "q.class").alias("b"))
            .repartition("b").distinct())


def _unmerged(shared: DataFrame) -> DataFrame:
    """The rows of ``shared`` before any link: each class is a component, and
    signatures of many classes have their number (``all``)."""
    many = shared.groupBy("signature").agg(F.count(F.lit(1)).alias("all")).filter(F.col("all") > CHUNK)
    # Broadcast (a row for 512 at most): a join's partitions by signature would serve the window, chunks or not.
    return shared.join(F.broadcast(many), "signature", "left").withColumn("label", F.col("class"))


def _apart(shared: DataFrame, found: DataFrame) -> tuple[DataFrame, bool]:
    """The rows of ``shared`` (signature, class, n, place) whose signature is
    held in several components, with their component (``label``), the one
    that most rows of the signature have (``usual``) and the number of its rows
    (``all``); whether they make many pairs. Signatures only ever leave this
    table."""
    labelled = saved(shared.join(found.withColumnRenamed("node", "class"), "class", "left").select(
        "signature", "class", "n", "place", F.coalesce("component", "class").alias("label")), "labelled")
    held = labelled.groupBy("signature", "label").agg(F.count(F.lit(1)).cast("double").alias("held"))
    mixed = saved(held.groupBy("signature").agg(
        F.max_by("label", F.struct("held", "label")).alias("usual"), F.count(F.lit(1)).alias("labels"),
        F.sum("held").alias("all"), F.sum(F.col("held") * F.col("held")).alias("same")).filter("labels > 1"), "mixed")
    usual = mixed.select("signature", "usual", "all")
    out = saved(labelled.join(F.broadcast(usual) if is_few(mixed) else usual, "signature"), "apart")
    rows, pairs = mixed.agg(F.sum("all"), F.sum((F.col("all") * F.col("all") - F.col("same")) / 2)).first()
    for table in (labelled, mixed):
        drop_saved(table)
    return out, (pairs or 0) > PAIRS_A_ROW * (rows or 0)


def _all_pairs(apart: DataFrame) -> DataFrame:
    """All pairs of a signature's classes in different components: at least
    one of the two is not of the usual component."""
    return (apart.filter("label <> usual").alias("p").join(apart.alias("q"), F.expr(
        f"p.signature = q.signature AND p.label <> q.label AND (q.label = q.usual OR p.class < q.class) AND {_room('p', 'q')}"))
        .select(F.least("p.class", "q.class").alias("a"), F.greatest("p.class", "q.class").alias("b")).distinct())


def _verified_links(near: DataFrame, links: DataFrame, sets: DataFrame, classes: DataFrame, rows: DataFrame):
    """``links`` and ``sets`` with what the pairs of ``near`` add; the same objects if there is no link more."""
    if near.isEmpty():
        return links, sets
    sets = sets.unionByName(saved(_sets_of(near, classes, sets, rows), "sets"))
    more = saved(_verified(near, sets), "links")
    return (links if more.isEmpty() else saved(links.unionByName(more), "links")), sets


def components(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, group`` of every row of
    ``docs`` (doc_id, text); ``text_key`` is a hash of the text, ``group`` the
    component's class (NULL for the empty set)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64(F.col("text").cast("string")).alias("text_key"))
    parts = 4 * scan_partitions(rows)
    salt, clash = -1, True
    while clash:  # two sets of one name: name them anew
        salt += 1
        summary = saved(rows.mapInArrow(tidy(_summarise(salt, parts)), f"part int, {_DOCUMENT_TYPES}, elements binary")
                        .groupBy("part").applyInArrow(_counted(FREQUENT_TIMES), f"{_DOCUMENT_TYPES}, element long, times long"),
                        "set-summary")
        documents = summary.filter("element IS NULL").select(*_DOCUMENT)
        # One class per distinct set; one of its texts stands for it.
        classes = saved(documents.filter("n_shingles > 0").groupBy("class").agg(
            F.min(F.struct("doc_id", "text_key")).alias("of"), F.first("n_shingles").alias("n"),
            F.first("sketch").alias("sketch"),
            (F.min("check") != F.max("check")).alias("clash")), "classes")
        elements, clash = classes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.bool_or("clash"), F.lit(False))).first()
    frequent = _frequent(summary.filter("element IS NOT NULL"), parts)
    buckets = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(elements / BUCKET_ROWS))

    shared = saved(rows.select("text").mapInArrow(tidy(_emit(frequent, buckets, salt)), _EMITTED).groupBy("part").applyInArrow(
        _shared, "signature long, class long, n long, place long").groupBy("signature", "class").agg(
        F.first("n").alias("n"), F.min("place").alias("place")), "shared-signatures")
    empty = rows.sparkSession.createDataFrame
    links, found = empty([], "a long, b long"), empty([], "node long, component long")
    sets, apart = empty([], "class long, shingles binary"), _unmerged(shared)
    # Neighbours first, until few pairs are left or a round finds no link; then all pairs of different components.
    for turn in range(TURNS):
        near = saved(_possible(_neighbours(apart, turn), classes), "possible")
        before = links
        links, sets = _verified_links(near, links, sets, classes, rows)
        if links is not before:
            found = saved(connected_components(links), "components")
        met = apart
        apart, many = _apart(met, found)
        if turn:
            drop_saved(met)
        if links is before or not many:
            break
    near = saved(_possible(_all_pairs(apart), classes), "possible")
    before = links
    links, sets = _verified_links(near, links, sets, classes, rows)
    if links is not before:
        found = saved(connected_components(links), "components")
    for table in (shared, sets, apart):
        drop_saved(table)

    named = documents.drop("sketch").join(found.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "group", F.when(F.col("n_shingles") > 0, F.coalesce("component", "class")))
    # A component's id is the smallest doc_id of all its rows, copies included.
    smallest = named.filter("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("smallest"))
    return named.join(smallest, "group", "left").select(
        "doc_id", "text_key", "n_shingles", F.coalesce("smallest", "doc_id").alias("component_id"), "group")


def join(docs: DataFrame) -> DataFrame:
    """Contract rows: set size and component of every document."""
    return components(docs).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those of a component that are not its
    smallest (by id, then text hash); all columns as they were. Rows that
    repeat an id and its text stay or go together."""
    key, one = fresh(docs, "dq_text_key"), saved(components(docs), "components")
    first = one.filter("group IS NOT NULL").groupBy("group").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    gone = saved(one.join(first, "group").filter(~F.struct("doc_id", "text_key").eqNullSafe(F.col("first")))
                 .select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct(), "near-copies")
    marked = docs.withColumn(key, F.xxhash64(F.col("text").cast("string")))
    return marked.join(gone, marked["doc_id"].eqNullSafe(gone["gone_id"]) & (marked[key] == gone["gone_key"]),
                       "left_anti").select(*docs.columns)


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP8_SQL = r"""
WITH RECURSIVE lists AS MATERIALIZED (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT d, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT d, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM lists WHERE len(w) > 0) t),
sizes AS MATERIALIZED (SELECT d, count(*) AS n FROM shingles GROUP BY d),
meets AS MATERIALIZED (
  SELECT a.d AS x, b.d AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.d < b.d GROUP BY ALL),
linked AS MATERIALIZED (
  SELECT x, y FROM meets JOIN sizes p ON p.d = x JOIN sizes q ON q.d = y WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
edges AS MATERIALIZED (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
reach AS (
  SELECT d AS a, d AS b FROM sizes
  UNION SELECT reach.a, edges.y FROM reach JOIN edges ON edges.x = reach.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(
    (SELECT min(o.doc_id) FROM reach JOIN lists o ON o.d = reach.b WHERE reach.a = l.d), doc_id) AS component_id
FROM lists l LEFT JOIN sizes USING (d)
"""
