"""Best-fit packing planned on a length histogram (operator 4).

1. ``cut_documents`` encodes each whole text once, ends it with id 0 and cuts
   only documents longer than a sequence; the first piece takes the
   remainder, all others are full. The pieces are written once with their
   ids, the task that made them, and how many pieces of the same length that
   task had made before.
2. ``plan`` runs best-fit decreasing over counts: the histogram has at most
   ``capacity`` rows, however many documents there are. The plan lists, per
   length, ranges of ranks and the slots they take.
3. ``pack`` gives every piece its rank within its length (pieces of that
   length in earlier tasks, plus those before it in its own) and joins ranks
   with the plan. No length is ever gathered in one task.

Defined cases: NULL text counts as empty and packs as the single id 0; NULL
or repeated ids are rows like any other (``piece`` counts within the row);
an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import saved, text_slices, tidy
from .tokens import encoder, vocabulary_path

CAPACITY = 2048
END_ID = 0
PIECES = "doc_id long, piece int, start long, length int, ids binary, task int, nth long"


def _cutter(path: str, capacity: int):
    def cut(batches):
        task, made = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        enc = encoder(path)
        for batch in batches:
            for a, b in text_slices(batch, most=1_000_000):
                part = batch.slice(a, b - a)
                ids, bounds = enc.encode_batch(part.column("text"))
                ends = bounds[1:] + np.arange(1, b - a + 1)
                payload = np.full(int(ends[-1]), END_ID, "<u4")
                keep = np.ones(len(payload), bool)
                keep[ends - 1] = False
                payload[keep] = ids
                n = np.diff(bounds) + 1
                pieces = -(-n // capacity)
                doc = np.repeat(np.arange(b - a), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                head = n - (pieces - 1) * capacity
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[doc], capacity)
                nth = np.empty(len(doc), np.int64)
                order = np.argsort(length, kind="stable")
                sizes = np.bincount(length, minlength=capacity + 1)
                nth[order] = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                nth += made[length]
                made += sizes
                raw, begin = payload.view(np.uint8).data, (ends - n)[doc] + start
                chunks = [bytes(raw[4 * x:4 * (x + y)]) for x, y in zip(begin.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(length.astype(np.int32)), pa.array(chunks, pa.binary()),
                     pa.array(np.full(len(doc), task, np.int32)), pa.array(nth)],
                    names=["doc_id", "piece", "start", "length", "ids", "task", "nth"])
    return cut


def cut_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text), written once into the shared folder."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return saved(rows.mapInArrow(tidy(_cutter(vocabulary or vocabulary_path(), capacity)), PIECES), "pieces")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``{length: count}``.

    Rows ``(length, from_rank, to_rank, first_sequence, per_sequence,
    offset)``: the i-th rank of a row goes to sequence ``first_sequence + i //
    per_sequence`` at ``offset + (i % per_sequence) * length``. Sequences with
    the same room and contents are handled as one run ``(room, first, count)``.
    """
    rows, runs, sequences = [], [], 0  # runs: sorted by room
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(runs, (length,))
            if at == len(runs):
                per = capacity // length
                opened = -(-left // per)
                bisect.insort(runs, (capacity, sequences, opened))
                sequences += opened
                continue
            room, first, count = runs.pop(at)
            per = room // length
            if left >= per:
                used = min(count, left // per)
                took = used * per
            else:
                used, per, took = 1, left, left
            rows.append((length, rank, rank + took, first, per, capacity - room))
            if room > per * length:
                bisect.insort(runs, (room - per * length, first, used))
            if used < count:
                bisect.insort(runs, (room, first + used, count - used))
            rank, left = rank + took, left - took
    return rows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (length, task, nth and any further columns) with their
    ``sequence_id`` and ``offset``."""
    counts = saved(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    slots = pieces.sparkSession.createDataFrame(
        plan(histogram, capacity),
        "plan_length int, from_rank long, to_rank long, first_sequence long, per_sequence long, at long")
    before = counts.select(F.col("length").alias("b_length"), F.col("task").alias("b_task"), (F.sum("n").over(
        W.partitionBy("length").orderBy("task")) - F.col("n")).alias("before"))
    ranked = pieces.join(before, (F.col("length") == F.col("b_length")) & (F.col("task") == F.col("b_task")))
    ranked = ranked.withColumn("rank", F.col("before") + F.col("nth"))
    placed = ranked.join(slots, (F.col("length") == F.col("plan_length")) & (F.col("rank") >= F.col("from_rank"))
                         & (F.col("rank") < F.col("to_rank")))
    i = F.col("rank") - F.col("from_rank")
    return placed.select(
        *[pieces[c] for c in pieces.columns],
        (F.col("first_sequence") + F.floor(i / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("at") + (i % F.col("per_sequence")) * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame) -> DataFrame:
    """Contract rows of the packing of ``docs``."""
    pieces = cut_documents(docs)
    digests = pieces.select("doc_id", "piece", "start", "length", "task", "nth", F.crc32("ids").alias("ids_crc32"))
    return pack(digests).select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32",
                                "sequence_id", "offset")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
