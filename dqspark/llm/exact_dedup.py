"""Exact deduplication with a heavy-hitter split (operator 10, native).

1. Each row's digest (sha256 of the text without ASCII white space) and
   length are computed once and written, with a row number of their own.
2. A frequent-items sketch of the Misra-Gries family (``approx_top_k``: a
   fixed number of counters, mergeable) names the digests that may hold a
   large share of the rows.
3. Their exact counts and winners come from a map-side aggregation over the
   candidates: at most ``candidates`` rows, broadcast. Rows with such a digest
   are decided where they are read, without a shuffle.
4. The other digests, none of them frequent, are shuffled and decided by a
   window.

Any candidate list gives the same result; the sketch only decides which rows
move. Defined cases: NULL text counts as empty; of equal texts the longest
original (in code points) stays, then the smallest ``doc_id`` (NULL first),
then the first row read, so that of repeated rows one stays; empty tables give
no row; extra columns are ignored by ``decide`` and kept by ``keep_first``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import fresh, saved

WHITE = " \t\n\u000b\f\r"
CANDIDATES = 256
COUNTERS = 4096
BROADCAST_ROWS = 1_000_000


def digest(text: str = "text"):
    """sha256 (hex) of the text without ASCII white space; NULL as empty."""
    return F.sha2(F.translate(F.coalesce(F.col(text), F.lit("")), WHITE, "").cast("binary"), 256)


def decide(docs: DataFrame, candidates: int = CANDIDATES, counters: int = COUNTERS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row."""
    rows = saved(docs.select(
        "doc_id", digest().alias("text_sha256"),
        (-F.length(F.coalesce(F.col("text"), F.lit("")))).alias("shorter"),
        F.monotonically_increasing_id().alias("row")), "digests")
    frequent = (rows.agg(F.expr(f"approx_top_k(text_sha256, {candidates}, {counters})").alias("top"))
                .select(F.explode("top").alias("t")).select(F.col("t.item").alias("text_sha256")))
    best = F.struct("shorter", "doc_id", "row")
    winners = saved(rows.join(F.broadcast(frequent), "text_sha256", "left_semi").groupBy("text_sha256")
                    .agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("group_size")), "winners")
    # At most `candidates` rows, as the sketch names no more.
    winners = F.broadcast(winners)
    heavy = rows.join(winners, "text_sha256").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256")
    group = W.partitionBy("text_sha256")
    light = (rows.join(winners.select("text_sha256"), "text_sha256", "left_anti")
             .select("doc_id", "text_sha256", "row", F.min(best).over(group).alias("best"),
                     F.count(F.lit(1)).over(group).alias("group_size"))
             .select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                     (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256"))
    return heavy.unionByName(light)


def _short(sha):
    """120 bits of a hex digest as two longs."""
    return [F.conv(F.substring(sha, i, 15), 16, 10).cast("long") for i in (1, 16)]


def keep_first(docs: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were.

    Only keys (id and digest) that are dropped, or held by several rows, are
    looked up: rows without such a key pass where they are read, and no text is
    shuffled while those keys are at most ``broadcast_rows`` (two dozen bytes
    each); beyond that the join shuffles. Of repeated rows, the longest is kept per
    task before they meet.
    """
    names = [fresh(docs, f"dq_{n}") for n in ("id", "a", "b", "drop")]
    own, keys, drop = names[0], names[:3], names[3]
    decided = decide(docs).select("doc_id", "kept", *[c.alias(n) for c, n in zip(_short(F.col("text_sha256")), names[1:])])
    special = saved(decided.groupBy("doc_id", *names[1:3]).agg(F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
                    .filter("NOT kept OR n > 1").select(F.col("doc_id").alias(own), *names[1:3], (~F.col("kept")).alias(drop)),
                    "dropped-or-repeated")
    found = {r[drop]: r["count"] for r in special.groupBy(drop).count().collect()}     # two rows
    if sum(found.values()) <= broadcast_rows:
        special = F.broadcast(special)
    looked_up = docs.select("*", *[c.alias(f"{n}_") for c, n in zip(_short(digest()), names[1:3])])
    meets = [F.col("doc_id").eqNullSafe(F.col(own)), *(F.col(f"{n}_") == F.col(n) for n in names[1:3])]
    if not found:
        return docs
    marked = looked_up.join(special, meets, "left")
    out = marked.filter(F.col(drop).isNull()).select(*docs.columns)
    if found.get(False):
        longest = F.max_by(F.struct(*docs.columns), F.length(F.coalesce(F.col("text"), F.lit(""))))
        once = marked.filter(~F.col(drop)).groupBy(*keys).agg(longest.alias(drop))
        out = out.unionByName(once.select(f"{drop}.*"))
    return out


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""
