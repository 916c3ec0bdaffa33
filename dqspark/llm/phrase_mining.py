"""Phrase collocations by prefix-free parsing (operator 12).

1. *Parse.* Texts are lower-cased (A to Z) and cut at punctuation into pieces
   and words. Two neighbouring words whose hash is 0 modulo ``EVERY`` are a
   trigger; a piece is cut after each trigger, and the next chunk begins with
   the trigger's two words again. Cuts depend on content only, so a passage
   gives the same chunks wherever it stands.
2. *Dictionary.* Distinct chunks per language with how often the parse holds
   them: partial counts per batch, added by Spark. It is written once.
3. *Counts.* N-grams of up to three words are counted inside distinct chunks,
   weighted by their frequency. Every n-gram lies in a chunk whole, and is
   counted where its last word is not one of the two repeated words, so
   overlaps count once. Words come first, then pairs of frequent words, then
   triples of frequent pairs. "Frequent" is asked of a bitmap of ``BITMAP_BITS``
   hashed bits, the only thing broadcast: a stray hit costs a row, no result.
4. *Scores.* Phrases of at least ``AT_LEAST`` occurrences are cut in two, both
   parts' counts joined, and the score taken in exact decimals. Phrases that
   mostly stand inside a longer one are dropped; each language's first ``TOP``
   are ranked, first within parts, then over what the parts leave.

Defined cases: NULL or empty text has no words; NULL lang is ``und``, together
with a lang of that name; ids are not read, repeated rows count each; ties are
ordered by phrase in UTF-8 byte order; texts of any length are read whole; an
empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import saved, text_slices
from .words import byte_classes, words

EVERY = 6
AT_LEAST = 10
LONGEST = 3
SCALE = 1_000_000
INSIDE_PERCENT = 50
TOP = 2000
PARTS = 64
BITMAP_BITS = 1 << 26
UNKNOWN = "und"
_OVERLAP = LONGEST - 1
_SLICE = 4_000_000
_COUNTED = 8_000_000
"""Bytes of dictionary rows counted together."""
_CLASSES = byte_classes(white=b" \t", end=b".,;:!?\n\x0b\f\r")


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of two hashes, in order."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + b
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(27))


def _hashes(strings: pa.Array) -> np.ndarray:
    distinct = strings.dictionary_encode()
    if not len(distinct):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(distinct.dictionary.to_numpy(zero_copy_only=False), categorize=False)[
        distinct.indices.to_numpy(zero_copy_only=False)]


# --- the parse ------------------------------------------------------------------

def chunks(langs: pa.Array, texts: pa.Array, every: int = EVERY) -> pa.Table:
    """Distinct ``lang, opens, chunk`` of the texts' parse and their frequency
    ``n``; ``opens`` chunks begin a piece, others begin with repeated words."""
    found = words(texts, _CLASSES, lower=True)
    m = len(found.text)
    ends_before = np.cumsum(found.kind == 2)[found.start]
    opens = np.ones(m + 1, bool)
    opens[1:m] = (found.doc[1:] != found.doc[:-1]) | (ends_before[1:] != ends_before[:-1])
    h = _hashes(found.text)
    trigger = np.zeros(m, bool)
    trigger[1:] = (_mixed(h[:-1], h[1:]) % np.uint64(every) == 0) & ~opens[1:m]
    last = np.flatnonzero(trigger | opens[1:])               # last word of every chunk
    own = np.concatenate([[0], last[:-1] + 1])[:len(last)]   # its first word that is not repeated
    begins = opens[own]
    first = np.where(begins, own, own - _OVERLAP)
    size = last + 1 - first
    at = np.cumsum(size) - size
    index = np.repeat(first - at, size) + np.arange(int(size.sum()))
    lists = pa.LargeListArray.from_arrays(pa.array(np.append(at, len(index))), found.text.take(pa.array(index)))
    row = pa.array(found.doc[own])
    table = pa.table({"lang": pc.fill_null(langs.cast(pa.string()), UNKNOWN).take(row), "opens": pa.array(begins),
                      "chunk": pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())})
    return table.group_by(["lang", "opens", "chunk"], use_threads=False).aggregate([([], "count_all")]).rename_columns(
        ["lang", "opens", "chunk", "n"])


def _parse(batches):
    for batch in batches:
        for a, b in text_slices(batch, most=_SLICE):
            part = batch.slice(a, b - a)
            yield from chunks(part.column("lang"), part.column("text")).combine_chunks().to_batches()


def parse(docs: DataFrame) -> DataFrame:
    """The dictionary of ``docs`` (lang, text): ``lang, opens, chunk, n``."""
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(_parse, "lang string, opens boolean, chunk string, n long")
    return saved(counted.groupBy("lang", "opens", "chunk").agg(F.sum("n").alias("n")), "chunks")


# --- counts ---------------------------------------------------------------------

def _joined(parts: list[pa.Array]) -> pa.Array:
    return parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", parts[0].type))


def _has(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    slot = key % np.uint64(len(bitmap) * 64)
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def ngrams(table: pa.Table, size: int, bitmap: np.ndarray | None) -> pa.Table:
    """Weighted counts of the n-grams of ``size`` words of dictionary rows, of
    those whose shorter parts the bitmap holds; with ``size`` 1 also all words
    of each language, under a NULL phrase."""
    text = table["chunk"].combine_chunks().cast(pa.large_string())
    lists = pc.split_pattern(text, " ")
    row, flat = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False), pc.list_flatten(lists)
    weight = table["n"].to_numpy()
    count = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)
    counted = place >= np.where(table["opens"].to_numpy(zero_copy_only=False), 0, _OVERLAP)[row]
    coded = flat.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    langs = table["lang"].combine_chunks().dictionary_encode()
    lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row]
    last = np.flatnonzero(counted & (place >= size - 1))
    if bitmap is not None:
        h, lang_hash = _hashes(flat), _hashes(langs.dictionary)[lang]
        part = h if size == 2 else _mixed(h[:-1], h[1:])       # keys of the n-grams that begin at each word
        back = size - 1
        for shift in (back, back - 1):
            last = last[_has(bitmap, _mixed(lang_hash[last], part[last - shift]))]
    # One code per distinct n-gram with its language.
    name = lang[last]
    for k in range(size):
        name = pd.factorize(name * np.int64(len(code) + 1) + code[last - size + 1 + k])[0].astype(np.int64)
    first = np.flatnonzero(~pd.Series(name).duplicated().to_numpy())
    total = np.bincount(name, weight[row[last]], minlength=len(first)).astype(np.int64)  # exact below 2**53
    spelt = [flat.take(pa.array(last[first] - size + 1 + k)) for k in range(size)]
    out = {"lang": langs.dictionary.take(pa.array(lang[last[first]])), "phrase": _joined(spelt).cast(pa.string()), "n": pa.array(total)}
    made = pa.table(out)
    if size == 1:
        whole = np.bincount(lang[counted], weight[row[counted]], minlength=len(langs.dictionary)).astype(np.int64)
        made = pa.concat_tables([made, pa.table({"lang": langs.dictionary, "phrase": pa.nulls(len(whole), pa.string()), "n": pa.array(whole)})])
    return made


def _counter(size: int, bitmap: np.ndarray | None):
    def run(batches):
        held, bytes_held = [], 0
        for batch in batches:
            held.append(batch)
            bytes_held += batch.nbytes
            if bytes_held >= _COUNTED:
                yield from ngrams(pa.Table.from_batches(held), size, bitmap).combine_chunks().to_batches()
                held, bytes_held = [], 0
        if held:
            yield from ngrams(pa.Table.from_batches(held), size, bitmap).combine_chunks().to_batches()
    return run


def _bits(size: int, bits: int):
    def run(batches):
        bitmap = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            lists = pc.split_pattern(batch.column("phrase").cast(pa.large_string()), " ")
            h = _hashes(pc.list_flatten(lists)).reshape(-1, size)
            key = _mixed(_hashes(batch.column("lang")), h[:, 0] if size == 1 else _mixed(h[:, 0], h[:, 1]))
            slot = key % np.uint64(bits)
            np.bitwise_or.at(bitmap, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
        some = np.flatnonzero(bitmap)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(bitmap[some].view(np.int64))], names=["at", "bits"])
    return run


def _bitmap(grams: DataFrame, size: int, bits: int) -> np.ndarray:
    """Hashed bits of frequent n-grams: at most ``bits / 64`` rows reach the driver."""
    rows = grams.mapInArrow(_bits(size, bits), "at long, bits long").groupBy("at").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return out


def frequent_ngrams(dictionary: DataFrame, at_least: int = AT_LEAST, bits: int = BITMAP_BITS) -> tuple[DataFrame, DataFrame]:
    """``lang, size, phrase, n`` of every n-gram of 1 to 3 words that occurs at
    least ``at_least`` times, and ``lang, n``, all words of each language."""
    found, bitmap, totals = None, None, None
    for size in range(1, LONGEST + 1):
        counts = (dictionary.mapInArrow(_counter(size, bitmap), "lang string, phrase string, n long")
                  .groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(f"n >= {at_least} OR phrase IS NULL"))
        counts = saved(counts, f"{size}-grams")
        if size == 1:
            totals = counts.filter("phrase IS NULL").select("lang", "n")
        grams = counts.filter("phrase IS NOT NULL")
        if size < LONGEST:
            bitmap = _bitmap(grams, size, bits)
        tagged = grams.select("lang", F.lit(size).alias("size"), "phrase", "n")
        found = tagged if found is None else found.unionByName(tagged)
    return found, totals


# --- scores ---------------------------------------------------------------------

def _exact(c):
    return F.col(c).cast("decimal(19,0)")


def scored(grams: DataFrame) -> DataFrame:
    """``lang, size, phrase, a, l, r, score`` of every phrase of two words or more,
    by its lowest-scoring cut."""
    w = F.split("phrase", " ")
    cut = [F.struct(F.lit(k).alias("k"), F.array_join(F.slice(w, 1, k), " ").alias("left"),
                    F.array_join(F.slice(w, k + 1, LONGEST), " ").alias("right")) for k in range(1, LONGEST)]
    cuts = (grams.filter("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"), F.explode(F.array(*cut)).alias("c"))
            .filter("c.k < size").select("lang", "size", "phrase", "a", "c.k", "c.left", "c.right"))
    left = grams.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = grams.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    both = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    product, parts = F.lit(SCALE).cast("decimal(7,0)") * (_exact("a") * _exact("a")), _exact("l") * _exact("r")
    both = both.select("lang", "size", "phrase", "a", "k", "l", "r", product.alias("product"), parts.alias("parts"))
    best = both.withColumn("score", F.expr("product div parts")).groupBy("lang", "size", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "size", "phrase", "a", "best.l", "best.r", "best.score")


def mostly_inside(phrases: DataFrame, percent: int = INSIDE_PERCENT) -> DataFrame:
    """``lang, phrase`` of two words that stand in a phrase of three with at
    least ``percent`` of their occurrences."""
    w = F.split("phrase", " ")
    inner = F.explode(F.array(*(F.array_join(F.slice(w, i, 2), " ") for i in (1, 2))))
    longer = (phrases.filter("size = 3").select("lang", inner.alias("phrase"), "a").groupBy("lang", "phrase")
              .agg(F.max("a").alias("longer")))
    return phrases.filter("size = 2").join(longer, ["lang", "phrase"]).filter(100 * F.col("longer") >= percent * F.col("a")).select(
        "lang", "phrase")


def mine(docs: DataFrame, top: int = TOP, at_least: int = AT_LEAST, bits: int = BITMAP_BITS) -> DataFrame:
    """Each language's first phrases: ``lang, rank, phrase, a, l, r, n, score``."""
    grams, totals = frequent_ngrams(parse(docs), at_least, bits)
    phrases = saved(scored(grams), "phrases")
    left = phrases.join(mostly_inside(phrases), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    for by in (["lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))], ["lang"]):
        left = left.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= top)
    return left.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
grams AS MATERIALIZED (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM starts, (VALUES (1), (2), (3)) AS sizes(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
keyed AS MATERIALIZED (SELECT lang || chr(9) || phrase AS gram, f FROM grams),
candidates AS (
  SELECT lang, k, phrase, f AS a, cut, lang || chr(9) || array_to_string(string_split(phrase, ' ')[1:cut], ' ') AS l_gram,
         lang || chr(9) || array_to_string(string_split(phrase, ' ')[cut + 1:], ' ') AS r_gram
  FROM grams, (VALUES (1), (2)) AS c(cut) WHERE k > 1 AND f >= 10 AND cut < k),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.cut, lf.f AS l, rt.f AS r,
         (1000000::HUGEINT * c.a * c.a) // (lf.f::HUGEINT * rt.f) AS score
  FROM candidates c JOIN keyed lf ON lf.gram = c.l_gram JOIN keyed rt ON rt.gram = c.r_gram),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_phrases AS (
  SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '),
                       array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase, a AS longer
  FROM best WHERE k = 3),
stays AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM inner_phrases i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.longer >= 50 * b.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM stays)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
