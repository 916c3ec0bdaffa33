"""Raw id shards with a minimal perfect hash index (operator 7).

File format. ``shards/part-<n>-<attempt>.bin``: 8 bytes ``IDS1`` + id width
(2 or 4) + three zero bytes, then the little-endian ids of the shard's
documents, in ascending ``doc_id`` order within and across shards, each
document followed by the end id. Two bytes an id when the vocabulary allows.

The index maps a key ``(doc_id, ordinal)`` to a shard and offset. ``ordinal``
counts the rows that share a ``doc_id`` (0 unless ids repeat). Keys are dealt
into buckets of about 2,000 by one hash; each bucket holds a minimal perfect
hash (hash and displace): a displacement per small group of keys, found
largest group first, and slot arrays of 32-bit fingerprints, shard numbers,
offsets and lengths. A lookup reads one displacement and one slot; a key
that was never stored fails the fingerprint (up to 2**-32) and the payload's
key list is never searched.

Lost executors: a shard's file name holds a random attempt name, files are
closed before their rows are committed, and the manifest (a Parquet table,
committed task by task) names the files that count; leftovers of failed
attempts are never read.

Defined cases: NULL text counts as empty (only the end id); NULL ``doc_id``
sorts first and is a key of its own; repeated ``doc_id`` rows are all kept,
with ordinals in file order; an empty table gives no shard and no row; extra
columns are ignored; texts are never cut.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import new_dir, open_fs, saved, scan_partitions, text_slices
from .tokens import encoder, vocabulary_path

END_ID = 0
HEADER = 8
KEYS_PER_BUCKET = 2000
KEYS_PER_GROUP = 4


@dataclass(frozen=True)
class TokenStore:
    root: str
    manifest: DataFrame  # doc_id, ordinal, shard, file, at (ids before it in its shard), n_tokens, start
    index: DataFrame     # bucket, n_keys, displacement, fingerprint, slot_* (binary arrays)
    buckets: int


# --- writing -----------------------------------------------------------------

MANIFEST = "doc_id long, shard int, file string, at long, n_tokens long"


def _shard_writer(root: str, path: str, width: int):
    def write(batches):
        shard = TaskContext.get().partitionId()
        name = f"part-{shard:06d}-{uuid.uuid4().hex}.bin"
        filesystem, base = open_fs(root)
        out, at = None, 0
        enc = encoder(path)
        for batch in batches:
            for a, b in text_slices(batch):
                part = batch.slice(a, b - a)
                ids, bounds = enc.encode_batch(part.column("text"))
                n = np.diff(bounds) + 1
                ends = np.cumsum(n)
                payload = np.full(int(ends[-1]), END_ID, f"<u{width}")
                keep = np.ones(len(payload), bool)
                keep[ends - 1] = False
                payload[keep] = ids
                if out is None:
                    filesystem.create_dir(base, recursive=True)
                    out = filesystem.open_output_stream(f"{base}/{name}")
                    out.write(b"IDS1" + bytes([width, 0, 0, 0]))
                out.write(payload.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.full(b - a, shard, np.int32)), pa.array([name] * (b - a)),
                     pa.array(at + ends - n), pa.array(n)], names=["doc_id", "shard", "file", "at", "n_tokens"])
                at += int(ends[-1])
        if out is not None:
            out.close()
    return write


def write_store(docs: DataFrame, vocabulary: str | None = None) -> TokenStore:
    """Encode ``docs`` (doc_id, text) into shards and index them."""
    spark = docs.sparkSession
    path = vocabulary or vocabulary_path()
    width = 2 if encoder(path).size <= 1 << 16 else 4
    root = new_dir(spark, "token-store")
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .repartitionByRange(scan_partitions(docs), F.col("doc_id").asc_nulls_first())
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first()))
    written = saved(rows.mapInArrow(_shard_writer(f"{root}/shards", path, width), MANIFEST), "manifest")
    # Ids before each shard: one row per shard, summed in shard order.
    sizes = written.groupBy("shard").agg(F.sum("n_tokens").alias("shard_tokens"))
    bases = sizes.select("shard", (F.sum("shard_tokens").over(W.orderBy("shard")) - F.col("shard_tokens")).alias("base"))
    order = W.partitionBy("doc_id").orderBy("shard", "at")
    manifest = (written.join(bases, "shard")
                .withColumn("ordinal", (F.row_number().over(order) - 1).cast("int"))
                .select("doc_id", "ordinal", "shard", "file", "at", "n_tokens",
                        (F.col("base") + F.col("at")).alias("start")))
    n = written.count()
    buckets = max(1, -(-n // KEYS_PER_BUCKET))
    return TokenStore(root, manifest, saved(_index(manifest, buckets), "mph-index"), buckets)


# --- the index ----------------------------------------------------------------

def key_hash(doc_id, ordinal, seed: int):
    """64-bit hash of a key; NULL ids differ from every number."""
    return F.xxhash64(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")), ordinal)


def _keyed(df: DataFrame, buckets: int) -> DataFrame:
    h = key_hash(F.col("doc_id"), F.col("ordinal"), 1)
    return df.select("*", F.pmod(h, F.lit(buckets)).cast("int").alias("bucket"),
                     key_hash(F.col("doc_id"), F.col("ordinal"), 2).alias("key"))


def _mix(key: np.ndarray, seed) -> np.ndarray:
    """splitmix64 finaliser of ``key`` under a displacement."""
    with np.errstate(over="ignore"):
        x = key + (np.asarray(seed, np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _group_of(key: np.ndarray, groups: int) -> np.ndarray:
    return ((key >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)


def build_mph(key: np.ndarray) -> np.ndarray:
    """Displacements (int32) of a minimal perfect hash over distinct keys.

    A group's displacement d >= 0 puts its keys at ``mix(key, d) % n``; a
    group with one key may store ``-slot - 1`` instead. Groups are placed
    largest first; displacements are tried 64 at a time.
    """
    n = len(key)
    groups = max(1, -(-n // KEYS_PER_GROUP))
    group = _group_of(key, groups)
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group, minlength=groups)
    first = np.cumsum(sizes) - sizes
    out, free = np.zeros(groups, np.int32), np.ones(n, bool)
    for g in np.argsort(-sizes, kind="stable"):
        if sizes[g] == 0:
            break
        mine = key[order[first[g]:first[g] + sizes[g]]]
        if len(mine) == 1:
            slot = int(np.argmax(free))
            out[g], free[slot] = -slot - 1, False
            continue
        tried = 0
        while True:
            seeds = np.arange(tried, tried + 64, dtype=np.uint64)
            slots = (_mix(mine[None, :], seeds[:, None]) % np.uint64(n)).astype(np.int64)
            ok = free[slots].all(axis=1)
            if len(mine) > 1:
                ranked = np.sort(slots, axis=1)
                ok &= (np.diff(ranked, axis=1) > 0).all(axis=1)
            if ok.any():
                k = int(np.argmax(ok))
                out[g] = tried + k
                free[slots[k]] = False
                break
            tried += 64
    return out


def mph_slots(key: np.ndarray, displacement: np.ndarray, n: int) -> np.ndarray:
    d = displacement[_group_of(key, len(displacement))]
    hashed = (_mix(key, np.maximum(d, 0).astype(np.uint64)) % np.uint64(n)).astype(np.int64)
    return np.where(d < 0, -d.astype(np.int64) - 1, hashed)


def fingerprint(key: np.ndarray) -> np.ndarray:
    return (_mix(key, 0xF1F1F1F1) >> np.uint64(32)).astype(np.uint32)


INDEX = ("bucket int, n_keys int, displacement binary, fingerprint binary, slot_shard binary, slot_at binary, "
         "slot_tokens binary, slot_start binary")
_SLOTS = [("slot_shard", "shard", "<i4"), ("slot_at", "at", "<i8"), ("slot_tokens", "n_tokens", "<i8"),
          ("slot_start", "start", "<i8")]


def _index_bucket(key, table):
    keys = table.column("key").to_numpy().astype(np.uint64)
    n = len(keys)
    displacement = build_mph(keys)
    slot = mph_slots(keys, displacement, n)
    put = np.empty(n, np.int64)
    put[slot] = np.arange(n)
    row = {"bucket": [key[0].as_py()], "n_keys": [n], "displacement": [displacement.astype("<i4").tobytes()],
           "fingerprint": [fingerprint(keys)[put].astype("<u4").tobytes()]}
    for name, source, kind in _SLOTS:
        row[name] = [table.column(source).to_numpy()[put].astype(kind).tobytes()]
    return pa.table(row, schema=pa.schema([("bucket", pa.int32()), ("n_keys", pa.int32()),
                                           *[(c, pa.binary()) for c in ("displacement", "fingerprint")],
                                           *[(c, pa.binary()) for c, _, _ in _SLOTS]]))


def _index(manifest: DataFrame, buckets: int) -> DataFrame:
    keyed = _keyed(manifest, buckets).select("bucket", "key", "shard", "at", "n_tokens", "start")
    return keyed.groupBy("bucket").applyInArrow(_index_bucket, INDEX)


# --- reading ------------------------------------------------------------------

FOUND = "doc_id long, ordinal int, shard int, at long, n_tokens long, start long"


def _lookup(key, asked, index):
    schema = pa.schema([("doc_id", pa.int64()), ("ordinal", pa.int32()), ("shard", pa.int32()), ("at", pa.int64()),
                        ("n_tokens", pa.int64()), ("start", pa.int64())])
    if not len(index) or not len(asked):
        return schema.empty_table()
    row = index.to_pylist()[0]
    keys = asked.column("key").to_numpy().astype(np.uint64)
    slot = mph_slots(keys, np.frombuffer(row["displacement"], "<i4"), row["n_keys"])
    hit = np.frombuffer(row["fingerprint"], "<u4")[slot] == fingerprint(keys)
    take = slot[hit]
    return pa.Table.from_arrays(
        [asked.column("doc_id").filter(pa.array(hit)), asked.column("ordinal").filter(pa.array(hit)),
         *[pa.array(np.frombuffer(row[name], kind)[take]) for name, _, kind in _SLOTS]], schema=schema)


def locate(store: TokenStore, keys: DataFrame) -> DataFrame:
    """Where each stored key of ``keys`` (doc_id, ordinal) lies."""
    asked = _keyed(keys.select("doc_id", "ordinal"), store.buckets)
    return asked.groupBy("bucket").cogroup(store.index.groupBy("bucket")).applyInArrow(_lookup, FOUND)


def _payload_reader(root: str):
    def read(batches):
        filesystem, base = open_fs(root)
        name, file, width = None, None, 0
        for batch in batches:
            payload = []
            for wanted, at, n in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "n_tokens"))):
                if wanted != name:
                    if file is not None:
                        file.close()
                    name, file = wanted, filesystem.open_input_file(f"{base}/{wanted}")
                    head = file.read_at(HEADER, 0)
                    if head[:4] != b"IDS1":
                        raise ValueError(f"{wanted} is no id shard")
                    width = head[4]
                raw = file.read_at(n * width, HEADER + at * width)
                if len(raw) != n * width:
                    raise ValueError(f"{wanted} ends before id {at + n}")
                payload.append(raw if width == 4 else np.frombuffer(raw, f"<u{width}").astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ordinal"), batch.column("start"), pa.array(payload, pa.binary())],
                names=["doc_id", "ordinal", "start", "ids"])
        if file is not None:
            file.close()
    return read


def read_ids(store: TokenStore, keys: DataFrame) -> DataFrame:
    """``doc_id, ordinal, start, ids`` (little-endian uint32 bytes, end id
    included) of the stored keys among ``keys``, read from the shards."""
    files = store.manifest.select("shard", "file").distinct()
    found = locate(store, keys).join(files, "shard")
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (found.repartitionByRange(n, "shard", "at").sortWithinPartitions("shard", "at")
            .mapInArrow(_payload_reader(f"{store.root}/shards"), "doc_id long, ordinal int, start long, ids binary"))


def all_keys(docs: DataFrame) -> DataFrame:
    """Every row's key: its id and which of the rows with that id it is."""
    order = W.partitionBy("doc_id").orderBy(F.lit(0))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"))
            .select("doc_id", (F.row_number().over(order) - 1).cast("int").alias("ordinal")))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, from the files read back: ids before it, its token count
    and the crc32 of its ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    store = write_store(docs)
    ids = read_ids(store, all_keys(docs))
    return ids.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.crc32("ids").alias("ids_crc32"))
