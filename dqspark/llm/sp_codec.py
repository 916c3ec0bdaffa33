"""SentencePiece encoding and decoding by a shared-prefix Viterbi (operator 3).

A text is split at its spaces; each word keeps the space before it as its mark
(the first word has one too, as the vocabulary's pieces expect). A word's
pieces are those of the highest total score, by the scores of the vocabulary
file, among all ways to cut it into pieces; a character without a piece of its
own is written with byte pieces at a score below every piece's. Ties take the
longer last piece.

Distinct words of a batch that were not met before are sorted, which is a walk
through their trie depth first: the forward scores of the prefix a word shares
with the one before it are kept, and only the new characters are scored.

Decoding joins the pieces' bytes and takes the first mark away; a text comes
back byte for byte.

Defined cases: NULL and empty texts have no piece and decode to the empty
text; several spaces in a row are words of a mark alone; a literal mark
character is written in bytes, so it is not mistaken for a space; repeated rows
are encoded each; words of any length are encoded whole; an empty table gives
no row; extra columns are ignored.
"""

from __future__ import annotations

from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_slices

MARK = "▁"
REMEMBERED = 600_000
LONGEST_KEPT = 64


def default_vocabulary() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


class Codec:
    """Viterbi pieces of words, and the bytes of pieces."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes_of: list[bytes] = []
        self.byte_id = {}
        for i in range(sp.get_piece_size()):
            piece, raw = sp.id_to_piece(i), b""
            if sp.is_byte(i):
                raw = bytes([int(piece[3:5], 16)])
                self.byte_id[raw[0]] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                text = piece.replace(MARK, " ")
                raw = text.encode()
                self.pieces[text] = i, sp.get_score(i)
            self.bytes_of.append(raw)
        # Pieces from their last character on: a walk ends where no piece goes on.
        self.backward: dict = {}
        for text, found in self.pieces.items():
            node = self.backward
            for ch in reversed(text):
                node = node.setdefault(ch, {})
            node[""] = found
        self.unknown = min(s for _, s in self.pieces.values()) - 10
        self.words: dict[str, bytes] = {}

    def viterbi(self, words: list[str]):
        """``(word, ids as uint32 bytes)`` of sorted distinct words."""
        pieces, backward, last = self.pieces, self.backward, ""
        best, back, ident = [0.0], [0], [0]  # by end position in the current word
        for word in words:
            common, most = 0, min(len(word), len(last))
            while common < most and word[common] == last[common]:
                common += 1
            del best[common + 1:], back[common + 1:], ident[common + 1:]
            for end in range(common + 1, len(word) + 1):
                top, start, piece = float("-inf"), end - 1, -1
                # Shortest piece first, up to the longest that ends here; of equal sums the longest piece's stays.
                node, begin = backward, end
                while begin:
                    begin -= 1
                    node = node.get(word[begin])
                    if node is None:
                        break
                    found = node.get("")
                    if found is not None and best[begin] + found[1] >= top:
                        top, start, piece = best[begin] + found[1], begin, found[0]
                if word[end - 1] not in pieces and best[end - 1] + self.unknown > top:
                    top, start, piece = best[end - 1] + self.unknown, end - 1, -1
                best.append(top), back.append(start), ident.append(piece)
            ids, end = [], len(word)
            while end:
                start = back[end]
                if ident[end] < 0:
                    ids.extend(self.byte_id[b] for b in reversed(word[start:end].encode()))
                else:
                    ids.append(ident[end])
                end = start
            ids.reverse()
            yield word, array("I", ids).tobytes()
            last = word

    def encode_batch(self, texts: pa.Array) -> list[bytes]:
        """Little-endian uint32 ids of each text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lists = pc.split_pattern(texts, " ")
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        coded = pc.list_flatten(lists).dictionary_encode()
        words = coded.dictionary.to_pylist()
        known = self.words
        new = sorted(" " + w for w in words if w not in known)
        if len(known) + len(new) > REMEMBERED:  # forgetting changes speed only
            known = self.words = {}
            new = sorted(" " + w for w in words)
        once: dict[str, bytes] = {}      # long words are not remembered: what is kept stays small in bytes too
        for word, ids in self.viterbi(new):
            (known if len(word) <= LONGEST_KEPT else once)[word[1:]] = ids
        table = [once[w] if w in once else known[w] for w in words]
        which, out, at = coded.indices.to_pylist(), [], 0
        empty = pc.equal(texts, "").to_pylist()
        for n, nothing in zip(sizes.tolist(), empty):
            out.append(b"" if nothing else b"".join([table[i] for i in which[at:at + n]]))
            at += n
        return out

    def decode(self, ids: bytes) -> str:
        raw = self.bytes_of
        return b"".join([raw[i] for i in np.frombuffer(ids, "<u4").tolist()])[1:].decode()


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _encode(path: str):
    def run(batches):
        c = codec(path)
        for batch in batches:
            for a, b in text_slices(batch):
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(c.encode_batch(rows.column("text")), pa.binary())], names=["doc_id", "ids"])
    return run


def _decode(path: str, column: str):
    def run(batches):
        c = codec(path)
        for batch in batches:
            for a, b in text_slices(batch, column):
                rows = batch.slice(a, b - a)
                texts = [c.decode(x) if x is not None else None for x in rows.column(column).to_pylist()]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column(column), pa.array(texts, pa.string())],
                                                 names=["doc_id", column, "decoded"])
    return run


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids`` (uint32 bytes) of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_encode(vocabulary or default_vocabulary()), "doc_id long, ids binary")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded`` of ``encoded`` (doc_id, ids)."""
    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(_decode(vocabulary or default_vocabulary(), "ids"), "doc_id long, ids binary, decoded string")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its number of pieces, the crc32 of its ids, and length and
    sha256 of the text decoded from them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return decode(encode(docs)).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"),
        F.length("decoded").cast("long").alias("decoded_chars"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
