"""Secret scans with dictionary-primed zstandard novelty (operator 9).

Base kinds are patterns. Further candidates are strings of key characters
near a word that announces a secret, name and value of ``name=value`` each by
itself; plain numbers are none, and strings with
fewer than two digits are none if they are made of words (``WORDY``). A
candidate is reported when it is incompressible where it stands: with a zstandard dictionary made of the
corpus's identifiers and the code around the candidate, the bytes it adds to
the compressed context are at least ``NOVELTY`` of its length.

The identifiers are counted over the contexts of all candidates of all
documents, and the ``IDENTIFIERS`` most frequent ones (by documents) make the
dictionary, commonest last, as zstandard reaches the end cheapest. Texts are
read once: spans, candidates and contexts are written, then judged.

Defined cases: NULL and empty texts have no span (the empty string's sha256);
offsets are code points, ends exclusive; repeated rows are scanned each; whole
texts of any length are scanned; an empty table gives no row; extra columns
are ignored by ``scan`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, text_slices, tidy

# The base kinds, in their order.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Words that announce a secret, and the strings they may announce.
SENSITIVE = ("key", "secret", "token", "passw", "credential", "auth", "bearer", "signature", "private")
LEAST = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
_INNER = re.compile(r"=+(?=[A-Za-z0-9+/_-])")
REACH = 48
"""Characters from the end of a sensitive word in which a candidate must start."""
CONTEXT = 512
NOVELTY = 0.7
IDENTIFIERS = 2000
WORDY = 2.7
"""Letters a vocabulary piece from which a digit-poor string is words: of 20,000
random ones of 16 to 40 characters none had more than 2.67, of 30 names and
words (among them made-up words of the test data) none fewer than 3.0."""
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{2,31}")


def base_spans(text: str, lower: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the base kinds, unordered."""
    out = []
    if any(h in lower for h in _ASSIGN_HINTS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


_RUN = re.compile("[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[A-Z]|[0-9]")
_VOCABULARY: dict[str, int] = {}  # lower-case pieces, and the longest's length under ""


def _vocabulary() -> dict[str, int]:
    if not _VOCABULARY:
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        pieces = {sp.id_to_piece(i).strip("▁").lower() for i in range(sp.get_piece_size())}
        found = {x: len(x) for x in pieces if x.isascii() and x.isalpha()}
        _VOCABULARY.update(found | {"": max(found.values())})
    return _VOCABULARY


def letters_a_piece(s: str) -> float:
    """Letters and digits for each piece of the cheapest cut into vocabulary
    pieces; changes of case and marks cut too."""
    vocabulary, letters, pieces = _vocabulary(), 0, 0
    for run in _RUN.findall(s):
        run, fewest = run.lower(), [0]
        for j in range(1, len(run) + 1):
            fewest.append(min(fewest[i] + 1 for i in range(max(0, j - vocabulary[""]), j) if j - i == 1 or run[i:j] in vocabulary))
        letters, pieces = letters + len(run), pieces + fewest[-1]
    return letters / max(1, pieces)


def may_be_key(s: str) -> bool:
    """Neither a number nor, with fewer than two digits, words."""
    return any(c.isalpha() for c in s) and (sum(c.isdigit() for c in s) >= 2 or letters_a_piece(s) < WORDY)


def candidates(text: str, lower: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Spans near a sensitive word that no base span touches."""
    out, at = [], 0
    hints = sorted({m.span() for w in SENSITIVE if w in lower for m in re.finditer(w, lower)})
    for h, stop in hints:
        begin = max(h, at)
        while begin > at and _key_char(text[begin - 1]):
            begin -= 1
        # A string may start up to REACH after the word; its end is not bounded.
        while begin <= stop + REACH and (m := CANDIDATE.search(text, begin, stop + REACH + LEAST)):
            start, at = m.start(), CANDIDATE.match(text, m.start()).end()
            out += [(s, e) for s, e in values(text, start, at)
                    if may_be_key(text[s:e]) and not any(a < e and s < b for a, b, _ in taken)]
            begin = at
    return out


def values(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """The string, or the sides of its first inner ``=`` (a name and its value)
    that are long enough; whole if the value is not."""
    sign = _INNER.search(text, start + 1, end)
    if not sign or end - sign.end() < LEAST:
        return [(start, end)]
    return [(s, e) for s, e in ((start, sign.start()), (sign.end(), end)) if e - s >= LEAST]


def _key_char(c: str) -> bool:
    return c.isascii() and (c.isalnum() or c in "+/_=-")


FOUND = "doc_id long, base array<struct<s:int,e:int,kind:string>>, near array<struct<s:int,e:int,before:string,word:string>>"
_FOUND = pa.schema([
    ("doc_id", pa.int64()),
    ("base", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("kind", pa.string())]))),
    ("near", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("before", pa.string()), ("word", pa.string())])))])


def find(text: str):
    lower = text.lower()
    if len(lower) != len(text):  # a few letters change length; then offsets need ASCII lower case
        lower = text.translate({c: c + 32 for c in range(65, 91)})
    base = sorted(base_spans(text, lower), key=lambda x: (x[0], KINDS.index(x[2])))
    near = [(s, e, text[max(0, s - CONTEXT):s], text[s:e]) for s, e in candidates(text, lower, base)]
    return base, near


def _find(batches):
    for batch in batches:
        for a, b in text_slices(batch):
            rows = batch.slice(a, b - a)
            found = [find(t or "") for t in rows.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([[dict(zip("se", x[:2]), kind=x[2]) for x in f[0]] for f in found], _FOUND[1].type),
                 pa.array([[dict(zip(("s", "e", "before", "word"), x)) for x in f[1]] for f in found], _FOUND[2].type)],
                schema=_FOUND)


class Novelty:
    """Marginal compressed bytes of a string after its context."""

    def __init__(self, identifiers: str):
        self.identifiers = identifiers.encode()

    def share(self, before: str, word: str) -> float:
        import zstandard

        # The surrounding text stands last in the dictionary, nearest to the string.
        primed = zstandard.ZstdCompressionDict(self.identifiers + b" " + before.encode(),
                                               dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        press = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False, write_checksum=False,
                                         write_dict_id=False)
        raw = word.encode()
        return (len(press.compress(raw)) - len(press.compress(b""))) / len(raw)


SCANNED = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _listed(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]))))


def judge(base, near, novelty: Novelty):
    """All spans of one text, the base ones first kept as they are."""
    return base + [(s, e, "novel") for s, e, before, word in near if novelty.share(before, word) >= NOVELTY]


def _judge(identifiers: str):
    def run(batches):
        novelty = Novelty(identifiers)
        for batch in batches:
            out = {name: [] for name in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for base, near in zip(batch.column("base").to_pylist(), batch.column("near").to_pylist()):
                base = [(x["s"], x["e"], x["kind"]) for x in base]
                near = [(x["s"], x["e"], x["before"], x["word"]) for x in near]
                for kind in KINDS[:3]:
                    out[f"n_{kind}"].append(sum(x[2] == kind for x in base))
                out["base_sha256"].append(hashlib.sha256(_listed(base).encode()).hexdigest())
                out["spans"].append(_listed(judge(base, near, novelty)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(out[f"n_{k}"], pa.int64()) for k in KINDS[:3]],
                 pa.array(out["base_sha256"]), pa.array(out["spans"])],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return run


def identifier_dictionary(found: DataFrame) -> str:
    """The most frequent identifiers around candidates, commonest last."""
    words = (found.filter(F.size("near") > 0)
             .select(F.explode(F.array_distinct(F.flatten(F.transform("near", lambda x: F.regexp_extract_all(
                 x["before"], F.lit(f"({_IDENTIFIER.pattern})"), F.lit(1)))))).alias("word")))
    top = (words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
           .orderBy(F.desc("n"), "word").limit(IDENTIFIERS).collect())
    return " ".join(r.word for r in reversed(top))


def scan(docs: DataFrame) -> DataFrame:
    """Counts and spans of every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = saved(rows.mapInArrow(tidy(_find), FOUND), "secret-candidates")
    return found.mapInArrow(_judge(identifier_dictionary(found)), SCANNED)


def _redact(identifiers: str, columns: list[str], lengths: str | None, mask: str):
    def run(batches):
        novelty = Novelty(identifiers)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, text in enumerate(texts):
                if text:
                    spans = sorted((s, e) for s, e, _ in judge(*find(text), novelty))
                    out, at = [], 0
                    for s, e in spans:
                        if s >= at:
                            out += [text[at:s], mask]
                        at = max(at, e)
                    texts[i] = "".join([*out, text[at:]]) if spans else text
            new = {"text": pa.array(texts, pa.string())}
            if lengths:
                old = batch.column("text").to_pylist()
                new[lengths] = pa.array([n if a == b else len(b) for n, a, b in zip(
                    batch.column(lengths).to_pylist(), old, texts)], batch.schema.field(lengths).type)
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in columns], names=columns)
    return run


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mask`` (and ``n_chars`` of the
    changed rows, where there is such a column); rows without a span are as
    they were."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    identifiers = identifier_dictionary(saved(rows.mapInArrow(tidy(_find), FOUND), "secret-candidates"))
    lengths = "n_chars" if "n_chars" in docs.columns else None
    return docs.mapInArrow(tidy(_redact(identifiers, docs.columns, lengths, mask)), docs.schema)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
