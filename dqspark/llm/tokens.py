"""Whole-text encoding with a byte-level BPE file of the tokenizers library.

The file's tokens, as bytes, are handed to tiktoken as merge ranks: in a
vocabulary whose ids follow the order of its merges, both libraries give the
same ids (the tests compare them, over every code point too) and tiktoken
takes a third of the time. Any other file is read by the tokenizers library
itself. Texts longer than ``limit`` are encoded piece by piece, cut at a
single space between two non-white characters: the vocabulary's splitter
starts a new unit there whatever stands around it.
"""

from __future__ import annotations

import json
import re

import numpy as np
import public_tokenizers
import pyarrow as pa

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
SAFE_SPACE = re.compile(r"(?<=[^\s\u2581]) (?=[^\s\u2581])")


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable
    bytes stand as themselves, the others from 256 on."""
    out, spare = {}, 256
    for b in range(256):
        if 33 <= b < 127 or 161 <= b < 173 or b >= 174:
            out[chr(b)] = b
        else:
            out[chr(spare)], spare = b, spare + 1
    return out


def cut_long(text: str, limit: int) -> list[str]:
    """``text`` without the safe spaces at which it is cut, about every
    ``limit`` characters."""
    out, at = [], 0
    while len(text) - at > limit:
        m = SAFE_SPACE.search(text, at + limit)
        if m is None:
            break
        out.append(text[at:m.start()])
        at = m.end()
    return [*out, text[at:]]


class BatchEncoder:
    """Ids equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``;
    with ``specials=False`` special tokens' strings are plain text."""

    def __init__(self, path: str, limit: int = 1_000_000, specials: bool = True):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, added = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        self.limit, self.special = limit, list(added)
        self.token_bytes: dict[int, bytes] = {
            i: t.encode() if t in added else bytes(alphabet[c] for c in t) for t, i in (vocab | added).items()}
        self.size = max(self.token_bytes) + 1
        ranks = {self.token_bytes[i]: i for t, i in vocab.items() if t not in added}
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        splitter = spec["pre_tokenizer"]
        if (merged == sorted(merged) and len(ranks) == len(merged) + 256 and spec["normalizer"] is None
                and splitter["type"] == "ByteLevel" and not splitter["add_prefix_space"] and splitter["use_regex"]):
            import tiktoken

            enc = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
            allowed = "all" if specials else set()
            self._ids = lambda text: enc.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            tok.encode_special_tokens = not specials
            self._ids = lambda text: np.array(tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def _text(self, text: str) -> list[np.ndarray]:
        if len(text) <= self.limit or any(s in text for s in self.special):
            return [self._ids(text)] if text else []
        first, *rest = cut_long(text, self.limit)
        return [self._ids(first), *(self._ids(" " + part) for part in rest)]

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) and, per text, where its ids start; one more at the end.
        NULL counts as empty."""
        out, bounds = [], np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts.to_pylist()):
            parts = self._text(text or "")
            out += parts
            bounds[i + 1] = sum(map(len, parts))
        return np.concatenate([np.zeros(0, np.uint32), *out]), np.cumsum(bounds)


_ENCODERS: dict[tuple[str, bool], BatchEncoder] = {}


def encoder(path: str, specials: bool = True) -> BatchEncoder:
    """The worker process's encoder of a vocabulary file."""
    if (path, specials) not in _ENCODERS:
        _ENCODERS[path, specials] = BatchEncoder(path, specials=specials)
    return _ENCODERS[path, specials]
