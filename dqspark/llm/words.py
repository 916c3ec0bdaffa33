"""Words of Arrow text columns, found byte by byte in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = b" \t\n\x0b\f\r"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
"""Each byte, A to Z in lower case."""


def byte_classes(**classes: bytes) -> np.ndarray:
    """Class of each byte: 0 for those of words, 1, 2, ... for the given sets."""
    out = np.zeros(256, np.uint8)
    for i, chars in enumerate(classes.values(), 1):
        out[list(chars)] = i
    return out


@dataclass(frozen=True)
class Words:
    text: pa.Array           # every word, in order
    doc: np.ndarray          # the row it comes from
    start: np.ndarray        # its first byte among all bytes
    data: np.ndarray         # all bytes of the texts, and their classes
    kind: np.ndarray
    bounds: np.ndarray       # where each row's bytes start, and the end

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many of each row's bytes are flagged."""
        return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[self.bounds])

    def count(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=len(self.bounds) - 1)


def words(texts: pa.Array, classes: np.ndarray, lower: bool = False) -> Words:
    """Runs of class 0 bytes of each text; NULL counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[bounds[0]:bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    if lower:
        data = LOWER[data]
    kind = classes[data]
    inside = kind == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = bounds[:-1][np.diff(bounds) > 0]
    first[heads] = inside[heads]
    start = np.flatnonzero(first)
    at = np.append(np.cumsum(inside)[start] - 1, np.count_nonzero(inside)).astype(np.int64)
    text = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(at), pa.py_buffer(data[inside]))
    return Words(text, np.searchsorted(bounds, start, "right") - 1, start, data, kind, bounds)
