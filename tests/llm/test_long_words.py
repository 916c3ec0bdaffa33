"""Operators 1 and 3 on very long unbroken strings."""

from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from dqspark.llm import lm_lattice, sp_codec


@pytest.fixture(scope="module")
def pieces():
    return lm_lattice.pieces_of(lm_lattice.default_vocabulary())


def test_long_words_equal_the_batched_lattice(pieces, monkeypatch):
    rng = random.Random(1)
    words = pa.array(["".join(rng.choices("the日本é▁x" + chr(0x1F600) + "andor", k=n)) for n in (1, 2, 17, 60, 61, 150)])
    logp, weight = np.log(pieces.first), np.arange(1.0, 7.0)
    whole = lm_lattice.word_log_probability(words, pieces, logp), lm_lattice.expected_counts(words, weight, pieces, logp)
    monkeypatch.setattr(lm_lattice, "LONG", 10)
    assert np.allclose(lm_lattice.word_log_probability(words, pieces, logp), whole[0], rtol=1e-12)
    assert np.allclose(lm_lattice.expected_counts(words, weight, pieces, logp), whole[1], rtol=1e-9, atol=1e-12)


def test_a_word_of_100_000_characters_takes_seconds(pieces):
    word = pa.array(["".join(random.Random(2).choices("abcdefghij", k=100_000))])
    begin = time.process_time()
    lp = lm_lattice.word_log_probability(word, pieces, np.log(pieces.first))
    lm_lattice.expected_counts(word, np.ones(1), pieces, np.log(pieces.first))
    assert time.process_time() - begin < 20 and np.isfinite(lp).all()


def test_long_words_are_encoded_but_not_remembered():
    codec = sp_codec.Codec(lm_lattice.default_vocabulary())
    long = "".join(random.Random(3).choices("abcdef", k=5000))
    texts = ["short " + long, long, long + " short"]
    ids = codec.encode_batch(pa.array(texts))
    assert [codec.decode(x) for x in ids] == texts
    assert "short" in codec.words and max(map(len, codec.words)) < 70
