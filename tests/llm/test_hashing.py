"""Words, their hashes and what is joined from them, against plain Python."""

import random

import numpy as np
import pytest

from visitlens.llm import hashing


def row_of(texts):
    data = np.frombuffer(b"".join(texts), np.uint8)
    return data, np.cumsum([0, *map(len, texts)])


@pytest.mark.parametrize("piece", [1, 7, 1 << 22])
def test_words_and_joined_words(monkeypatch, piece):
    monkeypatch.setattr(hashing, "_PIECE", piece)
    rng = random.Random(1)
    hashes = {}
    for _ in range(60):
        texts = ["".join(rng.choice("abé \t\n") for _ in range(rng.randrange(30))).encode() for _ in range(rng.randrange(1, 6))]
        data, starts = row_of(texts)
        first, end, found, counts = hashing.words(data, starts)
        listed = [w for text in texts for w in text.split()]
        assert [data[a:b].tobytes() for a, b in zip(first, end)] == listed
        assert np.diff(counts).tolist() == [len(text.split()) for text in texts]
        for word, value in zip(listed, found.tolist()):
            assert hashes.setdefault(word, value) == value
        kept = np.array([rng.random() < 0.6 for _ in listed], bool)
        it = iter(kept)
        wanted = [b" ".join([w for w in text.split() if next(it)]) for text in texts]
        assert hashing.joined_words(data, first, end, kept, counts).to_pylist() == wanted
    assert len(set(hashes.values())) == len(hashes)
