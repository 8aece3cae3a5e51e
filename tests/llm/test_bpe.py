"""Ids against another implementation of the same ranks, and the round trip."""

import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken

from visitlens.llm import bpe

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def other(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    signs = ["a", "b", "'s", "'t", "re", " ", " ", "\n", "\t", "1", "é", "漢", "!", "-", " ", "ing", "The"]
    some = ["".join(rng.choice(signs) for _ in range(rng.randrange(200))) for _ in range(200)]
    return ["", "  a  b \n\n c 's don't", "a" * 5000, "é 漢字 ١٢٣  x y", "<|endoftext|>", " \t x", "xyz" * 60, *some]


@pytest.mark.parametrize("fold", ["tasks", "spark"])
def test_ids_and_round_trip(spark, ranks, other, monkeypatch, fold):
    monkeypatch.setattr(bpe, "HEAP_BYTES", 64)
    monkeypatch.setattr(bpe, "KNOWN_UNITS", 20)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 30)
    monkeypatch.setattr(bpe, "KNOWN_CHARS", 40)
    given = [(i, text, 1) for i, text in enumerate(texts())] + [(-1, None, 2), (0, "", 3)]
    docs = spark.createDataFrame(given, "doc_id long, text string, decoded int")
    found = bpe.decode(bpe.encode(docs, ranks, PATTERN, block_chars=500, fold=fold, spaces_begin=True), ranks).collect()
    assert len(found) == len(given)
    for r in found:
        assert list(r.token_ids) == other.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


@pytest.mark.parametrize("fold", ["tasks", "spark"])
def test_round_trip_in_one_step(spark, ranks, other, monkeypatch, fold):
    """Bytes are joined in parts; a column named like a result is replaced."""
    monkeypatch.setattr(bpe, "DECODED_IDS", 7)
    given = [(i, text, "x") for i, text in enumerate(texts())] + [(None, None, "x"), (0, "", None)]
    docs = spark.createDataFrame(given, "doc_id long, text string, n_tokens string")
    found = bpe.encode(docs, ranks, PATTERN, fold=fold, finish=bpe.RoundTrip(ranks))
    assert found.columns == ["doc_id", "text", "token_ids", "n_tokens", "decoded_sha256"]
    rows = found.collect()
    assert len(rows) == len(given)
    for r in rows:
        assert list(r.token_ids) == other.encode_ordinary(r.text or "")
        assert r.n_tokens == len(r.token_ids)
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_heap_merges_agree_with_the_fold(ranks, other):
    rng = random.Random(5)
    single = [ranks[bytes([i])] for i in range(256)]
    pairs = {left << 16 | right: rank for (left, right), rank in bpe.pair_ranks(ranks).items()}
    for _ in range(300):
        word = "".join(rng.choice("theringsaeéüß") for _ in range(rng.randrange(1, 90)))
        wanted = other.encode_ordinary(word)
        assert bpe.heap_merges(word.encode(), ranks) == wanted
        if len(wanted) > 1:
            assert bpe.list_merges(word.encode(), single, pairs) == wanted


def test_units_are_cut_as_in_place():
    cut = regex.compile(PATTERN).findall
    for text in texts():
        assert [word for unit in bpe.units(text) for word in cut(unit)] == cut(text)


def test_no_rows(spark, ranks):
    docs = spark.createDataFrame([], "doc_id long, text string")
    for fold in ("tasks", "spark"):
        assert bpe.encode(docs, ranks, PATTERN, fold=fold).collect() == []


def test_a_word_that_is_a_piece_is_not_merged(spark):
    """Ranks in which merges do not lead to a piece."""
    ranks = {bytes([i]): i for i in range(256)} | {b"bc": 256, b"abc": 257, b"ab": 258, b"abcd": 259}
    docs = spark.createDataFrame([(1, "abcd abcd x")], "doc_id long, text string")
    other = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    for fold in ("tasks", "spark"):
        found = bpe.encode(docs, ranks, PATTERN, fold=fold).first()
        assert list(found.token_ids) == other.encode_ordinary("abcd abcd x")


def test_a_pattern_that_joins_words_over_a_space(spark):
    """Parts cut at spaces would miss its matches, which merge over the space."""
    pattern = r"[a-z]+ [a-z]+|\S+|\s"
    ranks = {bytes([i]): i for i in range(256)} | {b"b ": 256, b"b c": 257, b" d": 258}
    given = [(i, text) for i, text in enumerate(["ab cd ef gh x", "b c d b c", "1 b c", "b  c", " b", "", None])]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    for fold in ("tasks", "spark"):
        for r in bpe.encode(docs, ranks, pattern, fold=fold).collect():
            assert list(r.token_ids) == other.encode_ordinary(r.text or "")
