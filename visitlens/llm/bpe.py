"""Byte-level BPE encoding and decoding.

Encoding folds the ranked merges over the bytes of every distinct word: in each step the
leftmost pair of lowest rank in a literal rank map becomes one piece. Texts are put together
from their words. Nothing is shuffled, and what a task remembers is bounded.

The fold has two forms with equal results. ``fold="spark"`` is one of Spark's higher-order
functions: each task gives out a block's distinct words before its texts, Spark folds the
words, and the next step in the same task, which gets the rows in the same order, assembles
the texts. Its literal is an array of small maps picked by a hash of the pair, since a lookup
in a Spark map looks at every entry. Spark interprets such functions and copies arrays in each
step, which takes several times the processor time of the same fold over a list in the task;
``fold="tasks"``, the default, does that. Words over ``FOLDED_BYTES`` bytes are merged in the
task in either form, from ``HEAP_BYTES`` on with a heap.

Decoding joins the pieces' bytes, in order.

Null texts count as empty and have no ids. Repeated rows are encoded each. Other columns of
the documents are kept, whatever their names; those named like a result are replaced.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BLOCK_CHARS = 12 << 20
#: Parts of texts, and words, that a task remembers at most before it starts anew.
KNOWN_UNITS = 400_000
#: Documents whose ids are held as Python's numbers at once.
PART_ROWS = 256
KNOWN_WORDS = 300_000
#: Longer parts and words are not remembered, so that what is remembered is bounded in bytes too.
KNOWN_CHARS = 128
#: Ids whose bytes are joined at once for a digest.
DECODED_IDS = 1 << 16
FOLDED_BYTES = 48
HEAP_BYTES = 200
BUCKETS = 1 << 15
LEFT_FACTOR = 7919
NO_RANK = (1 << 31) - 1

#: White space at an end of a text or beside a space.
BESIDE_SPACE = re.compile(r"^\s|\s$| \s|\s ")

#: Columns of the stream between the steps: rows of words have them, rows of documents have none.
WORD, BYTES, IDS = "_bpe_word", "_bpe_bytes", "_bpe_ids"


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one line for each piece, its bytes in base 64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def pair_ranks(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """The rank of every two pieces that join to a piece, by the pieces' ids."""
    found = {}
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if left is not None and right is not None:
                found[left, right] = rank
    return found


def rank_map(ranks: dict[bytes, int]) -> Column:
    """``pair_ranks`` as a literal: small maps from pairs, picked by a hash of the pair."""
    maps: list[dict[int, int]] = [{} for _ in range(BUCKETS)]
    for (left, right), rank in pair_ranks(ranks).items():
        maps[(left * LEFT_FACTOR + right) % BUCKETS][(left << 16) + right] = rank
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>").cast("array<map<bigint,int>>")


def encoded(pieces: Column, table: Column) -> Column:
    """Merged ids of the single-byte ids of words, an array column; ``table`` is ``rank_map``'s literal.

    The state of the fold is the pieces and the rank of each two neighbours, so a merge looks
    up only the two pairs it makes.
    """
    none = F.array().cast("array<int>")

    def rank(table: Column, left: Column, right: Column) -> Column:
        bucket = F.get(table, (left * LEFT_FACTOR + right).bitwiseAND(F.lit(BUCKETS - 1)))
        return F.coalesce(F.try_element_at(bucket, left.cast("long") * 65536 + right), F.lit(NO_RANK))

    def merged(table: Column, p: Column, r: Column, least: Column, at: Column) -> Column:
        last = F.size(p)
        left = F.when(at > 1, F.array(rank(table, F.get(p, at - 2), least))).otherwise(none)
        right = F.when(at + 1 < last, F.array(rank(table, least, F.get(p, at + 1)))).otherwise(none)
        return F.struct(
            F.concat(F.slice(p, F.lit(1), at - 1), F.array(least), F.slice(p, at + 2, last)).alias("p"),
            F.concat(F.slice(r, F.lit(1), F.greatest(at - 2, F.lit(0))), left, right, F.slice(r, at + 2, last)).alias("r"),
        )

    def step(table: Column, state: Column) -> Column:
        def chosen(least: Column) -> Column:
            place = F.array_position(state["r"], least).cast("int")
            found = _let(place, lambda at: merged(table, state["p"], state["r"], least, at))
            return F.when(least < NO_RANK, found).otherwise(state)

        return _let(F.coalesce(F.array_min(state["r"]), F.lit(NO_RANK)), chosen)

    def fold(table: Column) -> Column:
        pairs = F.transform(
            F.slice(pieces, F.lit(2), F.size(pieces)), lambda x, i: rank(table, F.get(pieces, i), x)
        )
        start = F.struct(pieces.alias("p"), pairs.alias("r"))
        return F.aggregate(
            F.slice(pieces, F.lit(2), F.size(pieces)), start, lambda state, _: step(table, state), lambda state: state["p"]
        )

    return F.when(F.size(pieces) < 2, pieces).when(pieces.isNotNull(), _let(table, fold))


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def list_merges(word: bytes, single: list[int], pairs: dict[int, int]) -> list[int]:
    """The fold's steps over a list; ``pairs`` has the rank of two ids under ``left << 16 | right``."""
    known = pairs.get
    p = [single[byte] for byte in word]
    r = [known(a << 16 | b, NO_RANK) for a, b in pairwise(p)]
    while r:
        least = min(r)
        if least == NO_RANK:
            break
        at = r.index(least)
        p[at : at + 2] = [least]
        del r[at]
        if at:
            r[at - 1] = known(p[at - 1] << 16 | least, NO_RANK)
        if at < len(r):
            r[at] = known(least << 16 | p[at + 1], NO_RANK)
    return p


def heap_merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap and linked pieces, for words too long to look at all pairs in each step."""
    if word in ranks:
        return [ranks[word]]
    pieces: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    after = [*range(1, len(word)), -1]
    before = [-1, *range(len(word) - 1)]
    waiting = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] >= 0:
            rank = ranks.get(pieces[i] + pieces[after[i]])
            if rank is not None:
                heapq.heappush(waiting, (rank, i, len(pieces[i]), len(pieces[after[i]])))

    for i in range(len(word) - 1):
        offer(i)
    while waiting:
        _, i, left, right = heapq.heappop(waiting)
        if pieces[i] is None or after[i] < 0 or (len(pieces[i]), len(pieces[after[i]])) != (left, right):
            continue
        gone = after[i]
        pieces[i] += pieces[gone]
        pieces[gone] = None
        after[i] = after[gone]
        if after[i] >= 0:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [ranks[piece] for piece in pieces if piece is not None]


def units(text: str) -> list[str]:
    """A text in parts that a pattern cuts alike alone and in place, if it lets a space begin a
    word but never end or join two: a single space between two other characters that aren't white
    space then always begins a match.
    """
    if not text or BESIDE_SPACE.search(text):
        return [text] if text else []
    first, *rest = text.split(" ")
    return [first, *[" " + part for part in rest]]


def whole(text: str) -> list[str]:
    """A text as its only part, for any other pattern."""
    return [text] if text else []


def _words_first(text: str, pattern: str, ranks: dict[bytes, int], block_chars: int, schema: pa.Schema, parts):
    """Rows of words before the documents they are from, block by block."""
    single = [ranks[bytes([i])] for i in range(256)]
    pieces_type = pa.list_(pa.int32())

    def start(word: bytes) -> list[int]:
        """The ids to merge, just one if the word is a piece."""
        whole = ranks.get(word)
        return [single[byte] for byte in word] if whole is None else [whole]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = regex.compile(pattern).findall
        at = schema.get_field_index(text)

        def out(held: list[pa.RecordBatch], seen: set[str]) -> Iterator[pa.RecordBatch]:
            words = set()
            for unit in seen:
                words.update(cut(unit))
            # A long word that is no piece is left to the assembling step.
            listed = [w for w in (word.encode() for word in words) if len(w) <= FOLDED_BYTES or w in ranks]
            names = [*schema.names, WORD, BYTES]
            for first in range(0, len(listed), 20_000):
                part = listed[first : first + 20_000]
                nulls = [pa.nulls(len(part), field.type) for field in schema]
                given = [pa.array(part, pa.binary()), pa.array([start(word) for word in part], pieces_type)]
                yield pa.RecordBatch.from_arrays([*nulls, *given], names=names)
            for batch in held:
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.nulls(n, pa.binary()), pa.nulls(n, pieces_type)], names=names
                )

        held, seen, size = [], set(), 0
        for batch in batches:
            first = 0
            texts = batch.column(at).to_pylist()
            for i, value in enumerate(texts):
                if value:
                    seen.update(parts(value))
                    size += len(value)
                if size >= block_chars:
                    held.append(batch.slice(first, i + 1 - first))
                    yield from out(held, seen)
                    held, seen, size, first = [], set(), 0, i + 1
            if first < batch.num_rows:
                held.append(batch.slice(first))
        if held:
            yield from out(held, seen)

    return run


def _assembled(text: str, pattern: str, ranks: dict[bytes, int], names: list[str], finish, parts):
    """Documents with what ``finish`` makes of their ids, from a stream of words and documents, or
    of documents alone."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = regex.compile(pattern).findall
        single = [ranks[bytes([i])] for i in range(256)]
        pairs = {left << 16 | right: rank for (left, right), rank in pair_ranks(ranks).items()}
        ids: dict[str, list[int]] = {}
        known: dict[str, tuple] = {}
        fresh = True

        def merged(word: bytes) -> list[int]:
            whole = ranks.get(word)
            if whole is not None:
                return [whole]
            return list_merges(word, single, pairs) if len(word) < HEAP_BYTES else heap_merges(word, ranks)

        def of_unit(unit: str) -> tuple:
            found = []
            for word in cut(unit):
                own = ids.get(word)
                if own is None:
                    own = merged(word.encode())
                    if len(word) <= KNOWN_CHARS:
                        ids[word] = own
                found.extend(own)
            made = finish.unit(found)
            if len(unit) <= KNOWN_CHARS:
                known[unit] = made
            return made

        for batch in batches:
            n = batch.num_rows
            at = batch.schema.get_field_index(WORD)
            words = batch.column(at) if at >= 0 else pa.nulls(n, pa.binary())
            start = 0
            while start < n:
                kind = words[start].is_valid
                end = start
                valid = words.is_valid().to_numpy(zero_copy_only=False)
                most = n if kind else min(n, start + PART_ROWS)
                while end < most and valid[end] == kind:
                    end += 1
                part = batch.slice(start, end - start)
                if kind:
                    if not fresh:
                        ids, known, fresh = {}, {}, True
                    given = part.column(part.schema.get_field_index(IDS)).to_pylist()
                    for word, own in zip(words.slice(start, end - start).to_pylist(), given):
                        if own is not None:
                            ids[word.decode()] = own
                else:
                    fresh = False
                    rows = []
                    for value in part.column(part.schema.get_field_index(text)).to_pylist():
                        if len(known) > KNOWN_UNITS:
                            known = {}
                        if at < 0 and len(ids) > KNOWN_WORDS:
                            ids = {}
                        pieces = []
                        for unit in parts(value or ""):
                            own = known.get(unit)
                            pieces.append(of_unit(unit) if own is None else own)
                        rows.append(finish.text(pieces))
                    columns = [part.column(part.schema.get_field_index(name)) for name in names]
                    made = [
                        pa.array([row[k] for row in rows], kind) for k, (_, kind) in enumerate(finish.columns)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, *made], names=[*names, *[name for name, _ in finish.columns]]
                    )
                start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # No cycles are made here, and the collector would look through all remembered words again and again.
        gc.disable()
        try:
            yield from assemble(batches)
        finally:
            gc.enable()

    return run


class Ids:
    """Keeps the ids of a text."""

    columns = [("token_ids", pa.list_(pa.int32()))]
    fields = [T.StructField("token_ids", T.ArrayType(T.IntegerType()))]

    def unit(self, ids: list[int]) -> tuple:
        return tuple(ids)

    def text(self, parts: list[tuple]) -> tuple:
        return ([i for part in parts for i in part],)


class RoundTrip:
    """Keeps the ids of a text, their number and a digest of the bytes that they decode to, in one step."""

    columns = [("token_ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("decoded_sha256", pa.string())]
    fields = [
        T.StructField("token_ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]

    def __init__(self, ranks: dict[bytes, int]):
        self.table = pieces(ranks)

    def unit(self, ids: list[int]) -> tuple:
        return tuple(ids)

    def text(self, parts: list[tuple]) -> tuple:
        ids = [i for part in parts for i in part]
        decoded = hashlib.sha256()
        for start in range(0, len(ids), DECODED_IDS):
            decoded.update(b"".join([self.table[i] for i in ids[start : start + DECODED_IDS]]))
        return ids, len(ids), decoded.hexdigest()


class Digests:
    """Keeps the number of ids, a digest of them, and one of the bytes they decode to."""

    columns = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]

    def __init__(self, ranks: dict[bytes, int]):
        self.table = pieces(ranks)

    def unit(self, ids: list[int]) -> tuple:
        return len(ids), ",".join(map(str, ids)), b"".join([self.table[i] for i in ids])

    def text(self, parts: list[tuple]) -> tuple:
        counts, listed, decoded = zip(*parts) if parts else ((), (), ())
        ids = hashlib.sha256(",".join(listed).encode()).hexdigest()
        return sum(counts), ids, hashlib.sha256(b"".join(decoded)).hexdigest()


def encode(
    docs: DataFrame,
    ranks: dict[bytes, int],
    pattern: str,
    text: str = "text",
    finish: Ids | RoundTrip | Digests | None = None,
    block_chars: int = BLOCK_CHARS,
    fold: str = "tasks",
    spaces_begin: bool = False,
) -> DataFrame:
    """``docs`` with the column ``token_ids``, or the columns that ``finish`` makes of the ids.

    ``spaces_begin`` states that the pattern begins a match at each space between two characters that
    aren't white space, as the patterns of the public tokenizers do; the words between are then
    cut and remembered by themselves. Any pattern is right without it.
    """
    if fold not in ("tasks", "spark"):
        raise ValueError(f"fold is tasks or spark, not {fold!r}")
    finish = finish or Ids()
    made = {field.name for field in finish.fields}
    rest = [field for field in docs.schema if field.name not in made or field.name == text]
    docs = docs.select(*[F.col(f"`{field.name}`") for field in rest])
    names = [field.name for field in rest]
    parts = units if spaces_begin else whole
    assembled = _assembled(text, pattern, ranks, names, finish, parts)
    schema = T.StructType([*rest, *finish.fields])
    if fold == "tasks":
        return docs.mapInArrow(assembled, schema)
    given = to_arrow_schema(docs.schema)
    between = [T.StructField(WORD, T.BinaryType()), T.StructField(BYTES, T.ArrayType(T.IntegerType()))]
    stream = docs.mapInArrow(
        _words_first(text, pattern, ranks, block_chars, given, parts), T.StructType([*rest, *between])
    )
    merged = stream.select(
        *[F.col(f"`{field.name}`") for field in rest], WORD, encoded(F.col(BYTES), rank_map(ranks)).alias(IDS)
    )
    return merged.mapInArrow(assembled, schema)


def pieces(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each id."""
    found = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        found[rank] = piece
    return found


def decode(docs: DataFrame, ranks: dict[bytes, int], ids: str = "token_ids") -> DataFrame:
    """``docs`` with ``decoded``, the joined bytes of the ids; null ids give no bytes."""
    table = pieces(ranks)
    rest = [field for field in docs.schema if field.name != "decoded"]
    docs = docs.select(*[F.col(f"`{field.name}`") for field in rest])
    names = to_arrow_schema(docs.schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, PART_ROWS):
                part = batch.slice(start, PART_ROWS)
                found = part.column(names.index(ids)).to_pylist()
                made = pa.array([b"".join([table[i] for i in own or ()]) for own in found], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*names, "decoded"])

    return docs.mapInArrow(run, T.StructType([*rest, T.StructField("decoded", T.BinaryType())]))
