"""Benchmark decontamination with an FM-index per training shard.

A shard is a block of documents in a task. Its index is over words: those of the test
phrases are symbols, all others one separator. Phrases are searched backwards, all at once,
through the ranks of a wavelet tree over the shard's BWT; occurrences are located by walking
to sampled suffix positions; and the words they hit are merged into spans per document. Runs
of phrase words shorter than the shortest phrase cannot hold one and are left out.

Test phrases are a stated query set. They are read in blocks of ``BLOCK_PHRASES`` and each
block is searched in all documents, so what goes to the tasks at once is bounded however many
items there are. One block is all that most benchmarks have; documents are then read once and never shuffled. Of more
blocks only what they hit is stored, by the text's MD5, and joined to the documents once at the end.

Null texts have no words, and an item without words has no phrases. Items that repeat count
once by id; a null id counts as an empty one. Repeated documents are each judged. Other
columns are kept; those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from visitlens.llm.common import blocks, stored
from visitlens.llm.fm_index import FMIndex
from visitlens.llm.hashing import words

WINDOW = 13
SHARD_BYTES = 1 << 20
BLOCK_PHRASES = 100_000
ROWS_AT_ONCE = 1 << 18

#: Bytes that part words, and the lower case of each byte.
_APART = np.ones(256, bool)
_APART[0x30:0x3A] = _APART[0x61:0x7B] = _APART[0x80:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

#: The result columns: words, spans [start, end) of hit words, and ids of items that occur.
SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(SPAN)),
    T.StructField("items", T.ArrayType(T.StringType())),
]
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


class Phrases(NamedTuple):
    """A block of distinct phrases: sorted word hashes, phrases as rows of symbols (2 and up, in
    that order) with 0 before the first, and pairs of a phrase and an item that has it."""

    words: np.ndarray
    rows: np.ndarray
    lengths: np.ndarray
    pair_phrase: np.ndarray
    pair_item: np.ndarray
    ids: list[str]


def _block(rows: list[np.ndarray], owners: list[str], window: int) -> Phrases:
    """Phrases, given as word hashes, and the item of each."""
    lengths = np.array([len(row) for row in rows], np.int64)
    known = np.unique(np.concatenate([*rows, np.zeros(0, np.uint64)]))
    matrix = np.zeros((len(rows), window), np.int64)
    for i, row in enumerate(rows):
        matrix[i, window - len(row) :] = np.searchsorted(known, row) + 2
    matrix, which = np.unique(matrix, axis=0, return_inverse=True) if len(rows) else (matrix, lengths)
    ids = sorted(set(owners))
    place = {owner: i for i, owner in enumerate(ids)}
    item = np.array([place[owner] for owner in owners], np.int64)
    return Phrases(known, matrix, (matrix > 0).sum(axis=1), which.ravel(), item, ids)


def phrase_blocks(items: DataFrame, window: int, item_id: str, text: str, most: int) -> Iterator[Phrases]:
    """The items' windows in blocks; one empty block if there are none."""
    rows: list[np.ndarray] = []
    owners: list[str] = []
    made = False
    chosen = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    for item in chosen.filter("text is not null").toLocalIterator():
        data = _LOWER[np.frombuffer(item.text.encode(), np.uint8)]
        found = words(data, np.array([0, len(data)]), _APART)[2]
        for start in range(max(1, len(found) - window + 1) if len(found) else 0):
            rows.append(found[start : start + window])
            owners.append(item.id)
            if len(rows) == most:
                yield _block(rows, owners, window)
                rows, owners, made = [], [], True
    if rows or not made:
        yield _block(rows, owners, window)


class Searcher:
    """Finds a block of phrases in shards."""

    def __init__(self, phrases: Phrases):
        self.phrases = phrases
        self.shortest = int(phrases.lengths.min(initial=1 << 30))
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(phrases.words & np.uint64(0xFFFF)).astype(np.int64)] = True
        order = np.argsort(phrases.pair_phrase, kind="stable")
        self.items = phrases.pair_item[order]
        self.item_start = np.searchsorted(phrases.pair_phrase[order], np.arange(len(phrases.rows) + 1))

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of words; 1 for words of no phrase."""
        found = np.ones(len(hashes), np.int64)
        at = np.flatnonzero(self.maybe[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        place = np.searchsorted(self.phrases.words, hashes[at])
        place[place == len(self.phrases.words)] = 0
        known = self.phrases.words[place] == hashes[at] if len(self.phrases.words) else np.zeros(len(at), bool)
        found[at[known]] = place[known] + 2
        return found

    def occurrences(self, hashes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Phrases and the places of their first words in a shard, in pieces."""
        symbols = self.symbols(hashes)
        # Runs of phrase words inside one text.
        cut = np.zeros(len(symbols) + 1, bool)
        cut[counts] = True
        inside = symbols > 1
        begins = np.flatnonzero(inside & (cut[:-1] | np.r_[True, ~inside[:-1]]))
        ends = np.flatnonzero(inside & (cut[1:] | np.r_[~inside[1:], True])) + 1
        long = ends - begins >= self.shortest
        begins, sizes = begins[long], (ends - begins)[long]
        if not len(begins):
            return
        # Each run, then a separator.
        first = np.cumsum(sizes + 1) - sizes - 1
        place = np.arange(int((sizes + 1).sum())) - np.repeat(first - begins, sizes + 1)
        text = symbols[np.minimum(place, len(symbols) - 1)]
        text[first + sizes] = 1
        index = FMIndex(text)
        low, high = index.search(self.phrases.rows)
        found = np.flatnonzero(low < high)
        sizes = high[found] - low[found]
        ends = np.cumsum(sizes)
        for start in range(0, int(ends[-1]) if len(ends) else 0, ROWS_AT_ONCE):
            wanted = np.arange(start, min(start + ROWS_AT_ONCE, int(ends[-1])))
            which = np.searchsorted(ends, wanted, side="right")
            rows = low[found[which]] + wanted - (ends - sizes)[which]
            yield found[which], place[index.locate(rows)]

    def shard(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[list[str]]]:
        """For each text of a shard its words, hit spans and items."""
        _, _, hashes, counts = words(_LOWER[data], starts, _APART)
        n = len(starts) - 1
        change = np.zeros(len(hashes) + 1, np.int64)
        seen: list[np.ndarray] = []
        for phrase, place in self.occurrences(hashes, counts):
            np.add.at(change, place, 1)
            np.add.at(change, place + self.phrases.lengths[phrase], -1)
            text = np.searchsorted(counts, place, side="right") - 1
            seen.append(np.unique(text * len(self.phrases.rows) + phrase))
        spans = [np.zeros((0, 2), np.int64)] * n
        items: list[list[str]] = [[] for _ in range(n)]
        if seen:
            hit = np.r_[0, np.cumsum(change)[:-1] > 0, 0]
            for text, phrase in (divmod(int(x), len(self.phrases.rows)) for x in np.unique(np.concatenate(seen))):
                own = self.items[self.item_start[phrase] : self.item_start[phrase + 1]]
                items[text].extend(self.phrases.ids[i] for i in own)
                if not len(spans[text]):
                    part = np.diff(np.r_[0, hit[1 + counts[text] : 1 + counts[text + 1]], 0])
                    spans[text] = np.stack([np.flatnonzero(part > 0), np.flatnonzero(part < 0)], axis=1)
        return np.diff(counts), spans, [sorted(set(x)) for x in items]


def merged(spans: np.ndarray) -> np.ndarray:
    """The union of spans as maximal spans in order."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > reach[:-1]]
    return np.stack([spans[new, 0], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(spans) - 1]]], axis=1)


def _listed(spans: list[np.ndarray]) -> pa.Array:
    return pa.array([[{"start": a, "end": b} for a, b in x.tolist()] for x in spans], _ARROW_SPANS)


def _searched(docs: DataFrame, phrases: Phrases, text: str) -> DataFrame:
    """``docs`` with the result columns, of one block of phrases."""
    schema = T.StructType([*docs.schema, *FIELDS])
    at = to_arrow_schema(docs.schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(phrases)
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, names=at)
            for first, end, data, starts in blocks(batch, text, SHARD_BYTES):
                n_words, spans, items = searcher.shard(data, starts)
                found = (pa.array(n_words.astype(np.int64)), _listed(spans), pa.array(items, pa.list_(pa.string())))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(first, end - first).columns, *found], names=[field.name for field in schema]
                )

    return docs.mapInArrow(run, schema)


def _finished(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the result columns in place of ``_spans`` and ``_items``, lists of what blocks found, or null."""
    rest = [field for field in docs.schema if field.name not in ("_spans", "_items")]
    schema = T.StructType([*rest, *FIELDS])
    at = to_arrow_schema(docs.schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, names=at)
            for first, end, data, starts in blocks(batch, text, SHARD_BYTES):
                part = batch.slice(first, end - first)
                counts = words(_LOWER[data], starts, _APART)[3]
                spans, items = [], []
                for lists, names in zip(part.column(at.index("_spans")).to_pylist(), part.column(at.index("_items")).to_pylist()):
                    every = [[s["start"], s["end"]] for own in lists or [] for s in own]
                    spans.append(merged(np.array(every, np.int64).reshape(-1, 2)))
                    items.append(sorted({x for own in names or [] for x in own}))
                found = (pa.array(np.diff(counts).astype(np.int64)), _listed(spans), pa.array(items, pa.list_(pa.string())))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(at.index(field.name)) for field in rest], *found], names=[field.name for field in schema]
                )

    return docs.mapInArrow(run, schema)


def judged(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_phrases: int = BLOCK_PHRASES,
) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans``, ``items``, ``n_hit`` and ``contaminated``: words are
    hit, and at least one of twenty."""
    given = docs.drop("n_words", "hit_spans", "items", "n_hit", "contaminated")
    every = phrase_blocks(items, window, item_id, item_text, block_phrases)
    first = next(every)
    second = next(every, None)
    if second is None:
        found = _searched(given, first, text)
    else:
        # What a block finds depends on the text alone.
        texts = given.select(F.unhex(F.md5(F.col(f"`{text}`"))).alias("_hash"), F.col(f"`{text}`").alias("text"))
        hits = None
        for phrases in chain((first, second), every):
            of_block = _searched(texts.filter("text is not null"), phrases, "text").filter("size(hit_spans) > 0")
            own = stored(of_block.select("_hash", "hit_spans", "items").dropDuplicates(["_hash"]))
            hits = own if hits is None else hits.unionByName(own)
        hits = hits.groupBy("_hash").agg(F.collect_list("hit_spans").alias("_spans"), F.collect_list("items").alias("_items"))
        marked = given.withColumn("_hash", F.unhex(F.md5(F.col(f"`{text}`")))).join(hits, "_hash", "left").drop("_hash")
        found = _finished(marked, text)
    return found.withColumn(
        "n_hit", F.expr("aggregate(hit_spans, 0L, (n, s) -> n + s.end - s.start)")
    ).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))
