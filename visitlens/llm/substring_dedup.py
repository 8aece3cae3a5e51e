"""Substring dedup by seed and extend.

A repeat is a run of at least ``length`` words that an earlier document, one with a smaller
id, has too. Seeds are winnowed: of the short word groups in a window of ``length`` words the
one with the lowest hash is chosen, so equal windows choose equal seeds and about one place in
five or six is a seed. Documents are joined on seeds that two of them have. Around
these, matches are extended both ways: every window that chose the seed reaches from it as far
left and right as a repeat of ``length`` words can, and windows of equal words meet under one
hash of 64 bits. Windows that an earlier document has are merged into maximal repeats, which go.

A seed or window brings one row per task to its aggregation, and joins get both sides as plain exchanges,
so Spark splits a seed or a window that very many documents have over tasks; no pairs of documents are made.
Of documents with equal texts, by MD5, only the first takes part; the others are repeats as a whole.
A document is named by 64 bits. Names that different documents would share are found by MD5 and
replaced, so that every document has a name of its own.

Texts are read in blocks of a megabyte; a longer one takes some thirty times its size in memory.

Null texts have no words. A null id comes after all others. Rows that repeat (equal id and
text) are one document and each get its result. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import blocks, named, often
from visitlens.llm.hashing import grams, joined_words, lowest, windows, words

LENGTH = 13
SEED = 4
#: Rows and bytes of texts that are unpacked at once, or one text.
UNPACKED_ROWS = 1024
UNPACKED_BYTES = 4 << 20

#: Every step takes all columns of a row, so that the exchanges of the texts are one.
ROW = ["doc_id", "doc", "name", "packed"]


def _chosen(hashes: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows' places and texts, the place of each one's seed, and the seeds' hashes."""
    seed = min(SEED, length)
    values = grams(hashes, seed)
    at, text = windows(counts, length)
    return at, text, lowest(values, length - seed + 1)[at], values


def packed(docs: DataFrame) -> DataFrame:
    """``ROW`` with texts compressed one by one, which halves what is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor().compress
        for batch in batches:
            texts = [pack(text.encode()) for text in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(texts, pa.binary())], names=ROW)

    # Keys that may be null would get a filter in some joins and so an exchange of their own.
    return docs.mapInArrow(run, "doc_id long, doc long not null, name long not null, packed binary")


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``ROW`` and more with texts again, in parts of bounded rows and bytes."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        column = batch.column(3)
        ends = np.cumsum([zstandard.frame_content_size(x.as_buffer()) for x in column])
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + UNPACKED_BYTES, side="right"))
            part = batch.slice(start, min(max(stop, start + 1), start + UNPACKED_ROWS) - start)
            texts = pa.array([unpack(x) for x in part.column(3).to_pylist()], pa.large_binary()).cast(pa.large_string())
            names = [*ROW[:3], "text", *batch.schema.names[4:]]
            yield pa.RecordBatch.from_arrays([*part.columns[:3], texts, *part.columns[4:]], names=names)
            start += part.num_rows


def seeds_held(docs: DataFrame, length: int) -> DataFrame:
    """``h`` of each seed, once for a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches):
            for _, _, data, starts in blocks(batch, "text"):
                _, _, hashes, counts = words(data, starts)
                _, text, place, values = _chosen(hashes, counts, length)
                found = values[place]
                order = np.lexsort((found, text))
                found, text = found[order], text[order]
                new = np.r_[True, (found[1:] != found[:-1]) | (text[1:] != text[:-1])] if len(found) else text > 0
                yield pa.RecordBatch.from_arrays([pa.array(found[new].view(np.int64))], names=["h"])

    return docs.select(ROW).mapInArrow(run, "h long")


def seeds(docs: DataFrame, length: int) -> DataFrame:
    """``h``, the document's name and ``at``, the place of each seed in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches):
            name = batch.column(2).to_numpy()
            for start, _, data, starts in blocks(batch, "text"):
                _, _, hashes, counts = words(data, starts)
                _, text, place, values = _chosen(hashes, counts, length)
                new = np.r_[True, place[1:] != place[:-1]] if len(place) else np.zeros(0, bool)
                place, text = place[new], text[new]
                found = (values[place].view(np.int64), name[start + text], (place - counts[text]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["h", "name", "at"])

    return docs.select(ROW).mapInArrow(run, "h long, name long, at int")


def extended(found: DataFrame, length: int) -> DataFrame:
    """``w``, the document's order and name, and ``start`` of each window around the seeds at ``places``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches):
            doc, name = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            places = batch.column(4)
            for first, end, data, starts in blocks(batch, "text"):
                _, _, hashes, counts = words(data, starts)
                at, text, place, _ = _chosen(hashes, counts, length)
                shared = np.zeros(len(hashes) + 1, bool)
                for i in range(first, end):
                    shared[counts[i - first] + places[i].values.to_numpy()] = True
                kept = shared[place]
                at, text = at[kept], text[kept]
                found = (
                    grams(hashes, length)[at].view(np.int64),
                    doc[first + text],
                    name[first + text],
                    (at - counts[text]).astype(np.int32),
                )
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["w", "doc", "name", "start"])

    return found.select(*ROW, "places").mapInArrow(run, "w long, doc long, name long, start int")


def _parted(docs: DataFrame, length: int) -> DataFrame:
    """Each text's words but those in the windows that start at ``starts``; all if ``copy``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked(batches):
            copies, listed = batch.column(4).to_pylist(), batch.column(5)
            for row, stop, data, text_starts in blocks(batch, "text"):
                first, end, _, counts = words(data, text_starts)
                change = np.zeros(len(first) + 1, np.int64)
                for i in range(row, stop):
                    low, high = counts[i - row], counts[i - row + 1]
                    if copies[i] and high - low >= length:
                        change[low] += 1
                        change[high] -= 1
                    elif listed[i].is_valid:
                        at = low + listed[i].values.to_numpy()
                        np.add.at(change, at, 1)
                        np.add.at(change, at + length, -1)
                gone = np.cumsum(change)[:-1] > 0
                removed = np.diff(np.r_[0, np.cumsum(gone)][counts])
                kept = joined_words(data, first, end, ~gone, counts).cast(pa.binary())
                found = (pa.array(np.diff(counts).astype(np.int64)), pa.array(removed.astype(np.int64)), kept)
                ids = batch.column(0).slice(row, stop - row)
                yield pa.RecordBatch.from_arrays([ids, *found], names=["doc_id", "n_words", "n_removed", "kept"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary")


def without_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id, ``n_words``, ``n_removed`` and ``kept``, the kept words joined by one space in UTF-8."""
    last = (1 << 63) - 1
    whole = F.coalesce(F.col(text), F.lit(""))
    base = named(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            F.coalesce(F.col(id_column).cast("long"), F.lit(last)).alias("doc"),
            F.unhex(F.md5(whole)).alias("text_hash"),
            whole.alias("text"),
        ),
        ["doc", "text_hash"],
    )
    # The texts are shuffled once, by name; Spark reuses that exchange in each join below.
    first = base.groupBy("text_hash").agg(F.min(F.struct("doc", "name")).alias("first")).select("first.name")
    rows = packed(base.select("doc_id", "doc", "name", "text"))
    own = rows.join(first.withColumn("own", F.lit(True)), "name", "left_semi")
    sown = seeds(own, length)
    places = sown.join(often(seeds_held(own, length), "h"), "h").groupBy("name").agg(F.collect_list("at").alias("places"))
    around = extended(rows.join(places, "name"), length)
    earliest = _earliest(around)
    repeats = (
        around.join(earliest, "w").filter("earliest < doc").groupBy("name").agg(F.collect_set("start").alias("starts"))
    )
    marked = rows.join(first.withColumn("own", F.lit(True)), "name", "left").join(repeats, "name", "left")
    return _parted(marked.select(*ROW, F.expr("own is null").alias("copy"), "starts"), length)


def _earliest(around: DataFrame) -> DataFrame:
    """``w`` and ``earliest``, the first document, of windows that occur twice. Counted in tasks first; ``w`` is
    given back from another number, so that a join on it is one of plain exchanges."""
    counted = around.groupBy(F.col("w").bitwiseXOR(F.lit(1)).alias("other")).agg(
        F.min("doc").alias("earliest"), F.count("*").alias("n")
    )
    return counted.filter("n > 1").select(F.col("other").bitwiseXOR(F.lit(1)).alias("w"), "earliest")
