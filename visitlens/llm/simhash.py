"""SimHash near-duplicates by anchor-point covering.

A text's fingerprint has the bits that more than half of its shingles' hashes have. Two
fingerprints are linked if few bits differ. To find links, the first 62 bits are two blocks
of 31, and the words of the Hamming code of length 31 are the anchors of a block. That code
is perfect: every block value is within one bit of exactly one anchor, its home. If two
fingerprints differ in at most 3 bits, one block differs in at most 1, and then the home of
the one is within 1 + 1 bits of the other. So a fingerprint goes to the home of each block
and to every anchor within covering radius plus threshold, 15 or none besides, and homes are
compared with visitors per anchor.

Only distinct fingerprints take part. An anchor's rows arrive sorted, are compared in pieces
of bounded size, and give at most one edge per fingerprint, towards the smallest one linked
with it there. Anchors are counted first, in tasks. One with more than ``CROWDED`` rows is in no single task: its
rows are dealt out anew by the bits outside its block. Of ``bits + 3`` parts of these, three are equal in linked
fingerprints; so a row goes to a group for each choice of three parts and their values, and groups
are compared as anchors are. No pairs of documents are made. What is left of quadratic work is inside groups
of fingerprints that agree in their block, but for the radius, and in three parts besides.

Null texts and texts without words have fingerprint zero. Rows that repeat are one
fingerprint. Rows without an id get the id of their component like others; a component
without any id has none. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitlens.llm.common import stored
from visitlens.llm.components import components
from visitlens.llm.hashing import FACTOR, mixed

SEED = 42
BLOCK = 31
PAIRS = 1 << 20
CROWDED = 2048


def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint of one text, unsigned."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        hashes = map(partial(xxhash.xxh64_intdigest, seed=SEED), joined)
    count = max(1, len(words) - shingle + 1)
    values = np.fromiter(hashes, np.uint64, count)
    ones = np.zeros(64, np.int64)
    for start in range(0, count, 1 << 14):
        part = values[start : start + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str, id_column: str, shingle: int, others: Sequence[str] = ()) -> DataFrame:
    """doc_id, ``others`` and ``fp``, the fingerprint as a signed long, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x, shingle) for x in batch.column(0).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(found.view(np.int64))], names=["doc_id", *others, "fp"]
            )

    given = docs.select(F.col(text).alias("_text"), F.col(id_column).cast("long").alias("doc_id"), *others)
    kept = T.StructType([*given.schema.fields[1:], T.StructField("fp", T.LongType())])
    return given.mapInArrow(run, kept)


def syndromes(values: np.ndarray) -> np.ndarray:
    """For the Hamming code: the place, from 1, of the bit that leads to the code word; 0 in one."""
    found = np.zeros(len(values), np.uint64)
    for place in range(1, BLOCK + 1):
        found ^= ((values >> np.uint64(place - 1)) & np.uint64(1)) * np.uint64(place)
    return found


def flips(radius: int) -> list[np.ndarray]:
    """For each syndrome, all bit patterns of up to ``radius`` ones that lead to a code word;
    the first is that to the nearest."""
    found: list[list[int]] = [[] for _ in range(BLOCK + 1)]
    for ones in range(radius + 1):
        for places in combinations(range(1, BLOCK + 1), ones):
            syndrome = pattern = 0
            for place in places:
                syndrome ^= place
                pattern |= 1 << (place - 1)
            found[syndrome].append(pattern)
    return [np.array(patterns, np.uint64) for patterns in found]


def anchors(fps: DataFrame, bits: int) -> DataFrame:
    """A row for each fingerprint, block and anchor near enough: anchor, fp, home."""
    patterns = flips(1 + bits // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy().view(np.uint64)
            for start in range(0, len(every), 4096):
                values = every[start : start + 4096]
                rows = ([], [], [])
                for block in range(2):
                    own = (values >> np.uint64(BLOCK * block)) & np.uint64((1 << BLOCK) - 1)
                    which = syndromes(own)
                    for syndrome in np.unique(which):
                        at = which == syndrome
                        to = (own[at][:, None] ^ patterns[int(syndrome)][None, :]) | np.uint64(block << BLOCK)
                        home = np.zeros(to.shape, bool)
                        home[:, 0] = True
                        rows[0].append(to.ravel())
                        rows[1].append(np.repeat(values[at], to.shape[1]))
                        rows[2].append(home.ravel())
                to, fp, home = map(np.concatenate, rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(home)],
                    names=["anchor", "fp", "home"],
                )

    return fps.mapInArrow(run, "anchor long, fp long, home boolean")


def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First rows and sizes of the runs of equal keys."""
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return first, np.diff(np.r_[first, len(keys)])


def close_pairs(keys: np.ndarray, fps: np.ndarray, homes: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows with equal keys whose fingerprints are near, a home row first, in
    pieces of some ``PAIRS`` pairs. Keys must be sorted."""
    first, sizes = groups(keys)
    rows = np.repeat(np.arange(len(first)), sizes)
    at = np.flatnonzero(homes & (sizes[rows] > 1))
    width = sizes[rows[at]]
    ends = np.cumsum(width)
    start = 0
    while start < len(at):
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
        left = np.repeat(at[start:end], width[start:end])
        inside = np.arange(len(left)) - np.repeat(ends[start:end] - width[start:end] - done, width[start:end])
        right = np.repeat(first[rows[at[start:end]]], width[start:end]) + inside
        near = np.bitwise_count(fps[left] ^ fps[right]) <= bits
        yield left[near], right[near]
        start = end


def outside(fps: np.ndarray, block: int) -> np.ndarray:
    """The bits of fingerprints that are not in a block, in one row."""
    if block == 0:
        return fps >> np.uint64(BLOCK)
    low, high = (1 << BLOCK) - 1, np.uint64(2 * BLOCK)
    return (fps & np.uint64(low)) | (fps >> high << np.uint64(BLOCK))


def parted(rows: DataFrame, bits: int) -> DataFrame:
    """Rows of crowded anchors (anchor, fp, home) with other anchors: one for each choice of parts that may be equal."""
    parts, width = bits + 3, 64 - BLOCK
    edges_of_parts = [width * i // parts for i in range(parts + 1)]
    masks = []
    for chosen in combinations(range(parts), parts - bits):
        spans = [(edges_of_parts[i], edges_of_parts[i + 1]) for i in chosen]
        masks.append(sum((1 << high) - (1 << low) for low, high in spans))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor = batch.column(0).to_numpy().view(np.uint64)
            fps = batch.column(1).to_numpy().view(np.uint64)
            block = anchor >> np.uint64(BLOCK) & np.uint64(1)
            others = np.where(block == 0, outside(fps, 0), outside(fps, 1))
            for i, mask in enumerate(masks):
                # Groups that share a key by chance are only compared in vain.
                to = mixed(mixed(anchor * np.uint64(FACTOR) + np.uint64(i + 1)) ^ (others & np.uint64(mask)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to.view(np.int64)), *batch.columns[1:]], names=["anchor", "fp", "home"]
                )

    return rows.select("anchor", "fp", "home").mapInArrow(run, "anchor long, fp long, home boolean")


def joined(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Labels, each the smallest place linked so far, after more links."""
    while True:
        a, b = labels[left], labels[right]
        apart = a != b
        if not apart.any():
            return labels
        left, right = left[apart], right[apart]
        np.minimum.at(labels, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            shorter = labels[labels]
            if (shorter == labels).all():
                break
            labels = shorter


def edges(sorted_rows: DataFrame, bits: int) -> DataFrame:
    """Edges (u, v) between fingerprints of each anchor; an anchor's rows lie together."""

    def found(keys: np.ndarray, fps: np.ndarray, homes: np.ndarray) -> pa.RecordBatch:
        labels = np.arange(len(keys))
        for left, right in close_pairs(keys, fps, homes, bits):
            labels = joined(labels, left, right)
        at = np.flatnonzero((labels != np.arange(len(keys))) & (fps != fps[labels]))
        return pa.RecordBatch.from_arrays(
            [pa.array(fps[labels[at]].view(np.int64)), pa.array(fps[at].view(np.int64))], names=["u", "v"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool))
        for batch in batches:
            new = (
                batch.column(0).to_numpy(),
                batch.column(1).to_numpy().view(np.uint64),
                batch.column(2).to_numpy(zero_copy_only=False),
            )
            held = tuple(np.concatenate(x) for x in zip(held, new))
            # The last anchor may go on in the next batch.
            end = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if end:
                yield found(*(x[:end] for x in held))
                held = tuple(x[end:] for x in held)
        if len(held[0]):
            yield found(*held)

    return sorted_rows.mapInArrow(run, "u long, v long")


def _together(rows: DataFrame) -> DataFrame:
    return rows.repartition("anchor").sortWithinPartitions("anchor")


def rooted(known: DataFrame, bits: int) -> DataFrame:
    """``fp``, ``least`` (the smallest doc_id of its rows) and ``root``, a fingerprint that names its
    component, for each fingerprint of ``known`` (doc_id, fp)."""
    if not 0 <= bits <= 7:
        raise ValueError("bits must be from 0 to 7")
    classes = stored(known.groupBy("fp").agg(F.min("doc_id").alias("least")))
    near = anchors(classes.select("fp"), bits)
    crowded = stored(near.groupBy("anchor").agg(F.count("*").alias("n"), F.max("home").alias("met")).filter(F.col("n") > CROWDED))
    # Visitors of an anchor that is nobody's home meet no one there.
    again = parted(near.join(crowded.filter("met"), "anchor"), bits)
    found = [edges(_together(rows), bits) for rows in (near.join(crowded, "anchor", "left_anti"), again)]
    roots = components(stored(found[0].unionByName(found[1])))
    return classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(
    docs: DataFrame, shingle: int = 3, bits: int = 3, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """doc_id, ``fp`` and ``component_id``, the smallest doc_id reachable over links, for every row."""
    known = stored(fingerprints(docs, text, id_column, shingle))
    classes = rooted(known, bits)
    ids = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = classes.join(ids, "root").select("fp", "component_id")
    return known.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def firsts(
    docs: DataFrame, shingle: int = 3, bits: int = 3, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """The row of the smallest id, and then text, of each component; one id may be in many components.
    Ids must not be null."""
    # A row is known by its id and a hash of its text.
    own = docs.withColumn("_own", F.xxhash64(F.lit(SEED), F.col(text)))
    known = stored(fingerprints(own, text, id_column, shingle, ["_own"]))
    classes = stored(rooted(known, bits))
    least = classes.groupBy("root").agg(F.min("least").alias("least"))
    leading = classes.join(least, ["root", "least"]).select("fp", F.col("least").alias("doc_id"), "root")
    rows = known.join(leading, ["fp", "doc_id"]).select(F.col("doc_id").alias("_id"), "_own", "root").distinct()
    held = own.withColumn("_id", F.col(id_column).cast("long")).join(rows, ["_id", "_own"])
    place = F.row_number().over(Window.partitionBy("root").orderBy(text))
    return held.withColumn("_place", place).filter("_place = 1").select(*docs.columns)


def hex_of(fp: str) -> str:
    """SQL for a fingerprint as 16 hexadecimal digits."""
    return f"lpad(lower(hex({fp})), 16, '0')"
