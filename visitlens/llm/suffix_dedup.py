"""Suffix-array dedup: bytes covered by a long string that starts elsewhere too are removed.

The suffix array is sampled: of every window of ``length`` bytes, the group of ``SEED`` bytes
with the lowest hash is its seed, so equal windows have seeds at equal places and about one
byte in eighty begins a seed. Seeds that occur once are dropped. The surroundings of the
others are merged where they are equal, and go to one partition per seed, where deep-shallow sorting orders the suffixes that
start at the seed, and the reversed prefixes that end there. From the two orders and the
lengths that neighbours share, every window around a seed is known to have an equal or not:
windows that are as many bytes to the left of their seed are equal if the prefixes agree that
far and the suffixes agree over the rest. All equal windows of an occurrence hold its seed,
so they cover one span.

Equal texts, by MD5, are one text that is covered as a whole. Equal surroundings of a seed are merged in
the tasks that read them and then by all their bytes, so a seed's group costs its different surroundings. A seed with more of
them than ``SURROUNDINGS`` is split by more bytes, again and again: the windows that start from lo to hi bytes left of
the seed all cover lo bytes before it and some bytes after it, so equal ones agree in these, and
the groups that agree are sorted as others are. The range of a group that is still crowded is halved, down to a
single start; its windows are then equal as a whole and only counted. What is found for
surroundings is joined back to their occurrences by seed and MD5.
Texts are read in blocks of a megabyte; a longer one takes some fifty times its size.

Null texts are empty. Texts shorter than ``length`` lose nothing. Rows that repeat are copies
of each other. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import blocks, named, often, stored, text_bytes
from visitlens.llm.hashing import lowest, mixed, powers, prefix_hashes, windows
from visitlens.llm.hashing import INVERSE
from visitlens.llm.suffix_sort import agreement, deep_shallow

LENGTH = 200
SEED = 32
BATCH_ROWS = 20_000
#: Different surroundings of a seed that one task sorts.
SURROUNDINGS = 20_000
KEYS = ["h", "left", "mark", "around"]
#: SQL for the group of a seed's surroundings that share bytes. Unlike ones that meet in one are told apart by sorting.
GROUP = "xxhash64(h, lo, {shared})"


def _chosen(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of windows that share a seed: its hash and place, and the first and last window."""
    seed = min(SEED, length)
    at, text = windows(starts, length)
    if not len(at):
        empty = np.zeros(0, np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    sums = prefix_hashes(data)
    n = len(data) - seed + 1
    values = mixed((sums[seed:] - sums[:n]) * powers(INVERSE, n))
    place = lowest(values, length - seed + 1)[at]
    new = np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(at)] - 1
    return values[place[first]], place[first], at[first], at[last]


def seeds(texts: DataFrame, length: int) -> DataFrame:
    """``h``, the text's name and ``at``, the place of each seed in its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name = batch.column(0).to_numpy()
            for row, _, data, starts in blocks(batch, "text"):
                h, place, _, _ = _chosen(data, starts, length)
                text = np.searchsorted(starts, place, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(name[row + text]), pa.array(place - starts[text])],
                    names=["h", "name", "at"],
                )

    return texts.select("name", "text").mapInArrow(run, "h long, name long, at long")


def surroundings(found: DataFrame, length: int) -> DataFrame:
    """For each seed at ``places``: its hash and place, how far left its windows reach, and the bytes they cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, places = batch.column(0).to_numpy(), batch.column(2)
            for row, end, data, starts in blocks(batch, "text"):
                h, place, low, high = _chosen(data, starts, length)
                shared = np.zeros(len(data) + 1, bool)
                for i in range(row, end):
                    shared[starts[i - row] + places[i].values.to_numpy()] = True
                kept = shared[place]
                h, place, low, high = h[kept], place[kept], low[kept], high[kept]
                text = np.searchsorted(starts, place, side="right") - 1
                for i in range(0, len(h), 10_000):
                    part = slice(i, i + 10_000)
                    around = [data[a : b + length].tobytes() for a, b in zip(low[part], high[part])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(h[part].view(np.int64)),
                            pa.array(name[row + text[part]]),
                            pa.array((place - starts[text])[part]),
                            pa.array((place - low)[part].astype(np.int32)),
                            pa.array(around, pa.binary()),
                        ],
                        names=["h", "name", "at", "left", "around"],
                    )

    return found.select("name", "text", "places").mapInArrow(
        run, "h long, name long, at long, left int, around binary"
    )


def reach(
    group: np.ndarray, left: np.ndarray, around: list[bytes], times: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each row the farthest and the nearest start, from ``lo`` to ``hi`` bytes left of the seed, of a window
    that another row of its group or a copy of it has too; -1 where none is."""
    n, widest = len(around), length - min(SEED, length)
    before, after = np.zeros((n, max(1, widest)), np.uint8), np.zeros((n, length), np.uint8)
    right = np.empty(n, np.int64)
    for i, (text, cut) in enumerate(zip(around, left)):
        row = np.frombuffer(text, np.uint8)
        before[i, :cut] = row[:cut][::-1]
        right[i] = len(row) - cut
        after[i, : min(length, right[i])] = row[cut : cut + length]
    orders = []
    for matrix in (before, after):
        order = deep_shallow(matrix, group)
        shared = agreement(matrix, group, order)
        orders.append((order, shared))
    far, near = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    classes = np.empty((2, n), np.int64)
    for start in range(int(lo.min(initial=0)), min(widest, int(hi.max(initial=0))) + 1):
        valid = (left >= start) & (right >= length - start) & (lo <= start) & (start <= hi)
        if not valid.any():
            continue
        for side, agree in ((0, start), (1, length - start)):
            order, shared = orders[side]
            classes[side, order] = np.cumsum(shared < agree)
        at = np.flatnonzero(valid)
        _, which = np.unique(classes[0, at] * (n + 1) + classes[1, at], return_inverse=True)
        held = np.bincount(which, weights=times[at])
        twice = at[held[which] > 1]
        near[twice] = np.where(near[twice] < 0, start, near[twice])
        far[twice] = start
    return far, near


def _merged(rows: pa.Table) -> pa.Table:
    """Rows with equal surroundings of a seed as one, with the sum of their times."""
    return rows.group_by(KEYS).aggregate([("times", "sum")]).rename_columns([*KEYS, "times"])


def different(around: DataFrame) -> DataFrame:
    """The different surroundings of all seeds, with ``times``, how many rows have them. What a task has of them is
    merged before they are dealt out, by all their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = pa.Table.from_batches([batch.append_column("times", pa.array(np.ones(batch.num_rows, np.int64)))])
            held = new if held is None else pa.concat_tables([held, new])
            if held.num_rows >= 2 * BATCH_ROWS:
                held = _merged(held)
                if held.num_rows >= BATCH_ROWS:
                    yield from held.to_batches()
                    held = None
        if held is not None:
            yield from _merged(held).to_batches()

    counted = around.select(*KEYS).mapInArrow(run, "h long, left int, mark binary, around binary, times long")
    return counted.groupBy(*KEYS).agg(F.sum("times").alias("times"))


def verdicts(dealt: DataFrame, length: int) -> DataFrame:
    """h, left, mark, and ``far`` and ``near`` of the different surroundings that have equal windows in their group
    ``g``; rows must be sorted by it."""

    def found(part: pa.Table) -> pa.RecordBatch:
        g, left, times, lo, hi = (part.column(x).to_numpy().astype(np.int64) for x in ("g", "left", "times", "lo", "hi"))
        group = np.r_[0, np.cumsum(g[1:] != g[:-1])]
        far, near = reach(group, left, part.column("around").to_pylist(), times, lo, hi, length)
        some = pa.array(np.flatnonzero(far >= 0))
        known = [part.column(x).combine_chunks().take(some) for x in ("h", "left", "mark")]
        ends = [pa.array(x.astype(np.int32)).take(some) for x in (far, near)]
        return pa.RecordBatch.from_arrays([*known, *ends], names=["h", "left", "mark", "far", "near"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_ROWS):
                held.append(batch.slice(i, BATCH_ROWS))
                size += held[-1].num_rows
                if size < BATCH_ROWS:
                    continue
                part = pa.Table.from_batches(held)
                g = part.column("g").to_numpy()
                # The last group may go on in the next batch.
                end = int(np.searchsorted(g, g[-1]))
                if end:
                    yield found(part.slice(0, end))
                    part = part.slice(end)
                held, size = part.to_batches(), part.num_rows
        if size:
            yield found(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "h long, left int, mark binary, far int, near int")


def halved(rows: DataFrame, length: int) -> DataFrame:
    """Crowded groups split: each row with either half of the starts, if it has windows there, in the group of those
    that share the bytes which all windows of that half cover."""
    halves = "inline(array(struct(lo as lo, (lo + hi) div 2 as hi), struct((lo + hi) div 2 + 1 as lo, hi as hi)))"
    each = rows.selectExpr("h", "left", "mark", "around", "times", halves)
    fits = f"least(left, hi) >= greatest(lo, {length} - (length(around) - left), 0)"
    shared = f"substring(around, left - lo + 1, {length} - hi + lo)"
    return each.filter(fits).withColumn("g", F.expr(GROUP.format(shared=shared)))


def counted_windows(rows: DataFrame, length: int) -> DataFrame:
    """As ``verdicts``, for groups of a single start: their windows are equal as a whole or not at all."""
    windowed = rows.withColumn("window", F.expr(f"substring(around, left - lo + 1, {length})"))
    # From another number, so that a window that very many have can be split.
    several = windowed.groupBy(F.expr("h ^ 1 as other"), "lo", "window").agg(F.sum("times").alias("n")).filter("n > 1")
    twice = several.selectExpr("other ^ 1 as h", "lo", "window")
    return windowed.join(twice, ["h", "lo", "window"]).selectExpr("h", "left", "mark", "lo as far", "lo as near")


def covered(around: DataFrame, length: int) -> DataFrame:
    """The text's name, ``start`` and ``end`` of what equal windows cover around each seed."""
    known = stored(around.withColumn("mark", F.unhex(F.md5("around"))))
    widest = length - min(SEED, length)
    rows = stored(different(known)).withColumn("g", F.col("h")).withColumn("lo", F.lit(0)).withColumn("hi", F.lit(widest))
    judged = []
    while True:
        many = stored(rows.groupBy("g").count().filter(F.col("count") > SURROUNDINGS).select("g"))
        crowded = not many.isEmpty()
        few = rows.join(many, "g", "left_anti") if crowded else rows
        judged.append(verdicts(few.repartition("g").sortWithinPartitions("g"), length))
        if not crowded:
            break
        rows = stored(halved(rows.join(many, "g", "left_semi"), length))
        judged.append(counted_windows(rows.filter("lo = hi"), length))
        rows = rows.filter("lo < hi")
    every = reduce(DataFrame.unionByName, judged)
    spans = known.drop("around").join(every, ["h", "left", "mark"])
    return spans.selectExpr("name", "at - far as start", f"at - near + {length} as end")


def _cut(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, spans = batch.column(2).to_pylist(), batch.column(3)
            data, starts = text_bytes(batch.column(1))
            out = ([], [], [], [])
            for i in range(batch.num_rows):
                text = data[starts[i] : starts[i + 1]]
                gone = np.zeros(len(text) + 2, np.int32)
                if copies[i] > 1 and len(text) >= length:
                    gone[1], gone[-1] = 1, -1
                elif spans[i].is_valid:
                    own = spans[i].values
                    np.add.at(gone, own.field("start").to_numpy() + 1, 1)
                    np.add.at(gone, own.field("end").to_numpy() + 1, -1)
                removed = np.cumsum(gone)[:-1] > 0
                out[0].append(len(text))
                out[1].append(int(removed.sum()))
                out[2].append(int((removed[1:] & ~removed[:-1]).sum()))
                out[3].append(text[~removed[1:]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, pa.int64()) for x in out[:3]], pa.array(out[3], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def without_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """doc_id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept``, the other bytes joined."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = named(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"), F.unhex(F.md5(whole)).alias("text_hash"), whole.alias("text")
        ),
        ["text_hash"],
    ).drop("text_hash")
    # One row stands for equal texts: that of the smallest id.
    classes = rows.groupBy("name").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    known = rows.join(classes, "name")
    # Not an equality, which Spark would make a join key that needs the texts dealt out anew.
    own = known.filter("coalesce(doc_id <= least, least is null)").select("name", "text")
    sown = seeds(own, length)
    places = sown.join(often(sown, "h"), "h").groupBy("name").agg(F.collect_set("at").alias("places"))
    around = surroundings(own.join(places, "name"), length)
    spans = covered(around, length).groupBy("name").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    marked = known.join(spans, "name", "left")
    return _cut(marked.select("doc_id", "text", "copies", "spans"), length)
