"""Periodic runs in texts by internal pattern matching.

A run is a stretch of words with smallest period q, at least ``LEAST_EXPONENT`` times as long as q and of at
least ``LEAST_LENGTH`` words, that no neighbouring word extends. All runs of a text are found, and all but
the first period of each goes.

Texts of a block lie in a row, words as numbers, with a number of its own after each text. The suffix
array is made by doubling, which gives for each power of two l the classes of equal stretches of l words:
a class is an interval of the suffix array, the occurrences of its stretch. A wavelet tree over the suffix
array answers range-successor queries: the first occurrence of an interval after a place. On each level l
the dyadic blocks of l words, which start at every l/2 words, look for their next occurrence in the
neighbouring window of l words.

Why this finds every run: let a run have period q, and l be the power of two with l/2 < q <= l. One of the
blocks of l words starts in the run's first l/2 words; it and its next period end before the run does, as
the run has four periods. Its occurrences inside the run are a progression of step q, since q is the
smallest period and the block is no shorter; so the range successor is q words on. Every such step is a
candidate period. The stretch around the block that keeps it is found by comparing classes, level by level,
to the right and to the left. Had it a smaller period, the block would have occurred sooner; so the step
is its smallest.

Blocks whose first word, or whose half, does not occur again near enough need no query. A text is handled by
one task, in a block of a megabyte or alone; it takes up to fifty times its size, since arrays are kept for
each level and each bit of a place (a text of 19 MB took 0.8 GB).

Null texts have no words, and empty texts neither: no runs. Repeated rows are each judged. Other columns
are kept; those named like a result are replaced. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from visitlens.llm.common import blocks
from visitlens.llm.hashing import joined_words, words

LEAST_LENGTH = 6
LEAST_EXPONENT = 4

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(RUN)),
    T.StructField("collapsed", T.BinaryType()),
]
_ARROW_RUNS = pa.list_(pa.struct([(field.name, pa.int64()) for field in RUN]))


class Classes(NamedTuple):
    """The suffix array of a row of numbers, and for each level k the class of the stretch of 2**k numbers
    at each place: the first place of its interval in the suffix array, or of a wider stretch's, where
    the stretch occurs once."""

    order: np.ndarray
    levels: list[np.ndarray]


def classes_of(numbers: np.ndarray) -> Classes:
    """By doubling; only stretches that still occur twice are sorted again. The last number must be the
    lowest and occur once."""
    n = len(numbers)
    order = np.argsort(numbers, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.r_[True, numbers[order][1:] != numbers[order][:-1]]

    def first_places() -> np.ndarray:
        return np.maximum.accumulate(np.where(new, np.arange(n), 0))

    rank[order] = first_places()
    levels, width = [rank.astype(np.int32)], 1
    while not new.all():
        open_ = np.flatnonzero(~(new & np.r_[new[1:], True]))
        rows = order[open_]
        key = rank[rows] * np.int64(n) + rank[np.minimum(rows + width, n - 1)]
        part = np.argsort(key, kind="stable")
        order[open_] = rows[part]
        key = key[part]
        new[open_] |= np.r_[True, key[1:] != key[:-1]]
        rank[order] = first_places()
        levels.append(rank.astype(np.int32))
        width *= 2
    return Classes(order, levels)


class RangeSuccessor:
    """A wavelet tree over different numbers 0 to n - 1: the smallest number in an interval of places that is not
    below a bound."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, (len(values) - 1).bit_length())
        self.ones_before: list[np.ndarray] = []
        self.zeros: list[int] = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            self.ones_before.append(np.r_[0, np.cumsum(ones, dtype=np.int32)].astype(np.int32))
            self.zeros.append(int(len(values) - ones.sum()))
            values = np.r_[values[~ones], values[ones]]

    def _below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many numbers of each interval are below its bound."""
        found = np.zeros(len(low), np.int64)
        for level, (ones, zeros) in enumerate(zip(self.ones_before, self.zeros)):
            one = (bound >> (self.bits - 1 - level) & 1).astype(bool)
            a, b = ones[low], ones[high]
            found += np.where(one, (high - low) - (b - a), 0)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return found

    def _smallest(self, low: np.ndarray, high: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The number with so many smaller ones in each interval."""
        found = np.zeros(len(low), np.int64)
        for ones, zeros in zip(self.ones_before, self.zeros):
            a, b = ones[low], ones[high]
            left = (high - low) - (b - a)
            one = place >= left
            found = found << 1 | one
            place = np.where(one, place - left, place)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return found

    def __call__(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray, none: int) -> np.ndarray:
        """``none`` where no number of an interval [low, high) is as large as its bound."""
        below = self._below(low, high, bound)
        some = np.flatnonzero(below < high - low)
        found = np.full(len(low), none, np.int64)
        found[some] = self._smallest(low[some], high[some], below[some])
        return found


def _agreement(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many numbers agree from places a and b to the right (step 1), or to the left of them (-1)."""
    found = np.zeros(len(a), np.int64)
    n = len(levels[0])
    for level in range(len(levels) - 1, -1, -1):
        width, classes = 1 << level, levels[level]
        left, right = (a + found, b + found) if step > 0 else (a - found - width, b - found - width)
        inside = (np.minimum(left, right) >= 0) & (np.maximum(left, right) < n)
        # Places outside are read as some place inside, and count as different.
        same = inside & (classes[np.where(inside, left, 0)] == classes[np.where(inside, right, 0)])
        found += np.where(same, width, 0)
    return found


def runs_of(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs in a row of numbers, by start and then period."""
    n = len(numbers)
    order, levels = classes_of(numbers)
    successor = RangeSuccessor(order)
    # A bound from below on how far on the block at a place occurs again: first that of its first number.
    by_number = np.argsort(numbers, kind="stable")
    again = np.full(n, n, np.int64)
    same = numbers[by_number][1:] == numbers[by_number][:-1]
    again[by_number[:-1][same]] = np.diff(by_number)[same]
    found = []
    for level, classes in enumerate(levels):
        width = 1 << level
        at = np.arange(0, n, max(1, width // 2))
        at = at[again[at] <= width]
        if level:
            # The interval of a class ends where the next one begins.
            size = np.bincount(classes, minlength=n)
            low = classes[at].astype(np.int64)
            twice = size[low] > 1
            at, low = at[twice], low[twice]
            again[at] = successor(low, low + size[low], at + 1, 2 * n) - at
            at = at[again[at] <= width]
        period = again[at]
        # Smaller periods have been found by shorter blocks.
        at, period = at[2 * period > width], period[2 * period > width]
        if not len(at):
            continue
        # Blocks of one stretch lie at a distance in which the stretch that keeps the period still goes on.
        right = _agreement(levels, at, at + period, 1)
        left = _agreement(levels, at, at + period, -1)
        start, length = at - left, left + right + period
        long = (length >= LEAST_LENGTH) & (length >= LEAST_EXPONENT * period)
        found.append(np.stack([start, length, period], axis=1)[long])
    every = np.unique(np.concatenate([*found, np.zeros((0, 3), np.int64)]), axis=0)
    every = every[np.lexsort((every[:, 2], every[:, 0]))]
    return every[:, 0], every[:, 1], every[:, 2]


def _numbered(data: np.ndarray, first: np.ndarray, end: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of texts as numbers, equal ones alike, with a number of its own after each text, and where each text
    begins. The last number is the lowest."""
    n_texts = len(counts) - 1
    inside = np.zeros(len(data) + 1, np.int8)
    inside[first] += 1
    inside[end] -= 1
    letters = data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
    ends = np.r_[0, np.cumsum(end - first)]
    listed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    own = listed.dictionary_encode().indices.to_numpy().astype(np.int64)
    begin = counts + np.arange(n_texts + 1)
    numbers = np.empty(len(own) + n_texts + 1, np.int64)
    text = np.repeat(np.arange(n_texts), np.diff(counts))
    numbers[np.arange(len(own)) + text] = own + 1 + n_texts
    numbers[begin[1:] - 1] = np.arange(1, n_texts + 1)
    numbers[-1] = 0
    return numbers, begin


def found(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length, period) by start and period, and ``collapsed``, the words joined
    by one space in UTF-8, without those after the first period of each run."""
    names = {field.name for field in FIELDS}
    rest = [field for field in docs.schema if field.name not in names or field.name == text]
    given = docs.select(*[f"`{field.name}`" for field in rest])
    columns = to_arrow_schema(given.schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, names=columns)
            for row, stop, data, starts in blocks(batch, text):
                first, end, _, counts = words(data, starts)
                numbers, begin = _numbered(data, first, end, counts)
                start, length, period = runs_of(numbers)
                of = np.searchsorted(begin, start, side="right") - 1
                # Words after the first period of a run go.
                change = np.zeros(len(first) + 1, np.int64)
                np.add.at(change, start - of + period, 1)
                np.add.at(change, start - of + length, -1)
                collapsed = joined_words(data, first, end, np.cumsum(change)[:-1] == 0, counts)
                runs: list[list[dict]] = [[] for _ in range(stop - row)]
                for i, *run_of in zip(of.tolist(), (start - begin[of]).tolist(), length.tolist(), period.tolist()):
                    runs[i].append(dict(zip(RUN.names, run_of)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.slice(row, stop - row).columns,
                        pa.array(np.diff(counts).astype(np.int64)),
                        pa.array(runs, _ARROW_RUNS),
                        collapsed.cast(pa.binary()),
                    ],
                    names=[*columns, *(field.name for field in FIELDS)],
                )

    return given.mapInArrow(run, T.StructType([*rest, *FIELDS]))
