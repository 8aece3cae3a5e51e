"""Hard-negative mining with Kronecker-packed products.

For each anchor the positives are the rows of its label with the highest scores, and the hard
negatives of a positive are the best rows of other labels whose score is a given share of the
positive's. A score is the inner product of whole numbers: each component becomes
``floor(scale * x)``.

Scores come from packed products. Several candidates' components, made non-negative by a bias,
lie in separate fields of one wide integer; the sum over components of the anchor's component
times that integer holds all their scores, each in its field, and fields are as wide as the largest
possible sum. So one multiplication per anchor component serves all candidates of the integer. Integers of up to 53
bits are multiplied as doubles, which hold them exactly; where not even one field fits, as
Python's integers of any size. Scores are exact either way.

Anchors are dealt into blocks and all rows into slices. A task gets a block and a slice, anchors
first, then the slice's rows in the order of their ids, and holds the block and the best rows so far;
the slice streams past. Labels deal out nothing, so a label that most rows have is in all tasks.
A first pass finds positives, a second one the negatives in the positives' ranges.

Rows with a null label, a null vector or a component that is null or not finite take no part.
The shorter of two vectors counts as filled with zeros. Ties go to the smaller id; a null id
comes after all others and is no anchor. A row is never its own positive, nor is another of the same
id. Rows that repeat are rows of their own, as anchors too. Scores beyond a long are its bounds.
No anchors give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.common import stored

#: Anchors that a task holds.
ANCHORS = 131_072
#: Anchors and rows of one packed product.
TILE_ANCHORS, TILE_ROWS = 256, 2048
#: Rows of a task's first product; it is small, since without best rows so far every row may be one.
FIRST_ROWS = 128
#: Bits of an integer that a double holds exactly.
EXACT_BITS = 53

LAST = (1 << 63) - 1
LEAST = -(1 << 63)


def whole(vectors: pa.Array, scale: int) -> np.ndarray:
    """Lists of components as rows of whole numbers in doubles; shorter lists are filled with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(sizes) and (sizes == sizes[0]).all():
        return values.reshape(len(sizes), sizes[0])
    rows = np.zeros((len(sizes), int(sizes.max(initial=0))))
    rows[np.arange(rows.shape[1]) < sizes[:, None]] = values
    return rows


def packed_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The inner product of each anchor with each row, from products with packed rows."""
    width, n = min(anchors.shape[1], rows.shape[1]), len(rows)
    anchors, rows = anchors[:, :width], rows[:, :width]
    bias = int(np.abs(rows).max(initial=0))

    def field_bits() -> int:
        """Bits of a field: a sum may be as large as twice the bias times an anchor's components."""
        reach = int(np.abs(anchors).sum(axis=1).max(initial=0))
        return (2 * bias * reach).bit_length() + 1

    bits = field_bits()
    fields, exact = EXACT_BITS // bits, np.int64
    if not fields:
        anchors, rows = (np.frompyfunc(int, 1, 1)(x).astype(object) for x in (anchors, rows))
        bits, fields, exact = field_bits(), 4, object
    in_field = -(-n // fields)
    biased = np.zeros((fields * in_field, width), rows.dtype)
    biased[:n] = rows + bias
    words = sum(part * (1 << bits * i) for i, part in enumerate(np.split(biased, fields)))
    # Half of a field's range makes every field non-negative, so that none borrows from the next.
    half, mask = 1 << (bits - 1), (1 << bits) - 1
    products = (anchors @ words.T).astype(exact)
    products += sum(half << bits * i for i in range(fields))
    extra = (anchors.sum(axis=1) * bias).astype(exact)[:, None] + half
    scores = np.empty((len(anchors), fields * in_field), exact)
    for i in range(fields):
        own = scores[:, i * in_field : (i + 1) * in_field]
        np.bitwise_and(products >> bits * i if i else products, mask, out=own)
        own -= extra
    if exact is object:
        scores = np.clip(scores, LEAST + 1, LAST).astype(np.int64)
    return scores[:, :n]


class Best:
    """The best rows of each place: highest score, then smallest id. Rows must come in the order of
    their ids, so that later ones must have higher scores than the last of a full place."""

    def __init__(self, places: int, most: int):
        self.most = most
        self.least = np.full(places, LEAST)
        self.place, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, place: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        place, score, id_ = (np.concatenate(x) for x in zip((self.place, self.score, self.id), (place, score, id_)))
        order = np.lexsort((id_, -score, place))
        place, score, id_ = place[order], score[order], id_[order]
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.zeros(0, np.int64)
        rank = np.arange(len(place)) - np.repeat(first, np.diff(np.r_[first, len(place)]))
        full = rank == self.most - 1
        self.least[place[full]] = score[full]
        kept = rank < self.most
        self.place, self.score, self.id = place[kept], score[kept], id_[kept]


class Positives:
    """The best rows of each anchor's label."""

    fields = "anchor long, id long, score long"

    def __init__(self, anchors: pa.Table, most: int):
        self.names = anchors.column("anchor").to_numpy()
        self.ids, self.labels = anchors.column("id").to_numpy(), anchors.column("label").to_numpy()
        self.best = Best(len(self.names), most)

    def add(self, start: int, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        part = slice(start, start + len(scores))
        fits = (scores > self.best.least[part, None]) & (labels == self.labels[part, None]) & (ids != self.ids[part, None])
        i, j = np.nonzero(fits)
        if len(i):
            self.best.add(start + i, scores[i, j], ids[j])

    def result(self) -> list[pa.Array]:
        return [pa.array(x) for x in (self.names[self.best.place], self.best.id, self.best.score)]


class Negatives:
    """For each positive of an anchor, the best rows of other labels in the range of its score."""

    fields = "anchor long, place int, id long, score long"

    def __init__(self, anchors: pa.Table, most: int):
        self.names, self.labels = anchors.column("anchor").to_numpy(), anchors.column("label").to_numpy()
        ranges = anchors.column("ranges").combine_chunks()
        self.sizes = np.diff(ranges.offsets.to_numpy())
        self.first = np.cumsum(self.sizes) - self.sizes
        every = ranges.flatten()
        self.numbers, self.low, self.high = (every.field(x).to_numpy() for x in ("place", "low", "high"))
        self.best = Best(len(self.numbers), most)
        self.widest = np.full(len(self.names), LEAST)
        np.maximum.at(self.widest, np.repeat(np.arange(len(self.sizes)), self.sizes), self.high)

    def add(self, start: int, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        n = len(scores)
        own = slice(self.first[start], self.first[start] + int(self.sizes[start : start + n].sum()))
        anchor = np.repeat(np.arange(n), self.sizes[start : start + n])
        above = np.maximum(self.low[own] - 1, self.best.least[own])
        lowest = np.full(n, LAST)
        np.minimum.at(lowest, anchor, above)
        part = slice(start, start + n)
        fits = (scores > lowest[:, None]) & (scores <= self.widest[part, None]) & (labels != self.labels[part, None])
        i, j = np.nonzero(fits)
        # Each of them against every range of its anchor.
        times = self.sizes[start + i]
        i, j = np.repeat(i, times), np.repeat(j, times)
        place = self.first[start + i] + np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
        score = scores[i, j]
        inside = (score > above[place - own.start]) & (score <= self.high[place])
        if inside.any():
            self.best.add(place[inside], score[inside], ids[j[inside]])

    def result(self) -> list[pa.Array]:
        anchor = np.repeat(np.arange(len(self.sizes)), self.sizes)
        place = self.best.place
        found = (self.names[anchor[place]], self.numbers[place].astype(np.int32), self.best.id, self.best.score)
        return [pa.array(x) for x in found]


def searched(anchors: DataFrame, rows: DataFrame, kind: type, most: int, scale: int, n_anchors: int) -> DataFrame:
    """What ``kind`` finds for the anchors among the rows of each slice, a row per anchor, slice and find."""
    spark = rows.sparkSession
    blocks = -(-n_anchors // ANCHORS)
    slices = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // max(1, blocks)))

    def dealt(df: DataFrame, first: int, block: str, slice_: str) -> DataFrame:
        """Rows with the task they go to; anchors before others."""
        task = F.expr(f"cast({block} * {slices} + {slice_} as int)")
        return df.withColumn("first", F.lit(first)).withColumn("task", task)

    each_block = F.explode(F.sequence(F.lit(0), F.lit(max(0, blocks - 1))))
    every = dealt(rows.withColumn("b", each_block), 1, "b", f"pmod(xxhash64(id), {slices})").drop("b")
    each_slice = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    own = dealt(anchors.withColumn("s", each_slice), 0, f"pmod(anchor, {max(1, blocks)})", "s").drop("s")
    cells = own.unionByName(every, allowMissingColumns=True).repartitionById(max(1, blocks * slices), "task")
    given = cells.sortWithinPartitions("first", "id", "label").select(*own.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        found = matrix = None
        size = FIRST_ROWS
        for batch in batches:
            at = batch.column(batch.schema.get_field_index("first")).to_numpy()
            split = int(np.searchsorted(at, 1))
            if split:
                held.append(batch.slice(0, split))
            if split == batch.num_rows or not held:
                continue
            if found is None:
                table = pa.Table.from_batches(held)
                found = kind(table, most)
                matrix = whole(table.column("vector").combine_chunks(), scale)
            ids, labels = (batch.column(batch.schema.get_field_index(x)).to_numpy() for x in ("id", "label"))
            vectors = batch.column(batch.schema.get_field_index("vector"))
            while split < batch.num_rows:
                part = slice(split, min(split + size, batch.num_rows))
                tile = whole(vectors[part], scale)
                for start in range(0, len(matrix), TILE_ANCHORS):
                    scores = packed_scores(matrix[start : start + TILE_ANCHORS], tile)
                    found.add(start, scores, ids[part], labels[part])
                split, size = part.stop, min(2 * size, TILE_ROWS)
        if found is not None:
            yield pa.RecordBatch.from_arrays(found.result(), names=[x.split()[0] for x in kind.fields.split(", ")])

    return given.mapInArrow(run, kind.fields)


def mined(
    vectors: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, ``rank``, negative_id, positive_score and negative_score: for each row whose
    id is divisible by ``every`` and each of its ``positives`` best rows of one label, the ``negatives`` best rows
    of others with ``low * positive_score <= 100 * negative_score <= high * positive_score``."""
    rows = vectors.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).alias("vector"),
    ).filter(
        "label is not null and vector is not null and not exists(vector, x -> x is null or isnan(x) "
        "or abs(cast(x as double)) = double('infinity'))"
    )
    # Rows of one id may differ, so each anchor row has a number of its own.
    numbered = rows.filter(f"id % {every} = 0 and id <> {LAST}").withColumn("anchor", F.monotonically_increasing_id())
    anchors = stored(numbered)
    n_anchors = anchors.count()
    best_first = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    same = (
        searched(anchors, rows, Positives, positives, scale, n_anchors)
        .withColumn("place", F.row_number().over(best_first))
        .filter(F.col("place") <= positives)
    )
    same = stored(same)
    # The whole scores of a range: its ends rounded inwards.
    limits = same.selectExpr(
        "anchor",
        "struct(place, "
        f"cast(ceil(cast(score as decimal(38)) * {low} / 100) as bigint) as low, "
        f"cast(floor(cast(score as decimal(38)) * {high} / 100) as bigint) as high) as range",
    )
    ranges = limits.filter("range.low <= range.high").groupBy("anchor").agg(F.collect_list("range").alias("ranges"))
    others = searched(anchors.join(ranges, "anchor"), rows, Negatives, negatives, scale, n_anchors)
    best_other = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id")
    ranked = others.withColumn("rank", F.row_number().over(best_other)).filter(F.col("rank") <= negatives)
    pairs = same.selectExpr("anchor", "place", "id as positive", "score as positive_score")
    return (
        ranked.join(pairs, ["anchor", "place"])
        .join(anchors.selectExpr("anchor", "id as anchor_id"), "anchor")
        .selectExpr(
            "anchor_id",
            f"nullif(positive, {LAST}) as positive_id",
            "rank",
            f"nullif(id, {LAST}) as negative_id",
            "positive_score",
            "score as negative_score",
        )
    )
