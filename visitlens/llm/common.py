"""What the operators of this subpackage share: stored steps, exact ranks, text blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlens.sinks.shared import shared_folder, written

#: Text that one step in a task handles at once; longer texts are handled alone.
BLOCK_BYTES = 1 << 20


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps, and executors that
    take over from lost ones, read files instead of running its plan again."""
    return written(df, shared_folder(df.sparkSession))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ranked(df: DataFrame, keys: list[str], order: list[str], name: str, rows: int) -> DataFrame:
    """Adds ``name``, the gapless place of each row from 0 among the rows of its keys.

    The order is that of a hash of ``order`` and then ``order`` itself; rows that agree in
    both take places in any order. A key's rows are numbered in parts of about two
    thousand rows and each part starts where the one before ends, so no task has to hold a key's
    rows, however many. ``rows`` is the number of rows of ``df``.
    """
    parts = max(1, rows // 2_000)
    split = df.withColumn("_part", F.expr(f"pmod(xxhash64({', '.join(order)}), {parts})"))
    at = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        split.groupBy(*keys, "_part")
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(at), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(*order)
    numbered = split.withColumn("_place", F.row_number().over(inside) - 1)
    placed = numbered.join(starts, [*keys, "_part"])
    return placed.withColumn(name, F.col("_start") + F.col("_place")).drop("_part", "_place", "_start")


def often(df: DataFrame, key: str, least: int = 2) -> DataFrame:
    """The values of a long column that at least so many rows have, as ``key``.

    Counted in tasks first. The key is given back from another number, so that a join on it
    deals both sides out itself: only then can Spark split a value that very many rows have.
    """
    counted = df.groupBy(F.col(key).bitwiseXOR(F.lit(1)).alias("_other")).agg(F.count("*").alias("_n"))
    return counted.filter(F.col("_n") >= least).select(F.col("_other").bitwiseXOR(F.lit(1)).alias(key))


#: Names that are listed in a plan as shared. Of 5e10 rows some 70 pairs share 64 bits.
SHARED_NAMES = 10_000


def name_of(keys: list[str], salt: int) -> str:
    """SQL for a row's number by its keys, one of many by a salt."""
    return f"xxhash64({', '.join(keys)}, {salt})"


def named(df: DataFrame, keys: list[str], numbered: Callable[[list[str], int], str] = name_of) -> DataFrame:
    """``df`` with ``name``, one long for each combination of the keys and no other.

    Numbers that different combinations share are counted, and these few get others."""
    pairs = df.select(*keys).distinct()

    def shared(name: Column, most: int) -> list[int]:
        twice = pairs.groupBy(name.alias("name")).agg(F.count("*").alias("n")).filter("n > 1")
        return [row.name for row in twice.select("name").limit(most).collect()]

    name = F.expr(numbered(keys, 0))
    for salt in range(1, 9):
        listed = shared(name, SHARED_NAMES + 1)
        if not listed:
            return df.withColumn("name", name)
        if len(listed) > SHARED_NAMES:
            break
        name = F.when(name.isin(listed), F.expr(numbered(keys, salt))).otherwise(name)
    raise ValueError("more rows share a number than 64 bits explain")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column's texts in a row, and where each text starts and the
    last one ends. A null counts as an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, starts, data = column.buffers()
    starts = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def blocks(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows of a batch whose texts together have up to ``most`` bytes, or one row with more:
    first row, end row, bytes, and the texts' starts in them."""
    data, starts = text_bytes(batch.column(batch.schema.get_field_index(column)))
    first, n = 0, len(starts) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(starts, starts[first] + most, side="right")) - 1)
        yield first, end, data[starts[first] : starts[end]], starts[first : end + 1] - starts[first]
        first = end


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
