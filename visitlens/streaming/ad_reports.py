"""Reports over the stream of ad clicks: counts by window, repeated clicks, users over a daily limit.

Extensions of ours: only the click line is declared with the inputs. All take typed clicks
(ts, province, city, user_id, ad_id), keep state per key, and forget it by a watermark, so state is bounded by
the clicks of the time that may still come late.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: How much later than the latest click a click may come and still count.
LATE = "1 hour"
#: The day of a click in UTC, whatever the session's time zone.
DAY = "date_add(date'1970-01-01', cast(floor(unix_seconds(ts) / 86400) as int))"
CLICK = ["ts", "province", "city", "user_id", "ad_id"]

# The setting of the state store, and the store that keeps several values and timers per key.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession, provider: str = ROCKSDB) -> Iterator[None]:
    """Streams started here keep their state in another store."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, provider)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def clicks_per_window(clicks: DataFrame, length: str = "10 minutes", late: str = LATE) -> DataFrame:
    """Clicks by window of event time, province, city and ad, streaming or not.

    Counted in tasks before the only shuffle, so an ad that has a third of all clicks is one row per window,
    place and task there. State is one number per key of a window that may still change.
    """
    window = F.window("ts", length).alias("window")
    counted = clicks.withWatermark("ts", late).groupBy(window, "province", "city", "ad_id").agg(F.count("*").alias("clicks"))
    return counted.selectExpr("window.start as window_start", "province", "city", "ad_id", "clicks")


def first_clicks(clicks: DataFrame, late: str = LATE) -> DataFrame:
    """A stream of clicks without those that are equal in all columns to an earlier one, for producers that send again
    what they do not know to have arrived. State is one row per click of the last ``late``."""
    return clicks.withWatermark("ts", late).dropDuplicatesWithinWatermark(CLICK)


def over_limit(clicks: DataFrame, limit: int) -> DataFrame:
    """For a table of clicks: user_id, ad_id, day, and ``reached_at``, the time of a user's click on an ad that was
    one more than ``limit`` that day. Each task keeps the first ``limit + 1`` clicks of a key before the shuffle."""
    order = "row_number() over (partition by user_id, ad_id, day order by ts)"
    placed = clicks.selectExpr("user_id", "ad_id", f"{DAY} as day", "ts").selectExpr("*", f"{order} as place")
    return placed.where(f"place <= {limit + 1}").where(f"place = {limit + 1}").selectExpr(
        "user_id", "ad_id", "day", "ts as reached_at"
    )


class DailyLimit(StatefulProcessor):
    """Tells once a day of a user who clicks an ad more than ``limit`` times. Keeps the earliest ``limit + 1`` times of a
    key until the day is over by the watermark."""

    fields = "user_id long, ad_id long, day date, micros long"

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kind = T.StructType([T.StructField("micros", T.ArrayType(T.LongType())), T.StructField("told", T.BooleanType())])
        self.seen = handle.getValueState("seen", kind)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.seen.exists()
        micros, told = self.seen.get() if known else ([], False)
        micros = list(micros)
        for part in rows:
            micros = sorted(micros + part["micros"].tolist())[: self.limit + 1]
        if not known:
            # The day's end in milliseconds of UTC.
            end = pd.Timestamp(key[2]) + pd.Timedelta(days=1)
            self.handle.registerTimer(end.value // 1_000_000)
        over = len(micros) > self.limit
        self.seen.update((micros, told or over))
        if over and not told:
            yield pd.DataFrame({"user_id": [key[0]], "ad_id": [key[1]], "day": [key[2]], "micros": [micros[-1]]})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def over_limit_stream(clicks: DataFrame, limit: int, late: str = LATE) -> DataFrame:
    """As ``over_limit`` for a stream, in one row as soon as a user is over the limit. ``reached_at`` is among
    the clicks that have arrived by then. Needs ``state_store``."""
    keyed = clicks.withWatermark("ts", late).selectExpr(
        "user_id", "ad_id", f"{DAY} as day", "ts", "unix_micros(ts) as micros"
    )
    reached = keyed.groupBy("user_id", "ad_id", "day").transformWithStateInPandas(
        DailyLimit(limit), DailyLimit.fields, "append", "eventTime"
    )
    return reached.selectExpr("user_id", "ad_id", "day", "timestamp_micros(micros) as reached_at")


def changes_to_folder(rows: DataFrame, folder: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write what each batch changed to ``folder/batch=<id>``. A batch that runs again after a failure replaces its own
    folder, so ``latest`` sees every change once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    writer = rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def latest(spark: SparkSession, folder: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """For each key its row in the last batch that changed it."""
    every = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    values = [name for name in schema.names if name not in keys]
    last = F.max_by(F.struct(*values), "batch").alias("last")
    found = spark.read.schema(every).parquet(folder).groupBy(*keys).agg(last)
    return found.select(*keys, "last.*").select(*schema.names)


def late_rows(query: StreamingQuery) -> int:
    """How many rows the recent batches of a query left out because they came after the watermark."""
    return sum(
        state["numRowsDroppedByWatermark"] for progress in query.recentProgress for state in progress["stateOperators"]
    )
