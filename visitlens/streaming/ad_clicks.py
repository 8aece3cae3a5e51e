"""The ad-click stream: one line of text per click, typed.

A line is ``epochMillis province city userId adId`` with one space between. Only the
line, its topic and its brokers are declared with the inputs; the reader is ours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Fixed value: the topic the lines are sent to.
TOPIC = "AdRealTimeLog1"

# The numbers of a line in order, and the largest time, in milliseconds, that fits microseconds.
NAMES = ["millis", "province", "city", "user_id", "ad_id"]
MOST_MILLIS = (2**63 - 1) // 1000


def kafka_lines(spark: SparkSession, brokers: str, topic: str = TOPIC, **options: str) -> DataFrame:
    """Lines from Kafka. Needs Spark's Kafka connector on the class path.

    ``options`` are the connector's own, such as ``maxOffsetsPerTrigger`` to bound a batch.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .options(**options)
        .load()
        .select(F.col("value").cast("string"))
    )


def text_lines(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """Lines from text files dropped into a folder."""
    return spark.readStream.options(**options).text(folder)


def _typed(lines: DataFrame) -> DataFrame:
    """Lines with the numbers they hold, and ``reason``, null for a click.

    A time must fit microseconds, in which Spark keeps it; beyond that its conversion raises,
    and one line would end a stream for good.
    """
    numbers = [f"try_cast(get(token, {i}) as bigint) as {name}" for i, name in enumerate(NAMES)]
    complete = " and ".join(f"{name} is not null" for name in NAMES)
    return (
        lines.selectExpr("value", "split(value, ' ') as token")
        .selectExpr("value", "token", *numbers)
        .selectExpr(
            "value",
            *NAMES,
            f"""case when value is null or size(token) <> 5 then 'tokens'
                     when not ({complete}) then 'number'
                     when millis not between -{MOST_MILLIS} and {MOST_MILLIS} then 'time' end as reason""",
        )
    )


def parse_ad_lines(lines: DataFrame) -> DataFrame:
    """Typed clicks from a ``value`` column, streaming or not. Other lines are left to
    ``rejected_ad_lines``.

    Row by row and stateless: no shuffle, no state store.
    """
    clicks = _typed(lines).where("reason is null")
    return clicks.selectExpr("timestamp_millis(millis) as ts", "province", "city", "user_id", "ad_id")


def rejected_ad_lines(lines: DataFrame) -> DataFrame:
    """The lines that are no clicks, streaming or not, with the reason: tokens, number or time."""
    return _typed(lines).where("reason is not null").select("value", "reason")


def append_to_folder(
    clicks: DataFrame, folder: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append clicks to Parquet files, exactly once.

    Runs a batch ``every`` interval ("10 seconds") until stopped, or without one takes
    what has arrived and ends. Offsets and commits are kept under ``checkpoint``, so a
    run that loses its driver or executors goes on where it stopped.
    """
    writer = (
        clicks.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
