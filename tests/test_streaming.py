import pytest

from visitlens.sinks.shared import shared_folder
from visitlens.streaming.ad_clicks import (
    MOST_MILLIS,
    append_to_folder,
    kafka_lines,
    parse_ad_lines,
    rejected_ad_lines,
    text_lines,
)


def test_lines_arrive_once_over_two_runs(spark, tmp_path):
    folder = shared_folder(spark)

    def run():
        clicks = parse_ad_lines(text_lines(spark, str(tmp_path)))
        append_to_folder(clicks, f"{folder}/out", f"{folder}/progress").awaitTermination()
        found = spark.read.parquet(f"{folder}/out").selectExpr(
            "unix_millis(ts)", "province", "city", "user_id", "ad_id"
        )
        return sorted(tuple(row) for row in found.collect())

    # A time beyond microseconds would end the stream for good.
    lines = ["1555900000000 3 3 17 5", "bad line", "1555900000001 x 3 17 5", "1 2 3 4 5 6", ""]
    lines += ["9223372036854775807 1 1 1 1", "-9223372036854775808 1 1 1 1", "99999999999999999999 1 1 1 1"]
    (tmp_path / "one.txt").write_text("\n".join(lines))
    assert run() == [(1555900000000, 3, 3, 17, 5)]
    (tmp_path / "two.txt").write_text("1555900000002 9 9 0 19\n")
    assert run() == [(1555900000000, 3, 3, 17, 5), (1555900000002, 9, 9, 0, 19)]


def test_a_running_stream_takes_new_files(spark, tmp_path):
    folder = shared_folder(spark)
    (tmp_path / "one.txt").write_text("1 2 3 4 5\n")
    clicks = parse_ad_lines(text_lines(spark, str(tmp_path), maxFilesPerTrigger="1"))
    query = append_to_folder(clicks, f"{folder}/out", f"{folder}/progress", every="1 second")
    try:
        query.processAllAvailable()
        (tmp_path / "two.txt").write_text("2 2 3 4 5\n")
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        kafka_lines(spark, "nowhere:9092", maxOffsetsPerTrigger="1000")


def test_every_line_is_a_click_or_rejected_with_a_reason(spark):
    lines = {
        "1 2 3 4 5": None,
        f"{MOST_MILLIS} 2 3 4 5": None,
        f"-{MOST_MILLIS} 2 3 4 5": None,
        f"{MOST_MILLIS + 1} 2 3 4 5": "time",
        "99999999999999999999 2 3 4 5": "number",
        "1 2 3 4 x": "number",
        "1 2  3 4": "number",
        "1 2 3 4": "tokens",
        "": "tokens",
        None: "tokens",
    }
    given = spark.createDataFrame([(line,) for line in lines], "value string")
    rejected = {row.value: row.reason for row in rejected_ad_lines(given).collect()}
    assert rejected == {line: reason for line, reason in lines.items() if reason}
    assert parse_ad_lines(given).selectExpr("unix_micros(ts)").count() == 3
