"""Reports over the click stream: two runs each, with a restart from the checkpoint, late and repeated clicks."""

import datetime

import pytest

from visitlens.sinks.shared import shared_folder
from visitlens.streaming import ad_reports
from visitlens.streaming.ad_clicks import append_to_folder, parse_ad_lines, text_lines

DAY = 1704067200000
MINUTE = 60_000


def lines(clicks):
    return "".join(f"{DAY + minute * MINUTE} 1 2 {user} {ad}\n" for minute, user, ad in clicks)


def clicks_of(spark, folder):
    return parse_ad_lines(text_lines(spark, str(folder), maxFilesPerTrigger="1"))


def test_counts_go_on_after_a_restart_and_late_clicks_are_left_out(spark, tmp_path):
    folder = shared_folder(spark)

    def run():
        counted = ad_reports.clicks_per_window(clicks_of(spark, tmp_path), "10 minutes", "30 minutes")
        query = ad_reports.changes_to_folder(counted, f"{folder}/out", f"{folder}/progress")
        query.awaitTermination()
        keys = ["window_start", "province", "city", "ad_id"]
        found = ad_reports.latest(spark, f"{folder}/out", counted.schema, keys)
        rows = found.selectExpr(f"(unix_millis(window_start) - {DAY}) div {MINUTE} as minute", "ad_id", "clicks").collect()
        return sorted(map(tuple, rows)), ad_reports.late_rows(query)

    (tmp_path / "a.txt").write_text(lines([(0, 1, 5), (3, 2, 5), (12, 1, 5), (12, 1, 6)]))
    assert run() == ([(0, 5, 2), (10, 5, 1), (10, 6, 1)], 0)
    # Within half an hour of the latest click, so its window is counted on.
    (tmp_path / "b.txt").write_text(lines([(4, 3, 5), (70, 1, 5)]))
    assert run() == ([(0, 5, 3), (10, 5, 1), (10, 6, 1), (70, 5, 1)], 0)
    # Now the first window is closed.
    (tmp_path / "c.txt").write_text(lines([(5, 3, 5), (71, 1, 5)]))
    assert run() == ([(0, 5, 3), (10, 5, 1), (10, 6, 1), (70, 5, 2)], 1)


def test_windows_of_a_table_are_counted_in_tasks_first(spark):
    clicks = parse_ad_lines(spark.createDataFrame([(x,) for x in lines([(0, 1, 5)] * 9).splitlines()], "value string"))
    found = ad_reports.clicks_per_window(clicks)
    assert [r.clicks for r in found.collect()] == [9]
    assert "partial_count" in found._jdf.queryExecution().executedPlan().toString()


def test_clicks_sent_again_are_left_out_over_two_runs(spark, tmp_path):
    folder = shared_folder(spark)

    def run():
        first = ad_reports.first_clicks(clicks_of(spark, tmp_path), "30 minutes")
        append_to_folder(first, f"{folder}/out", f"{folder}/progress").awaitTermination()
        found = spark.read.parquet(f"{folder}/out")
        return sorted(map(tuple, found.selectExpr(f"(unix_millis(ts) - {DAY}) div {MINUTE}", "user_id", "ad_id").collect()))

    (tmp_path / "a.txt").write_text(lines([(1, 1, 5), (1, 1, 5), (1, 2, 5)]))
    assert run() == [(1, 1, 5), (1, 2, 5)]
    (tmp_path / "b.txt").write_text(lines([(1, 2, 5), (1, 1, 6), (9, 1, 5)]))
    assert run() == [(1, 1, 5), (1, 1, 6), (1, 2, 5), (9, 1, 5)]


def test_users_over_the_limit_are_told_once_a_day(spark, tmp_path):
    folder = shared_folder(spark)

    def run():
        with ad_reports.state_store(spark):
            reached = ad_reports.over_limit_stream(clicks_of(spark, tmp_path), 2, "30 minutes")
            append_to_folder(reached, f"{folder}/out", f"{folder}/progress").awaitTermination()
        rows = spark.read.parquet(f"{folder}/out").selectExpr(
            "user_id", "ad_id", "day", f"(unix_millis(reached_at) - {DAY}) div {MINUTE} as minute"
        )
        return sorted(map(tuple, rows.collect()))

    first, second = datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)
    (tmp_path / "a.txt").write_text(lines([(1, 1, 5), (2, 1, 5), (1, 2, 5), (2, 2, 5), (9, 2, 5), (3, 1, 6)]))
    assert run() == [(2, 5, first, 9)]
    # Goes on with what it knows; told users are not told again.
    (tmp_path / "b.txt").write_text(lines([(5, 1, 5), (10, 2, 5)]))
    assert run() == [(1, 5, first, 5), (2, 5, first, 9)]
    # A day later the count begins anew.
    (tmp_path / "c.txt").write_text(lines([(1445 + i, 1, 5) for i in range(3)]))
    (tmp_path / "d.txt").write_text(lines([(1600, 3, 5)]))
    assert run() == [(1, 5, first, 5), (1, 5, second, 1447), (2, 5, first, 9)]


@pytest.mark.parametrize("limit", [0, 1, 4])
def test_users_over_the_limit_of_a_table(spark, limit):
    given = [(i * 7 % 60, i % 3, i % 2) for i in range(40)] + [(1450, 1, 1)] * 3
    clicks = parse_ad_lines(spark.createDataFrame([(x,) for x in lines(given).splitlines()], "value string"))
    wanted = []
    for user in range(3):
        for ad in range(2):
            for day in (0, 1):
                own = sorted(m for m, u, a in given if (u, a, m // 1440) == (user, ad, day))
                if len(own) > limit:
                    wanted.append((user, ad, day + 1, own[limit]))
    found = ad_reports.over_limit(clicks, limit)
    rows = found.selectExpr("user_id", "ad_id", "day(day)", f"(unix_millis(reached_at) - {DAY}) div {MINUTE}").collect()
    assert sorted(map(tuple, rows)) == sorted(wanted)
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()
