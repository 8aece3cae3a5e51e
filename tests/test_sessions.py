from dataclasses import replace

from brute import sessions as expected_sessions
from conftest import action
from visitlens.operators.histograms import (
    session_stat_ratio,
    step_length_histogram,
    visit_length_histogram,
)
from visitlens.operators.sessions import as_session_record, filtered_records, filtered_sessions, value_lists
from visitlens.operators.sampling import hourly_counts
from visitlens.operators.unreadable import unreadable_values
from visitlens.params import TaskParams
from visitlens.schemas import ACTIONS, RATIOS, SESSION_RECORD, USERS

ALL = TaskParams("2024-01-01", "2024-01-31")


def rows(df):
    return sorted((row.asDict() for row in df.collect()), key=repr)


def test_records_match_brute_force(crowded, profiles, crowded_actions, users):
    found = as_session_record(filtered_records(crowded_actions, users, ALL))
    assert {f.name: f.dataType for f in found.schema} == {f.name: f.dataType for f in SESSION_RECORD}
    assert rows(found) == sorted(expected_sessions(crowded, profiles), key=repr)


def test_totals_agree_with_records(crowded_actions, users):
    params = replace(ALL, keywords=("kw1", "nope"), category_ids=(3, 7), start_age=20, end_age=45)
    columns = ["session_id", "user_id", "start_ts", "visit_length", "step_length", "age"]
    totals = rows(filtered_sessions(crowded_actions, users, params).select(columns))
    assert totals
    assert totals == rows(filtered_records(crowded_actions, users, params).select(columns))


def ids(actions, users, params):
    """Sessions that pass, which must not depend on whether value lists are built."""
    totals, records = (
        sorted(row.session_id for row in build(actions, users, params).select("session_id").collect())
        for build in (filtered_sessions, filtered_records)
    )
    assert totals == records
    return totals


def test_filters(spark):
    april = TaskParams("2019-04-01", "2019-04-30")
    profiles = [
        (1, "u", "n", 20, "cook", "A", "male"),
        (2, "u", "n", 51, "-1", "B", "female"),
        (3, "u", "n", None, None, None, None),
    ]
    actions = [
        action("searched", "2019-04-22 5:08:33", user=1, keyword="kw10"),
        action("searched", "2019-04-22 15:08:33", user=1, keyword="tea"),
        action("clicked", "2019-04-30 00:00:00", user=2, click=10),
        action("clicked", "2019-04-30 00:00:01", user=2, keyword="-1"),
        action("ordered", "2019-04-01 1:00:00", user=3, order="10"),
        action("too_late", "2019-05-01 00:00:00", user=1, keyword="kw10"),
        action("nobody", "2019-04-02 1:00:00", user=9, keyword="kw10"),
    ]
    everyone = ["clicked", "ordered", "searched"]
    cases = [
        ({}, everyone),
        ({"start_age": 21}, everyone),
        ({"start_age": 20, "end_age": 51}, ["clicked", "searched"]),
        ({"start_age": 21, "end_age": 51}, ["clicked"]),
        ({"professionals": ("cook", "-1")}, ["searched"]),
        ({"cities": ("B", "C")}, ["clicked"]),
        ({"cities": ()}, []),
        ({"sex": "female"}, ["clicked"]),
        ({"keywords": ("kw1",)}, []),
        ({"keywords": ("kw10", "-1")}, ["searched"]),
        ({"keywords": ()}, []),
        ({"category_ids": (1, 10)}, ["clicked"]),
        ({"category_ids": (1,)}, []),
        ({"category_ids": (10,), "sex": "male"}, []),
    ]
    actions = spark.createDataFrame(actions, ACTIONS)
    users = spark.createDataFrame(profiles, USERS)
    for changes, passing in cases:
        assert ids(actions, users, replace(april, **changes)) == passing, changes


def test_one_digit_hour_is_earlier(spark):
    actions = [
        action("s", "2019-04-22 15:08:33", user=-1),
        action("s", "2019-04-22 5:08:33", user=4),
    ]
    profiles = [(4, "u", "n", 20, "cook", "A", "male")]
    found = filtered_sessions(
        spark.createDataFrame(actions, ACTIONS),
        spark.createDataFrame(profiles, USERS),
        TaskParams("2019-04-22", "2019-04-22"),
    ).collect()
    assert [(row.user_id, row.visit_length, row.step_length) for row in found] == [(4, 36000, 2)]
    assert str(found[0].start_ts) == "2019-04-22 05:08:33"


VISITS = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
STEPS = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 61, 61, 61, 61, 61, 61, 61]


def test_bucket_edges(spark):
    lengths = spark.createDataFrame(list(zip(VISITS, STEPS)), "visit_length long, step_length long")
    visits = {row.bucket: row.sessions for row in visit_length_histogram(lengths).collect()}
    assert visits == {
        "1s_3s": 2, "4s_6s": 2, "7s_9s": 2, "10s_30s": 2, "30s_60s": 2,
        "1m_3m": 2, "3m_10m": 2, "10m_30m": 2, "30m": 1,
    }
    steps = {row.bucket: row.sessions for row in step_length_histogram(lengths).collect()}
    assert steps == {"1_3": 2, "4_6": 2, "7_9": 2, "10_30": 2, "30_60": 2, "60": 8}
    assert sum(visits.values()) + 1 == sum(steps.values()) == len(VISITS)
    stats = session_stat_ratio(lengths, "t")
    assert [(f.name, f.dataType) for f in stats.schema] == [(f.name, f.dataType) for f in RATIOS]
    row = stats.collect()[0]
    assert (row.taskid, row.session_count) == ("t", 18)
    assert (row.visit_length_1s_3s_ratio, row.visit_length_30m_ratio, row.step_length_60_ratio) == (0.11, 0.06, 0.44)


def test_ratio_rounds_half_up_on_the_decimal_form(spark):
    lengths = spark.range(200).selectExpr("if(id < 57, 2L, 0L) as visit_length", "1L as step_length")
    assert session_stat_ratio(lengths, "t").collect()[0].visit_length_1s_3s_ratio == 0.29


def test_no_session_passes(crowded_actions, users):
    nobody = replace(ALL, cities=())
    row = session_stat_ratio(filtered_sessions(crowded_actions, users, nobody), "t").collect()[0]
    assert row.session_count == 0
    assert set(row[2:]) == {0.0}


def test_a_hot_session_is_split_by_its_values(spark):
    """At default settings and in two input partitions: the list step gets a row per distinct
    pair and task, and the step before is dealt out by session and value."""
    rows = spark.range(0, 30_000, 1, 2).selectExpr(
        "concat('hot', id * 0) as session_id", "concat('k', id % 500) as search_keyword", "id % 1 - 1 as click_category_id"
    )
    lists = value_lists(rows, ["session_id"])
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "spark_partition_id" not in plan.lower()
    assert any("keyword" in line and "category_id" in line for line in plan.split("\n") if "Exchange hashpartitioning" in line)
    assert len(lists.collect()[0].search_keywords) == 500


def test_times_that_cannot_be_read(spark):
    """They count as steps, and say nothing of start and end; a session without any has neither."""
    actions = [
        action("a", "2019-04-22 25:00:00", date="2019-04-22"),
        action("a", "2019-04-22 5:00:00"),
        action("a", None, date="2019-04-22"),
        action("a", "2019-04-22 5:00:09"),
        action("b", "noon", date="2019-04-22"),
    ]
    profiles = [(1, "u", "n", 20, "cook", "A", "male")]
    found = filtered_sessions(
        spark.createDataFrame(actions, ACTIONS),
        spark.createDataFrame(profiles, USERS),
        TaskParams("2019-04-22", "2019-04-22"),
    )
    got = {row.session_id: (row.visit_length, row.step_length) for row in found.collect()}
    assert got == {"a": (9, 4), "b": (None, 1)}
    assert [(r.hour, r.hour_count) for r in hourly_counts(found).collect()] == [(5, 1)]
    assert session_stat_ratio(found, "t").collect()[0].session_count == 2
    bad = unreadable_values(spark.createDataFrame(actions, ACTIONS)).collect()
    assert [tuple(r) for r in bad] == [(5, 3, 0, 0)]
