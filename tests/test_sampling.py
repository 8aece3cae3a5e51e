from dataclasses import replace

from brute import drawn as expected_drawn
from brute import sessions as expected_sessions
from visitlens.operators.sampling import (
    actions_of,
    draw_sessions,
    random_extract,
    sample_quota,
    session_detail,
)
from visitlens.operators.sessions import filtered_sessions
from visitlens.params import TaskParams
from visitlens.schemas import RANDOM_EXTRACT, SESSION_DETAIL

ALL = TaskParams("2024-01-01", "2024-01-31")


def test_extract_and_detail_match_brute_force(crowded, profiles, crowded_actions, users):
    records = expected_sessions(crowded, profiles)
    for seed in ("7", "8"):
        picked = expected_drawn(records, seed, 100)
        sample = draw_sessions(filtered_sessions(crowded_actions, users, ALL), seed)
        extract = random_extract(actions_of(crowded_actions, sample), sample, "t")
        assert extract.columns == RANDOM_EXTRACT.names
        got = extract.collect()
        assert sorted(row.sessionid for row in got) == picked
        assert 0 < len(picked) <= 100
        by_id = {record["sessionid"]: record for record in records}
        for row in got:
            for name in ("startTime", "searchKeywords", "clickCategoryIds"):
                assert row[name] == by_id[row.sessionid][name]
    detail = session_detail(actions_of(crowded_actions, sample), "t")
    assert detail.columns == SESSION_DETAIL.names
    wanted = sorted((row[2], row[4], row[3]) for row in crowded if row[2] in set(picked))
    assert sorted((r.sessionid, r.actionTime, r.pageid) for r in detail.collect()) == wanted


def test_quota_is_capped_and_truncated(spark):
    starts = spark.range(27).selectExpr(
        # Day one: one session in each of 24 hours. Day two: three sessions in one hour.
        "cast(id as string) as session_id",
        "if(id < 24, timestamp'2024-01-01 00:00:00' + make_dt_interval(0, id),"
        " timestamp'2024-01-02 05:00:00') as start_ts",
    )
    by_day = {}
    for row in sample_quota(starts).collect():
        by_day.setdefault(str(row.date), []).append(row.quota)
    assert by_day == {"2024-01-01": [1] * 24, "2024-01-02": [3]}
    fewer = {}
    for row in sample_quota(starts, size=46).collect():
        fewer.setdefault(str(row.date), set()).add(row.quota)
    assert fewer == {"2024-01-01": {0}, "2024-01-02": {3}}


def test_a_larger_sample_is_drawn_whole(spark):
    starts = spark.range(300).selectExpr("cast(id as string) as session_id", "timestamp'2024-01-02 05:00:00' as start_ts")
    assert draw_sessions(starts, "7", size=250).count() == 250
    assert draw_sessions(starts, "7").count() == 100


def test_nothing_to_draw(crowded_actions, users):
    sessions = filtered_sessions(crowded_actions, users, replace(ALL, cities=()))
    assert draw_sessions(sessions, "7").collect() == []
