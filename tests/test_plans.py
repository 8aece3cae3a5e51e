"""What the physical plans must and must not hold."""

import re
from collections import Counter

import pytest

from conftest import settings
from visitlens.operators.conversion import page_convert_rate
from visitlens.operators.rankings import top10_session, top_categories
from visitlens.operators.sampling import actions_of, draw_sessions, random_extract
from visitlens.operators.sessions import filtered_sessions, session_totals
from visitlens.params import TaskParams
from visitlens.plans import session_job
from visitlens.plans.registry import all_queries as queries
from visitlens.schemas import ACTIONS, USERS
from visitlens.sinks.shared import written
from visitlens.sources import driver_tables
from visitlens.sources.tables import from_folder

TASK = TaskParams("2024-01-01", "2024-01-04", start_age=20, end_age=50, keywords=("a",), category_ids=(1,))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    for name, schema in (("user_visit_action", ACTIONS), ("user_info", USERS)):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}")
    (tmp_path_factory.getbasetemp() / folder / "product_info").mkdir()
    return from_folder(spark, folder)


@pytest.mark.parametrize("name", sorted(set(queries()) - {"ad_click_stream"}))
def test_no_cross_or_nested_loop_join_and_no_python(spark, name):
    text = plan(queries()[name](spark, "/root/testdata/sf0.001"))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in text


def test_filters_and_columns_reach_the_scans(tables):
    text = plan(filtered_sessions(tables.actions, tables.users, TASK).select("visit_length"))
    assert "GreaterThanOrEqual(date,2024-01-01), LessThanOrEqual(date,2024-01-04)" in text
    assert "GreaterThanOrEqual(age,20), LessThanOrEqual(age,50)" in text
    scans = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert "user_id:bigint,age:int" in scans
    assert not any("page_id" in scan or "order" in scan or "username" in scan for scan in scans)


def test_session_totals_are_one_hash_aggregation_without_lists(tables):
    text = plan(session_totals(tables.actions, TASK))
    assert "collect" not in text and "ObjectHashAggregate" not in text
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_count" in text


def test_ranks_are_limited_before_the_shuffle(tables):
    sessions = filtered_sessions(tables.actions, tables.users, TASK)
    assert re.search(r"WindowGroupLimit.*100, Partial", plan(draw_sessions(sessions, "7")))
    best = top_categories(tables.actions, sessions)
    text = plan(top10_session(tables.actions, sessions, best, "t"))
    assert re.search(r"WindowGroupLimit.*10, Partial", text)
    assert "TakeOrderedAndProject" in text


def test_only_the_bounded_sides_are_broadcast_by_hint(tables):
    drawn = draw_sessions(tables.users.selectExpr("name as session_id", "current_timestamp() as start_ts"), "7")
    for df, hints in (
        (filtered_sessions(tables.actions, tables.users, TASK), 0),
        (actions_of(tables.actions, drawn), 1),
        (random_extract(tables.actions, drawn, "t"), 0),
    ):
        logical = df._jdf.queryExecution().analyzed().toString()
        assert logical.count("UnresolvedHint broadcast") + logical.count("ResolvedHint (strategy=broadcast)") == hints


def test_conversion_combines_before_the_shuffle(tables):
    text = plan(page_convert_rate(tables.actions, (1, 2, 3), "t"))
    assert "partial_count" in text
    assert re.search(r"Exchange hashpartitioning\(session_id\S+, tick\S+, \d+\)", text)
    assert not re.search(r"ReadSchema: struct<date|ReadSchema: .*user_id", text)


def scans(df, table):
    """Scans of a table when ``df`` runs; reused exchanges don't scan again."""
    with settings(df.sparkSession, {"spark.sql.maxMetadataStringLength": "1000"}):
        df.collect()
        text = plan(df)
    return text.split("== Initial Plan ==")[0].count(f"/{table}]")


def test_the_job_scans_the_actions_five_times(spark, tmp_path, monkeypatch):
    tables = {"user_visit_action": driver_tables.actions, "user_info": driver_tables.users}
    for name, build in tables.items():
        build(spark, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/{name}")
    found = Counter()

    def counting(df, path):
        found[path.rpartition("/")[2]] += scans(df, "user_visit_action")
        return written(df, path)

    monkeypatch.setattr(session_job, "written", counting)
    task = TaskParams("2024-01-01", "2024-01-04", target_page_flow=(1, 2, 3))
    outputs = session_job.session_outputs(from_folder(spark, str(tmp_path)), task, "t", "7", f"{tmp_path}/shared")
    for name, df in vars(outputs).items():
        found[name] += scans(df, "user_visit_action")
    assert {name: n for name, n in found.items() if n} == {
        "sessions": 1,
        "drawn_actions": 1,
        "best": 1,
        "top10_session": 1,
        "page_convert_rate": 1,
    }
