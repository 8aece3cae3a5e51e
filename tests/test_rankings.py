from brute import category_counts
from brute import sessions as expected_sessions
from conftest import action
from visitlens.operators.rankings import top10_category, top10_session, top_categories
from visitlens.operators.sessions import filtered_sessions
from visitlens.params import TaskParams
from visitlens.schemas import ACTIONS, TOP10_CATEGORY, TOP10_SESSION

ADULTS = TaskParams("2024-01-01", "2024-01-31", start_age=20, end_age=48)


def test_match_brute_force(crowded, profiles, crowded_actions, users):
    records = expected_sessions(crowded, profiles)
    kept = {r["sessionid"] for r in records if 20 <= r["age"] <= 48}
    totals, clicks = category_counts(crowded, kept)
    top = sorted(totals, key=lambda c: (-totals[c]["clicks"], -totals[c]["orders"], -totals[c]["pays"], c))[:10]

    sessions = filtered_sessions(crowded_actions, users, ADULTS)
    best = top_categories(crowded_actions, sessions)
    found = top10_category(best, "t")
    assert found.columns == TOP10_CATEGORY.names
    assert sorted((r.categoryid, r.clickCount, r.orderCount, r.payCount) for r in found.collect()) == sorted(
        (c, totals[c]["clicks"], totals[c]["orders"], totals[c]["pays"]) for c in top
    )

    wanted = []
    for category in top:
        ranked = sorted((-n, s) for (c, s), n in clicks.items() if c == category)[:10]
        wanted += [(category, s, -n) for n, s in ranked]
    found = top10_session(crowded_actions, sessions, best, "t")
    assert found.columns == TOP10_SESSION.names
    assert sorted((r.categoryid, r.sessionid, r.clickCount) for r in found.collect()) == sorted(wanted)


def test_odd_ids(spark):
    actions = spark.createDataFrame(
        [
            action("a", "2024-01-01 1:00:00", order="5,,x,6"),
            action("a", "2024-01-01 1:00:01", pay="-1"),
            action("a", "2024-01-01 1:00:02"),
        ],
        ACTIONS,
    )
    sessions = spark.createDataFrame([("a",)], "session_id string")
    best = top_categories(actions, sessions)
    found = {(r.category_id, r.clicks, r.orders, r.pays) for r in best.collect()}
    assert found == {(5, 0, 1, 0), (6, 0, 1, 0), (-1, 0, 0, 1)}
    # -1 as a click id still means no click, even if it leads as a paid category.
    assert top10_session(actions, sessions, best, "t").collect() == []
