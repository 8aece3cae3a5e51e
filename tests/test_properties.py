"""Random small inputs against plain Python."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from brute import convert_rates
from brute import drawn as expected_drawn
from brute import sessions as expected_sessions
from conftest import action
from visitlens.operators.conversion import page_convert_rate
from visitlens.operators.sampling import draw_sessions
from visitlens.operators.sessions import as_session_record, filtered_records, filtered_sessions
from visitlens.params import TaskParams
from visitlens.schemas import ACTIONS

MAY = TaskParams("2024-05-01", "2024-05-31")

actions = st.lists(
    st.builds(
        action,
        session=st.sampled_from(["a", "b", "c", "d"]),
        time=st.builds(
            "2024-05-0{} {}:{:02d}:{:02d}".format,
            st.integers(1, 2),
            st.integers(0, 23),
            st.sampled_from([0, 59]),
            st.sampled_from([0, 1, 59]),
        ),
        user=st.sampled_from([-1, 3]),
        page=st.integers(-1, 4),
        keyword=st.sampled_from([None, "", "x", "xy"]),
        click=st.sampled_from([-1, 0, 10, 9]),
    ),
    min_size=1,
    max_size=40,
)
flows = st.lists(st.integers(0, 4), min_size=2, max_size=5).map(tuple)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=actions, flow=flows, seed=st.sampled_from(["1", "2"]))
def test_random_actions(spark, profiles, users, rows, flow, seed):
    df = spark.createDataFrame(rows, ACTIONS).repartition(3)

    rates = page_convert_rate(df, flow, "t").collect()
    assert {r.page_split: r.convert_rate for r in rates} == convert_rates(rows, flow)

    expected = expected_sessions(rows, profiles)
    found = [row.asDict() for row in as_session_record(filtered_records(df, users, MAY)).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)

    picked = draw_sessions(filtered_sessions(df, users, MAY), seed).collect()
    wanted = expected_drawn(expected, seed, 100) if expected else []
    assert sorted(row.session_id for row in picked) == wanted
