import pytest

from visitlens.params import TaskParams

DATES = {"startDate": "2019-04-01", "endDate": "2019-04-30"}


def test_blank_and_missing_mean_no_filter():
    blank = TaskParams.from_mapping(
        {**DATES, "startAge": "", "professionals": "", "cities": "", "sex": "", "keywords": "", "categoryIds": ""}
    )
    assert blank == TaskParams.from_mapping(DATES) == TaskParams("2019-04-01", "2019-04-30")


def test_values():
    params = TaskParams.from_mapping(
        {
            **DATES,
            "startAge": 20,
            "endAge": "50",
            "professionals": "a,b",
            "sex": "male",
            "keywords": "x,,y",
            "categoryIds": "1,07,x,20,-5",
            "targetPageFlow": "1,2,3",
        }
    )
    assert (params.start_age, params.end_age) == (20, 50)
    assert params.professionals == ("a", "b")
    assert params.sex == "male"
    assert params.keywords == ("x", "y")
    assert params.category_ids == (1, 20, -5)
    assert params.target_page_flow == (1, 2, 3)


@pytest.mark.parametrize("flow", ["1,x,3", "1,07", "1, 2", "--1", ["1", "²"]])
def test_a_bad_page_of_a_flow_raises(flow):
    with pytest.raises(ValueError, match="targetPageFlow"):
        TaskParams.from_mapping({**DATES, "targetPageFlow": flow})


def test_lists_are_taken_as_they_are():
    params = TaskParams.from_mapping({**DATES, "categoryIds": [1, 20], "cities": ["a"], "keywords": []})
    assert (params.category_ids, params.cities, params.keywords) == ((1, 20), ("a",), None)


def test_only_commas_is_a_filter_nothing_meets():
    assert TaskParams.from_mapping({**DATES, "cities": ","}).cities == ()


@pytest.mark.parametrize("name", DATES)
def test_dates_are_required(name):
    with pytest.raises(ValueError, match=name):
        TaskParams.from_mapping({**DATES, name: ""})
