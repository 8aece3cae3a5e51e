from visitlens.functions import times, values


def row(spark, *expressions):
    return tuple(spark.range(1).selectExpr(*expressions).collect()[0])


def test_today_and_yesterday(spark):
    expected = row(spark, "cast(current_date() as string)", "cast(current_date() - 1 as string)")
    assert row(spark, times.today(), times.yesterday()) == expected


def test_text(spark):
    found = row(
        spark,
        values.trim_comma("',a,b,'"),
        values.trim_comma("'a'"),
        values.two_digits("'7'"),
        values.two_digits("'17'"),
        values.two_digits("''"),
        values.two_digits("'123'"),
        values.is_empty("cast(null as string)"),
        values.is_not_empty("''"),
        values.is_not_empty("'x'"),
    )
    assert found == ("a,b", "a", "07", "17", "0", "0123", True, False, True)


def test_times(spark):
    found = row(
        spark,
        times.before("'2019-04-22 5:08:33'", "'2019-04-22 15:08:33'"),
        times.after("'2019-04-22 5:08:33'", "'2019-04-22 15:08:33'"),
        times.seconds_between(times.parse_time("'2019-04-22 5:08:33'"), times.parse_time("'2019-04-22 15:08:33'")),
        times.date_hour(times.parse_time("'2019-04-22 5:08:33'")),
    )
    assert found == (True, False, 36000, "2019-04-22_05")
