import random
from contextlib import contextmanager

import pytest
from pyspark.sql import SparkSession

from visitlens.schemas import ACTIONS, USERS


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@contextmanager
def settings(spark, values):
    """The session with other settings for a while."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def action(session, time, user=1, page=1, keyword=None, click=-1, order=None, pay=None, date=None):
    """One row of ``user_visit_action``."""
    return (
        date or time.split(" ")[0],
        user,
        session,
        page,
        time,
        keyword,
        click,
        click,
        order,
        order,
        pay,
        pay,
        0,
    )


@pytest.fixture(scope="session")
def crowded():
    """Random actions where one session, one user and one hour each hold a third or more."""
    rng = random.Random(5)
    rows = []
    for i in range(2400):
        hot = i % 3 == 0
        session = "hot" if hot else f"s{rng.randrange(150)}"
        user = 1 if hot or int(session[1:]) % 3 == 0 else 2 + int(session[1:]) % 12
        day, hour = 1 + rng.randrange(3), 9 if rng.random() < 0.5 else rng.randrange(24)
        time = f"2024-01-0{day} {hour}:{rng.randrange(4):02d}:{rng.randrange(60):02d}"
        kind = rng.choice(["search", "click", "order", "pay", "page"])
        ids = ",".join(str(rng.randrange(30)) for _ in range(rng.choice([1, 1, 2, 3])))
        rows.append(
            action(
                session,
                time,
                user=-1 if rng.random() < 0.1 else user,
                page=rng.randrange(6),
                keyword=rng.choice(["kw1", "kw10", "", "kw2"]) if kind == "search" else None,
                click=(7 if hot else rng.randrange(30)) if kind == "click" else -1,
                order=ids if kind == "order" else None,
                pay=ids if kind == "pay" else None,
            )
        )
    return rows


@pytest.fixture(scope="session")
def crowded_actions(spark, crowded):
    return spark.createDataFrame(crowded, ACTIONS).repartition(4).cache()


@pytest.fixture(scope="session")
def profiles():
    """User 13 has no profile and user 2 has two."""
    users = [(i, f"u{i}", f"n{i}", 18 + 3 * i, f"job{i % 3}", f"city{i % 4}", "male") for i in range(1, 13)]
    return [*users, (2, "u2", "n2", 30, "job9", "city9", "female")]


@pytest.fixture(scope="session")
def users(spark, profiles):
    return spark.createDataFrame(profiles, USERS).cache()
