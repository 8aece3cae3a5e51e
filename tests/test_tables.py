"""Sources, sinks and the whole job."""

import json
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from conftest import settings
from visitlens.plans.registry import SEED, TASK, TASK_ID
from visitlens.plans.session_job import main, session_outputs
from visitlens.schemas import ACTION_TABLE, PRODUCT_TABLE, USER_TABLE, USERS, checked
from visitlens.sinks.shared import shared_folder, written
from visitlens.sinks.tables import append_jdbc, replace_table, replace_task
from visitlens.sources import driver_tables
from visitlens.sources.tables import from_catalog, from_folder

SF_DIR = "/root/testdata/sf0.01"


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.fixture(scope="module")
def saved(spark):
    replace_table(driver_tables.actions(spark, SF_DIR), ACTION_TABLE, partition_by="date")
    replace_table(driver_tables.users(spark, SF_DIR), USER_TABLE)
    replace_table(driver_tables.products(spark, SF_DIR), PRODUCT_TABLE)
    return from_catalog(spark)


def test_job_gives_the_same_outputs_as_the_queries(spark, saved):
    outputs = session_outputs(saved, TASK, TASK_ID, SEED, shared_folder(spark))
    for name, found in vars(outputs).items():
        assert rows(found) == rows(queries()[name](spark, SF_DIR)), name


def test_job_from_the_command_line(spark, saved):
    spark.sql("CREATE DATABASE results")
    task = {"startDate": "2024-01-01", "endDate": "2024-01-04", "startAge": 20, "endAge": 50, "sex": ""}
    common = ["--database", "default", "--output-database", "results", "--seed", SEED]
    # A task that runs again leaves its rows once.
    for task_id in ("a", TASK_ID, TASK_ID):
        main(["--task", json.dumps(task), "--task-id", task_id, *common])
    names = {row.tableName for row in spark.sql("SHOW TABLES IN results").collect()}
    assert names == {
        "session_stat_ratio",
        "session_random_extract",
        "session_detail",
        "top10_category",
        "top10_session",
    }
    for name in names:
        found = spark.table(f"results.{name}")
        mine = found.where(F.col("taskid") == TASK_ID).select(queries()[name](spark, SF_DIR).columns)
        assert rows(mine) == rows(queries()[name](spark, SF_DIR)), name
        assert found.count() == 2 * mine.count()


def test_job_needs_no_products_and_leaves_no_folder(spark, saved, tmp_path):
    spark.sql("CREATE DATABASE two_tables")
    saved.actions.write.saveAsTable("two_tables.user_visit_action")
    saved.users.write.saveAsTable("two_tables.user_info")
    task = {"startDate": "2024-01-01", "endDate": "2024-01-04", "targetPageFlow": "1,2"}
    arguments = ["--task", json.dumps(task), "--task-id", "t", "--database", "two_tables"]
    main([*arguments, "--output-database", "two_tables", "--shared-folder", str(tmp_path)])
    assert spark.table("two_tables.page_convert_rate").count() == 1
    assert list(tmp_path.iterdir()) == []


def test_a_result_table_must_be_partitioned_by_task(spark):
    spark.sql("SELECT 'a' AS taskid, 1 AS n").write.saveAsTable("flat_results")
    with pytest.raises(ValueError, match="partitioned by taskid"):
        replace_task(spark.sql("SELECT 'a' AS taskid, 2 AS n"), "flat_results")


def test_job_over_dates_without_actions(spark, saved):
    empty = replace(TASK, start_date="2030-01-01", end_date="2030-01-31")
    outputs = session_outputs(saved, empty, TASK_ID, SEED, shared_folder(spark))
    assert rows(outputs.session_stat_ratio) == [(TASK_ID, 0, *[0.0] * 15)]
    assert {row.convert_rate for row in outputs.page_convert_rate.collect()} == {0.0}
    for name in ("session_random_extract", "session_detail", "top10_category", "top10_session"):
        assert rows(getattr(outputs, name)) == [], name


def test_date_range_prunes_partitions(spark, saved):
    plan = saved.actions.where("date between '2024-01-02' and '2024-01-03'").select("session_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in text
    assert "ReadSchema: struct<session_id:string>" in text


def test_replace_table_replaces(spark):
    replace_table(spark.range(3), "numbers")
    replace_table(spark.range(5).withColumnRenamed("id", "n"), "numbers")
    assert spark.table("numbers").columns == ["n"]
    assert spark.table("numbers").count() == 5


def test_a_crowded_date_is_written_by_several_tasks(spark, crowded_actions):
    days = crowded_actions.selectExpr(
        "* except (date)", "if(session_id = 's1', '2024-01-09', '2024-01-01') as date"
    )
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}
    with settings(spark, small):
        replace_table(days, "by_date", partition_by="date")
    files = Counter(
        row.file.split("/date=")[1].split("/")[0]
        for row in spark.table("by_date").selectExpr("_metadata.file_path as file").distinct().collect()
    )
    assert files["2024-01-01"] > 1
    assert spark.table("by_date").count() == days.count()


def test_folder_source(spark, users, tmp_path):
    users.write.parquet(f"{tmp_path}/{USER_TABLE}")
    for table, frame in ((ACTION_TABLE, driver_tables.actions), (PRODUCT_TABLE, driver_tables.products)):
        frame(spark, SF_DIR).write.parquet(f"{tmp_path}/{table}")
    found = from_folder(spark, str(tmp_path))
    assert rows(found.users) == rows(users)
    assert found.actions.count() == 10000


def test_schema_is_checked(spark):
    with pytest.raises(ValueError, match="user_info needs user_id bigint"):
        checked(spark.range(1).selectExpr("cast(id as int) as user_id"), USERS, "user_info")


def test_written_table_is_in_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != shared_folder(spark)
    again = written(spark.range(4), f"{folder}/numbers")
    assert sorted(r.id for r in again.collect()) == [0, 1, 2, 3]


def test_jdbc_append_reaches_the_driver_lookup(spark):
    """No database may be started here, so this goes as far as loading the driver class."""
    with pytest.raises(Exception, match="no.such.Driver"):
        append_jdbc(spark.range(1), "jdbc:none:x", "user", "secret", driver="no.such.Driver")


def test_jdbc_append_options():
    class Recorder:
        def __init__(self):
            self.calls = []
            self.write = self

        def __getattr__(self, name):
            def call(*args, **kwargs):
                self.calls.append((name, args, kwargs))
                return self

            return call

    df = Recorder()
    append_jdbc(df, "jdbc:x", "me", "secret")
    options = {"url": "jdbc:x", "user": "me", "password": "secret", "dbtable": "session_stat_ratio"}
    assert df.calls == [
        ("coalesce", (1,), {}),
        ("format", ("jdbc",), {}),
        ("options", (), options),
        ("mode", ("append",), {}),
        ("save", (), {}),
    ]
