"""The whole session job: every output for one task.

    spark-submit --py-files visitlens.zip visitlens/plans/session_job.py \
        --task '{"startDate": "2019-04-01", "endDate": "2019-04-30", "startAge": 20}'
"""

from __future__ import annotations

import argparse
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from visitlens.operators.conversion import page_convert_rate
from visitlens.operators.filters import in_date_range
from visitlens.operators.histograms import session_stat_ratio
from visitlens.operators.rankings import top10_category, top10_session, top_categories
from visitlens.operators.sampling import actions_of, draw_sessions, random_extract, session_detail
from visitlens.operators.sessions import filtered_sessions
from visitlens.params import TaskParams
from visitlens.sinks.shared import removed, shared_folder, written
from visitlens.sinks.tables import append_jdbc, replace_task
from visitlens.sources.tables import Tables, from_catalog


@dataclass(frozen=True)
class SessionOutputs:
    session_stat_ratio: DataFrame
    session_random_extract: DataFrame
    session_detail: DataFrame
    top10_category: DataFrame
    top10_session: DataFrame
    page_convert_rate: DataFrame | None


def session_outputs(
    tables: Tables, params: TaskParams, task_id: str, seed: str, folder: str
) -> SessionOutputs:
    """All outputs of a task.

    The filtered sessions, the drawn sessions, their actions and the top categories feed
    several outputs each. They are written once to ``folder``; without that every output
    would scan and shuffle the actions anew. The caller removes it when the outputs are
    written. The actions are scanned five times: for the sessions, the drawn sessions'
    actions, the top categories, the top sessions, and the conversion.
    """
    actions = in_date_range(tables.actions, params)
    sessions = written(
        filtered_sessions(tables.actions, tables.users, params).select(
            "session_id", "start_ts", "visit_length", "step_length"
        ),
        f"{folder}/sessions",
    )
    drawn = written(draw_sessions(sessions, seed), f"{folder}/drawn")
    drawn_actions = written(actions_of(actions, drawn), f"{folder}/drawn_actions")
    best = written(top_categories(actions, sessions), f"{folder}/best")
    flow = params.target_page_flow
    return SessionOutputs(
        session_stat_ratio=session_stat_ratio(sessions, task_id),
        session_random_extract=random_extract(drawn_actions, drawn, task_id),
        session_detail=session_detail(drawn_actions, task_id),
        top10_category=top10_category(best, task_id),
        top10_session=top10_session(actions, sessions, best, task_id),
        page_convert_rate=page_convert_rate(actions, flow, task_id) if len(flow) > 1 else None,
    )


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Session statistics for one task")
    parser.add_argument("--task", required=True, help="task parameters as JSON")
    parser.add_argument("--database", help="database of the input tables")
    parser.add_argument("--output-database", help="database of the result tables")
    parser.add_argument("--task-id", default=uuid.uuid4().hex)
    parser.add_argument("--seed", help="seed of the sample; the task id by default")
    parser.add_argument("--jdbc-url", help="also append the ratios to this database")
    parser.add_argument("--jdbc-user", default="")
    parser.add_argument("--jdbc-password-file", help="file that holds the password")
    parser.add_argument("--jdbc-driver", help="class of the database's driver")
    parser.add_argument("--shared-folder", help="folder all executors share, for intermediate tables")
    args = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("session").getOrCreate()
    params = TaskParams.from_mapping(json.loads(args.task))
    root = args.shared_folder
    folder = f"{root.rstrip('/')}/{uuid.uuid4().hex}" if root else shared_folder(spark)
    try:
        outputs = session_outputs(
            from_catalog(spark, args.database), params, args.task_id, args.seed or args.task_id, folder
        )
        prefix = f"{args.output_database}." if args.output_database else ""
        for name, result in vars(outputs).items():
            if result is not None:
                replace_task(result, prefix + name)
        if args.jdbc_url:
            password = ""
            if args.jdbc_password_file:
                with open(args.jdbc_password_file) as file:
                    password = file.read().strip()
            append_jdbc(
                outputs.session_stat_ratio, args.jdbc_url, args.jdbc_user, password, driver=args.jdbc_driver
            )
    finally:
        removed(spark, folder)


if __name__ == "__main__":
    main()
