"""The three input tables, from a catalog or from files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from visitlens.schemas import (
    ACTION_TABLE,
    ACTIONS,
    PRODUCT_TABLE,
    PRODUCTS,
    USER_TABLE,
    USERS,
    checked,
)


@dataclass(frozen=True)
class Tables:
    """``products`` is looked up when called: no session output needs it."""

    actions: DataFrame
    users: DataFrame
    products: Callable[[], DataFrame]


def from_catalog(spark: SparkSession, database: str | None = None) -> Tables:
    """Tables of the current database, or of ``database``."""
    prefix = f"{database}." if database else ""
    return Tables(
        checked(spark.table(prefix + ACTION_TABLE), ACTIONS, ACTION_TABLE),
        checked(spark.table(prefix + USER_TABLE), USERS, USER_TABLE),
        lambda: checked(spark.table(prefix + PRODUCT_TABLE), PRODUCTS, PRODUCT_TABLE),
    )


def from_folder(spark: SparkSession, folder: str) -> Tables:
    """Parquet folders named like the tables; the schema is given, not inferred."""

    def read(table, schema):
        return spark.read.schema(schema).parquet(f"{folder}/{table}")

    return Tables(
        read(ACTION_TABLE, ACTIONS),
        read(USER_TABLE, USERS),
        lambda: read(PRODUCT_TABLE, PRODUCTS),
    )
