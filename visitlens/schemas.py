"""Input and output schemas.

Times and dates arrive as text and id sets as comma-separated text; a click id
of -1 means "no click".
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Table names, column names and types of the data model.
ACTION_TABLE = "user_visit_action"
USER_TABLE = "user_info"
PRODUCT_TABLE = "product_info"
RATIO_TABLE = "session_stat_ratio"

NO_CLICK = -1
NO_USER = -1


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in columns.items()])


ACTIONS = _struct(
    date=StringType,
    user_id=LongType,
    session_id=StringType,
    page_id=LongType,
    action_time=StringType,
    search_keyword=StringType,
    click_category_id=LongType,
    click_product_id=LongType,
    order_category_ids=StringType,
    order_product_ids=StringType,
    pay_category_ids=StringType,
    pay_product_ids=StringType,
    city_id=LongType,
)

USERS = _struct(
    user_id=LongType,
    username=StringType,
    name=StringType,
    age=IntegerType,
    professional=StringType,
    city=StringType,
    sex=StringType,
)

PRODUCTS = _struct(
    product_id=LongType,
    product_name=StringType,
    extend_info=StringType,
)

SESSION_RECORD = _struct(
    sessionid=StringType,
    searchKeywords=StringType,
    clickCategoryIds=StringType,
    visitLength=LongType,
    stepLength=LongType,
    startTime=StringType,
    age=IntegerType,
    professional=StringType,
    sex=StringType,
    city=StringType,
)

# Inclusive bounds on whole seconds or whole steps; None leaves the top open.
# A visit of 0 seconds is in no bucket but still counts as a session.
VISIT_BUCKETS = [
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
]
STEP_BUCKETS = [
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
]

RATIOS = StructType(
    [StructField("taskid", StringType()), StructField("session_count", LongType())]
    + [StructField(f"visit_length_{name}_ratio", DoubleType()) for name, _, _ in VISIT_BUCKETS]
    + [StructField(f"step_length_{name}_ratio", DoubleType()) for name, _, _ in STEP_BUCKETS]
)

RANDOM_EXTRACT = _struct(
    taskid=StringType,
    sessionid=StringType,
    startTime=StringType,
    searchKeywords=StringType,
    clickCategoryIds=StringType,
)

SESSION_DETAIL = _struct(
    taskid=StringType,
    userid=LongType,
    sessionid=StringType,
    pageid=LongType,
    actionTime=StringType,
    searchKeyword=StringType,
    clickCategoryId=LongType,
    clickProductId=LongType,
    orderCategoryIds=StringType,
    orderProductIds=StringType,
    payCategoryIds=StringType,
    payProductIds=StringType,
)

TOP10_CATEGORY = _struct(
    taskid=StringType,
    categoryid=LongType,
    clickCount=LongType,
    orderCount=LongType,
    payCount=LongType,
)

TOP10_SESSION = _struct(
    taskid=StringType,
    categoryid=LongType,
    sessionid=StringType,
    clickCount=LongType,
)


def checked(df: DataFrame, schema: StructType, what: str) -> DataFrame:
    """``df`` narrowed to the columns of ``schema``; raises if one is missing or mistyped."""
    found = {field.name: field.dataType for field in df.schema}
    wrong = [
        f"{field.name} {field.dataType.simpleString()}"
        for field in schema
        if found.get(field.name) != field.dataType
    ]
    if wrong:
        raise ValueError(f"{what} needs {', '.join(wrong)}; it has {df.schema.simpleString()}")
    return df.select(schema.names)
