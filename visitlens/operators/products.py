"""Products with the status kept in their JSON text (read by no job of the data model)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def product_status(products: DataFrame) -> DataFrame:
    return products.selectExpr(
        "product_id",
        "product_name",
        "cast(get_json_object(extend_info, '$.product_status') as int) as product_status",
    )
