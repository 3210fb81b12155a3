"""The event contract: what every change event must hold. The first broken rule is reported."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lsn


def violations(events: DataFrame) -> DataFrame:
    """events(lsn as text, transaction_id, schema, table, type, data, old_data) with violation, null where none."""
    has = lambda c: F.col(c).isNotNull()  # noqa: E731  an empty map is a row without columns, not a missing row
    text = F.coalesce(F.col("lsn"), F.lit(""))
    rule = (
        F.when(text == "", "missing lsn")
        .when(lsn.parse(text).isNull(), "malformed lsn")
        .when(F.coalesce(F.col("transaction_id"), F.lit(0)) == 0, "missing transaction_id")
        .when(F.coalesce(F.col("schema"), F.lit("")) == "", "missing schema")
        .when(F.coalesce(F.col("table"), F.lit("")) == "", "missing table")
        .when((F.col("type") == "INSERT") & ~has("data"), "insert without data")
        .when((F.col("type") == "INSERT") & has("old_data"), "insert with old data")
        .when((F.col("type") == "UPDATE") & ~has("data"), "update without data")
        .when((F.col("type") == "UPDATE") & ~has("old_data"), "update without old data")
        .when((F.col("type") == "DELETE") & ~has("data"), "delete without data")
        .when((F.col("type") == "DELETE") & has("old_data"), "delete with old data")
        .when(~F.coalesce(F.col("type").isin("INSERT", "UPDATE", "DELETE"), F.lit(False)), "unsupported type")
    )
    return events.withColumn("violation", rule)
