"""Audit records of frames: one flat JSON per message, relations with what the source catalog says of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lsn
from .decode import DML, IGNORED


def records(frames: DataFrame, catalog: DataFrame) -> DataFrame:
    """seq, message_type, columns, new_width, old_width, catalog_read_status, record (JSON) of each frame."""
    have = catalog.groupBy(F.col("namespace").alias("_n"), F.col("name").alias("_t")).agg(F.count("*").alias("catalog_columns"))
    rows = frames.join(have, (F.col("namespace") == F.col("_n")) & (F.col("relation_name") == F.col("_t")), "left")
    kind = F.when(F.col("msg_type").isin("BEGIN", "COMMIT", "RELATION", *DML, *IGNORED), F.col("msg_type")).otherwise("UNKNOWN")
    status = F.when(F.col("msg_type") == "RELATION", F.when(F.col("catalog_columns").isNull(), "TABLE_NOT_FOUND").otherwise("OK"))
    out = rows.select("seq", kind.alias("message_type"), F.size("columns").alias("columns"), F.size("new_tuple").alias("new_width"), F.size("old_tuple").alias("old_width"), status.alias("catalog_read_status"), lsn.format(F.col("wal_start")).alias("wal_start"), "xid", "relation_id")
    return out.withColumn("record", F.to_json(F.struct(*out.columns)))
