"""The ledger of applied transactions: (source_id, commit_lsn), one row per transaction, empty ones included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import running_max

SCHEMA = "source_id string, commit_lsn long, transaction_id long, applied_at timestamp"
KEY = ["source_id", "commit_lsn"]


def unapplied(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows (transactions or events) whose transaction the ledger doesn't have."""
    return rows.join(ledger.select(*KEY).distinct(), KEY, "left_anti")


def entries(transactions: DataFrame) -> DataFrame:
    return transactions.select(*KEY, F.col("xid").alias("transaction_id"), F.current_timestamp().alias("applied_at")).dropDuplicates(KEY)


def progress(transactions: DataFrame) -> DataFrame:
    """source_id, xid, commit_lsn, processed (highest position so far), regressed (the position went back), by arrival."""
    rows = running_max(transactions, ["source_id"], "arrival", F.col("commit_lsn"), "before")
    processed = F.greatest("commit_lsn", F.coalesce("before", F.col("commit_lsn")))
    return rows.select("source_id", "xid", "commit_lsn", processed.alias("processed"), F.coalesce(F.col("commit_lsn") < F.col("before"), F.lit(False)).alias("regressed"))
