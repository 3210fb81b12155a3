"""Change logs and frames made from the supplied tables, so that every operator has real input.

From events, by user: the first is an INSERT, some errors a DELETE, what follows a DELETE an INSERT, all else an UPDATE.
Five events make a transaction. The table is public.user_state with key user_id; updates of odd events leave props out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SOURCE = "cdc-demo"
RELATION = 7


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str) -> Column:
    """Money as whole numbers, as texts of doubles differ between engines."""
    return F.round(F.col(c) * 100).cast("long")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, user_id, op, lsn, xid, commit_lsn, event_type, value, old_value, props of each event."""
    by = Window.partitionBy("user_id").orderBy("event_id")
    rows = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", cents("value").alias("value"), "props").withColumn("rn", F.row_number().over(by))
    rows = rows.withColumn("op0", F.when(F.col("rn") == 1, "INSERT").when((F.col("event_type") == "error") & (F.col("rn") % 2 == 0), "DELETE"))
    rows = rows.withColumn("op", F.coalesce("op0", F.when(F.lag("op0").over(by) == "DELETE", "INSERT").otherwise("UPDATE"))).withColumn("old_value", F.lag("value").over(by))
    xid = F.floor(F.col("event_id") / 5).cast("long") + 1
    rows = rows.select("event_id", "user_id", "op", ((F.col("event_id") + 1) * 64).alias("lsn"), xid.alias("xid"), "event_type", "value", "old_value", "props")
    ends = rows.groupBy("xid").agg(((F.max("event_id") + 1) * 64 + 32).alias("commit_lsn"))
    return rows.join(ends, "xid")


def _map(**columns: Column) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(k) for k in columns]), F.array(*[v.cast("string") for v in columns.values()]))


def events(log: DataFrame, partial: bool = True) -> DataFrame:
    """Change events of a change_log(); with partial, updates of odd events say nothing of props."""
    full = _map(user_id=F.col("user_id"), event_type=F.col("event_type"), value=F.col("value"), props=F.col("props"))
    part = _map(user_id=F.col("user_id"), event_type=F.col("event_type"), value=F.col("value"))
    data = F.when((F.col("op") == "UPDATE") & (F.col("event_id") % 2 == 1) & F.lit(partial), part).otherwise(full)
    old = F.when(F.col("op") == "UPDATE", _map(user_id=F.col("user_id"), value=F.col("old_value")))
    return log.select(F.lit(SOURCE).alias("source_id"), "xid", "commit_lsn", F.col("event_id").alias("seq"), "lsn", F.col("op").alias("type"), F.lit("public").alias("schema"), F.lit("user_state").alias("table"), data.alias("data"), old.alias("old_data"))


def frames(log: DataFrame) -> DataFrame:
    """Frames of a change_log(): BEGIN, RELATION (each hundredth transaction), changes, COMMIT; the last stays open."""
    from .frames import SCHEMA

    cell = lambda c: F.struct(F.when(c.isNull(), "n").otherwise("t").alias("kind"), c.cast("string").alias("text"))
    kept = F.struct(F.lit("u").alias("kind"), F.lit(None).cast("string").alias("text"))
    row = F.array(*[cell(F.col(c)) for c in ("user_id", "event_type", "value", "props")])
    partial = F.array(*[cell(F.col(c)) for c in ("user_id", "event_type", "value")], kept)
    old = F.array(cell(F.col("user_id")), kept, cell(F.col("old_value")), kept)
    update = F.col("op") == "UPDATE"
    dml = log.select(
        (F.col("event_id") * 4 + 2).alias("seq"), F.col("lsn").alias("wal_start"), F.col("op").alias("msg_type"), F.lit(RELATION).cast("long").alias("relation_id"),
        F.when(F.col("op") != "DELETE", F.when(update & (F.col("event_id") % 2 == 1), partial).otherwise(row)).alias("new_tuple"), F.when(F.col("op") == "DELETE", row).when(update, old).alias("old_tuple"), F.when(F.col("op") != "INSERT", "O").alias("old_kind"),
    )
    tx = log.groupBy("xid", "commit_lsn").agg(F.min("event_id").alias("first"), F.max("event_id").alias("last"))
    begin = tx.select((F.col("first") * 4).alias("seq"), (F.col("first") * 64 + 1).alias("wal_start"), F.lit("BEGIN").alias("msg_type"), "xid", F.col("commit_lsn").alias("final_lsn"))
    described = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("key"), F.lit(o).cast("long").alias("type_oid"), F.lit(-1).alias("typmod")) for n, k, o in (("user_id", True, 20), ("event_type", False, 25), ("value", False, 20), ("props", False, 25))])
    relation = tx.where("(xid - 1) % 100 = 0").select((F.col("first") * 4 + 1).alias("seq"), F.lit(0).cast("long").alias("wal_start"), F.lit("RELATION").alias("msg_type"), F.lit(RELATION).cast("long").alias("relation_id"), F.lit("public").alias("namespace"), F.lit("user_state").alias("relation_name"), F.lit(ord("f")).alias("replica_identity"), described.alias("columns"))
    newest = log.agg(F.max("xid")).first()[0]
    commit = tx.where(F.col("xid") < (newest or 0)).select((F.col("last") * 4 + 3).alias("seq"), F.col("commit_lsn").alias("wal_start"), F.lit("COMMIT").alias("msg_type"), F.col("commit_lsn"), F.col("commit_lsn").alias("end_lsn"))
    empty = log.sparkSession.createDataFrame([], SCHEMA)
    out = empty
    for part in (begin, relation, dml, commit):
        out = out.unionByName(part.withColumns({"epoch": F.lit(1), "server_wal_end": F.col("wal_start")}), allowMissingColumns=True)
    return out


def ordinals(changes: DataFrame) -> DataFrame:
    """changes with ordinal: the place in its transaction, by seq."""
    return changes.withColumn("ordinal", F.row_number().over(Window.partitionBy("source_id", "commit_lsn").orderBy("seq")) - 1)
