"""From frames to change events: dispatch, transactions, relation look-up, tuples.

Frames: seq (order within an epoch), epoch (one connection), wal_start, msg_type and the fields of each message; see
tidelog.sources.frames.SCHEMA. Events of a transaction appear once its COMMIT is there, and never without it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import EARLIER, UP_TO, WIDTH

DML = ("INSERT", "UPDATE", "DELETE")
IGNORED = ("TYPE", "ORIGIN")


def dispatch(frames: DataFrame) -> DataFrame:
    """frames with kind: bracket, relation, change, ignored (by design) or unknown (logged and skipped)."""
    kind = F.when(F.col("msg_type").isin("BEGIN", "COMMIT"), "bracket").when(F.col("msg_type") == "RELATION", "relation").when(F.col("msg_type").isin(*DML), "change").when(F.col("msg_type").isin(*IGNORED), "ignored").otherwise("unknown")
    return frames.withColumn("kind", kind).withColumn("kept", F.col("kind").isin("bracket", "relation", "change"))


def tuple_map(columns: Column, cells: Column) -> Column:
    """Column names to cell texts: null cells are null, unchanged large values are absent, missing trailing cells too."""
    pairs = F.zip_with(F.slice(columns, 1, F.greatest(F.size(cells), F.lit(1))), cells, lambda c, x: F.struct(c["name"].alias("key"), F.when(x["kind"] != "n", x["text"]).alias("value"), x["kind"].alias("kind")))
    held = F.filter(pairs, lambda p: p["key"].isNotNull() & (p["kind"] != "u"))
    return F.map_from_entries(F.transform(held, lambda p: F.struct(p["key"], p["value"])))


def placed(frames: DataFrame, width: int = WIDTH) -> DataFrame:
    """frames with what their order says of each:

    tx: the BEGIN it follows (seq, xid, final_lsn); n: changes up to and with it in its epoch; before: those before that
    BEGIN; bracket: the first BEGIN or COMMIT from it on (seq, msg_type, end_lsn); depth: BEGINs less COMMITs so far;
    relation: the last message of its relation_id before it.

    Frames are shuffled once, to ranges of `width` positions; windows work within a range, and what ranges hand on to each
    other is a row for each range, or for each range and relation in it.
    """
    kind, keys, part = F.col("msg_type"), ["epoch", "_range"], Window.partitionBy("epoch", "_range")
    past, ahead = part.orderBy("seq").rowsBetween(*UP_TO), part.orderBy(F.desc("seq")).rowsBetween(*UP_TO)
    n = F.sum(kind.isin(*DML).cast("long")).over(past)
    depth = F.when(kind == "BEGIN", 1).when(kind == "COMMIT", -1).otherwise(0).cast("long")
    bracket = F.when(kind.isin("BEGIN", "COMMIT"), F.struct("seq", "msg_type", "end_lsn"))
    begin = F.when(kind == "BEGIN", F.struct("seq", "xid", "final_lsn", "_n"))
    ranged = frames.withColumn("_range", F.floor(F.col("seq") / width))

    # a row for each range, of few columns: what earlier and later ranges say
    narrow = ranged.select(*keys, "seq", "msg_type", "xid", "final_lsn", "end_lsn").withColumn("_n", n)
    sums = narrow.groupBy(*keys).agg(F.max("_n").alias("n"), F.sum(depth).alias("depth"), F.max(begin).alias("begin"), F.min(bracket).alias("bracket"))
    earlier, later = (Window.partitionBy("epoch").orderBy(order).rowsBetween(*EARLIER) for order in (F.col("_range"), F.desc("_range")))
    sums = sums.withColumn("_n0", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    own = F.when(F.col("begin").isNotNull(), F.struct(F.struct("begin.seq", "begin.xid", "begin.final_lsn").alias("tx"), (F.col("begin._n") + F.col("_n0")).alias("before")))
    before = F.coalesce(F.sum("depth").over(earlier), F.lit(0))
    sums = sums.select(*keys, "_n0", before.alias("_depth0"), F.last(own, True).over(earlier).alias("_open"), F.last("bracket", True).over(later).alias("_next"))

    # a row for each range and relation in it: the last message before the range
    each, message = [*keys, "relation_id"], F.when(kind == "RELATION", F.struct("seq", "namespace", "relation_name", "columns"))
    handed = ranged.where(F.col("relation_id").isNotNull()).groupBy(*each).agg(F.max_by(message, F.when(kind == "RELATION", F.col("seq"))).alias("_end"))
    handed = handed.select(*each, F.last("_end", True).over(Window.partitionBy("epoch", "relation_id").orderBy("_range").rowsBetween(*EARLIER)).alias("_known"))

    rows = ranged.repartition(*keys).withColumns({"_n": n, "_depth": F.sum(depth).over(past)})
    rows = rows.withColumns({"_begin": F.last(begin, True).over(past), "_bracket": F.last(bracket, True).over(ahead)})
    rows = rows.withColumn("_relation", F.last(message, True).over(Window.partitionBy(*each).orderBy("seq").rowsBetween(*UP_TO)))
    rows = rows.join(sums, keys, "left").join(handed, each, "left")
    within = F.col("_begin").isNotNull()
    out = {
        "tx": F.when(within, F.struct("_begin.seq", "_begin.xid", "_begin.final_lsn")).otherwise(F.col("_open.tx")),
        "before": F.when(within, F.col("_begin._n") + F.col("_n0")).otherwise(F.col("_open.before")),
        "n": F.col("_n") + F.col("_n0"),
        "depth": F.col("_depth") + F.col("_depth0"),
        "bracket": F.coalesce("_bracket", "_next"),
        "relation": F.coalesce("_relation", "_known"),
    }
    return rows.select(*frames.columns, *(c.alias(k) for k, c in out.items()))


def relation_versions(frames: DataFrame, width: int = WIDTH) -> DataFrame:
    """RELATION messages with their position: their own, or that of the enclosing BEGIN where they have none."""
    out = placed(frames, width).where("msg_type = 'RELATION'")
    return out.select("epoch", "seq", F.when(F.col("wal_start") == 0, F.col("tx.final_lsn")).otherwise(F.col("wal_start")).alias("lsn"), F.col("tx.xid").alias("xid"), "relation_id", "namespace", F.col("relation_name").alias("name"), "columns")


def _breach() -> Column:
    """What is wrong with a change's relation or tuple, in placed frames; null if nothing is."""
    wide = F.greatest(F.coalesce(F.size("new_tuple"), F.lit(0)), F.coalesce(F.size("old_tuple"), F.lit(0))) > F.coalesce(F.size("relation.columns"), F.lit(0))
    return F.when(F.col("relation").isNull(), "unknown relation").when(wide, "tuple wider than its relation")


def assemble(frames: DataFrame, source_id: str = "cdc-demo", width: int = WIDTH, strict: bool = True) -> DataFrame:
    """One row per event of committed transactions: source_id, xid, commit_lsn, ordinal, lsn, type, schema, table, ...

    commit_lsn is the end of the transaction. UPDATE has data and old_data; DELETE has its old row as data. An event of an
    unknown relation, or with more cells than its relation has columns, is an error; where not strict it is left out.
    """
    rows = placed(frames.where(F.col("msg_type").isin("BEGIN", "COMMIT", "RELATION", *DML)), width)
    rows = rows.where(F.col("msg_type").isin(*DML) & F.col("tx").isNotNull() & (F.col("bracket.msg_type") == "COMMIT"))
    error = F.concat(_breach(), F.lit(" at frame "), F.col("seq"))
    rows = rows.where(F.when(error.isNotNull(), F.raise_error(error).cast("boolean") if strict else F.lit(False)).otherwise(F.lit(True)))
    new, old = tuple_map(F.col("relation.columns"), F.col("new_tuple")), tuple_map(F.col("relation.columns"), F.col("old_tuple"))
    return rows.select(
        F.lit(source_id).alias("source_id"),
        F.col("tx.xid").alias("xid"),
        F.col("bracket.end_lsn").alias("commit_lsn"),
        (F.col("n") - F.col("before") - 1).alias("ordinal"),
        F.when(F.col("wal_start") == 0, F.col("tx.final_lsn")).otherwise(F.col("wal_start")).alias("lsn"),
        F.col("msg_type").alias("type"),
        F.col("relation.namespace").alias("schema"),
        F.col("relation.relation_name").alias("table"),
        F.transform("relation.columns", lambda c: c["name"]).alias("columns"),
        F.when(F.col("msg_type") == "DELETE", old).otherwise(new).alias("data"),
        F.when((F.col("msg_type") == "UPDATE") & F.col("old_tuple").isNotNull(), old).alias("old_data"),
        "epoch",
        "seq",
        F.col("relation.seq").alias("relation_seq"),
    )


def committed(frames: DataFrame, source_id: str = "cdc-demo", width: int = WIDTH) -> DataFrame:
    """source_id, xid, commit_lsn, events, epoch and seq of each COMMIT that ends a transaction, empty ones included."""
    rows = placed(frames.where(F.col("msg_type").isin("BEGIN", "COMMIT", *DML)), width).where("msg_type = 'COMMIT' AND tx IS NOT NULL AND depth = 0")
    return rows.select(F.lit(source_id).alias("source_id"), F.col("tx.xid").alias("xid"), F.col("end_lsn").alias("commit_lsn"), (F.col("n") - F.col("before")).alias("events"), "epoch", "seq")


def transactions(events: DataFrame) -> DataFrame:
    """source_id, xid, commit_lsn, events, first and last ordinal of each transaction."""
    return events.groupBy("source_id", "xid", "commit_lsn").agg(F.count("*").alias("events"), F.min("ordinal").alias("first_ordinal"), F.max("ordinal").alias("last_ordinal"))


def protocol_errors(frames: DataFrame, width: int = WIDTH) -> DataFrame:
    """epoch, seq and error of the first breach of message order in each epoch.

    A BEGIN inside a transaction, a change or COMMIT outside one, a change of an unknown relation, a tuple wider than its
    relation. What follows the first breach isn't judged: the connection ends there.
    """
    rows, change = placed(frames, width), F.col("msg_type").isin(*DML)
    error = (
        F.when((F.col("msg_type") == "BEGIN") & (F.col("depth") > 1), "begin inside a transaction")
        .when((F.col("msg_type") == "COMMIT") & (F.col("depth") < 0), "commit outside a transaction")
        .when(change & (F.col("depth") < 1), "change outside a transaction")
        .when(change, _breach())
    )
    found = rows.withColumn("error", error).where("error IS NOT NULL")
    return found.groupBy("epoch").agg(F.min("seq").alias("seq"), F.min_by("error", "seq").alias("error"))
