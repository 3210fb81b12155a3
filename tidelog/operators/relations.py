"""Drift of relation metadata: what changed between a relation message and the snapshot before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Reasons by classification, where the change itself names none.
REASONS = {
    "COLUMN_ADDED": "column_added_observed",
    "COLUMN_REMOVED": "column_removed_observed",
    "COLUMN_METADATA_CHANGED": "column_metadata_changed_observed",
    "RELATION_ID_CHANGED": "relation_id_changed_observed",
    "RELATION_RENAMED_OR_REPLACED": "relation_name_changed_observed",
    "UNKNOWN": "insufficient_relation_metadata",
}


def invalid(id_: Column, namespace: Column, name: Column, columns: Column) -> Column:
    """Why a message can't be a snapshot; null if it can."""
    names = F.transform(columns, lambda c: c["name"])
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    return (
        F.when(F.coalesce(id_, F.lit(0)) == 0, "relation id is 0")
        .when(empty(namespace) | empty(name), "relation without a name")
        .when(columns.isNull() | F.exists(columns, lambda c: c.isNull() | empty(c["name"])), "column without a name")
        .when(F.size(F.array_distinct(names)) < F.size(names), "duplicate column")
    )


def _changes(kind: str, names: Column) -> Column:
    return F.transform(names, lambda n: F.struct(F.lit(kind).alias("classification"), n.alias("column"), F.lit(REASONS[kind]).alias("reason")))


def _one(kind: str, reason: str | None = None) -> Column:
    return F.array(F.struct(F.lit(kind).alias("classification"), F.lit(None).cast("string").alias("column"), F.lit(reason or REASONS[kind]).alias("reason")))


def column_changes(before: Column, after: Column) -> Column:
    """Ordered changes from one column list to the next."""
    names = lambda columns: F.transform(columns, lambda c: c["name"])
    none = F.slice(_one("UNKNOWN"), 1, 0)
    added, removed = F.array_except(names(after), names(before)), F.array_except(names(before), names(after))
    both = (F.size(added) > 0) & (F.size(removed) > 0)
    moved = F.when(both, _one("UNKNOWN", "columns_added_and_removed")).otherwise(F.concat(_changes("COLUMN_ADDED", added), _changes("COLUMN_REMOVED", removed)))
    kept = F.filter(after, lambda c: F.exists(before, lambda b: (b["name"] == c["name"]) & ((b["type_oid"] != c["type_oid"]) | (b["typmod"] != c["typmod"]))))
    changed = _changes("COLUMN_METADATA_CHANGED", names(kept))
    order = (F.size(added) == 0) & (F.size(removed) == 0) & (names(before) != names(after))
    return F.concat(moved, changed, F.when(order, _one("UNKNOWN", "column_order_changed")).otherwise(none))


def observe(relations: DataFrame, strict: bool = True) -> DataFrame:
    """epoch, seq, relation_id, ordinal, classification, column, reason: one row for each change.

    A message is compared to the last valid one with its id, unless another id has taken over that one's name since;
    else to the last one with its name; a first sighting is no change. Snapshots live as long as the epoch. A message that
    can't be a snapshot is an error; where not strict it is passed over, and the snapshot before it stays.
    """
    wrong = invalid(F.col("relation_id"), F.col("namespace"), F.col("name"), F.col("columns"))
    error = F.raise_error(F.concat(wrong, F.lit(" at frame "), F.col("seq"))).cast("boolean") if strict else F.lit(False)
    rows = relations.where(F.when(wrong.isNotNull(), error).otherwise(F.lit(True)))
    by_id, by_name = Window.partitionBy("epoch", "relation_id").orderBy("seq"), Window.partitionBy("epoch", "namespace", "name").orderBy("seq")
    own = F.struct("seq", "relation_id", "namespace", "name", "columns", F.lead("seq").over(by_name).alias("taken_at"), F.lead("relation_id").over(by_name).alias("taken_by"))
    rows = rows.withColumn("own", own)
    rows = rows.withColumn("id_before", F.lag("own").over(by_id)).withColumn("name_before", F.lag("own").over(by_name))
    gone = (F.col("id_before.taken_at") < F.col("seq")) & (F.col("id_before.taken_by") != F.col("relation_id"))
    rows = rows.withColumn("id_before", F.when(~F.coalesce(gone, F.lit(False)), F.col("id_before")))
    renamed = (F.col("id_before.namespace") != F.col("namespace")) | (F.col("id_before.name") != F.col("name"))
    none = F.slice(_one("UNKNOWN"), 1, 0)
    changes = F.when(F.col("id_before").isNotNull(), F.concat(F.when(renamed, _one("RELATION_RENAMED_OR_REPLACED")).otherwise(none), column_changes(F.col("id_before.columns"), F.col("columns")))).when(
        F.col("name_before").isNotNull(), F.concat(_one("RELATION_ID_CHANGED"), column_changes(F.col("name_before.columns"), F.col("columns")))
    )
    return rows.select("epoch", "seq", "relation_id", F.posexplode(changes).alias("ordinal", "change")).select("epoch", "seq", "relation_id", "ordinal", "change.*")
