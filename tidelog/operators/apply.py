"""Applying change events to keyed tables.

A column that is absent from an event's data isn't touched by it; a column that is present and null becomes null. Order is
the order of lsn within a key, so keys are independent, and the state is a plain aggregation: for each column the last
event that says anything about it. Nothing is ordered, windowed or gathered by key, so a hot key aggregates on its way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written
from .ordered import WIDTH, last_known


def key_value(name: str) -> Column:
    """A key column of the row that an event changes: by presence from the old row, else from the new one."""
    old = F.coalesce(F.map_contains_key("old_data", name), F.lit(False))
    return F.when(old, F.col("old_data")[name]).otherwise(F.col("data")[name])


def key_violation(key: list[str]) -> Column:
    """The first key column that an event has in neither row; null if none."""
    out = F.lit(None).cast("string")
    for name in reversed(key):
        there = F.coalesce(F.map_contains_key("old_data", name), F.lit(False)) | F.coalesce(F.map_contains_key("data", name), F.lit(False))
        out = F.when(~there, F.lit(name)).otherwise(out)
    return out


def moved(key: list[str]) -> Column:
    """Whether an event is an update that changes its row's key."""
    differs = [F.coalesce(F.map_contains_key("old_data", k) & F.map_contains_key("data", k), F.lit(False)) & ~F.col("old_data")[k].eqNullSafe(F.col("data")[k]) for k in key]
    return (F.col("type") == "UPDATE") & F.coalesce(F.greatest(*differs, F.lit(False)), F.lit(False))


def split_key_changes(events: DataFrame, key: list[str]) -> DataFrame:
    """Updates that move a row become a DELETE of the old key and an INSERT of the new one, filled from the old row.

    step orders the two; what the old row doesn't hold stays absent, so old rows must be complete for such updates.
    """
    rows = events.withColumn("_moved", moved(key))
    filled = F.map_concat(F.map_filter("old_data", lambda k, _: ~F.map_contains_key(F.col("data"), k)), "data")
    none = F.lit(None).cast("map<string,string>")
    stay = rows.where("NOT _moved").withColumn("step", F.lit(0))
    gone = rows.where("_moved").withColumns({"type": F.lit("DELETE"), "data": F.col("old_data"), "old_data": none, "step": F.lit(0)})
    come = rows.where("_moved").withColumns({"type": F.lit("INSERT"), "data": filled, "old_data": none, "step": F.lit(1)})
    return stay.unionByName(gone).unionByName(come).drop("_moved")


def _lives(base: DataFrame | None, events: DataFrame, key: list[str], width: int) -> DataFrame:
    """INSERTs and DELETEs by key (_key0, ...), lsn, step and commit_lsn, with before: what came last for the key.

    Updates that move a row count as both. Keys are cut into ranges of positions, so a hot key isn't one task.
    """
    names = [f"_key{i}" for i in range(len(key))]
    rows = split_key_changes(events.withColumn("_moves", moved(key)), key).where("type <> 'UPDATE'")
    rows = rows.select(*[key_value(k).alias(n) for k, n in zip(key, names, strict=True)], "lsn", "step", "commit_lsn", "type", "_moves")
    if base is not None:
        old = base.select(*[F.col(k).cast("string").alias(n) for k, n in zip(key, names, strict=True)], F.lit(-1).cast("long").alias("lsn"), F.lit(0).alias("step"), F.lit(-1).cast("long").alias("commit_lsn"), F.lit("INSERT").alias("type"), F.lit(False).alias("_moves"))
        rows = old.unionByName(rows)
    for n in names:
        rows = rows.where(F.col(n).isNotNull())
    return last_known(rows, names, "lsn", F.col("type"), "before", width, ties=("step",), own=False)


def effective(base: DataFrame | None, events: DataFrame, key: list[str], width: int = WIDTH) -> DataFrame:
    """events without updates that move a row which isn't there: they match nothing, so nothing appears at the new key.

    Leaving one out may show that a later one moves nothing either, so this goes on until none is left.
    """
    if events.where(moved(key)).first() is None:
        return events
    while True:
        dead = _lives(base, events, key, width).where("_moves AND step = 0 AND NOT before <=> 'INSERT'").select("lsn")
        dead = written(dead)
        if dead.first() is None:
            return events
        events = written(events.join(dead, "lsn", "left_anti"))


def state(base: DataFrame | None, events: DataFrame, key: list[str], columns: list[str], missing: str = "keep") -> DataFrame:
    """The table's rows, as texts, after all events(lsn, type, data, old_data); base has columns and comes before them.

    missing: 'keep' leaves absent columns of an update alone and finds rows by their old key; 'null' makes such columns
    null and finds rows by the new row's key, so that an update never moves a row: the rule of fixed column lists. Events
    whose key is null change nothing, as no row equals null; deleting or updating a row that isn't there changes nothing.
    """
    if missing == "null":
        events = events.withColumn("old_data", F.lit(None).cast("map<string,string>"))
    rows = split_key_changes(events, key)
    if base is not None:
        old = base.select(F.lit(-1).cast("long").alias("lsn"), F.lit("INSERT").alias("type"), F.lit(0).alias("step"), F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*[F.col(c).cast("string") for c in columns])).alias("data"), F.lit(None).cast("map<string,string>").alias("old_data"))
        rows = old.unionByName(rows.select("lsn", "type", "step", "data", "old_data"))
    keys = [key_value(k).alias(f"_key{i}") for i, k in enumerate(key)]
    names = [f"_key{i}" for i in range(len(key))]
    rows = rows.select(*keys, F.struct("lsn", "step").alias("at"), "type", "data")
    for n in names:
        rows = rows.where(F.col(n).isNotNull())
    says = (lambda c: F.lit(True)) if missing == "null" else (lambda c: (F.col("type") != "UPDATE") | F.map_contains_key("data", c))
    wanted = [c for c in columns if c not in key]
    values = [F.max_by(F.when(says(c), F.struct(F.col("data")[c].alias("v"))), F.when(says(c), F.col("at"))).alias(f"_value{i}") for i, c in enumerate(wanted)]
    # an update after a delete, with no insert between them, finds no row
    last = lambda kinds: F.max(F.when(F.col("type").isin(*kinds), F.col("at")))
    out = rows.groupBy(*names).agg(last(["INSERT"]).alias("_in"), last(["DELETE"]).alias("_out"), *values)
    alive = out.where(F.col("_in").isNotNull() & (F.col("_out").isNull() | (F.col("_out") < F.col("_in"))))
    got = {c: F.col(n) for c, n in zip(key, names, strict=True)} | {c: F.col(f"_value{i}.v") for i, c in enumerate(wanted)}
    return alive.select(*[got[c].alias(c) for c in columns])


def conflicts(base: DataFrame | None, events: DataFrame, key: list[str], width: int = WIDTH) -> DataFrame:
    """Events that bring a key to life that is live already: the keys, lsn and commit_lsn of each.

    These are INSERTs and updates that move a row to another key; see effective() for moves of rows that aren't there.
    """
    found = _lives(base, events, key, width).where("type = 'INSERT' AND before = 'INSERT' AND lsn >= 0")
    return found.select(*[F.col(f"_key{i}").alias(k) for i, k in enumerate(key)], "lsn", "commit_lsn")


def good_prefix(events: DataFrame, poisoned: DataFrame) -> DataFrame:
    """Events of the transactions before the first poisoned one: a failing transaction stops all that come after it."""
    first = poisoned.agg(F.min("commit_lsn")).first()[0]  # one number
    return events if first is None else events.where(F.col("commit_lsn") < first)
