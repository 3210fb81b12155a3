"""Source and destination catalogs: differences, and what follows from them.

A catalog has one row per column: namespace, name, ordinal, column, data_type, type_oid, typmod, nullable, has_default,
pk_position (null outside the key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.pgtypes import definition
from .filters import valid_identifier

CATALOG = "namespace string, name string, ordinal int, column string, data_type string, type_oid bigint, typmod int, nullable boolean, has_default boolean, pk_position int"
TABLE = ["namespace", "name"]


def keys_of(catalog: DataFrame) -> DataFrame:
    """The key columns of each table, in key order."""
    pk = F.sort_array(F.collect_list(F.when(F.col("pk_position").isNotNull(), F.struct("pk_position", "column"))))
    return catalog.groupBy(*TABLE).agg(F.transform(pk, lambda x: x["column"]).alias("pk"))


def columns_compatible(source: str, destination: str) -> Column:
    a, b = (lambda f: F.col(f"{source}.{f}")), (lambda f: F.col(f"{destination}.{f}"))
    return (a("type_oid") == b("type_oid")) & (a("typmod") == b("typmod")) & (~a("nullable") | b("nullable"))


def compare(source: DataFrame, destination: DataFrame) -> DataFrame:
    """namespace, name, type, column: one row per difference of the tables that the source has."""
    fields = F.struct("ordinal", "data_type", "type_oid", "typmod", "nullable", "has_default")
    s = source.select(*TABLE, "column", fields.alias("s"))
    d = destination.select(*TABLE, "column", fields.alias("d"))
    tables, there = source.select(*TABLE).distinct(), destination.select(*TABLE).distinct()
    missing = tables.join(there, TABLE, "left_anti").select(*TABLE, F.lit("TABLE_MISSING").alias("type"), F.lit(None).cast("string").alias("column"))
    both = s.join(d, [*TABLE, "column"], "full_outer").join(tables.join(there, TABLE), TABLE)
    differs = (F.col("s.type_oid") != F.col("d.type_oid")) | (F.col("s.typmod") != F.col("d.typmod"))
    found = F.array_compact(
        F.array(
            F.when(F.col("d").isNull(), "COLUMN_MISSING"),
            F.when(differs, "TYPE_MISMATCH"),
            F.when(F.col("s.nullable") & ~F.col("d.nullable"), "NULLABILITY_MISMATCH"),
            F.when(F.col("s").isNull() & ~F.col("d.nullable") & ~F.col("d.has_default"), "COLUMN_EXTRA"),
        )
    )
    by_column = both.select(*TABLE, F.explode(found).alias("type"), "column")
    keys = keys_of(source).join(keys_of(destination).withColumnRenamed("pk", "other"), TABLE).where(F.col("pk") != F.col("other"))
    return missing.unionByName(by_column).unionByName(keys.select(*TABLE, F.lit("PRIMARY_KEY_MISMATCH").alias("type"), F.lit(None).cast("string").alias("column")))


def status(asked: DataFrame, source: DataFrame, destination: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """namespace, name, columns to keep, and status of each table asked about: UNKNOWN where the source doesn't have it."""
    known = asked.join(source.select(*TABLE).distinct().withColumn("known", F.lit(True)), TABLE, "left")
    n = compare(source, destination).groupBy(*TABLE).agg(F.count("*").alias("differences"))
    out = F.when(F.col("known").isNull(), "UNKNOWN").when(F.coalesce("differences", F.lit(0)) > 0, "INCOMPATIBLE").otherwise("COMPATIBLE")
    return known.join(n, TABLE, "left").select(*TABLE, *(keep or []), out.alias("status"))


def gate(differences: DataFrame, source: DataFrame, destination: DataFrame, mode: str, apply_mode: str) -> DataFrame:
    """differences with outcome: candidate, or error:<reason>. Tables without differences simply go on."""
    s = source.select(*TABLE, "column", F.struct("type_oid", "typmod", "nullable").alias("s"))
    d = destination.select(*TABLE, "column", F.lit(True).alias("d"))
    rows = differences.join(s, [*TABLE, "column"], "left").join(d, [*TABLE, "column"], "left")
    outcome = (
        F.when(F.col("type") != "COLUMN_MISSING", F.concat(F.lit("error:"), F.lower("type")))
        .when(F.lit(mode != "auto"), f"error:schema_evolution_{mode}")
        .when(F.lit(apply_mode != "generic"), f"error:apply_mode_{apply_mode}")
        .when(F.col("s").isNull(), "error:source_metadata_missing")
        .when(F.col("d"), "error:destination_conflict")
        .when(~F.col("s.nullable"), "error:add_column_not_null")
        .when(definition(F.col("s.type_oid"), F.col("s.typmod")).isNull(), "error:unsupported_type")
        .otherwise("candidate")
    )
    return rows.select(*TABLE, "type", "column", outcome.alias("outcome"))


def apply_outcomes(changes: DataFrame, destination: DataFrame, include: list[str], mode: str = "auto") -> DataFrame:
    """changes(namespace, name, classification, column, type_oid, typmod, nullable) with result, risk, reason, ddl.

    has_column is whether the change carries a column at all; what is staged gets its definition in ddl.
    """
    tables = destination.select(*TABLE).distinct().withColumn("t", F.lit(True))
    d = destination.select(*TABLE, "column", F.struct("type_oid", "typmod", "nullable").alias("d"))
    rows = changes.join(tables, TABLE, "left").join(d, [*TABLE, "column"], "left").withColumn("s", F.struct("type_oid", "typmod", "nullable"))
    kind = definition(F.col("type_oid"), F.col("typmod"))
    outcome = lambda result, risk, reason: F.struct(F.lit(result).alias("result"), F.lit(risk).alias("risk"), F.lit(reason).alias("reason"))
    out = (
        F.when(~F.concat_ws(".", *TABLE).isin(*include), outcome("rejected", "HIGH", "table_not_supported"))
        .when(F.lit(mode != "auto"), outcome("rejected", "HIGH", f"schema_evolution_{mode}"))
        .when(F.col("classification") != "COLUMN_ADDED", outcome("rejected", "HIGH", "operation_not_allowed"))
        .when(F.col("column").isNull() | F.col("type_oid").isNull(), outcome("rejected", "MEDIUM", "source_column_metadata_missing"))
        .when(~F.col("nullable"), outcome("rejected", "MEDIUM", "add_column_not_null"))
        .when(~(valid_identifier(F.col("namespace")) & valid_identifier(F.col("name")) & valid_identifier(F.col("column"))), outcome("rejected", "MEDIUM", "invalid_identifier"))
        .when(kind.isNull(), outcome("rejected", "MEDIUM", "unsupported_type"))
        .when(F.col("t").isNull(), outcome("rejected", "MEDIUM", "destination_table_missing"))
        .when(F.col("d").isNotNull() & columns_compatible("s", "d"), outcome("already_applied", "LOW", "column_already_compatible"))
        .when(F.col("d").isNotNull(), outcome("failure", "MEDIUM", "schema_conflict"))
        .otherwise(outcome("staged", "LOW", "awaiting_destination_commit"))
    )
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    ddl = F.when(F.col("o.result") == "staged", F.concat(F.lit("ALTER TABLE "), quoted(F.col("namespace")), F.lit("."), quoted(F.col("name")), F.lit(" ADD COLUMN "), quoted(F.col("column")), F.lit(" "), kind))
    return rows.withColumn("o", out).withColumn("ddl", ddl).select(*changes.columns, "o.*", "ddl")


def settled(outcomes: DataFrame, committed: Column) -> DataFrame:
    """Outcomes once the destination transaction has ended: staged and already applied ones succeed or roll back."""
    open_ = F.col("result").isin("staged", "already_applied")
    return outcomes.withColumn("final", F.when(open_ & committed, "success").when(open_, "failure").otherwise(F.col("result"))).withColumn("final_reason", F.when(open_ & ~committed, "destination_transaction_rolled_back").otherwise(F.col("reason")))


def observed_candidates(changes: DataFrame, validation: DataFrame) -> DataFrame:
    """Validation's candidates that observation hasn't already named, after observation's own."""
    own = changes.where("classification = 'COLUMN_ADDED'").select(*TABLE, "column", F.lit("observed").alias("basis"))
    rest = validation.where("outcome = 'candidate'").select(*TABLE, "column", F.lit("schema_validation_column_missing").alias("basis"))
    return own.unionByName(rest.join(own.select(*TABLE, "column"), [*TABLE, "column"], "left_anti"))


def event_column_differences(events: DataFrame, destination: DataFrame, keyed: bool = True) -> DataFrame:
    """The first difference of each event shape: schema, table, columns, problem, column, commit_lsn and lsn where it shows.

    Checked once for each distinct table and column set, not for each event. destination may say since which position a
    column is there; with keyed, a table needs a key.
    """
    none = F.array().cast("array<string>")
    needed = F.array_sort(F.array_distinct(F.concat(F.coalesce(F.map_keys("data"), none), F.coalesce(F.map_keys("old_data"), none))))
    at = F.struct("commit_lsn", "lsn") if "commit_lsn" in events.columns else F.struct(F.lit(None).cast("long").alias("commit_lsn"), F.lit(None).cast("long").alias("lsn"))
    shapes = events.select("schema", "table", needed.alias("columns"), at.alias("at")).groupBy("schema", "table", "columns").agg(F.min("at").alias("at"))
    since = F.col("since") if "since" in destination.columns else F.lit(-1).cast("long")
    have = destination.groupBy(F.col("namespace").alias("schema"), F.col("name").alias("table")).agg(F.map_from_entries(F.collect_list(F.struct("column", since))).alias("have"), F.max(F.col("pk_position").isNotNull()).alias("keyed"))
    rows = shapes.join(have, ["schema", "table"], "left")
    # a column that comes with a later transaction isn't there yet
    rows = rows.withColumn("absent", F.filter("columns", lambda c: F.coalesce(F.col("have")[c] > F.coalesce("at.commit_lsn", F.lit(1 << 62)), F.lit(True))))
    problem = F.when(F.col("have").isNull(), "TABLE_MISSING").when(F.size("absent") > 0, "COLUMN_MISSING").when(~F.col("keyed") & F.lit(keyed), "PRIMARY_KEY_MISSING")
    return rows.select("schema", "table", F.concat_ws(",", "columns").alias("columns"), problem.alias("problem"), F.when(problem == "COLUMN_MISSING", F.element_at("absent", 1)).alias("column"), "at.commit_lsn", "at.lsn")


def ordered_columns(events: DataFrame, destination: DataFrame) -> DataFrame:
    """schema, table, columns (an event's, in destination order, leftovers by name after), signature, by distinct shape."""
    shapes = events.select("schema", "table", F.array_sort(F.map_keys("data")).alias("present")).distinct()
    have = destination.groupBy(F.col("namespace").alias("schema"), F.col("name").alias("table")).agg(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "column"))), lambda x: x["column"]).alias("order"))
    rows = shapes.join(have, ["schema", "table"])
    columns = F.concat(F.array_intersect("order", "present"), F.array_sort(F.array_except("present", "order")))
    return rows.select("schema", "table", F.concat_ws(",", columns).alias("columns"), F.concat_ws("|", "order").alias("signature"))
