"""Catalogs from the system tables of a database: columns, their order, and the key's columns in the key's order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .compat import CATALOG

#: Kinds of relation that hold rows of their own: tables, and partitioned ones.
TABLES = ("r", "p")


def read(classes: DataFrame, namespaces: DataFrame, attributes: DataFrame, types: DataFrame, indexes: DataFrame, defaults: DataFrame) -> DataFrame:
    """One row per live column of each table, as compat.CATALOG says, from the system tables' columns of the same names.

    classes(oid, relname, relnamespace, relkind), namespaces(oid, nspname), attributes(attrelid, attname, attnum, atttypid,
    atttypmod, attnotnull, attisdropped), types(oid, typname), indexes(indrelid, indisprimary, indkey), defaults(adrelid,
    adnum).
    """
    tables = classes.where(F.col("relkind").isin(*TABLES)).join(namespaces.withColumnRenamed("oid", "relnamespace"), "relnamespace").select(F.col("oid").alias("attrelid"), F.col("nspname").alias("namespace"), F.col("relname").alias("name"))
    live = attributes.where("attnum > 0 AND NOT attisdropped")
    keys = indexes.where("indisprimary").select(F.col("indrelid").alias("attrelid"), F.posexplode("indkey").alias("place", "attnum")).withColumn("pk_position", F.col("place") + 1).drop("place")
    has = defaults.select(F.col("adrelid").alias("attrelid"), F.col("adnum").alias("attnum"), F.lit(True).alias("filled")).distinct()
    rows = live.join(tables, "attrelid").join(types.select(F.col("oid").alias("atttypid"), "typname"), "atttypid")
    rows = rows.join(keys, ["attrelid", "attnum"], "left").join(has, ["attrelid", "attnum"], "left")
    out = rows.select(
        "namespace", "name", F.col("attnum").alias("ordinal"), F.col("attname").alias("column"), F.col("typname").alias("data_type"), F.col("atttypid").alias("type_oid"), F.col("atttypmod").alias("typmod"),
        (~F.col("attnotnull")).alias("nullable"), F.coalesce("filled", F.lit(False)).alias("has_default"), "pk_position",
    )
    kinds = dict(f.split(" ") for f in CATALOG.split(", "))
    return out.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()])


def publication_tables(members: DataFrame, publication: str) -> DataFrame:
    """schema, table of each member of a publication. members(pubname, schemaname, tablename)."""
    return members.where(F.col("pubname") == publication).select(F.col("schemaname").alias("schema"), F.col("tablename").alias("table"))


def slot(slots: DataFrame, name: str, database: str) -> DataFrame:
    """plugin, confirmed_flush_lsn and active of a logical slot of a database; no row where there is none."""
    return slots.where((F.col("slot_name") == name) & (F.col("slot_type") == "logical") & (F.col("database") == database)).select("plugin", "confirmed_flush_lsn", "active")


class Cache:
    """Key and columns of destination tables, read again when the source's columns change; an empty signature always hits."""

    def __init__(self, catalog) -> None:
        self._catalog, self._known = catalog, {}

    def get(self, table: str, signature: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
        """Key and columns, in their order. catalog, a function without arguments, gives the catalog when it is needed."""
        known = self._known.get(table)
        if known is None or signature and known[0] != signature:
            rows = sorted(self._catalog().where(F.concat_ws(".", "namespace", "name") == table).collect(), key=lambda r: r["ordinal"])
            if not rows:
                raise LookupError(f"no table {table}")
            known = self._known[table] = signature, [r["column"] for r in sorted((r for r in rows if r["pk_position"] is not None), key=lambda r: r["pk_position"])], [r["column"] for r in rows]
        return known[1], known[2]

    def clear(self) -> None:
        """After a reconnection, or once a column was added."""
        self._known.clear()
