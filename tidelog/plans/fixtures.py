"""Small catalogs and histories that the schema queries run on: (fixed) rows as the contract tests of the operators use them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.compat import CATALOG

RELATIONS = "epoch int, seq bigint, relation_id bigint, namespace string, name string, columns array<struct<name:string,type_oid:bigint,typmod:int>>"
CHANGES = "namespace string, name string, classification string, column string, type_oid bigint, typmod int, nullable boolean"

_INT, _TEXT, _VARCHAR = ("bigint", 20), ("text", 25), ("character varying", 1043)


def _table(name: str, *columns: tuple) -> list[tuple]:
    """columns: name, type, nullable, pk position or None, has_default."""
    return [("public", name, i + 1, c, t[0], t[1], -1, nullable, default, pk) for i, (c, t, nullable, pk, default) in enumerate(columns)]


_ID, _NAME = ("id", _INT, False, 1, False), ("nome", _TEXT, False, None, False)


_EMAIL = ("email", _TEXT, True, None, False)
SOURCE = [
    *_table("same", _ID, _NAME, _EMAIL),
    *_table("missing_column", _ID, _NAME, ("telefone", _TEXT, True, None, False), ("codigo", _TEXT, False, None, False), ("ponto", ("point", 600), True, None, False)),
    *_table("extra_nullable", _ID, _NAME),
    *_table("extra_required", _ID),
    *_table("retyped", _ID, ("idade", ("integer", 23), True, None, False)),
    *_table("stricter", _ID, _EMAIL),
    *_table("keys", ("tenant_id", _INT, False, 1, False), ("id", _INT, False, 2, False)),
    *_table("absent", _ID),
]
DESTINATION = [
    *_table("same", _ID, _NAME, _EMAIL),
    *_table("missing_column", _ID, _NAME),
    *_table("extra_nullable", _ID, _NAME, ("telefone", _TEXT, True, None, False)),
    *_table("extra_required", _ID, ("codigo", _TEXT, False, None, False), ("criado", _TEXT, False, None, True)),
    *_table("retyped", _ID, ("idade", _TEXT, True, None, False)),
    *_table("stricter", _ID, ("email", _TEXT, False, None, False)),
    *_table("keys", ("tenant_id", _INT, False, 2, False), ("id", _INT, False, 1, False)),
]


def source_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCE, CATALOG)


def destination_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DESTINATION, CATALOG)


_I, _N = ("id", 20, -1), ("nome", 25, -1)
#: epoch, relation id, name, columns of each message; the tenth and eleventh can't be snapshots.
STEPS = [
    (1, 7, "clientes", [_I, _N]),
    (1, 7, "clientes", [_I, _N]),
    (1, 7, "clientes", [_I, _N, ("email", 25, -1)]),
    (1, 7, "clientes", [_I]),
    (1, 7, "clientes", [_I, _N]),
    (1, 7, "clientes", [_I, ("nome", 1043, -1)]),
    (1, 7, "clientes", [_I, ("nome", 1043, 20)]),
    (1, 7, "clientes", [_I, ("nome_completo", 1043, 20)]),
    (1, 7, "clientes", [("nome_completo", 1043, 20), _I]),
    (1, 7, "clientes", [_I, _I]),
    (1, 0, "clientes", [_I]),
    (1, 7, "clientes", []),
    (1, 8, "clientes", [_I]),
    (1, 8, "pessoas", [_I]),
    (1, 8, "pessoas", [_I, ("a", 25, -1), ("b", 25, -1)]),
    (1, 7, "outra", [_I]),
    (2, 7, "clientes", [_I]),
    (2, 7, "clientes", [_I, ("nome", 1043, 104), ("telefone", 25, -1)]),
]


def relation_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(e, k, r, "public", t, c) for k, (e, r, t, c) in enumerate(STEPS, 1)], RELATIONS)


_ADD = "COLUMN_ADDED"
CHANGED = [
    ("public", "missing_column", _ADD, "telefone", 25, -1, True),
    ("public", "missing_column", _ADD, "codigo", 25, -1, False),
    ("public", "missing_column", "COLUMN_REMOVED", "nome", 25, -1, True),
    ("public", "missing_column", _ADD, "sem_tipo", None, None, None),
    ("public", "missing_column", _ADD, "ponto", 600, -1, True),
    ("public", "missing_column", _ADD, "", 25, -1, True),
    ("public", "missing_column", _ADD, 'com"aspas', 1043, 34, True),
    ("public", "missing_column", _ADD, "quando", 1114, 3, True),
    ("public", "extra_nullable", _ADD, "telefone", 25, -1, True),
    ("public", "stricter", _ADD, "email", 25, -1, True),
    ("public", "absent", _ADD, "telefone", 25, -1, True),
    ("privado", "x", _ADD, "telefone", 25, -1, True),
]


def schema_changes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CHANGED, CHANGES)


INCLUDE = [f"public.{t}" for t in ("same", "missing_column", "extra_nullable", "extra_required", "retyped", "stricter", "keys", "absent")]
