"""The types that a column may be added with: object identifier and type modifier to definition text and Spark type.

A null definition means that the type isn't supported. The rules per type: no modifier (-1) only; a length (modifier - 4);
precision and scale packed into the modifier; or fractional digits 0 to 6.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# PostgreSQL's object identifiers of built-in types and the names of their definitions.
PLAIN = {25: "TEXT", 23: "INTEGER", 20: "BIGINT", 16: "BOOLEAN", 3802: "JSONB", 1082: "DATE", 2950: "UUID"}
VARCHAR, NUMERIC = 1043, 1700
TEMPORAL = {1114: "TIMESTAMP WITHOUT TIME ZONE", 1184: "TIMESTAMP WITH TIME ZONE", 1083: "TIME WITHOUT TIME ZONE", 1266: "TIME WITH TIME ZONE"}
SPARK = {25: T.StringType(), 23: T.IntegerType(), 20: T.LongType(), 16: T.BooleanType(), 3802: T.StringType(), 1082: T.DateType(), 2950: T.StringType(), 1043: T.StringType(), 1700: T.DecimalType(38, 18), 1114: T.TimestampNTZType(), 1184: T.TimestampType(), 1083: T.StringType(), 1266: T.StringType()}


def definition(oid: Column, modifier: Column) -> Column:
    """Definition text of a supported type, else null."""
    out = F.lit(None).cast("string")
    for k, name in PLAIN.items():
        out = F.when((oid == k) & (modifier == -1), F.lit(name)).otherwise(out)
    out = F.when(oid == VARCHAR, F.when(modifier == -1, "CHARACTER VARYING").when(modifier >= 4, F.format_string("CHARACTER VARYING(%d)", modifier - 4))).otherwise(out)
    packed = modifier - 4
    precision, low = F.shiftright(packed, 16), packed.bitwiseAND(0xFFFF)
    scale = F.when(low >= 0x8000, low - 0x10000).otherwise(low)  # the low half is signed
    out = F.when(oid == NUMERIC, F.when(modifier == -1, "NUMERIC").when((modifier >= 4) & (precision > 0), F.format_string("NUMERIC(%d,%d)", precision, scale))).otherwise(out)
    for k, name in TEMPORAL.items():  # digits come last, as existing deployments write them
        out = F.when(oid == k, F.when(modifier == -1, name).when(modifier.between(0, 6), F.format_string(f"{name}(%d)", modifier))).otherwise(out)
    return out


def decoded(text: Column, oid: int) -> Column:
    """A cell's text as its type; unknown types stay text, malformed values become null."""
    kind = SPARK.get(oid, T.StringType())
    return text.try_cast("boolean") if oid == 16 else text if isinstance(kind, T.StringType) else text.try_cast(kind)


def described(kind: Column, oid: Column, modifier: Column, nullable: Column, has_default: Column) -> Column:
    null = F.when(nullable, "NULL").otherwise("NOT NULL")
    return F.concat_ws(" ", kind, F.format_string("oid=%d typmod=%d", oid, modifier), null, F.when(has_default, "DEFAULT").otherwise("NO DEFAULT"))
