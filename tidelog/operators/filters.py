"""Which tables take part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_tables(text: str) -> list[str]:
    """schema.table names of a comma list, trimmed, each once, in first-seen order; ValueError on any other form."""
    out: list[str] = []
    for part in text.split(","):
        name = part.strip()
        if not name:
            continue
        halves = [h.strip() for h in name.split(".")]
        if len(halves) != 2 or not all(halves):
            raise ValueError(f"not a schema.table name: {name!r}")
        out.append(".".join(halves))
    return list(dict.fromkeys(out))


def qualified(schema: str = "schema", table: str = "table") -> Column:
    return F.concat_ws(".", F.col(schema), F.col(table))


def include(events: DataFrame, tables: list[str], on_excluded: str = "error") -> DataFrame:
    """Events of listed tables: others are dropped, or kept with `excluded` true for the caller to fail on."""
    inside = qualified().isin(*tables) if tables else F.lit(False)
    return events.where(inside) if on_excluded == "drop" else events.withColumn("excluded", ~inside)


def should_validate(table: Column, tables: list[str]) -> Column:
    """An empty list means every table."""
    return table.isin(*tables) if tables else F.lit(True)


def valid_identifier(name: Column) -> Column:
    return name.isNotNull() & (F.length(name) > 0) & F.is_valid_utf8(name) & (F.instr(name, "\0") == 0)
