"""What a publication lacks of a table list: statements to create it or to add to it. Nothing is ever removed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def plan(wanted: DataFrame, members: DataFrame, publication: str, exists: bool) -> DataFrame:
    """action and ddl. wanted: schema, table, position; members: schema, table of the publication."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    named = F.concat(quoted(F.col("schema")), F.lit("."), quoted(F.col("table")))
    own = F.lit('"' + publication.replace('"', '""') + '"')
    if not exists:
        tables = F.transform(F.sort_array(F.collect_list(F.struct("position", named.alias("n")))), lambda x: x["n"])
        return wanted.agg(F.concat_ws(", ", tables).alias("t")).select(F.lit("create").alias("action"), F.concat(F.lit("CREATE PUBLICATION "), own, F.lit(" FOR TABLE "), "t").alias("ddl"))
    rest = wanted.join(members.select("schema", "table").distinct(), ["schema", "table"], "left_anti")
    return rest.select(F.lit("add").alias("action"), F.concat(F.lit("ALTER PUBLICATION "), own, F.lit(" ADD TABLE "), named).alias("ddl"))
