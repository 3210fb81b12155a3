"""One query for each operator, over whole tables, with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import counters, pgtypes
from ..operators import apply, audit, catalog, compat, contract, decode, filters, ledger, publication, relations, sinks
from ..operators.replica import EXPLICIT, Rejected, Replica
from ..operators.store import Store
from ..sources import changes, scratch
from ..sources import frames as wire
from ..streaming import apply as streaming
from ..streaming import consumer, supervisor
from . import fixtures

KEY, COLUMNS = ["user_id"], ["user_id", "event_type", "value", "props"]

#: The change log of sources.changes, in SQL.
LOG = """
b AS (SELECT event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS value, props, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
o AS (SELECT *, CASE WHEN rn = 1 THEN 'INSERT' WHEN event_type = 'error' AND rn % 2 = 0 THEN 'DELETE' END AS op0 FROM b),
c AS (SELECT *, coalesce(op0, CASE WHEN lag(op0) OVER (PARTITION BY user_id ORDER BY event_id) = 'DELETE' THEN 'INSERT' ELSE 'UPDATE' END) AS op,
  lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS old_value, (event_id + 1) * 64 AS lsn, event_id // 5 + 1 AS xid FROM o),
cl AS (SELECT *, (max(event_id) OVER (PARTITION BY xid) + 1) * 64 + 32 AS commit_lsn, row_number() OVER (PARTITION BY xid ORDER BY event_id) - 1 AS ordinal FROM c),
done AS (SELECT * FROM cl WHERE xid < (SELECT max(xid) FROM cl))
"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.change_log(spark, sf_dir)


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scratch.written(changes.frames(_log(spark, sf_dir)))  # as a real source would have them: stored


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.assemble(_frames(spark, sf_dir))


def _typed(state: DataFrame) -> DataFrame:
    return state.select(F.col("user_id").cast("long").alias("user_id"), "event_type", F.col("value").cast("long").alias("value"), "props")


SQL: dict[str, str] = {}

SQL["q01_frames_scan"] = f"""WITH {LOG}, x AS (SELECT DISTINCT xid FROM cl)
SELECT 'BEGIN' AS msg_type, count(*) AS n FROM x UNION ALL SELECT 'COMMIT', count(*) - 1 FROM x
UNION ALL SELECT 'RELATION', count(*) FROM x WHERE (xid - 1) % 100 = 0 UNION ALL SELECT op, count(*) FROM cl GROUP BY op"""


def q01_frames_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frames(spark, sf_dir).groupBy("msg_type").agg(F.count("*").alias("n"))


SQL["q02_dispatch"] = f"""WITH {LOG}, x AS (SELECT DISTINCT xid FROM cl), k AS (
SELECT 'bracket' AS kind FROM x UNION ALL SELECT 'bracket' FROM x WHERE xid < (SELECT max(xid) FROM x) UNION ALL SELECT 'relation' FROM x WHERE (xid - 1) % 100 = 0
UNION ALL SELECT 'change' FROM cl UNION ALL SELECT 'ignored' FROM cl WHERE event_id % 50 = 0 UNION ALL SELECT 'ignored' FROM cl WHERE event_id % 50 = 1 UNION ALL SELECT 'unknown' FROM cl WHERE event_id % 50 = 2)
SELECT kind, kind IN ('bracket', 'relation', 'change') AS kept, count(*) AS n FROM k GROUP BY 1, 2"""


def q02_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    other = F.element_at(F.array(F.lit("TYPE"), F.lit("ORIGIN"), F.lit("TRUNCATE")), (F.col("event_id") % 50 + 1).cast("int"))
    more = log.where("event_id % 50 < 3").select((F.col("event_id") * 4 + 3).alias("seq"), F.lit(1).alias("epoch"), other.alias("msg_type"))
    every = changes.frames(log).unionByName(more, allowMissingColumns=True)
    return decode.dispatch(every).groupBy("kind", "kept").agg(F.count("*").alias("n"))


SQL["q03_transactions"] = f"WITH {LOG} SELECT xid, commit_lsn, count(*) AS events, min(ordinal) AS first_ordinal, max(ordinal) AS last_ordinal FROM done GROUP BY ALL"


def q03_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.transactions(_events(spark, sf_dir)).drop("source_id")


SQL["q04_event_projection"] = f"WITH {LOG} SELECT commit_lsn, ordinal, op AS type, lsn, value, CASE WHEN op = 'UPDATE' THEN old_value END AS old_value FROM done"


def q04_event_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("commit_lsn", "ordinal", "type", "lsn", F.col("data")["value"].cast("long").alias("value"), F.col("old_data")["value"].cast("long").alias("old_value"))


SQL["q05_asof_relation"] = f"WITH {LOG} SELECT (xid - 1) // 100 * 100 * 5 * 4 + 1 AS relation_seq, count(*) AS events FROM done GROUP BY 1"


def q05_asof_relation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).groupBy("relation_seq").agg(F.count("*").alias("events"))


SQL["q06_tuple_map"] = f"""WITH {LOG} SELECT op AS type, op <> 'UPDATE' OR event_id % 2 = 0 AS has_props, op = 'UPDATE' AS has_old_value, false AS has_old_props, count(*) AS n FROM done GROUP BY ALL"""


def q06_tuple_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    has = lambda c, k: F.coalesce(F.map_contains_key(c, k), F.lit(False))
    return _events(spark, sf_dir).groupBy("type", has("data", "props").alias("has_props"), has("old_data", "value").alias("has_old_value"), has("old_data", "props").alias("has_old_props")).agg(F.count("*").alias("n"))


SQL["q07_typed_decode"] = f"WITH {LOG} SELECT op AS type, CAST(sum(user_id) AS BIGINT) AS users, CAST(sum(value) AS BIGINT) AS total, CAST(sum(CASE WHEN op <> 'UPDATE' OR event_id % 2 = 0 THEN length(props) ELSE 0 END) AS BIGINT) AS chars FROM done GROUP BY op"


def q07_typed_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = lambda k, oid: pgtypes.decoded(F.col("data")[k], oid)
    return _events(spark, sf_dir).groupBy("type").agg(F.sum(cell("user_id", 20)).alias("users"), F.sum(cell("value", 20)).alias("total"), F.sum(F.coalesce(F.length(cell("props", 25)), F.lit(0))).alias("chars"))


SQL["q08_relation_lsn"] = f"WITH {LOG} SELECT DISTINCT xid, commit_lsn AS lsn FROM cl WHERE (xid - 1) % 100 = 0"


def q08_relation_lsn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.relation_versions(_frames(spark, sf_dir)).select("xid", "lsn")


SQL["q09_contract"] = f"""WITH {LOG}, v AS (SELECT CASE event_id % 13 WHEN 1 THEN 'missing lsn' WHEN 2 THEN 'malformed lsn' WHEN 3 THEN 'missing transaction_id' WHEN 4 THEN 'missing schema' WHEN 5 THEN 'missing table'
WHEN 6 THEN lower(op) || ' without data' WHEN 7 THEN CASE op WHEN 'UPDATE' THEN 'update without old data' END WHEN 8 THEN CASE op WHEN 'UPDATE' THEN NULL ELSE lower(op) || ' with old data' END WHEN 9 THEN 'unsupported type' END AS violation FROM cl)
SELECT violation, count(*) AS n FROM v GROUP BY violation"""


def q09_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions import lsn

    e, kind = changes.events(_log(spark, sf_dir)), F.col("seq") % 13
    none = F.lit(None).cast("map<string,string>")
    broken = e.select(
        F.when(kind == 1, "").when(kind == 2, "0/xyz").otherwise(lsn.format(F.col("lsn"))).alias("lsn"), F.when(kind != 3, F.col("xid")).otherwise(0).alias("transaction_id"), F.when(kind != 4, F.col("schema")).alias("schema"), F.when(kind != 5, F.col("table")).alias("table"),
        F.when(kind == 9, "UPSERT").otherwise(F.col("type")).alias("type"), F.when(kind != 6, F.col("data")).alias("data"), F.when(kind == 7, none).when(kind == 8, F.col("data")).otherwise(F.col("old_data")).alias("old_data"),
    )
    return contract.violations(broken).groupBy("violation").agg(F.count("*").alias("n"))


SQL["q10_protocol_errors"] = f"""WITH {LOG}, x AS (SELECT xid, count(*) AS n FROM cl GROUP BY xid)
SELECT xid % 6 AS kind, CASE xid % 6 WHEN 0 THEN 'change outside a transaction' WHEN 1 THEN 'begin inside a transaction' WHEN 2 THEN 'unknown relation' WHEN 3 THEN 'tuple wider than its relation' WHEN 4 THEN 'commit outside a transaction' END AS error, count(*) AS n
FROM x WHERE xid % 6 < 5 GROUP BY ALL"""


def q10_protocol_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each transaction as a connection of its own, broken in one of five ways or not at all."""
    log = _log(spark, sf_dir)
    f = scratch.written(changes.frames(log))
    by = log.select(F.col("event_id").alias("e"), "xid")
    f = f.where("msg_type IN ('INSERT', 'UPDATE', 'DELETE')").withColumn("e", F.floor(F.col("seq") / 4)).drop("xid").join(by, "e").drop("e")
    f = f.withColumn("epoch", F.col("xid").cast("int")).withColumn("kind", F.col("xid") % 6)
    wider = lambda c: F.when(F.col("kind") == 3, F.concat(c, c)).otherwise(F.col(c))
    f = f.withColumns({"new_tuple": wider("new_tuple"), "old_tuple": wider("old_tuple"), "xid": F.lit(None).cast("long")})
    tx = f.groupBy("epoch", "kind").agg(F.min("seq").alias("first"), F.max("seq").alias("last"))
    described = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(False).alias("key"), F.lit(25).cast("long").alias("type_oid"), F.lit(-1).alias("typmod")) for n in COLUMNS])
    relation = tx.where("kind <> 2").select("epoch", (F.col("first") - 4).alias("seq"), F.lit("RELATION").alias("msg_type"), F.lit(changes.RELATION).cast("long").alias("relation_id"), F.lit("public").alias("namespace"), F.lit("user_state").alias("relation_name"), described.alias("columns"))
    begin = tx.where("kind NOT IN (0, 4)").select("epoch", F.explode(F.when(F.col("kind") == 1, F.array(F.col("first") - 3, F.col("first") - 2)).otherwise(F.array(F.col("first") - 3))).alias("seq"), F.lit("BEGIN").alias("msg_type"), F.col("epoch").cast("long").alias("xid"))
    commit = tx.where("kind <> 0").select("epoch", (F.when(F.col("kind") == 4, F.col("first") - 1).otherwise(F.col("last") + 1)).alias("seq"), F.lit("COMMIT").alias("msg_type"))
    every = f.drop("kind")
    for part in (relation, begin, commit):
        every = every.unionByName(part, allowMissingColumns=True)
    return decode.protocol_errors(every).groupBy((F.col("epoch") % 6).cast("long").alias("kind"), "error").agg(F.count("*").alias("n"))


SQL["q11_include"] = f"WITH {LOG} SELECT CASE WHEN user_id % 2 = 0 THEN 'public.user_state' ELSE 'public.other' END AS name, user_id % 2 = 1 AS excluded, count(*) AS n FROM cl GROUP BY ALL"


def q11_include(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = filters.parse_tables(" public.user_state, public.clientes,public.user_state ")
    e = changes.events(_log(spark, sf_dir)).withColumn("table", F.when(F.col("data")["user_id"].cast("long") % 2 == 0, "user_state").otherwise("other"))
    return filters.include(e, listed).groupBy(filters.qualified().alias("name"), "excluded").agg(F.count("*").alias("n"))


_LINE = """'{"type":"' || op || '","lsn":"' || printf('%X/%X', lsn >> 32, lsn & 4294967295) || '","transaction_id":' || xid || ',"schema":"public","table":"user_state","data":{"event_type":' || to_json(event_type) ||
CASE WHEN op <> 'UPDATE' OR event_id % 2 = 0 THEN ',"props":' || to_json(props) ELSE '' END || ',"user_id":"' || user_id || '","value":"' || value || '"}' ||
CASE WHEN op = 'UPDATE' THEN ',"old_data":{"user_id":"' || user_id || '","value":"' || old_value || '"}' ELSE '' END || '}'"""
SQL["q12_json_lines"] = f"WITH {LOG} SELECT commit_lsn, ordinal, {_LINE} AS line FROM cl"


def q12_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.lines(changes.ordinals(changes.events(_log(spark, sf_dir)))).withColumn("ordinal", F.col("ordinal").cast("long"))


SQL["q13_progress"] = f"""WITH {LOG}, t AS (SELECT DISTINCT xid, commit_lsn, xid * 2 - CASE WHEN xid % 7 = 0 THEN 5 ELSE 0 END AS arrival FROM cl),
w AS (SELECT *, max(commit_lsn) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM t)
SELECT xid, commit_lsn, greatest(commit_lsn, coalesce(before, commit_lsn)) AS processed, coalesce(commit_lsn < before, false) AS regressed FROM w"""


def q13_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _log(spark, sf_dir).select(F.lit(changes.SOURCE).alias("source_id"), "xid", "commit_lsn").distinct()
    t = t.withColumn("arrival", F.col("xid") * 2 - F.when(F.col("xid") % 7 == 0, 5).otherwise(0))
    return ledger.progress(t).drop("source_id")


SQL["q14_file_replay"] = f"""WITH {LOG}, r AS (SELECT op, lsn FROM cl UNION ALL SELECT op, lsn FROM cl WHERE xid * 10 > 9 * (SELECT max(xid) FROM cl))
SELECT op AS type, count(*) AS lines, count(DISTINCT lsn) AS distinct_lines FROM r GROUP BY op"""


def q14_file_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file sink after a crash before the last tenth was acknowledged: those lines are there twice."""
    e = changes.ordinals(changes.events(_log(spark, sf_dir)))
    newest = e.agg(F.max("xid")).first()[0]
    again = e.where(F.col("xid") * 10 > 9 * newest)
    lines = sinks.lines(e.unionByName(again)).select(F.get_json_object("line", "$.type").alias("type"), "line")
    return lines.groupBy("type").agg(F.count("*").alias("lines"), F.countDistinct("line").alias("distinct_lines"))


SQL["q15_ledger"] = f"WITH {LOG} SELECT xid, commit_lsn, count(*) AS events FROM cl WHERE xid % 3 <> 0 GROUP BY ALL"


def q15_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = changes.events(_log(spark, sf_dir))
    applied = ledger.entries(e.where("xid % 3 = 0").select("source_id", "xid", "commit_lsn"))
    return ledger.unapplied(e, applied).groupBy("xid", "commit_lsn").agg(F.count("*").alias("events"))


SQL["q16_replica_state"] = f"WITH {LOG}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS k FROM cl) SELECT user_id, event_type, value, props FROM r WHERE k = 1 AND op <> 'DELETE'"


def q16_replica_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(apply.state(None, changes.events(_log(spark, sf_dir), partial=False), KEY, COLUMNS))


SQL["q17_column_map"] = "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) || '!' ELSE c_name END AS nome, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS email FROM customer WHERE c_custkey % 10 <> 0"


def q17_column_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed column lists: columns that an update leaves out become null."""
    c = changes.read(spark, sf_dir, "customer")
    row = lambda **k: F.map_from_arrays(F.array(*map(F.lit, k)), F.array(*[v.cast("string") for v in k.values()]))
    none = F.lit(None).cast("map<string,string>")
    own = F.col("c_custkey").cast("long")
    full = row(id=own, nome=F.col("c_name"), email=F.col("c_mktsegment"))
    e = c.select(own.alias("lsn"), F.lit("INSERT").alias("type"), full.alias("data"), none.alias("old_data"))
    e = e.unionByName(c.where("c_custkey % 3 = 0").select((own + 1_000_000_000).alias("lsn"), F.lit("UPDATE").alias("type"), row(id=own, nome=F.concat(F.upper("c_name"), F.lit("!"))).alias("data"), full.alias("old_data")))
    e = e.unionByName(c.where("c_custkey % 10 = 0").select((own + 2_000_000_000).alias("lsn"), F.lit("DELETE").alias("type"), full.alias("data"), none.alias("old_data")))
    return apply.state(None, e, ["id"], ["id", "nome", "email"], missing="null").withColumn("id", F.col("id").cast("long"))


SQL["q18_insert_conflicts"] = "SELECT l_orderkey, l_linenumber, count(*) - 1 AS conflicts FROM lineitem GROUP BY ALL HAVING count(*) > 1"


def q18_insert_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = changes.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    data = F.map_from_arrays(F.array(F.lit("l_orderkey"), F.lit("l_linenumber")), F.array(F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    e = li.select(data.alias("data"), F.lit(None).cast("map<string,string>").alias("old_data"), F.lit("INSERT").alias("type"), F.monotonically_increasing_id().alias("lsn")).withColumn("commit_lsn", F.col("lsn"))
    found = apply.conflicts(None, e, ["l_orderkey", "l_linenumber"])
    return found.groupBy(F.col("l_orderkey").cast("long").alias("l_orderkey"), F.col("l_linenumber").cast("int").alias("l_linenumber")).agg(F.count("*").alias("conflicts"))


SQL["q19_partial_update"] = f"""WITH {LOG}, g AS (SELECT *, sum(CASE WHEN op = 'INSERT' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY lsn) AS seg FROM cl),
f AS (SELECT *, last_value(CASE WHEN op = 'INSERT' OR event_id % 2 = 0 THEN props END IGNORE NULLS) OVER (PARTITION BY user_id, seg ORDER BY lsn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p,
row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS r FROM g) SELECT user_id, event_type, value, p AS props FROM f WHERE r = 1 AND op <> 'DELETE'"""


def q19_partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(apply.state(None, changes.events(_log(spark, sf_dir)), KEY, COLUMNS))


SQL["q19_composite_key"] = "SELECT conv_id, CASE WHEN turn % 2 = 0 THEN turn + 1000 ELSE turn END AS turn, CASE WHEN turn % 2 = 0 THEN 'moved' ELSE role END AS role, text FROM conversations WHERE conv_id % 5 <> 0"


def q19_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two key columns; updates of even turns change the key and leave the text out, so it comes from the old row."""
    c = changes.read(spark, sf_dir, "conversations")
    row = lambda **k: F.map_from_arrays(F.array(*map(F.lit, k)), F.array(*[v.cast("string") for v in k.values()]))
    none = F.lit(None).cast("map<string,string>")
    full = row(conv_id=F.col("conv_id"), turn=F.col("turn"), role=F.col("role"), text=F.col("text"))
    moved = row(conv_id=F.col("conv_id"), turn=F.col("turn") + 1000, role=F.lit("moved"))
    now = row(conv_id=F.col("conv_id"), turn=F.when(F.col("turn") % 2 == 0, F.col("turn") + 1000).otherwise(F.col("turn")))
    e = c.select(F.lit(1).cast("long").alias("lsn"), F.lit("INSERT").alias("type"), full.alias("data"), none.alias("old_data"))
    e = e.unionByName(c.where("turn % 2 = 0").select(F.lit(2).cast("long").alias("lsn"), F.lit("UPDATE").alias("type"), moved.alias("data"), full.alias("old_data")))
    e = e.unionByName(c.where("conv_id % 5 = 0").select(F.lit(3).cast("long").alias("lsn"), F.lit("DELETE").alias("type"), now.alias("data"), none.alias("old_data")))
    out = apply.state(None, e, ["conv_id", "turn"], ["conv_id", "turn", "role", "text"])
    return out.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")


_HALF = "(SELECT min(event_id) FROM cl WHERE event_id >= (SELECT max(event_id) // 2 FROM cl) AND op <> 'DELETE')"
SQL["q20_atomic_prefix"] = f"""WITH {LOG}, p AS (SELECT * FROM cl WHERE xid < (SELECT xid FROM cl WHERE event_id = {_HALF})),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS k FROM p) SELECT user_id, event_type, value, props FROM r WHERE k = 1 AND op <> 'DELETE'"""


def q20_atomic_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An INSERT on a live key poisons its transaction: the state is that of what came before it."""
    e = changes.events(_log(spark, sf_dir), partial=False)
    half = e.agg(F.max("seq")).first()[0] // 2
    at = e.where((F.col("seq") >= half) & (F.col("type") != "DELETE")).agg(F.min("seq")).first()[0]
    bad = e.where(F.col("seq") == at).withColumns({"type": F.lit("INSERT"), "lsn": F.col("lsn") + 1, "old_data": F.lit(None).cast("map<string,string>")})
    every = e.unionByName(bad)
    return _typed(apply.state(None, apply.good_prefix(every, apply.conflicts(None, every, KEY)), KEY, COLUMNS))


SQL["q21_noop_delete"] = "SELECT c_custkey, c_name FROM customer WHERE c_custkey % 4 <> 0"


def q21_noop_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes of keys that aren't there, and of null keys, change nothing."""
    c = changes.read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    key = F.when(F.col("c_custkey") % 4 == 0, F.col("c_custkey")).when(F.col("c_custkey") % 4 == 1, F.col("c_custkey") + 1_000_000_000).cast("string")
    e = c.select(F.col("c_custkey").cast("long").alias("lsn"), F.lit("DELETE").alias("type"), F.map_from_arrays(F.array(F.lit("c_custkey")), F.array(key)).alias("data"), F.lit(None).cast("map<string,string>").alias("old_data"))
    return apply.state(c, e, ["c_custkey"], ["c_custkey", "c_name"]).withColumn("c_custkey", F.col("c_custkey").cast("long"))


def _literal(v: object) -> str:
    return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"


def _values(rows: list[tuple], names: str) -> str:
    """Input rows in SQL."""
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(_literal, r)) + ')' for r in rows)}) t({names})"


_CATALOG = "namespace, name, ordinal, col, data_type, type_oid, typmod, nullable, has_default, pk"
#: Both catalogs, and their differences.
CATALOGS = f"""s AS ({_values(fixtures.SOURCE, _CATALOG)}), d AS ({_values(fixtures.DESTINATION, _CATALOG)}),
st AS (SELECT DISTINCT name FROM s), dt AS (SELECT DISTINCT name FROM d),
f AS (SELECT coalesce(s.name, d.name) AS name, coalesce(s.col, d.col) AS col, s.col AS sc, d.col AS dc, s.type_oid AS so, d.type_oid AS do_, s.typmod AS sm, d.typmod AS dm, s.nullable AS sn, d.nullable AS dn, d.has_default AS dd
  FROM s FULL JOIN d ON s.name = d.name AND s.col = d.col WHERE coalesce(s.name, d.name) IN (FROM st) AND coalesce(s.name, d.name) IN (FROM dt)),
sk AS (SELECT name, list(col ORDER BY pk) AS pk FROM s WHERE pk IS NOT NULL GROUP BY name), dk AS (SELECT name, list(col ORDER BY pk) AS pk FROM d WHERE pk IS NOT NULL GROUP BY name),
diff AS (SELECT name, 'TABLE_MISSING' AS difference, NULL::VARCHAR AS column_name FROM st WHERE name NOT IN (FROM dt)
  UNION ALL SELECT name, 'COLUMN_MISSING', col FROM f WHERE dc IS NULL
  UNION ALL SELECT name, 'TYPE_MISMATCH', col FROM f WHERE sc IS NOT NULL AND (so <> do_ OR sm <> dm)
  UNION ALL SELECT name, 'NULLABILITY_MISMATCH', col FROM f WHERE sc IS NOT NULL AND sn AND NOT dn
  UNION ALL SELECT name, 'COLUMN_EXTRA', col FROM f WHERE sc IS NULL AND NOT dn AND NOT dd
  UNION ALL SELECT sk.name, 'PRIMARY_KEY_MISMATCH', NULL FROM sk JOIN dk ON sk.name = dk.name WHERE sk.pk <> dk.pk)"""


def _definition(oid: str, typmod: str) -> str:
    """The type list in SQL."""
    plain = {**pgtypes.PLAIN, pgtypes.VARCHAR: "CHARACTER VARYING", pgtypes.NUMERIC: "NUMERIC", **pgtypes.TEMPORAL}
    named = lambda kinds: f"CASE {oid} " + " ".join(f"WHEN {k} THEN '{n}'" for k, n in kinds.items()) + " END"
    m = f"({typmod} - 4)"
    return f"""CASE WHEN {typmod} = -1 THEN {named(plain)} WHEN {oid} = 1043 AND {m} >= 0 THEN 'CHARACTER VARYING(' || {m} || ')'
WHEN {oid} = 1700 AND {m} // 65536 > 0 THEN 'NUMERIC(' || ({m} // 65536) || ',' || (({m} % 65536 + 32768) % 65536 - 32768) || ')'
WHEN {typmod} BETWEEN 0 AND 6 THEN {named(pgtypes.TEMPORAL)} || '(' || {typmod} || ')' END"""


def _columns_sql(columns: list[tuple]) -> str:
    """A list of columns, typed also where it is empty."""
    items = ", ".join("{'n': " + _literal(n) + f", 'o': {o}, 'm': {m}" + "}" for n, o, m in columns)
    return f"[{items}]::STRUCT(n VARCHAR, o BIGINT, m BIGINT)[]"


_STEPS = " UNION ALL ".join(f"SELECT {e} AS epoch, {k} AS seq, {r} AS rid, '{t}' AS name, {_columns_sql(c)} AS cols" for k, (e, r, t, c) in enumerate(fixtures.STEPS, 1))
_CHANGE = lambda kind, column, reason: "{'k': '" + kind + "', 'c': " + column + ", 'r': '" + reason + "'}"
SQL["q22_relation_drift"] = f"""WITH raw AS ({_STEPS}), valid AS (SELECT * FROM raw WHERE rid <> 0 AND len(list_distinct(list_transform(cols, lambda x: x.n))) = len(cols)),
w AS (SELECT *, lag(seq) OVER i AS by_id, lag(seq) OVER n AS by_name, lead(seq) OVER n AS taken_at, lead(rid) OVER n AS taken_by FROM valid WINDOW i AS (PARTITION BY epoch, rid ORDER BY seq), n AS (PARTITION BY epoch, name ORDER BY seq)),
p AS (SELECT w.*, CASE WHEN a.seq IS NULL OR (a.taken_at < w.seq AND a.taken_by <> w.rid) THEN NULL ELSE a.seq END AS same, a.name AS old_name FROM w LEFT JOIN w a ON a.seq = w.by_id),
b AS (SELECT p.epoch, p.seq, p.same IS NOT NULL AS known, p.same IS NOT NULL AND p.old_name <> p.name AS renamed, o.cols AS b, p.cols AS a,
  list_filter(list_transform(p.cols, lambda x: x.n), lambda x: NOT list_contains(list_transform(o.cols, lambda y: y.n), x)) AS added, list_filter(list_transform(o.cols, lambda x: x.n), lambda x: NOT list_contains(list_transform(p.cols, lambda y: y.n), x)) AS removed
  FROM p JOIN w o ON o.seq = coalesce(p.same, p.by_name)),
c AS (SELECT epoch, seq, list_concat(
  CASE WHEN renamed THEN [{_CHANGE('RELATION_RENAMED_OR_REPLACED', 'NULL::VARCHAR', 'relation_name_changed_observed')}] WHEN NOT known THEN [{_CHANGE('RELATION_ID_CHANGED', 'NULL::VARCHAR', 'relation_id_changed_observed')}] ELSE [] END,
  CASE WHEN len(added) > 0 AND len(removed) > 0 THEN [{_CHANGE('UNKNOWN', 'NULL::VARCHAR', 'columns_added_and_removed')}]
    ELSE list_concat(list_transform(added, lambda x: {_CHANGE('COLUMN_ADDED', 'x', 'column_added_observed')}), list_transform(removed, lambda x: {_CHANGE('COLUMN_REMOVED', 'x', 'column_removed_observed')})) END,
  list_transform(list_filter(a, lambda x: len(list_filter(b, lambda y: y.n = x.n AND (y.o <> x.o OR y.m <> x.m))) > 0), lambda x: {_CHANGE('COLUMN_METADATA_CHANGED', 'x.n', 'column_metadata_changed_observed')}),
  CASE WHEN len(added) = 0 AND len(removed) = 0 AND list_transform(a, lambda x: x.n) <> list_transform(b, lambda x: x.n) THEN [{_CHANGE('UNKNOWN', 'NULL::VARCHAR', 'column_order_changed')}] ELSE [] END) AS changes FROM b),
u AS (SELECT epoch, seq, unnest(changes) AS x, generate_subscripts(changes, 1) - 1 AS ordinal FROM c)
SELECT epoch, seq, ordinal, x.k AS classification, x.c AS column_name, x.r AS reason FROM u"""


def q22_relation_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relations.observe(fixtures.relation_history(spark), strict=False).select("epoch", "seq", "ordinal", "classification", F.col("column").alias("column_name"), "reason")


SQL["q23_catalog_compare"] = f"WITH {CATALOGS} SELECT name, difference, column_name FROM diff"


def _differences(spark: SparkSession) -> DataFrame:
    return compat.compare(fixtures.source_catalog(spark), fixtures.destination_catalog(spark))


def q23_catalog_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _differences(spark).select("name", F.col("type").alias("difference"), F.col("column").alias("column_name"))


#: The columns of each distinct shape of events, sorted.
SHAPES = f"""{LOG.strip()}, shape AS (SELECT DISTINCT CASE WHEN op <> 'UPDATE' OR event_id % 2 = 0 THEN ['event_type', 'props', 'user_id', 'value'] ELSE ['event_type', 'user_id', 'value'] END AS present FROM cl)"""
SQL["q24_ordered_columns"] = f"""WITH {SHAPES}, destination AS (SELECT ['value', 'user_id', 'idade'] AS o)
SELECT 'user_state' AS table_name, array_to_string(list_concat(list_filter(o, lambda x: list_contains(present, x)), list_filter(present, lambda x: NOT list_contains(o, x))), ',') AS columns, array_to_string(o, '|') AS signature FROM shape, destination"""


def _user_state_catalog(spark: SparkSession, columns: tuple[str, ...], keyed: bool) -> DataFrame:
    return spark.createDataFrame([("public", "user_state", i + 1, c, "text", 25, -1, True, False, 1 if keyed and c == "user_id" else None) for i, c in enumerate(columns)], fixtures.CATALOG)


def q24_ordered_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Destination order first, what it doesn't know by name after."""
    out = compat.ordered_columns(changes.events(_log(spark, sf_dir)), _user_state_catalog(spark, ("value", "user_id", "idade"), True))
    return out.select(F.col("table").alias("table_name"), "columns", "signature")


SQL["q25_event_columns"] = f"""WITH {SHAPES}, a AS (SELECT present, list_filter(present, lambda x: NOT list_contains(['user_id', 'event_type', 'value'], x)) AS absent FROM shape)
SELECT array_to_string(present, ',') AS columns, CASE WHEN len(absent) > 0 THEN 'COLUMN_MISSING' ELSE 'PRIMARY_KEY_MISSING' END AS problem, absent[1] AS column_name FROM a"""


def q25_event_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = compat.event_column_differences(changes.events(_log(spark, sf_dir)), _user_state_catalog(spark, ("user_id", "event_type", "value"), False))
    return out.select("columns", "problem", F.col("column").alias("column_name"))


#: Every type that the list names and some that it doesn't, with modifiers at and beyond each rule's edges.
_OIDS, _TYPMODS = (25, 23, 20, 16, 3802, 1082, 2950, 1043, 1700, 1114, 1184, 1083, 1266, 999999, 21, 114, 700), (-2, -1, 0, 3, 4, 6, 7, 10, 34, 655366, 720902, 65539, 131071)
_TYPES = [(o, m) for o in _OIDS for m in _TYPMODS]
SQL["q26_type_definitions"] = f"WITH t AS ({_values(_TYPES, 'type_oid, typmod')}) SELECT type_oid, typmod, {_definition('type_oid', 'typmod')} AS definition FROM t"


def q26_type_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame(_TYPES, "type_oid int, typmod int")
    return rows.select("type_oid", "typmod", pgtypes.definition(F.col("type_oid"), F.col("typmod")).alias("definition"))


_MODES = [("auto", "generic"), ("manual", "generic"), ("auto", "explicit"), ("disabled", "explicit")]
SQL["q27_gate"] = f"""WITH {CATALOGS}, m AS ({_values(_MODES, 'mode, apply_mode')})
SELECT mode, apply_mode, diff.name, column_name, CASE WHEN difference <> 'COLUMN_MISSING' THEN 'error:' || lower(difference) WHEN mode <> 'auto' THEN 'error:schema_evolution_' || mode WHEN apply_mode <> 'generic' THEN 'error:apply_mode_' || apply_mode
WHEN s.col IS NULL THEN 'error:source_metadata_missing' WHEN d.col IS NOT NULL THEN 'error:destination_conflict' WHEN NOT s.nullable THEN 'error:add_column_not_null' WHEN ({_definition('s.type_oid', 's.typmod')}) IS NULL THEN 'error:unsupported_type' ELSE 'candidate' END AS outcome
FROM diff CROSS JOIN m LEFT JOIN s ON s.name = diff.name AND s.col = column_name LEFT JOIN d ON d.name = diff.name AND d.col = column_name"""


def q27_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, d = fixtures.source_catalog(spark), fixtures.destination_catalog(spark)
    out = None
    for mode, apply_mode in _MODES:
        one = compat.gate(_differences(spark), s, d, mode, apply_mode).select(F.lit(mode).alias("mode"), F.lit(apply_mode).alias("apply_mode"), "name", F.col("column").alias("column_name"), "outcome")
        out = one if out is None else out.unionByName(one)
    return out


_QUOTED = lambda c: f"""'"' || replace({c}, '"', '""') || '"'"""
_BAD = lambda c: f"({c} = '' OR contains({c}, chr(0)))"
APPLIED = f"""{CATALOGS}, ch AS ({_values(fixtures.CHANGED, 'namespace, name, classification, col, type_oid, typmod, nullable')}), inc AS (SELECT unnest([{', '.join(map(_literal, fixtures.INCLUDE))}]) AS t),
jo AS (SELECT ch.*, {_definition('ch.type_oid', 'ch.typmod')} AS def, d.col AS dcol, d.type_oid AS doid, d.typmod AS dmod, d.nullable AS dnull FROM ch LEFT JOIN d ON d.namespace = ch.namespace AND d.name = ch.name AND d.col = ch.col),
ou AS (SELECT *, CASE WHEN namespace || '.' || name NOT IN (FROM inc) THEN 'rejected,HIGH,table_not_supported' WHEN classification <> 'COLUMN_ADDED' THEN 'rejected,HIGH,operation_not_allowed' WHEN col IS NULL OR type_oid IS NULL THEN 'rejected,MEDIUM,source_column_metadata_missing'
  WHEN NOT nullable THEN 'rejected,MEDIUM,add_column_not_null' WHEN {_BAD('namespace')} OR {_BAD('name')} OR {_BAD('col')} THEN 'rejected,MEDIUM,invalid_identifier' WHEN def IS NULL THEN 'rejected,MEDIUM,unsupported_type' WHEN name NOT IN (FROM dt) THEN 'rejected,MEDIUM,destination_table_missing'
  WHEN dcol IS NOT NULL AND doid = type_oid AND dmod = typmod AND (NOT nullable OR dnull) THEN 'already_applied,LOW,column_already_compatible' WHEN dcol IS NOT NULL THEN 'failure,MEDIUM,schema_conflict' ELSE 'staged,LOW,awaiting_destination_commit' END AS o FROM jo),
applied AS (SELECT name, classification, col AS column_name, split_part(o, ',', 1) AS result, split_part(o, ',', 2) AS risk, split_part(o, ',', 3) AS reason, CASE WHEN o LIKE 'staged%' THEN 'ALTER TABLE ' || {_QUOTED('namespace')} || '.' || {_QUOTED('name')} || ' ADD COLUMN ' || {_QUOTED('col')} || ' ' || def END AS ddl FROM ou)"""
SQL["q28_apply_outcomes"] = f"WITH {APPLIED} SELECT * FROM applied"


def _applied(spark: SparkSession) -> DataFrame:
    return compat.apply_outcomes(fixtures.schema_changes(spark), fixtures.destination_catalog(spark), fixtures.INCLUDE)


def q28_apply_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark).select("name", "classification", F.col("column").alias("column_name"), "result", "risk", "reason", "ddl")


SQL["q29_settled"] = f"""WITH {APPLIED}, c AS (SELECT unnest([true, false]) AS committed)
SELECT committed, CASE WHEN result IN ('staged', 'already_applied') THEN CASE WHEN committed THEN 'success' ELSE 'failure' END ELSE result END AS final, CASE WHEN result IN ('staged', 'already_applied') AND NOT committed THEN 'destination_transaction_rolled_back' ELSE reason END AS final_reason, count(*) AS n
FROM applied, c GROUP BY ALL"""


def q29_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = _applied(spark).withColumn("committed", F.explode(F.array(F.lit(True), F.lit(False))))
    return compat.settled(both, F.col("committed")).groupBy("committed", "final", "final_reason").agg(F.count("*").alias("n"))


_WANTED, _MEMBERS = [("public", "clientes", 1), ("public", "enderecos", 2), ("public", 'com"aspas', 3)], [("cdc_publication", "public", "clientes"), ("other", "public", "enderecos")]
_TABLE = f"{_QUOTED('w.s')} || '.' || {_QUOTED('w.t')}"
SQL["q30_publication"] = f"""WITH w AS ({_values(_WANTED, 's, t, position')}), m AS ({_values(_MEMBERS, 'p, s, t')})
SELECT true AS there, 'add' AS action, 'ALTER PUBLICATION "cdc_publication" ADD TABLE ' || {_TABLE} AS ddl FROM w WHERE NOT EXISTS (FROM m WHERE m.p = 'cdc_publication' AND m.s = w.s AND m.t = w.t)
UNION ALL SELECT false, 'create', 'CREATE PUBLICATION "cdc_publication" FOR TABLE ' || string_agg({_TABLE}, ', ' ORDER BY position) FROM w"""


def q30_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = spark.createDataFrame(_WANTED, "schema string, table string, position int")
    members = catalog.publication_tables(spark.createDataFrame(_MEMBERS, "pubname string, schemaname string, tablename string"), "cdc_publication")
    plans = [publication.plan(wanted, members, "cdc_publication", there).select(F.lit(there).alias("there"), "action", "ddl") for there in (True, False)]
    return plans[0].unionByName(plans[1])


SQL["q31_audit"] = f"""WITH {LOG}, x AS (SELECT DISTINCT xid FROM cl) SELECT 'BEGIN' AS message_type, NULL::INT AS columns, NULL::INT AS new_width, NULL::INT AS old_width, NULL::VARCHAR AS catalog_read_status, count(*) AS n FROM x
UNION ALL SELECT 'COMMIT', NULL, NULL, NULL, NULL, count(*) - 1 FROM x UNION ALL SELECT 'RELATION', 4, NULL, NULL, 'TABLE_NOT_FOUND', count(*) FROM x WHERE (xid - 1) % 100 = 0
UNION ALL SELECT op, NULL, CASE WHEN op <> 'DELETE' THEN 4 END, CASE WHEN op <> 'INSERT' THEN 4 END, NULL, count(*) FROM cl GROUP BY op"""


def q31_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = audit.records(_frames(spark, sf_dir), fixtures.source_catalog(spark))
    none = lambda c: F.when(F.col(c) >= 0, F.col(c)).alias(c)
    return r.select("message_type", none("columns"), none("new_width"), none("old_width"), "catalog_read_status").groupBy("message_type", "columns", "new_width", "old_width", "catalog_read_status").agg(F.count("*").alias("n"))


_COUNTED = {"events_received": "(SELECT count(*) FROM cl)", "events_applied": "(SELECT count(*) FROM done)", "transactions_received": "(SELECT count(DISTINCT xid) FROM cl)", "transactions_committed": "(SELECT count(DISTINCT xid) FROM done)", "schema_metadata_relation_messages": "(SELECT count(DISTINCT xid) FROM cl WHERE (xid - 1) % 100 = 0)"}
SQL["q32_counters"] = f"WITH {LOG} " + " UNION ALL ".join(f"SELECT '{counters.json_name(k)}' AS json_name, '{counters.prometheus_name(k)}' AS prom_name, {_COUNTED.get(k, '0')} AS value" for k in counters.SCALARS)


def q32_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _frames(spark, sf_dir)
    n = lambda cond: F.count(F.when(cond, 1))
    kind = F.col("msg_type")
    seen = f.agg(n(kind.isin(*decode.DML)).alias("events_received"), n(kind == "BEGIN").alias("transactions_received"), n(kind == "COMMIT").alias("transactions_committed"), n(kind == "RELATION").alias("schema_metadata_relation_messages"))
    applied = _events(spark, sf_dir).agg(F.count("*").alias("events_applied"))
    rows = None
    for part in (seen, applied):
        one = part.select(F.explode(F.create_map(*[x for c in part.columns for x in (F.lit(c), F.col(c))])).alias("name", "value"))
        rows = one if rows is None else rows.unionByName(one)
    names = spark.createDataFrame([(k, counters.json_name(k), counters.prometheus_name(k)) for k in counters.SCALARS], "name string, json_name string, prom_name string")
    return names.join(rows, "name", "left").select("json_name", "prom_name", F.coalesce("value", F.lit(0)).alias("value"))


SQL["q33_validation_status"] = f"""WITH {CATALOGS}, asked AS (FROM st UNION ALL SELECT 'nowhere')
SELECT CASE WHEN name NOT IN (FROM st) THEN 'UNKNOWN' WHEN name IN (SELECT name FROM diff) THEN 'INCOMPATIBLE' ELSE 'COMPATIBLE' END AS status, count(*) AS n FROM asked GROUP BY 1"""


def q33_validation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = fixtures.source_catalog(spark)
    asked = s.select(*compat.TABLE).distinct().unionByName(spark.createDataFrame([("public", "nowhere")], "namespace string, name string"))
    return compat.status(asked, s, fixtures.destination_catalog(spark)).groupBy("status").agg(F.count("*").alias("n"))


SQL["q34_backoff"] = "SELECT i AS attempt, least(1000 * (1 << (i - 1)), 30000) AS delay_ms FROM (SELECT unnest(generate_series(1, 10)) AS i)"


def q34_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supervisor.schedule(spark, supervisor.Retry(), 10)


def _replica(spark: SparkSession, at: str, columns: list[str] | None = None, **options) -> Replica:
    """A replica of public.user_state in a new store."""
    store = Store(spark, f"{at}/store")
    kinds = {"user_id": ("bigint", 20), "value": ("bigint", 20)}
    store.create(spark.createDataFrame([("public", "user_state", k, c, *kinds.get(c, ("text", 25)), -1, c != "user_id", False, 1 if c == "user_id" else None) for k, c in enumerate(columns or COLUMNS, 1)], compat.CATALOG))
    return Replica(store, **({"include": ["public.user_state"]} | options))


SQL["q35_streaming_state"] = SQL["q16_replica_state"]


def q35_streaming_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of q16 by micro-batches of event files into the replica, read by the types of its catalog."""
    at, e = scratch.folder(spark), changes.events(_log(spark, sf_dir), partial=False)
    newest = e.agg(F.max("xid")).first()[0] or 1
    cut = F.floor((F.col("xid") - 1) * 3 / newest)  # three batches in log order, whole transactions in each
    for k in range(3):
        e.where(cut == k).write.mode("append").parquet(f"{at}/events/part={k}")
    sink = _replica(spark, at)
    streaming.run(spark, f"{at}/events/*", e.schema, sink, f"{at}/progress").awaitTermination()
    return sink.store.typed("public.user_state")


SQL["q36_streaming_replay"] = f"WITH {LOG} SELECT xid, commit_lsn, count(*) AS entries FROM (SELECT DISTINCT xid, commit_lsn FROM cl) GROUP BY ALL"


def q36_streaming_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after a failure between the sink's commit and the stream's: replayed transactions are in it once."""
    at, e = scratch.folder(spark), changes.events(_log(spark, sf_dir), partial=False)
    e.write.parquet(f"{at}/events")
    sink, failed = _replica(spark, at), []

    def failing(batch: DataFrame, number: int) -> None:
        sink(batch, number)
        if not failed:
            failed.append(number)
            raise RuntimeError("stopped after the sink's commit")

    for _ in range(2):
        try:
            streaming.run(spark, f"{at}/events", e.schema, failing, f"{at}/progress").awaitTermination()
        except Exception as error:
            if "stopped after the sink" not in str(error):
                raise
    return sink.store.ledger().groupBy(F.col("transaction_id").alias("xid"), "commit_lsn").agg(F.count("*").alias("entries"))


SQL["q37_wire_round_trip"] = f"""WITH {LOG}, x AS (SELECT xid, min(event_id) AS first, max(commit_lsn) AS commit_lsn FROM cl GROUP BY xid)
SELECT 'BEGIN' AS msg_type, count(*) AS n, CAST(sum(first * 64 + 1) AS BIGINT) AS positions, 0 AS new_cells, 0 AS old_cells, 0 AS chars FROM x UNION ALL SELECT 'COMMIT', count(*), sum(commit_lsn), 0, 0, 0 FROM x WHERE xid < (SELECT max(xid) FROM x)
UNION ALL SELECT 'RELATION', count(*), 0, 0, 0, 0 FROM x WHERE (xid - 1) % 100 = 0
UNION ALL SELECT op, count(*), sum(lsn), sum(CASE WHEN op <> 'DELETE' THEN 4 ELSE 0 END), sum(CASE WHEN op <> 'INSERT' THEN 4 ELSE 0 END), sum(CASE WHEN op = 'DELETE' THEN 0 ELSE length(event_type) END) FROM cl GROUP BY op"""


def q37_wire_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log as bytes of the protocol, in segments, and read back."""
    stored = scratch.written(wire.encoded(_frames(spark, sf_dir)))
    size = lambda c: F.sum(F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0))).alias(c[:3] + "_cells")
    chars = F.sum(F.coalesce(F.length(F.get("new_tuple", 1)["text"]), F.lit(0))).alias("chars")
    return wire.decoded(stored).groupBy("msg_type").agg(F.count("*").alias("n"), F.sum("wal_start").alias("positions"), size("new_tuple"), size("old_tuple"), chars)


SQL["q38_stream_from_bytes"] = SQL["q19_partial_update"].replace("AS seg FROM cl)", "AS seg FROM done)")


def q38_stream_from_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of bytes, cut anywhere in a transaction, as a stream into the replica; the last transaction stays open."""
    at = scratch.folder(spark)
    stored = scratch.written(wire.encoded(_frames(spark, sf_dir), width=20_001))
    newest = stored.agg(F.max("segment")).first()[0]
    for k in range(3):
        stored.where(F.floor(F.col("segment") * 3 / (newest + 1)) == k).coalesce(1).write.mode("append").parquet(f"{at}/segments")  # as few files as batches
    sink = _replica(spark, at)
    own = consumer.Consumer(spark, sink, f"{at}/state", changes.SOURCE, ["public.user_state"])
    segments = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/segments")
    segments.transform(wire.decoded).writeStream.foreachBatch(own).option("checkpointLocation", f"{at}/progress").trigger(availableNow=True).start().awaitTermination()
    return sink.store.typed("public.user_state")


_CLASSES = [(1, "clientes", 90, "r"), (2, "pedidos", 90, "p"), (3, "clientes_pkey", 90, "i"), (4, "clientes", 91, "r")]
_NAMESPACES = [(90, "public"), (91, "outro")]
_ATTRIBUTES = [(1, "id", 1, 20, -1, True, False), (1, "nome", 2, 1043, 34, False, False), (1, "velho", 3, 25, -1, False, True), (1, "ctid", -1, 27, -1, True, False), (2, "tenant", 1, 20, -1, True, False), (2, "id", 2, 20, -1, True, False), (2, "valor", 4, 1700, 655366, True, False), (3, "id", 1, 20, -1, True, False), (4, "id", 1, 20, -1, True, False)]
_NAMES = [(20, "int8"), (25, "text"), (27, "tid"), (1043, "varchar"), (1700, "numeric")]
_INDEXES = [(1, True, "1"), (1, False, "2"), (2, True, "2,1")]
_DEFAULTS = [(1, 1), (2, 4)]
_SYSTEM = f"""c AS ({_values(_CLASSES, 'oid, relname, ns, kind')}), n AS ({_values(_NAMESPACES, 'oid, nspname')}), a AS ({_values(_ATTRIBUTES, 'rel, attname, num, typ, typmod, filled, dropped')}), t AS ({_values(_NAMES, 'oid, typname')}),
i AS ({_values(_INDEXES, 'rel, is_pk, keys')}), f AS ({_values(_DEFAULTS, 'rel, num')}), k AS (SELECT rel, unnest(string_split(keys, ','))::INT AS num, generate_subscripts(string_split(keys, ','), 1) AS pk_position FROM i WHERE is_pk)"""
SQL["q39_catalog_read"] = f"""WITH {_SYSTEM} SELECT nspname AS namespace, relname AS name, a.num AS ordinal, attname AS column_name, typname AS data_type, typ AS type_oid, typmod, NOT filled AS nullable, f.num IS NOT NULL AS has_default, pk_position
FROM a JOIN c ON c.oid = a.rel AND kind IN ('r', 'p') JOIN n ON n.oid = c.ns JOIN t ON t.oid = typ LEFT JOIN k ON k.rel = a.rel AND k.num = a.num LEFT JOIN f ON f.rel = a.rel AND f.num = a.num WHERE a.num > 0 AND NOT dropped"""


def q39_catalog_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog from system tables: joins, and the key's columns unnested in the key's order."""
    of = lambda rows, schema: spark.createDataFrame(rows, schema)
    indexes = of(_INDEXES, "indrelid long, indisprimary boolean, indkey string").withColumn("indkey", F.split("indkey", ",").cast("array<int>"))
    out = catalog.read(
        of(_CLASSES, "oid long, relname string, relnamespace long, relkind string"),
        of(_NAMESPACES, "oid long, nspname string"),
        of(_ATTRIBUTES, "attrelid long, attname string, attnum int, atttypid long, atttypmod int, attnotnull boolean, attisdropped boolean"),
        of(_NAMES, "oid long, typname string"),
        indexes,
        of(_DEFAULTS, "adrelid long, adnum int"),
    )
    return out.withColumnRenamed("column", "column_name")


SQL["q40_added_column"] = f"""WITH {LOG}, h AS (SELECT max(xid) // 2 AS h FROM cl), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS k FROM cl)
SELECT user_id, event_type, value, CASE WHEN xid >= h THEN props END AS props FROM r, h WHERE k = 1 AND op <> 'DELETE'"""


def q40_added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the middle of the log on the source has one more column: the replica adds it in that transaction."""
    at, e = scratch.folder(spark), changes.events(_log(spark, sf_dir), partial=False)
    half = e.agg(F.max("xid")).first()[0] // 2
    e = e.withColumn("data", F.when(F.col("xid") < half, F.map_filter("data", lambda k, _: k != "props")).otherwise(F.col("data")))
    told = e.where(F.col("xid") == half).select("commit_lsn", F.lit("public").alias("namespace"), F.lit("user_state").alias("name")).distinct()
    source = _replica(spark, f"{at}/source").store.catalog()
    sink = _replica(spark, at, ["user_id", "event_type", "value"], schema_evolution="auto", source=source)
    sink.apply(e.select("source_id", "xid", "commit_lsn"), e, told)
    return sink.store.typed("public.user_state")


SQL["q41_explicit_addresses"] = """SELECT s_suppkey AS id, s_nationkey AS cliente_id, CASE WHEN s_suppkey % 2 = 0 THEN upper(s_name) ELSE s_name END AS logradouro, CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE s_name END AS bairro, 'X' AS cidade, 'SP' AS estado FROM supplier WHERE s_suppkey % 7 <> 0"""


def q41_explicit_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed column list of addresses, through the replica: absent columns of an update become null."""
    at, c = scratch.folder(spark), changes.read(spark, sf_dir, "supplier")
    row = lambda **k: F.map_from_arrays(F.array(*map(F.lit, k)), F.array(*[v.cast("string") for v in k.values()]))
    none, own = F.lit(None).cast("map<string,string>"), F.col("s_suppkey").cast("long")
    full = row(id=own, cliente_id=F.col("s_nationkey"), logradouro=F.col("s_name"), bairro=F.col("s_name"), cidade=F.lit("X"), estado=F.lit("SP"))
    less = row(id=own, cliente_id=F.col("s_nationkey"), logradouro=F.upper("s_name"), cidade=F.lit("X"), estado=F.lit("SP"))
    e = None
    for step, kind, data, old, rows in ((1, "INSERT", full, none, c), (2, "UPDATE", less, full, c.where("s_suppkey % 2 = 0")), (3, "DELETE", full, none, c.where("s_suppkey % 7 = 0"))):
        lsn = step * 1_000_000_000 + own
        one = rows.select(F.lit("s").alias("source_id"), F.lit(step).cast("long").alias("xid"), F.lit((step + 1) * 1_000_000_000).cast("long").alias("commit_lsn"), lsn.alias("lsn"), F.lit(kind).alias("type"), F.lit("public").alias("schema"), F.lit("enderecos").alias("table"), data.alias("data"), old.alias("old_data"))
        e = one if e is None else e.unionByName(one)
    store = Store(spark, f"{at}/store")
    kinds = {"id": ("bigint", 20), "cliente_id": ("bigint", 20)}
    store.create(spark.createDataFrame([("public", "enderecos", k, n, *kinds.get(n, ("text", 25)), -1, n != "id", False, 1 if n == "id" else None) for k, n in enumerate(EXPLICIT["public.enderecos"], 1)], compat.CATALOG))
    Replica(store, apply_mode="explicit")(e, 0)
    return store.typed("public.enderecos").select("id", "cliente_id", "logradouro", "bairro", "cidade", "estado")


SQL["q42_key_moves"] = "SELECT o_orderkey + 10000000000 AS id, 'inserted' AS how FROM orders WHERE o_orderkey % 9 = 0 UNION ALL SELECT o_orderkey + 20000000000, 'moved' FROM orders WHERE o_orderkey % 5 = 2"


def q42_key_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys brought to life twice, by inserts and by updates that move a row; moves of rows that aren't there do nothing."""
    own, none = F.col("o_orderkey").cast("long"), F.lit(None).cast("map<string,string>")
    far = lambda k: own + k * 10_000_000_000
    row = lambda k: F.create_map(F.lit("id"), k.cast("string"))
    steps = [
        ("INSERT", far(0), None, "true"), ("UPDATE", far(1), far(0), "o_orderkey % 3 = 0"), ("INSERT", far(0), None, "o_orderkey % 6 = 0"), ("INSERT", far(1), None, "o_orderkey % 9 = 0"),
        ("UPDATE", far(4), far(3), "o_orderkey % 4 = 1"), ("INSERT", far(4), None, "o_orderkey % 4 = 1"), ("INSERT", far(2), None, "o_orderkey % 5 = 2"), ("INSERT", far(6), None, "o_orderkey % 5 = 2"), ("UPDATE", far(2), far(6), "o_orderkey % 5 = 2"),
    ]
    e, orders = None, changes.read(spark, sf_dir, "orders").select("o_orderkey")
    for k, (kind, to, old, cond) in enumerate(steps, 1):
        one = orders.where(cond).select((own * 16 + k).alias("lsn"), (own * 16 + k).alias("commit_lsn"), F.lit(kind).alias("type"), row(to).alias("data"), (none if old is None else row(old)).alias("old_data"))
        e = one if e is None else e.unionByName(one)
    found = apply.conflicts(None, apply.effective(None, e, ["id"]), ["id"])
    return found.select(F.col("id").cast("long").alias("id"), F.when(F.col("lsn") % 16 == 9, "moved").otherwise("inserted").alias("how"))


SQL["q43_empty_transactions"] = f"WITH {LOG} SELECT xid, commit_lsn, count(*) FILTER (event_id % 10 >= 5) AS events, 1 AS entries FROM done GROUP BY xid, commit_lsn"


def q43_empty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the transactions are empty: they are in the ledger all the same, from their COMMITs."""
    at = scratch.folder(spark)
    f = scratch.written(_frames(spark, sf_dir).where("NOT (msg_type IN ('INSERT', 'UPDATE', 'DELETE') AND floor(seq / 4) % 10 < 5)"))
    done, sink = scratch.written(decode.committed(f)), _replica(spark, at)
    sink.apply(done, decode.assemble(f).where("false"))
    entries = sink.store.ledger().groupBy("commit_lsn").agg(F.count("*").cast("int").alias("entries"))
    return done.join(entries, "commit_lsn").select("xid", "commit_lsn", "events", "entries")


SQL["q44_published"] = f"WITH {LOG} SELECT op AS msg_type, count(*) AS n FROM cl WHERE event_id % 2 = 0 GROUP BY op UNION ALL SELECT 'BEGIN', count(DISTINCT xid) FROM cl UNION ALL SELECT 'COMMIT', count(DISTINCT xid) FROM done UNION ALL SELECT 'RELATION', count(DISTINCT xid) FROM cl WHERE (xid - 1) % 100 = 0"


def q44_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of odd events belong to another relation, which the publication leaves out."""
    f = _frames(spark, sf_dir)
    other = F.when(F.col("msg_type").isin(*decode.DML) & (F.floor(F.col("seq") / 4) % 2 == 1), 8).otherwise(F.col("relation_id"))
    f = f.withColumn("relation_id", other.cast("long"))
    more = f.where("msg_type = 'RELATION'").withColumns({"relation_id": F.lit(8).cast("long"), "relation_name": F.lit("outra"), "seq": F.col("seq") - 2})
    return wire.published(f.unionByName(more), ["public.user_state"]).groupBy("msg_type").agg(F.count("*").alias("n"))


_BAD_XID = f"(SELECT xid FROM cl WHERE event_id = {_HALF})"
SQL["q45_sink_counters"] = f"""WITH {LOG}, n AS (SELECT count(DISTINCT xid) FILTER (xid * 4 <= (SELECT max(xid) FROM cl)) AS quarter, count(*) FILTER (xid * 4 <= (SELECT max(xid) FROM cl)) AS quarter_events, count(DISTINCT xid) FILTER (xid < {_BAD_XID}) AS good, count(*) FILTER (xid < {_BAD_XID}) AS good_events FROM cl)
SELECT 'transactions_committed' AS name, quarter + good AS value FROM n UNION ALL SELECT 'transactions_replayed', quarter FROM n UNION ALL SELECT 'events_applied', good_events FROM n UNION ALL SELECT 'transactions_failed', 1 UNION ALL SELECT 'sink_errors', 1 UNION ALL SELECT 'validation_compatible', good_events FROM n"""


def q45_sink_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the log, then all of it with a poisoned transaction in the middle: what the sink has counted."""
    at, e = scratch.folder(spark), scratch.written(changes.events(_log(spark, sf_dir), partial=False))
    newest, half = e.agg(F.max("xid")).first()[0], e.agg(F.max("seq")).first()[0] // 2
    first = e.where((F.col("seq") >= half) & (F.col("type") != "DELETE")).agg(F.min("seq")).first()[0]
    bad = e.where(F.col("seq") == first).withColumns({"type": F.lit("INSERT"), "lsn": F.col("lsn") + 1, "old_data": F.lit(None).cast("map<string,string>")})
    sink = _replica(spark, at)
    sink(e.where(F.col("xid") * 4 <= newest), 0)
    try:
        sink(e.unionByName(bad), 1)
    except Rejected:
        rows = [(k, int(v)) for k, v in sink.counters.items()] + [("validation_compatible", sink.statuses["COMPATIBLE"])]
        return spark.createDataFrame(rows, "name string, value long")
    raise AssertionError("the poisoned transaction went through")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[0] == "q" and k[1:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
