"""The replica: whole transactions into keyed tables, in commit order, each of them once.

What a transaction must pass, in this order: the event contract; the compatibility of the relations that it describes, by
which columns may be added; its events' tables and columns; the include list; the keys. The first transaction that fails
stops those after it; the ones before it are committed, with the columns that they add and a ledger row for each, empty
transactions included. Then the failure is raised, and a later attempt finds the failed transaction first.

A batch is checked as a whole, by DataFrames: each check says at which position it fails first, and the least position
counts. Only that position, columns to be added and counts reach the driver.
"""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lsn
from ..sources.scratch import written
from . import apply, compat, contract, filters, ledger
from .store import Store

log = logging.getLogger("tidelog.replica")

# The tables and column lists of the explicit mode.
EXPLICIT = {
    "public.clientes": ("id", "nome", "email"),
    "public.enderecos": ("id", "cliente_id", "logradouro", "numero", "complemento", "bairro", "cidade", "estado", "cep"),
}
#: Checks in the order in which a transaction meets them.
CONTRACT, SCHEMA, DDL, TABLE, INCLUDE, KEY = range(6)
PROBLEM = "commit_lsn long, stage int, lsn long, reason string"
TRANSACTIONS = ["source_id", "xid", "commit_lsn"]


class Rejected(ValueError):
    """A transaction that the replica refuses; commit_lsn is its position."""

    def __init__(self, reason: str, commit_lsn: int):
        super().__init__(f"{reason} (transaction at {commit_lsn >> 32:X}/{commit_lsn & 0xFFFFFFFF:X})")
        self.reason, self.commit_lsn = reason, commit_lsn


@dataclass
class Replica:
    """A sink: apply() takes transactions, their events and relations; a call takes events alone, as foreachBatch does.

    source: the catalog of the source; without one nothing is validated and no column is added. fail: a hook for tests,
    called with the batch's number before the commit.
    """

    store: Store
    include: Sequence[str] = ()
    apply_mode: str = "generic"
    schema_evolution: str = "disabled"
    source: DataFrame | None = None
    fail: Callable[[int], None] | None = None
    counters: Counter = field(default_factory=Counter)
    statuses: Counter = field(default_factory=Counter)

    @property
    def name(self) -> str:
        return f"postgres:{self.apply_mode}"

    def ready(self) -> bool:
        """Whether the store can be read."""
        self.store.current()
        return True

    def close(self) -> None:
        """Nothing stays open between batches."""

    def __call__(self, events: DataFrame, batch: int) -> None:
        self.apply(events.select(*TRANSACTIONS).distinct(), events, batch=batch)

    def apply(self, transactions: DataFrame, events: DataFrame, relations: DataFrame | None = None, batch: int = 0) -> None:
        """transactions(source_id, xid, commit_lsn), their events, and relations(commit_lsn, namespace, name) they describe."""
        done = self.store.ledger()
        every = transactions.select(*TRANSACTIONS).distinct()
        transactions, events = written(ledger.unapplied(every, done)), written(ledger.unapplied(events, done))
        relations = self._open(relations, transactions)
        problems, staged, outcomes = self._schema(relations)
        catalog = self._catalog(staged)
        problems += [self._contract(events), self._tables(events, catalog), self._listed(events)]
        tables = {}
        for name in sorted(self._keys(catalog)):
            key, columns = self._keys(catalog)[name]
            own = events.where(filters.qualified() == name)
            if own.first() is not None:
                problems.append(self._keyed(name, own, key))
                tables[name] = key, columns, own
        first = self._first(problems)
        good = (lambda df: df) if first is None else (lambda df: df.where(F.col("commit_lsn") < first["commit_lsn"]))
        changes = {name: self._state(name, good(own), key, columns) for name, (key, columns, own) in tables.items()}
        applied = [c for c in staged if first is None or c["commit_lsn"] < first["commit_lsn"]]
        entries = ledger.entries(good(transactions))
        if self.fail:
            self.fail(batch)
        if entries.first() is not None:
            named = {name: c for name, c in changes.items() if c is not None}
            self.store.commit(named, entries, self._catalog(applied) if applied else None)
        self._count(every, transactions, good, events, outcomes, first)
        if first is not None:
            raise Rejected(first["reason"], first["commit_lsn"])

    def _open(self, relations: DataFrame | None, transactions: DataFrame) -> DataFrame | None:
        """namespace, name, n and the first commit_lsn of the relations that are to be validated."""
        if relations is None or self.source is None:
            return None
        named = F.concat_ws(".", "namespace", "name")
        rows = relations.where(filters.should_validate(named, list(self.include))).join(transactions.select("commit_lsn").distinct(), "commit_lsn", "left_semi")
        return written(rows.groupBy(*compat.TABLE).agg(F.min("commit_lsn").alias("commit_lsn"), F.count("*").alias("n")))

    def _schema(self, relations: DataFrame | None) -> tuple[list[DataFrame], list[dict], list[dict]]:
        """Problems of compatibility, columns to be added, and the outcome of each change that was considered."""
        if relations is None:
            return [], [], []
        destination = self.store.catalog()
        source = self.source.join(relations.select(*compat.TABLE), compat.TABLE, "left_semi")
        status = written(compat.status(relations.select(*compat.TABLE, "n", "commit_lsn"), source, destination, keep=["n", "commit_lsn"]))
        for r in status.groupBy("status").agg(F.sum("n").alias("n")).collect():
            self.statuses[r["status"]] += r["n"]
        where = F.concat(F.lit("schema validation rejected "), filters.qualified("namespace", "name"), F.lit(": "))
        problem = lambda df, reason, stage=SCHEMA: df.select("commit_lsn", F.lit(stage).alias("stage"), F.lit(0).cast("long").alias("lsn"), F.concat(where, reason).alias("reason"))
        out = [problem(status.where("status = 'UNKNOWN'"), F.lit("UNKNOWN"))]
        found = compat.gate(compat.compare(source, destination), source, destination, self.schema_evolution, self.apply_mode)
        found = written(found.join(relations.select(*compat.TABLE, "commit_lsn"), compat.TABLE))
        out.append(problem(found.where("outcome <> 'candidate'"), F.concat_ws(" ", "type", F.concat(F.lit("column="), "column"), F.regexp_replace("outcome", "^error:", ""))))
        shape = source.select(*compat.TABLE, "column", "type_oid", "typmod", "nullable", "data_type")
        changes = found.where("outcome = 'candidate'").select(*compat.TABLE, F.lit("COLUMN_ADDED").alias("classification"), "column", "commit_lsn").join(shape, [*compat.TABLE, "column"])
        outcomes = [r.asDict() for r in compat.apply_outcomes(changes, destination, list(self.include), self.schema_evolution).collect()]  # one for each column
        failed = [(r["commit_lsn"], DDL, 0, f"schema conflict in {r['namespace']}.{r['name']}: column {r['column']}") for r in outcomes if r["result"] == "failure"]
        out.append(self.store.spark.createDataFrame(failed, PROBLEM))
        return out, [r for r in outcomes if r["result"] == "staged"], outcomes

    def _catalog(self, staged: list[dict]) -> DataFrame:
        """The destination's catalog once columns are added; since is the position from which a column is there."""
        have = self.store.catalog().withColumn("since", F.lit(-1).cast("long"))
        if not staged:
            return have
        added = self.store.spark.createDataFrame([(r["namespace"], r["name"], 0, r["column"], r["data_type"], r["type_oid"], r["typmod"], True, False, None, r["commit_lsn"]) for r in staged], f"{compat.CATALOG}, since long")
        last = have.groupBy(*compat.TABLE).agg(F.max("ordinal").alias("last"))
        place = F.row_number().over(compat.Window.partitionBy(*compat.TABLE).orderBy("since", "column"))
        return have.unionByName(added.withColumn("place", place).join(last, compat.TABLE).withColumn("ordinal", (F.col("last") + F.col("place")).cast("int")).drop("place", "last"))

    def _keys(self, catalog: DataFrame) -> dict[str, tuple[list[str], list[str]]]:
        """Key and columns, in their order, of each table that takes part; one row for each column reaches the driver."""
        rows = sorted(catalog.collect(), key=lambda r: r["ordinal"])
        out = {}
        for r in rows:
            name = f"{r['namespace']}.{r['name']}"
            if name in (EXPLICIT if self.apply_mode == "explicit" else self.include):
                key, columns = out.setdefault(name, ([], []))
                columns.append(r["column"])
                if r["pk_position"] is not None:
                    key.append((r["pk_position"], r["column"]))
        return {name: ([c for _, c in sorted(key)], columns) for name, (key, columns) in out.items() if key}

    def _contract(self, events: DataFrame) -> DataFrame:
        rows = contract.violations(events.select("commit_lsn", F.col("lsn").alias("position"), lsn.format(F.col("lsn")).alias("lsn"), F.col("xid").alias("transaction_id"), "schema", "table", "type", "data", "old_data"))
        return rows.where("violation IS NOT NULL").select("commit_lsn", F.lit(CONTRACT).alias("stage"), F.col("position").alias("lsn"), F.col("violation").alias("reason"))

    def _tables(self, events: DataFrame, catalog: DataFrame) -> DataFrame:
        rows = compat.event_column_differences(events, catalog, keyed=self.apply_mode == "generic").where("problem IS NOT NULL")
        reason = F.concat(F.lit("schema validation rejected "), filters.qualified(), F.lit(": "), F.concat_ws(" ", "problem", F.concat(F.lit("column="), "column")))
        return rows.select("commit_lsn", F.lit(TABLE).alias("stage"), "lsn", reason.alias("reason"))

    def _listed(self, events: DataFrame) -> DataFrame:
        listed = list(EXPLICIT if self.apply_mode == "explicit" else self.include)
        rows = filters.include(events, listed).where("excluded")
        return rows.select("commit_lsn", F.lit(INCLUDE).alias("stage"), "lsn", F.concat(F.lit("table outside the include list: "), filters.qualified()).alias("reason"))

    def _touched(self, events: DataFrame, key: list[str]) -> list[int]:
        """Buckets of the rows that events are about; as many as there are, at most."""
        rows = apply.split_key_changes(events, key)
        return [r[0] for r in rows.select(self.store.bucket_of([apply.key_value(k) for k in key])).distinct().collect()]

    def _keyed(self, name: str, events: DataFrame, key: list[str]) -> DataFrame:
        wrong = events.withColumn("absent", apply.key_violation(key)).where("absent IS NOT NULL").select("commit_lsn", F.lit(KEY).alias("stage"), "lsn", F.concat(F.lit(f"{name}: event without key column "), "absent").alias("reason"))
        base = self.store.table(name, self._touched(events, key))
        events = apply.effective(base, self._fixed(events), key)
        clash = apply.conflicts(base, events, key)
        return wrong.unionByName(clash.select("commit_lsn", F.lit(KEY).alias("stage"), "lsn", F.concat(F.lit(f"insert on a live key of {name}: "), F.concat_ws(",", *key)).alias("reason")))

    def _fixed(self, events: DataFrame) -> DataFrame:
        """Fixed column lists find rows by the new key, so no update moves a row."""
        return events.withColumn("old_data", F.lit(None).cast("map<string,string>")) if self.apply_mode == "explicit" else events

    def _state(self, name: str, events: DataFrame, key: list[str], columns: list[str]) -> tuple[DataFrame, list[str], list[int]] | None:
        if events.first() is None:
            return None
        touched = self._touched(events, key)
        base = self.store.table(name, touched, columns)
        events = apply.effective(base, self._fixed(events), key)
        return apply.state(base, events, key, columns, "null" if self.apply_mode == "explicit" else "keep"), key, touched

    def _first(self, problems: list[DataFrame]) -> dict | None:
        every = problems[0]
        for p in problems[1:]:
            every = every.unionByName(p)
        got = every.agg(F.min(F.struct("commit_lsn", "stage", "lsn", "reason")).alias("x")).first()["x"]
        return None if got is None else got.asDict()

    def _count(self, every: DataFrame, transactions: DataFrame, good, events: DataFrame, outcomes: list[dict], first: dict | None) -> None:
        """Counters as they are published: transactions that the ledger knew count as committed again."""
        n, new, events_applied = every.count(), transactions.count(), good(events).count()
        committed = n - new + good(transactions).count()
        self.counters.update({"transactions_committed": committed, "events_applied": events_applied, "transactions_replayed": n - new})
        self.statuses["COMPATIBLE"] += events_applied  # each event's table is validated as well
        if first is not None:
            self.counters.update({"transactions_failed": 1, "sink_errors": 1})
            self.statuses["INCOMPATIBLE"] += first["stage"] == TABLE
        for r in outcomes:
            if first is not None and r["commit_lsn"] > first["commit_lsn"]:
                continue
            open_ = r["result"] in ("staged", "already_applied")
            rolled = open_ and first is not None and r["commit_lsn"] == first["commit_lsn"]
            result = "failure" if rolled else "success" if open_ else r["result"]
            self.counters.update({"schema_apply_attempts": int(r["result"] == "staged"), f"schema_apply_{result}": 1})
            log.info("event=schema_apply result=%s risk=%s reason=%s table=%s.%s column=%s", result, r["risk"], "destination_transaction_rolled_back" if rolled else r["reason"], r["namespace"], r["name"], r["column"])
        log.info("event=transactions_committed sink=%s transactions=%d replayed=%d events=%d", self.name, committed, n - new, events_applied)
        if first is not None:
            log.error("event=transaction_rejected commit_lsn=%d reason=%s", first["commit_lsn"], first["reason"])
