"""Sinks: JSON Lines and the replica. Both are callables for foreachBatch as well as for batches."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lsn
from .replica import Replica
from .store import Store


def lines(events: DataFrame) -> DataFrame:
    """commit_lsn, ordinal, line: the JSON of each event, keys in contract order, absent maps left out, map keys sorted."""
    ordered = lambda c: F.when(F.size(c) > 0, F.map_from_entries(F.array_sort(F.map_entries(c))))
    fields = {"type": F.to_json(F.array("type")), "lsn": F.to_json(F.array(lsn.format(F.col("lsn")))), "transaction_id": F.to_json(F.array("xid")), "schema": F.to_json(F.array("schema")), "table": F.to_json(F.array("table"))}
    parts = [F.concat(F.lit(f'"{k}":'), F.regexp_extract(v, r"(?s)^\[(.*)\]$", 1)) for k, v in fields.items()]
    # maps, not structs: a null inside a map stays, a null field of a struct would vanish
    parts += [F.when(ordered(F.col(c)).isNotNull(), F.concat(F.lit(f'"{c}":'), F.to_json(ordered(F.col(c))))) for c in ("data", "old_data")]
    return events.select("commit_lsn", "ordinal", F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("line"))


def jsonl(path: str) -> Callable[[DataFrame, int], None]:
    """At least once: each batch has a folder of its own that a repeated batch replaces; lines are in commit order."""

    def write(events: DataFrame, batch: int) -> None:
        lines(events).orderBy("commit_lsn", "ordinal").select("line").write.mode("overwrite").text(f"{path}/batch={batch}")

    return write


class Lines:
    """The file sink: jsonl() with a name, optional echo of each line, and hooks for tests.

    fail_match: writing a line that holds this text fails, as a full disk would; lines of the batch before it stay.
    """

    name = "file"

    def __init__(self, path: str, echo: Callable[[str], None] | None = None, fail_match: str = ""):
        self.path, self.echo, self.fail_match, self.counters = path, echo, fail_match, Counter()

    def ready(self) -> bool:
        return True

    def close(self) -> None:
        """Nothing stays open between batches."""

    def __call__(self, events: DataFrame, batch: int) -> None:
        self.apply(events.select("source_id", "xid", "commit_lsn").distinct(), events, batch=batch)

    def apply(self, transactions: DataFrame, events: DataFrame, relations: DataFrame | None = None, batch: int = 0) -> None:
        bad = None
        if self.fail_match:
            found = lines(events).where(F.contains("line", F.lit(self.fail_match))).agg(F.min(F.struct("commit_lsn", "ordinal")).alias("x")).first()["x"]
            bad = found and (found["commit_lsn"], found["ordinal"])
        if bad:
            events = events.where((F.col("commit_lsn") < bad[0]) | ((F.col("commit_lsn") == bad[0]) & (F.col("ordinal") < bad[1])))
        jsonl(self.path)(events, batch)
        if self.echo:
            for r in lines(events).orderBy("commit_lsn", "ordinal").select("line").toLocalIterator():
                self.echo(r["line"])
        self.counters.update({"events_applied": events.count(), "transactions_committed": transactions.count() if not bad else transactions.where(F.col("commit_lsn") < bad[0]).count()})
        if bad:
            self.counters.update({"transactions_failed": 1, "sink_errors": 1})
            raise OSError(f"a line that holds {self.fail_match!r} couldn't be written")


def open_sink(config, spark: SparkSession, store: str = "", source: DataFrame | None = None, echo: Callable[[str], None] | None = None):
    """The sink that the settings name."""
    if config.sink == "file":
        return Lines(config.output, echo, config.fail_write_match)
    return Replica(Store(spark, store), config.tables, config.apply_mode, config.schema_evolution, source)
