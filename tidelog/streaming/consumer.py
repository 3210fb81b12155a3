"""From a stream of frames to a sink, a micro-batch at a time.

Frames of transactions that are still open, and the last message of each relation, are kept as a table beside the stream's
checkpoint, under the number of the batch that needs them next, so a repeated batch finds the same. Every batch then is an
ordinary log: it is checked, assembled and handed to the sink as whole transactions, and what follows its last COMMIT is
kept. A new connection (epoch) drops what the one before it left open. Where order or contents of the messages are broken,
the transactions before the breach go to the sink, then the batch fails.
"""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import decode, relations
from ..sources import frames as protocol
from ..sources.config import Config
from ..sources.scratch import written
from .progress import Progress

log = logging.getLogger("tidelog.consumer")


class Broken(ValueError):
    """A breach of the protocol; the connection ends."""


class Consumer:
    """foreachBatch over frames. sink: Replica, Lines or anything with their apply() and counters.

    before_ack is called with the events of a batch after the sink has taken it and before progress moves; a test may stop
    there.
    """

    def __init__(self, spark: SparkSession, sink, state: str, source_id: str = "cdc-demo", tables: list[str] | None = None, progress: Progress | None = None, before_ack: Callable[[DataFrame], None] | None = None):
        self.spark, self.sink, self.state, self.source_id, self.tables = spark, sink, state.rstrip("/"), source_id, tables
        self.progress, self.before_ack, self.counters = progress or Progress(), before_ack, Counter()
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._path, self._fs = path, path(self.state).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _open(self, batch: int) -> DataFrame | None:
        at = f"{self.state}/open={batch}"
        return self.spark.read.schema(protocol.SCHEMA).parquet(at) if self._fs.exists(self._path(f"{at}/_SUCCESS")) else None

    def __call__(self, frames: DataFrame, batch: int) -> None:
        new = written(frames.select(*protocol.NAMES))
        kept = self._open(batch)
        rows = new if kept is None else kept.unionByName(new)
        if self.tables is not None:
            rows = protocol.published(rows, self.tables)
        rows = written(rows.where(F.col("msg_type") != protocol.KEEPALIVE))
        message = F.col("msg_type") == "RELATION"
        wrong = F.when(message, relations.invalid(F.col("relation_id"), F.col("namespace"), F.col("relation_name"), F.col("columns")))
        bad = decode.protocol_errors(rows).unionByName(rows.withColumn("error", wrong).where("error IS NOT NULL").select("epoch", "seq", "error"))
        first = bad.agg(F.min(F.struct("epoch", "seq", "error")).alias("x")).first()["x"]
        good = rows if first is None else rows.where(F.struct("epoch", "seq") < F.struct(F.lit(first["epoch"]), F.lit(first["seq"])))
        transactions, events = decode.committed(good, self.source_id), decode.assemble(good, self.source_id)
        told = decode.placed(good).where((F.col("msg_type") == "RELATION") & (F.col("depth") == 1) & (F.col("bracket.msg_type") == "COMMIT"))
        told = told.select(F.col("bracket.end_lsn").alias("commit_lsn"), "namespace", F.col("relation_name").alias("name"))
        self._count(new, rows if kept is None else rows.join(kept.select("epoch", "seq"), ["epoch", "seq"], "left_anti"), rows)
        self.sink.apply(transactions, events, told, batch)  # a failure there is counted there
        if self.before_ack:
            self.before_ack(events)
        self._keep(rows, batch)
        ends = transactions.agg(F.max("commit_lsn").alias("lsn")).first()["lsn"]
        if first is not None:
            self.counters["sink_errors"] += 1  # errors of decoding count here too
            log.error("event=protocol_error epoch=%d seq=%d reason=%s", first["epoch"], first["seq"], first["error"])
            raise Broken(f"{first['error']} at frame {first['seq']} of epoch {first['epoch']}")
        if ends is not None:
            self.progress.advance(max(ends, self.progress.processed))
        if self.progress.due() or new.where((F.col("msg_type") == protocol.KEEPALIVE) & (F.col("old_kind") == "r")).first() is not None:
            self.progress.confirm()

    def _keep(self, rows: DataFrame, batch: int) -> None:
        """Of the last epoch: the last message of each relation, and what follows the last COMMIT."""
        last = rows.agg(F.max("epoch").alias("e")).first()["e"]
        rows = rows.where(F.col("epoch") == last)
        end = rows.where("msg_type = 'COMMIT'").agg(F.max("seq").alias("s")).first()["s"]
        known = rows.where("msg_type = 'RELATION'").groupBy("relation_id").agg(F.max("seq").alias("s")).select(F.col("s").alias("seq"))
        before = rows.where(F.col("seq") <= (-1 if end is None else end)).join(known, "seq", "left_semi").select(*protocol.NAMES)
        rows.where(F.col("seq") > (-1 if end is None else end)).unionByName(before).write.mode("overwrite").parquet(f"{self.state}/open={batch + 1}")
        self._fs.delete(self._path(f"{self.state}/open={batch - 1}"), True)

    def _count(self, arrived: DataFrame, new: DataFrame, rows: DataFrame) -> None:
        """arrived: all frames of the batch; new: those that are published; rows: with what earlier batches left."""
        at = arrived.agg(F.max("wal_start").alias("received"), F.max("server_wal_end").alias("end")).first()
        self.progress.saw(at["received"], at["end"])
        n = lambda cond: F.count(F.when(cond, 1))
        kind = F.col("msg_type")
        got = new.agg(n(kind.isin(*decode.DML)).alias("events_received"), n(kind == "BEGIN").alias("transactions_received"), n(kind == "RELATION").alias("schema_metadata_relation_messages")).first()
        self.counters.update(got.asDict())
        if got["schema_metadata_relation_messages"]:
            shape = F.transform("columns", lambda c: F.struct(c["name"], c["type_oid"], c["typmod"])).alias("columns")
            own = rows.where("msg_type = 'RELATION'").select("epoch", "seq", "relation_id", "namespace", F.col("relation_name").alias("name"), shape)
            seen = relations.observe(own, strict=False).join(new.select("epoch", "seq"), ["epoch", "seq"], "left_semi")  # others were counted before
            for r in seen.orderBy("epoch", "seq", "ordinal").collect():  # changes of relations, a few for each
                self.counters.update({"schema_metadata_changes": 1, "schema_metadata_unknown": int(r["classification"] == "UNKNOWN")})
                log.warning("event=schema_change relation_id=%d classification=%s column=%s reason=%s", r["relation_id"], r["classification"], r["column"], r["reason"])

    def values(self) -> dict[str, int]:
        """All counters, the sink's included."""
        return dict(self.counters + self.sink.counters)


def start(spark: SparkSession, path: str, consumer: Consumer, checkpoint: str, files: int = 64) -> StreamingQuery:
    """Applies all segments under path that the checkpoint hasn't seen, then stops."""
    frames = protocol.decoded(protocol.segments(spark, path, stream=True, files=files))
    return frames.writeStream.foreachBatch(consumer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def from_config(spark: SparkSession, config: Config, state: str, store: str = "", source: DataFrame | None = None, echo: Callable[[str], None] | None = print) -> Consumer:
    """A consumer, its sink and its progress, as the settings say."""
    from ..operators.sinks import open_sink

    pause = (lambda events: _stop(events, config.pause_match)) if config.pause_before_ack or config.pause_after_commit else None
    return Consumer(spark, open_sink(config, spark, store, source, echo), state, config.source_id, list(config.tables), Progress(interval=config.status_interval), pause)


class Paused(RuntimeError):
    """A test asked to stop between the sink and the acknowledgement."""


def _stop(events: DataFrame, match: str) -> None:
    from ..operators.sinks import lines

    if not match or lines(events).where(F.contains("line", F.lit(match))).first() is not None:
        raise Paused("stopped before the acknowledgement")
