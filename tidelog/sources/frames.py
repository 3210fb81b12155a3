"""Frames of a logical replication stream: their schema, the binary protocol, and readers of stored frames.

A segment is a file of records: length (4 bytes), epoch (4 bytes), then one message of the copy stream as the server sends
it: 'w' (start, server's end, time, one logical message) or 'k' (server's end, time, whether a reply is asked for).
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader
from pyspark.sql.types import LongType

_COLUMNS = "array<struct<name:string,key:boolean,type_oid:bigint,typmod:int>>"
_CELLS = "array<struct<kind:string,text:string>>"
SCHEMA = (
    f"seq bigint, epoch int, wal_start bigint, server_wal_end bigint, msg_type string, xid bigint, final_lsn bigint, commit_lsn bigint, end_lsn bigint, commit_time bigint, relation_id bigint, namespace string, relation_name string, "
    f"replica_identity int, columns {_COLUMNS}, new_tuple {_CELLS}, old_tuple {_CELLS}, old_kind string"
)
NAMES = [f.strip().split(" ")[0] for f in SCHEMA.replace(_COLUMNS, "x").replace(_CELLS, "x").split(",")]
#: Names of the message tags that are decoded; others are kept as OTHER.
TAGS = {"B": "BEGIN", "C": "COMMIT", "R": "RELATION", "I": "INSERT", "U": "UPDATE", "D": "DELETE", "Y": "TYPE", "O": "ORIGIN", "T": "TRUNCATE"}
#: A record of the server's clock, no message of the log; `reply` is in old_kind: 'r' where one is asked for.
KEEPALIVE = "KEEPALIVE"
#: Places in the order of frames that a segment has.
SEGMENT = 1 << 32


class Malformed(ValueError):
    """Bytes that aren't a message."""


class _Bytes:
    def __init__(self, b: bytes):
        self.b, self.i = b, 0

    def take(self, form: str):
        form = ">" + form
        n = struct.calcsize(form)
        if self.i + n > len(self.b):
            raise Malformed("message is cut off")
        out = struct.unpack_from(form, self.b, self.i)
        self.i += n
        return out[0] if len(out) == 1 else out

    def bytes(self, n: int) -> bytes:
        if self.i + n > len(self.b):
            raise Malformed("message is cut off")
        self.i += n
        return self.b[self.i - n : self.i]

    def text(self) -> str:
        end = self.b.find(b"\0", self.i)
        if end < 0:
            raise Malformed("text without an end")
        out, self.i = self.b[self.i : end].decode(), end + 1
        return out

    def cells(self) -> list[dict]:
        out = []
        for _ in range(self.take("H")):
            kind = chr(self.take("B"))
            if kind not in "nutb":
                raise Malformed(f"unknown cell kind {kind!r}")
            out.append({"kind": kind, "text": self.bytes(self.take("I")).decode(errors="replace") if kind in "tb" else None})
        return out


def parse(message: bytes) -> dict:
    """Fields of one logical message, by the names of SCHEMA."""
    b = _Bytes(message)
    tag = chr(b.take("B"))
    out: dict = {"msg_type": TAGS.get(tag, "OTHER")}
    if tag == "B":
        out["final_lsn"], out["commit_time"], out["xid"] = b.take("QQI")
    elif tag == "C":
        _, out["commit_lsn"], out["end_lsn"], out["commit_time"] = b.take("BQQQ")
    elif tag == "R":
        out["relation_id"] = b.take("I")
        out["namespace"], out["relation_name"] = b.text(), b.text()
        out["replica_identity"], n = b.take("BH")
        out["columns"] = []
        for _ in range(n):
            flags, name = b.take("B"), b.text()
            oid, typmod = b.take("Ii")
            out["columns"].append({"name": name, "key": bool(flags & 1), "type_oid": oid, "typmod": typmod})
    elif tag in "IUD":
        out["relation_id"] = b.take("I")
        while b.i < len(message):
            part = chr(b.take("B"))
            if part == "N":
                out["new_tuple"] = b.cells()
            elif part in "KO":
                out["old_kind"], out["old_tuple"] = part, b.cells()
            else:
                raise Malformed(f"unknown tuple kind {part!r}")
        if ("old_tuple" if tag == "D" else "new_tuple") not in out:
            raise Malformed("message without its row")
    return out


def parse_copy(data: bytes) -> dict:
    """Fields of one message of the copy stream: a logical message with its positions, or a keepalive."""
    b = _Bytes(data)
    kind = chr(b.take("B"))
    if kind == "w":
        start, end, _ = b.take("QQQ")
        return parse(data[b.i :]) | {"wal_start": start, "server_wal_end": end}
    if kind == "k":
        end, _, reply = b.take("QQB")
        return {"msg_type": KEEPALIVE, "wal_start": 0, "server_wal_end": end, "old_kind": "r" if reply else None}
    raise Malformed(f"unknown copy message {kind!r}")


def _cells(cells: list) -> bytes:
    out = struct.pack(">H", len(cells))
    for c in cells:  # None: null; ...: unchanged; text otherwise
        out += b"n" if c is None else b"u" if c is ... else b"t" + struct.pack(">I", len(c.encode())) + c.encode()
    return out


def begin(xid: int, final_lsn: int, time: int = 0) -> bytes:
    return b"B" + struct.pack(">QQI", final_lsn, time, xid)


def commit(commit_lsn: int, end_lsn: int, time: int = 0) -> bytes:
    return b"C" + struct.pack(">BQQQ", 0, commit_lsn, end_lsn, time)


def relation(id_: int, namespace: str, name: str, columns: list[tuple[str, bool, int, int]], identity: str = "f") -> bytes:
    body = b"".join(struct.pack(">B", key) + c.encode() + b"\0" + struct.pack(">Ii", oid, typmod) for c, key, oid, typmod in columns)
    return b"R" + struct.pack(">I", id_) + namespace.encode() + b"\0" + name.encode() + b"\0" + struct.pack(">BH", ord(identity), len(columns)) + body


def change(kind: str, id_: int, new: list | None = None, old: list | None = None, old_kind: str = "O") -> bytes:
    """An INSERT, UPDATE or DELETE message."""
    return kind[0].encode() + struct.pack(">I", id_) + (old_kind.encode() + _cells(old) if old is not None else b"") + (b"N" + _cells(new) if new is not None else b"")


def xlog(message: bytes, start: int, end: int = 0, time: int = 0) -> bytes:
    """A logical message in the copy stream."""
    return b"w" + struct.pack(">QQQ", start, end or start, time) + message


def keepalive(end: int, reply: bool = False, time: int = 0) -> bytes:
    return b"k" + struct.pack(">QQB", end, time, reply)


def record(data: bytes, epoch: int = 1) -> bytes:
    """A message of the copy stream as a segment holds it."""
    return struct.pack(">II", len(data), epoch) + data


def framed(messages: list[bytes], start: int = 64, epoch: int = 1) -> bytes:
    """A segment of logical messages, 64 positions apart."""
    return b"".join(record(xlog(m, start + 64 * k), epoch) for k, m in enumerate(messages))


def records(segment: bytes) -> Iterator[dict]:
    """Fields of each record of a segment; Malformed where the last one is cut off."""
    b = _Bytes(segment)
    while b.i < len(segment):
        n, epoch = b.take("II")
        yield parse_copy(b.bytes(n)) | {"epoch": epoch}


def _row(fields: dict) -> tuple:
    return tuple([tuple(x.values()) for x in v] if isinstance(v := fields.get(c), list) else v for c in NAMES)


def encoded(frames: DataFrame, width: int = 4096) -> DataFrame:
    """segment and content: frames(SCHEMA) in the binary protocol, `width` positions of their order in a segment."""

    def cells(some) -> list | None:
        return None if some is None else [... if c["kind"] == "u" else None if c["kind"] == "n" else c["text"] for c in some]

    def message(r: dict) -> bytes:
        kind = r["msg_type"]
        if kind == "BEGIN":
            return begin(r["xid"], r["final_lsn"], r["commit_time"] or 0)
        if kind == "COMMIT":
            return commit(r["commit_lsn"], r["end_lsn"], r["commit_time"] or 0)
        if kind == "RELATION":
            return relation(r["relation_id"], r["namespace"], r["relation_name"], [(c["name"], c["key"], c["type_oid"], c["typmod"]) for c in r["columns"]], chr(r["replica_identity"]))
        if kind in ("INSERT", "UPDATE", "DELETE"):
            return change(kind, r["relation_id"], cells(r["new_tuple"]), cells(r["old_tuple"]), r["old_kind"] or "O")
        return {"TYPE": b"Y", "ORIGIN": b"O", "TRUNCATE": b"T"}.get(kind, b"?")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []
        made = lambda: pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([b"".join(parts)], pa.binary())], ["segment", "content"])
        for b in batches:
            for r in b.to_pylist():
                if r["segment"] != at:
                    if parts:
                        yield made()
                    at, parts = r["segment"], []
                parts.append(record(xlog(message(r), r["wal_start"] or 0, r["server_wal_end"] or 0), r["epoch"]))
        if parts:
            yield made()

    rows = frames.withColumn("segment", F.floor(F.col("seq") / width).cast("long"))
    return rows.repartition("segment").sortWithinPartitions("segment", "seq").mapInArrow(run, "segment long, content binary")


def decoded(segments: DataFrame) -> DataFrame:
    """Frames of segments(segment, content), each read by itself: seq is the segment's place and the record's in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                first = b.column(0)[i].as_py() * SEGMENT
                rows = [f | {"seq": first + k} for k, f in enumerate(records(b.column(1)[i].as_py()))]
                for a in range(0, len(rows), 4096):
                    part = rows[a : a + 4096]
                    yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in part], t) for c, t in zip(NAMES, kinds, strict=True)], NAMES)

    kinds = _arrow_kinds()
    return segments.select("segment", "content").mapInArrow(run, SCHEMA)


def _arrow_kinds() -> list[pa.DataType]:
    columns = pa.list_(pa.struct([("name", pa.string()), ("key", pa.bool_()), ("type_oid", pa.int64()), ("typmod", pa.int32())]))
    cells = pa.list_(pa.struct([("kind", pa.string()), ("text", pa.string())]))
    plain = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    kinds = {f.strip().split(" ")[0]: f.strip().split(" ")[1] for f in SCHEMA.replace(_COLUMNS, "columns").replace(_CELLS, "cells").split(",")}
    return [{"columns": columns, "cells": cells}.get(k) or plain[k] for k in kinds.values()]


def segments(spark: SparkSession, path: str, stream: bool = False, files: int = 64) -> DataFrame:
    """segment and content of the files segment-<number>.frames under path, read by Spark's own file system.

    As a stream, files come in as they appear, `files` of them in a batch; Spark's checkpoint remembers which were read.
    """
    source = spark.readStream.schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", files) if stream else spark.read
    rows = source.format("binaryFile").option("pathGlobFilter", "segment-*.frames").load(path)
    return rows.select(F.regexp_extract("path", r"segment-(\d+)\.frames$", 1).cast(LongType()).alias("segment"), "content")


def published(frames: DataFrame, tables: list[str]) -> DataFrame:
    """frames without relations outside `tables`, and their changes, as a publication leaves them out at the source."""
    own = frames.where("msg_type = 'RELATION'").where(F.concat_ws(".", "namespace", "relation_name").isin(*tables)) if tables else frames.where("false")
    ids = own.select(F.col("epoch").alias("_e"), F.col("relation_id").alias("_r")).distinct()
    inside = frames.join(ids, (F.col("epoch") == F.col("_e")) & (F.col("relation_id") == F.col("_r")), "left_semi")
    return frames.where("relation_id IS NULL").unionByName(inside)


def _files(path: str) -> list[tuple[str, object]]:
    """Segments of a folder in order, with the file system that has them; local paths and addresses of shared storage."""
    from pyarrow import fs

    system, at = (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
    found = system.get_file_info(fs.FileSelector(at, allow_not_found=True))
    return sorted((f.path, system) for f in found if f.is_file and f.path.endswith(".frames"))


def _bytes(at: str, system) -> bytes:
    with system.open_input_stream(at) as f:
        return f.read()


class _Range(InputPartition):
    def __init__(self, path: str, first: int):
        self.path, self.first = path, first


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[InputPartition]:
        # seq leaves room for 2^32 frames a file, so files are read apart and stay in order
        return [_Range(p, k * SEGMENT) for k, (p, _) in enumerate(_files(self.path))]

    def read(self, partition: _Range) -> Iterator[tuple]:
        system = dict(_files(self.path))[partition.path]
        for k, fields in enumerate(records(_bytes(partition.path, system))):
            yield _row(fields | {"seq": partition.first + k})


class _Slot(SimpleDataSourceStreamReader):
    """Whole transactions from the confirmed position on; the offset is the end of the last one, commit() confirms it.

    As a server does, it sends the relations that a transaction needs again, and never half a transaction. One process reads,
    like one replication connection; segments() reads stored segments in parallel.
    """

    def __init__(self, path: str, state: str, most: int):
        self.path, self.state, self.most = path, state, most

    def initialOffset(self) -> dict:  # noqa: N802
        from pyarrow import fs

        system, at = (fs.LocalFileSystem(), self.state) if self.state.startswith("/") else fs.FileSystem.from_uri(self.state)
        if system.get_file_info(at).is_file:
            return json.loads(_bytes(at, system))
        return {"lsn": 0}

    def _sent(self, after: int, upto: int | None = None) -> tuple[list[tuple], int]:
        out, relations, open_, end, whole = [], {}, [], after, 0
        for k, (at, system) in enumerate(_files(self.path)):
            for j, fields in enumerate(records(_bytes(at, system))):
                fields["seq"] = k * SEGMENT + j
                kind = fields["msg_type"]
                if kind == "RELATION":
                    relations[fields["relation_id"]] = fields
                if kind == "BEGIN":
                    open_ = []
                open_.append(fields)
                if kind != "COMMIT":
                    continue
                if fields["end_lsn"] > after and (fields["end_lsn"] <= upto if upto is not None else whole < self.most):
                    first = open_[0]["seq"]
                    if not out:
                        out += [_row(r) for r in relations.values() if r["seq"] < first]
                    out += [_row(f) for f in open_]
                    end, whole = fields["end_lsn"], whole + 1
                open_ = []
        return out, end

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = self._sent(start["lsn"])
        return iter(rows), {"lsn": end}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return iter(self._sent(start["lsn"], end["lsn"])[0])

    def commit(self, end: dict) -> None:
        from pyarrow import fs

        system, at = (fs.LocalFileSystem(), self.state) if self.state.startswith("/") else fs.FileSystem.from_uri(self.state)
        with system.open_output_stream(at + ".new") as f:
            f.write(json.dumps(end).encode())
        system.move(at + ".new", at)


class FrameSource(DataSource):
    """spark.read or readStream, format("frames"): a folder of segments on storage that all machines see.

    Options: path; for streams also state, the file of the confirmed position (path/slot.json), and most, transactions in
    a batch (1000).
    """

    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802
        path = self.options["path"].rstrip("/")
        return _Slot(path, self.options.get("state", f"{path}/slot.json"), int(self.options.get("most", "1000")))
