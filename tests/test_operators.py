"""Operators on small inputs: edges that the queries don't reach."""

import json
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.functions import counters, lsn
from tidelog.operators import apply, catalog, compat, decode, filters, ledger, ordered, relations, sinks
from tidelog.operators.replica import Rejected, Replica
from tidelog.operators.store import Store
from tidelog.sources import config, frames, scratch
from tidelog.streaming import apply as streaming
from tidelog.streaming import consumer, progress, supervisor

EVENT = "source_id string, xid long, commit_lsn long, ordinal long, lsn long, type string, schema string, table string, data map<string,string>, old_data map<string,string>"


def event(xid, k, kind, data, old=None, table="clientes"):
    return ("s", xid, xid * 100 + 50, k, xid * 100 + k, kind, "public", table, data, old)


def test_lsn(spark):
    rows = spark.createDataFrame([("16/B374D848",), ("0/0000000A",), ("x/1",), ("",), (None,), ("1/2/3",)], "t string").select(lsn.parse(F.col("t")).alias("n"))
    got = [r.n for r in rows.collect()]
    assert got == [97500059720, 10, None, None, None, None]
    assert rows.where("n IS NOT NULL").select(lsn.format(F.col("n")).alias("t")).collect()[0].t == "16/B374D848"


def test_table_lists():
    assert filters.parse_tables(" public.clientes, public.enderecos,public.clientes ") == ["public.clientes", "public.enderecos"]
    with pytest.raises(ValueError):
        filters.parse_tables("clientes")


def test_identifiers(spark):
    rows = spark.createDataFrame([("public",), ('nome"com aspas',), ("",), ("a\0b",), (None,)], "n string")
    assert [r.ok for r in rows.select(filters.valid_identifier(F.col("n")).alias("ok")).collect()] == [True, True, False, False, False]


def test_running_values_cross_ranges(spark):
    df = spark.createDataFrame([(k, k if k % 7 == 3 else None, k * 37 % 11) for k in range(100)], "seq long, v long, m long").withColumn("g", F.lit(1))
    got = {r.seq: r for r in ordered.running_max(ordered.running_sum(ordered.last_known(df, ["g"], "seq", F.col("v"), "last", 8), ["g"], "seq", F.col("m"), "total", 8), ["g"], "seq", F.col("m"), "top", 8).collect()}
    last = total = top = None
    for k in range(100):
        last = k if k % 7 == 3 else last
        total = (total or 0) + k * 37 % 11
        assert (got[k]["last"], got[k]["total"], got[k]["top"]) == (last, total, top)
        top = max(k * 37 % 11, -1 if top is None else top)


def log_rows(messages):
    return [frames.parse(m) | {"seq": k, "epoch": 1, "wal_start": 64 * k} for k, m in enumerate(messages, 1)]


def as_frames(spark, messages):
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(frames.SCHEMA)
    plain = lambda v: [tuple(x.values()) for x in v] if isinstance(v, list) else v
    return spark.createDataFrame([tuple(plain(r.get(f.name)) for f in schema.fields) for r in log_rows(messages)], schema)


RELATION = frames.relation(7, "public", "clientes", [("id", True, 20, -1), ("nome", False, 25, -1), ("email", False, 25, -1)])


def test_assemble_from_bytes(spark):
    f = as_frames(spark, [RELATION, frames.begin(42, 0x120), frames.change("INSERT", 7, ["1", "Zoë", None]), frames.change("UPDATE", 7, ["1", "Ünal Ørsted", ...], ["1", "Zoë", None]), frames.change("DELETE", 7, old=["1", "Größe", None], old_kind="K"), frames.commit(0x120, 0x128), frames.begin(43, 0x200), frames.change("INSERT", 7, ["2"])])
    got = decode.assemble(f, width=2).orderBy("ordinal").collect()
    assert [(r.type, r.ordinal, r.commit_lsn, r.xid) for r in got] == [("INSERT", 0, 0x128, 42), ("UPDATE", 1, 0x128, 42), ("DELETE", 2, 0x128, 42)]
    assert got[0]["data"] == {"id": "1", "nome": "Zoë", "email": None} and got[0].old_data is None
    assert got[1]["data"] == {"id": "1", "nome": "Ünal Ørsted"} and got[1].old_data["nome"] == "Zoë"
    assert got[2]["data"] == {"id": "1", "nome": "Größe", "email": None} and got[2].old_data is None


@pytest.mark.parametrize(
    ("messages", "error"),
    [
        ([RELATION, frames.change("INSERT", 7, ["1"])], "change outside a transaction"),
        ([frames.commit(1, 2)], "commit outside a transaction"),
        ([frames.begin(10, 1), frames.begin(11, 2)], "begin inside a transaction"),
        ([frames.begin(10, 1), frames.change("INSERT", 9, ["1"])], "unknown relation"),
        ([RELATION, frames.begin(10, 1), frames.change("INSERT", 7, ["1", "2", "3", "4"])], "tuple wider than its relation"),
        ([RELATION, frames.begin(10, 1), frames.change("INSERT", 7, ["1"]), frames.commit(1, 2)], None),
    ],
)
def test_protocol_errors(spark, messages, error):
    assert [r.error for r in decode.protocol_errors(as_frames(spark, messages)).collect()] == ([error] if error else [])


def test_malformed_messages():
    with pytest.raises(frames.Malformed):
        frames.parse(frames.begin(1, 2)[:-1])
    with pytest.raises(frames.Malformed):
        frames.parse(b"I" + struct.pack(">I", 7) + b"N" + struct.pack(">H", 1) + b"z")


@pytest.mark.parametrize("cut", range(1, 30))
def test_cut_off_messages(cut):
    whole = frames.change("INSERT", 7, ["abc", None, "de"], ["x"])
    if cut < len(whole):
        with pytest.raises(frames.Malformed):
            frames.parse(whole[:-cut])
    with pytest.raises(frames.Malformed):
        list(frames.records(frames.framed([RELATION, whole])[:-cut]))


def test_frame_source(spark, tmp_path):
    (tmp_path / "segment-1.frames").write_bytes(frames.framed([RELATION, frames.begin(5, 64)]))
    (tmp_path / "segment-2.frames").write_bytes(frames.framed([frames.change("INSERT", 7, ["1", None, ...]), frames.commit(64, 72)], start=512) + frames.record(frames.keepalive(900, True)))
    spark.dataSource.register(frames.FrameSource)
    got = spark.read.format("frames").option("path", str(tmp_path)).load().orderBy("seq").collect()
    assert [r.msg_type for r in got] == ["RELATION", "BEGIN", "INSERT", "COMMIT", "KEEPALIVE"]
    assert [c.kind for c in got[2].new_tuple] == ["t", "n", "u"] and got[0]["columns"][0].key and (got[4].server_wal_end, got[4].old_kind) == (900, "r")
    same = frames.decoded(frames.segments(spark, str(tmp_path))).orderBy("seq").collect()
    assert [r[1:] for r in same] == [r[1:] for r in got] and [r.seq for r in same] == [(1 << 32), (1 << 32) + 1, 2 << 32, (2 << 32) + 1, (2 << 32) + 2]


def test_wire_round_trip(spark):
    messages = [RELATION, frames.begin(5, 64, 9), frames.change("INSERT", 7, ["1", None, ...]), frames.change("UPDATE", 7, ["1", "é", ""], ["0", None, None], "K"), frames.change("DELETE", 7, old=["1"]), frames.commit(64, 72, 9)]
    f = as_frames(spark, messages).withColumn("server_wal_end", F.col("wal_start"))
    back = frames.decoded(frames.encoded(f, width=3))
    strip = lambda df: [tuple(r)[1:] for r in df.select(*frames.NAMES).orderBy("seq").collect()]
    assert strip(back) == strip(f)


def segment(tmp_path, number, data):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / f"segment-{number:06d}.frames").write_bytes(data)


def test_slot_stream(spark, tmp_path):
    """Whole transactions by position; a new reader goes on after the confirmed one and gets the relations again."""
    spark.dataSource.register(frames.FrameSource)
    one = [RELATION, frames.begin(1, 64), frames.change("INSERT", 7, ["1"]), frames.commit(64, 72)]
    two = [frames.begin(2, 80), frames.change("INSERT", 7, ["2"]), frames.commit(80, 88), frames.begin(3, 90), frames.change("INSERT", 7, ["3"])]
    segment(tmp_path, 1, frames.framed(one))
    batches = []
    for k in range(3):
        source = spark.readStream.format("frames").option("path", str(tmp_path / "in")).load()
        q = source.writeStream.foreachBatch(lambda df, n: batches.append([(r.msg_type, r.xid) for r in df.orderBy("seq").collect()])).option("checkpointLocation", str(tmp_path / "c")).trigger(once=True).start()
        q.awaitTermination()
        if k == 0:
            segment(tmp_path, 2, frames.framed(two, start=400))
    got = [b for b in batches if b]
    assert got[0] == [("RELATION", None), ("BEGIN", 1), ("INSERT", None), ("COMMIT", None)] and got[1] == [("RELATION", None), ("BEGIN", 2), ("INSERT", None), ("COMMIT", None)] and len(got) == 2


OPS = st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["put", "set_a", "set_b", "null_a", "drop", "move"]), st.integers(0, 5)), max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(OPS)
def test_state_equals_a_row_at_a_time_fold(spark, ops):
    """Events are taken as they come, rows there or not; the first that brings a live key to life again is the conflict."""
    live, rows, clash, n = {}, [], None, 0
    for key, op, value in ops:
        k, v, to = str(key), str(value), str(value)
        n += 1
        old = dict(live.get(k, {"id": k, "a": None, "b": None}))
        if op == "put":
            rows.append(event(n, 0, "INSERT", {"id": k, "a": v}))
            if k in live:
                clash = n
                break
            live[k] = {"id": k, "a": v, "b": None}
        elif op in ("set_a", "set_b", "null_a"):
            change = {"set_a": {"a": v}, "set_b": {"b": v}, "null_a": {"a": None}}[op]
            rows.append(event(n, 0, "UPDATE", {"id": k} | change, old))
            if k in live:
                live[k] |= change
        elif op == "drop":
            rows.append(event(n, 0, "DELETE", {"id": k}))
            live.pop(k, None)
        elif op == "move" and to != k:
            rows.append(event(n, 0, "UPDATE", {"id": to}, old))
            if k in live:
                if to in live:
                    clash = n
                    break
                live[to] = live.pop(k) | {"id": to}
    e = apply.effective(None, spark.createDataFrame(rows, EVENT), ["id"], width=300)
    found = apply.conflicts(None, e, ["id"], width=300).agg(F.min("commit_lsn").alias("c")).first()["c"]
    assert found == (None if clash is None else clash * 100 + 50)
    got = apply.state(None, apply.good_prefix(e, apply.conflicts(None, e, ["id"])), ["id"], ["id", "a", "b"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted((tuple(r.values()) for r in live.values()), key=str)


def test_conflicts_with_moves(spark):
    insert, move = (lambda n, k: event(n, 0, "INSERT", {"id": k})), (lambda n, a, b: event(n, 0, "UPDATE", {"id": b}, {"id": a}))
    at = lambda *rows: [r.commit_lsn for r in apply.conflicts(None, apply.effective(None, spark.createDataFrame(list(rows), EVENT), ["id"]), ["id"]).collect()]
    assert at(insert(1, "1"), move(2, "1", "2"), insert(3, "1")) == []
    assert at(insert(1, "1"), insert(2, "2"), move(3, "1", "2")) == [350]
    assert at(move(1, "8", "9"), insert(2, "9")) == [] == at(move(1, "8", "9"), move(2, "9", "7"), insert(3, "7"))


def test_state_over_a_base_and_missing_as_null(spark):
    base = spark.createDataFrame([(1, "x", "y"), (2, "p", "q")], "id long, a string, b string")
    e = spark.createDataFrame([event(1, 0, "UPDATE", {"id": "1", "a": "z"}, {"id": "1"}), event(2, 0, "DELETE", {"id": "2"}), event(3, 0, "UPDATE", {"id": "9", "a": "z"}, {"id": "9"}), event(4, 0, "DELETE", {"id": None})], EVENT)
    assert sorted(map(tuple, apply.state(base, e, ["id"], ["id", "a", "b"]).collect())) == [("1", "z", "y")]
    assert sorted(map(tuple, apply.state(base, e, ["id"], ["id", "a", "b"], missing="null").collect()), key=str) == [("1", "z", None)]
    assert [r.v for r in e.select(apply.key_violation(["id", "tenant"]).alias("v")).collect()] == ["tenant"] * 4


def test_empty_inputs(spark):
    none = spark.createDataFrame([], EVENT)
    assert apply.state(None, none, ["id"], ["id", "a"]).count() == apply.conflicts(None, none, ["id"]).count() == 0
    assert ledger.unapplied(none, spark.createDataFrame([], ledger.SCHEMA)).count() == 0
    assert decode.assemble(spark.createDataFrame([], frames.SCHEMA)).count() == 0


def columns(table, *names, key=("id",), kinds=None):
    return [("public", table, k, c, *(kinds or {}).get(c, ("text", 25)), -1, c not in key, False, key.index(c) + 1 if c in key else None) for k, c in enumerate(names, 1)]


def replica(spark, tmp_path, *rows, **options):
    store = Store(spark, str(tmp_path / "store"), buckets=4)
    store.create(spark.createDataFrame(list(rows), compat.CATALOG))
    return store, Replica(store, **({"include": ["public.clientes"]} | options))


def transactions(spark, *xids):
    return spark.createDataFrame([("s", x, x * 100 + 50) for x in xids], "source_id string, xid long, commit_lsn long")


def test_replica_commits_what_comes_before_a_bad_transaction(spark, tmp_path):
    store, sink = replica(spark, tmp_path, *columns("clientes", "id", "nome"), *columns("outra", "id"))
    first = spark.createDataFrame([event(1, 0, "INSERT", {"id": "1", "nome": "a"}), event(1, 1, "INSERT", {"id": "2", "nome": "b"})], EVENT)
    sink(first, 0)
    sink(first, 1)  # again: nothing changes
    assert store.table("public.clientes").count() == 2 and store.ledger().count() == 1
    batch = spark.createDataFrame([event(2, 0, "DELETE", {"id": "2"}), event(3, 0, "UPDATE", {"id": "1", "nome": "c"}, {"id": "1"}), event(3, 1, "INSERT", {"id": "1"}), event(4, 0, "INSERT", {"id": "9"})], EVENT)
    for _ in range(2):  # the good transaction stays, the bad one is found again, nothing after it is seen
        with pytest.raises(Rejected, match="live key") as e:
            sink.apply(transactions(spark, 2, 3, 4), batch)
        assert e.value.commit_lsn == 350
        assert [tuple(r) for r in store.table("public.clientes").collect()] == [("1", "a")] and sorted(r.transaction_id for r in store.ledger().collect()) == [1, 2]
    sink.apply(transactions(spark, 3, 5), batch.where("false"))  # without events, from their COMMITs alone
    assert sorted(r.transaction_id for r in store.ledger().collect()) == [1, 2, 3, 5]
    assert sink.counters["transactions_failed"] == 2 and sink.counters["transactions_committed"] == 6 and sink.counters["transactions_replayed"] == 2


@pytest.mark.parametrize(
    ("row", "reason"),
    [
        (event(2, 0, "UPSERT", {"id": "7"}), "unsupported type"),
        (event(2, 0, "UPDATE", {"id": "1"}), "update without old data"),
        (event(2, 0, "INSERT", {"id": "7", "ghost": "x"}), "COLUMN_MISSING column=ghost"),
        (event(2, 0, "INSERT", {"id": "7"}, table="nada"), "TABLE_MISSING"),
        (event(2, 0, "INSERT", {"id": "7"}, table="outra"), "include list"),
        (event(2, 0, "INSERT", {"nome": "x"}), "without key column id"),
        (event(2, 0, "INSERT", {"a": "x"}, table="sem_chave"), "PRIMARY_KEY_MISSING"),
        (event(2, 0, "UPDATE", {"id": "2"}, {"id": "1"}), "live key"),
    ],
)
def test_replica_refuses(spark, tmp_path, row, reason):
    store, sink = replica(spark, tmp_path, *columns("clientes", "id", "nome"), *columns("outra", "id"), *columns("sem_chave", "a", key=()))
    with pytest.raises(Rejected, match=reason):
        sink(spark.createDataFrame([event(1, 0, "INSERT", {"id": "1"}), event(1, 1, "INSERT", {"id": "2"}), row], EVENT), 0)
    assert store.table("public.clientes").count() == 2 and store.ledger().count() == 1


def test_replica_adds_columns(spark, tmp_path):
    """A relation with a new nullable column, in one transaction with rows that use it."""
    source = spark.createDataFrame(columns("clientes", "id", "nome", "telefone", kinds={"id": ("int8", 20)}), compat.CATALOG)
    rows = columns("clientes", "id", "nome", kinds={"id": ("int8", 20)})
    told = spark.createDataFrame([(250, "public", "clientes")], "commit_lsn long, namespace string, name string")
    e = spark.createDataFrame([event(1, 0, "INSERT", {"id": "1", "nome": "a"}), event(2, 0, "INSERT", {"id": "2", "nome": "b", "telefone": "5"})], EVENT)
    for mode, reason in (("disabled", "schema_evolution_disabled"), ("auto", None)):
        store, sink = replica(spark, tmp_path / mode, *rows, schema_evolution=mode, source=source)
        if reason:
            with pytest.raises(Rejected, match=reason):
                sink.apply(transactions(spark, 1, 2), e, told)
            assert store.table("public.clientes").columns == ["id", "nome"] and store.table("public.clientes").count() == 1
        else:
            sink.apply(transactions(spark, 1, 2), e, told)
            assert sorted(tuple(r) for r in store.typed("public.clientes").collect()) == [(1, "a", None), (2, "b", "5")]
            assert store.typed("public.clientes").schema["id"].dataType.simpleString() == "bigint" and sink.counters["schema_apply_success"] == 1 == sink.counters["schema_apply_attempts"]
    # before the transaction that brings it, the column isn't there
    store, sink = replica(spark, tmp_path / "early", *rows, schema_evolution="auto", source=source)
    early = spark.createDataFrame([event(1, 0, "INSERT", {"id": "1", "telefone": "5"})], EVENT)
    with pytest.raises(Rejected, match="COLUMN_MISSING column=telefone"):
        sink.apply(transactions(spark, 1, 2), early, told)
    # with a failure in the transaction that adds it, the column goes with it
    bad = spark.createDataFrame([event(2, 0, "INSERT", {"id": "2", "telefone": "5"}), event(2, 1, "INSERT", {"id": "2"})], EVENT)
    with pytest.raises(Rejected, match="live key"):
        sink.apply(transactions(spark, 2), bad, told)
    assert [r.column for r in store.catalog().collect()] == ["id", "nome"] and sink.counters["schema_apply_failure"] == 1


def test_replica_explicit(spark, tmp_path):
    """Fixed lists: absent columns become null, and an update finds its row by the new key."""
    store, sink = replica(spark, tmp_path, *columns("clientes", "id", "nome", "email"), apply_mode="explicit")
    sink(spark.createDataFrame([event(1, 0, "INSERT", {"id": "1", "nome": "a", "email": "e"}), event(2, 0, "UPDATE", {"id": "1", "nome": "b"}, {"id": "1"}), event(3, 0, "UPDATE", {"id": "5", "nome": "z"}, {"id": "1"})], EVENT), 0)
    assert [tuple(r) for r in store.table("public.clientes").collect()] == [("1", "b", None)]


def test_store_after_a_stop_at_any_step(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"), buckets=3)
    store.create(spark.createDataFrame(columns("t", "id", "v"), compat.CATALOG))
    row = lambda n: spark.createDataFrame([(str(n), "x")], "id string, v string")
    entry = lambda n: spark.createDataFrame([("s", n, n, None)], ledger.SCHEMA)
    for n in range(1, 5):
        monkeypatch.setattr(store, "_publish", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            store.commit({"public.t": (row(n), ["id"], [])}, entry(n))
        monkeypatch.undo()
        assert store.ledger().count() == n - 1 and Store(spark, str(tmp_path / "store")).current() == n
        touched = [r[0] for r in row(n).select(store.bucket_of([F.col("id")])).collect()]
        base = store.table("public.t", touched)
        store.commit({"public.t": (row(n).unionByName(base), ["id"], touched)}, entry(n))
        assert sorted(r.id for r in store.table("public.t").collect()) == [str(k) for k in range(1, n + 1)] and store.ledger().count() == n
    assert len(list((tmp_path / "store" / "manifests").glob("*.json"))) == 2  # the current snapshot and the one before it


def test_stream_repeats_a_failed_batch(spark, tmp_path):
    e = spark.createDataFrame([event(1, 0, "INSERT", {"id": "1", "nome": "Maçã"})], EVENT)
    e.write.parquet(str(tmp_path / "in"))
    calls = []
    store, sink = replica(spark, tmp_path, *columns("clientes", "id", "nome"), fail=lambda b: calls.append(b) or (_ for _ in ()).throw(RuntimeError("unavailable")) if not calls else None)
    for _ in range(2):
        try:
            streaming.run(spark, str(tmp_path / "in"), e.schema, sink, str(tmp_path / "c")).awaitTermination()
        except Exception as x:
            assert "unavailable" in str(x)
    assert [tuple(r) for r in store.table("public.clientes").collect()] == [("1", "Maçã")] and store.current() == 2


def test_consumer_from_bytes(spark, tmp_path):
    """A transaction over three files, an empty one, a keepalive that asks for a reply, and a breach at the end."""
    store, sink = replica(spark, tmp_path, *columns("clientes", "id", "nome", "email"))
    told = []
    own = consumer.Consumer(spark, sink, str(tmp_path / "state"), "s", ["public.clientes"], progress.Progress(interval=1e9, send=told.append))
    run = lambda: consumer.start(spark, str(tmp_path / "in"), own, str(tmp_path / "c"), files=1).awaitTermination()
    segment(tmp_path, 1, frames.framed([RELATION, frames.begin(1, 64), frames.change("INSERT", 7, ["1", "a", None])]))
    segment(tmp_path, 2, frames.framed([frames.change("INSERT", 7, ["2", "b", None])], start=300) + frames.record(frames.keepalive(999)))
    run()
    assert store.ledger().count() == 0 and own.progress.processed == 0
    segment(tmp_path, 3, frames.framed([frames.change("UPDATE", 7, ["1", "c", ...], ["1", "a", None]), frames.commit(64, 600), frames.begin(2, 610), frames.commit(610, 620)], start=400) + frames.record(frames.keepalive(999, True)))
    run()
    assert sorted(tuple(r) for r in store.table("public.clientes").collect()) == [("1", "c", None), ("2", "b", None)] and store.ledger().count() == 2
    assert (own.progress.processed, own.progress.confirmed, told, own.progress.server_end) == (620, 620, [620], 999)
    other = frames.relation(9, "public", "outra", [("id", True, 20, -1)])
    segment(tmp_path, 4, frames.framed([other, frames.begin(3, 700), frames.change("INSERT", 9, ["1"]), frames.change("DELETE", 7, old=["2"]), frames.commit(700, 710), frames.commit(711, 720), frames.begin(4, 730)], start=640))
    with pytest.raises(Exception, match="commit outside a transaction"):
        run()
    assert [r.id for r in store.table("public.clientes").collect()] == ["1"] and sorted(r.commit_lsn for r in store.ledger().collect()) == [600, 620, 710]
    assert own.values()["events_received"] == 4 and own.values()["sink_errors"] == 1 and own.values()["events_applied"] == 4


def test_progress():
    now, told = [0.0], []
    p = progress.Progress(0x500, 10, told.append, lambda: now[0])
    p.advance(0x520)
    with pytest.raises(progress.Regressed):
        p.advance(0x510)
    p.advance(0x520)
    assert not p.due() and (p.processed, p.confirmed) == (0x520, 0x500)
    now[0] = 10
    assert p.due()
    p.confirm()
    assert told == [0x520] and not p.due() and p.confirmed == 0x520


def test_file_sink(spark, tmp_path):
    echoed = []
    sink = sinks.Lines(str(tmp_path / "out"), echoed.append, fail_match="poison")
    e = spark.createDataFrame([event(1, 0, "INSERT", {"id": "1"}), event(2, 0, "INSERT", {"id": "2"}), event(2, 1, "INSERT", {"id": "poison"}), event(3, 0, "INSERT", {"id": "3"})], EVENT)
    with pytest.raises(OSError):
        sink(e, 0)
    assert [json.loads(x)["data"]["id"] for x in echoed] == ["1", "2"] and spark.read.text(str(tmp_path / "out")).count() == 2
    assert sink.counters["transactions_committed"] == 1 and sink.counters["sink_errors"] == 1 and sink.name == "file" and sink.ready()


def test_sinks_by_setting(spark, tmp_path):
    base = {"CDC_SOURCE_PGDATABASE": "a", "CDC_SOURCE_PGUSER": "b", "CDC_OUTPUT_FILE": str(tmp_path / "o")}
    own = consumer.from_config(spark, config.load(base | {"CDC_STATUS_INTERVAL": "2s", "CDC_TEST_PAUSE_BEFORE_ACK": "true", "CDC_TEST_PAUSE_MATCH": "x"}), str(tmp_path / "s"))
    assert own.sink.name == "file" and own.progress.interval == 2 and own.tables == ["public.clientes", "public.enderecos"]
    with pytest.raises(consumer.Paused):
        own.before_ack(spark.createDataFrame([event(1, 0, "INSERT", {"id": "x"})], EVENT))
    c = config.load(base | {"CDC_SINK": "postgres", "CDC_DEST_PGDATABASE": "c", "CDC_DEST_PGUSER": "d"})
    assert sinks.open_sink(c, spark, str(tmp_path / "store")).name == "postgres:explicit"


def test_unknown_relations_and_wide_tuples_are_errors(spark):
    for messages, error in (([RELATION, frames.begin(1, 9), frames.change("INSERT", 8, ["1"]), frames.commit(9, 10)], "unknown relation"), ([RELATION, frames.begin(1, 9), frames.change("INSERT", 7, list("1234")), frames.commit(9, 10)], "tuple wider")):
        with pytest.raises(Exception, match=error):
            decode.assemble(as_frames(spark, messages)).collect()
        assert decode.assemble(as_frames(spark, messages), strict=False).count() == 0
    own = spark.createDataFrame([(1, 1, 7, "public", "t", [("a", 25, -1), ("a", 25, -1)])], "epoch int, seq long, relation_id long, namespace string, name string, columns array<struct<name:string,type_oid:long,typmod:int>>")
    with pytest.raises(Exception, match="duplicate column"):
        relations.observe(own).collect()


def test_catalog_cache(spark):
    calls = []
    cache = catalog.Cache(lambda: calls.append(1) or spark.createDataFrame(columns("t", "id", "v"), compat.CATALOG))
    assert cache.get("public.t", ("id",)) == cache.get("public.t", ("id",)) == cache.get("public.t") == (["id"], ["id", "v"]) and len(calls) == 1
    cache.get("public.t", ("id", "v"))
    cache.clear()
    cache.get("public.t")
    assert len(calls) == 3
    with pytest.raises(LookupError):
        cache.get("public.nada")


def test_scratch_is_cleared(spark):
    df = scratch.written(spark.range(3))
    assert df.count() == 3
    at = scratch.root(spark)
    scratch.clear(spark)
    assert not __import__("os").path.exists(at)


def test_jsonl(spark, tmp_path):
    sink = sinks.jsonl(str(tmp_path / "out"))
    e = spark.createDataFrame([event(2, 0, "DELETE", {"id": "1", "nome": None}), event(1, 0, "UPDATE", {"nome": 'a"b', "id": "1"}, {"id": "1"})], EVENT)
    sink(e, 0)
    sink(e, 0)
    got = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert len(got) == 2 and list(json.loads(got[0])) == ["type", "lsn", "transaction_id", "schema", "table", "data", "old_data"]
    assert {json.loads(x)["type"]: json.loads(x)["data"] for x in got} == {"UPDATE": {"id": "1", "nome": 'a"b'}, "DELETE": {"id": "1", "nome": None}}


def test_counters_agree():
    values, statuses = {"events_applied": 3, "sink_errors": 1}, {"COMPATIBLE": 2}
    text, body = counters.to_prometheus(values, statuses), json.loads(counters.to_json(values, statuses, {}))
    assert "cdc_events_total 3\n" in text and 'status="compatible"} 2\n' in text and body["events_applied"] == 3
    assert text.count("# HELP ") == text.count("# TYPE ") == 16 and len(body) == 18


def test_supervisor():
    retry, waits, runs, ready = supervisor.Retry(attempts=4), [], [], supervisor.Readiness()

    class Query:
        def awaitTermination(self):  # noqa: N802
            runs.append(ready.snapshot()[0])
            raise RuntimeError("gone")

    with pytest.raises(RuntimeError):
        supervisor.supervise(Query, retry, ready, waits.append)
    assert waits == [1, 2, 4] and runs == [True] * 4 and ready.snapshot() == (False, "gone")
    with pytest.raises(ValueError):
        supervisor.Retry(initial=2, most=1)


def test_health_endpoints():
    import urllib.error
    import urllib.request

    ready = supervisor.Readiness()
    server = supervisor.serve(ready, lambda: "{}", lambda: "x 1")
    at = f"http://127.0.0.1:{server.server_address[1]}"
    get = lambda p: urllib.request.urlopen(at + p).read().decode()
    assert get("/livez") == "ok" and get("/metrics/prometheus") == "x 1"
    with pytest.raises(urllib.error.HTTPError):
        get("/readyz")
    ready.set_ready()
    assert get("/readyz") == "ready"
    server.shutdown()
