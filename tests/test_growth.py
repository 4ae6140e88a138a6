"""Steps whose cost or range is to hold on tables much larger than these."""

import os
import random
from datetime import timedelta

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from deltaloom.functions import scalars
from deltaloom.operators import changes, overlay
from deltaloom.plans import extended
from deltaloom.sources import tables
from deltaloom.streaming import feeds


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_intervals_of_any_length(spark):
    micros = [0, 1, -1, 10**12, -(10**12), 6 * 10**12 + 7, 10**17 + 1, None]
    out = spark.createDataFrame(list(enumerate(micros)), "k int, m long").select("k", scalars.micros_to_interval(F.col("m")).alias("i"))
    assert rows(out) == sorted(((k, None if m is None else timedelta(microseconds=m)) for k, m in enumerate(micros)), key=str)
    ends = spark.createDataFrame([(2**63 - 1,), (-(2**63),)], "m long").select((scalars.micros_to_interval(F.col("m")) / F.lit(4)).alias("i"))
    assert len(ends.collect()) == 2


def test_uuids_compute_their_input_once(spark):
    for f in (scalars.parse_uuid, scalars.uuid_from_little_endian, scalars.uuid_to_little_endian, scalars.reverse_bytes):
        assert str(f(F.col("given"))).count("given") == 1, f.__name__
    text = "00112233-4455-6677-8899-aabbccddeeff"
    given = [text, text.upper(), text.replace("-", ""), text[:-1], "zz" + text[2:], "", None]
    out = spark.createDataFrame(list(enumerate(given)), "k int, u string").withColumn("raw", scalars.uuid_to_little_endian(F.col("u")))
    got = {r[0]: r[1:] for r in out.select("k", scalars.parse_uuid(F.col("u")), F.lower(F.hex("raw")), scalars.uuid_from_little_endian(F.col("raw"))).collect()}
    back = "ffeeddccbbaa99887766554433221100"
    assert [got[k] for k in range(7)] == [(text, back, text)] * 3 + [(None, None, None)] * 4
    short = spark.createDataFrame([(bytearray(15),), (None,)], "raw binary")
    assert rows(short.select(scalars.uuid_from_little_endian(F.col("raw")))) == [(None,), (None,)]
    hexes = [("0A1bFf",), ("0A1bF",), ("0",), ("",), (None,)]
    assert {tuple(r) for r in spark.createDataFrame(hexes, "h string").select("h", scalars.reverse_bytes(F.col("h"))).collect()} == {("0A1bFf", "Ff1b0A"), ("0A1bF", "1b0A"), ("0", ""), ("", ""), (None, None)}


BAG = "a int, request_id long"


def test_rows_without_a_request_are_not_joined(spark):
    bag = spark.createDataFrame([(1, None), (1, None), (1, 7), (2, 8), (2, 9), (None, None), (None, 7)], BAG)
    out = overlay.committed_only(bag, bag.where("a = 1").limit(1), spark.createDataFrame([(7,), (9,), (9,), (None,)], "request_id long"))
    assert rows(out) == sorted([(1,), (2,), (None,)], key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "isnull(request_id" in plan, "all rows of the server would share one task of the join"


def test_written_state_does_not_join_rows_without_a_request(spark, tmp_path, monkeypatch):
    plans, only = [], tables.committed_only
    monkeypatch.setattr(tables, "committed_only", lambda *a: plans.append(only(*a)) or plans[-1])
    bag = spark.createDataFrame([(1, None), (1, None), (1, 7), (2, 8), (None, None)], BAG)
    tables.write_state(bag, None, f"{tmp_path}/s", spark.createDataFrame([(7,)], "request_id long"))
    assert rows(tables.current_state(spark, f"{tmp_path}/s")) == sorted([(1,), (1,), (2,), (None,)], key=str)
    assert "isnull(request_id" in plans[0]._jdf.queryExecution().optimizedPlan().toString()


def test_written_state_without_pending_inserts_is_not_grouped(spark, tmp_path, monkeypatch):
    plans, only = [], tables.committed_only
    monkeypatch.setattr(tables, "committed_only", lambda *a: plans.append(only(*a)) or plans[-1])
    bag = spark.createDataFrame([(1, None), (1, None), (1, 7), (2, 8), (None, None), (None, None)], BAG)
    tables.write_state(bag, None, f"{tmp_path}/a", spark.createDataFrame([(7,), (7,), (None,)], "request_id long"))
    tables.write_state(bag.select("a"), None, f"{tmp_path}/b")
    tables.write_state(bag.select("a"), bag.select("a").limit(0), f"{tmp_path}/c")
    assert rows(tables.current_state(spark, f"{tmp_path}/a")) == sorted([(1,), (1,), (2,), (None,), (None,)], key=str)
    assert rows(tables.current_state(spark, f"{tmp_path}/b")) == rows(tables.current_state(spark, f"{tmp_path}/c")) == sorted([(1,)] * 3 + [(2,), (None,), (None,)], key=str)
    assert not any("replicaterows" in p._jdf.queryExecution().optimizedPlan().toString().lower() for p in plans[:2]), "every row would be counted with its equals"


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, feeds.ROCKS)
    yield
    spark.conf.set(name, before)


def streamed(spark, path, batches, shape, through):
    """What through tells of the batches, in the order of batches."""
    for batch in batches:
        spark.createDataFrame(batch, shape).write.mode("append").parquet(f"{path}/in")
        out = through(spark.readStream.schema(shape).parquet(f"{path}/in"))
        out.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/c").trigger(availableNow=True).start().awaitTermination()
    return rows(spark.read.schema(out.schema).parquet(f"{path}/out"))


def calls_of(monkeypatch, tmp_path, name):
    """How often Python is called for a group of a stream's rows, told by the lines of a file."""
    base, path = getattr(feeds, name), f"{tmp_path}/calls"

    class Counted(base):
        MOST = 2  # states are merged in most micro-batches

        def handleInputRows(self, key, rows, timerValues):
            with open(path, "a") as f:
                f.write("call\n")
            yield from base.handleInputRows(self, key, rows, timerValues)

    monkeypatch.setattr(feeds, name, Counted)
    return lambda: len(open(path).readlines())


BIG = 2**53 + 1


def test_owned_keys_share_their_state(spark, tmp_path, rocks, monkeypatch):
    calls, rng = calls_of(monkeypatch, tmp_path, "_Own"), random.Random(5)
    shape, n = "key long, txn long, query_set_id long, op string, row string", 3000
    ops = [[(rng.randrange(n) + BIG, t, rng.randrange(1, 4), rng.choice(["insert", "insert", "delete"]), rng.choice(["a", "b"])) for t in range(b * 4000, b * 4000 + 4000)] for b in range(2)]
    ops[0] += [(None, 1, 1, "insert", "n"), (BIG, None, 1, "insert", "no place"), (BIG, 1, None, "insert", "no set")]
    first = [(k + BIG, "base", [1, 2]) for k in range(0, n, 3)] + [(None, "n", [2])]
    initial = spark.createDataFrame(first, "key long, row string, sets array<long>")
    got = streamed(spark, tmp_path, ops, shape, lambda s: feeds.owned_key_events(s, initial, parts=4))
    held, want = {k: (row, set(sets)) for k, row, sets in first}, []
    for k, txn, q, op, row in sorted((r for b in ops for r in b if r[1] is not None and r[2] is not None), key=lambda r: r[1]):
        old, owners = held.get(k, (None, set()))
        before, new = bool(owners), row if op == "insert" else old
        owners = owners | {q} if op == "insert" else owners - {q}
        kind = "insert" if owners and not before else "delete" if before and not owners else "update" if owners and new != old else None
        held[k] = (new, owners)
        if kind:
            want.append((k, txn, q, kind, None if kind == "insert" else old, None if kind == "delete" else new))
    assert got == sorted(want, key=str)
    assert calls() <= 2 * 5, "a call for each part and micro-batch, not for each key"


def test_keyed_events_share_their_state(spark, tmp_path, rocks, monkeypatch):
    calls, rng = calls_of(monkeypatch, tmp_path, "_Apply"), random.Random(6)
    ops = [[(rng.choice([None, *range(BIG, BIG + 500)]), t, rng.choice(["insert", "delete"]), rng.choice(["a", "b", None])) for t in range(b * 1000, b * 1000 + 1000)] for b in range(4)]
    first = [(k, "base" if k % 2 else None, 100) for k in range(BIG, BIG + 200)]
    initial = spark.createDataFrame(first, "key long, row string, upto long")
    got = streamed(spark, tmp_path, ops, "key long, txn long, op string, row string", lambda s: feeds.keyed_events(s, initial, parts=3))
    now, want = {k: row for k, row, _ in first}, []
    upto = {k: u for k, _, u in first}
    for k, txn, op, row in (r for b in ops for r in b):
        old, new = now.get(k), row if op == "insert" else None
        if txn > upto.get(k, -1):
            now[k] = new
            if old != new:
                want.append((k, txn, "insert" if old is None else "delete" if new is None else "update", old, new))
    assert got == sorted(want, key=str)
    assert calls() <= 4 * 4, "a call for each part and micro-batch, not for each key"


def test_changes_follow_the_state_that_was_told(spark, tmp_path, rocks):
    shape, out = "key long, txn long, op string, row string", f"{tmp_path}/told"
    spark.createDataFrame([(1, 4, "insert", "z"), (1, 6, "insert", "a"), (2, 7, "insert", "b"), (3, 8, "delete", None), (4, 9, "insert", "d"), (None, 9, "insert", "n")], shape).write.parquet(f"{tmp_path}/in")
    snapshot = lambda *made: spark.createDataFrame(made, "key long, row string")
    start = lambda now: feeds.state_then_changes(spark.readStream.schema(shape).parquet(f"{tmp_path}/in"), now, 5, out)
    start(snapshot((1, "a"), (2, "a"), (3, "c"), (None, "m")))  # fails before its first batch
    start(snapshot((1, "new"), (2, "b"))).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    state = [(1, 5, "state", None, "a"), (2, 5, "state", None, "a"), (3, 5, "state", None, "c"), (None, 5, "state", None, "m")]
    told = [(2, 7, "update", "a", "b"), (3, 8, "delete", "c", None), (4, 9, "insert", None, "d"), (None, 9, "update", "m", "n")]
    assert rows(spark.read.parquet(out).select("key", "txn", "kind", "old", "new")) == sorted(state + told, key=str)


def test_changed_values_share_their_state(spark, tmp_path, rocks, monkeypatch):
    calls, rng = calls_of(monkeypatch, tmp_path, "_Changed"), random.Random(7)
    seen = [[(rng.choice([None, *range(BIG, BIG + 400)]), t, rng.choice(["a", None])) for t in range(b * 1000, b * 1000 + 1000)] for b in range(3)]
    seen[2].append((BIG + 1, None, "last"))
    got = streamed(spark, tmp_path, seen, "key long, seq long, value string", lambda s: feeds.distinct_until_changed(s, parts=3))
    last, want = {}, []
    for k, seq, value in (r for b in seen for r in b):
        if last.get(k) != [value]:
            want.append((k, seq, value))
        last[k] = [value]
    assert got == sorted(want, key=str)
    assert calls() <= 3 * 4, "a call for each part and micro-batch, not for each key"


def test_parts_of_a_feed_are_written_by_all_tasks(spark):
    seen = []
    parts = [spark.range(k * 8, k * 8 + 8, 1, 4) for k in range(2)]
    keep = lambda batch, n: seen.append((n, rows(batch), batch.select(F.input_file_name()).distinct().count()))
    extended._batches(spark, parts, lambda stream: stream.writeStream.foreachBatch(keep))
    assert seen == [(n, sorted(((k,) for k in range(n * 8, n * 8 + 8)), key=str), 4) for n in range(2)]


def test_state_of_a_stream_is_dealt_by_rows(spark, tmp_path, monkeypatch):
    names = ["spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass"]
    session, cores = [spark.conf.get(n) for n in names], spark.sparkContext.defaultParallelism
    seen = [[(k % 7 + BIG, k, "abc"[k // 7 % 3]) for k in range(b * 70, b * 70 + 70)] for b in range(2)]
    parts = [spark.createDataFrame(rows, "key long, seq long, value string") for rows in seen]
    monkeypatch.setattr(extended, "_folder", lambda spark, name: f"{tmp_path}/{name}")
    spark.conf.set(names[0], str(3 * cores))
    try:
        got = rows(extended._streamed(parts, feeds.distinct_until_changed))
        assert [spark.conf.get(n) for n in names] == [str(3 * cores), session[1]]
    finally:
        spark.conf.set(names[0], session[0])
    assert got == sorted(seen[0] + seen[1], key=str), "each value differs from the one before"
    states = [p for p in os.listdir(f"{tmp_path}/progress/state/0") if p.isdigit()]
    assert len(states) == cores, "as many tasks with state as rows need, whatever the session's number"


def test_state_of_keyed_events_is_dealt_by_rows(spark, tmp_path, monkeypatch):
    name, cores = "spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism
    before = spark.conf.get(name)
    monkeypatch.setattr(extended, "_folder", lambda spark, name: f"{tmp_path}/{name}")
    spark.createDataFrame([(k, k % 9, ("view", "error")[k // 9 % 2], 1.0) for k in range(36)], "event_id long, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    spark.conf.set(name, str(3 * cores))
    try:
        got = rows(extended.QUERIES["keyed_events"](spark, str(tmp_path)))
    finally:
        spark.conf.set(name, before)
    assert got == sorted(((k % 9, k, "delete", "view", None) if k // 9 % 2 else (k % 9, k, "insert", None, "view") for k in range(36)), key=str)
    assert len([p for p in os.listdir(f"{tmp_path}/progress/state/0") if p.isdigit()]) == cores


def test_rows_of_a_part_reach_python_packed(spark, tmp_path, rocks, monkeypatch):
    base, path = feeds._Apply, f"{tmp_path}/sizes"

    class Counted(base):
        def handleInputRows(self, key, rows, timerValues):
            frames = list(rows)
            with open(path, "a") as f:
                f.write(f"{sum(map(len, frames))}\n")
            yield from base.handleInputRows(self, key, iter(frames), timerValues)

    monkeypatch.setattr(feeds, "_Apply", Counted)
    ops = [(k % 50 + BIG, k, "insert", "ab"[k // 50 % 2]) for k in range(4000)]
    got = streamed(spark, tmp_path, [ops], "key long, txn long, op string, row string", lambda s: feeds.keyed_events(s, parts=3))
    old = {"a": "b", "b": "a"}
    assert got == sorted(((k, txn, "update" if txn >= 50 else "insert", old[row] if txn >= 50 else None, row) for k, txn, _, row in ops), key=str)
    assert sum(map(int, open(path))) <= 3 * 8, "a row for each task and part, not for each change"


def test_packs_hold_all_rows_by_part(monkeypatch):
    monkeypatch.setattr(feeds, "PACK", 2000)
    rng = random.Random(8)
    sent = [(rng.choice([-1, 0, 0, 0, 5]), rng.choice([None, "", "x" * rng.randrange(90)]), k) for k in range(1000)]
    table = pa.table(dict(zip(("_part", "row", "txn"), map(list, zip(*sent)), strict=True)), pa.schema([("_part", pa.int32()), ("row", pa.string()), ("txn", pa.int64())]))
    packs = [(p, r) for b in feeds._pack(iter([pa.RecordBatch.from_pylist([], table.schema), *table.to_batches(100)])) for p, r in zip(b["_part"].to_pylist(), b["rows"].to_pylist(), strict=True)]
    assert len(packs) > 3, "written in several rounds"
    got = [(p, row, txn) for p in (-1, 0, 5) for row, txn in (r.values() for r in feeds._unpacked([pd.DataFrame({"rows": [x for part, x in packs if part == p]})]).to_pylist())]
    assert sorted(got, key=str) == sorted(sent, key=str)
    assert list(feeds._pack(iter([]))) == []


def test_steps_over_whole_parts_tell_what_row_by_row_steps_tell():
    rng = random.Random(9)
    for _ in range(300):
        n = rng.randrange(1, 40)
        held = {BIG + k: (rng.choice(["a", "z"]), None) if rng.random() < 0.5 else (rng.choice(["a", None]), rng.randrange(10)) for k in range(rng.randrange(4))}
        ops = [(BIG + rng.randrange(5), rng.randrange(20), *rng.choice([(0, None), (1, "a"), (1, "b"), (1, None)])) for _ in range(n)]
        now, want, moved = dict(held), [], set()
        for (k, txn, step), row in sorted({op[:3]: op[3] for op in ops}.items()):
            if (k, txn, 1) in {op[:3] for op in ops} and not step:
                continue
            old, upto = now.get(k) or (None, None)
            if row != old and (upto is None or txn > upto):
                want.append((k, txn, "insert" if old is None else "delete" if row is None else "update", old, row))
                now[k] = None if row is None and upto is None else (row, upto)
                moved.add(k)
        shape = pa.schema([("key", pa.int64()), ("txn", pa.int64()), ("step", pa.int8()), ("row", pa.string())])
        told, changed = feeds._Apply().step(held, pa.table(dict(zip(shape.names, map(list, zip(*ops)), strict=True)), shape))
        assert list(told.itertuples(index=False, name=None)) == want and held == now and set(changed) == moved
        held = {BIG + k: [rng.choice(["a", "z", None])] for k in range(rng.randrange(4))}
        seen = [(BIG + rng.randrange(5), *rng.choice([(False, t), (True, 0)]), rng.choice(["a", "b", None])) for t in range(n)]
        now, want, moved = dict(held), [], set()
        for k, unplaced, seq, value in sorted(seen, key=lambda r: r[:3]):
            if now.get(k) != [value]:
                want.append((k, None if unplaced else seq, value))
                now[k] = [value]
                moved.add(k)
        shape = pa.schema([("key", pa.int64()), ("unplaced", pa.bool_()), ("seq", pa.int64()), ("value", pa.string())])
        told, changed = feeds._Changed().step(held, pa.table(dict(zip(shape.names, map(list, zip(*seen)), strict=True)), shape))
        assert list(told.itertuples(index=False, name=None)) == want and held == now and set(changed) == moved


def test_tasks_with_state_grow_with_rows():
    tasks = {n: extended._state_tasks(n, 12, 200) for n in (0, 1, 3_000_000, 3_000_001, 36_000_000, 10**9)}
    assert tasks == {0: 12, 1: 12, 3_000_000: 12, 3_000_001: 24, 36_000_000: 144, 10**9: 200}
    assert extended._state_tasks(10**6, 12, 4) == 4, "never more than the session's"


def test_bags_are_scanned_and_copied_in_parts(spark, monkeypatch):
    monkeypatch.setattr(changes, "TASK_ROWS", 100)
    monkeypatch.setattr(changes, "COPIES", 10)
    state = spark.range(2000).select("id").unionAll(spark.range(35).select(F.lit(5000).cast("long")))
    log = spark.range(20).select(F.lit(1).alias("txn"), F.lit("delete").alias("op"), F.lit(5000).cast("long").alias("id")).unionAll(spark.range(5).select(F.lit(2), F.lit("insert"), "id"))
    out = changes.apply_changes_bag(state, log, blocked=False).withColumn("task", F.spark_partition_id())
    tasks = {r[0]: r[1] for r in out.groupBy("task").count().collect()}
    assert max(tasks.values()) <= 250 and len(tasks) >= 15, "tasks are as many as rows need, whatever their size in bytes"
    counts = {r[0]: r[1] for r in out.groupBy("id").count().collect()}
    assert counts == {k: 1 + (k < 5) for k in range(2000)} | {5000: 15}
