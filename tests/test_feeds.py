"""Feeds over held state: flat reads, batches that run again, streams against the batch operators."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.operators import ownership
from deltaloom.streaming import feeds
from deltaloom.streaming.held import HeldState

ROW = "k long, row string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def rocks(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", feeds.ROCKS)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def state(spark, path, **options):
    return HeldState(spark, path, ["k"], T.StructType([T.StructField("k", T.LongType()), T.StructField("row", T.StringType())]), "row is not null", **options)


@pytest.fixture
def one_task(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


#: 200 batches take five minutes.
BATCHES = int(os.environ.get("FEED_BATCHES", "60"))


def test_batches_read_alike(spark, tmp_path, one_task):
    held, now, rng, read = state(spark, f"{tmp_path}/s", buckets=4, most=3), {k: "base" for k in range(40)}, random.Random(1), []
    held.start(spark.createDataFrame(list(now.items()), ROW))
    held.start(spark.createDataFrame([(99, "no: there is a version already")], ROW))
    for batch in range(BATCHES):
        change = {rng.randrange(40): rng.choice([None, f"v{batch}"]) for _ in range(6)}
        df = spark.createDataFrame([*change.items()], ROW).coalesce(1)
        buckets = held.touched(df)
        folders = held.folders(buckets, batch)
        assert len(folders) <= 3 * len(buckets)
        if batch % 20 == 19:
            read.append(spark.read.schema(ROW).parquet(*folders).count())
        held.put(df, batch)
        if batch % 50 == 7:
            was = rows(held.rows())
            held.put(df, batch)  # once more, as after a failure
            assert rows(held.rows()) == was
        now |= change
    assert rows(held.rows()) == sorted(((k, v) for k, v in now.items() if v), key=str)
    assert max(read) <= 40 + 3 * 6 * 3, "a batch reads its buckets' keys and a few versions of them, whatever came before"
    assert len(list((tmp_path / "s" / "manifests").glob("*.json"))) <= 8
    assert len(list((tmp_path / "s").glob("version=*/bucket=*"))) <= 4 * (3 + 8)
    some = spark.createDataFrame([(3,), (17,), (1000,)], "k long")
    assert rows(held.of(some)) == sorted(((k, now[k]) for k in (3, 17) if now[k]), key=str)


def test_older_versions_and_keys_that_go(spark, tmp_path):
    held = state(spark, f"{tmp_path}/s", buckets=1, most=2)
    held.start(spark.createDataFrame([(1, "a"), (2, "b")], ROW))
    held.put(spark.createDataFrame([(1, None)], ROW), 0)
    held.put(spark.createDataFrame([(2, None)], ROW), 1)  # the bucket is merged, and nothing is left
    assert rows(held.rows()) == [] and held.folders() == []
    assert rows(held.rows(0)) == [(2, "b")] and rows(held.rows(-1)) == [(1, "a"), (2, "b")]
    held.put(spark.createDataFrame([], ROW), 2)
    held.put(spark.createDataFrame([(5, "e")], ROW), 3)
    assert rows(held.rows()) == [(5, "e")]
    with pytest.raises(ValueError):
        state(spark, f"{tmp_path}/x", most=0)


LOG = "key long, txn long, set_no int, query_set_id long, op string, row string"


def test_owned_events_with_values(spark, tmp_path, rocks):
    rng = random.Random(3)
    log = [(rng.randrange(4), txn, q % 2, q, rng.choice(["insert", "insert", "delete"]), str(rng.randrange(3))) for txn in range(60) for q in (1, 2, 3) if rng.random() < 0.6]
    first = [(0, "base", [1, 2]), (1, "base", [3]), (9, "idle", [1])]
    source, sink = f"{tmp_path}/in", f"{tmp_path}/out"
    for low in (0, 20, 40):
        spark.createDataFrame([r for r in log if low <= r[1] < low + 20], LOG).coalesce(1).write.mode("append").parquet(source)
    initial = spark.createDataFrame(first, "key long, row string, sets array<long>")
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(source)
    feeds.owned_key_events(stream, initial).writeStream.format("parquet").option("path", sink).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    base = initial.select("key", "row")
    owners = initial.select("key", F.explode("sets").alias("query_set_id"))
    change = spark.createDataFrame(log, LOG).withColumn("grp", F.lit(0))
    steps = ownership.ownership_steps(base, owners, change.select("txn", "set_no", "grp", "query_set_id", "op", "key", "row"), ["key"])
    want = ownership.owned_events(steps, ["key"]).select("key", "txn", "query_set_id", "kind", F.col("old.row").alias("old"), F.col("new.row").alias("new"))
    got = rows(spark.read.parquet(sink))
    assert got == rows(want) and {r[3] for r in got} == {"insert", "update", "delete"}


def test_state_then_changes_that_arrive_meanwhile(spark, tmp_path, rocks):
    shape = "key long, txn long, op string, row string"
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    put = lambda *r: spark.createDataFrame(list(r), shape).coalesce(1).write.mode("append").parquet(source)
    put((1, 1, "insert", "a"), (2, 2, "insert", "b"), (3, 3, "insert", "c"), (3, 4, "delete", "c"))
    now = spark.createDataFrame([(1, "a"), (2, "b")], "key long, row string")  # as of 4
    put((1, 5, "insert", "a2"), (4, 6, "insert", "d"))  # between the snapshot and the start
    stream = lambda: spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(source)
    start = lambda: feeds.state_then_changes(stream(), now, 4, out).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    start()
    put((2, 7, "delete", "b"), (1, 8, "insert", "a2"), (3, 9, "insert", "c3"))
    start()  # again, after a stop
    told = rows(spark.read.parquet(out).select("key", "txn", "kind", "old", "new"))
    assert told == sorted([(1, 4, "state", None, "a"), (2, 4, "state", None, "b"), (1, 5, "update", "a", "a2"), (4, 6, "insert", None, "d"), (2, 7, "delete", "b", None), (3, 9, "insert", None, "c3")], key=str)


def test_late_listener(spark, tmp_path):
    path, sink, progress = (f"{tmp_path}/{n}" for n in ("told", "heard", "progress"))
    put = lambda n: spark.createDataFrame([(n, k) for k in range(3)], "n long, k long").write.parquet(f"{path}/batch={n}")
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("k", T.LongType())])

    def hear():
        feeds.late_listener(spark, path, schema, progress).writeStream.format("parquet").option("path", sink).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
        return rows(spark.read.schema("n long, k long, batch long").parquet(sink).select("n", "k"))

    for n in (0, 1, 10):
        put(n)
    assert hear() == []
    put(11)
    put(12)
    assert hear() == [(n, k) for n in (11, 12) for k in range(3)]
    put(13)
    assert hear() == hear() == [(n, k) for n in (11, 12, 13) for k in range(3)]


def test_owned_feed_runs_again(spark, tmp_path):
    key, log = ["k"], "txn long, grp int, set_no int, query_set_id int, op string, k long, v string"
    state, owners = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), spark.createDataFrame([(1, 1), (2, 1), (2, 2)], "k long, query_set_id int")
    change = [(1, 0, 0, 1, "delete", 1, "a"), (1, 0, 0, 1, "delete", 2, "b"), (2, 0, 0, 2, "insert", 3, "c"), (3, 0, 0, 2, "insert", 2, "b2")]
    path = str(tmp_path)
    held = feeds.held_owners(spark, f"{path}/held", key, state.schema)
    for again in range(2):
        source = f"{path}/in{again}"
        for r in change:
            spark.createDataFrame([r], log).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(log).option("maxFilesPerTrigger", 2).parquet(source)
        # a new checkpoint runs the same batches again
        feeds.owned_feed(stream, path, key, state, owners).option("checkpointLocation", f"{path}/c{again}").trigger(availableNow=True).start().awaitTermination()
        assert rows(spark.read.parquet(f"{path}/events").select("txn", "k", "kind")) == [(1, 1, "delete"), (2, 3, "insert"), (3, 2, "update")]
        assert sorted((r["k"], r["row"]["v"], sorted(r["sets"])) for r in held.rows().collect()) == [(2, "b2", [2]), (3, "c", [2])]


def test_direct_write_and_windows(spark, tmp_path, rocks):
    log, key, path = "txn long, table_name string, k long, v string, op string", ["table_name", "k"], str(tmp_path)
    none = spark.createDataFrame([], "table_name string, k long, v string")
    source = f"{path}/in"
    for txn in range(3):
        spark.createDataFrame([(txn, t, k, f"{t}{txn}", "insert") for t in ("a", "b", "events") for k in (0, txn)], log).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(log).option("maxFilesPerTrigger", 1).parquet(source)
    feeds.ordered_apply(stream, f"{path}/s", key, none, f"{path}/marks").option("checkpointLocation", f"{path}/c").trigger(availableNow=True).start().awaitTermination()
    held = feeds.held_rows(spark, f"{path}/s", key, none.schema)
    feeds.write_now(held, "b", f"{path}/out", f"{path}/marks")
    marks = spark.readStream.schema("table_name string, version long, mark string").option("recursiveFileLookup", "true").parquet(f"{path}/marks")
    running = feeds.coalesced_snapshot_sink(marks, held, f"{path}/out", 300, ("events",)).option("checkpointLocation", f"{path}/c2").trigger(processingTime="200 milliseconds").start()
    try:
        running.awaitTermination(15)
    finally:
        running.stop()
    written = feeds.written_snapshots(spark, f"{path}/out")
    assert [tables for _, tables in written] == [["b"], ["a"]]  # three changes of a: one flush; b: written directly, so none
    got = spark.read.schema("k long, v string, table_name string").parquet(written[1][0])
    assert rows(got) == [(0, "a2", "a"), (1, "a1", "a"), (2, "a2", "a")]
    json.dumps(written)
