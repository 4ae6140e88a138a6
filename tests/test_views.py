import pytest
from pyspark.sql import functions as F

from deltaloom.operators import events, jobs, overlay, ownership, views
from deltaloom.sources import tables
from deltaloom.sources.scratch import ensure


def rows(df, *by):
    return sorted(map(tuple, df.select(*by).collect() if by else df.collect()), key=str)


def test_find_and_views(spark):
    s = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id int, v string")
    assert rows(views.find(s, ["id"], 1)) == [(1, "a")]
    assert rows(views.find(s, ["id"], 9)) == rows(views.find(s, [], 1)) == []
    assert rows(views.view_option(s, F.col("id") == 9)) == []
    assert rows(views.view_single(s, F.col("id") == 1)) == [(1, "a")]
    for bad in (2, 9):
        with pytest.raises(Exception, match="exactly one row"):
            views.view_single(s, F.col("id") == bad).collect()


def test_query_sets(spark):
    q = spark.createDataFrame([(1, 1, "SELECT * FROM a"), (1, 2, "select * from Nowhere"), (1, 3, "SELECT * FROM gone"), (2, 1, 'SELECT x.* FROM "a" x JOIN nowhere ON 1 = 1'), (3, 1, "SELECT * FROM nowhere"), (4, 1, "SELECT * FROM a JOIN b ON 1 = 1")], "query_set_id int, query_no int, query string")
    catalog = spark.createDataFrame([("A",), ("b",)], "table_name string")
    assert rows(views.validate_query_sets(q, catalog), "query_set_id", "query_no") == [(1, 1), (1, 3), (2, 1), (4, 1)]
    assert rows(views.emptied_sets(q, catalog)) == [(3,)]
    # tables that are only joined return no rows, and names are taken as they are
    assert rows(views.covering_sets(q, "a")) == [(1,), (2,), (4,)] and rows(views.covering_sets(q, "A")) == []
    assert views.table_covered(q, "gone") and not views.table_covered(q, "b")
    assert rows(views.tags_for_table(q, "b"), "query_set_id", "query_no") == [(1, 1), (1, 2), (1, 3), (2, 1), (3, 1), (4, 1)]


def test_tags_mind_case(spark):
    q = spark.createDataFrame([(1, 1, "SELECT * FROM LineItem"), (1, 2, "select * from lineitem"), (1, 3, "SELECT * FROM x"), (2, 1, "SELECT * FROM LineItem"), (2, 2, "SELECT * FROM y")], "query_set_id int, query_no int, query string")
    assert rows(views.tags_for_table(q, "lineitem"), "query_set_id", "query_no") == [(1, 2), (2, 1), (2, 2)]
    assert rows(views.tags_for_table(q, "LineItem"), "query_set_id", "query_no") == [(1, 1), (2, 1)]


def test_query_hash_sorts_by_utf16_units(spark):
    from deltaloom.functions import scalars

    def fnv(texts):
        h = 2166136261
        for t in sorted(texts, key=lambda t: t.encode("utf-16-be")):
            for b in t.encode("utf-16-le") + b"\n":
                h = (h ^ b) * 16777619 % 2**32
        return h

    for texts in (["b", "a"], ["\U0001f600", "\ufb00"], ["SELECT é", "SELECT e"]):  # the second pair: UTF-8 sorts the other way
        assert spark.createDataFrame([(texts,)], "q array<string>").select(scalars.query_hash(F.col("q"))).first()[0] == fnv(texts)


def test_draws_of_the_generator(spark):
    ensure(spark)
    ids = [3, 5, 8, 13, 21, 34, 55]
    x, hits = 42, dict.fromkeys(ids, 0)
    for _ in range(50):
        x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
        hits[ids[(x >> 33) % len(ids)]] += 1
    state = spark.createDataFrame([(i, 0, 1.5) for i in ids], "id long, health int, x double")
    out = jobs.random_mutations(state, 50, 42, "id", ["health", "x"])
    assert {r["id"]: r["health"] for r in out.collect()} == hits and all(r["x"] == 1.5 + hits[r["id"]] for r in out.collect())


def test_feeds_count_a_batch_once(spark, tmp_path):
    from deltaloom.streaming import feeds

    log = "txn long, set_no int, grp int, query_set_id int, op string, id long, v string"
    batches = [[(1, 0, 0, 1, "insert", 1, "a"), (1, 1, 0, 2, "insert", 1, "a")], [(2, 0, 0, 1, "delete", 1, "a")], [(3, 0, 0, 2, "delete", 1, "a"), (3, 0, 0, 2, "insert", 2, "b")]]

    class Stream:
        """Hands batches to the writer's function, the second one twice."""

        sparkSession = spark
        columns = [c.split()[0] for c in log.split(", ")]

        @property
        def writeStream(self):
            return self

        def foreachBatch(self, put):
            for n, rows_ in enumerate(batches):
                for _ in range(1 + (n == 1)):
                    put(spark.createDataFrame(rows_, log), n)

    state, owners = spark.createDataFrame([], "id long, v string"), spark.createDataFrame([], "id long, query_set_id int")
    path = f"file://{tmp_path}"
    feeds.owned_feed(Stream(), f"{path}/owned", ["id"], state, owners)
    got = spark.read.parquet(f"{path}/owned/events")
    assert rows(got, "txn", "query_set_id", "id", "kind") == [(1, 1, 1, "insert"), (3, 2, 1, "delete"), (3, 2, 2, "insert")]
    feeds.ordered_apply(Stream(), f"{path}/ordered", ["id"], state)
    assert rows(feeds.ordered_state(spark, f"{path}/ordered", ["id"], state)) == [(2, "b")]
    assert rows(feeds.ordered_state(spark, f"{path}/none", ["id"], state)) == []


def test_drop_with_rows(spark):
    state = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    owners = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 2)], "id int, query_set_id int")
    left, rest = ownership.drop_with_rows(state, owners, state.where("id < 3"), 2, ["id"])
    assert rows(left) == [(1,), (3,)]
    assert rows(rest, "id", "query_set_id") == [(1, 1)]


def test_mixed_batch(spark):
    s = spark.createDataFrame([(i, 0) for i in (5, 1, 9, 3)], "id long, v int")
    new = spark.createDataFrame([(1, 7), (2, 8)], "place long, v int")
    assert rows(jobs.mixed_batch(s, "id", 1, 2, new, v=F.lit(1))) == [(1, 1), (10, 7), (11, 8), (9, 0)]
    assert rows(jobs.mixed_batch(s, "id", 0, 0, new, v=F.lit(1))) == [(1, 0), (10, 7), (11, 8), (3, 0), (5, 0), (9, 0)]
    assert rows(jobs.mixed_batch(s.where("id < 0"), "id", 2, 2, new, v=F.lit(1))) == [(1, 7), (2, 8)]


def test_held_mutations_spread_over_a_long_chain(spark):
    ensure(spark)
    m = spark.createDataFrame([(i, [f"k{i}", f"k{i + 1}"]) for i in range(12)] + [(50, ["other"])], "seq long, keys array<string>")
    awaited = spark.createDataFrame([("k3",)], "key string")
    for plain in (0, 50):  # by doubling at once, and not at all
        assert rows(overlay.held_mutations(m, awaited, plain)) == sorted([(i,) for i in range(2, 12)], key=str)
    unknown = m.unionAll(spark.createDataFrame([(20, None)], m.schema))
    assert (50,) in rows(overlay.held_mutations(unknown, awaited))


def test_read_state_keeps_good_rows(spark, tmp_path):
    path = str(tmp_path / "s.json")
    with open(path, "w") as f:
        f.write('{"id": 1, "v": "a"}\n{torn\n\n{"id": 2}\n')
    schema = spark.createDataFrame([], "id int, v string").schema
    good, bad = tables.read_state(spark, path, schema)
    assert rows(good) == [(1, "a"), (2, None)]
    assert rows(bad) == [("{torn",)]
    good, bad = tables.read_state(spark, str(tmp_path / "none"), schema)
    assert rows(good) == rows(bad) == []


def test_late_snapshots_apply_once(spark):
    replies = spark.createDataFrame([(1, 5, "a"), (1, 6, "b"), (2, 5, "c")], "request_id long, result_ts int, v string")
    waiting = spark.createDataFrame([(1,), (3,)], "request_id long")
    assert rows(events.late_snapshots(replies, waiting)) == [(1, 5, "a")]


def test_import_legacy_queue(spark, tmp_path):
    path = str(tmp_path / "queue.json")
    with open(path, "w") as f:
        f.write('[{"requestId": "r1", "reducerName": "x"}, {"requestId": "r2", "reducerName": "y"}]')
    assert rows(tables.replay_journal(tables.import_legacy_queue(spark, path)), "request_id") == [("r1",), ("r2",)]


def test_held_mutations_match_a_queue(spark):
    import random

    ensure(spark)
    rng = random.Random(4)
    queue = [(i, rng.sample("abcdefghijklmnopqrstuvwxyz", 2)) for i in range(60)]
    waits, want = {"a"}, []
    for seq, keys in queue:
        if waits & set(keys):
            waits |= set(keys)
            want.append((seq,))
    m = spark.createDataFrame(queue, "seq long, keys array<string>")
    assert rows(overlay.held_mutations(m, spark.createDataFrame([("a",)], "key string"), 1)) == sorted(want, key=str)


def test_a_chain_of_100_000_takes_few_rounds(spark, monkeypatch):
    from pyspark.sql import functions as F

    n, steps, write = 100_000, [], overlay.written
    monkeypatch.setattr(overlay, "written", lambda df, name: steps.append(name) or write(df, name))
    key = lambda c: F.concat(F.lit("k"), c.cast("string"))
    m = spark.range(n).select(F.col("id").alias("seq"), F.array(key(F.col("id")), key(F.col("id") + 1)).alias("keys"))
    held = overlay.held_mutations(m, spark.createDataFrame([("k10",)], "key string"))
    assert held.agg(F.min("seq"), F.max("seq"), F.count("*")).first() == (9, n - 1, n - 9)
    assert len(steps) < 3 * 17 + 10, "jumps of 1, 2, 4, ... once up and once down"


def test_messages_to_state(spark):
    """Sets, groups and rows of a message keep their places; events hold nothing."""
    from deltaloom.operators import changes

    group = "struct<inserts:array<struct<id:long,v:string>>,deletes:array<struct<id:long,v:string>>,events:array<struct<id:long,v:string>>>"
    nested = f"txn long, query_sets array<struct<query_set_id:int,tables:array<struct<table_name:string,groups:array<{group}>>>>>"
    message = [(7, [("t", [([(1, "z"), (1, "b")], [(1, "a")], None), ([(2, "c")], [], [(9, "e")])])]), (3, [("t", [([(1, "w")], [], [])]), ("u", [([(5, "u")], [], [])])])]
    flat = tables.flatten_transactions(spark.createDataFrame([(4, message)], nested))
    assert rows(flat.where("op = 'event'"), "set_no", "grp", "query_set_id", "table_name") == [(0, 1, 7, "t")]
    log = tables.log_of_table(flat, "t")
    state = spark.createDataFrame([(1, "a")], "id long, v string")
    assert rows(changes.apply_changes(state, log, ["id"])) == [(1, "w"), (2, "c")]
    assert rows(changes.apply_changes(state, log.where("set_no = 0"), ["id"])) == [(1, "b"), (2, "c")]
    assert rows(tables.log_of_table(flat, "u"), "set_no", "op", "id") == [(1, "insert", 5)]


def test_versions_of_a_state(spark, tmp_path):
    root = f"file://{tmp_path}/state"
    assert tables.current_state(spark, root) is None
    for k in (1, 2):
        tables.write_state(spark.createDataFrame([(i,) for i in range(k)], "id long"), None, root)
        assert tables.current_state(spark, root).count() == k
