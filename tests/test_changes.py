import random

from deltaloom.functions import scalars
from deltaloom.operators import changes, events, jobs, overlay, ownership, scans
from pyspark.sql import functions as F

LOG = "txn long, grp int, query_set_id int, op string, k long, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_coalesce_is_update_in_either_group_order(spark):
    log = spark.createDataFrame([(1, 0, 1, "insert", 1, "new"), (1, 1, 1, "delete", 1, "old"), (1, 0, 1, "delete", 2, "x"), (2, 0, 1, "insert", 2, "y")], LOG)
    out = changes.coalesce_changes(log, ["k"])
    assert rows(out.select("txn", "k", "kind")) == [(1, 1, "update"), (1, 2, "delete"), (2, 2, "insert")]


def test_strict_tells_ghost_deletes(spark):
    state = spark.createDataFrame([(1, "a")], "k long, v string")
    log = spark.createDataFrame([(1, 0, 1, "delete", 9, "gone"), (1, 0, 1, "insert", 1, "a")], LOG)
    assert rows(changes.classify_against_state(state, log, ["k"], "strict").select("k", "kind")) == [(1, "insert"), (9, "delete")]
    assert rows(changes.classify_against_state(state, log, ["k"]).select("k", "kind")) == []


def test_bag_matches_loop(spark):
    rng = random.Random(42)
    state = [rng.randrange(4) for _ in range(12)]
    log = [(t, rng.choice(["delete", "insert"]), rng.randrange(4)) for t in range(40) for _ in range(2)]
    bag = list(state)
    for t in range(40):
        for op in ("delete", "insert"):
            for x in (v for u, o, v in log if u == t and o == op):
                if op == "insert":
                    bag.append(x)
                elif x in bag:
                    bag.remove(x)
    out = changes.apply_changes_bag(spark.createDataFrame([(x,) for x in state], "v int"), spark.createDataFrame(log, "txn long, op string, v int"))
    assert sorted(r[0] for r in out.collect()) == sorted(bag)


def test_owned_delta_matches_model(spark):
    rng = random.Random(7)
    owns, value, log, want = {}, {}, [], []
    for txn in range(60):
        # sets come in any order in a message
        for place, q in enumerate(rng.sample((1, 2, 3), 3)):
            for k in range(4):
                mine = q in owns.get(k, set())
                if rng.random() < 0.3:
                    before = bool(owns.get(k))
                    if mine and rng.random() < 0.5:
                        log.append((txn, place, 0, q, "delete", k, value[k]))
                        owns[k].discard(q)
                        if not owns[k]:
                            want.append((txn, q, k, "delete"))
                    else:
                        new = str(rng.randrange(3))
                        log.append((txn, place, 0, q, "insert", k, new))
                        owns.setdefault(k, set()).add(q)
                        if not before:
                            want.append((txn, q, k, "insert"))
                        elif value[k] != new:
                            want.append((txn, q, k, "update"))
                        value[k] = new
    steps = ownership.ownership_steps(spark.createDataFrame([], "k long, v string"), spark.createDataFrame([], "k long, query_set_id int"), spark.createDataFrame(log, LOG.replace("grp", "set_no int, grp")), ["k"])
    assert rows(ownership.owned_events(steps, ["k"]).select("txn", "query_set_id", "k", "kind")) == sorted(want, key=str)
    final = ownership.state_after(spark.createDataFrame([], "k long, v string"), steps, ["k"])
    assert rows(final) == sorted(((k, value[k]) for k in owns if owns[k]), key=str)


def test_overlay_phantom_and_rollback(spark):
    state = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    entry = "seq long, change_no int, request_id string, kind string, k long, old struct<k:long,v:string>, new struct<k:long,v:string>"
    over = spark.createDataFrame([(1, 0, "r", "update", 1, None, (1, "x")), (2, 0, "s", "delete", 2, (2, "b"), None), (3, 0, "s", "update", 5, None, (5, "ghost"))], entry)
    assert rows(overlay.visible_state(state, over, ["k"])) == [(1, "x")]
    assert rows(overlay.visible_state(state, overlay.rollback(over, "s"), ["k"])) == [(1, "x"), (2, "b")]


def test_query_hash_and_refs(spark):
    def fnv(queries):
        h = 2166136261
        for q in sorted(" ".join(q.split()) for q in queries):
            for b in q.encode("utf-16-le") + b"\n":
                h = (h ^ b) * 16777619 % 2**32
        return h

    df = spark.createDataFrame([(["SELECT * FROM  b", " select x from 'é' "],)], "q array<string>")
    assert df.select(scalars.query_hash(F.col("q"))).first()[0] == fnv(["SELECT * FROM  b", " select x from 'é' "])
    refs = spark.createDataFrame([('SELECT n.* FROM folder f JOIN "note" n ON 1 = 1',)], "q string").select(scalars.table_refs(F.col("q"))).first()[0]
    assert refs == ["folder", "note"]


def test_held_mutations_spread(spark):
    from deltaloom.sources.scratch import ensure

    ensure(spark)
    m = spark.createDataFrame([(1, ["a"]), (2, ["a", "b"]), (3, ["b"]), (4, ["c"]), (5, None), (6, ["d"])], "seq long, keys array<string>")
    held = overlay.held_mutations(m, spark.createDataFrame([("a",)], "key string"))
    assert sorted(r[0] for r in held.collect()) == [1, 2, 3, 5, 6]


def test_error_text(spark):
    df = spark.createDataFrame([(bytearray(b"\x02\x00\x00\x00hi"),), (bytearray(b"plain"),)], "b binary")
    assert [r[0] for r in df.select(events.error_text("b")).collect()] == ["hi", "plain"]


def test_hand_over_within_a_message(spark):
    """A set that takes a key before another gives it up tells an update at most; after it, a delete and an insert."""
    state, owners = spark.createDataFrame([(1, "a")], "k long, v string"), spark.createDataFrame([(1, 1)], "k long, query_set_id int")
    for take, give, want in ((0, 1, []), (1, 0, [(1, "delete"), (2, "insert")])):
        log = spark.createDataFrame([(7, take, 0, 2, "insert", 1, "a"), (7, give, 0, 1, "delete", 1, "a")], LOG.replace("grp", "set_no int, grp"))
        steps = ownership.ownership_steps(state, owners, log, ["k"])
        assert rows(ownership.owned_events(steps, ["k"]).select("query_set_id", "kind")) == want
        assert rows(ownership.state_after(state, steps, ["k"])) == [(1, "a")]
        assert rows(ownership.owners_after(steps, ["k"])) == [(1, 2)]


def test_batches_of_a_bulk_load(spark):
    """A batch of 30,000 events is one row of the manifest, and no row holds them."""
    kinds = F.when(F.col("id") % 3 == 0, "update").when(F.col("id") % 3 == 1, "insert").otherwise("delete")
    load = spark.range(30_000).select(F.lit(1).cast("long").alias("txn"), F.col("id").alias("k"), kinds.alias("kind"), F.lit(None).cast("long").alias("old"), F.col("id").alias("new"))
    events = changes.deliver_events(load.unionByName(load.where("k < 5").withColumn("txn", F.lit(2).cast("long"))).repartition(4))
    batches = {r["txn"]: r for r in changes.transaction_batches(events).collect()}
    assert [tuple(batches[t])[:4] for t in (1, 2)] == [(1, 10_000, 10_000, 10_000), (2, 2, 1, 2)]
    assert batches[1]["last_at"] < batches[2]["first_at"]
    own = changes.events_of(events, batches[1]["first_at"], batches[1]["last_at"]).collect()
    assert [(r["kind"], r["k"]) for r in own] == [(kind, k) for at, kind in ((1, "insert"), (2, "delete"), (0, "update")) for k in range(30_000) if k % 3 == at]
    assert events.inputFiles() and all(r["new"] == r["k"] for r in own)


def test_blocks_give_the_same_steps(spark):
    rng = random.Random(11)
    log = [(txn, txn % 2, 0, q, rng.choice(["insert", "delete"]), k, str(rng.randrange(3))) for txn in range(80) for q in (1, 2, 3) for k in (0, 1, None, rng.randrange(9)) if rng.random() < 0.4]
    log = spark.createDataFrame(log, "txn long, set_no int, grp int, query_set_id int, op string, k long, v string")
    state, owners = spark.createDataFrame([(0, "s"), (7, "t"), (8, "u")], "k long, v string"), spark.createDataFrame([(0, 1), (0, 3), (7, 2)], "k long, query_set_id int")
    plain = ownership.ownership_steps(state, owners, log, ["k"], blocked=False)
    blocks = ownership.ownership_steps(state, owners, log, ["k"], blocked=True)
    names = ["k", "txn", "set_no", "query_set_id", "owns", "gain", "after", "value", "before", "previous"]
    assert rows(blocks.select(*names)) == rows(plain.select(*names))
    assert sorted(blocks.columns) == sorted(plain.columns)


def test_a_hot_key_is_dealt_over_blocks(spark):
    hot = spark.range(20_000).select(F.when(F.col("id") % 20 == 0, F.col("id")).otherwise(-1).alias("k"), F.col("id").alias("t"), F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("v"))
    assert scans.has_hot_key(hot, ["k"], 10_000) and not scans.has_hot_key(hot, ["k"], 19_001)
    blocks = scans.cut(hot, ["k"], ["t"], 8)
    most = blocks.groupBy("_block").count().agg(F.max("count"), F.count("*")).first()
    assert most[0] < 20_000 / 4 and most[1] >= 7
    out = scans.following(scans.running(blocks, ["k"], ["t"], {"s": "v"}, {"l": "v"}), ["k"], ["t"], "next", "t")
    out = scans.running(out, ["k"], ["t"], {"s0": "v"}, {"l0": "v"}, before=True)
    got = {r["t"]: (r["s"], r["l"], r["next"], r["s0"], r["l0"]) for r in out.where("k = -1").collect()}
    times = [t for t in range(20_000) if t % 20]
    total, last = 0, None
    for t, later in zip(times, [*times[1:], None], strict=True):
        before = (total, last)
        v = t % 7 if t % 3 else None
        total, last = total + (v or 0), last if v is None else v
        assert got[t] == (total, last, later, *before)


def test_bag_in_blocks(spark):
    rng = random.Random(9)
    state = spark.createDataFrame([(rng.randrange(3),) for _ in range(9)] + [(None,)], "v int")
    log = spark.createDataFrame([(t, rng.choice(["delete", "delete", "insert"]), rng.choice([0, 1, 2, None])) for t in range(200) for _ in range(3)], "txn long, op string, v int")
    assert rows(changes.apply_changes_bag(state, log, blocked=True)) == rows(changes.apply_changes_bag(state, log, blocked=False))


def test_percentiles_of_one_hot_group(spark):
    rng = random.Random(2)
    values = {"hot": [rng.choice([5, 10**15, -3, rng.randrange(10**6)]) for _ in range(4000)], "one": [7], None: [1, 2], "same": [4] * 9, "ends": [-(2**63), 2**63 - 1, 0, 0]}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in [*vs, None]], "g string, v long")
    at = lambda vs, p: sorted(vs)[int(p * (len(vs) - 1) + 0.5)]
    out = jobs.latency_report(df, ["g"], "v")
    assert {r["g"]: tuple(r)[1:] for r in out.collect()} == {g: (at(vs, 0.5), at(vs, 0.95), at(vs, 0.99), len(vs)) for g, vs in values.items()}
    inf = float("inf")
    odd = spark.createDataFrame([(v,) for v in [-inf, -1e308, -2.5, 0.0, 1e-300, 3e-300, 1.0, 1e308, inf, float("nan")]], "v double")
    found = jobs.latency_report(odd, [], "v", [k / 9 for k in range(9)]).first()
    assert list(found)[:9] == [-inf, -1e308, -2.5, 0.0, 1e-300, 3e-300, 1.0, 1e308, inf]


def test_confirmed_overlays_tell_nothing(spark):
    change = spark.createDataFrame([(r, True, kind, k, (k, "new")) for r, kind, k in [(1, "update", 1), (2, "update", 1), (3, "delete", 9), (4, "delete", 9), (5, "insert", 1)]], "request_id int, subscribed boolean, kind string, k long, new struct<k:long,v:string>")
    state, owners = spark.createDataFrame([(1, "new")], "k long, v string"), spark.createDataFrame([(1, 1)], "k long, query_set_id int")
    none = spark.createDataFrame([], "k long")
    log = spark.createDataFrame([(1, 1), (3, 9), (5, 1), (4, 9), (6, 6)], "request_id int, k long")
    confirmed = overlay.confirmed_keys(log, spark.createDataFrame([(4,)], "request_id int"), ["k"])
    seen = lambda **o: dict(rows(overlay.mutation_landed(change, state, owners, none, ["k"], **o)))
    assert seen() == dict.fromkeys(range(1, 6), "landed")
    assert seen(confirmed=confirmed) == {1: "undetectable", 2: "landed", 3: "undetectable", 4: "landed", 5: "landed"}
    assert seen(confirmed=confirmed, overlay_is_proof=True) == dict.fromkeys(range(1, 6), "landed")


def test_null_keys_meet_in_a_diff(spark):
    old, new = (spark.createDataFrame([(None, "a"), (1, "x")], "k long, v string"), spark.createDataFrame([(None, "b"), (1, "x")], "k long, v string"))
    assert rows(changes.snapshot_diff(old, new, ["k"]).select("k", "kind")) == [(None, "update")]


def test_later_rows_win(spark):
    state, new = spark.createDataFrame([(1, "a")], "k long, v string"), spark.createDataFrame([(1, "z", 0), (1, "b", 1)], "k long, v string, place int")
    assert rows(changes.upsert_rows(state, new, ["k"], ["place"])) == [(1, "b")]
    log = spark.createDataFrame([(1, 0, 0, 1, "insert", 1, "z"), (1, 0, 1, 1, "insert", 1, "b")], "txn long, grp int, pos int, query_set_id int, op string, k long, v string")
    assert [r["new"]["v"] for r in changes.coalesce_changes(log, ["k"]).collect()] == ["b"]
