"""More registered queries: sources, views, query sets, generations, queues, functions and streams."""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager, nullcontext
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.functions import scalars
from deltaloom.operators import changes, events, jobs, overlay, ownership, views
from deltaloom.sources import tables
from deltaloom.sources.scratch import ensure
from deltaloom.streaming import feeds

from .fixtures import fixture, oracle
from .registry import KEY, ORACLE_SQL, OWNED_EVENTS, QUERIES, UNTIL_CHANGED, VISIBLE, _overlay, flat, query


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure(spark)}/{name}-{uuid.uuid4().hex}"


# sources and sinks


@query("SELECT o_orderkey, o_totalprice, CAST(0 AS BIGINT) AS unreadable FROM orders WHERE o_orderkey % 10 <> 0 UNION ALL SELECT NULL, NULL, count(*) FROM orders WHERE o_orderkey % 10 = 0")
def read_state(t):
    o = t("orders")
    path = _folder(o.sparkSession, "snapshot")
    o.select(F.when(F.col("o_orderkey") % 10 == 0, "{torn").otherwise(F.to_json(F.struct("o_orderkey", "o_totalprice"))).alias("value")).write.text(path)
    good, bad = tables.read_state(o.sparkSession, path, o.select("o_orderkey", "o_totalprice").schema)
    none = bad.agg(F.count("*").alias("unreadable")).select(F.lit(None).cast("long").alias("o_orderkey"), F.lit(None).cast("double").alias("o_totalprice"), "unreadable")
    return good.withColumn("unreadable", F.lit(0).cast("long")).unionByName(none)


@query("SELECT c_custkey AS request_id, 'call' || c_nationkey AS reducer FROM customer WHERE c_custkey % 4 <> 0")
def import_legacy_queue(t):
    """Queue files that are one JSON array each, a nation's customers in each; every fourth call is dequeued afterwards."""
    c = t("customer")
    path = _folder(c.sparkSession, "queues")
    call = F.struct(F.col("c_custkey").cast("string").alias("requestId"), F.concat(F.lit("call"), "c_nationkey").alias("reducerName"))
    c.groupBy("c_nationkey").agg(F.to_json(F.collect_list(call)).alias("value")).write.partitionBy("c_nationkey").text(path)
    lines = tables.import_legacy_queue(c.sparkSession, f"{path}/*/*.txt")
    gone = c.where("c_custkey % 4 = 0").select(F.lit(2**62).alias("seq"), F.format_string('{"op":"dequeue","requestId":"%d"}', "c_custkey").alias("line"))
    return tables.replay_journal(lines.unionByName(gone)).select(F.col("request_id").cast("long").alias("request_id"), F.col("mutation.reducerName").alias("reducer"))


@query("SELECT o_orderkey, o_totalprice FROM orders_base WHERE o_orderkey % 13 <> 0")
def write_state(t):
    p, root = t("prices"), _folder(t("prices").sparkSession, "state")
    tables.write_state(p, None, root)
    tables.write_state(p, p.where("o_orderkey % 13 = 0"), root)
    return tables.current_state(p.sparkSession, root)


@query("SELECT l_orderkey, l_linenumber FROM line_bag WHERE l_orderkey % 5 <> 0")
def write_state_bag(t):
    bag, root = t("line_bag").withColumn("request_id", F.when(F.col("l_orderkey") % 5 == 0, F.col("l_orderkey"))), _folder(t("line_bag").sparkSession, "state")
    tables.write_state(bag, None, root, bag.where("request_id is not null").select("request_id"))
    return tables.current_state(bag.sparkSession, root)


@query("SELECT event_id * 2 AS seq FROM events WHERE event_id % 3 <> 0 AND (event_id + 1) % 3 <> 0")
def compact_journal(t):
    e = t("events")
    on = e.where("event_id % 3 <> 0").select((F.col("event_id") * 2).alias("seq"), F.format_string('{"op":"enqueue","mutation":{"requestId":"%d"}}', "event_id").alias("line"))
    off = e.where("event_id % 3 <> 0 and (event_id + 1) % 3 = 0").select((F.col("event_id") * 2 + 1).alias("seq"), F.format_string('{"op":"dequeue","requestId":"%d"}', "event_id").alias("line"))
    bad = e.where("event_id % 3 = 0").select((F.col("event_id") * 2).alias("seq"), F.lit("{torn").alias("line"))
    return tables.compact_journal(on.unionAll(off).unionAll(bad)).select("seq")


@query("SELECT 'due' AS journal, event_id * 2 AS seq FROM events WHERE event_id % 5 = 0 UNION ALL SELECT 'not due', event_id * 2 FROM events UNION ALL SELECT 'not due', event_id * 2 + 1 FROM events WHERE event_id % 2 = 0")
def compact_journal_by_ratio(t):
    e = t("events")
    on = e.select((F.col("event_id") * 2).alias("seq"), F.format_string('{"op":"enqueue","mutation":{"requestId":"%d"}}', "event_id").alias("line"))
    off = lambda where: e.where(where).select((F.col("event_id") * 2 + 1).alias("seq"), F.format_string('{"op":"dequeue","requestId":"%d"}', "event_id").alias("line"))
    of = lambda name, where: tables.compact_journal(on.unionAll(off(where))).select(F.lit(name).alias("journal"), "seq")
    return of("due", "event_id % 5 <> 0").unionByName(of("not due", "event_id % 2 = 0"))


# lookups and views


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey = 7")
def find(t):
    return views.find(t("orders"), KEY, 7).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders_base")
def current_rows(t):
    return t("orders_base").select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT event_id, user_id FROM events WHERE event_id >= 100 AND value >= 10")
def view_array(t):
    return views.view_array(t("events"), F.expr("event_id >= 100 and value >= 10"), "events_from_100").select("event_id", "user_id")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey = 1")
def view_option(t):
    return views.view_option(t("customer"), F.col("c_custkey") == 1).select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey = 3")
def view_single(t):
    return views.view_single(t("customer"), F.col("c_custkey") == 3).select("c_custkey", "c_name")


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 1000 GROUP BY o_orderstatus")
def view_query(t):
    o = t("orders").where("o_totalprice > 1000").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return views.view_array(o, F.lit(True), "orders_by_status")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def where_eq(t):
    return t("orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


# query sets


#: Queries by shape.
TEXTS = ["SELECT * FROM orders", 'select * from "customer" where c_custkey = 1', "SELECT o.* FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey", "SELECT * FROM nowhere", "SELECT * FROM Orders o JOIN nowhere n ON true"]


def _query_sets(t):
    text = F.get(F.array(*map(F.lit, TEXTS)), (F.col("c_nationkey") % 5).cast("int"))
    return t("customer").select((F.col("c_custkey") % 100).alias("query_set_id"), F.col("c_custkey").alias("query_no"), text.alias("query"))


def _catalog(t):
    return t("nation").select(F.explode(F.array(*map(F.lit, ("orders", "customer", "lineitem")))).alias("table_name")).distinct()


SETS = "(SELECT c_custkey % 100 AS query_set_id, c_custkey AS query_no, c_nationkey % 5 AS shape FROM customer)"
#: Tables that the shapes of query have after FROM, and join.
FROM, JOINED = "CASE shape WHEN 1 THEN 'customer' WHEN 3 THEN 'nowhere' WHEN 4 THEN 'Orders' ELSE 'orders' END", "CASE shape WHEN 2 THEN 'lineitem' WHEN 4 THEN 'nowhere' END"


@query(f"SELECT query_set_id, query_no, {FROM} AS table_name FROM {SETS} s UNION ALL SELECT query_set_id, query_no, {JOINED} FROM {SETS} s WHERE shape IN (2, 4)")
def query_table_refs(t):
    return views.query_table_refs(_query_sets(t))


@query(f"SELECT DISTINCT name AS table_name, query_set_id FROM {SETS} s JOIN (VALUES ('orders'), ('Orders'), ('ORDERS'), ('lineitem'), ('nowhere')) n(name) ON name = {FROM}")
def table_covered(t):
    q = _query_sets(t)
    covering = [views.covering_sets(q, name).select(F.lit(name).alias("table_name"), "query_set_id") for name in ("orders", "Orders", "ORDERS", "lineitem", "nowhere")]
    return reduce(DataFrame.unionByName, covering)


@query(f"SELECT query_set_id, query_no FROM {SETS} s WHERE query_no NOT IN (SELECT min(query_no) FROM {SETS} s WHERE shape = 3 GROUP BY query_set_id)")
def validate_query_sets(t):
    return views.validate_query_sets(_query_sets(t), _catalog(t)).select("query_set_id", "query_no")


@query(f"SELECT query_no AS query_set_id FROM {SETS} s WHERE shape = 3")
def emptied_sets(t):
    # each customer is a set of its own here
    return views.emptied_sets(_query_sets(t).withColumn("query_set_id", F.col("query_no")), _catalog(t))


def _fnv(*texts: str) -> str:
    """SQL of the hash of sorted texts without runs of spaces, whose characters are below 256."""
    units = ", ".join(f"flatten(list_transform(string_split({t}, ''), lambda c: [unicode(c)::UBIGINT, 0::UBIGINT])), [10::UBIGINT]" for t in texts)
    return f"CAST(list_reduce(flatten([[2166136261::UBIGINT], {units}]), lambda h, b: (xor(h, b) * 16777619::UBIGINT) % 4294967296::UBIGINT) AS BIGINT)"


@query(f"SELECT query_set_id, query_no, {_fnv('list_extract([' + ', '.join(repr(x) for x in TEXTS) + '], shape + 1)')} AS query_hash FROM {SETS} s WHERE shape = 2 OR query_set_id NOT IN (SELECT query_set_id FROM {SETS} s WHERE shape = 2)")
def tags_for_table(t):
    return views.tags_for_table(_query_sets(t), "lineitem")


@query(f"SELECT query_set_id, query_no, {_fnv('list_extract([' + ', '.join(repr(x) for x in TEXTS) + '], shape + 1)')} AS query_hash FROM {SETS} s WHERE shape = 4 OR query_set_id NOT IN (SELECT query_set_id FROM {SETS} s WHERE shape = 4)")
def tags_for_cased_table(t):
    return views.tags_for_table(_query_sets(t), "Orders")


@query(f"SELECT c_custkey, {_fnv('c_name', repr('SELECT 1'))} AS query_hash FROM customer")
def query_hash(t):
    return t("customer").select("c_custkey", scalars.query_hash(F.array(F.lit("SELECT   1"), F.concat(F.lit("  "), "c_name", F.lit(" ")))).alias("query_hash"))


# change application


@query("SELECT o_orderkey, o_totalprice FROM orders_base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM overlay)")
def delete_keys(t):
    return changes.delete_keys(t("prices"), overlay.protected_keys(t("overlay"), KEY), KEY)


@query("SELECT 'before' AS side, count(*) AS n FROM orders_base UNION ALL SELECT 'after', 0")
def clear_state(t):
    of = lambda side, rows: rows.agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "n")
    return of("before", t("prices")).unionByName(of("after", changes.clear_state(t("prices"))))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey % 3 END AS request_id FROM orders_base WHERE o_orderkey % 11 = 0 UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 4 = 0")
def initial_load(t):
    state = t("orders_base").select("o_orderkey", F.when(F.col("o_orderkey") % 11 == 0, F.col("o_orderkey") % 3).alias("request_id"))
    return changes.initial_load(state, t("orders").where("o_orderkey % 4 = 0").select("o_orderkey"))


@query("SELECT o_orderkey, 9 AS owner, CASE WHEN o_orderkey % 7 = 0 THEN 'insert' WHEN o_orderkey % 2 = 0 THEN 'update' END AS kind, o_totalprice + (o_orderkey + 1) % 2 AS new_price FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, NULL, 'delete', NULL FROM orders_base WHERE o_orderkey % 3 = 0")
def replace_state(t):
    rows = t("orders").where("o_orderkey % 3 <> 0").select("o_orderkey", F.expr("o_totalprice + (o_orderkey + 1) % 2").alias("o_totalprice"))
    state, owners, told = changes.replace_state(t("prices"), rows, KEY, 9)
    out = state.join(owners, KEY).join(told.select("o_orderkey", "kind"), KEY, "full_outer")
    return out.select("o_orderkey", F.col("query_set_id").alias("owner"), "kind", F.col("o_totalprice").alias("new_price"))


@query("SELECT o_orderkey, o_orderkey % 2 = 0 AS deep, o_orderkey % 2 = 0 AS shallow, true AS as_text FROM orders")
def rows_equal(t):
    o = t("orders")
    row = lambda n, m: F.struct(F.col("o_totalprice").alias("price"), n.alias("n"), m.alias("m"))
    key, other = F.col("o_orderkey"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).otherwise(F.concat(F.lit("x"), F.col("o_orderkey").cast("string")))
    pairs = o.select("o_orderkey", row(key.cast("string"), F.create_map(F.lit("a"), key, F.lit("b"), key + 1)).alias("a"), row(other, F.create_map(F.lit("b"), key + 1, F.lit("a"), key)).alias("b"))
    whole = pairs.schema["a"].dataType
    plain = T.StructType([whole["price"], whole["n"]])
    text = F.struct(F.col("o_orderkey").alias("n")), F.struct(F.col("o_orderkey").cast("string").alias("n"))
    same = changes.rows_equal_text(F.col("x"), F.col("y"), T.StructType([T.StructField("n", T.LongType())]))
    pairs = pairs.withColumns({"x": text[0], "y": text[1]})
    return pairs.select("o_orderkey", changes.rows_equal_deep(F.col("a"), F.col("b"), whole).alias("deep"), changes.rows_equal_shallow(F.col("a"), F.col("b"), plain).alias("shallow"), same.alias("as_text"))


# events


def _caused(t):
    e = t("events")
    return e.select("event_id", "event_type", F.when(F.col("event_id") % 2 == 0, "call").otherwise("remote").alias("cause"), (F.col("user_id") % 5).cast("string").alias("caller"), (F.col("event_id") % 3 == 0).alias("optimistic"))


@query("SELECT event_id FROM events WHERE event_id % 3 <> 0 AND NOT (event_id % 2 = 0 AND user_id % 5 = 1)")
def external_confirmed(t):
    return events.external_confirmed(events.with_context(_caused(t), "1")).select("event_id")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'optimistic' WHEN event_id % 4 = 0 THEN 'snapshot' WHEN event_id % 4 = 1 AND event_type = 'click' THEN 'call' ELSE 'remote' END AS cause FROM events")
def event_cause(t):
    message = F.when(F.col("event_id") % 4 == 0, "snapshot").when(F.col("event_id") % 4 == 1, "result").otherwise("transaction")
    e = _caused(t).withColumns({"message": message, "name": F.when(F.col("event_type") == "click", "click")})
    return e.select("event_id", events.event_cause().alias("cause"))


@query("SELECT c_custkey, c_name AS message FROM customer")
def error_text(t):
    size = F.lpad(F.hex(F.length("c_name")), 2, "0")
    raw = F.when(F.col("c_custkey") % 2 == 0, F.unhex(F.concat(size, F.lit("000000"), F.hex(F.encode("c_name", "UTF-8"))))).otherwise(F.encode("c_name", "UTF-8"))
    return t("customer").select("c_custkey", raw.alias("raw")).select("c_custkey", events.error_text("raw").alias("message"))


@query("SELECT request_id, outcome FROM calls JOIN results USING (request_id) WHERE name = 'click'")
def calls_by_name(t):
    return events.calls_by_name(events.match_results(t("calls"), t("results")), "click").select("request_id", "outcome")


@query("SELECT user_id, seq, value FROM history WHERE seq > 500")
def changes_after(t):
    return events.changes_after(t("history"), 500).select("user_id", "seq", "value")


@query("SELECT request_id, outcome FROM results JOIN calls USING (request_id) WHERE request_id % 20 > 10")
def late_snapshots(t):
    return events.late_snapshots(t("results"), events.call_timeouts(t("calls"), t("results"))).select("request_id", "outcome")


@query("SELECT event_id, user_id, event_id % 3 AS generation FROM events e WHERE event_id % 3 = (SELECT max(f.event_id % 3) FROM events f WHERE f.user_id = e.user_id)")
def drop_stale_generation(t):
    log = t("events").select("event_id", F.col("user_id").alias("connection_id"), (F.col("event_id") % 3).alias("generation"))
    return feeds.drop_stale_generation(log).select("event_id", F.col("connection_id").alias("user_id"), "generation")


# ownership


@query("SELECT o_orderkey, o_totalprice FROM orders_base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_owners WHERE query_set_id = 2 AND o_orderkey % 2 = 0) OR o_orderkey IN (SELECT o_orderkey FROM orders_owners WHERE query_set_id = 1)")
def drop_with_rows(t):
    owners = t("orders_owners")
    return ownership.drop_with_rows(t("prices"), owners, owners.where("query_set_id = 2 and o_orderkey % 2 = 0"), 2, KEY)[0]


@query("SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber) AS r FROM line_bag) x WHERE NOT (r = 1 AND l_orderkey % 3 = 0)")
def drop_with_rows_bag(t):
    dropped = t("line_bag").where("l_orderkey % 3 = 0").distinct()
    return ownership.drop_with_rows(t("line_bag"), None, dropped, 2, None)[0]


@query("SELECT DISTINCT o_orderkey, query_set_id FROM orders_owners WHERE query_set_id = 1 OR o_orderkey % 4 = 0")
def begin_generation(t):
    o = t("orders_owners")
    return ownership.begin_generation(o.where("query_set_id = 1"), o.where("o_orderkey % 4 = 0"))


REPLAY = {"applied": ("true", "false", "false"), "some errored": ("event_id % 2 = 0", "event_id % 2 = 1", "false"), "some open": ("event_id % 3 = 0", "event_id % 3 = 1", "false"), "one timed out": ("true", "false", "event_id = 7")}


@query(" UNION ALL ".join(f"SELECT '{n}' AS round, bool_and({a} OR {e}) AND NOT bool_or({o}) AS may_finalize, bool_and({a}) AS ready FROM events" for n, (a, e, o) in REPLAY.items()) + " UNION ALL SELECT 'no set', true, false")
def replay_complete(t):
    of = lambda n, rows, a, e, o: ownership.replay_complete(rows.select(F.expr(a).alias("applied"), F.expr(e).alias("errored"), F.expr(o).alias("timed_out"))).select(F.lit(n).alias("round"), "may_finalize", "ready")
    rounds = [of(n, t("events"), *flags) for n, flags in REPLAY.items()]
    return reduce(DataFrame.unionByName, [*rounds, of("no set", t("events").where("event_id < 0"), *REPLAY["applied"])])


@query("SELECT o_custkey AS request_id, bool_and(o_orderkey % 17 <> 0) AS matches FROM orders GROUP BY o_custkey")
def batch_reply_matches(t):
    sent = t("orders").select(F.col("o_custkey").alias("request_id"), F.col("o_orderkey").alias("query_set_id"))
    return ownership.batch_reply_matches(sent, sent.unionAll(sent.where("query_set_id % 17 = 0")))


@query("SELECT event_type AS table_name, CASE event_id % 3 WHEN 0 THEN 'unsubscribe' WHEN 1 THEN 'reconcile' ELSE 'sweep' END AS cause, count(*) AS evictions FROM events GROUP BY ALL")
def eviction_counts(t):
    cause = F.when(F.col("event_id") % 3 == 0, "unsubscribe").when(F.col("event_id") % 3 == 1, "reconcile").otherwise("sweep")
    return ownership.eviction_counts(t("events").select(F.col("event_type").alias("table_name"), cause.alias("cause")))


TAGS = "SELECT o_orderkey, 13 AS query_hash FROM orders WHERE o_orderkey % 3 = 0 UNION SELECT o_orderkey, 10 + query_set_id FROM orders_owners"


def _tags(t):
    tags = t("orders").where("o_orderkey % 3 = 0").select("o_orderkey", F.lit(13).cast("long").alias("query_hash"))
    hashes = t("orders_owners").select("query_set_id").distinct().withColumn("query_hash", (F.col("query_set_id") + 10).cast("long"))
    o = t("orders_owners")
    return ownership.effective_tags(t("prices"), o.where("query_set_id = 1"), o.where("query_set_id = 2"), tags, hashes, "o_orderkey")


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS pk, CAST(query_hash AS BIGINT) AS query_hash FROM ({TAGS}) x WHERE o_orderkey IN (SELECT o_orderkey FROM orders_base)")
def effective_tags(t):
    return _tags(t).select("pk", F.explode("qtags").alias("query_hash"))


@query(f"SELECT o_orderkey, CAST(query_hash AS BIGINT) AS query_hash FROM ({TAGS}) x WHERE o_orderkey IN (SELECT o_orderkey FROM orders_base) AND o_orderkey % 2 = 0")
def load_tags(t):
    return ownership.load_tags(t("prices").where("o_orderkey % 2 = 0"), _tags(t), "o_orderkey")


@query("SELECT txn, o_orderkey, kind FROM (SELECT *, coalesce(lag(after_) OVER (PARTITION BY o_orderkey ORDER BY txn, set_no), 0) AS before_, CASE WHEN after_ > 0 THEN 'insert' ELSE 'delete' END AS kind FROM (SELECT *, sum(gain) OVER (PARTITION BY o_orderkey ORDER BY txn, set_no) AS after_ FROM (SELECT *, owns - coalesce(lag(owns) OVER (PARTITION BY o_orderkey, query_set_id ORDER BY txn, set_no), 0) AS gain FROM (SELECT txn, set_no, query_set_id, o_orderkey, max(CASE WHEN op = 'insert' THEN 1 ELSE 0 END) AS owns FROM two_set_log GROUP BY ALL) a) b) c) d WHERE (before_ > 0) <> (after_ > 0)")
def owned_key_events(t):
    log = t("two_set_log").select(F.col("o_orderkey").alias("key"), "txn", "set_no", F.col("query_set_id").cast("long").alias("query_set_id"), "op", F.col("o_totalprice").cast("string").alias("row"))
    return _streamed(log, feeds.owned_key_events).where("kind <> 'update'").select("txn", F.col("key").alias("o_orderkey"), "kind")


def _owned_rows(t):
    return t("orders").where("o_totalprice >= 50000 or o_orderdate >= timestamp'1998-01-01'").select("o_orderkey", "o_totalprice")


@query(OWNED_EVENTS)
def streamed_owned_events(t):
    log = t("two_set_log").select(F.col("o_orderkey").alias("key"), "txn", "set_no", F.col("query_set_id").cast("long").alias("query_set_id"), "op", F.to_json(F.struct("o_orderkey", "o_totalprice")).alias("row"))
    sets = t("orders_owners").groupBy(F.col("o_orderkey").alias("key")).agg(F.collect_set("query_set_id").alias("sets"))
    initial = _owned_rows(t).select(F.col("o_orderkey").alias("key"), F.to_json(F.struct("o_orderkey", "o_totalprice")).alias("row")).join(sets, "key")
    out = _streamed(_by_txn(log, 3), lambda stream: feeds.owned_key_events(stream, initial))
    price = lambda c: F.from_json(c, "o_totalprice double")["o_totalprice"]
    return out.select("txn", F.col("query_set_id").cast("int").alias("query_set_id"), F.col("key").alias("o_orderkey"), "kind", price("old").alias("old_price"), price("new").alias("new_price"))


# overlay and queue


@query("SELECT o_orderkey FROM orders_log WHERE op = 'insert' AND o_orderkey NOT IN (SELECT o_orderkey FROM orders_owners)")
def retained_unowned(t):
    return overlay.retained_unowned(t("orders_log").where("op = 'insert'").select(*KEY), t("orders_owners"), KEY)


@query("SELECT o_orderkey, change_no, kind, true AS is_optimistic, CASE WHEN change_no = 1 THEN p * 2 ELSE b END AS old_price, new_price FROM (SELECT v.*, o.o_totalprice AS p, b.o_totalprice AS b FROM overlay v JOIN orders o USING (o_orderkey) LEFT JOIN orders_base b USING (o_orderkey)) x")
def overlay_events(t):
    out = overlay.overlay_events(t("prices"), _overlay(t).drop("old"), KEY)
    return out.select("o_orderkey", "change_no", "kind", "is_optimistic", F.col("old.o_totalprice").alias("old_price"), F.col("new.o_totalprice").alias("new_price"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 5 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 14 <> 0 OR o_orderkey % 3 = 0")
def visible_after_inserts(t):
    # rows that state lacks: of even ones a third is inserted and then updated, the others only updated
    row = lambda add: F.struct("o_orderkey", (F.col("o_totalprice") + add).alias("o_totalprice")).alias("new")
    o = t("orders")
    entry = lambda rows, seq, kind, add: rows.select("o_orderkey", F.lit(seq).alias("seq"), F.lit(0).alias("change_no"), F.lit(kind).alias("kind"), row(add))
    pending = entry(o.where("o_orderkey % 7 = 0 and (o_orderkey % 2 = 1 or o_orderkey % 3 = 0)"), 1, "insert", 0).unionByName(entry(o.where("o_orderkey % 2 = 0"), 2, "update", 5))
    return overlay.visible_state(t("prices"), pending, KEY)


@query("SELECT l_orderkey, l_linenumber FROM line_bag UNION ALL SELECT l_orderkey, l_linenumber FROM line_bag WHERE l_orderkey % 5 = 0")
def visible_bag(t):
    bag = t("line_bag")
    return overlay.visible_state(bag, bag.where("l_orderkey % 5 = 0").select(F.lit("insert").alias("kind"), F.struct("l_orderkey", "l_linenumber").alias("new")), None)


@query("SELECT l_orderkey, l_linenumber FROM line_bag WHERE l_orderkey % 5 <> 0")
def committed_only_bag(t):
    bag = t("line_bag").withColumn("request_id", F.when(F.col("l_orderkey") % 5 == 0, F.col("l_orderkey")))
    return overlay.committed_only(bag, t("line_bag").where("l_orderkey < 0"), bag.where("request_id is not null").select("request_id"))


@query("SELECT seq, o_orderkey FROM overlay WHERE kind = 'update' AND o_orderkey NOT IN (SELECT o_orderkey FROM orders_base)")
def overlay_inserts(t):
    fresh = t("overlay").join(t("orders_base").select(*KEY).withColumn("there", F.lit(True)), KEY, "left")
    kinds = F.when((F.col("kind") == "update") & F.col("there").isNull(), "insert").otherwise(F.col("kind"))
    return overlay.overlay_inserts(fresh.withColumn("kind", kinds)).select("seq", "o_orderkey")


@query("SELECT DISTINCT request_id FROM overlay")
def pending_request_ids(t):
    return overlay.pending_request_ids(t("overlay"))


@query("SELECT seq, change_no, kind FROM overlay WHERE o_orderkey = 22")
def entries_for_key(t):
    return overlay.entries_for_key(t("overlay"), o_orderkey=22).select("seq", "change_no", "kind")


LANDING = "SELECT o_orderkey, o_orderkey % 1000 AS request_id, CASE o_orderkey % 1000 % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END AS kind, o_orderkey % 1000 % 7 <> 0 AS subscribed, o_totalprice AS price FROM orders"


@query(f"SELECT request_id, CASE WHEN bool_or(NOT subscribed OR (kind <> 'insert' AND hidden) OR (kind = 'update' AND NOT present)) THEN 'undetectable' WHEN bool_and(CASE kind WHEN 'insert' THEN owned WHEN 'delete' THEN NOT present ELSE true END) THEN 'landed' ELSE 'not_landed' END AS outcome FROM (SELECT *, o_orderkey IN (SELECT o_orderkey FROM orders_base) AS present, o_orderkey IN (SELECT o_orderkey FROM orders_owners) AS owned, o_orderkey IN (SELECT o_orderkey FROM overlay) AS hidden FROM ({LANDING}) a) b GROUP BY request_id")
def mutation_landed(t):
    o = t("orders")
    c = o.sparkSession.sql(LANDING.replace("FROM orders", "FROM {o}"), o=o)
    c = c.select("request_id", "kind", "subscribed", "o_orderkey", F.struct("o_orderkey", F.col("price").alias("o_totalprice")).alias("new"))
    return overlay.mutation_landed(c, t("prices"), t("orders_owners"), t("overlay"), KEY)


@query(f"SELECT request_id, CASE WHEN bool_or(NOT subscribed OR (kind <> 'insert' AND (hidden OR confirmed)) OR (kind = 'update' AND NOT present)) THEN 'undetectable' WHEN bool_and(CASE kind WHEN 'insert' THEN owned WHEN 'delete' THEN NOT present ELSE true END) THEN 'landed' ELSE 'not_landed' END AS outcome FROM (SELECT *, o_orderkey IN (SELECT o_orderkey FROM orders_base) AS present, o_orderkey IN (SELECT o_orderkey FROM orders_owners) AS owned, o_orderkey IN (SELECT o_orderkey FROM overlay) AS hidden, o_orderkey % 5 = 0 AND request_id % 4 <> 0 AS confirmed FROM ({LANDING}) a) b GROUP BY request_id")
def mutation_landed_after_confirmations(t):
    o = t("orders")
    c = o.sparkSession.sql(LANDING.replace("FROM orders", "FROM {o}"), o=o)
    c = c.select("request_id", "kind", "subscribed", "o_orderkey", F.struct("o_orderkey", F.col("price").alias("o_totalprice")).alias("new"))
    log = c.where("o_orderkey % 5 = 0").select("request_id", *KEY)
    confirmed = overlay.confirmed_keys(log, c.where("request_id % 4 = 0").select("request_id"), KEY)
    return overlay.mutation_landed(c, t("prices"), t("orders_owners"), t("overlay"), KEY, confirmed=confirmed)


@query("SELECT o_custkey AS request_id, bool_and(o_orderkey % 4 <> 0) AS pure_insert FROM orders GROUP BY o_custkey")
def pure_insert(t):
    kind = F.when(F.col("o_orderkey") % 4 == 0, "update").otherwise("insert")
    m = t("orders").groupBy(F.col("o_custkey").alias("request_id")).agg(F.collect_list(F.struct(kind.alias("kind"))).alias("changes"))
    return overlay.pure_insert(m).select("request_id", "pure_insert")


@query("SELECT event_id FROM events WHERE value > 50 OR value IS NULL OR event_id % 5 = 0")
def veto(t):
    return overlay.veto(t("events"), F.when(F.col("event_id") % 5 != 0, F.col("value") > 50)).select("event_id")


@query("SELECT o_orderkey AS seq FROM orders WHERE o_custkey % 10 = 0")
def held_mutations(t):
    o = t("orders")
    ensure(o.sparkSession)
    m = o.select(F.col("o_orderkey").alias("seq"), F.array(F.col("o_custkey").cast("string")).alias("keys"))
    awaited = o.where("o_custkey % 10 = 0").select(F.col("o_custkey").cast("string").alias("key")).distinct()
    return overlay.held_mutations(m, awaited)


@query("SELECT event_id AS seq, (SELECT count(*) FROM events WHERE event_type = 'error') AS failed_count FROM events WHERE event_type = 'error' ORDER BY event_id DESC LIMIT 50")
def recent_failures(t):
    return overlay.recent_failures(t("events").select(F.col("event_id").alias("seq"), (F.col("event_type") != "error").alias("success")), 50).select("seq", "failed_count")


#: What is left in the queue, and this pass's results.
CLEARED = {"failures, queue empty": ("false", "event_id % 10 = 1"), "no failures, queue empty": ("false", "event_id % 10 = 1 AND event_type <> 'error'"), "no failures, queue left": ("true", "event_id % 10 = 1 AND event_type <> 'error'")}


@query(" UNION ALL ".join(f"SELECT '{n}' AS pass, event_id AS seq FROM (SELECT event_id, row_number() OVER (ORDER BY event_id DESC) AS r FROM events WHERE event_type = 'error' AND (event_id % 10 = 0 OR ({p}))) x WHERE r <= 20 AND ({q} OR (SELECT count(*) FROM events WHERE event_type = 'error' AND {p}) > 0)" for n, (q, p) in CLEARED.items()))
def cleared_failures(t):
    e = t("events").select("event_id", "event_type", F.col("event_id").alias("seq"), (F.col("event_type") != "error").alias("success"))
    earlier = e.where("event_id % 10 = 0 and not success")
    each = [overlay.recent_failures(e.where(p), 20, earlier, t("overlay").where(q)).select(F.lit(n).alias("pass"), "seq") for n, (q, p) in CLEARED.items()]
    return reduce(DataFrame.unionByName, each)


@query("SELECT event_id FROM events WHERE event_id % 4 = 0 OR event_id % 4 = 3 OR (event_id % 4 = 2 AND value > 50)")
def veto_that_fails(t):
    # divides by zero, casts text to a number, or compares
    e = t("events").where("value is not null")
    fails = F.when(F.col("event_id") % 4 == 0, F.lit(1) / (F.col("event_id") % 4) > 0).when(F.col("event_id") % 4 == 3, F.col("event_type").cast("int") > 1)
    return overlay.veto(e, fails.when(F.col("event_id") % 4 == 2, F.col("value") > 50).otherwise(F.lit(False))).select("event_id").unionByName(t("events").where("value is null and event_id % 4 in (0, 3)").select("event_id"))


#: Filters of the queue, of what is in flight, and of the pass's results; failures before it; connection.
PASSES = {"failures, queue left": ("true", "false", "true", 4, True), "no failures, queue empty": ("false", "false", "event_type <> 'error'", 4, True), "no failures, queue left": ("true", "false", "event_type <> 'error'", 4, False), "failures, queue empty": ("false", "false", "true", 4, True), "in flight": ("true", "o_orderkey % 22 = 0", "event_type <> 'error'", 0, True)}


@query(" UNION ALL ".join(f"SELECT '{n}' AS pass, CASE WHEN (SELECT count(*) FROM overlay WHERE {q} AND {f}) > 0 THEN 'syncing' WHEN (SELECT count(*) FROM overlay WHERE {q}) > 0 AND {c} THEN 'waiting' ELSE 'idle' END AS status, (SELECT count(*) FROM overlay WHERE {q}) AS pending_count, CASE WHEN count_if(event_type = 'error') > 0 THEN {k} + count_if(event_type = 'error') WHEN (SELECT count(*) FROM overlay WHERE {q}) = 0 THEN 0 ELSE {k} END AS failed_count, max(ts) AS last_sync_at FROM events WHERE {r}" for n, (q, f, r, k, c) in PASSES.items()))
def sync_state(t):
    def of(name, queued, flight, done, before, connected):
        queue = t("overlay").where(queued).withColumn("in_flight", F.expr(flight))
        results = t("events").where(done).select((F.col("event_type") != "error").alias("success"), F.col("ts").alias("finished_at"))
        return overlay.sync_state(queue, results, before, connected).select(F.lit(name).alias("pass"), "status", "pending_count", "failed_count", "last_sync_at")

    return reduce(DataFrame.unionByName, [of(n, *p) for n, p in PASSES.items()])


@query("SELECT event_id, CAST(CASE event_id % 8 WHEN 0 THEN 5 WHEN 1 THEN 10 WHEN 2 THEN 20 WHEN 3 THEN 40 ELSE 60 END AS BIGINT) AS delay_s, date_trunc('second', ts) + INTERVAL '1' SECOND * CASE event_id % 8 WHEN 0 THEN 5 WHEN 1 THEN 10 WHEN 2 THEN 20 WHEN 3 THEN 40 ELSE 60 END AS retry_at FROM events")
def next_retry_at(t):
    q = t("events").select("event_id", (F.col("event_id") % 8).alias("attempt"), F.date_trunc("second", "ts").alias("last_attempt_at"))
    return overlay.next_retry_at(q).select("event_id", "delay_s", "retry_at")


@query("SELECT count(*) AS n, count(*) AS ids, true AS negative FROM events")
def temp_ids(t):
    return overlay.temp_ids(t("events"), "id").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), (F.max("id") < 0).alias("negative"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' WHEN 2 THEN 'delete' END AS kind, o_orderkey % 4 IN (0, 1) AND (o_orderkey % 4 = 0 OR o_orderkey % 8 = 1) AS valid FROM orders")
def parse_changes(t):
    kind = F.when(F.col("o_orderkey") % 4 == 0, "insert").when(F.col("o_orderkey") % 4 == 1, "update").when(F.col("o_orderkey") % 4 == 2, "delete")
    row = F.struct("o_orderkey")
    json = F.to_json(F.struct(kind.alias("type"), F.when(F.col("o_orderkey") % 8 == 1, row).alias("oldRowJson"), row.alias("newRowJson")))
    json = F.when(F.col("o_orderkey") % 4 == 3, "{torn").otherwise(json)
    return overlay.parse_changes(t("orders").select("o_orderkey", json.alias("json")), "struct<o_orderkey:bigint>").select("o_orderkey", "kind", "valid")


@query(f"SELECT count(*) AS n, count(DISTINCT o_orderkey) AS keys FROM ({VISIBLE}) v")
def visible_counts(t):
    return overlay.visible_state(t("prices"), _overlay(t), KEY).agg(F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("keys"))


# jobs and functions


@query("SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders")
def update_all(t):
    return jobs.update_all(t("orders").select("o_orderkey", "o_totalprice"), o_totalprice=F.col("o_totalprice") * 2)


@query("SELECT c_custkey, CASE WHEN r <= 10 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) AS r FROM customer) x WHERE r NOT BETWEEN 11 AND 15 UNION ALL SELECT (SELECT max(c_custkey) FROM customer) + s_suppkey, 0.0::DOUBLE FROM supplier")
def mixed_batch(t):
    new = t("supplier").select(F.col("s_suppkey").alias("place"), F.lit(0.0).alias("c_acctbal"))
    return jobs.mixed_batch(t("customer").select("c_custkey", "c_acctbal"), "c_custkey", 10, 5, new, c_acctbal=F.col("c_acctbal") + 1)


@query("WITH RECURSIVE g(k, x) AS (SELECT 1, (42::HUGEINT * 6364136223846793005 + 1442695040888963407) % 18446744073709551616 UNION ALL SELECT k + 1, (x * 6364136223846793005 + 1442695040888963407) % 18446744073709551616 FROM g WHERE k < (SELECT count(*) FROM customer)), h AS (SELECT CAST((x // 8589934592) % (SELECT count(*) FROM customer) AS BIGINT) AS place, count(*) AS hits FROM g GROUP BY 1) SELECT c_custkey AS id, CAST(coalesce(hits, 0) AS INTEGER) AS health FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS place FROM customer) c LEFT JOIN h USING (place)")
def random_mutations(t):
    c = t("customer").select(F.col("c_custkey").alias("id"), F.lit(0).alias("health"))
    ensure(c.sparkSession)
    return jobs.random_mutations(c, c.count(), 42, "id", ["health"])


@query("SELECT c_custkey, " + " || ".join(f"substr(h, {31 - 2 * i}, 2)" for i in range(16)) + " AS little_endian, h AS parsed FROM (SELECT c_custkey, md5(c_name) AS h FROM customer) x")
def connection_ids(t):
    h = F.md5("c_name")
    return t("customer").select("c_custkey", scalars.reverse_bytes(h).alias("little_endian"), scalars.parse_connection_id(F.concat(F.lit("0x"), F.upper(h))).alias("parsed"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'interval' WHEN 1 THEN 'time' END AS type, CASE WHEN event_id % 3 < 2 THEN event_id * 1000 END AS micros, event_id % 3 = 1 AS is_time FROM events")
def schedule_at(t):
    json = F.format_string('{"type":"%s","value":%d}', F.element_at(F.array(*map(F.lit, ("interval", "time", "never"))), (F.col("event_id") % 3 + 1).cast("int")), F.col("event_id") * 1000)
    e = t("events").select("event_id", json.alias("json")).withColumn("at", scalars.schedule_at(F.col("json")))
    return e.select("event_id", F.col("at.type").alias("type"), F.col("at.micros").alias("micros"), scalars.is_variant(F.col("json"), "time").alias("is_time"))


@query("SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS uuid_text, " + " || ".join(f"substr(h, {31 - 2 * i}, 2)" for i in range(16)) + " AS little_endian, CASE WHEN c_custkey % 2 = 0 THEN h || h END AS parsed_identity FROM (SELECT c_custkey, md5(c_name) AS h FROM customer) x")
def uuid_bytes(t):
    h = F.md5("c_name")
    raw = F.unhex(scalars.reverse_bytes(h))
    rows = t("customer").select("c_custkey", scalars.uuid_from_little_endian(raw).alias("uuid_text"), F.concat(F.lit("0x"), F.upper(h), F.when(F.col("c_custkey") % 2 == 0, h).otherwise(F.lit("zz"))).alias("i"))
    return rows.select("c_custkey", "uuid_text", F.lower(F.hex(scalars.uuid_to_little_endian(F.col("uuid_text")))).alias("little_endian"), scalars.parse_identity(F.col("i")).alias("parsed_identity"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Draft' WHEN 1 THEN 'Published' WHEN 2 THEN 'Archived' END AS type, CASE WHEN event_id % 4 < 3 THEN event_id % 4 END AS tag, CASE WHEN event_id % 4 = 1 THEN CAST(event_id AS VARCHAR) END AS value FROM events")
def tagged_union(t):
    names = ["Draft", "Published", "Archived"]
    tag = F.col("event_id") % 4
    json = scalars.variant(tag, F.when(tag == 1, F.col("event_id").cast("string")), names)
    e = t("events").select("event_id", json.alias("json")).withColumn("v", scalars.variant_of(F.col("json"), names))
    return e.select("event_id", F.get_json_object("json", "$.type").alias("type"), F.col("v.tag").alias("tag"), F.col("v.value").alias("value"))


@query("SELECT event_id, event_id * 1000003 AS micros, make_timestamp(1000000 + event_id * 1000003) AS shifted, 'interval' AS type FROM events")
def intervals(t):
    micros = F.col("event_id") * 1000003
    at = F.timestamp_micros(F.lit(1000000)) + scalars.micros_to_interval(micros)
    back = scalars.schedule_at(scalars.schedule_to_json(F.struct(F.lit("interval").alias("type"), micros.alias("micros"))))
    e = t("events").select("event_id", at.alias("shifted"), back.alias("s"))
    return e.select("event_id", F.col("s.micros").alias("micros"), "shifted", F.col("s.type").alias("type"))


@query("SELECT event_id, make_timestamp(event_id * 1000000 + 5) AS at, CASE WHEN event_id % 2 = 0 THEN user_id END AS maybe, CASE WHEN event_id % 2 = 0 THEN 2 ELSE 0 END AS n_labels FROM events")
def wire_values(t):
    labels = F.when(F.col("event_id") % 2 == 0, F.array(F.col("event_type"), F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>"))
    row = F.to_json(F.struct("event_id", F.when(F.col("event_id") % 2 == 0, F.col("user_id")).alias("maybe"), labels.alias("labels")))
    back = F.from_json(row, "event_id bigint, maybe bigint, labels array<string>")
    e = t("events").select(back.alias("r"))
    return e.select("r.event_id", F.timestamp_micros(F.col("r.event_id") * 1000000 + 5).alias("at"), "r.maybe", F.size("r.labels").alias("n_labels"))


# streams: each reads its input in micro-batches until there is none left, and the query returns what the sink holds


#: Rows of a micro-batch for each task with a part of a stream's state: to open and commit its state takes a task about a second.
STATE_ROWS = 250_000


def _state_tasks(rows: int, cores: int, most: int) -> int:
    """Tasks with state for micro-batches of so many rows: whole rounds of all cores, and no more than most."""
    return min(most, cores * max(1, -(-rows // (STATE_ROWS * cores))))


@contextmanager
def _keyed_state(spark: SparkSession, rows: int):
    """Streams that start here keep their state in RocksDB, and have as many tasks with state as micro-batches of so many rows need."""
    tasks, provider = "spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass"
    before = {name: spark.conf.get(name) for name in (tasks, provider)}
    spark.conf.set(tasks, _state_tasks(rows, spark.sparkContext.defaultParallelism, int(before[tasks])))
    spark.conf.set(provider, feeds.ROCKS)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _batches(spark: SparkSession, parts: list[DataFrame], start, keyed: bool = False) -> None:
    """Each part written to the shared folder, by all tasks, and then streamed as the next micro-batch of one stream.

    keyed: the stream has state by key; its tasks are dealt by the first part's rows, as a checkpoint keeps their number.
    """
    source, progress = (_folder(spark, name) for name in ("source", "progress"))
    first = None
    for rows in parts:
        rows.write.mode("append").parquet(source)
        if keyed and first is None:
            first = spark.read.schema(rows.schema).parquet(source).count()
        writer = start(feeds.read_change_stream(spark, source, rows.schema)).option("checkpointLocation", progress).trigger(availableNow=True)
        with _keyed_state(spark, first) if keyed else nullcontext():
            running = writer.start()
        running.awaitTermination()


def _by_txn(rows: DataFrame, parts: int) -> list[DataFrame]:
    """rows in parts that follow each other by txn."""
    spark, whole = rows.sparkSession, _folder(rows.sparkSession, "whole")
    rows.write.parquet(whole)
    rows = spark.read.schema(rows.schema).parquet(whole)
    return [rows.where(F.expr(f"cast(txn * {parts} / 150 as int) = {k}")) for k in range(parts)]


def _streamed(parts: DataFrame | list[DataFrame], through) -> DataFrame:
    """Rows written to the shared folder, streamed through an operator into files, and read back; each part is a micro-batch."""
    parts = parts if isinstance(parts, list) else [parts]
    spark = parts[0].sparkSession
    sink, shape = _folder(spark, "sink"), []

    def start(stream: DataFrame):
        out = through(stream)
        shape.append(out.schema)
        return out.writeStream.format("parquet").option("path", sink)

    _batches(spark, parts, start, keyed=True)
    return spark.read.schema(shape[0]).parquet(sink)


@query(UNTIL_CHANGED)
def streamed_distinct_until_changed(t):
    h = t("history")
    rows = h.select(F.col("user_id").alias("key"), "seq", "value")
    middle = h.agg(F.max("seq")).first()[0] // 2
    return _streamed([rows.where(F.col("seq") <= middle), rows.where(F.col("seq") > middle)], feeds.distinct_until_changed).select(F.col("key").alias("user_id"), "seq", "value")


@query("SELECT event_id, user_id, event_type, 'insert' AS kind FROM events")
def event_table_append(t):
    return _streamed(t("events").select("event_id", "user_id", "event_type"), feeds.event_table_append)


@query("SELECT user_id, event_id AS txn, CASE WHEN p IS NULL THEN 'insert' WHEN n IS NULL THEN 'delete' ELSE 'update' END AS kind, p AS old, n AS new FROM (SELECT *, lag(n) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM (SELECT user_id, event_id, CASE WHEN event_type <> 'error' THEN event_type END AS n FROM events) a) b WHERE n IS DISTINCT FROM p")
def keyed_events(t):
    log = t("user_log").select(F.col("user_id").alias("key"), F.col("seq").alias("txn"), "op", F.col("event_type").alias("row"))
    return _streamed(log, feeds.keyed_events).withColumnRenamed("key", "user_id")


def streamed_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's held row after a stream of three batches; what is held replaces what was."""
    log = fixture(spark, sf_dir, "user_log").withColumnRenamed("seq", "txn")
    sink = _folder(spark, "held")
    edge = log.agg(F.max("txn")).first()[0] // 3
    parts = [log.where((F.col("txn") > k * edge) & ((F.col("txn") <= (k + 1) * edge) | F.lit(k == 2)) | F.lit(k == 0) & (F.col("txn") <= 0)) for k in range(3)]
    put = lambda held, _: held.write.mode("overwrite").parquet(sink)
    _batches(spark, parts, lambda stream: feeds.latest(stream, ["user_id"]).writeStream.outputMode("complete").foreachBatch(put))
    return spark.read.parquet(sink).select("row.*").where("op <> 'delete'").select("user_id", F.col("txn").alias("seq"), "event_type")


def changes_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fixture(spark, sf_dir, "user_log").select("seq", "user_id", F.col("op").alias("kind"))
    source, sink = _folder(spark, "source"), _folder(spark, "changes")
    log.write.parquet(source)
    feeds.changes_sink(feeds.read_change_stream(spark, source, log.schema), sink, _folder(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(sink).select("seq", "user_id", "kind")


def coalesced_snapshot_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables by event_type, keys by user: applied in batches, then whole snapshots of dirty tables, once for a window.

    views are events; clicks are written directly after all changes, so that no flush of them is due.
    """
    rows = fixture(spark, sf_dir, "events").select(F.col("event_id").alias("txn"), F.col("event_type").alias("table_name"), "user_id", "value", F.when(F.col("event_id") % 5 == 0, "delete").otherwise("insert").alias("op"))
    path, marks, out = (_folder(spark, n) for n in ("tables", "marks", "snapshots"))
    parts = [rows.where(F.col("txn") % 3 == k).withColumn("txn", F.col("txn") + k * 10**9) for k in range(3)]
    key, none = ["table_name", "user_id"], rows.select("table_name", "user_id", "value").where("false")
    _batches(spark, parts, lambda stream: feeds.ordered_apply(stream, path, key, none, marks, buckets=8))
    held = feeds.held_rows(spark, path, key, none.schema, buckets=8)
    feeds.write_now(held, "click", out, marks)
    due = {r[0] for r in rows.select("table_name").distinct().collect()} - {"view", "click"}
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", feeds.ROCKS)
    try:
        stream = spark.readStream.schema("table_name string, version long, mark string").option("recursiveFileLookup", "true").parquet(marks)
        running = feeds.coalesced_snapshot_sink(stream, held, out, every_ms=500, event_tables=("view",)).option("checkpointLocation", _folder(spark, "progress")).trigger(processingTime="500 milliseconds").start()
        try:
            until = time.monotonic() + 120
            while due - {t for _, ts in feeds.written_snapshots(spark, out)[1:] for t in ts} and time.monotonic() < until:
                running.awaitTermination(1)
        finally:
            running.stop()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    each = [spark.read.schema("user_id bigint, value double, table_name string").parquet(folder).withColumn("write", F.lit(folder)) for folder, _ in feeds.written_snapshots(spark, out)]
    every = reduce(DataFrame.unionByName, each)
    return every.groupBy("table_name").agg(F.count("*").alias("n"), F.count_distinct("write").alias("writes"), F.sum("user_id").alias("users"))


def ordered_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, out = fixture(spark, sf_dir, "orders_log"), _folder(spark, "ordered")
    base = fixture(spark, sf_dir, "orders_base").select(*changes.row_columns(log))
    _batches(spark, _by_txn(log, 10), lambda stream: feeds.ordered_apply(stream, out, KEY, base, buckets=8))
    return feeds.ordered_state(spark, out, KEY, base).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def owned_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, owners, out = fixture(spark, sf_dir, "two_set_log"), fixture(spark, sf_dir, "orders_owners"), _folder(spark, "owned")
    state = _owned_rows(lambda name: fixture(spark, sf_dir, name))
    _batches(spark, _by_txn(log, 6), lambda stream: feeds.owned_feed(stream, out, KEY, state, owners, buckets=8))
    return flat(spark.read.parquet(f"{out}/events"), "txn", "query_set_id", *KEY)


def streamed_state_then_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's value up to the middle, then the changes; the stream begins before the middle and goes on after it."""
    log = fixture(spark, sf_dir, "user_log").select(F.col("user_id").alias("key"), F.col("seq").alias("txn"), "op", F.col("event_type").alias("row"))
    middle = log.agg(F.max("txn")).first()[0] // 2
    now = log.where(F.col("txn") <= middle).groupBy("key").agg(F.max_by(F.struct("op", "row"), "txn").alias("last")).where("last.op = 'insert'").select("key", "last.row")
    out = _folder(spark, "told")
    parts = [F.col("txn") <= middle // 2, (F.col("txn") > middle // 2) & (F.col("txn") <= middle + 5), F.col("txn") > middle + 5]
    _batches(spark, [log.where(part) for part in parts[1:]], lambda stream: feeds.state_then_changes(stream, now, middle, out), keyed=True)
    return spark.read.parquet(out).select(F.col("key").alias("user_id"), "txn", "kind", "old", "new")


def late_listener(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listener that starts after three of six batches, and is started again after each later one."""
    rows = fixture(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    path, sink, progress = (_folder(spark, n) for n in ("told", "heard", "progress"))
    for k in range(6):
        rows.where(F.col("event_id") % 6 == k).write.parquet(f"{path}/batch={k}")
        if k >= 2:
            heard = feeds.late_listener(spark, path, rows.schema, progress)
            heard.writeStream.format("parquet").option("path", sink).option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(heard.schema).parquet(sink).select("event_id", "user_id", "event_type")


def timed_out_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed; a late row on each side moves the watermark past all others, whose answers are then final."""
    calls, results = (fixture(spark, sf_dir, n) for n in ("calls", "results"))
    end = lambda df: df.limit(1).select(*(F.lit("2100-01-01").cast("timestamp").alias(c) if c.endswith("_ts") else F.lit(-1 - (df is results)).cast(df.schema[c].dataType).alias(c) for c in df.columns))
    paths = [_folder(spark, "calls"), _folder(spark, "results")]
    for df, path in zip((calls, results), paths, strict=True):
        df.unionByName(end(df)).write.parquet(path)
    c, r = (feeds.read_change_stream(spark, p, df.schema) for p, df in zip(paths, (calls, results), strict=True))
    sink = _folder(spark, "unanswered")
    feeds.timed_out_calls(c, r).writeStream.format("parquet").option("path", sink).option("checkpointLocation", _folder(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(sink).select("request_id", F.col("call_ts").cast(calls.schema["call_ts"].dataType).alias("call_ts"), "name")


def streamed_late_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = (fixture(spark, sf_dir, n) for n in ("calls", "results"))
    twice = results.unionByName(results.withColumn("result_ts", F.col("result_ts") + F.expr("interval 1 second")))
    waiting = events.call_timeouts(calls, results)
    return _streamed(twice, lambda stream: feeds.late_snapshots(stream, waiting).select("request_id"))


def sync_results_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, sf_dir, "events").select(F.col("event_id").alias("request_id"), (F.col("event_type") != "error").alias("success"))
    source, sink = _folder(spark, "source"), _folder(spark, "results")
    rows.write.parquet(source)
    feeds.sync_results_sink(feeds.read_change_stream(spark, source, rows.schema), sink, _folder(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(sink).select("request_id", "success")


QUERIES |= {f.__name__: f for f in (changes_sink, coalesced_snapshot_sink, late_listener, ordered_apply, owned_feed, streamed_latest_state, streamed_state_then_changes, timed_out_calls, streamed_late_snapshots, sync_results_sink)}
ORACLE_SQL |= {
    "changes_sink": oracle("SELECT seq, user_id, op AS kind FROM user_log"),
    "coalesced_snapshot_sink": "SELECT table_name, count(*) AS n, CAST(1 AS BIGINT) AS writes, CAST(sum(user_id) AS BIGINT) AS users FROM (SELECT event_type AS table_name, user_id, arg_max(event_id % 5 <> 0, (event_id % 3) * 1000000000 + event_id) AS there FROM events WHERE event_type <> 'view' GROUP BY event_type, user_id) x WHERE there GROUP BY table_name",
    "streamed_latest_state": oracle("SELECT user_id, seq, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS r FROM user_log) x WHERE r = 1 AND op <> 'delete'"),
    "late_listener": "SELECT event_id, user_id, event_type FROM events WHERE event_id % 6 >= 3",
    "streamed_state_then_changes": "WITH v AS (SELECT user_id, event_id AS txn, CASE WHEN event_type <> 'error' THEN event_type END AS n, (SELECT max(event_id) // 2 FROM events) AS m FROM events), e AS (SELECT *, lag(n) OVER (PARTITION BY user_id ORDER BY txn) AS p FROM v) SELECT user_id, txn, CASE WHEN p IS NULL THEN 'insert' WHEN n IS NULL THEN 'delete' ELSE 'update' END AS kind, p AS old, n AS new FROM e WHERE txn > m AND n IS DISTINCT FROM p UNION ALL SELECT user_id, any_value(m), 'state', NULL, arg_max(n, txn) FROM (SELECT user_id, txn, m, coalesce(n, '-') AS n FROM v WHERE txn <= m) y GROUP BY user_id HAVING arg_max(n, txn) <> '-'",
    "ordered_apply": ORACLE_SQL["apply_changes"],
    "owned_feed": ORACLE_SQL["apply_owned_delta"],
    "timed_out_calls": ORACLE_SQL["call_timeouts"],
    "streamed_late_snapshots": oracle("SELECT request_id FROM results JOIN calls USING (request_id) WHERE request_id % 20 > 10"),
    "sync_results_sink": "SELECT event_id AS request_id, event_type <> 'error' AS success FROM events",
}
