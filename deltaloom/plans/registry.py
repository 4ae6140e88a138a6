"""Registered queries of the change-data operators, each with equivalent SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaloom.functions import scalars
from deltaloom.operators import changes, events, jobs, overlay, ownership, views
from deltaloom.sources import tables

from .fixtures import fixture, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
KEY = ["o_orderkey"]


def query(sql: str | None = None):
    """Register a function of a fixture getter under its name."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: fixture(spark, sf_dir, name))
        if sql:
            ORACLE_SQL[f.__name__] = oracle(sql)
        return f

    return add


def flat(df: DataFrame, *keep: str) -> DataFrame:
    """Events with the price of the old and new row."""
    return df.select(*keep, "kind", F.col("old.o_totalprice").alias("old_price"), F.col("new.o_totalprice").alias("new_price"))


# change application

COALESCED = "SELECT txn, o_orderkey, CASE WHEN d AND i THEN 'update' WHEN i THEN 'insert' ELSE 'delete' END AS kind, old_price, new_price FROM (SELECT txn, o_orderkey, bool_or(op = 'delete') AS d, bool_or(op = 'insert') AS i, arg_max(o_totalprice, grp) FILTER (WHERE op = 'delete') AS old_price, arg_max(o_totalprice, grp) FILTER (WHERE op = 'insert') AS new_price FROM orders_log GROUP BY txn, o_orderkey) x"
DELTA = "(SELECT o_orderkey, bool_or(op = 'delete') AS d, bool_or(op = 'insert') AS i, arg_max(o_totalprice, txn * 10 + grp) FILTER (WHERE op = 'delete') AS d_price, arg_max(o_totalprice, txn * 10 + grp) FILTER (WHERE op = 'insert') AS i_price, arg_max(o_orderstatus, txn * 10 + grp) FILTER (WHERE op = 'insert') AS i_status FROM orders_log GROUP BY o_orderkey)"
FINAL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders_base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_log) UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY txn DESC, CASE op WHEN 'insert' THEN 1 ELSE 0 END DESC, grp DESC) AS r FROM orders_log) l WHERE r = 1 AND op = 'insert'"
SLIM = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query(COALESCED)
def coalesce_changes(t):
    return flat(changes.coalesce_changes(t("orders_log"), KEY), "txn", *KEY)


@query(f"SELECT o_orderkey, kind, CASE WHEN kind <> 'insert' THEN b.o_totalprice END AS old_price, CASE WHEN kind <> 'delete' THEN i_price END AS new_price FROM (SELECT l.*, CASE WHEN i AND b.o_orderkey IS NULL THEN 'insert' WHEN i AND (b.o_totalprice <> i_price OR b.o_orderstatus <> i_status) THEN 'update' WHEN i THEN NULL WHEN b.o_orderkey IS NOT NULL THEN 'delete' END AS kind FROM {DELTA} l LEFT JOIN orders_base b USING (o_orderkey)) x LEFT JOIN orders_base b USING (o_orderkey) WHERE kind IS NOT NULL")
def classify_reconcile(t):
    return flat(changes.classify_against_state(t("orders_base"), t("orders_log"), KEY), *KEY)


@query(f"SELECT o_orderkey, kind, old_price, new_price FROM (SELECT o_orderkey, CASE WHEN d AND b.o_orderkey IS NOT NULL THEN 'update' ELSE 'insert' END AS kind, CASE WHEN d THEN b.o_totalprice END AS old_price, i_price AS new_price FROM {DELTA} l LEFT JOIN orders_base b USING (o_orderkey) WHERE i UNION ALL SELECT o_orderkey, 'delete', coalesce(b.o_totalprice, d_price), NULL FROM {DELTA} l LEFT JOIN orders_base b USING (o_orderkey) WHERE d AND NOT (i AND b.o_orderkey IS NOT NULL)) x")
def classify_strict(t):
    return flat(changes.classify_against_state(t("orders_base"), t("orders_log"), KEY, "strict"), *KEY)


@query(FINAL)
def apply_changes(t):
    return changes.apply_changes(t("orders_base"), t("orders_log"), KEY).select(*SLIM)


BAG_AFTER = "SELECT l_orderkey, l_linenumber, CAST(sum(n) AS BIGINT) AS n FROM (SELECT l_orderkey, l_linenumber, 1 AS n FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber) AS r FROM line_bag) x WHERE NOT (l_orderkey % 3 = 0 AND r = 1) UNION ALL SELECT l_orderkey, l_linenumber, 1 FROM line_bag WHERE l_orderkey % 10 = 0) y GROUP BY l_orderkey, l_linenumber"


@query(BAG_AFTER)
def apply_changes_bag(t):
    return changes.apply_changes_bag(t("line_bag"), t("line_bag_log")).groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))


#: A few distinct rows, each in nearly every transaction.
HOT_BAG = "SELECT l_orderkey AS txn, CASE WHEN l_orderkey % 3 = 0 THEN 'delete' ELSE 'insert' END AS op, l_linenumber % 2 AS v FROM lineitem"


@query(f"SELECT v, CAST(total - least(0, low) AS BIGINT) AS n FROM (SELECT v, sum(i - d) AS total, min(after_ - i) AS low FROM (SELECT *, sum(i - d) OVER (PARTITION BY v ORDER BY txn) AS after_ FROM (SELECT txn, v, count(*) FILTER (op = 'insert') AS i, count(*) FILTER (op = 'delete') AS d FROM ({HOT_BAG}) a GROUP BY txn, v) b) c GROUP BY v) e WHERE total - least(0, low) > 0")
def apply_changes_bag_hot(t):
    """Two distinct rows with a change in nearly every transaction, scanned in blocks."""
    log = t("lineitem").sparkSession.sql(HOT_BAG.replace("FROM lineitem", "FROM {l}"), l=t("lineitem"))
    return changes.apply_changes_bag(log.select("v").where("false"), log, blocked=True).groupBy("v").agg(F.count("*").alias("n"))


@query("SELECT txn, op, count(*) AS n FROM (SELECT DISTINCT txn, op, l_orderkey, l_linenumber FROM line_bag_log) x GROUP BY txn, op")
def merge_row_groups(t):
    log = t("line_bag_log").withColumns({"query_set_id": F.lit(1), "grp": F.pmod("l_linenumber", F.lit(2)).cast("int")})
    return changes.merge_row_groups(log).groupBy("txn", "op").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT txn, o_orderkey FROM orders_log WHERE o_orderkey NOT IN (SELECT o_orderkey FROM overlay)")
def touched_keys(t):
    return changes.touched_keys(t("orders_log"), KEY, overlay.protected_keys(t("overlay"), KEY))


@query("SELECT DISTINCT o_orderkey FROM orders_log WHERE op = 'insert' AND o_orderkey NOT IN (SELECT o_orderkey FROM orders_base)")
def fresh_keys(t):
    return changes.fresh_keys(t("orders_base"), t("orders_log"), KEY)


@query("SELECT DISTINCT o_orderkey FROM orders_log WHERE op = 'insert'")
def inserted_keys(t):
    return changes.inserted_keys(t("orders_log"), KEY)


@query("SELECT o_orderkey FROM orders_log GROUP BY o_orderkey HAVING bool_and(op = 'delete')")
def removed_keys(t):
    return changes.removed_keys(t("orders_log"), KEY)


@query("SELECT txn, o_orderkey, 'present' AS side FROM orders_log WHERE op = 'insert' GROUP BY txn, o_orderkey UNION ALL SELECT txn, o_orderkey, 'absent' FROM orders_log GROUP BY txn, o_orderkey HAVING bool_and(op = 'delete')")
def present_absent_keys(t):
    log = t("orders_log")
    return changes.present_keys(log, KEY).withColumn("side", F.lit("present")).unionByName(changes.absent_keys(log, KEY).withColumn("side", F.lit("absent")))


@query(f"SELECT o_orderkey, i_price AS committed_price FROM {DELTA} x WHERE o_orderkey IN (SELECT o_orderkey FROM overlay)")
def split_protected(t):
    return changes.split_protected(t("orders_log"), overlay.protected_keys(t("overlay"), KEY), KEY)[1].select(*KEY, F.col("committed.o_totalprice").alias("committed_price"))


@query(f"SELECT txn, CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS table_name, count_if(kind = 'insert') AS inserts, count_if(kind = 'delete') AS deletes, count_if(kind = 'update') AS updates, string_agg(substr(kind, 1, 1), '' ORDER BY CASE kind WHEN 'insert' THEN 0 WHEN 'delete' THEN 1 ELSE 2 END) AS kinds FROM ({COALESCED}) y GROUP BY ALL")
def transaction_batches(t):
    c = changes.coalesce_changes(t("orders_log"), KEY).withColumn("table_name", F.when(F.col("o_orderkey") % 2 == 0, "even").otherwise("odd"))
    told = changes.deliver_events(c)
    batches = changes.transaction_batches(told).alias("b")
    # the letters of a batch's events in order; these batches are small
    own = told.alias("e").join(batches, F.col("e.at").between(F.col("b.first_at"), F.col("b.last_at")) & (F.col("e.txn") == F.col("b.txn")))
    letters = own.groupBy("b.txn", "b.table_name").agg(F.array_sort(F.collect_list(F.struct("e.at", F.substring("e.kind", 1, 1).alias("k")))).alias("l"))
    return batches.join(letters, ["txn", "table_name"]).select("txn", "table_name", "inserts", "deletes", "updates", F.array_join(F.transform("l", lambda x: x["k"]), "").alias("kinds"))


@query(f"SELECT txn, table_name, kind, o_orderkey, CAST(row_number() OVER (PARTITION BY txn, table_name ORDER BY CASE kind WHEN 'insert' THEN 0 WHEN 'delete' THEN 1 ELSE 2 END, o_orderkey) - 1 AS BIGINT) AS n FROM (SELECT txn // 50 AS txn, kind, o_orderkey, 'orders' AS table_name FROM ({COALESCED}) y QUALIFY row_number() OVER (PARTITION BY txn // 50, o_orderkey, kind ORDER BY txn) = 1) z")
def delivered_events(t):
    """Whole batches of thousands of events, each event at its place after its batch's first one."""
    c = changes.coalesce_changes(t("orders_log"), KEY).withColumns({"txn": F.floor(F.col("txn") / 50), "table_name": F.lit("orders")}).dropDuplicates(["txn", "kind", *KEY])
    told = changes.deliver_events(c)
    places = jobs.numbered(told.drop("old", "new"), ["at"], "place_no")
    first = changes.transaction_batches(places).select("txn", "table_name", "first_at").alias("b")
    at = places.join(first, ["txn", "table_name"])
    start = at.where("at = first_at").select("txn", "table_name", F.col("place_no").alias("start"))
    return at.join(start, ["txn", "table_name"]).select("txn", "table_name", "kind", *KEY, (F.col("place_no") - F.col("start")).alias("n"))


for _kind in ("insert", "update", "delete"):

    def _of_kind(t, kind=_kind):
        return flat(changes.of_kind(changes.coalesce_changes(t("orders_log"), KEY), kind), "txn", *KEY)

    _of_kind.__name__ = f"{_kind}s_of_changes"
    query(f"SELECT * FROM ({COALESCED}) y WHERE kind = '{_kind}'")(_of_kind)


@query(f"SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'insert' WHEN b.o_orderkey IS NULL THEN 'delete' ELSE 'update' END AS kind, a.o_totalprice AS old_price, b.o_totalprice AS new_price FROM orders_base a FULL JOIN ({FINAL}) b USING (o_orderkey) WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_totalprice <> b.o_totalprice OR a.o_orderstatus <> b.o_orderstatus")
def snapshot_diff(t):
    base = t("orders_base").select(*SLIM)
    return flat(changes.snapshot_diff(base, changes.apply_changes(t("orders_base"), t("orders_log"), KEY).select(*SLIM), KEY), *KEY)


@query("SELECT o_orderkey, o_totalprice FROM orders_base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM overlay)")
def apply_deletes(t):
    return changes.apply_deletes(t("orders_base"), t("overlay"), KEY).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders_base WHERE o_orderkey % 5 <> 0 UNION ALL SELECT o_orderkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 5 = 0")
def upsert_rows(t):
    rows = t("orders").where("o_orderkey % 5 = 0").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return changes.upsert_rows(t("prices"), rows, KEY)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders_base")
def update_rows(t):
    rows = t("orders").where("o_orderkey % 5 = 0").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return changes.update_rows(t("prices"), rows, KEY)


# queries and views


@query("SELECT * FROM customer")
def select_all(t):
    return t("customer")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 1000 AND o_totalprice <= 50000 AND o_orderstatus = 'F'")
def where_range_and(t):
    return t("orders").where("o_totalprice >= 1000 and o_totalprice <= 50000 and o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'c%_d%t'")
def where_like(t):
    return t("part").where(F.col("p_name").like("c%_d%t")).select("p_partkey", "p_name")


@query("SELECT c.c_custkey, c.c_name FROM nation n JOIN customer c ON n.n_nationkey = c.c_nationkey WHERE n.n_regionkey = 1")
def join_project(t):
    c = t("customer")
    return c.join(t("nation").where("n_regionkey = 1"), F.col("c_nationkey") == F.col("n_nationkey")).select(c["c_custkey"], c["c_name"])


@query("SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_totalprice >= 50000 OR o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'")
def query_set_snapshot(t):
    o = t("orders")
    of = lambda rows, n: rows.select("o_orderkey", F.lit(n).alias("query_no"), (F.col("o_totalprice") + n).alias("o_totalprice"))
    rows = of(o.where("o_totalprice >= 50000"), 0).unionByName(of(o.where("o_orderdate >= timestamp'1998-01-01'"), 1))
    return views.snapshot_of_sets(rows, KEY, ["query_no"]).drop("query_no")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 2 = 0 UNION ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 3 = 0")
def query_set_snapshot_bag(t):
    bag = t("line_bag")
    return views.snapshot_of_sets(bag.where("l_orderkey % 2 = 0").unionByName(bag.where("l_orderkey % 3 = 0")), [], [])


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_custkey = 7 OR o_totalprice > 1000 GROUP BY o_orderstatus")
def one_off_query(t):
    o = t("orders")
    return o.sparkSession.sql("SELECT o_orderstatus, count(*) AS n FROM {o} WHERE o_custkey = :key OR o_totalprice > :price GROUP BY o_orderstatus", args={"key": 7, "price": 1000}, o=o)


@query("SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'events', count(*) FROM events")
def row_count(t):
    return t("orders").select(F.lit("orders").alias("table_name")).unionAll(t("events").select(F.lit("events"))).groupBy("table_name").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT o_orderkey FROM orders_base")
def primary_keys(t):
    return t("orders_base").select("o_orderkey").distinct()


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)")
def view_for_sender(t):
    return t("orders").join(t("customer").where("c_nationkey = 3"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_custkey")


@query(f"SELECT * FROM ({COALESCED}) y WHERE kind = 'update' AND new_price > old_price")
def updates_where(t):
    u = changes.of_kind(changes.coalesce_changes(t("orders_log"), KEY), "update")
    return flat(u.where("new.o_totalprice > old.o_totalprice"), "txn", *KEY)


@query(f"SELECT txn, o_orderkey, CASE WHEN kind <> 'delete' THEN new_price END AS price FROM ({COALESCED}) y WHERE o_orderkey IN (SELECT o_orderkey FROM overlay) AND old_price IS DISTINCT FROM new_price")
def watch_keys(t):
    slim = t("orders_log").select("txn", "grp", "query_set_id", "op", "o_orderkey", "o_totalprice")
    return views.watch_keys(changes.coalesce_changes(slim, KEY), t("overlay"), KEY).select("txn", "o_orderkey", F.col("value.o_totalprice").alias("price"))


@query("SELECT o_orderkey, o_totalprice, false AS touched FROM orders WHERE o_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, NULL, true FROM orders WHERE o_orderkey % 3 = 0")
def removed_where(t):
    left, gone = views.removed_where(t("orders").select("o_orderkey", "o_totalprice"), KEY, F.col("o_orderkey") % 3 == 0)
    return left.withColumn("touched", F.lit(False)).unionByName(gone.select("o_orderkey", F.lit(None).cast("double").alias("o_totalprice"), F.lit(True).alias("touched")))


# ownership


@query("SELECT o_orderkey, count(*) AS n_owners, min(query_set_id) AS first_owner FROM orders_owners GROUP BY o_orderkey")
def row_owners(t):
    return ownership.row_owners(t("orders_owners"), KEY).select(*KEY, F.size("owners").cast("long").alias("n_owners"), F.element_at("owners", 1).alias("first_owner"))


def _steps(t):
    state = t("orders").where("o_totalprice >= 50000 or o_orderdate >= timestamp'1998-01-01'").select("o_orderkey", "o_totalprice")
    return state, ownership.ownership_steps(state, t("orders_owners"), t("two_set_log"), KEY)


STEPS = """SELECT *, coalesce(lag(after_) OVER w, 0) AS before_, lag(value_) OVER w AS previous_ FROM (SELECT *, sum(gain) OVER u AS after_, last_value(price IGNORE NULLS) OVER u AS value_ FROM (SELECT *, owns - coalesce(lag(owns) OVER (PARTITION BY o_orderkey, query_set_id ORDER BY txn, set_no), 0) AS gain FROM (SELECT o_orderkey, -1 AS txn, query_set_id AS set_no, query_set_id, 1 AS owns, o_totalprice AS price FROM orders_owners JOIN orders USING (o_orderkey) UNION ALL SELECT o_orderkey, txn, set_no, query_set_id, max(CASE WHEN op = 'insert' THEN 1 ELSE 0 END), max(CASE WHEN op = 'insert' THEN o_totalprice END) FROM two_set_log GROUP BY o_orderkey, txn, set_no, query_set_id) a) b WINDOW u AS (PARTITION BY o_orderkey ORDER BY txn, set_no ROWS UNBOUNDED PRECEDING)) c WINDOW w AS (PARTITION BY o_orderkey ORDER BY txn, set_no)"""


OWNED_EVENTS = f"SELECT txn, query_set_id, o_orderkey, kind, CASE WHEN kind <> 'insert' THEN previous_ END AS old_price, CASE WHEN kind <> 'delete' THEN value_ END AS new_price FROM (SELECT *, CASE WHEN before_ = 0 AND after_ > 0 THEN 'insert' WHEN before_ > 0 AND after_ = 0 THEN 'delete' WHEN before_ > 0 AND after_ > 0 AND previous_ <> value_ THEN 'update' END AS kind FROM ({STEPS}) d WHERE txn >= 0) e WHERE kind IS NOT NULL"


@query(OWNED_EVENTS)
def apply_owned_delta(t):
    return flat(ownership.owned_events(_steps(t)[1], KEY), "txn", "query_set_id", *KEY)


#: Orders as changes of one hot key and of their customers' keys.
HOT_LOG = "SELECT o_orderkey AS txn, 1 + o_orderkey % 3 AS query_set_id, CASE WHEN o_orderkey % 7 < 3 THEN 'delete' ELSE 'insert' END AS op, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey ELSE -1 END AS k, o_totalprice AS v FROM orders"


@query(f"SELECT txn, query_set_id, k, kind, CASE WHEN kind <> 'insert' THEN previous_ END AS old, CASE WHEN kind <> 'delete' THEN value_ END AS new FROM (SELECT *, CASE WHEN before_ = 0 AND after_ > 0 THEN 'insert' WHEN before_ > 0 AND after_ = 0 THEN 'delete' WHEN before_ > 0 AND after_ > 0 AND previous_ <> value_ THEN 'update' END AS kind FROM (SELECT *, coalesce(lag(after_) OVER w, 0) AS before_, lag(value_) OVER w AS previous_ FROM (SELECT *, sum(gain) OVER u AS after_, last_value(price IGNORE NULLS) OVER u AS value_ FROM (SELECT *, owns - coalesce(lag(owns) OVER (PARTITION BY k, query_set_id ORDER BY txn), 0) AS gain FROM (SELECT *, CASE WHEN op = 'insert' THEN 1 ELSE 0 END AS owns, CASE WHEN op = 'insert' THEN v END AS price FROM ({HOT_LOG}) a) b) c WINDOW u AS (PARTITION BY k ORDER BY txn ROWS UNBOUNDED PRECEDING)) d WINDOW w AS (PARTITION BY k ORDER BY txn)) e) f WHERE kind IS NOT NULL")
def apply_owned_delta_hot(t):
    """Two thirds of all changes are of one key, whose steps are scanned in blocks."""
    log = t("orders").sparkSession.sql(HOT_LOG.replace("FROM orders", "FROM {o}"), o=t("orders")).withColumn("grp", F.lit(0))
    none = log.where("false")
    steps = ownership.ownership_steps(none.select("k", "v"), none.select("k", "query_set_id"), log.select("txn", "grp", "query_set_id", "op", "k", "v"), ["k"], blocked=True)
    return ownership.owned_events(steps, ["k"]).select("txn", "query_set_id", "k", "kind", F.col("old.v").alias("old"), F.col("new.v").alias("new"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net changes of orders under two overlapping query sets."""
    return QUERIES["apply_owned_delta"](spark, sf_dir)


@query(f"SELECT o_orderkey, value_ AS o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY txn DESC, set_no DESC) AS r FROM ({STEPS}) d) e WHERE r = 1 AND after_ > 0")
def owned_state_after(t):
    state, steps = _steps(t)
    return ownership.state_after(state, steps, KEY)


@query("SELECT o_orderkey, query_set_id FROM (SELECT o_orderkey, query_set_id, owns, row_number() OVER (PARTITION BY o_orderkey, query_set_id ORDER BY txn DESC, set_no DESC) AS r FROM (SELECT o_orderkey, -1 AS txn, 0 AS set_no, query_set_id, 1 AS owns FROM orders_owners UNION ALL SELECT o_orderkey, txn, set_no, query_set_id, max(CASE WHEN op = 'insert' THEN 1 ELSE 0 END) FROM two_set_log GROUP BY o_orderkey, txn, set_no, query_set_id) a) b WHERE r = 1 AND owns = 1")
def owners_after(t):
    return ownership.owners_after(_steps(t)[1], KEY)


@query("SELECT o_orderkey, query_set_id FROM two_set_log WHERE txn BETWEEN 50 AND 99 GROUP BY o_orderkey, query_set_id HAVING bool_and(op = 'delete') EXCEPT SELECT o_orderkey, query_set_id FROM orders_owners WHERE query_set_id = 2 AND o_orderkey % 4 = 0 EXCEPT SELECT o_orderkey, query_set_id FROM orders_owners WHERE query_set_id = 1")
def ownership_imbalance(t):
    return ownership.ownership_imbalance(t("orders_owners").where("query_set_id = 1 or o_orderkey % 4 = 0"), t("two_set_log").where("txn between 50 and 99"), KEY).select("o_orderkey", "query_set_id")


@query("SELECT DISTINCT o_orderkey FROM orders_owners WHERE query_set_id = 2 AND o_orderkey NOT IN (SELECT o_orderkey FROM orders_owners WHERE query_set_id = 1) AND o_orderkey NOT IN (SELECT o_orderkey FROM overlay)")
def drop_query_set(t):
    return ownership.drop_query_set(t("orders_owners"), 2, KEY, t("overlay"))[1]


@query("SELECT o_orderkey, o_totalprice FROM orders_base WHERE o_orderkey % 2 = 1 AND NOT (o_totalprice >= 50000 AND o_orderdate < TIMESTAMP '1998-01-01 00:00:00') UNION ALL SELECT o_orderkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 2 = 0")
def apply_snapshot(t):
    snapshot = t("orders").where("o_orderkey % 2 = 0").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return ownership.apply_snapshot(t("prices"), t("orders_owners"), snapshot, 1, KEY)[0]


@query("SELECT o_orderkey FROM orders_base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_owners) AND o_orderkey % 3 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey NOT IN (SELECT o_orderkey FROM overlay)")
def sweep_unowned(t):
    o = t("orders")
    return ownership.sweep_unowned(t("orders_base"), t("orders_owners"), o.where("o_orderkey % 3 = 0"), o.where("o_orderkey % 5 = 0"), KEY, t("overlay"))


@query("SELECT o_orderkey, query_hash FROM orders, (SELECT 11 AS query_hash UNION ALL SELECT 12) h WHERE o_orderkey IN (SELECT o_orderkey FROM orders_owners WHERE query_set_id = 2) AND o_orderkey NOT IN (SELECT o_orderkey FROM orders_owners WHERE query_set_id = 1) UNION SELECT o_orderkey, 13 FROM orders WHERE o_orderkey % 3 = 0")
def retain_on_unsubscribe(t):
    tags = t("orders").where("o_orderkey % 3 = 0").select("o_orderkey", F.lit(13).cast("long").alias("query_hash"))
    return ownership.retain_on_unsubscribe(t("orders_owners"), tags, 2, [11, 12], KEY)


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 6 <> 0 AND o_orderkey NOT IN (SELECT o_orderkey FROM orders_owners) AND o_orderkey % 5 <> 0")
def reconcile_retained(t):
    o = t("orders")
    tags = o.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit(13).alias("query_hash")).unionAll(o.where("o_orderkey % 6 = 0").select("o_orderkey", F.lit(14)))
    hashes = o.sparkSession.range(13, 14).select(F.col("id").cast("int").alias("query_hash"))
    return ownership.reconcile_retained(tags, hashes, o.where("o_orderkey % 5 = 0"), t("orders_owners"), KEY)[1]


@query("SELECT o_orderkey, CASE WHEN bool_or(query_set_id = 2) THEN 'carry' WHEN o_orderkey IN (SELECT o_orderkey FROM overlay) THEN 'skip' WHEN NOT bool_or(query_set_id = 1) THEN 'retain' ELSE 'evict' END AS action FROM (SELECT o_orderkey, query_set_id FROM orders_owners UNION ALL SELECT o_orderkey, 3 FROM orders WHERE o_orderkey % 5 = 0) p WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_owners WHERE o_orderkey % 4 = 0) GROUP BY o_orderkey")
def finalize_generation(t):
    spark = t("orders").sparkSession
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "query_set_id int")
    owners = t("orders_owners")
    # of set 3 the new generation knows nothing
    previous = owners.unionByName(t("orders").where("o_orderkey % 5 = 0").select("o_orderkey", F.lit(3).alias("query_set_id")))
    return ownership.finalize_generation(previous, owners.where("o_orderkey % 4 = 0"), ids(1), ids(2), KEY, t("overlay"))


@query("SELECT o_orderkey, query_set_id FROM orders_owners WHERE query_set_id = 1 UNION ALL SELECT o_orderkey, query_set_id FROM orders_owners WHERE query_set_id = 2 AND o_orderkey NOT IN (SELECT o_orderkey FROM orders_owners WHERE query_set_id = 1)")
def owned_or_pending(t):
    o = t("orders_owners")
    return ownership.owned_or_pending(o.where("query_set_id = 1"), o, KEY)


@query("SELECT o_orderkey FROM orders_owners WHERE query_set_id = 2 EXCEPT SELECT o_orderkey FROM orders_owners WHERE query_set_id = 1")
def ownership_gained(t):
    o = t("orders_owners")
    return ownership.ownership_gained(o.where("query_set_id = 1"), o, KEY)


@query("SELECT txn, o_orderkey, op FROM two_set_log WHERE query_set_id = 1")
def ignore_unregistered(t):
    log = t("two_set_log")
    return ownership.ignore_unregistered(log, log.sparkSession.range(1, 2).select(F.col("id").cast("int").alias("query_set_id"))).select("txn", "o_orderkey", "op")


# overlay and queue

VISIBLE = "SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders_base WHERE o_orderkey % 22 <> 0"


def _overlay(t):
    o = t("overlay")
    row = F.when(F.col("new_price").isNotNull(), F.struct("o_orderkey", F.col("new_price").alias("o_totalprice")))
    return o.withColumn("new", row).withColumn("old", row).drop("new_price")


@query(VISIBLE)
def visible_state(t):
    return overlay.visible_state(t("prices"), _overlay(t), KEY)


@query(VISIBLE.replace("o_orderkey % 11 = 0", "o_orderkey % 11 = 0 AND o_orderkey % 3 <> 1").replace("o_orderkey % 22 <> 0", "NOT (o_orderkey % 22 = 0 AND o_orderkey % 3 <> 1)"))
def rollback(t):
    return overlay.visible_state(t("prices"), overlay.rollback(_overlay(t), 1), KEY)


@query("SELECT DISTINCT o_orderkey FROM overlay")
def protected_keys(t):
    return overlay.protected_keys(t("overlay"), KEY)


@query("SELECT o_orderkey, change_no, o_orderkey IN (SELECT o_orderkey FROM orders_log) AS confirmed FROM overlay WHERE request_id = 1")
def confirm_by_touch(t):
    return overlay.confirm_by_touch(t("overlay"), 1, t("orders_log"), KEY).select("o_orderkey", "change_no", "confirmed")


@query(FINAL)
def committed_under_overlay(t):
    return overlay.committed_under_overlay(t("orders_base"), t("orders_log"), KEY).select(*SLIM)


CONFIRMED = "CASE WHEN o_orderkey % 5 = 0 THEN 'pending' WHEN o_orderkey NOT IN (SELECT o_orderkey FROM orders_owners) AND {} THEN '{}' ELSE 'promote' END AS outcome FROM overlay WHERE request_id = 1"


@query(f"SELECT DISTINCT o_orderkey, false AS empty, {CONFIRMED.format('o_orderkey NOT IN (SELECT o_orderkey FROM orders_log)', 'drop')} UNION ALL SELECT DISTINCT o_orderkey, true, {CONFIRMED.format('true', 'retain')}")
def confirm_own_commit(t):
    mine = t("overlay").withColumn("kind", F.lit("insert"))
    both = mine.unionByName(mine.where("request_id = 1 and o_orderkey % 5 = 0").withColumn("request_id", F.lit(2).cast("long")))
    of = lambda empty: overlay.confirm_own_commit(both, 1, t("orders_log"), t("orders_owners"), KEY, empty_result=empty, durably_queued=empty).withColumn("empty", F.lit(empty))
    return of(False).unionByName(of(True))


@query("SELECT o_orderkey, o_totalprice FROM orders_base WHERE o_orderkey % 13 <> 0")
def committed_only(t):
    return overlay.committed_only(t("prices"), t("prices").where("o_orderkey % 13 = 0"))


@query("SELECT DISTINCT o_orderkey FROM overlay WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders_owners)")
def unowned_awaits(t):
    return overlay.unowned_awaits(overlay.protected_keys(t("overlay"), KEY), t("orders_owners"), KEY)


@query("SELECT request_id FROM (SELECT o_orderkey % 1000 AS request_id, o_orderkey IN (SELECT o_orderkey FROM orders_owners) AS owned FROM orders) x GROUP BY request_id HAVING bool_and(owned)")
def release_owned(t):
    return overlay.release_owned(t("orders").select((F.col("o_orderkey") % 1000).alias("request_id"), "o_orderkey"), t("orders_owners"), KEY)


@query("SELECT 'reject_new' AS strategy, event_id AS seq, row_number() OVER (ORDER BY event_id) <= 100 AS kept FROM events UNION ALL SELECT 'drop_oldest', event_id, row_number() OVER (ORDER BY event_id DESC) <= 100 FROM events")
def bound_queue(t):
    q = t("events").select(F.col("event_id").alias("seq"))
    of = lambda strategy: overlay.bound_queue(q, 100, strategy).select(F.lit(strategy).alias("strategy"), "seq", "kept")
    return of("reject_new").unionByName(of("drop_oldest"))


@query("SELECT event_id AS seq, ts < (SELECT max(ts) FROM events) - INTERVAL '1' DAY AS expired FROM events")
def expire(t):
    e = t("events")
    now = e.agg(F.max("ts")).first()[0]
    return overlay.expire(e.select(F.col("event_id").alias("seq"), F.col("ts").alias("created_at")), "1 day", now).select("seq", "expired")


ATTEMPTS = "SELECT event_id AS seq, CASE event_id % 6 WHEN 0 THEN 'success' WHEN 1 THEN 'rejected' WHEN 2 THEN 'aborted' WHEN 3 THEN 'success' WHEN 4 THEN 'aborted' ELSE 'timeout' END AS outcome, CASE WHEN event_id % 5 < 3 THEN 'landed' ELSE 'not_landed' END AS landed, event_id % 2 = 0 AS pure_insert, event_id % 4 AS rechecks FROM events"


@query(f"SELECT seq, action, seq <= (SELECT coalesce(min(CASE WHEN outcome = 'timeout' AND landed <> 'landed' THEN seq END), 9000000000) FROM ({ATTEMPTS}) b) AS attempted FROM (SELECT *, CASE WHEN outcome = 'success' THEN 'confirm' WHEN outcome = 'rejected' THEN 'fail' WHEN landed = 'landed' THEN 'confirm' WHEN outcome = 'aborted' AND pure_insert AND rechecks < 3 THEN 'keep' WHEN outcome = 'aborted' THEN 'fail' ELSE 'keep' END AS action FROM ({ATTEMPTS}) a) x")
def replay_action(t):
    e = t("events")
    return overlay.replay_action(e.sparkSession.sql(ATTEMPTS.replace("FROM events", "FROM {e}"), e=e)).select("seq", "action", "attempted")


# events


@query("SELECT request_id, result_ts, outcome, name, CASE WHEN name IS NULL THEN 'remote' ELSE 'call' END AS cause FROM results LEFT JOIN calls USING (request_id)")
def match_results(t):
    return events.match_results(t("calls"), t("results")).select("request_id", "result_ts", "outcome", "name", "cause")


@query("SELECT request_id, CASE outcome WHEN 0 THEN 'committed' WHEN 1 THEN 'committed_empty' WHEN 2 THEN 'failed' ELSE 'internal_error' END AS status, CASE WHEN outcome = 0 AND request_id % 3 <> 0 THEN 'r' || request_id END AS returned, CASE WHEN outcome >= 2 THEN 'no ' || request_id END AS message FROM results")
def result_status(t):
    raw = F.when(F.col("request_id") % 3 == 0, F.lit("").cast("binary")).otherwise(F.concat(F.lit("r"), F.col("request_id").cast("string")).cast("binary"))
    r = t("results").select("request_id", "outcome", raw.alias("raw"), F.concat(F.lit("no "), F.col("request_id").cast("string")).cast("binary").alias("error"))
    r = r.select("request_id", events.result_outcome(F.col("outcome"), F.col("raw"), "error").alias("o"))
    return r.select("request_id", "o.status", F.col("o.returned").cast("string").alias("returned"), "o.message")


@query("SELECT c.request_id, c.call_ts, c.name FROM calls c LEFT JOIN results r ON c.request_id = r.request_id AND r.result_ts BETWEEN c.call_ts AND c.call_ts + INTERVAL '10' SECOND WHERE r.request_id IS NULL")
def call_timeouts(t):
    return events.call_timeouts(t("calls"), t("results")).select("request_id", "call_ts", "name")


@query("SELECT request_id, drop_ts FROM (SELECT c.request_id, min(d.drop_ts) AS drop_ts FROM calls c JOIN drops d ON d.user_id = c.user_id AND d.drop_ts >= c.call_ts GROUP BY c.request_id) x LEFT JOIN results r USING (request_id) WHERE r.result_ts IS NULL OR r.result_ts > drop_ts")
def calls_failed_by_disconnect(t):
    return events.calls_failed_by_disconnect(t("calls"), t("results"), t("drops"), "user_id")


@query("SELECT request_id, CASE WHEN outcome = 3 THEN 'internal_error' ELSE 'returned' END AS status FROM calls JOIN results USING (request_id)")
def procedure_results(t):
    return events.procedure_results(t("calls"), t("results")).select("request_id", "status")


UNTIL_CHANGED = "SELECT user_id, seq, value FROM (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY seq) AS p, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS r FROM history) x WHERE r = 1 OR value IS DISTINCT FROM p"


@query(UNTIL_CHANGED)
def distinct_until_changed(t):
    return events.distinct_until_changed(t("history"), ["user_id"]).select("user_id", "seq", "value")


@query("SELECT user_id, min(seq) AS seq, arg_min(value, seq) AS value FROM history WHERE value = 'click' GROUP BY user_id")
def first_matching(t):
    return events.first_matching(t("history"), ["user_id"], F.col("value") == "click")


@query("SELECT user_id, min(seq) AS seq, arg_min(value, seq) AS value FROM history WHERE seq > 500 GROUP BY user_id")
def next_change(t):
    return events.next_change(t("history"), ["user_id"], 500)


@query("SELECT user_id, max(seq) AS seq, arg_max(value, seq) AS value FROM history WHERE seq <= 500 GROUP BY user_id UNION ALL SELECT user_id, seq, value FROM history WHERE seq > 500")
def state_then_changes(t):
    return events.state_then_changes(t("history"), ["user_id"], 500)


@query("SELECT seq, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS r FROM user_log) x WHERE r = 1 AND op <> 'delete'")
def latest_state(t):
    return events.latest_state(t("user_log"), ["user_id"]).drop("op")


@query("SELECT event_id, event_id % 3 = 0 OR (event_id % 2 = 0 AND user_id % 5 = 1) AS is_mine FROM events")
def with_context(t):
    e = t("events").select("event_id", F.when(F.col("event_id") % 2 == 0, "call").otherwise("remote").alias("cause"), (F.col("user_id") % 5).cast("string").alias("caller"), (F.col("event_id") % 3 == 0).alias("optimistic"))
    return events.with_context(e, "1").select("event_id", "is_mine")


# jobs, functions, reports


@query("SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey) AS c_custkey, s_suppkey FROM supplier")
def insert_with_next_ids(t):
    spark = t("nation").sparkSession
    from deltaloom.sources.scratch import ensure

    ensure(spark)
    return jobs.insert_with_next_ids(t("customer"), t("supplier").select("s_suppkey"), "c_custkey", ["s_suppkey"]).select("c_custkey", "s_suppkey")


@query("SELECT o.o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'no such row' WHEN b.o_orderstatus = 'F' THEN 'row is locked' ELSE 'ok' END AS result FROM orders o LEFT JOIN orders_base b USING (o_orderkey)")
def guarded_update(t):
    return jobs.guarded_update(t("orders_base"), t("orders").select("o_orderkey"), "o_orderkey", F.col("o_orderstatus") == "F")


@query("WITH c AS (SELECT event_id AS connection_id, user_id FROM events), l AS (SELECT * FROM c WHERE connection_id % 3 <> 0), gone AS (SELECT DISTINCT user_id FROM c WHERE connection_id % 3 = 0 AND user_id % 2 = 0 AND user_id NOT IN (SELECT user_id FROM l)) SELECT o_orderkey, o_custkey AS owner FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM gone)")
def cascade_on_disconnect(t):
    c = t("events").select(F.col("event_id").alias("connection_id"), F.col("user_id").alias("identity"))
    items = t("orders").select("o_orderkey", F.col("o_custkey").alias("owner"))
    return jobs.cascade_on_disconnect(c, c.where("identity % 2 = 0").select("identity").distinct(), items, c.where("connection_id % 3 = 0").select("connection_id"))[1].select("o_orderkey", "owner")


@query("SELECT event_type, p50, p95, p99, n FROM (SELECT event_type, s[CAST(floor(0.5 * (n - 1) + 0.5) AS BIGINT) + 1] AS p50, s[CAST(floor(0.95 * (n - 1) + 0.5) AS BIGINT) + 1] AS p95, s[CAST(floor(0.99 * (n - 1) + 0.5) AS BIGINT) + 1] AS p99, n FROM (SELECT event_type, list_sort(list(value)) AS s, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY event_type) x) y")
def latency_report(t):
    return jobs.latency_report(t("events"), ["event_type"], "value")


@query("SELECT event_type, count(*) AS fired, count_if(event_id % 3 = 0) AS observed, count_if(value > 50) AS budget_misses, count_if(event_id % 3 = 0) * 2 < count(*) AS backpressure, bool_or(event_id % 1000 = 7) AS disconnected, CAST(round(count_if(event_id % 3 = 0) * 1000000.0::DOUBLE / count(*)) AS BIGINT) AS kept_up_millionths FROM events GROUP BY event_type")
def throughput_report(t):
    e = t("events").withColumns({"fired": F.lit(True), "observed": F.col("event_id") % 3 == 0, "lost": F.col("event_id") % 1000 == 7})
    out = jobs.throughput_report(e, ["event_type"], "fired", "observed", "value", 50, "lost")
    return out.withColumn("kept_up_millionths", F.round(F.col("kept_up_pct") * 10_000).cast("long")).drop("kept_up_pct")


@query("SELECT event_type AS table_name, count(*) AS calls, CAST(sum(event_id % 7) AS BIGINT) AS rows_written FROM events GROUP BY event_type")
def snapshot_write_report(t):
    e = t("events").select(F.col("event_type").alias("table_name"), (F.col("event_id") % 7).alias("rows"))
    return jobs.snapshot_write_report(e).select("table_name", "calls", F.col("rows").alias("rows_written"))


@query("SELECT event_type AS table_name, max(ts) AS last_sync_at FROM events GROUP BY event_type")
def last_sync_times(t):
    return tables.last_sync_times(t("events").select(F.col("event_type").alias("table_name"), "ts"))


@query("SELECT user_id, event_id AS seq FROM events WHERE event_id % 3 <> 0 AND (event_id + 1) % 3 <> 0")
def replay_journal(t):
    e = t("events")
    on = e.where("event_id % 3 <> 0").select((F.col("event_id") * 2).alias("seq"), F.format_string('{"op":"enqueue","mutation":{"requestId":"%d"}}', "event_id").alias("line"))
    off = e.where("event_id % 3 <> 0 and (event_id + 1) % 3 = 0").select((F.col("event_id") * 2 + 1).alias("seq"), F.format_string('{"op":"dequeue","requestId":"%d"}', "event_id").alias("line"))
    bad = e.where("event_id % 3 = 0").select((F.col("event_id") * 2).alias("seq"), F.lit("{torn").alias("line"))
    live = tables.replay_journal(on.unionAll(off).unionAll(bad)).select(F.col("request_id").cast("long").alias("seq"))
    return live.join(e, F.col("seq") == F.col("event_id")).select("user_id", "seq")


@query("SELECT txn, set_no, grp, query_set_id, op, o_orderkey FROM two_set_log UNION ALL SELECT txn, 2, 0, 7, 'event', o_orderkey FROM two_set_log WHERE op = 'insert'")
def flatten_transactions(t):
    log = t("two_set_log").select("txn", "set_no", "query_set_id", "op", "o_orderkey")
    log = log.unionByName(log.where("op = 'insert'").withColumns({"op": F.lit("event"), "set_no": F.lit(2), "query_set_id": F.lit(7)}))
    rows = lambda op: F.collect_list(F.when(F.col("op") == op, F.struct("o_orderkey")))
    groups = log.groupBy("txn", "set_no", "query_set_id").agg(F.struct(rows("insert").alias("inserts"), rows("delete").alias("deletes"), rows("event").alias("events")).alias("group"))
    one = F.struct("set_no", "query_set_id", F.array(F.struct(F.lit("orders").alias("table_name"), F.array("group").alias("groups"))).alias("tables"))
    nested = groups.groupBy("txn").agg(F.sort_array(F.collect_list(one)).alias("query_sets"))
    # a message's sets stand in their order; where a place has no set there is one without tables
    full = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: F.get(F.filter("query_sets", lambda q: q["set_no"] == k), 0))
    nested = nested.select("txn", F.transform(full, lambda q: F.struct(q["query_set_id"].alias("query_set_id"), q["tables"].alias("tables"))).alias("query_sets"))
    return tables.flatten_transactions(nested).select("txn", "set_no", "grp", "query_set_id", "op", "row.o_orderkey")


@query("SELECT c_custkey, lower(substr(md5(c_name), 1, 4)) || '...' || substr(md5(c_name), 29, 4) AS short_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS uuid_text FROM (SELECT *, md5(c_name) AS h FROM customer) x")
def identity_text(t):
    h = F.md5("c_name")
    return t("customer").select("c_custkey", scalars.abbreviate(h).alias("short_id"), scalars.parse_uuid(F.upper(h)).alias("uuid_text"))
