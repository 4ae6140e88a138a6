"""Inputs derived from the given tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

SQL = {
    "orders_base": "SELECT * FROM orders WHERE o_orderkey % 7 <> 0",
    "orders_log": """SELECT o_orderkey % 50 AS txn, 0 AS grp, 1 AS query_set_id, 'delete' AS op, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 5 = 0
UNION ALL SELECT o_orderkey % 50, 0, 1, 'insert', o_orderkey, o_custkey, 'U', o_totalprice + 1, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 10 = 0
UNION ALL SELECT o_orderkey % 50, 0, 1, 'insert', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 10 <> 0
UNION ALL SELECT 50 + o_orderkey % 50, 0, 1, 'insert', o_orderkey, o_custkey, o_orderstatus, o_totalprice + 3, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 35 = 0
UNION ALL SELECT 50 + o_orderkey % 50, 1, 1, 'insert', o_orderkey, o_custkey, 'V', o_totalprice + 7, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 35 = 0
UNION ALL SELECT 50 + o_orderkey % 50, 1, 1, 'delete', o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 70 = 0
UNION ALL SELECT 100 + o_orderkey % 50, 0, 1, 'delete', o_orderkey, o_custkey, o_orderstatus, o_totalprice + 7, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 105 = 0""",
    "orders_owners": """SELECT o_orderkey, 1 AS query_set_id FROM orders WHERE o_totalprice >= 50000
UNION ALL SELECT o_orderkey, 2 FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'""",
    # in half of the messages set 2 comes before set 1
    "two_set_log": """SELECT o_orderkey % 50 AS txn, CASE WHEN o_orderkey % 50 % 4 < 2 THEN 0 ELSE 1 END AS set_no, 0 AS grp, 1 AS query_set_id, 'delete' AS op, o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 50000 AND o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey % 50, CASE WHEN o_orderkey % 50 % 4 < 2 THEN 1 ELSE 0 END, 0, 2, 'insert', o_orderkey, o_totalprice + 2 FROM orders WHERE o_orderkey % 6 = 0
UNION ALL SELECT 50 + o_orderkey % 50, 0, 0, 2, 'delete', o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND o_orderkey % 6 = 0
UNION ALL SELECT 100 + o_orderkey % 50, 0, 0, 1, 'insert', o_orderkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 9 = 0""",
    "user_log": "SELECT event_id AS seq, user_id, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'insert' END AS op, event_type, value FROM events",
    "overlay": """SELECT o_orderkey AS seq, 0 AS change_no, o_orderkey % 3 AS request_id, 'update' AS kind, o_orderkey, o_totalprice * 2 AS new_price FROM orders WHERE o_orderkey % 11 = 0
UNION ALL SELECT o_orderkey, 1, o_orderkey % 3, 'delete', o_orderkey, NULL FROM orders WHERE o_orderkey % 22 = 0""",
    "prices": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 7 <> 0",
    "line_bag": "SELECT l_orderkey, l_linenumber FROM lineitem",
    "line_bag_log": """SELECT 1 AS txn, 'delete' AS op, l_orderkey, l_linenumber FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 3 = 0) x
UNION ALL SELECT 2, 'insert', l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 10 = 0""",
    "calls": "SELECT event_id AS request_id, ts AS call_ts, event_type AS name, user_id FROM events WHERE event_id % 4 <> 3",
    "results": "SELECT event_id AS request_id, ts + INTERVAL '1' SECOND * (event_id % 20) AS result_ts, event_id % 4 AS outcome FROM events WHERE event_id % 5 <> 0",
    "drops": "SELECT user_id, ts AS drop_ts FROM events WHERE event_type = 'error'",
    "history": "SELECT event_id AS seq, user_id, event_type AS value FROM events",
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture, or a table, over the tables in sf_dir."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    used = {t: fixture(spark, sf_dir, t) for t in TABLES if re.search(rf"\b{t}\b", SQL[name])}
    text = SQL[name].replace("{", "{{").replace("}", "}}")
    for t in used:
        text = re.sub(rf"\bFROM {t}\b", f"FROM {{{t}}}", text)
    return spark.sql(text, **used)


def oracle(text: str) -> str:
    """Equivalent SQL with the fixtures that it names as common tables."""
    names = [n for n in SQL if re.search(rf"\b{n}\b", text)]
    return ("WITH " + ",\n".join(f"{n} AS ({SQL[n]})" for n in names) + "\n" if names else "") + text
