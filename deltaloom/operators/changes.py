"""Applying change logs to keyed tables and bags.

A change log has txn (a total order), grp (row group within it), query_set_id, op ('insert' or 'delete') and the
table's columns; it may have set_no, a query set's place in the transaction's message, and pos, a row's place in its group. Within a transaction deletes come before inserts. pk lists the key columns; rows with a null in the
key are not addressable and are ignored by keyed operators.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from deltaloom.sources.scratch import written

from . import scans

META = ("txn", "set_no", "grp", "pos", "query_set_id", "op")
#: Rows of a bag and its log for each task that scans them, and copies of a row that are made at once.
TASK_ROWS, COPIES = 1_000_000, 10_000


def row_columns(log: DataFrame, meta=META) -> list[str]:
    return [c for c in log.columns if c not in meta]


def keyed(df: DataFrame, pk: list[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in pk]))


def step(op: str = "op") -> Column:
    """Order of operations within a transaction."""
    return F.when(F.col(op) == "delete", 0).otherwise(1)


def comparable(value: Column, kind: T.DataType) -> Column:
    """A value whose equality is content equality: maps become sorted arrays of entries, at any depth."""
    if isinstance(kind, T.MapType):
        return F.array_sort(F.transform(F.map_entries(value), lambda e: F.struct(comparable(e["key"], kind.keyType).alias("k"), comparable(e["value"], kind.valueType).alias("v"))))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: comparable(e, kind.elementType))
    if isinstance(kind, T.StructType):
        return F.when(value.isNotNull(), F.struct(*(comparable(value[f.name], f.dataType).alias(f.name) for f in kind.fields)))
    return value


def rows_equal_deep(a: Column, b: Column, kind: T.DataType) -> Column:
    """Content equality of two values of one type. NaN equals NaN, null equals null."""
    return comparable(a, kind).eqNullSafe(comparable(b, kind))


def rows_equal_shallow(a: Column, b: Column, kind: T.StructType) -> Column:
    """Equality field by field."""
    return reduce(lambda x, y: x & y, [a[f.name].eqNullSafe(b[f.name]) for f in kind.fields])


def rows_equal_text(a: Column, b: Column, kind: T.StructType) -> Column:
    """Equality of the fields' text forms: 1 and '1' are equal, structs compare as JSON."""
    text = lambda v, f: F.to_json(v[f.name]) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else v[f.name].cast("string")
    return reduce(lambda x, y: x & y, [text(a, f).eqNullSafe(text(b, f)) for f in kind.fields])


def delta(log: DataFrame, pk: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """One row for each key (and each value of by): d, the last deleted row, and i, the last inserted row, or null."""
    row = F.struct(*row_columns(log))
    at = F.struct(*(F.col(c) for c in ("txn", "set_no", "grp", "pos") if c in log.columns and c not in by))
    last = lambda op: F.max_by(F.when(F.col("op") == op, row), F.when(F.col("op") == op, at))
    return keyed(log, pk).groupBy(*by, *pk).agg(last("delete").alias("d"), last("insert").alias("i"))


def coalesce_changes(log: DataFrame, pk: list[str]) -> DataFrame:
    """txn, pk, kind, old, new: in each transaction a delete and an insert of a key are one update."""
    d, i = F.col("d"), F.col("i")
    kind = F.when(d.isNotNull() & i.isNotNull(), "update").when(i.isNotNull(), "insert").otherwise("delete")
    return delta(log, pk, ("txn",)).select("txn", *pk, kind.alias("kind"), d.alias("old"), i.alias("new"))


def classify_against_state(state: DataFrame, log: DataFrame, pk: list[str], mode: str = "reconcile") -> DataFrame:
    """pk, kind, old, new of the log taken as one delta on state.

    reconcile: rows that stay equal and deletes of absent rows tell nothing; an insert of a present row is an update.
    strict: a delete of an absent row is told with the row that it carries, an insert that no delete of a present row
    goes with is an insert.
    """
    columns = row_columns(log)
    base = state.select(*pk, F.struct(*columns).alias("base"))
    kind_of = base.schema["base"].dataType
    both = delta(log, pk).join(base, pk, "left")
    d, i, b = F.col("d"), F.col("i"), F.col("base")
    same = rows_equal_deep(b, i, kind_of)
    if mode == "reconcile":
        kind = F.when(i.isNotNull(), F.when(b.isNull(), "insert").when(~same, "update")).when(b.isNotNull(), "delete")
        events = F.array(F.struct(kind.alias("kind"), b.alias("old"), F.when(kind != "delete", i).alias("new")))
    elif mode == "strict":
        replaced = d.isNotNull() & b.isNotNull()
        put = F.when(i.isNotNull(), F.when(replaced, "update").otherwise("insert"))
        gone = F.when(d.isNotNull() & ~(replaced & i.isNotNull()), "delete")
        events = F.array(F.struct(put.alias("kind"), F.when(replaced, b).alias("old"), i.alias("new")), F.struct(gone.alias("kind"), F.coalesce(b, d).alias("old"), F.lit(None).cast(kind_of).alias("new")))
    else:
        raise ValueError(f"unknown mode {mode}")
    return both.select(*pk, F.explode(events).alias("e")).where("e.kind is not null").select(*pk, "e.kind", F.when(F.col("e.kind") != "insert", F.col("e.old")).alias("old"), "e.new")


def apply_changes(state: DataFrame, log: DataFrame, pk: list[str]) -> DataFrame:
    """State after all transactions in order: the last operation on each key holds. One pass, two shuffles by key."""
    columns = row_columns(log)
    at = [F.col(c) for c in ("set_no", "grp", "pos") if c in log.columns]
    last = keyed(log, pk).groupBy(*pk).agg(F.max_by(F.struct("op", F.struct(*columns).alias("row")), F.struct("txn", step().alias("step"), *at)).alias("last"))
    kept = state.join(last.select(*pk), pk, "left_anti").select(*columns)
    return kept.unionByName(last.where("last.op = 'insert'").select("last.row.*"))


def apply_changes_bag(state: DataFrame, log: DataFrame, blocked: bool | None = None) -> DataFrame:
    """Bag after all transactions: each delete takes one equal row, if there is one, then inserts are added.

    Per distinct row the count after t is max(0, n - deletes) + inserts; as running sums that is S_T - min(0, min of
    the sums after each transaction's deletes), so no loop is needed. State counts as the first transaction.

    blocked: whether a row's transactions are scanned in blocks, over many tasks; None: where a row has more than
    scans.HOT changes. The bag is the same.
    """
    columns = row_columns(log)
    blocked = scans.has_hot_key(log, columns) if blocked is None else blocked
    rows = 0 if blocked else log.count() + state.count()
    log = log.groupBy("txn", *columns).agg(F.count_if(F.col("op") == "delete").alias("d"), F.count_if(F.col("op") == "insert").alias("i"))
    first = state.groupBy(*columns).agg(F.lit(0).cast("long").alias("d"), F.count("*").alias("i")).withColumn("txn", F.lit(None).cast("long"))
    steps = log.unionByName(first)
    # as many tasks as rows need: partitions by size are merged into few of many short rows, whose sort takes much more
    steps = scans.cut(steps, columns, ["txn"]) if blocked else steps.repartition(rows // TASK_ROWS + 1, *columns)
    block = ["_block"] if blocked else []
    order = Window.partitionBy(*columns, *block).orderBy(F.col("txn").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("after", F.sum(F.col("i") - F.col("d")).over(order)).withColumn("low", F.col("after") - F.col("i"))
    parts = steps.groupBy(*columns, *block).agg(F.sum(F.col("i") - F.col("d")).alias("sum"), F.min("low").alias("low"))
    if blocked:  # a row's part in a block goes on from what its earlier parts add up to
        earlier = Window.partitionBy(*columns).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("low", F.col("low") + F.coalesce(F.sum("sum").over(earlier), F.lit(0)))
        parts = parts.groupBy(*columns).agg(F.sum("sum").alias("sum"), F.min("low").alias("low"))
    counts = parts.select(*columns, (F.col("sum") - F.least(F.lit(0), "low")).alias("n"))
    made = counts.where("n > 0").withColumn("_made", F.explode(F.expr(f"sequence(0L, n - 1, {COPIES}L)")))
    return made.withColumn("copy", F.explode(F.expr(f"sequence(1L, least(n - _made, {COPIES}L))"))).select(*columns)


def merge_row_groups(log: DataFrame) -> DataFrame:
    """Where a query set's transaction has several row groups, equal rows of one operation become one; grp is then 0."""
    columns = row_columns(log)
    several = log.groupBy("txn", "query_set_id").agg((F.min("grp") < F.max("grp")).alias("several")).where("several").drop("several")
    single = log.join(several, ["txn", "query_set_id"], "left_anti").select(*log.columns)
    merged = log.join(several, ["txn", "query_set_id"], "left_semi").withColumn("grp", F.lit(0).cast(log.schema["grp"].dataType)).dropDuplicates(["txn", "query_set_id", "op", *columns])
    return single.unionByName(merged.select(*log.columns))


def touched_keys(log: DataFrame, pk: list[str], protected: DataFrame | None = None) -> DataFrame:
    keys = keyed(log, pk).select("txn", *pk).distinct()
    return keys if protected is None else keys.join(protected, pk, "left_anti")


def present_keys(log: DataFrame, pk: list[str]) -> DataFrame:
    return keyed(log, pk).where("op = 'insert'").select("txn", *pk).distinct()


def absent_keys(log: DataFrame, pk: list[str]) -> DataFrame:
    """Keys that a transaction deletes and doesn't insert."""
    return keyed(log, pk).groupBy("txn", *pk).agg(F.bool_and(F.col("op") == "delete").alias("gone")).where("gone").drop("gone")


def inserted_keys(log: DataFrame, pk: list[str]) -> DataFrame:
    return present_keys(log, pk).select(*pk).distinct()


def fresh_keys(state: DataFrame, log: DataFrame, pk: list[str]) -> DataFrame:
    """Keys that are inserted and that state lacks."""
    return inserted_keys(log, pk).join(state.select(*pk), pk, "left_anti")


def removed_keys(log: DataFrame, pk: list[str]) -> DataFrame:
    """Keys that are deleted and not inserted, the log taken as one delta."""
    return keyed(log, pk).groupBy(*pk).agg(F.bool_and(F.col("op") == "delete").alias("gone")).where("gone").drop("gone")


def split_protected(log: DataFrame, protected: DataFrame, pk: list[str]) -> tuple[DataFrame, DataFrame]:
    """The log without protected keys, and pk, committed: what the log leaves of each protected key (null: deleted)."""
    free = log.join(protected, pk, "left_anti").select(*log.columns)
    held = delta(log.join(protected, pk, "left_semi").select(*log.columns), pk).select(*pk, F.col("i").alias("committed"))
    return free, held


def event_place(kind: str = "kind") -> Column:
    """A transaction tells inserts first, then deletes, then updates."""
    return F.when(F.col(kind) == "insert", 0).when(F.col(kind) == "delete", 1).otherwise(2)


def deliver_events(changes: DataFrame) -> DataFrame:
    """Events written in order of delivery, with at: transactions (and tables) one after the other, of each the inserts,
    then deletes, then updates, each by key. at ascends in that order over all files, and files by ranges of it.

    changes: txn, kind, pk columns, old, new, and table_name where there are several. Range partitions split a bulk load.
    """
    by = [c for c in ("txn", "table_name") if c in changes.columns]
    keys = [c for c in changes.columns if c not in (*by, "kind", "old", "new")]
    order = [*by, "place", *keys]
    rows = changes.withColumn("place", event_place()).repartitionByRange(*order).sortWithinPartitions(*order)
    return written(rows.withColumn("at", F.monotonically_increasing_id()), "events")


def transaction_batches(events: DataFrame) -> DataFrame:
    """The manifest of delivered events: one row for each transaction (and table), however many events it has.

    inserts, deletes, updates: their numbers; first_at, last_at: where its events begin and end.
    """
    by = [c for c in ("txn", "table_name") if c in events.columns]
    count = lambda k: F.count_if(F.col("kind") == k).alias(f"{k}s")
    return events.groupBy(*by).agg(count("insert"), count("delete"), count("update"), F.min("at").alias("first_at"), F.max("at").alias("last_at"))


def events_of(events: DataFrame, first_at: int, last_at: int) -> DataFrame:
    """A batch's events in order; only files whose range has some of them are read."""
    return events.where(F.col("at").between(first_at, last_at)).orderBy("at").drop("place")


def of_kind(changes: DataFrame, kind: str) -> DataFrame:
    return changes.where(F.col("kind") == kind)


def apply_deletes(state: DataFrame, gone: DataFrame, pk: list[str] | None) -> DataFrame:
    """state without the keys of gone; without pk one equal row goes for each row of gone."""
    return state.join(gone.select(*pk).distinct(), pk, "left_anti") if pk else state.exceptAll(gone)


def upsert_rows(state: DataFrame, rows: DataFrame, pk: list[str], order: list[str] | None = None) -> DataFrame:
    """Insert or replace. Of rows with one key the largest one by order stays, of all columns where none is given.

    rows may have more columns than state, such as a place in their batch, for order to name.
    """
    if not pk:
        raise ValueError("rows of a table without a key can't be replaced")
    new = rows.groupBy(*pk).agg(F.max_by(F.struct(*state.columns), F.struct(*(order or state.columns))).alias("r")).select("r.*")
    return state.join(rows.select(*pk).distinct(), pk, "left_anti").select(*state.columns).unionByName(new)


def update_rows(state: DataFrame, rows: DataFrame, pk: list[str]) -> DataFrame:
    """Replace rows whose key exists; others are no-ops."""
    if not pk:
        raise ValueError("rows of a table without a key can't be replaced")
    return upsert_rows(state, rows.join(state.select(*pk), pk, "left_semi").select(*rows.columns), pk)


def delete_keys(state: DataFrame, keys: DataFrame, pk: list[str]) -> DataFrame:
    if not pk:
        raise ValueError("rows of a table without a key can't be deleted by key")
    return apply_deletes(state, keys, pk)


def clear_state(state: DataFrame) -> DataFrame:
    return state.where(F.lit(False))


def replace_state(state: DataFrame, rows: DataFrame, pk: list[str], query_set: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """State, owners and events once a table's whole content is replaced: what was held, owned or tagged before is gone.

    Rows of the new content belong to query_set alone; of rows with one key one stays.
    """
    new = upsert_rows(clear_state(state), rows.select(*state.columns), pk)
    return new, new.select(*pk, F.lit(query_set).alias("query_set_id")), snapshot_diff(state, new, pk)


def initial_load(state: DataFrame, rows: DataFrame) -> DataFrame:
    """Snapshot of a bag: rows that belong to a pending request stay, all others are replaced."""
    return state.where("request_id is not null").unionByName(rows, allowMissingColumns=True)


def snapshot_diff(old: DataFrame, new: DataFrame, pk: list[str]) -> DataFrame:
    """pk, kind, old, new: what changed between two snapshots of a table."""
    columns = old.columns
    a, b = (df.select(*pk, F.struct(*columns).alias(name)) for df, name in ((old, "old"), (new, "new")))
    o, n = F.col("old"), F.col("new")
    kind = F.when(o.isNull(), "insert").when(n.isNull(), "delete").when(~rows_equal_deep(o, n, a.schema["old"].dataType), "update")
    # a null key is a row's identity too: it meets the other snapshot's null key
    met = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in pk])
    keys = [F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in pk]
    return a.alias("a").join(b.alias("b"), met, "full_outer").select(*keys, kind.alias("kind"), "old", "new").where("kind is not null")
