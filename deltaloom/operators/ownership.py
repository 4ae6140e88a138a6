"""Which query sets still select each row: owners in long form (pk, query_set_id), never one list per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import scans
from .changes import delta, keyed, row_columns, rows_equal_deep


def row_owners(owners: DataFrame, pk: list[str]) -> DataFrame:
    """pk -> sorted query sets; there are few sets for a row, however many rows."""
    return owners.groupBy(*pk).agg(F.array_sort(F.collect_set("query_set_id")).alias("owners"))


def ignore_unregistered(log: DataFrame, live: DataFrame) -> DataFrame:
    """Changes of query sets that are still subscribed; live: query_set_id."""
    return log.join(live.select("query_set_id").distinct(), "query_set_id", "left_semi").select(*log.columns)


def ownership_steps(state: DataFrame, owners: DataFrame, log: DataFrame, pk: list[str], blocked: bool | None = None) -> DataFrame:
    """Every (key, txn, query set) step with the owners and the row before and after it.

    Owners are a running count of sets that gain or lose the key; the row is the last one inserted. A set that
    reports a key absent without owning it changes nothing. The base is the step before all transactions. Sets of one
    transaction take effect in the order of its message, set_no; a log without that column is in order of query_set_id.

    blocked: whether steps are scanned in blocks, so that a key's steps are dealt over many tasks; None: where some key has
    more than scans.HOT changes. The steps are the same.
    """
    blocked = scans.has_hot_key(keyed(log, pk), pk) if blocked is None else blocked
    columns = row_columns(log)
    log = log if "set_no" in log.columns else log.withColumn("set_no", F.col("query_set_id"))
    per = delta(log, pk, ("txn", "set_no", "query_set_id")).select(*pk, "txn", "set_no", "query_set_id", F.col("i").isNotNull().cast("int").alias("owns"), F.col("i").alias("row"))
    base = owners.join(state.select(*pk, F.struct(*columns).alias("row")), pk, "left").select(*pk, F.lit(None).cast("long").alias("txn"), F.lit(None).cast(log.schema["set_no"].dataType).alias("set_no"), "query_set_id", F.lit(1).alias("owns"), "row")
    steps = base.unionByName(per)
    if blocked:
        order = ["txn", "set_no", "query_set_id"]
        steps = scans.running(scans.cut(steps, pk, order), [*pk, "query_set_id"], order, lasts={"_was": "owns"}, before=True)
        steps = steps.withColumn("gain", F.col("owns") - F.coalesce("_was", F.lit(0))).drop("_was")
        steps = scans.running(steps, pk, order, {"after": "gain"}, {"value": "row"})
        steps = scans.running(steps, pk, order, lasts={"previous": "row"}, before=True)
        return steps.withColumn("before", F.col("after") - F.col("gain")).drop("_block")
    own = Window.partitionBy(*pk, "query_set_id").orderBy(F.col("txn").asc_nulls_first(), "set_no")
    steps = steps.withColumn("gain", F.col("owns") - F.coalesce(F.lag("owns").over(own), F.lit(0)))
    order = Window.partitionBy(*pk).orderBy(F.col("txn").asc_nulls_first(), "set_no", "query_set_id")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("after", F.sum("gain").over(so_far)).withColumn("value", F.last("row", ignorenulls=True).over(so_far))
    return steps.withColumn("before", F.coalesce(F.lag("after").over(order), F.lit(0))).withColumn("previous", F.lag("value").over(order))


def owned_events(steps: DataFrame, pk: list[str]) -> DataFrame:
    """txn, query_set_id, pk, kind, old, new: a first owner inserts, a last owner's loss deletes, a new value updates."""
    kind_of = steps.schema["value"].dataType
    changed = ~rows_equal_deep(F.col("previous"), F.col("value"), kind_of)
    kind = F.when((F.col("before") == 0) & (F.col("after") > 0), "insert").when((F.col("before") > 0) & (F.col("after") == 0), "delete").when((F.col("before") > 0) & (F.col("after") > 0) & changed, "update")
    out = steps.where("txn is not null").withColumn("kind", kind).where("kind is not null")
    return out.select("txn", "query_set_id", *pk, "kind", F.when(F.col("kind") != "insert", F.col("previous")).alias("old"), F.when(F.col("kind") != "delete", F.col("value")).alias("new"))


def owners_after(steps: DataFrame, pk: list[str]) -> DataFrame:
    return steps.groupBy(*pk, "query_set_id").agg(F.max_by("owns", F.struct(F.coalesce("txn", F.lit(-(2**62))), "set_no")).alias("owns")).where("owns = 1").select(*pk, "query_set_id")


def state_after(state: DataFrame, steps: DataFrame, pk: list[str]) -> DataFrame:
    """Rows that some set still owns, with the value that the last insert left; rows without a step stay."""
    columns = steps.schema["value"].dataType.names
    last = steps.groupBy(*pk).agg(F.max_by(F.struct("after", "value"), F.struct(F.coalesce("txn", F.lit(-(2**62))), "set_no", "query_set_id")).alias("last"))
    idle = state.join(last.select(*pk), pk, "left_anti").select(*columns)
    return idle.unionByName(last.where("last.after > 0 and last.value is not null").select("last.value.*"))


def ownership_gained(before: DataFrame, after: DataFrame, pk: list[str]) -> DataFrame:
    """Keys that had no owner and have one."""
    return after.select(*pk).distinct().join(before.select(*pk), pk, "left_anti")


def ownership_imbalance(owners: DataFrame, log: DataFrame, pk: list[str]) -> DataFrame:
    """query_set_id, pk that a set reports absent though it was no owner."""
    gone = delta(log, pk, ("query_set_id",)).where("i is null").select(*pk, "query_set_id")
    return gone.join(owners, [*pk, "query_set_id"], "left_anti")


def drop_query_set(owners: DataFrame, query_set: int, pk: list[str], protected: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Owners without the set, and the keys that it leaves without an owner, protected ones left out."""
    rest = owners.where(F.col("query_set_id") != query_set)
    evicted = owners.where(F.col("query_set_id") == query_set).select(*pk).distinct().join(rest, pk, "left_anti")
    return rest, evicted if protected is None else evicted.join(protected, pk, "left_anti")


def drop_with_rows(state: DataFrame, owners: DataFrame | None, dropped: DataFrame, query_set: int, pk: list[str] | None) -> tuple[DataFrame, DataFrame | None]:
    """State and owners after an unsubscribe whose reply carries the rows that it drops.

    The rows count as deletes of the set and nothing is checked for imbalance; rows that another set owns stay. A table
    without a key has no owners: each dropped row takes one equal row, if there is one.
    """
    if not pk:
        return state.exceptAll(dropped.select(*state.columns)), owners
    rest = owners.where(F.col("query_set_id") != query_set)
    gone = dropped.select(*pk).distinct().join(rest.select(*pk), pk, "left_anti")
    return state.join(gone, pk, "left_anti").select(*state.columns), rest


def apply_snapshot(state: DataFrame, owners: DataFrame, snapshot: DataFrame, query_set: int, pk: list[str], protected: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """State and owners after a set's full result: its rows are upserted and owned, others lose it and may go."""
    rows = keyed(snapshot, pk)
    rest = owners.where(F.col("query_set_id") != query_set)
    lost = owners.where(F.col("query_set_id") == query_set).join(rows, pk, "left_anti").select(*pk)
    gone = lost.join(rest, pk, "left_anti")
    gone = gone if protected is None else gone.join(protected, pk, "left_anti")
    left = state.join(rows, pk, "left_anti").join(gone, pk, "left_anti").select(*state.columns)
    return left.unionByName(rows.select(*state.columns)), rest.select(*pk, "query_set_id").unionByName(rows.select(*pk, F.lit(query_set).alias("query_set_id")))


def sweep_unowned(state: DataFrame, owners: DataFrame, tags: DataFrame, snapshot: DataFrame, pk: list[str], protected: DataFrame | None = None) -> DataFrame:
    """Keys of rows that nothing holds: no owner, no tag, not in the snapshot, not protected."""
    out = state.select(*pk)
    for held in (owners, tags, snapshot, protected):
        out = out if held is None else out.join(held.select(*pk), pk, "left_anti")
    return out


def retain_on_unsubscribe(owners: DataFrame, tags: DataFrame, query_set: int, hashes: list[int], pk: list[str]) -> DataFrame:
    """Tags after an unsubscribe that keeps rows: those left without an owner get the set's query hashes."""
    orphans = drop_query_set(owners, query_set, pk)[1]
    new = orphans.select(*pk, F.explode(F.array(*(F.lit(h).cast("long") for h in hashes))).alias("query_hash"))
    return tags.select(*pk, "query_hash").unionByName(new).distinct()


def reconcile_retained(tags: DataFrame, hashes: DataFrame, snapshot: DataFrame, owners: DataFrame, pk: list[str], protected: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Tags without the hashes of a set that is back, and keys that nothing holds any more."""
    rest = tags.join(hashes, "query_hash", "left_anti").select(*pk, "query_hash")
    stripped = tags.join(hashes, "query_hash", "left_semi").select(*pk).distinct()
    return rest, sweep_unowned(stripped, owners, rest, snapshot, pk, protected)


def begin_generation(owners: DataFrame, previous: DataFrame) -> DataFrame:
    """Owners of the previous generation once a reconnect starts; the new generation starts without any."""
    return previous.unionByName(owners.select(*previous.columns)).distinct()


def finalize_generation(previous: DataFrame, owners: DataFrame, live: DataFrame, errored: DataFrame, pk: list[str], protected: DataFrame | None = None) -> DataFrame:
    """pk, action for keys that no set has delivered again.

    carry if one of its sets errored, else skip if protected, else retain if none of its sets is live, else evict.
    Touches owner rows alone, never the state, so that its cost follows the reported rows.
    """
    left = previous.join(owners.select(*pk).distinct(), pk, "left_anti")
    mark = lambda df, name: df.select("query_set_id").distinct().withColumn(name, F.lit(True))
    left = left.join(mark(live, "live"), "query_set_id", "left").join(mark(errored, "errored"), "query_set_id", "left")
    keys = left.groupBy(*pk).agg(F.max(F.coalesce("errored", F.lit(False))).alias("errored"), F.max(F.coalesce("live", F.lit(False))).alias("live"))
    if protected is None:
        keys = keys.withColumn("protected", F.lit(False))
    else:
        keys = keys.join(protected.select(*pk).distinct().withColumn("protected", F.lit(True)), pk, "left").withColumn("protected", F.coalesce("protected", F.lit(False)))
    action = F.when(F.col("errored"), "carry").when(F.col("protected"), "skip").when(~F.col("live"), "retain").otherwise("evict")
    return keys.select(*pk, action.alias("action"))


def replay_complete(sets: DataFrame) -> DataFrame:
    """One row: may finalize (every live set is applied or errored), ready (every set applied, and there is one).

    sets: query_set_id, applied, errored, timed_out.
    """
    every = lambda c: F.coalesce(F.bool_and(c), F.lit(True))
    return sets.agg((every(F.col("applied") | F.col("errored")) & ~F.coalesce(F.bool_or("timed_out"), F.lit(False))).alias("may_finalize"), (every(F.col("applied")) & (F.count("*") > 0)).alias("ready"))


def batch_reply_matches(sent: DataFrame, reply: DataFrame) -> DataFrame:
    """request_id, matches: the reply names the same sets as the request, each once. Both: request_id, query_set_id."""
    ids = lambda df, name: df.groupBy("request_id").agg(F.array_sort(F.collect_list("query_set_id")).alias(name))
    both = ids(sent, "asked").join(ids(reply, "told"), "request_id", "full_outer")
    return both.select("request_id", F.coalesce((F.col("asked") == F.col("told")) & (F.size(F.array_distinct("told")) == F.size("told")), F.lit(False)).alias("matches"))


def owned_or_pending(owners: DataFrame, previous: DataFrame, pk: list[str]) -> DataFrame:
    """Owners now; for keys without any, those of the previous generation."""
    return owners.select(*pk, "query_set_id").unionByName(previous.join(owners.select(*pk).distinct(), pk, "left_anti").select(*pk, "query_set_id"))


def eviction_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("table_name", "cause").agg(F.count("*").alias("evictions"))


def effective_tags(state: DataFrame, owners: DataFrame, previous: DataFrame, tags: DataFrame, set_hashes: DataFrame, pk: str) -> DataFrame:
    """pk as text, qtags: retained tags and those of current and previous owners, for rows that are there."""
    owned = owners.unionByName(previous).join(set_hashes, "query_set_id").select(pk, "query_hash")
    every = tags.select(pk, "query_hash").unionByName(owned).join(state.select(pk), pk, "left_semi")
    return every.groupBy(F.col(pk).cast("string").alias("pk")).agg(F.array_sort(F.collect_set("query_hash")).alias("qtags"))


def load_tags(state: DataFrame, stored: DataFrame, pk: str) -> DataFrame:
    """Stored tags (pk as text, qtags) of keys that are there; null tags are left out."""
    rows = stored.select("pk", F.explode("qtags").alias("query_hash")).where("query_hash is not null")
    return state.select(pk).join(rows, F.col(pk).cast("string") == F.col("pk")).select(pk, "query_hash").distinct()
