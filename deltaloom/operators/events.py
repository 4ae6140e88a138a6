"""Change-event streams: context and causes, calls matched with results, histories of a value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def with_context(changes: DataFrame, me: str) -> DataFrame:
    """is_mine: optimistic, or caused by a call of this connection; changes: cause, caller, optimistic."""
    mine = F.col("optimistic") | F.coalesce((F.col("cause") == "call") & (F.col("caller") == me), F.lit(False))
    return changes.withColumn("is_mine", mine).withColumn("is_optimistic", F.col("optimistic"))


def external_confirmed(changes: DataFrame) -> DataFrame:
    return changes.where("not is_mine and not is_optimistic")


def event_cause(kind: str = "message", optimistic: str = "optimistic", name: str = "name") -> Column:
    """optimistic, snapshot, call (a result whose call is known) or remote."""
    return F.when(F.col(optimistic), "optimistic").when(F.col(kind) == "snapshot", "snapshot").when((F.col(kind) == "result") & F.col(name).isNotNull(), "call").otherwise("remote")


def earliest(results: DataFrame) -> DataFrame:
    """Each request's first row by result_ts, ties by the other columns that can be ordered."""
    order = ["result_ts", *(f.name for f in results.schema.fields if f.name not in ("request_id", "result_ts") and f.dataType.typeName() not in ("map", "variant"))]
    return results.groupBy("request_id").agg(F.min_by(F.struct(*results.columns), F.struct(*order)).alias("r")).select("r.*")


def match_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Each request's first result with its call; a result without one has a null name and a remote cause.

    Of results of one time the least one by its other columns is the first."""
    first = earliest(results)
    out = first.join(calls, "request_id", "left")
    return out.withColumn("cause", F.when(F.col("name").isNull(), "remote").otherwise("call"))


def result_outcome(tag: Column, returned: Column, error: str) -> Column:
    """struct<status, returned, message>: a failure has its text, a return of no bytes is null, others keep theirs.

    tag: outcome tags 0 to 3; returned: the bytes of a return; error: name of the column of a failure's bytes.
    """
    status = F.when(tag == 0, "committed").when(tag == 1, "committed_empty").when(tag == 2, "failed").when(tag == 3, "internal_error")
    kept = F.when((tag == 0) & (F.length(returned) > 0), returned)
    return F.struct(status.alias("status"), kept.alias("returned"), F.when(tag.isin(2, 3), error_text(error)).alias("message"))


def result_status(tag: str = "outcome") -> Column:
    """Outcome tags 0 to 3."""
    return F.when(F.col(tag) == 0, "committed").when(F.col(tag) == 1, "committed_empty").when(F.col(tag) == 2, "failed").when(F.col(tag) == 3, "internal_error")


def error_text(raw: str) -> Column:
    """UTF-8 text of a result's bytes; a little-endian length before it is stripped where it matches."""
    body = F.expr(f"substring({raw}, 5)")
    size = F.expr(f"cast(conv(concat(substring(hex({raw}),7,2),substring(hex({raw}),5,2),substring(hex({raw}),3,2),substring(hex({raw}),1,2)),16,10) as bigint)")
    return F.when((F.length(raw) >= 4) & (size == F.length(raw) - 4), F.decode(body, "UTF-8")).otherwise(F.decode(F.col(raw), "UTF-8"))


def call_timeouts(calls: DataFrame, results: DataFrame, after: str = "10 seconds") -> DataFrame:
    """Calls without a result within the limit; with watermarks on both sides the same join runs on streams."""
    r = results.select(F.col("request_id").alias("r_id"), "result_ts")
    match = (F.col("request_id") == F.col("r_id")) & (F.col("result_ts") >= F.col("call_ts")) & (F.col("result_ts") <= F.col("call_ts") + F.expr(f"interval {after}"))
    return calls.join(r, match, "left_outer").where("r_id is null").select(*calls.columns)


def calls_failed_by_disconnect(calls: DataFrame, results: DataFrame, drops: DataFrame, connection: str) -> DataFrame:
    """Calls that were pending when their connection was next lost: request_id, drop_ts.

    The earliest drop at or after a call comes from one pass over calls and drops in order of time.
    """
    both = calls.select(connection, F.col("call_ts").alias("ts"), F.lit(0).alias("side"), "request_id").unionByName(drops.select(connection, F.col("drop_ts").alias("ts"), F.lit(1).alias("side"), F.lit(None).cast("long").alias("request_id")))
    later = Window.partitionBy(connection).orderBy(F.desc("ts"), F.desc("side")).rowsBetween(Window.unboundedPreceding, 0)
    dropped = both.withColumn("drop_ts", F.last(F.when(F.col("side") == 1, F.col("ts")), ignorenulls=True).over(later)).where("side = 0 and drop_ts is not null")
    first = results.groupBy("request_id").agg(F.min("result_ts").alias("result_ts"))
    return dropped.join(first, "request_id", "left").where("result_ts is null or result_ts > drop_ts").select("request_id", "drop_ts")


def procedure_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    return calls.join(results, "request_id").withColumn("status", F.when(F.col("outcome") == 3, "internal_error").otherwise("returned"))


def calls_by_name(matched: DataFrame, name: str) -> DataFrame:
    return matched.where((F.col("name") == name) & (F.col("cause") == "call"))


def first_matching(history: DataFrame, key: list[str], predicate: Column) -> DataFrame:
    """Each key's first value that satisfies the predicate; history: key, seq, value."""
    return history.where(predicate).groupBy(*key).agg(F.min("seq").alias("seq"), F.min_by("value", "seq").alias("value"))


def next_change(history: DataFrame, key: list[str], after: int) -> DataFrame:
    return first_matching(history, key, F.col("seq") > after)


def state_then_changes(history: DataFrame, key: list[str], at: int) -> DataFrame:
    """Each key's value at a point, then every later change."""
    now = history.where(F.col("seq") <= at).groupBy(*key).agg(F.max("seq").alias("seq"), F.max_by("value", "seq").alias("value"))
    return now.unionByName(history.where(F.col("seq") > at).select(*key, "seq", "value"))


def distinct_until_changed(history: DataFrame, key: list[str]) -> DataFrame:
    order = Window.partitionBy(*key).orderBy("seq")
    return history.withColumn("_n", F.row_number().over(order)).withColumn("_p", F.lag("value").over(order)).where((F.col("_n") == 1) | ~F.col("value").eqNullSafe(F.col("_p"))).drop("_n", "_p")


def latest_state(log: DataFrame, key: list[str]) -> DataFrame:
    """Each key's last row unless it is a delete; log: key, seq, op and other columns."""
    last = log.groupBy(*key).agg(F.max_by(F.struct(*log.columns), "seq").alias("r")).select("r.*")
    return last.where("op <> 'delete'")


def changes_after(history: DataFrame, at: int) -> DataFrame:
    """What a listener that comes late gets: nothing that happened up to then."""
    return history.where(F.col("seq") > at)


def late_snapshots(replies: DataFrame, timed_out: DataFrame) -> DataFrame:
    """Each timed-out request's first reply, which is still applied once; replies to anything else are rejected.

    replies: request_id, result_ts and others; timed_out: request_id.
    """
    known = replies.join(timed_out.select("request_id").distinct(), "request_id", "left_semi")
    return earliest(known.select(*replies.columns))
