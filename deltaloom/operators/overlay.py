"""Pending writes over committed state, and the queue of mutations that they come from.

overlay: seq (order of mutations), change_no, request_id, kind ('insert', 'update', 'delete'), pk columns, old and new
(structs of the table's columns). mutations: seq, request_id, created_at, changes (array of structs with kind).
What is visible is derived from committed rows and overlay, so that a rollback is a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deltaloom.sources.scratch import written

from . import scans
from .changes import apply_changes, rows_equal_deep


def visible_state(state: DataFrame, overlay: DataFrame, pk: list[str] | None) -> DataFrame:
    """Each key's newest pending row, else its committed row; an update of a row that isn't there shows nothing.

    A table without a key shows its committed rows and all pending inserts.
    """
    columns = state.columns
    if not pk:
        return state.unionByName(overlay.where("kind = 'insert' and new is not null").select("new.*").select(*columns))
    newest = overlay.groupBy(*pk).agg(F.max_by(F.struct("kind", "new"), F.struct("seq", "change_no")).alias("w"), F.bool_or(F.col("kind") == "insert").alias("inserted"))
    both = state.select(*pk, F.struct(*columns).alias("base")).join(newest, pk, "full_outer")
    shown = F.when(F.col("w").isNull(), F.col("base")).when((F.col("w.kind") == "insert") | ((F.col("w.kind") == "update") & (F.col("base").isNotNull() | F.col("inserted"))), F.col("w.new"))
    return both.select(shown.alias("row")).where("row is not null").select("row.*")


def protected_keys(overlay: DataFrame, pk: list[str]) -> DataFrame:
    return overlay.select(*pk).distinct()


def confirm_by_touch(overlay: DataFrame, request_id, touched: DataFrame, pk: list[str]) -> DataFrame:
    """The request's entries with confirmed: whether the commit touched their key; others are rolled back."""
    mine = overlay.where(F.col("request_id") == request_id)
    return mine.join(touched.select(*pk).distinct().withColumn("confirmed", F.lit(True)), pk, "left").withColumn("confirmed", F.coalesce("confirmed", F.lit(False)))


def rollback(overlay: DataFrame, request_id) -> DataFrame:
    return overlay.where(F.col("request_id") != request_id)


def committed_under_overlay(state: DataFrame, log: DataFrame, pk: list[str]) -> DataFrame:
    """Server changes go to the committed layer, pending or not; the overlay goes on hiding them."""
    return apply_changes(state, log, pk)


def confirm_own_commit(overlay: DataFrame, request_id, touched: DataFrame, owners: DataFrame, pk: list[str], empty_result: bool = False, durably_queued: bool = False, skipped_covered: bool = False) -> DataFrame:
    """pk, outcome of the request's entries once its own commit has arrived.

    pending: another request still has the key; promote: the predicted row becomes committed; retain: kept without an
    owner (the result was empty and the request is durably queued); drop: an insert that the commit neither touched
    nor any set owns, unless the only update came from an unregistered set of a covered table.
    """
    mine = overlay.where(F.col("request_id") == request_id).groupBy(*pk).agg(F.bool_or(F.col("kind") == "insert").alias("insert"))
    flag = lambda df, name: df.select(*pk).distinct().withColumn(name, F.lit(True))
    for df, name in ((rollback(overlay, request_id), "pending"), (touched, "touched"), (owners, "owned")):
        mine = mine.join(flag(df, name), pk, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    unowned = F.col("insert") & ~F.col("owned")
    outcome = F.when(F.col("pending"), "pending")
    if empty_result:
        outcome = outcome.when(unowned & F.lit(durably_queued), "retain")
    elif not skipped_covered:
        outcome = outcome.when(unowned & ~F.col("touched"), "drop")
    return mine.select(*pk, outcome.otherwise("promote").alias("outcome"))


def retained_unowned(inserts: DataFrame, owners: DataFrame, pk: list[str]) -> DataFrame:
    return inserts.join(owners.select(*pk), pk, "left_anti")


def committed_only(state: DataFrame, pending_inserts: DataFrame | None, pending_requests: DataFrame | None = None) -> DataFrame:
    """Rows to persist: without pending and retained inserts by content, one occurrence each; without any, none is grouped.

    Rows of a table without a key carry the request that inserted them (request_id, null for the server's): those of
    pending_requests go first, whatever their content, and request_id is not persisted.
    """
    if pending_requests is not None:
        own = [c for c in state.columns if c != "request_id"]
        # joined by their request, all rows of the server, which have none, would meet in one task
        sent = state.where("request_id is not null").join(pending_requests.select("request_id").distinct(), "request_id", "left_anti")
        state = state.where("request_id is null").select(*own).unionByName(sent.select(*own))
    return state if pending_inserts is None else state.exceptAll(pending_inserts.select(*state.columns))


def overlay_events(state: DataFrame, overlay: DataFrame, pk: list[str]) -> DataFrame:
    """seq, change_no, pk, kind, old, new, is_optimistic: the events that pending writes tell when they are made.

    old is the row that the write replaces: the newest earlier pending row of its key, else the committed one; an
    insert has none, a delete has no new one.
    """
    base = state.select(*pk, F.struct(*state.columns).alias("base"))
    order = Window.partitionBy(*pk).orderBy("seq", "change_no")
    rows = overlay.join(base, pk, "left").withColumn("_n", F.row_number().over(order)).withColumn("_old", F.when(F.col("_n") == 1, F.col("base")).otherwise(F.lag("new").over(order)))
    old, new = F.when(F.col("kind") != "insert", F.col("_old")), F.when(F.col("kind") != "delete", F.col("new"))
    return rows.select("seq", "change_no", *pk, "kind", old.alias("old"), new.alias("new"), F.lit(True).alias("is_optimistic"))


def overlay_inserts(overlay: DataFrame) -> DataFrame:
    return overlay.where("kind = 'insert'")


def pending_request_ids(overlay: DataFrame) -> DataFrame:
    return overlay.select("request_id").distinct()


def entries_for_key(overlay: DataFrame, **key) -> DataFrame:
    for c, v in key.items():
        overlay = overlay.where(F.col(c) == v)
    return overlay.orderBy("seq", "change_no")


def confirmed_keys(confirmations: DataFrame, resolved: DataFrame, pk: list[str]) -> DataFrame:
    """request_id, pk of overlay entries whose confirmation still tells something: those of requests not yet resolved.

    confirmations: request_id, pk of entries that confirm_own_commit or confirm_by_touch took off the overlay, as logged;
    resolved: request_id of mutations that left the queue, with which their log expires.
    """
    return confirmations.select("request_id", *pk).distinct().join(resolved.select("request_id"), "request_id", "left_anti")


def mutation_landed(changes: DataFrame, state: DataFrame, owners: DataFrame, overlay: DataFrame, pk: list[str], overlay_is_proof: bool = False, confirmed: DataFrame | None = None) -> DataFrame:
    """request_id, outcome of timed-out mutations: landed, not_landed or undetectable.

    changes: request_id, subscribed, kind (null: a mutation without changes), pk, new. An insert has landed if its key
    is owned, an update if the row equals new, a delete if the row is gone. An update or delete tells nothing where the
    key is still overlaid, or where the request's own overlay on it was confirmed (see confirmed_keys): what is seen is
    then its prediction. overlay_is_proof takes both as proof.
    """
    row = state.select(*pk, F.struct(*state.columns).alias("row"))
    flag = lambda df, name: df.select(*pk).distinct().withColumn(name, F.lit(True))
    x = changes.join(row, pk, "left").join(flag(owners, "owned"), pk, "left").join(flag(overlay, "hidden"), pk, "left")
    hidden = F.coalesce("hidden", F.lit(False))
    if confirmed is not None:
        x = x.join(confirmed.select("request_id", *pk).distinct().withColumn("confirmed", F.lit(True)), ["request_id", *pk], "left")
        hidden = hidden | F.coalesce("confirmed", F.lit(False))
    hidden = F.lit(False) if overlay_is_proof else hidden
    unclear = F.col("kind").isNull() | ~F.col("subscribed") | (F.col("kind").isin("update", "delete") & hidden) | ((F.col("kind") == "update") & F.col("row").isNull())
    there = F.when(F.col("kind") == "insert", F.coalesce("owned", F.lit(False))).when(F.col("kind") == "delete", F.col("row").isNull()).otherwise(rows_equal_deep(F.col("row"), F.col("new"), row.schema["row"].dataType))
    out = x.groupBy("request_id").agg(F.bool_or(F.coalesce(unclear, F.lit(True))).alias("unclear"), F.bool_and(there).alias("landed"))
    return out.select("request_id", F.when(F.col("unclear"), "undetectable").when(F.col("landed"), "landed").otherwise("not_landed").alias("outcome"))


def pure_insert(mutations: DataFrame) -> DataFrame:
    return mutations.withColumn("pure_insert", F.coalesce((F.size("changes") > 0) & F.forall("changes", lambda c: c["kind"] == "insert"), F.lit(False)))


def expire(mutations: DataFrame, max_age: str, now) -> DataFrame:
    """Mutations with expired: queued for longer than max_age (an interval, like '1 hour')."""
    return mutations.withColumn("expired", F.lit(now).cast("timestamp") - F.col("created_at") > F.expr(f"interval '{max_age}'" if not max_age.startswith("interval") else max_age))


def bound_queue(mutations: DataFrame, most: int, strategy: str) -> DataFrame:
    """Mutations with kept: reject_new keeps the first, drop_oldest the last `most` in order of arrival.

    The place of the cut comes from a top-k of seq, not from sorting the queue in one task.
    """
    if strategy not in ("reject_new", "drop_oldest"):
        raise ValueError(f"unknown strategy {strategy}")
    first = strategy == "reject_new"
    edge = mutations.select("seq").orderBy(F.col("seq") if first else F.desc("seq")).limit(most).agg((F.max if first else F.min)("seq").alias("edge"))
    kept = (F.col("seq") <= F.col("edge")) if first else (F.col("seq") >= F.col("edge"))
    return mutations.withColumn("_k", F.lit(1)).join(F.broadcast(edge.withColumn("_k", F.lit(1))), "_k").withColumn("kept", F.coalesce(kept, F.lit(False))).drop("_k", "edge")


def veto(mutations: DataFrame, predicate: Column) -> DataFrame:
    """Mutations that the predicate accepts; where it is null or fails, a mutation stays.

    The predicate is resolved without ANSI mode, so that a cast, a division or an index that fails is null and not the
    end of the job; what raises an error of its own accord still does.
    """
    conf, name = mutations.sparkSession.conf, "spark.sql.ansi.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return mutations.where(F.coalesce(predicate, F.lit(True)))
    finally:
        conf.set(name, before)


#: Rounds by keys before chains are doubled.
PLAIN_ROUNDS = 3


def _waiting_after(links: DataFrame, awaited: DataFrame, held: DataFrame) -> DataFrame:
    """seq of mutations with a key that is awaited, or that an earlier one of held has: all later ones of a key at once."""
    since = links.join(held, "seq", "left_semi").groupBy("key").agg(F.min("seq").alias("since"))
    since = since.join(awaited.withColumn("awaited", F.lit(True)), "key", "full_outer")
    return links.join(since, "key").where(F.coalesce("awaited", F.lit(False)) | (F.col("seq") > F.col("since"))).select("seq").distinct()


def _nearest(links: DataFrame) -> DataFrame:
    """seq -> to, the nearest later mutation that shares a key with it, from blocks of (key, seq)."""
    blocks = scans.cut(links, ["key"], ["seq"])
    return scans.following(blocks, ["key"], ["seq"], "to", "seq").where("to is not null").groupBy("seq").agg(F.min("to").alias("to"))


def _jumps(links: DataFrame) -> list[DataFrame]:
    """Jumps of 1, 2, 4, ... nearest later mutations, as long as there are any."""
    jumps = [written(_nearest(links), "jumps")]
    while True:
        a, b = jumps[-1].alias("a"), jumps[-1].alias("b")
        twice = written(a.join(b, F.col("a.to") == F.col("b.seq")).select("a.seq", "b.to"), "jumps")
        if not twice.limit(1).count():
            return jumps
        jumps.append(twice)


def held_mutations(mutations: DataFrame, awaited: DataFrame, plain_rounds: int = PLAIN_ROUNDS) -> DataFrame:
    """seq of mutations that wait: in queue order, one that shares a key with an awaited or a waiting one waits.

    mutations: seq, keys (array of text, null: unknown). awaited: key. One with unknown keys waits if anything before it
    waits or anything is awaited, and then all later ones do. A round marks all later mutations of every key that is
    waited for. Where rounds go on, along a chain from key to key, jumps of doubling length to the nearest later mutation
    that shares a key mark whole chains: from the longest to the shortest, each adds what those marked so far jump to, so
    that a chain takes as many rounds as its length has binary digits.
    """
    unknown = mutations.where("keys is null").select("seq")
    links = written(mutations.select("seq", F.explode("keys").alias("key")).distinct(), "links")
    awaited = awaited.select("key").where("key is not null").distinct()
    held, known, jumps, rounds = links.select("seq").where("false"), 0, None, 0
    while True:  # ends: held only grows
        held = written(_waiting_after(links, awaited, held), "held")
        if (now := held.count()) == known:
            break
        known, rounds = now, rounds + 1
        if rounds > plain_rounds:
            jumps = _jumps(links) if jumps is None else jumps
            for jump in reversed(jumps):
                held = written(held.unionByName(jump.join(held, "seq", "left_semi").select(F.col("to").alias("seq"))).distinct(), "held")
    first_held = held.agg(F.min("seq")).first()[0]
    awaits = awaited.limit(1).count() > 0
    cut = unknown if awaits else unknown.where(F.col("seq") > first_held) if first_held is not None else unknown.where(F.lit(False))
    first_unknown = cut.agg(F.min("seq")).first()[0]
    if first_unknown is None:
        return held
    return held.unionByName(mutations.where(F.col("seq") >= first_unknown).select("seq")).distinct()


def unowned_awaits(inserts: DataFrame, owners: DataFrame, pk: list[str]) -> DataFrame:
    """Inserted keys without an owner yet."""
    return inserts.join(owners.select(*pk), pk, "left_anti")


def release_owned(inserts: DataFrame, owners: DataFrame, pk: list[str]) -> DataFrame:
    """request_id of requests whose last awaited key has an owner."""
    owned = owners.select(*pk).distinct().withColumn("owned", F.lit(True))
    return inserts.join(owned, pk, "left").groupBy("request_id").agg(F.bool_and(F.coalesce("owned", F.lit(False))).alias("all")).where("all").select("request_id")


def replay_action(attempts: DataFrame) -> DataFrame:
    """action and stop of replayed mutations, and whether each was attempted before the pass stopped.

    attempts: seq, outcome (success, rejected, aborted, timeout, storage_error, network_error), landed (landed, ...),
    pure_insert, rechecks.
    """
    landed = F.coalesce(F.col("landed") == "landed", F.lit(False))
    action = (
        F.when(F.col("outcome") == "success", "confirm")
        .when(F.col("outcome") == "rejected", "fail")
        .when((F.col("outcome") == "aborted") & landed, "confirm")
        .when((F.col("outcome") == "aborted") & F.col("pure_insert") & (F.col("rechecks") < 3), "keep")
        .when(F.col("outcome") == "aborted", "fail")
        .when((F.col("outcome") == "timeout") & landed, "confirm")
        .otherwise("keep")
    )
    stop = ((F.col("outcome") == "timeout") & ~landed) | F.col("outcome").isin("storage_error", "network_error")
    out = attempts.withColumn("action", action).withColumn("stop", stop)
    first = out.agg(F.min(F.when(F.col("stop"), F.col("seq"))).alias("first")).withColumn("_k", F.lit(1))
    return out.withColumn("_k", F.lit(1)).join(F.broadcast(first), "_k").withColumn("attempted", F.col("first").isNull() | (F.col("seq") <= F.col("first"))).drop("_k", "first")


def recent_failures(results: DataFrame, most: int, earlier: DataFrame | None = None, queue: DataFrame | None = None) -> DataFrame:
    """The last failures by seq, at most `most`, each with failed_count, the number of all of them.

    results: those of the last pass. earlier: failures from before it. queue: what is left; a pass without failures that
    leaves it empty clears the earlier ones.
    """
    now = results.where("not success")
    failed = now if earlier is None else earlier.unionByName(now)
    total = failed.agg(F.count("*").alias("failed_count")).withColumn("_k", F.lit(1))
    last = failed.orderBy(F.desc("seq")).limit(most).withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k")
    if queue is not None:
        left = queue.limit(1).select(F.lit(1).alias("_k")).unionByName(now.limit(1).select(F.lit(1).alias("_k"))).distinct()
        last = last.join(F.broadcast(left), "_k", "left_semi")  # a row at most
    return last.drop("_k")


def sync_state(queue: DataFrame, results: DataFrame, failed_before: int = 0, connected: bool = True) -> DataFrame:
    """One row: status, pending_count, failed_count, last_sync_at, has_pending, has_error.

    results: those of the last pass. Its failures add to failed_before; a pass without any sets the count to 0 if it
    left the queue empty. What is left waits for a retry while there is a connection, else the queue is idle.
    """
    q = queue.agg(F.count("*").alias("pending_count"), F.count_if("in_flight").alias("in_flight")).withColumn("_k", F.lit(1))
    r = results.agg(F.count_if(~F.col("success")).alias("failed"), F.max("finished_at").alias("last_sync_at")).withColumn("_k", F.lit(1))
    status = F.when(F.col("in_flight") > 0, "syncing").when((F.col("pending_count") > 0) & F.lit(connected), "waiting").otherwise("idle")
    failed = F.when(F.col("failed") > 0, F.col("failed") + failed_before).when(F.col("pending_count") == 0, 0).otherwise(failed_before).cast("long")
    return q.join(r, "_k").select(status.alias("status"), "pending_count", failed.alias("failed_count"), "last_sync_at", (F.col("pending_count") > 0).alias("has_pending"), (failed > 0).alias("has_error"))


def next_retry_at(queue: DataFrame) -> DataFrame:
    """retry_at: 5 seconds doubled for each attempt, a minute at most, after last_attempt_at."""
    delay = F.least(F.lit(60), F.lit(5) * F.pow(F.lit(2), F.least(F.col("attempt"), F.lit(4)))).cast("long")
    return queue.withColumn("delay_s", delay).withColumn("retry_at", F.timestamp_seconds(F.unix_micros("last_attempt_at") / 1e6 + F.col("delay_s")))


def temp_ids(rows: DataFrame, name: str) -> DataFrame:
    """Negative ids, distinct, that can't meet assigned positive ones."""
    return rows.withColumn(name, -(F.monotonically_increasing_id() + 1))


def parse_changes(lines: DataFrame, row: str) -> DataFrame:
    """JSON changes -> kind, old, new, valid: an insert needs new, an update both, a delete old."""
    schema = f"type string, oldRowJson {row}, newRowJson {row}"
    parsed = lines.withColumn("c", F.from_json("json", schema))
    has = lambda c: F.col(f"c.{c}").isNotNull()
    valid = F.when(F.col("c.type") == "insert", has("newRowJson")).when(F.col("c.type") == "update", has("oldRowJson") & has("newRowJson")).when(F.col("c.type") == "delete", has("oldRowJson"))
    return parsed.select(*lines.columns, F.col("c.type").alias("kind"), F.col("c.oldRowJson").alias("old"), F.col("c.newRowJson").alias("new"), F.coalesce(valid, F.lit(False)).alias("valid"))
