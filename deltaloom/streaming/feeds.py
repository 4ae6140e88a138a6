"""Structured Streaming forms of the stateful operators."""

from __future__ import annotations

import json
import time
import uuid
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from deltaloom.operators import ownership
from deltaloom.operators.changes import keyed, row_columns, step
from deltaloom.sources.tables import files_of, replace_text, text_of

from .held import HeldState

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_change_stream(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).parquet(path)


def event_table_append(stream: DataFrame) -> DataFrame:
    """Event rows pass as inserts and leave no state."""
    return stream.withColumn("kind", F.lit("insert"))


def latest(stream: DataFrame, key: list[str]) -> DataFrame:
    """Held state for each key; rows whose last operation is a delete are marked by op."""
    return stream.groupBy(*key).agg(F.max_by(F.struct(*stream.columns), "txn").alias("row"))


#: Parts that the keys of a stream are dealt into. A stream's checkpoint holds for one number of them.
PARTS = 1024
#: Bytes of rows that a task deals by part at once.
PACK = 2**25


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    """rows by _part, a hash of their key: the group of many keys whose states are read and written together.

    Rows without a key are part -1, with 0 for it, so that keys stay whole numbers in pandas.
    """
    part = F.when(F.col("key").isNull(), -1).otherwise(F.pmod(F.hash("key"), F.lit(parts)))
    return rows.withColumns({"_part": part, "key": F.coalesce("key", F.lit(0).cast("long"))})


def _pack(batches):
    """Rows with their _part -> one row for each part of PACK bytes of them: what Spark sends row by row costs Python more than its step."""
    rows, size = [], 0
    for batch in batches:
        rows.append(batch)
        size += batch.nbytes
        if size >= PACK:
            yield from _by_part(rows)
            rows, size = [], 0
    yield from _by_part(rows)


def _by_part(batches):
    if not sum(batch.num_rows for batch in batches):
        return
    table = pa.Table.from_batches(batches)
    part = table["_part"].to_numpy()
    order = np.argsort(part, kind="stable")
    part, table = part[order], table.drop_columns(["_part"]).combine_chunks().take(order)
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    packs = []
    for low, high in pairwise(edges):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table.slice(low, high - low))
        packs.append(sink.getvalue().to_pybytes())
    yield pa.RecordBatch.from_arrays([pa.array(part[edges[:-1]], pa.int32()), pa.array(packs, pa.binary())], ["_part", "rows"])


def _packed(rows: DataFrame, parts: int):
    """rows grouped by _part, those of a task and a part packed as an Arrow stream; _unpacked reads them."""
    return _dealt(rows, parts).mapInArrow(_pack, "_part int, rows binary").groupBy("_part")


def _unpacked(frames) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(pack).read_all() for frame in frames for pack in frame["rows"]]).combine_chunks()


def _coded(texts: pa.ChunkedArray) -> tuple[np.ndarray, list]:
    """Texts as places in a list of different ones, null as -1."""
    coded = texts.combine_chunks().dictionary_encode()
    return coded.indices.fill_null(-1).to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it; the first one does."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def _moved(key: np.ndarray, first: np.ndarray, differs: np.ndarray) -> np.ndarray:
    """Places of the last rows of keys that have a row that differs."""
    starts = np.flatnonzero(first)
    some = np.logical_or.reduceat(differs, starts) if len(starts) else np.zeros(0, bool)
    return np.append(starts[1:], len(key))[: len(starts)][some] - 1


def _before(now: np.ndarray, first: np.ndarray, held: list) -> np.ndarray:
    """Each row's code before it: that of the row before, or of its key's state for a key's first row."""
    before = np.empty_like(now)
    before[1:] = now[:-1]
    before[first] = held
    return before


def _values(frame: pd.DataFrame, *columns: str):
    """Rows of plain values, null as None."""
    return zip(*(frame[c].astype(object).where(frame[c].notna(), None).tolist() for c in columns), strict=True)


class _Keys(StatefulProcessor):
    """A part's keys with their states, as a log of JSON texts [[key, state], ...]: a key's last state holds, null: none.

    What changed is appended, and MOST texts become those of all keys.
    """

    MOST, KEYS = 16, 10_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.log = handle.getListState("log", "entries string")

    def read(self) -> dict:
        held, self.texts = {}, 0
        for (text,) in self.log.get():
            held.update(json.loads(text))
            self.texts += 1
        return held

    def write(self, held: dict, changed) -> None:
        entries = [(k, held[k]) for k in changed]
        if self.texts + len(entries) / self.KEYS >= self.MOST + 2 * len(held) / self.KEYS:
            self.log.clear()
            entries = [e for e in held.items() if e[1] is not None]
        for k in range(0, len(entries), self.KEYS):
            self.log.appendValue((json.dumps(entries[k : k + self.KEYS]),))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        held = self.read()
        self.write(held, self.start(held, initialState))

    def handleInputRows(self, key, rows, timerValues):
        held = self.read()
        told, changed = self.step(held, _unpacked(rows))
        self.write(held, changed)
        if len(told):
            yield told.assign(key=None) if key[0] < 0 else told

    def close(self) -> None:
        pass


class _Apply(_Keys):
    """Holds keys' rows as JSON texts; tells insert, update or delete against them; a delete clears a key's state."""

    def start(self, held, initial):
        for k, row, upto in _values(initial, "key", "row", "upto"):
            held[k] = (row if row is not None else (held.get(k) or (None,))[0], int(upto))
        return initial["key"].unique().tolist()

    def states(self, held, key):
        first = _starts(key)
        return first, [held.get(k) or (None, None) for k in key[first].tolist()]

    def step(self, held, rows):
        key, txn, step = (rows[c].to_numpy() for c in ("key", "txn", "step"))
        row, texts = _coded(rows["row"])
        order = np.lexsort((step, txn, key))
        key, txn, row = key[order], txn[order], row[order]
        last = np.append(_starts(key, txn)[1:], True)
        key, txn, row = key[last], txn[last], row[last]
        first, states = self.states(held, key)
        if any(upto is not None for _, upto in states):
            n = np.diff(np.flatnonzero(np.append(first, True)))
            unseen = np.repeat([upto is None for _, upto in states], n) | (txn > np.repeat(np.array([upto or 0 for _, upto in states]), n))
            key, txn, row = key[unseen], txn[unseen], row[unseen]
            first, states = self.states(held, key)
        code = {text: k for k, text in enumerate(texts)}
        before = _before(row, first, [-1 if text is None else code.setdefault(text, len(code)) for text, _ in states])
        differs, texts = before != row, np.array([*code, None], object)  # -1 is the last one
        moved = _moved(key, first, differs)
        for k, text in zip(key[moved].tolist(), texts[row[moved]].tolist(), strict=True):
            upto = (held.get(k) or (None, None))[1]
            held[k] = None if text is None and upto is None else (text, upto)
        old, new = before[differs], row[differs]
        kind = np.where(old < 0, "insert", np.where(new < 0, "delete", "update")).astype(object)
        return pd.DataFrame({"key": key[differs], "txn": txn[differs], "kind": kind, "old": texts[old], "new": texts[new]}), key[moved].tolist()


TOLD_EVENTS = "key long, txn long, kind string, old string, new string"


def keyed_events(stream: DataFrame, initial: DataFrame | None = None, parts: int = PARTS) -> DataFrame:
    """key long, txn, op, row (JSON text) -> events against each key's held row; needs the RocksDB state store.

    initial: key, row, upto: a snapshot's rows, each with the last txn that it has seen; what a stream repeats up to there
    is left out, key by key. A micro-batch reads and writes the states of the parts that its keys are in.
    """
    new = F.when(F.col("op") == "insert", F.col("row"))
    stepped = stream.where("txn is not null").select("key", F.col("txn").cast("long").alias("txn"), step().cast("byte").alias("step"), new.alias("row"))
    first = None if initial is None else _dealt(initial, parts).groupBy("_part")
    return _packed(stepped, parts).transformWithStateInPandas(_Apply(), TOLD_EVENTS, "Append", "None", initialState=first)


def state_then_changes(stream: DataFrame, snapshot: DataFrame, upto: int, path: str):
    """A writer under path of each key's row at a point, then every later change of it, without gap or repeat.

    snapshot: key, row (JSON text) of all transactions up to upto; stream: key, txn, op, row from any point up to there
    on. The snapshot is path/batch=-1 with kind state; later batches have the events that their rows are against it, so
    a stream that goes back behind the snapshot tells nothing twice. Keys that the snapshot lacks start from nothing.
    It is computed once: the stream starts from what was told, also after a failure before its first batch.
    """
    told = f"{path}/batch=-1"
    if not _written(stream.sparkSession, told):
        _once(snapshot.select("key", F.lit(upto).cast("long").alias("txn"), F.lit("state").alias("kind"), F.lit(None).cast("string").alias("old"), F.col("row").alias("new")), told)
    rows = stream.sparkSession.read.schema(TOLD_EVENTS).parquet(told)
    events = keyed_events(stream.where(F.col("txn") > upto), rows.select("key", F.col("new").alias("row"), F.col("txn").alias("upto")))

    return events.writeStream.foreachBatch(lambda batch, batch_id: _once(batch, f"{path}/batch={batch_id}"))


def late_listener(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str) -> DataFrame:
    """A stream of what batches put under path/batch=N from now on: nothing of those that are there already.

    The point is kept beside the listener's progress in checkpoint, so that after a restart it goes on from there and
    neither loses nor repeats rows. Only folders of later batches are read.
    """
    mark = f"{checkpoint}/listens-from"
    at, files = files_of(spark, mark)
    if not files.exists(at):
        folder, there = files_of(spark, path)
        names = [f.getPath().getName() for f in there.listStatus(folder)] if there.exists(folder) else []
        done = [n for n in names if n.startswith("batch=") and there.exists(files_of(spark, f"{path}/{n}/_SUCCESS")[0])]
        replace_text(spark, mark, str(max((int(n[6:]) for n in done), default=-1)))
    after = int(text_of(spark, mark))
    rows = spark.readStream.schema(T.StructType([*(f for f in schema.fields if f.name != "batch"), T.StructField("batch", T.LongType())])).parquet(path)
    return rows.where(F.col("batch") > after)


class _Changed(_Keys):
    """Holds keys' last values; tells those that differ from the one before."""

    def step(self, held, rows):
        key, unplaced, seq = (rows[c].to_numpy() for c in ("key", "unplaced", "seq"))
        value, texts = _coded(rows["value"])
        order = np.lexsort((seq, unplaced, key))
        key, unplaced, seq, value = (c[order] for c in (key, unplaced, seq, value))
        first = _starts(key)
        code = {text: k for k, text in enumerate(texts)}
        states = [held.get(k) for k in key[first].tolist()]
        before = _before(value, first, [-2 if s is None else -1 if s[0] is None else code.setdefault(s[0], len(code)) for s in states])
        differs, texts = before != value, np.array([*code, None], object)  # -1 is the last one
        moved = _moved(key, first, differs)
        held.update((k, [text]) for k, text in zip(key[moved].tolist(), texts[value[moved]].tolist(), strict=True))
        seq = np.where(unplaced, None, seq) if unplaced.any() else seq
        return pd.DataFrame({"key": key[differs], "seq": seq[differs], "value": texts[value[differs]]}), key[moved].tolist()


def distinct_until_changed(stream: DataFrame, parts: int = PARTS) -> DataFrame:
    """key long, seq, value text -> each key's values that differ from the one before, null a value like others."""
    placed = stream.select("key", F.col("seq").isNull().alias("unplaced"), F.coalesce("seq", F.lit(0)).cast("long").alias("seq"), "value")
    return _packed(placed, parts).transformWithStateInPandas(_Changed(), "key long, seq long, value string", "Append", "None")


class _Own(_Keys):
    """Holds keys' rows (JSON texts) and owners; tells when the first owner comes, the last one goes, the row changes.

    A set that reports the key absent leaves the row as it was before: others still own that one.
    """

    TOLD = ["key", "txn", "query_set_id", "kind", "old", "new"]

    def start(self, held, initial):
        for k, row, sets in _values(initial, "key", "row", "sets"):
            was, owners = held.get(k) or (None, ())
            held[k] = (was if row is None else row, sorted({*owners, *(int(q) for q in (() if sets is None else sets))}))
        return initial["key"].unique().tolist()

    def step(self, held, rows):
        frame = rows.to_pandas()
        if "set_no" not in frame:
            frame["set_no"] = frame["query_set_id"]
        # a set's last insert on a key in a transaction, else one of its deletes
        turn = ["key", "txn", "set_no", "query_set_id"]
        places = [c for c in ("grp", "pos") if c in frame]
        last = frame.assign(_in=frame["op"] == "insert").sort_values([*turn, "_in", *places], kind="stable").drop_duplicates(turn, keep="last")
        out, now = [], {}
        for k, txn, q, inserted, row in _values(last, "key", "txn", "query_set_id", "_in", "row"):
            if k not in now:
                was, sets = held.get(k) or (None, ())
                now[k] = (was, set(sets))
            old, owners = now[k]
            new, before = row if inserted else old, bool(owners)
            (owners.add if inserted else owners.discard)(q)
            now[k] = (new, owners)
            kind = "insert" if owners and not before else "delete" if before and not owners else "update" if owners and new != old else None
            if kind:
                out.append((k, txn, q, kind, None if kind == "insert" else old, None if kind == "delete" else new))
        held.update((k, (row, sorted(owners)) if owners else None) for k, (row, owners) in now.items())
        return pd.DataFrame(out, columns=self.TOLD), now


def owned_key_events(stream: DataFrame, initial: DataFrame | None = None, parts: int = PARTS) -> DataFrame:
    """key long, txn, query_set_id, op, row (JSON text) -> net events of keys under overlapping query sets, with values.

    Sets of a transaction take effect in order of set_no, where there is one, else of query_set_id. initial: key, row,
    sets (those that own it) before the stream. Rows are compared as texts, so to_json is to give all of them. A
    micro-batch reads and writes the states of the parts that its keys are in.
    """
    shape = "key long, txn long, query_set_id long, kind string, old string, new string"
    used = ("key", "txn", "set_no", "grp", "pos", "query_set_id", "op", "row")
    there = stream.select(*(c for c in used if c in stream.columns)).dropna(subset=[c for c in ("txn", "set_no", "query_set_id") if c in stream.columns])
    first = None if initial is None else _dealt(initial, parts).groupBy("_part")
    return _packed(there, parts).transformWithStateInPandas(_Own(), shape, "Append", "None", initialState=first)


class _Dirty(StatefulProcessor):
    """A table's dirty mark: set by its first change, told once its window is over, cleared by a direct write."""

    def __init__(self, window_ms: int):
        self.window_ms = window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.mark = handle.getValueState("mark", "version long, due long")

    def handleInputRows(self, key, rows, timerValues):
        frame = pd.concat(list(rows))
        newest = lambda mark: frame.loc[frame["mark"] == mark, "version"].max()
        dirty, clean = newest("dirty"), newest("clean")
        version, due = self.mark.get() if self.mark.exists() else (None, None)
        if dirty == dirty:  # else there is none
            version = int(dirty) if version is None else max(version, int(dirty))
        if version is not None and clean == clean and clean >= version:
            if due is not None:
                self.handle.deleteTimer(due)
            self.mark.clear()
        elif version is not None:
            if due is None:  # a throttle: later changes don't put the window off
                due = timerValues.getCurrentProcessingTimeInMs() + self.window_ms
                self.handle.registerTimer(due)
            self.mark.update((version, due))
        yield pd.DataFrame(columns=["table_name", "version"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.mark.exists():
            version = self.mark.get()[0]
            self.mark.clear()
            yield pd.DataFrame([(*key, version)], columns=["table_name", "version"])

    def close(self) -> None:
        pass


def snapshot_flushes(marks: DataFrame, every_ms: int = 2000, event_tables: tuple[str, ...] = ()) -> DataFrame:
    """table_name, version, mark ('dirty' or 'clean') -> table_name, version: at most one flush of a table for each window.

    A window starts with the first change of a table that isn't marked yet; a table that was written directly as of the
    newest change is no longer marked. Event tables hold nothing and are never told. Needs the RocksDB state store.
    """
    held = marks.where(~F.col("table_name").isin(*event_tables)) if event_tables else marks
    return held.groupBy("table_name").transformWithStateInPandas(_Dirty(every_ms), "table_name string, version long", "Update", "ProcessingTime")


def write_snapshots(names: list[str], held: HeldState, path: str, name: str) -> None:
    """The whole of each named table as the held state has it now, under path/write=NAME/table_name=T, if it has rows."""
    rows = held.rows().where(F.col("table_name").isin(names)).select("row.*")
    rows.write.mode("overwrite").partitionBy("table_name").parquet(f"{path}/write={name}")
    replace_text(held.spark, f"{path}/log/{name}.json", json.dumps({"tables": names, "at": time.time_ns()}))


def coalesced_snapshot_sink(marks: DataFrame, held: HeldState, path: str, every_ms: int = 2000, event_tables: tuple[str, ...] = ()):
    """A writer of whole snapshots of dirty tables, each at most once for a window.

    marks: the stream of what ordered_apply tells of its batches (its key has table_name), so that a flush finds at
    least the rows that it is due to. The driver holds the names of dirty tables.
    """

    def flush(batch: DataFrame, batch_id: int) -> None:
        names = sorted(r[0] for r in batch.select("table_name").collect())  # once: each action would run the timers again
        if names:
            write_snapshots(names, held, path, f"flush-{batch_id}")

    return snapshot_flushes(marks, every_ms, event_tables).writeStream.outputMode("update").foreachBatch(flush)


def write_now(held: HeldState, table: str, path: str, marks: str) -> None:
    """A direct snapshot of one table, which clears its dirty mark."""
    spark, version, name = held.spark, held.version(), f"direct-{uuid.uuid4().hex}"
    write_snapshots([table], held, path, name)
    clean = spark.range(1).select(F.lit(table).alias("table_name"), F.lit(version).cast("long").alias("version"), F.lit("clean").alias("mark"))
    clean.coalesce(1).write.parquet(f"{marks}/{name}")


def written_snapshots(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """(folder, tables) of the snapshots that were written under path, in order."""
    folder, files = files_of(spark, f"{path}/log")
    names = [f.getPath().getName()[:-5] for f in files.listStatus(folder) if f.getPath().getName().endswith(".json")] if files.exists(folder) else []
    logs = sorted(((json.loads(text_of(spark, f"{path}/log/{n}.json")), n) for n in names), key=lambda x: x[0]["at"])
    return [(f"{path}/write={n}", log["tables"]) for log, n in logs]


def sync_results_sink(stream: DataFrame, path: str, checkpoint: str):
    """Results of mutations (request_id, success, error, ...) published as files by success."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("success").outputMode("append")


def _written(spark: SparkSession, folder: str) -> bool:
    done, files = files_of(spark, f"{folder}/_SUCCESS")
    return files.exists(done)


def _once(rows: DataFrame, folder: str) -> None:
    """Write what a batch tells, unless an earlier attempt at the batch has: its files, once read, stay the same.

    The rows are computed either way, as a stateful stream needs to bring its state up to date."""
    if _written(rows.sparkSession, folder):
        rows.write.format("noop").mode("overwrite").save()
    else:
        rows.write.mode("overwrite").parquet(folder)


def held_rows(spark: SparkSession, path: str, pk: list[str], columns: T.StructType, **options) -> HeldState:
    """The state of ordered_apply under path: each key's row, null where it is gone."""
    keys = [columns[c] for c in pk]
    return HeldState(spark, path, pk, T.StructType([*keys, T.StructField("row", columns)]), "row is not null", **options)


def held_owners(spark: SparkSession, path: str, pk: list[str], columns: T.StructType, **options) -> HeldState:
    """The state of owned_feed under path: each key's row and the query sets that own it."""
    keys = [columns[c] for c in pk]
    return HeldState(spark, path, pk, T.StructType([*keys, T.StructField("row", columns), T.StructField("sets", T.ArrayType(T.IntegerType()))]), "row is not null or size(sets) > 0", **options)


def ordered_apply(stream: DataFrame, path: str, pk: list[str], base: DataFrame, marks: str | None = None, **options):
    """A writer that applies a change log in order of arrival to a held state: batch by batch, by txn within a batch.

    What base holds is there before the first batch. Only the last operation on each key is put, so a batch that runs twice
    counts once. marks: a folder that gets, for each batch, the tables (table_name, a key column) that it changed.
    options: of HeldState.
    """
    columns = row_columns(stream)
    held = held_rows(stream.sparkSession, path, pk, base.select(*columns).schema, **options)

    def put(batch: DataFrame, batch_id: int) -> None:
        if held.version() is None:
            held.start(keyed(base, pk).select(*pk, F.struct(*columns).alias("row")))
        at = [F.col(c) for c in ("set_no", "grp", "pos") if c in batch.columns]
        last = keyed(batch, pk).groupBy(*pk).agg(F.max_by(F.struct("op", F.struct(*columns).alias("row")), F.struct("txn", step().alias("step"), *at)).alias("last"))
        held.put(last.select(*pk, F.when(F.col("last.op") == "insert", F.col("last.row")).alias("row")), batch_id)
        if marks:
            changed = batch.select("table_name").distinct().select("table_name", F.lit(batch_id).cast("long").alias("version"), F.lit("dirty").alias("mark"))
            _once(changed.coalesce(1), f"{marks}/dirty-{batch_id}")

    return stream.writeStream.foreachBatch(put)


def ordered_state(spark: SparkSession, path: str, pk: list[str], base: DataFrame, version: int | None = None) -> DataFrame:
    """base after the batches that ordered_apply has put under path, all of them or those up to version."""
    held = held_rows(spark, path, pk, base.schema)
    return base if held.version() is None else held.rows(version).select("row.*")


def owned_feed(stream: DataFrame, path: str, pk: list[str], state: DataFrame, owners: DataFrame, **options):
    """A writer of the net events of overlapping query sets, each exactly once.

    Rows and owners are held by key under path/held, at first those of state and owners; a batch reads them for the
    buckets of its own keys. It writes path/events/batch=N once and overwrites its version of the held state, so that
    running it again changes nothing. options: of HeldState.
    """
    held = held_owners(stream.sparkSession, f"{path}/held", pk, state.schema, **options)

    def both(rows: DataFrame, sets: DataFrame) -> DataFrame:
        every = sets.groupBy(*pk).agg(F.collect_set(F.col("query_set_id").cast("int")).alias("sets"))
        return rows.select(*pk, F.struct(*state.columns).alias("row")).join(every, pk, "full_outer")

    def put(batch: DataFrame, batch_id: int) -> None:
        if held.version() is None:
            held.start(both(keyed(state, pk), keyed(owners, pk)).withColumn("sets", F.coalesce("sets", F.array().cast("array<int>"))))
        touched = keyed(batch, pk).select(*pk).distinct()
        was = held.of(touched, batch_id)
        before, owned = was.where("row is not null").select("row.*"), was.select(*pk, F.explode("sets").alias("query_set_id"))
        steps = ownership.ownership_steps(before, owned, batch, pk)
        _once(ownership.owned_events(steps, pk), f"{path}/events/batch={batch_id}")
        now = touched.join(both(ownership.state_after(before, steps, pk), ownership.owners_after(steps, pk)), pk, "left")
        held.put(now.withColumn("sets", F.coalesce("sets", F.array().cast("array<int>"))), batch_id)

    return stream.writeStream.foreachBatch(put)


def late_snapshots(replies: DataFrame, timed_out: DataFrame, late: str = "1 minute") -> DataFrame:
    """A stream of replies -> those of timed-out requests, one for each as long as the watermark keeps it in mind."""
    known = replies.join(timed_out.select("request_id").distinct(), "request_id", "left_semi")
    return known.withColumn("result_ts", F.col("result_ts").cast("timestamp")).withWatermark("result_ts", late).dropDuplicatesWithinWatermark(["request_id"])


def changes_sink(stream: DataFrame, path: str, checkpoint: str):
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("kind").outputMode("append")


def drop_stale_generation(log: DataFrame) -> DataFrame:
    """Rows of each connection's newest generation."""
    now = log.groupBy("connection_id").agg(F.max("generation").alias("generation"))
    return log.join(now, ["connection_id", "generation"], "left_semi")


def timed_out_calls(calls: DataFrame, results: DataFrame, after: str = "10 seconds", late: str = "1 minute") -> DataFrame:
    """Streams of calls and results -> calls that no result followed within the limit."""
    c = calls.withColumn("call_ts", F.col("call_ts").cast("timestamp")).withWatermark("call_ts", late)
    r = results.select(F.col("request_id").alias("r_id"), F.col("result_ts").cast("timestamp").alias("result_ts")).withWatermark("result_ts", late)
    match = F.expr(f"request_id = r_id and result_ts >= call_ts and result_ts <= call_ts + interval {after}")
    return c.join(r, match, "left_outer").where("r_id is null").select(*calls.columns)
