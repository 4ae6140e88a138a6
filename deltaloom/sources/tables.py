"""Snapshots, journals and nested transactions as DataFrames."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.operators.overlay import committed_only

JOURNAL = "op string, requestId string, mutation struct<requestId:string,reducerName:string,createdAt:string>, bad string"


def files_of(spark: SparkSession, path: str):
    """A path and its file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def text_of(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    hadoop, files = files_of(spark, path)
    stream = files.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside path and rename it over path: a reader gets the text before or this one."""
    (new, files), (target, _) = files_of(spark, f"{path}.{uuid.uuid4().hex}.new"), files_of(spark, path)
    files.mkdirs(target.getParent())
    out = files.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(options, 1)
    how[0] = options.OVERWRITE
    context.rename(new, target, how)


def read_state(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """A JSON snapshot's rows, and the lines that don't decode; a missing snapshot is empty."""
    hadoop, files = files_of(spark, path)
    if not files.exists(hadoop):
        return spark.createDataFrame([], schema), spark.createDataFrame([], "bad string")
    bad = T.StructField("bad", T.StringType())
    rows = spark.read.text(path).where(F.trim("value") != "").withColumn("j", F.from_json("value", T.StructType([*schema.fields, bad]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}))
    return rows.where("j.bad is null").select(*(F.col("j")[f.name].alias(f.name) for f in schema.fields)), rows.where("j.bad is not null").select(F.col("j.bad").alias("bad"))


def write_state(state: DataFrame, pending_inserts: DataFrame | None, root: str, pending_requests: DataFrame | None = None) -> str:
    """Write the committed rows to a new version under root, let root/current name it, and return its path.

    Left out are pending and retained inserts, one occurrence each, and, in a table without a key, all rows whose
    request_id is one of pending_requests. A reader gets the version before or this one, never a part of it.
    """
    rows = committed_only(state, pending_inserts, pending_requests)
    version, spark = f"version-{uuid.uuid4().hex}", state.sparkSession
    rows.write.parquet(f"{root}/{version}")
    replace_text(spark, f"{root}/current", version)
    return f"{root}/{version}"


def current_state(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows of the version that root/current names; None before the first one."""
    current, files = files_of(spark, f"{root}/current")
    if not files.exists(current):
        return None
    return spark.read.parquet(f"{root}/{spark.read.text(f'{root}/current').first()[0]}")


def journal_entries(lines: DataFrame) -> DataFrame:
    """seq, line -> seq, op, request_id, mutation, readable; blank lines are left out."""
    parsed = lines.where(F.trim("line") != "").withColumn("j", F.from_json("line", JOURNAL, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}))
    request = F.when(F.col("j.op") == "enqueue", F.col("j.mutation.requestId")).otherwise(F.col("j.requestId"))
    readable = F.col("j.bad").isNull() & F.coalesce(F.col("j.op").isin("enqueue", "dequeue"), F.lit(False)) & request.isNotNull()
    return parsed.select("seq", "line", F.col("j.op").alias("op"), request.alias("request_id"), F.col("j.mutation").alias("mutation"), readable.alias("readable"))


def replay_journal(lines: DataFrame) -> DataFrame:
    """Live queue: enqueued mutations without a later dequeue of their request, by seq."""
    entries = journal_entries(lines).where("readable")
    gone = entries.where("op = 'dequeue'").groupBy("request_id").agg(F.max("seq").alias("gone"))
    live = entries.where("op = 'enqueue'").join(gone, "request_id", "left").where("gone is null or seq > gone")
    return live.select("seq", "request_id", "mutation", "line")


def compact_journal(lines: DataFrame) -> DataFrame:
    """seq, line of the journal rewritten as one enqueue for each live mutation, where that pays; else as it is."""
    entries, live = journal_entries(lines), replay_journal(lines)
    facts = entries.agg(F.count_if("readable").alias("ops"), F.count_if(~F.col("readable")).alias("bad")).withColumn("_k", F.lit(1)).join(live.agg(F.count("*").alias("live")).withColumn("_k", F.lit(1)), "_k")
    due = facts.select("_k", ((F.col("bad") > 0) | ((F.col("ops") > 64) & (F.col("ops") > 4 * F.col("live")))).alias("due"))
    new = live.select("seq", "line").withColumn("_k", F.lit(1)).join(F.broadcast(due), "_k").where("due")
    old = lines.select("seq", "line").withColumn("_k", F.lit(1)).join(F.broadcast(due), "_k").where("not due")
    return new.unionByName(old).select("seq", "line")


def import_legacy_queue(spark: SparkSession, path: str) -> DataFrame:
    """A queue file that is one JSON array -> journal lines."""
    rows = spark.read.option("multiLine", True).json(path)
    return rows.select(F.monotonically_increasing_id().alias("seq"), F.to_json(F.struct(F.lit("enqueue").alias("op"), F.struct(*rows.columns).alias("mutation"))).alias("line"))


def last_sync_times(log: DataFrame) -> DataFrame:
    return log.groupBy("table_name").agg(F.max("ts").alias("last_sync_at"))


def flatten_transactions(nested: DataFrame) -> DataFrame:
    """txn, query_sets array<struct<query_set_id, tables array<struct<table_name, groups array<struct<inserts, deletes>>>>>>
    -> the change log with table_name and row.

    set_no and grp number the query sets of a message and the row groups of a table, pos the rows of a group. Groups
    may have events too, rows of tables that hold nothing: op is then 'event'.
    """
    sets = nested.select("txn", F.posexplode("query_sets").alias("set_no", "q"))
    tables = sets.select("txn", "set_no", F.col("q.query_set_id").alias("query_set_id"), F.explode("q.tables").alias("t"))
    groups = tables.select("txn", "set_no", "query_set_id", F.col("t.table_name").alias("table_name"), F.posexplode("t.groups").alias("grp", "g"))
    kinds = [("delete", "deletes"), ("insert", "inserts"), ("event", "events")]
    there = groups.schema["g"].dataType.names
    ops = F.array(*(F.struct(F.lit(op).alias("op"), F.col(f"g.{rows}").alias("rows")) for op, rows in kinds if rows in there))
    return groups.withColumn("o", F.explode(ops)).select("txn", "set_no", "grp", "query_set_id", F.col("o.op").alias("op"), "table_name", F.posexplode("o.rows").alias("pos", "row"))


def log_of_table(flat: DataFrame, table: str) -> DataFrame:
    """The change log of one table, with its own columns; events are left out."""
    mine = flat.where((F.col("table_name") == table) & (F.col("op") != "event"))
    return mine.select("txn", "set_no", "grp", "pos", "query_set_id", "op", "row.*")
