"""Batch write jobs and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deltaloom.sources.scratch import written


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """rows with their place in order, from 0 without gaps.

    Numbers come from counts of range partitions and places within them, so no task sees all rows.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
    ranged = ranged.checkpoint()
    place = ranged.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_m").alias("_lo"))
    before = place.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = ranged.join(F.broadcast(before), "_p")  # a row for each partition
    return out.withColumn(name, F.col("_before") + F.col("_m") - F.col("_lo")).drop("_p", "_m", "_n", "_lo", "_before")


def insert_with_next_ids(state: DataFrame, rows: DataFrame, id_: str, order: list[str]) -> DataFrame:
    """rows with ids after the largest of state, from 1 for an empty one; in order, by ranges that are numbered apart."""
    top = state.agg(F.coalesce(F.max(id_), F.lit(0)).alias("_top")).withColumn("_k", F.lit(1))
    out = numbered(rows, order, "_at").withColumn("_k", F.lit(1)).join(F.broadcast(top), "_k")
    return out.withColumn(id_, F.col("_top") + 1 + F.col("_at")).drop("_k", "_top", "_at")


def update_all(state: DataFrame, **values: Column) -> DataFrame:
    """Every row with new values."""
    return state.withColumns(values)


def mixed_batch(state: DataFrame, pk: str, updates: int, deletes: int, inserts: DataFrame, **values: Column) -> DataFrame:
    """One transaction in order of pk: the first rows get new values, the next are deleted, inserts come after.

    inserts: place (from 1) and the other columns of state; ids follow the largest one. The bands' edges come from a
    top-k of ids, so no task sorts the table. Repeated ids share their band.
    """
    first = state.select(pk).orderBy(pk).limit(updates + deletes).select(pk, F.row_number().over(Window.orderBy(pk)).alias("_r"))
    edge = first.agg(F.max(F.when(F.col("_r") <= updates, F.col(pk))).alias("_u"), F.max(pk).alias("_d")).withColumn("_k", F.lit(1))
    top = state.agg(F.coalesce(F.max(pk), F.lit(0)).alias("_top")).withColumn("_k", F.lit(1))
    rows = state.withColumn("_k", F.lit(1)).join(F.broadcast(edge), "_k")
    updated = rows.where(F.col(pk) <= F.col("_u")).withColumns(values).select(*state.columns)
    kept = rows.where(F.coalesce(F.col(pk) > F.col("_d"), F.lit(True))).select(*state.columns)
    new = inserts.withColumn("_k", F.lit(1)).join(F.broadcast(top), "_k").withColumn(pk, F.col("_top") + F.col("place"))
    return updated.unionByName(kept).unionByName(new.select(*state.columns))


def guarded_update(state: DataFrame, updates: DataFrame, pk: str, guard: Column) -> DataFrame:
    """updates with result: ok, 'no such row', or 'row is locked' where the guard holds on the present row."""
    there = state.select(pk, guard.alias("_locked"))
    out = updates.join(there, pk, "left")
    return out.withColumn("result", F.when(F.col("_locked").isNull(), "no such row").when(F.col("_locked"), "row is locked").otherwise("ok")).drop("_locked")


def cascade_on_disconnect(connections: DataFrame, opted_in: DataFrame, items: DataFrame, ended: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Connections that are left, and items without those of identities that opted in and have none left."""
    left = connections.join(ended, "connection_id", "left_anti")
    gone = connections.join(ended, "connection_id", "left_semi").select("identity").distinct().join(left, "identity", "left_anti").join(opted_in, "identity", "left_semi")
    return left, items.join(gone.withColumnRenamed("identity", "owner"), "owner", "left_anti")


def generator_states(n: int, seed: int, a: int, c: int, spark) -> DataFrame:
    """k, x: the n states of the generator x -> a * x + c modulo 2**64 after seed, as decimals.

    Each comes by itself: the k-th state takes the jumps of 1, 2, 4, ... steps that k is the sum of. A product of two
    64-bit numbers has too many digits, so x is multiplied in two halves.
    """
    whole, half = 1 << 64, 1 << 32
    jumps, add, mul = [], c % whole, a % whole
    for bit in range(n.bit_length()):
        jumps.append((bit, mul, add))
        mul, add = mul * mul % whole, (mul + 1) * add % whole
    number = lambda v: F.lit(str(v)).cast("decimal(38,0)")
    steps = F.array(*(F.struct(F.lit(b).alias("bit"), number(m).alias("mul"), number(m % half).alias("low"), number(p).alias("add")) for b, m, p in jumps))
    w, h = number(whole), number(half)

    def jump(x, s):
        upper = ((x - x % h) / h).cast("decimal(38,0)")
        high = ((upper * s["low"]).cast("decimal(38,0)") % h * h).cast("decimal(38,0)")
        return ((high + (x % h * s["mul"]).cast("decimal(38,0)") + s["add"]).cast("decimal(38,0)") % w).cast("decimal(38,0)")

    taken = F.filter(steps, lambda s: F.call_function("shiftright", F.col("k"), s["bit"]).bitwiseAND(F.lit(1)) == 1)
    return spark.range(1, n + 1).withColumnRenamed("id", "k").withColumn("x", F.aggregate(taken, number(seed % whole), jump))


def random_mutations(state: DataFrame, n: int, seed: int, id_: str, fields: list[str], a: int = 6364136223846793005, c: int = 1442695040888963407) -> DataFrame:
    """n draws of a 64-bit linear congruential generator, each adding 1 to fields of one row of state.

    A draw is the generator's upper 31 bits modulo the number of rows, a place in the order of id_. The generator's
    constants and the shift are fixed values. Null ids come first in that order.
    """
    count = state.count()
    if not count or not n:
        return state
    drawn = generator_states(n, seed, a, c, state.sparkSession)
    hits = drawn.select((F.expr("x div 8589934592BD").cast("long") % count).alias("_at")).groupBy("_at").agg(F.count("*").alias("_hits"))
    out = numbered(state, [id_], "_at").join(hits, "_at", "left").withColumn("_hits", F.coalesce("_hits", F.lit(0)))
    return out.withColumns({f: (F.col(f) + F.col("_hits")).cast(state.schema[f].dataType) for f in fields}).select(*state.columns)


#: Ranges that a round of the selection counts.
RANGES = 256


def latency_report(samples: DataFrame, by: list[str], value: str, shares=(0.5, 0.95, 0.99)) -> DataFrame:
    """Exact percentiles: the element at round(p * (n - 1)) of the sorted values, by counting ranges again and again.

    Each wanted place of a group has a range of values that it lies in. A round counts the group's values in 256 parts of
    the range and goes on with the part that the place is in, between the least and the largest value found there, until
    they are the same. Counts are summed before they are shuffled, so that no task sees a group's values; rounds are as
    many as there are digits to base 256, whatever the rows.
    """
    rows = samples.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("v"))
    wanted = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.floor(F.lit(p) * (F.col("n") - 1) + 0.5).alias("place")) for k, p in enumerate(shares))))
    found = rows.groupBy(*by).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).withColumn("w", wanted)
    found = written(found.select(*by, "n", "lo", "hi", "w.k", F.col("w.place").alias("place")), "places")
    key = [*by, "k"]
    met = lambda names: reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in names], F.lit(True))
    while (open_ := found.where("lo < hi")).limit(1).count():
        lo, hi, v = (F.col(c).cast("double") for c in ("t.lo", "t.hi", "r.v"))
        # ends have parts of their own, so that each round narrows the range; what can't be told apart is one part
        part = F.when(F.col("r.v") == F.col("t.lo"), -1).when(F.col("r.v") == F.col("t.hi"), RANGES).otherwise(F.coalesce(F.nanvl(F.floor((v - lo) / (hi - lo) * RANGES).cast("double"), F.lit(None).cast("double")), F.lit(RANGES - 1.0)))
        within = rows.alias("r").join(open_.alias("t"), met(by) & F.col("r.v").between(F.col("t.lo"), F.col("t.hi")))
        parts = within.groupBy(*(F.col(f"t.{c}").alias(c) for c in key), part.alias("part")).agg(F.count("*").alias("c"), F.min("r.v").alias("lo"), F.max("r.v").alias("hi"))
        upto = parts.withColumn("upto", F.sum("c").over(Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)))  # few parts
        chosen = upto.alias("r").join(open_.alias("t"), met(key)).where((F.col("t.place") < F.col("r.upto")) & (F.col("t.place") >= F.col("r.upto") - F.col("r.c")))
        narrowed = chosen.select(*(F.col(f"t.{c}") for c in by), "t.n", "r.lo", "r.hi", "t.k", (F.col("t.place") - F.col("r.upto") + F.col("r.c")).alias("place"))
        found = written(narrowed.unionByName(found.where("not lo < hi")), "places")
    return found.groupBy(*by).agg(*(F.max(F.when(F.col("k") == k, F.col("lo"))).alias(f"p{round(p * 100)}") for k, p in enumerate(shares)), F.max("n").alias("n"))


def throughput_report(samples: DataFrame, by: list[str], fired: str, observed: str, micros: str, budget: int = 16_000, ended: str | None = None) -> DataFrame:
    """Fired and observed samples of each group, their share in per cent, and those over budget; ended: whether the
    connection was lost at a sample."""
    out = samples.groupBy(*by).agg(F.count_if(fired).alias("fired"), F.count_if(observed).alias("observed"), F.count_if(F.col(micros) > budget).alias("budget_misses"))
    out = out if ended is None else out.join(samples.groupBy(*by).agg(F.bool_or(ended).alias("disconnected")), by)
    return out.withColumn("kept_up_pct", F.col("observed") * 100.0 / F.col("fired")).withColumn("backpressure", F.col("observed") * 2 < F.col("fired"))


def snapshot_write_report(writes: DataFrame) -> DataFrame:
    return writes.groupBy("table_name").agg(F.count("*").alias("calls"), F.sum("rows").alias("rows")).withColumn("rows_per_call", F.col("rows") / F.col("calls"))
