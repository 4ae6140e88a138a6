"""Running sums and last values in blocks: a key with very many rows is dealt over many tasks.

Rows are range-partitioned by key and order and written, so that a block is a part of at most a few neighbouring keys'
rows, whatever a single key's share. Within a block a window runs over a part of a key's rows; what a key's blocks add up
to, one row for each block that it lies in, is carried from block to block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deltaloom.sources.scratch import written

#: Rows of a key from which its rows are dealt in blocks.
HOT = 1_000_000


def has_hot_key(rows: DataFrame, key: list[str], most: int = HOT) -> bool:
    """Whether some key has more rows than that: one count for each key and task is shuffled."""
    return bool(rows.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > most).limit(1).count())


def cut(rows: DataFrame, key: list[str], order: list[str], blocks: int | None = None) -> DataFrame:
    """rows with _block, in order of key and order across blocks; rows that are equal in both share a block."""
    by = [F.col(c).asc_nulls_first() for c in (*key, *order)]
    ranged = rows.repartitionByRange(blocks, *by) if blocks else rows.repartitionByRange(*by)
    return written(ranged.withColumn("_block", F.spark_partition_id()), "blocks")


def _met(a: str, b: str, names: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names])


def running(blocks: DataFrame, key: list[str], order: list[str], sums: dict[str, str] | None = None, lasts: dict[str, str] | None = None, before: bool = False) -> DataFrame:
    """blocks, as cut makes them, with running sums and last non-null values of columns over each key's rows by order.

    sums, lasts: new column -> column. before: up to the row before instead of the row itself (sums are then 0, and values
    null, at a key's first row). order is to tell a key's rows apart.
    """
    sums, lasts = sums or {}, lasts or {}
    at = [F.col(c).asc_nulls_first() for c in order]
    rows = Window.partitionBy(*key, "_block").orderBy(*at).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    place = F.struct(*order)
    parts = blocks.groupBy(*key, "_block").agg(*(F.sum(c).alias(n) for n, c in sums.items()), *(F.max_by(F.struct(c), F.when(F.col(c).isNotNull(), place)).alias(n) for n, c in lasts.items()))
    earlier = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(*key, "_block", *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_c_{n}") for n in sums), *(F.last(n, ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in lasts))
    within = blocks.withColumns({n: F.coalesce(F.sum(c).over(rows), F.lit(0)) for n, c in sums.items()} | {n: F.last(F.when(F.col(c).isNotNull(), F.struct(c)), ignorenulls=True).over(rows) for n, c in lasts.items()})
    both = within.alias("w").join(carried.alias("c"), _met("w", "c", [*key, "_block"]))
    out = {n: F.col(f"w.{n}") + F.col(f"c._c_{n}") for n in sums} | {n: F.coalesce(F.col(f"w.{n}"), F.col(f"c._c_{n}"))[c] for n, c in lasts.items()}
    return both.select(*(F.col(f"w.{c}") for c in blocks.columns), *(e.alias(n) for n, e in out.items()))


def following(blocks: DataFrame, key: list[str], order: list[str], name: str, value: str) -> DataFrame:
    """blocks with name: the value of the key's next row by order, in whatever block; null at its last one."""
    at = [F.col(c).asc_nulls_first() for c in order]
    firsts = blocks.groupBy(*key, "_block").agg(F.min_by(F.struct(value), F.struct(*order)).alias("_first"))
    later = firsts.select(*key, "_block", F.lead("_first").over(Window.partitionBy(*key).orderBy("_block")).alias("_next"))
    within = blocks.withColumn("_lead", F.lead(F.struct(value)).over(Window.partitionBy(*key, "_block").orderBy(*at)))
    both = within.alias("w").join(later.alias("l"), _met("w", "l", [*key, "_block"]))
    return both.select(*(F.col(f"w.{c}") for c in blocks.columns), F.coalesce("w._lead", "l._next")[value].alias(name))
