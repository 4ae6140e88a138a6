"""Lookups and views over a table, and the tables that subscription queries name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaloom.functions.scalars import from_tables, query_hash, table_refs


def find(state: DataFrame, pk: list[str], *key) -> DataFrame:
    """The row of a key, or none; a table without a key has none."""
    if not pk:
        return state.where(F.lit(False))
    return state.where(reduce(lambda a, b: a & b, [F.col(c) == v for c, v in zip(pk, key, strict=True)]))


def view_array(rows: DataFrame, predicate: Column, name: str) -> DataFrame:
    """A named view of many rows."""
    rows.where(predicate).createOrReplaceTempView(name)
    return rows.sparkSession.table(name)


def view_option(rows: DataFrame, predicate: Column) -> DataFrame:
    """At most one row."""
    return rows.where(predicate).limit(1)


def view_single(rows: DataFrame, predicate: Column) -> DataFrame:
    """Exactly one row; the query fails where there is none or several."""
    two = rows.where(predicate).limit(2).agg(F.count("*").alias("n"), F.first(F.struct(*rows.columns)).alias("row"))
    return two.select(F.when(F.col("n") == 1, F.col("row")).otherwise(F.raise_error(F.lit("a single-row view needs exactly one row"))).alias("row")).select("row.*")


def query_table_refs(queries: DataFrame) -> DataFrame:
    """query_set_id, query_no, query -> query_set_id, query_no, table_name, each table of a query once."""
    return queries.select("query_set_id", "query_no", F.explode(table_refs(F.col("query"))).alias("table_name"))


def query_from_tables(queries: DataFrame) -> DataFrame:
    """query_set_id, query_no, table_name of the tables after FROM; those that a query only joins return no rows."""
    return queries.select("query_set_id", "query_no", F.explode(from_tables(F.col("query"))).alias("table_name"))


def covering_sets(queries: DataFrame, table: str) -> DataFrame:
    """query_set_id of sets with a query that has the table after FROM, in this very case."""
    return query_from_tables(queries).where(F.col("table_name") == table).select("query_set_id").distinct()


def table_covered(queries: DataFrame, table: str) -> bool:
    return bool(covering_sets(queries, table).limit(1).count())


def validate_query_sets(queries: DataFrame, catalog: DataFrame) -> DataFrame:
    """Queries without each set's first one that has a table outside the catalog (table_name) after FROM.

    Unknown tables that a query only joins don't drop it. A set of which nothing is left has no row: see emptied_sets.
    """
    known = catalog.select(F.lower("table_name").alias("name")).distinct()
    bad = query_from_tables(queries).withColumn("name", F.lower("table_name")).join(known, "name", "left_anti")
    first = bad.groupBy("query_set_id").agg(F.min("query_no").alias("query_no"))
    return queries.join(first, ["query_set_id", "query_no"], "left_anti").select(*queries.columns)


def emptied_sets(queries: DataFrame, catalog: DataFrame) -> DataFrame:
    """query_set_id of sets that validation leaves without a query: their ownership, and rows without another owner, go."""
    left = validate_query_sets(queries, catalog).select("query_set_id").distinct()
    return queries.select("query_set_id").distinct().join(left, "query_set_id", "left_anti")


def snapshot_of_sets(rows: DataFrame, pk: list[str], order: list[str]) -> DataFrame:
    """Rows of several queries or tables of one reply: of one key's rows the last in order; without a key all of them."""
    if not pk:
        return rows
    last = rows.groupBy(*pk).agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("r"))
    return last.select("r.*")


def watch_keys(changes: DataFrame, keys: DataFrame, pk: list[str]) -> DataFrame:
    """pk, txn, value of watched keys after each change that alters it; a null value tells that the row is gone.

    changes: txn, pk, kind, old, new, as coalesce_changes makes them.
    """
    mine = changes.join(keys.select(*pk).distinct(), pk, "left_semi").where(~F.col("old").eqNullSafe(F.col("new")))
    return mine.select(*pk, "txn", F.when(F.col("kind") != "delete", F.col("new")).alias("value"))


def removed_where(state: DataFrame, pk: list[str], predicate: Column) -> tuple[DataFrame, DataFrame]:
    """State without the rows whose key satisfies the predicate, and the keys that went; null keeps a row."""
    goes = F.coalesce(predicate, F.lit(False))
    return state.where(~goes), state.where(goes).select(*pk).distinct()


def tags_for_table(queries: DataFrame, table: str) -> DataFrame:
    """query_set_id, query_no, query_hash of each set's queries that name the table, in this very case; of a set without
    any, all of them."""
    naming = query_table_refs(queries).where(F.col("table_name") == table).select("query_set_id", "query_no").distinct()
    others = queries.join(naming.select("query_set_id").distinct(), "query_set_id", "left_anti").select("query_set_id", "query_no")
    hashes = queries.select("query_set_id", "query_no", query_hash(F.array("query")).alias("query_hash"))
    return naming.unionByName(others).join(hashes, ["query_set_id", "query_no"])
