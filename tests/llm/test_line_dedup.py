"""Line dedup against plain Python, on hard rows, and its runs."""

import hashlib
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from deltaloom.llm import op13_lines, queries

SPACE, LOWER = " \t\n\x0b\x0c\r", {c: c + 32 for c in range(65, 91)}


def key(line):
    return line.strip(SPACE).translate(LOWER)


def expected(rows):
    """rows: (doc_id, text) -> sorted (doc_id, n_lines, n_dropped, kept)."""
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    first = lambda i: (i is not None, i or 0)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = lambda k: len(k) >= 20 and len(holders[k]) >= 3 and max(holders[k], key=first) != i
        kept = [x for x in lines if not gone(key(x))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=str)


def test_whole_table_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {(i, n, d, hashlib.sha256(k.encode()).hexdigest()) for i, n, d, k in expected(rows)}
    assert {tuple(r) for r in queries.op13_line_dedup(spark, sf).collect()} == want
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert {tuple(r) for r in con.sql(queries.ORACLE_SQL["op13_line_dedup"]).fetchall()} == want
    assert sum(d for _, _, d, _ in want) > 10


@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2), (7, 3)])
def test_any_batches(spark, batches, fanout):
    rng = random.Random(batches)
    pool = [f"{'Line' if k % 2 else 'lINE'} number {k % 20} of the common ones" for k in range(40)] + ["short", "", "x" * 19, "x" * 20, "é" * 20, "É" * 20, " " + "q" * 20]
    rows = [(rng.choice([None, *range(60)]), "\n".join(rng.choice(["", " \t", "\x0b"]) + rng.choice(pool) + rng.choice(["", "\r", " "]) for _ in range(rng.randrange(8)))) for _ in range(150)]
    rows += [(61, None), (62, ""), (63, "\n"), (64, "\n\n" + pool[0] + "\n"), *[(65, pool[0])] * 3]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(op13_lines.without_repeated_lines(df, batches=batches, fanout=fanout)) == expected(rows)


def test_long_texts_and_copies(spark):
    body = "\n".join(f"this is line {k:06d} of a very long text" for k in range(60_000))
    rows = [(k, body) for k in range(3)] + [(9, body + "\nand one of its own, which stays")]
    assert found(op13_lines.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


def test_empty_table_and_clashing_names(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert found(op13_lines.without_repeated_lines(none)) == []
    names = "tid, h, g, pos, line, lines, gone, batch, last, docs, kept".split(", ")
    rows = [(k, "one and the same line, repeated") for k in range(4)]
    df = spark.createDataFrame([(*r, *range(len(names))) for r in rows], "doc_id long, text string, " + ", ".join(f"{n} long" for n in names))
    assert found(op13_lines.without_repeated_lines(df)) == expected(rows)


def test_runs_compact_and_answers_stay(spark):
    runs = op13_lines.LineRuns(spark, least_docs=3, fanout=2)
    lines = spark.range(40).select((F.col("id") % 5).alias("h"), F.lit(7).cast("long").alias("g"), F.col("id").alias("doc_id"))
    for k in range(4):  # the largest ids first
        runs.add(lines.where((F.col("doc_id") >= 30 - 10 * k) & (F.col("doc_id") < 40 - 10 * k)))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    # two ids of each key in the first batch, two in the second: merged they are enough, so later batches add nothing
    assert {(r["docs"], r["last"]) for r in spark.table(runs.levels[2][0]).collect()} == {(4, 35 + k) for k in range(5)}
    assert {(r["h"], r["last"]) for r in runs.repeated().collect()} == {(k, 35 + k) for k in range(5)}
    runs.add(lines)
    plan = runs._merged([runs.levels[0][0], runs.levels[2][0]])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 2 and "Exchange" not in plan  # sorted runs are merged where they lie
    runs.close()


def test_no_python_on_the_way(spark):
    df = spark.createDataFrame([(1, "a line")], "doc_id long, text string")
    plan = op13_lines.without_repeated_lines(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
