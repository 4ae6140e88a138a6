"""Line dedup by levelled sorted runs of line hashes.

Documents come in batches of descending ids. A batch's line keys are counted, merge-anti-joined with the runs, which
takes out keys that can't change any answer any more, and what is left becomes a run of its own: a table bucketed and
sorted by hash, so that neither the joins nor compaction shuffle the runs again. When a level holds `fanout` runs they
are merged into one of the next level. DataFrame functions only.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, scratch_dir, text_or_empty, written

#: Code points of a key that counts, documents that make it a repeated one, batches, runs of a level that are merged.
LEAST_CHARS, LEAST_DOCS, BATCHES, FANOUT = 20, 3, 4, 2
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h", "g"]


def lines_of(text: Column) -> Column:
    """All lines of a text, the empty ones at its end included."""
    return F.split(text, "\n", -1)


def bare(line: Column) -> Column:
    """A line without white space at its ends."""
    return F.trim(line, F.lit(SPACE))


def folded(line: Column) -> Column:
    """A-Z in lower case; other letters stay as they are. lower() does the same to ASCII, and faster."""
    return F.when(F.octet_length(line) == F.char_length(line), F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))


def hashes(key: Column) -> list[Column]:
    """128 bits of two seeded hashes."""
    return [F.xxhash64(key).alias("h"), F.xxhash64(F.lit(1), key).alias("g")]


class LineRuns:
    """Runs of (h, g, docs, last): a key's number of documents and their largest id, in levels, each run sorted by hash.

    A key may stand in several runs: docs add up, last is the largest. A document's keys are to come in one batch.
    """

    def __init__(self, spark: SparkSession, least_docs: int = LEAST_DOCS, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("levels of fewer than two runs can't be merged")
        self.spark, self.least_docs, self.fanout = spark, least_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _store(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        run.write.option("path", f"{scratch_dir(self.spark)}/{name}").bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(self.spark)}/{name}")
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _merged(self, names: list[str]) -> DataFrame:
        """Runs merged in pairs, which Spark reads side by side, bucket by bucket; a union would forget the buckets."""

        def merge(a: DataFrame, b: DataFrame) -> DataFrame:
            docs = F.coalesce("a.docs", F.lit(0)) + F.coalesce("b.docs", F.lit(0))
            return a.alias("a").join(b.hint("merge").alias("b"), HASH, "full_outer").select(*HASH, docs.alias("docs"), F.greatest("a.last", "b.last").alias("last"))

        return reduce(merge, map(self.spark.table, names))

    def add(self, batch: DataFrame) -> None:
        """batch: h, g, doc_id of lines. Keys that are already repeated in a run, and under an id at least as large, add nothing."""
        keys = batch.select(*HASH, "doc_id").distinct().groupBy(*HASH).agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"))
        for name in (n for level in self.levels for n in level):
            b, r = keys.alias("b"), self.spark.table(name).where(F.col("docs") >= self.least_docs).hint("merge").alias("r")
            known = (F.col("b.h") == F.col("r.h")) & (F.col("b.g") == F.col("r.g")) & (F.col("b.last").isNull() | (F.col("r.last") >= F.col("b.last")))
            keys = b.join(r, known, "left_anti")
        self._put(0, self._store(keys.repartition(self.buckets, *HASH) if not any(self.levels) else keys))

    def _put(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(runs := self.levels[level]) == self.fanout:
            merged = self._store(self._merged(runs))
            for n in runs:
                self._drop(n)
            self.levels[level] = []
            self._put(level + 1, merged)

    def repeated(self) -> DataFrame:
        """(h, g, last) of keys that enough documents hold."""
        return self._merged([n for level in self.levels for n in level]).where(F.col("docs") >= self.least_docs).select(*HASH, "last")

    def close(self) -> None:
        for name in (n for level in self.levels for n in level):
            self._drop(name)
        self.levels = []


def without_repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (text) of each row.

    A key of at least least_chars code points that at least least_docs documents hold loses its lines in all of them but
    the one of the largest doc_id, where all its lines stay. Null and empty texts are one empty line. Rows that share a
    doc_id are one document when documents are counted, and each has a row of its own; null ids are together one
    document, smaller than all others. An empty table gives no rows; other columns, whatever their names, are left out.
    Texts are whole, however long. Which batch a document is in changes no result.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", text_or_empty().alias("text")).withColumn("tid", F.xxhash64("text"))
    edges = docs.approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01) if batches > 1 else []
    # the largest ids come first: their batch then holds what later ones are compared with; null ids come last
    batch = reduce(lambda c, e: c + F.when(F.col("doc_id") <= e, 1).otherwise(0), edges, F.when(F.col("doc_id").isNull(), len(edges)).otherwise(0)).alias("batch")
    every = docs.select(batch, "doc_id", "tid", F.posexplode(lines_of(F.col("text"))).alias("pos", "line")).withColumn("line", bare(F.col("line")))
    path = f"{scratch_dir(spark)}/lines-{uuid.uuid4().hex}"
    every.where(F.char_length("line") >= least_chars).select("batch", "doc_id", "tid", "pos", *hashes(folded(F.col("line")))).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, tid long, pos int, h long, g long, batch int").parquet(path)
    lines._written_at = path
    runs = LineRuns(spark, least_docs, fanout)
    for k in range(len(edges) + 1):
        runs.add(lines.where(F.col("batch") == k))
    repeated = written(runs.repeated(), "repeated-lines")
    runs.close()
    lost = lines.join(repeated, HASH).where(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("last")))
    gone = written(lost.groupBy("doc_id", "tid").agg(F.collect_set("pos").alias("gone")), "dropped-lines")
    discard(lines, repeated)
    d, g = docs.alias("d"), gone.alias("g")
    met = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.tid") == F.col("g.tid"))
    # a column of its own: an expression within the lambda would split the text again for each line
    both = d.join(g, met, "left").select("d.doc_id", "text", "gone", lines_of(F.col("text")).alias("lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.col("lines")[i]), "\n"))
    return both.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"), kept.alias("kept"))
