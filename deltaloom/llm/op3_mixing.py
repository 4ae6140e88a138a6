"""Mixing sources to target weights: fixed-length blocks of words, multinomial draws per shard, permuted indices.

Each source's words are one stream, cut into blocks. Shards of the output draw how many slots each source gets; the
k-th slot of a source takes the block that the source's pseudorandom permutation names for k modulo its blocks.
Shards draw by themselves, so a source's slots may miss its target by chance: slots beyond it are left out, and
missing ones form a last shard. Sources may be as many as documents: their ranks, shares and draws are running sums
and last values over blocks of a range partitioning, and only totals go to the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from deltaloom.operators import scans

from .common import MIX_A, MIX_B, U64, mix, slices, text_or_empty, tidy, written

#: Words of a block at most, and blocks of a source at least, where it has the words.
BLOCK, FINE = 64, 2048
#: Slots of an output shard; documents of a source whose sizes are summed in one task; slots that a task permutes.
SHARD, PART, PERMUTED = 4096, 4096, 1 << 16
#: Weights of the sources, by code point, repeating; share of all words that the mix has; most uses of a source.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def ranked(rows: DataFrame, by: list[Column], name: str) -> DataFrame:
    """rows with name, their place by order, from 0: rows before in their own range partition, and all rows of earlier ones."""
    at = written(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    at = at.withColumn("_part", F.shiftright("_at", 33))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    parts = at.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return at.join(parts, "_part").withColumn(name, place).drop("_part", "_at", "_n", "_before")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size -> with source_id (rank by code point, null last), target, and length of its blocks.

    The total goes by weight; a source whose share passes MOST times its size gets that, and the others share the rest.
    In order of size over weight the sources that are full come first, so running sums tell where sharing ends.
    """
    rank = ranked(sizes, [F.col("source").isNull(), F.col("source").cast("binary")], "source_id")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (F.col("source_id") % len(WEIGHTS) + 1).cast("int"))
    rank = rank.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(MOST)))
    blocks = scans.cut(rank.withColumn("ratio", F.col("most") / F.col("weight")), [], ["ratio", "source_id"])
    size, heavy = blocks.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    sums = scans.running(blocks, [], ["ratio", "source_id"], {"full": "most", "lighter": "weight"}, before=True)
    each = (F.lit(SHARE * size) - F.col("full")) / (F.lit(heavy) - F.col("lighter"))
    # the first source that isn't full tells what each weight gets
    level = sums.withColumn("each", each).where("each * weight <= most").agg(F.min(F.struct("ratio", "source_id", "each"))["each"]).first()[0]
    rank = blocks.withColumn("target", F.col("most") if level is None else F.least("most", F.lit(level) * F.col("weight")))
    return rank.drop("weight", "most", "ratio", "_block").withColumn("length", F.expr(f"greatest(1L, least({BLOCK}L, source_size div {FINE}))"))


def permuted(index: np.ndarray, count: int, key: int, rounds: int = 4) -> np.ndarray:
    """Places of indices in the pseudorandom permutation of 0 .. count - 1 that key names.

    A Feistel network permutes the next even power of two; what falls beyond count is sent through again.
    """
    half = U64(max(1, (int(count - 1).bit_length() + 1) // 2))
    mask = (U64(1) << half) - U64(1)
    keys = mix(np.arange(1, rounds + 1, dtype=U64) * MIX_B + U64(key * int(MIX_A) & 2**64 - 1))

    def through(x):
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (mix(right + k) & mask)
        return (left << half) | right

    out = through(index.astype(U64))
    while len(beyond := np.flatnonzero(out >= U64(count))):
        out[beyond] = through(out[beyond])
    return out.astype(np.int64)


def _blocks(seed: int):
    """Runs of a source's slots -> the blocks that they take, and how often."""

    def run(batches):
        for batch in batches:
            for source, blocks, lo, hi in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                place = permuted(np.arange(lo, hi) % blocks, blocks, seed * 1_000_003 + source)
                block, times = np.unique(place, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(block), source)), pa.array(block), pa.array(times)], names=["source_id", "block", "times"])

    return run


def draws(blocks: DataFrame, total: int, seed: int) -> DataFrame:
    """shard, source_id, slots: a multinomial draw of each shard's slots by the sources' wanted ones, total in all.

    A slot draws a place among all wanted ones, and belongs to the last source that begins at or before it.
    """
    begins = scans.running(scans.cut(blocks.where("wanted > 0"), [], ["source_id"]), [], ["source_id"], {"place": "wanted"}, before=True)
    none = F.lit(None).cast("long")
    marks = begins.select("place", none.alias("slot"), "source_id")
    slots = blocks.sparkSession.range(total).select(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(total)).alias("place"), F.col("id").alias("slot"), none.alias("source_id"))
    order = ["place", "slot"]  # a source's mark, with a null slot, comes before the slots of its place
    drawn = scans.running(scans.cut(marks.unionByName(slots), [], order), [], order, lasts={"drawn": "source_id"}).where("slot is not null")
    return drawn.groupBy(F.expr(f"slot div {SHARD}").alias("shard"), F.col("drawn").alias("source_id")).agg(F.count("*").alias("slots"))


def mixture(docs: DataFrame, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The documents' places in their sources' streams, and how often each block is taken.

    docs: doc_id, source, text and tie, which tells rows of one id and source apart.
    First: _doc_id, _source, _size, _tie, _source_id, _source_size, _target, _length (of the source's
    blocks) and _start (words of its source before the document).
    Second: source_id, block, times.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").alias("_doc_id"), "source", words(text_or_empty()).alias("_size"), F.col("tie").alias("_tie"))
    base = written(base, "sizes")  # texts are read once
    sizes = base.groupBy("source").agg(F.sum("_size").alias("source_size"), F.count("*").alias("source_rows"))
    goal = written(targets(sizes), "targets")
    known = goal.select(F.col("source").alias("_s"), F.col("source_id").alias("_source_id"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), F.col("length").alias("_length"), F.greatest(F.lit(1), F.ceil(F.col("source_rows") / PART)).cast("long").alias("_parts"))
    # a source's documents are dealt out over parts; sums of parts, then sums within a part, give each one's place
    lean = base.join(known, F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumnRenamed("source", "_source")
    lean = lean.withColumn("_part", F.pmod(F.xxhash64("_doc_id", "_tie"), F.col("_parts")))
    part = lean.groupBy("_source_id", "_part").agg(F.sum("_size").alias("_sum"))
    to_part = Window.partitionBy("_source_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    part = part.withColumn("_base", F.coalesce(F.sum("_sum").over(to_part), F.lit(0).cast("long"))).drop("_sum")
    to_doc = Window.partitionBy("_source_id", "_part").orderBy("_doc_id", "_tie", "_size").rowsBetween(Window.unboundedPreceding, -1)
    placed = lean.join(part, ["_source_id", "_part"]).withColumn("_start", F.col("_base") + F.coalesce(F.sum("_size").over(to_doc), F.lit(0).cast("long")))
    placed = written(placed.drop("_parts", "_base", "_part"), "places")

    blocks = goal.select("source_id", F.ceil(F.col("source_size") / F.col("length")).alias("blocks"), F.round(F.col("target") / F.col("length")).cast("long").alias("wanted")).where("blocks > 0")
    blocks = blocks.withColumn("wanted", F.least("wanted", F.col("blocks") * MOST))
    total = blocks.agg(F.coalesce(F.sum("wanted"), F.lit(0))).first()[0]
    tasks = max(1, -(-total // PERMUTED))
    drawn = written(draws(blocks, total, seed), "draws")
    top_up = blocks.join(drawn.groupBy("source_id").agg(F.sum("slots").alias("had")), "source_id", "left").select(F.lit(2**40).cast("long").alias("shard"), "source_id", (F.col("wanted") - F.coalesce("had", F.lit(0))).alias("slots")).where("slots > 0")
    earlier = Window.partitionBy("source_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    slots = drawn.unionAll(top_up).withColumn("first", F.coalesce(F.sum("slots").over(earlier), F.lit(0).cast("long")))
    slots = slots.join(blocks, "source_id").withColumn("last", F.least(F.col("first") + F.col("slots"), "wanted")).where("first < last")
    step = F.explode(F.sequence(F.col("first"), F.col("last") - 1, F.lit(SHARD).cast("long")))
    runs = slots.withColumn("at", step).withColumn("to", F.least(F.col("at") + SHARD, "last")).select("source_id", "blocks", "at", "to")
    taken = runs.repartition(tasks, "source_id", "at").select("source_id", "blocks", "at", "to").mapInArrow(_blocks(seed), "source_id long, block long, times long")
    return placed, taken.groupBy("source_id", "block").agg(F.sum("times").alias("times"))


def pieces(placed: DataFrame, taken: DataFrame) -> DataFrame:
    """Each document's parts that the mix takes: first and last word of the part in the document, and how often."""
    cut = placed.where("_size > 0").withColumn("block", F.explode(F.expr("sequence(_start div _length, (_start + _size - 1) div _length)")))
    lo, hi = F.expr("greatest(block * _length, _start) - _start"), F.expr("least((block + 1) * _length, _start + _size) - _start")
    return cut.withColumn("lo", lo).withColumn("hi", hi).join(taken.withColumnRenamed("source_id", "_source_id"), ["_source_id", "block"])


def mixed_words(docs: DataFrame, seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target and taken (words that the mix takes, repeats counted) of every row of docs.

    Null and empty texts have size 0 and are never taken; a null source is one source, the last. Rows of equal doc_id,
    source and text, null ids included, are documents of their own, whichever of them stands first. A source's taken words differ from its target by less than two blocks. An empty table gives none.
    """
    placed, taken = mixture(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", F.xxhash64(text_or_empty()).alias("tie")), seed)
    used = pieces(placed, taken).groupBy("_source_id", "_start").agg(F.sum((F.col("hi") - F.col("lo")) * F.col("times")).alias("taken"))
    some = placed.where("_size > 0").join(used, ["_source_id", "_start"], "left")
    out = some.unionByName(placed.where("_size = 0").withColumn("taken", F.lit(0).cast("long")))
    return out.select(F.col("_doc_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def _texts(columns: list[str]):
    """Rows with the word ranges that are taken -> one row for each pass over the text, with the words of that pass."""
    import re

    word, k = re.compile(r"[^\x20\x09-\x0D]+"), columns.index("text")

    def run(batches):
        for batch in batches:
            rows = pa.RecordBatch.from_arrays([*batch.column("row").flatten(), batch.column("words"), batch.column("ranges")], names=[str(i) for i in range(len(columns) + 2)])
            for part in slices(rows, str(k)):
                *kept, sizes, taken = part.columns
                index, texts = [], []
                for i, (text, size, ranges) in enumerate(zip(kept[k], sizes.to_pylist(), taken, strict=True)):
                    text, ranges = text.as_py(), sorted((r["lo"], r["hi"], r["times"]) for r in ranges.as_py() or [])
                    for turn in range(1, MOST + 1):
                        own = [(lo, hi) for lo, hi, times in ranges if times >= turn]
                        if not own:
                            continue
                        if sum(hi - lo for lo, hi in own) == size:
                            out = text
                        else:
                            at = [m.start() for m in word.finditer(text)] + [len(text)]
                            out = "".join(text[at[lo] : at[hi]] for lo, hi in own)
                        index.append(i)
                        texts.append(out)
                picked = [c.take(pa.array(index, pa.int64())) for c in kept]
                picked[k] = pa.array(texts, picked[k].type)
                yield pa.RecordBatch.from_arrays(picked, names=columns)

    return run


def whole_row(docs: DataFrame) -> Column:
    """A hash of all columns; of those that hold maps, by their JSON."""
    return F.xxhash64(*(F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in docs.schema))


def mixed_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The mix itself, with the columns of docs: a row for each pass over a document, holding the words taken in it.

    A document that is taken whole keeps its text as it is; words that no block takes are left out. n_chars, where
    there is one, follows. Documents without words are in no block and so not in the mix. Rows of one id, source and
    text keep each its own other columns; rows that are equal throughout are interchangeable.
    """
    tie = whole_row(docs)
    placed, taken = mixture(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source", tie.alias("tie")), seed)
    used = pieces(placed, taken).groupBy("_source_id", "_start").agg(F.collect_list(F.struct("lo", "hi", "times")).alias("_taken"), *(F.first(c).alias(c) for c in ("_doc_id", "_tie", "_size", "_source")))
    # equal rows are joined once to each of their places; columns of docs travel in one, so that no name clashes
    keys = F.col("doc_id").cast("long").alias("_k_id"), tie.alias("_k_tie"), F.col("source").alias("_k_source")
    rows = docs.select(F.struct(*docs.columns).alias("row"), *keys).dropDuplicates(["_k_id", "_k_tie", "_k_source"])
    same = F.col("_k_id").eqNullSafe(F.col("_doc_id")) & F.col("_k_tie").eqNullSafe(F.col("_tie")) & F.col("_k_source").eqNullSafe(F.col("_source"))
    out = rows.join(used, same).select("row", F.col("_size").alias("words"), F.col("_taken").alias("ranges")).mapInArrow(tidy(_texts(docs.columns)), docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
