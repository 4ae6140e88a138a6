"""A Merkle manifest of a dataset: each row a leaf, a tree of runs of three for each source, a tree of their roots.

Witnesses grow incrementally. The nodes of an aligned block of 3**LEVELS are appended one after the other in one task: a
node joins the open subtree of its level with what is known of its witness, and each run that fills up, or ends, extends
the witnesses of all leaves below it. Roots of blocks are appends to the next round in the same way, until a tree has
one root; a leaf's witness is then that in its block followed by its block's, and its source's.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import discard, short_batches, written

#: Nodes of a run; levels of a block, of which one group has at most 3**LEVELS nodes.
ARITY, LEVELS = 3, 6


def node(run: list[bytes]) -> bytes:
    """A run's digest: that of its digests' hex texts."""
    return hashlib.sha256(b"".join(run).hex().encode()).digest()


def record_digest(*fields: Column) -> Column:
    """Lower-case hex digest of fields, each '-' if null, else its number of UTF-8 bytes, ':' and itself."""
    told = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.sha2(F.concat(*told), 256)


class Appends:
    """Nodes appended to subtrees of a known depth, with their witnesses: siblings' digests, level by level from below.

    A step of a path is 4 * place + nodes of the run.
    """

    def __init__(self, depth: int):
        self.depth, self.root = depth, None
        self.open: list[list[tuple[bytes, int, int]]] = [[] for _ in range(depth)]
        self.witness: list[bytearray] = []
        self.path: list[bytearray] = []

    def append(self, digest: bytes) -> None:
        k = len(self.witness)
        self.witness.append(bytearray())
        self.path.append(bytearray())
        self._put(0, digest, k, k + 1)

    def end(self) -> None:
        for level in range(self.depth):
            if self.open[level]:
                self._close(level)

    def _put(self, level: int, digest: bytes, low: int, high: int) -> None:
        if level == self.depth:
            self.root = digest
            return
        self.open[level].append((digest, low, high))
        if len(self.open[level]) == ARITY:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        for place, (_, low, high) in enumerate(run):
            siblings = b"".join(d for j, (d, _, _) in enumerate(run) if j != place)
            for leaf in range(low, high):
                self.witness[leaf] += siblings
                self.path[leaf].append(4 * place + len(run))
        self._put(level + 1, node([d for d, _, _ in run]), run[0][1], run[-1][2])


def depth_of(nodes: int, levels: int) -> int:
    """Levels that a block needs in a tree of so many nodes: all of them, or up to the one node that is left."""
    depth = 0
    while depth < levels and ARITY**depth < nodes:
        depth += 1
    return depth


def folded(digest: bytes, witness: bytes, path: bytes) -> bytes:
    """The root that a leaf and the siblings on its way give."""
    at = 0
    for step in path:
        place, of = step >> 2, step & 3
        run = [witness[at + 32 * j : at + 32 * (j + 1)] for j in range(of - 1)]
        at += 32 * (of - 1)
        digest = node([*run[:place], digest, *run[place:]])
    return digest


def _block(table: pa.Table, levels: int) -> pa.Table:
    table = table.sort_by("idx")
    appends = Appends(depth_of(table["n"][0].as_py(), levels))
    for digest in table["digest"].to_pylist():
        appends.append(digest)
    appends.end()
    for name, values in (("witness", appends.witness), ("path", appends.path), ("root", [appends.root] * table.num_rows)):
        table = table.append_column(name, pa.array([bytes(v) for v in values], pa.binary()))
    return table


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """nodes with idx, their place in their tree by order, and n, its number of nodes; nulls come first.

    Rows are range-partitioned, written, and counted for each tree and partition, so that no task holds a whole tree.
    """
    at = nodes.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn("_at", F.monotonically_increasing_id())
    at = written(at, "merkle-sorted")
    at = at.withColumn("_part", F.shiftright("_at", 33))
    counts = at.groupBy("tree", "_part").agg(F.min("_at").alias("_low"), F.count("*").alias("_m"))
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_start", F.coalesce(F.sum("_m").over(before), F.lit(0))).withColumn("n", F.sum("_m").over(Window.partitionBy("tree")))
    out = at.join(counts.drop("_m"), ["tree", "_part"])
    return out.withColumn("idx", F.col("_start") + F.col("_at") - F.col("_low")).drop("_at", "_part", "_low", "_start")


def climbed(nodes: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """tree, idx, n, digest, ... -> nodes with block and the witness and path in it, and tree, block, witness, path, top
    of each block: what leads from its root to the tree's."""
    rounds, span = [], ARITY**levels
    while True:
        blocks = nodes.withColumn("block", F.floor(F.col("idx") / span))
        grown = blocks.groupBy("tree", "block").applyInArrow(lambda table: _block(table, levels), T.StructType([*blocks.schema.fields, *(T.StructField(c, T.BinaryType()) for c in ("witness", "path", "root"))]))
        rounds.append(written(grown, "merkle-blocks"))
        nodes = rounds[-1].where(F.col("idx") % span == 0).select("tree", F.col("block").alias("idx"), F.ceil(F.col("n") / span).alias("n"), F.col("root").alias("digest"))
        if not nodes.where("n > 1").limit(1).count():
            break
    above = nodes.select("tree", F.col("idx").alias("block"), F.lit(b"").alias("witness"), F.lit(b"").alias("path"), F.col("digest").alias("top"))
    for grown in reversed(rounds[1:]):
        on = grown.alias("g").join(above.alias("a"), ["tree", "block"])
        above = on.select("tree", F.col("idx").alias("block"), F.concat("g.witness", "a.witness").alias("witness"), F.concat("g.path", "a.path").alias("path"), "top")
    return rounds[0], above


def manifest(docs: DataFrame, keep: list[str] | None = None, levels: int = LEVELS) -> DataFrame:
    """doc_id, source, leaf, idx, witness, path, subroot, root of each row (digests as 32 bytes each), and columns to keep.

    A leaf is the digest of doc_id, source, lang, n_chars and text. Leaves of a source ascend by doc_id, null first, and by
    digest where rows share an id; sources by their bytes, null first. Null and empty texts are leaves of their own
    kinds, rows that are repeated are leaves of their own, texts are whole. An empty table has no rows and no root.
    """
    keep = keep or []
    rows = docs.select("doc_id", "source", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("tree"), F.unhex(record_digest(*map(F.col, ("doc_id", "source", "lang", "n_chars", "text")))).alias("digest"), *keep)
    with short_batches(docs.sparkSession):
        leaves = written(rows, "merkle-leaves")
        first, above = climbed(ranked(leaves, ["doc_id", "digest"]), levels)
        tops = above.where(F.col("block") == 0).select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("digest"))
        last, over = climbed(ranked(tops, ["name"]), levels)
    discard(leaves)
    sources = last.alias("l").join(over.alias("o"), ["tree", "block"]).select("name", "digest", F.concat("l.witness", "o.witness").alias("witness"), F.concat("l.path", "o.path").alias("path"), F.col("top").alias("root"))
    ways = above.alias("a").join(sources.alias("s"), F.col("a.tree") == F.col("s.name"))
    ways = ways.select("tree", "block", F.concat("a.witness", "s.witness").alias("witness"), F.concat("a.path", "s.path").alias("path"), F.col("digest").alias("subroot"), "s.root")
    on = first.alias("f").join(ways.alias("w"), ["tree", "block"])
    return on.select("doc_id", "source", F.col("f.digest").alias("leaf"), "idx", F.concat("f.witness", "w.witness").alias("witness"), F.concat("f.path", "w.path").alias("path"), "subroot", "w.root", *(F.col(f"f.{c}") for c in keep))


def _verify(batches):
    for batch in batches:
        c = {name: batch.column(name) for name in batch.schema.names}
        told = {name: [b.hex() for b in c[name].to_pylist()] for name in ("leaf", "subroot", "root")}
        ways = list(zip(c["witness"].to_pylist(), c["path"].to_pylist(), strict=True))
        shown = [b or a for a, b in zip(c["leaf"].to_pylist(), c["tampered"].to_pylist(), strict=True)]
        told["proof_sha256"] = [hashlib.sha256(w.hex().encode()).hexdigest() for w, _ in ways]
        told["folded_root"] = [folded(d, w, p).hex() for d, (w, p) in zip(shown, ways, strict=True)]
        verified = [a == b for a, b in zip(told["folded_root"], told["root"], strict=True)]
        yield pa.record_batch([c["doc_id"], *(pa.array(told[n], pa.string()) for n in TOLD), pa.array(verified, pa.bool_())], ["doc_id", *TOLD, "verified"])


TOLD = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]


def verified(entries: DataFrame) -> DataFrame:
    """A manifest with tampered (a leaf as somebody shows it, null: the original one) -> doc_id, leaf, subroot, root,
    proof_sha256, folded_root (from the shown leaf and the original siblings), verified."""
    kind = entries.schema["doc_id"].dataType.simpleString()
    return entries.select("doc_id", "leaf", "subroot", "root", "witness", "path", "tampered").mapInArrow(_verify, f"doc_id {kind}, {', '.join(f'{n} string' for n in TOLD)}, verified boolean")


def tampered(docs: DataFrame) -> DataFrame:
    """docs with tampered: the leaf of rows whose decimal doc_id has an even crc32, once their text has lost its line feeds;
    null for others, and for rows with a null id."""
    shown = record_digest(*map(F.col, ("doc_id", "source", "lang", "n_chars")), F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    return docs.select("doc_id", "source", "lang", "n_chars", "text").withColumn("tampered", F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.unhex(shown)))


def verified_rows(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of docs, held against their tampered leaves."""
    return verified(manifest(tampered(docs), ["tampered"], levels))
