"""Approximate nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions by several random rotations, shifted, and ordered along a Hilbert curve.
Each ordering is cut into windows of keys of about equal numbers of rows by a sample; a query takes the rows of the
window of its own key and of the windows nearest to it, those of largest inner product with the mean of their sampled
rows, scores them exactly, and the best of all orderings are merged. Only a table that fits one window is scored whole.

How many orderings and windows there are, and how many windows a query takes, follows from a bounded sample of queries,
whose true neighbours one pass over all rows finds: of the choices that find at least TARGET of them, the one of least
work. A query takes as many windows as that needs, so that no size of table and no distribution of lengths falls short.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import U64, mix, tidy, tidy_group, written

#: Dimensions of a projection, bits of a coordinate, bits that order rows of one cell.
DIMENSIONS, BITS, TIE_BITS = 8, 6, 15
#: Numbers of orderings to choose from, share of the sampled queries' neighbours to be found, sampled queries.
CURVES, TARGET, SAMPLED = (2, 3, 4, 6, 8), 0.94, 256
#: Sampled rows, and components of them, at most; sampled rows of a block at least.
SAMPLE, SAMPLE_VALUES, BLOCK_SAMPLE = 8192, 1 << 23, 32
#: Rows that are one block, and numbers of blocks to choose from for a query, besides all.
ONE_BLOCK, TAKEN = 4096, (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 14, 16, 20, 24, 28, 32, 40, 48, 64, 80, 96, 112, 128, 144, 160, 192, 224)
#: Rows and queries of a group; scores that take as long as moving one row.
ROW_PART, QUERY_PART, MOVE = 4096, 4096, 500


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places of integer points (rows, coordinates below 2**bits) along the Hilbert curve of their dimensions.

    Gray-code transposition by whole columns: from the highest bit, coordinates are exchanged or inverted by the bits
    above, then the bits of all coordinates are interleaved.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(n):
            flip = (x[i] & level) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    fix = np.zeros(x.shape[1], np.int64)
    level = 1 << (bits - 1)
    while level > 1:
        fix ^= np.where((x[-1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= fix
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def directions(width: int, curve: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """An ordering's projection (orthogonal directions) and shift."""
    rng = np.random.default_rng([seed, curve, width])
    q, _ = np.linalg.qr(rng.normal(size=(max(width, DIMENSIONS), DIMENSIONS)))
    return q[:width], rng.random(DIMENSIONS)


def lifted(x: np.ndarray, longest: float, asks: bool) -> np.ndarray:
    """Vectors with one more coordinate, all of one length, so that the nearest row is that of largest inner product.

    A row's is what its length lacks of the longest; a query has 0 there and is stretched to that length.
    """
    square = (x * x).sum(axis=1)
    if asks:
        return np.column_stack([x * (longest / np.sqrt(square))[:, None], np.zeros(len(x))])
    return np.column_stack([x, np.sqrt(np.maximum(longest**2 - square, 0))])


class Ordering:
    """A curve through the vectors of one width; each projection is measured by the quantiles of a sample's."""

    def __init__(self, sample: np.ndarray, ids: np.ndarray, longest: float, curve: int, seed: int):
        self.longest = longest
        self.to, self.shift = directions(sample.shape[1] + 1, curve, seed)
        levels = (np.arange(1, 4 << BITS) * len(sample)) // (4 << BITS)
        self.levels = np.sort(lifted(sample, longest, False) @ self.to, axis=0)[levels]
        keys = self.keys(sample, ids, False)
        order = np.argsort(keys, kind="stable")
        self.sorted, self.rows = keys[order], sample[order]

    def keys(self, x: np.ndarray, ids: np.ndarray, asks: bool) -> np.ndarray:
        p = lifted(x, self.longest, asks) @ self.to
        share = np.column_stack([np.searchsorted(a, b, side="right") for a, b in zip(self.levels.T, p.T, strict=True)]) / (len(self.levels) + 1)
        cell = ((share * 0.75 + self.shift * 0.25) * (1 << BITS)).astype(np.int64)
        tie = mix(ids.astype(np.int64).view(U64)) >> U64(64 - TIE_BITS)
        return (hilbert_keys(cell, BITS) << TIE_BITS) | tie.astype(np.int64)

    def blocks(self, keys: np.ndarray, blocks: int) -> np.ndarray:
        ends = self.sorted if len(self.sorted) == blocks - 1 else self.sorted[np.arange(1, blocks) * len(self.sorted) // blocks]
        return np.searchsorted(ends, keys, side="right")

    def cut(self, blocks: int) -> None:
        """Settle the number of blocks: their ends and the means of their sampled rows are what is left of the sample."""
        own = self.blocks(self.sorted, blocks)
        self.means = np.zeros((blocks, self.rows.shape[1]))
        np.add.at(self.means, own, self.rows)
        self.means /= np.maximum(np.bincount(own, minlength=blocks), 1)[:, None]

    def nearest_blocks(self, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Each query's blocks: its own, then by the inner product with their means."""
        near = x @ self.means.T
        near[np.arange(len(x)), self.blocks(self.keys(x, ids, True), len(self.means))] = np.inf
        return np.argsort(-near, axis=1, kind="stable")


@dataclass
class Plan:
    """Orderings, blocks and the number of blocks that a query takes, for the vectors of one width (no orderings and one
    block: they fit one), and parts of a block."""

    orderings: list[Ordering]
    blocks: int
    taken: int
    row_parts: int
    query_parts: int
    #: Share of the sampled queries' true neighbours that this finds, and of all pairs that are scored, in each ordering anew.
    recall: float = 1.0
    scored: float = 1.0


def parts(rows: int, queries: int, blocks: int, taken: int) -> tuple[int, int]:
    """Parts into which a block's rows and its queries are dealt, so that no group grows with the table."""
    return max(1, -(-rows // (blocks * ROW_PART))), max(1, -(-queries * taken // (blocks * QUERY_PART)))


def work(rows: int, queries: int, curves: int, blocks: int, taken: int) -> float:
    r, q = parts(rows, queries, blocks, taken)
    return curves * (queries * rows * taken / blocks + MOVE * (rows * q + queries * taken * r))


def planned(rows: int, queries: int, sample: np.ndarray, ids: np.ndarray, longest: float, asked: list[tuple], seed: int) -> Plan:
    """The choice of least work that finds TARGET of the true neighbours of the sampled queries.

    asked: for each of them its vector, its id, and its neighbours' vectors and ids. A query that takes all blocks finds
    every neighbour, so there is always a choice.
    """
    most = 1
    while 2 * most * BLOCK_SAMPLE <= len(sample):
        most *= 2
    asked = [a for a in asked if len(a[3])]
    if most < 4 or not asked or not np.isfinite(longest):
        return Plan([], 1, 1, *parts(rows, queries, 1, 1))
    choices = [(work(rows, queries, c, 2**b, t), c, 2**b, t) for c in CURVES for b in range(2, most.bit_length()) for t in (*TAKEN, 2**b) if t <= 2**b]
    q, q_ids = np.array([a[0] for a in asked]), np.array([a[1] for a in asked])
    near, near_ids = np.concatenate([a[2] for a in asked]), np.concatenate([a[3] for a in asked])
    owner = np.repeat(np.arange(len(asked)), [len(a[3]) for a in asked])
    made = [Ordering(sample, ids, longest, c, seed) for c in range(max(CURVES))]
    near_keys = [o.keys(near, near_ids, False) for o in made]
    turn: dict[int, np.ndarray] = {}  # when a neighbour's block comes up among its query's, in the first orderings
    for _, curves, blocks, taken in sorted(choices):
        if blocks not in turn:
            each = []
            for o, keys in zip(made, near_keys, strict=True):
                o.cut(blocks)
                each.append(np.argsort(o.nearest_blocks(q, q_ids), axis=1)[owner, o.blocks(keys, blocks)])
            turn[blocks] = np.minimum.accumulate(each)
        met = turn[blocks][curves - 1] < taken
        if met.mean() >= TARGET:
            for o in made[:curves]:
                o.cut(blocks)
                o.sorted, o.rows = o.sorted[np.arange(1, blocks) * len(o.sorted) // blocks], None  # what tasks need
            return Plan(made[:curves], blocks, taken, *parts(rows, queries, blocks, taken), float(met.mean()), curves * taken / blocks)
    raise AssertionError("a query that takes all blocks misses nothing")


def _matrix(column, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _by_width(batches):
    """(width, rows, their vectors) of batches."""
    for batch in batches:
        widths = batch.column("width").to_numpy(zero_copy_only=False)
        for width in np.unique(widths).tolist():
            rows = batch.take(pa.array(np.flatnonzero(widths == width)))
            yield width, rows, _matrix(rows.column("embedding"), width)


def top(y: np.ndarray, ids: np.ndarray, x: np.ndarray, own: np.ndarray, k: int):
    """For each query of x the places of the k rows of y of highest score, without its own id, and their scores.

    One product of matrices gives scores but for rounding; those that can be among the k are computed again row by
    row, so that equal vectors get equal scores.
    """
    long = np.sqrt((y * y).sum(axis=1).max()) if len(y) else 0.0
    for lo in range(0, len(x), 256):
        rough = x[lo : lo + 256] @ y.T
        for v, i, s in zip(x[lo : lo + 256], own[lo : lo + 256], rough, strict=True):
            other = ids != i
            at = np.flatnonzero(other)
            if len(at) > k and np.isfinite(s).all():
                least = np.partition(s[at], len(at) - k)[len(at) - k]
                at = np.flatnonzero(other & (s >= least - 1e-12 * len(v) * np.sqrt(v @ v) * long))
            sure = np.einsum("ij,j->i", y[at], v)
            order = np.lexsort((ids[at], -sure))[:k]
            yield at[order], sure[order]


def _truth(asked: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    """Rows -> the best of each task for each sampled query, by its width and number."""

    def run(batches):
        best: dict = {}
        for width, rows, y in _by_width(batches):
            if width not in asked:
                continue
            ids = rows.column("vec_id").to_numpy()
            for n, (at, score) in enumerate(top(y, ids, *asked[width], k)):
                old = best.get((width, n), (np.zeros(0), np.zeros(0, np.int64), np.zeros((0, width))))
                s, i, v = np.append(old[0], score), np.append(old[1], ids[at]), np.concatenate([old[2], y[at]])
                keep = np.lexsort((i, -s))[:k]
                best[width, n] = s[keep], i[keep], v[keep]
        for (width, n), (s, i, v) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), width, np.int32)), pa.array(np.full(len(i), n, np.int32)), pa.array(s), pa.array(i), pa.array(list(v), pa.list_(pa.float64()))], names=["width", "asked", "score", "vec_id", "embedding"])

    return run


def plans(rows: DataFrame, k: int, seed: int) -> dict[int, Plan]:
    """A plan for each width of rows (width, vec_id, embedding, asks, answers)."""
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    sizes = rows.groupBy("width").agg(F.count_if("answers").alias("rows"), F.count_if("asks").alias("queries"), F.max(norm).alias("longest")).collect()
    out, large = {}, {}
    for s in sizes:
        out[s["width"]] = Plan([], 1, 1, *parts(s["rows"], s["queries"], 1, 1))
        if s["queries"] and s["rows"] > ONE_BLOCK:
            large[s["width"]] = s
    chance = F.xxhash64("vec_id", "embedding", F.lit(seed))
    asked, samples = {}, {}
    for width, s in large.items():
        own = rows.where(F.col("width") == width)
        n = min(SAMPLE, max(1, SAMPLE_VALUES // width))
        below = int(-(2**63) + min(1.0, n / s["rows"]) * (2**64 - 2049))
        picked = own.where("answers").where(chance <= F.lit(below)).select("vec_id", "embedding").toArrow()
        samples[width] = _matrix(picked.column("embedding"), width), picked.column("vec_id").to_numpy()
        first = own.where("asks").orderBy(chance, "vec_id").limit(SAMPLED).select("vec_id", "embedding").toArrow()
        asked[width] = _matrix(first.column("embedding"), width), first.column("vec_id").to_numpy()
    if not large:
        return out
    order = Window.partitionBy("width", "asked").orderBy(F.desc("score"), "vec_id")
    found = rows.where("answers").mapInArrow(tidy(_truth(asked, k)), "width int, asked int, score double, vec_id long, embedding array<double>")
    near: dict = {}
    for r in found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).collect():
        near.setdefault((r["width"], r["asked"]), []).append((r["embedding"], r["vec_id"]))
    for width, s in large.items():
        told = [(v, i, np.array([e for e, _ in x]), np.array([j for _, j in x])) for n, (v, i) in enumerate(zip(*asked[width], strict=True)) if (x := near.get((width, n)))]
        out[width] = planned(s["rows"], s["queries"], *samples[width], s["longest"], told, seed)
    return out


CELL = ["width", "curve", "block", "query_part", "row_part"]
CELLS = "width int, curve int, block int, query_part int, row_part int, "


def _dealt(chosen: dict[int, Plan]):
    """Rows -> rows of cells: answers in their own block of each ordering, queries in all blocks of their window."""

    def run(batches):
        for width, rows, x in _by_width(batches):
            plan, ids = chosen[width], rows.column("vec_id").to_numpy()
            part = mix(ids.astype(np.int64).view(U64) + U64(1))
            for asks in (False, True):
                at = np.flatnonzero(rows.column("asks" if asks else "answers").to_numpy(zero_copy_only=False))
                own, other = (plan.query_parts, plan.row_parts) if asks else (plan.row_parts, plan.query_parts)
                mine = (part[at] % U64(own)).astype(np.int32)
                if not len(at):
                    continue
                took, n = rows.take(pa.array(at)), len(at)
                for c, o in enumerate(plan.orderings or [None]):
                    if o is None:
                        blocks = np.zeros((n, 1), np.int64)
                    elif asks:
                        blocks = o.nearest_blocks(x[at], ids[at])[:, : plan.taken]
                    else:
                        blocks = o.blocks(o.keys(x[at], ids[at], False), plan.blocks)[:, None]
                    for block in blocks.T.astype(np.int32):
                        for p in range(other):
                            those = np.full(n, p, np.int32)
                            q, r = (mine, those) if asks else (those, mine)
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, width, np.int32)), pa.array(np.full(n, c, np.int32)), pa.array(block), pa.array(q), pa.array(r), took.column("vec_id"), took.column("embedding"), pa.array(np.full(n, asks))], names=[*CELL, "vec_id", "embedding", "asks"])

    return run


def once(y: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows without those of an id and a vector that are there already."""
    if len(np.unique(ids)) == len(ids):
        return y, ids
    first = {(i, v.tobytes()): n for n, (i, v) in reversed(list(enumerate(zip(ids.tolist(), y, strict=True))))}
    keep = np.sort(np.fromiter(first.values(), np.int64))
    return y[keep], ids[keep]


def _search(k: int):
    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        width = table.column("width")[0].as_py() if table.num_rows else 0
        (x, own), (y, ids) = ((_matrix(t.column("embedding"), width), t.column("vec_id").to_numpy()) for t in (table.filter(pa.array(asks)), table.filter(pa.array(~asks))))
        y, ids = once(y, ids)
        found = [(np.full(len(at), i), ids[at], score) for i, (at, score) in zip(own, top(y, ids, x, own, k), strict=True)] if len(x) and len(y) else []
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({n: pa.array(c) for n, c in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    return run


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, seed: int = 3) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows found of largest inner product for each row whose id every divides.

    All rows are indexed; those with a null id, or a null, empty or zero vector, or one with null or non-finite components,
    take no part. A row that is there more than once answers once. Of rows with equal vectors the k + 1 smallest ids answer: no others can be among the k. Scores are
    inner products of the original vectors in double precision; ties go to the smaller id. Vectors of different
    widths don't meet. Other columns, whatever their names, are ignored; an empty table gives no rows. Orderings and blocks are chosen so that at least TARGET of the true
    neighbours of sampled queries are found, whatever the rows and the number of partitions.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null and size(embedding) > 0")
    rows = rows.where(~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0))
    alike = Window.partitionBy("embedding").orderBy("vec_id")
    firsts = rows.withColumn("alike", F.dense_rank().over(alike)).where(F.col("alike") <= k + 1).select("vec_id", "embedding", (F.col("vec_id") % every == 0).alias("asks"), F.lit(True).alias("answers"))
    # queries that are no candidates themselves
    asking = rows.where(F.col("vec_id") % every == 0)
    asking = asking.join(firsts.where("asks").select("vec_id").distinct(), "vec_id", "left_anti").distinct().select("vec_id", "embedding", F.lit(True).alias("asks"), F.lit(False).alias("answers"))
    every_row = written(firsts.unionByName(asking).withColumn("width", F.size("embedding")), "vectors")
    dealt = every_row.mapInArrow(tidy(_dealt(plans(every_row, k, seed))), CELLS + "vec_id long, embedding array<double>, asks boolean")
    found = dealt.groupBy(*CELL).applyInArrow(tidy_group(_search(k)), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
