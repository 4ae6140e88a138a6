"""Exact top-k search: blocks of queries against all rows, one term at a time.

A term is a component's place. For each term the rows with a weight there are its postings; every query row with a
weight there scatters products into the dense scores of its block, and a partial selection keeps each query's best.
A block of queries has a bounded size and is broadcast; rows stream past it where they are read, and only the best of
each task are shuffled.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, tidy, written

#: Components of a block's queries, queries whose scores are held at once, candidates that are scored together.
BLOCK_VALUES, AT_ONCE, ROW_BLOCK = 1 << 21, 256, 4096
#: Blocks of queries that are broadcast at a time.
ROUND = 8
#: Sums of absolute products below this fit 64 bits whatever the rounding of the bound; others are added as Python integers.
NARROW = float(1 << 62)
#: Stands for lower scores too; as an answer it is refused.
LOWEST = -(1 << 63)


def _rows(vectors: pa.Array) -> np.ndarray:
    """A list column as rows of one width; what a shorter vector lacks is 0."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    at = np.concatenate([[0], np.cumsum(np.diff(vectors.offsets.to_numpy()))])
    size = np.diff(at)
    out = np.zeros((len(size), int(size.max(initial=0))))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - at[row]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def narrow(queries: np.ndarray, rows: np.ndarray) -> np.ndarray | None:
    """Which pairs surely have sums of products that fit 64 bits; None where all have."""
    width = min(queries.shape[1], rows.shape[1])
    q, r = np.abs(queries[:, :width]), np.abs(rows[:, :width])
    if not width or q.max(initial=0) * r.max(initial=0) * width < NARROW and max(q.max(initial=0), r.max(initial=0)) < NARROW:
        return None
    return (q @ r.T < NARROW) & (q.max(axis=1) < NARROW)[:, None] & (r.max(axis=1) < NARROW)[None, :]


def whole(vector: np.ndarray) -> list[int]:
    return [int(x) for x in vector]


def wide_best(query: np.ndarray, rows: np.ndarray, score: np.ndarray, fits: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """(place, score) of the k best of one query, with scores that may not fit 64 bits."""
    v = whole(query)
    exact = {int(i): int(score[i]) if fits[i] else sum(a * b for a, b in zip(v, whole(rows[i]), strict=False)) for i in np.flatnonzero(ids != own)}
    return heapq.nsmallest(k, exact.items(), key=lambda x: (-x[1], ids[x[0]]))


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Dense score arrays, accumulated term by term from postings with a weight."""
    out = np.zeros((len(queries), len(rows)), np.int64)
    for term in range(min(queries.shape[1], rows.shape[1])):
        asked, posted = np.flatnonzero(queries[:, term]), np.flatnonzero(rows[:, term])
        if len(asked) == len(queries) and len(posted) == len(rows):
            out += queries[:, term, None] * rows[None, :, term]
        elif len(asked) and len(posted):
            out[np.ix_(asked, posted)] += queries[asked, term, None] * rows[None, posted, term]
    return out


def best(score: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k highest scores without the query's own id, ties to smaller ids."""
    keep = np.flatnonzero(ids != own)
    s = score[keep]
    if len(keep) > k:
        least = np.partition(s, len(s) - k)[len(s) - k]
        sure = keep[s > least]
        tied = keep[s == least]
        keep = np.concatenate([sure, tied[np.argsort(ids[tied], kind="stable")[: k - len(sure)]]])
    return keep[np.lexsort((ids[keep], -score[keep]))]


def answers(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int):
    """For each query the ids and scores of its k best rows."""
    # what is too large for 64 bits is scored apart
    small = lambda x: np.where(np.abs(x) < NARROW, x, 0).astype(np.int64)
    small_rows = small(rows)
    for lo in range(0, len(queries), AT_ONCE):
        part = queries[lo : lo + AT_ONCE]
        dense, fits = scores(small(part), small_rows), narrow(part, rows)
        for n, (query, score) in enumerate(zip(own[lo : lo + AT_ONCE], dense, strict=True)):
            if fits is None or fits[n].all():
                at = best(score, ids, query, k)
                yield ids[at], score[at]
                continue
            found = wide_best(part[n], rows, score, fits[n], ids, query, k)
            if any(x >= 1 << 63 for _, x in found):
                raise OverflowError(f"a score of query {query} doesn't fit 64 bits")
            yield ids[[i for i, _ in found]], np.array([max(x, LOWEST) for _, x in found], np.int64)


def _search(block, k: int):
    def run(batches):
        queries, own = block.value
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(own)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROW_BLOCK):
                part = batch.slice(lo, ROW_BLOCK)
                found = answers(queries, own, _rows(part.column("v")), part.column("vec_id").to_numpy(), k)
                for n, (ids, score) in enumerate(found):
                    ids, score = np.append(held[n][0], ids), np.append(held[n][1], score)
                    if len(ids) > k:
                        keep = np.lexsort((ids, ~score))[:k]  # falls as the score rises, also at the least one
                        ids, score = ids[keep], score[keep]
                    held[n] = ids, score
        sizes = [len(ids) for ids, _ in held]
        for lo in range(0, len(held), 1000):
            some = held[lo : lo + 1000]
            columns = np.repeat(own[lo : lo + 1000], sizes[lo : lo + 1000]), np.concatenate([i for i, _ in some]), np.concatenate([x for _, x in some])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    return run


def exact_top_k(vectors: DataFrame, every: int = 100, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of highest integer inner product for each row whose id every divides.

    Components are floor(scale * x). Candidates are all rows but those of the query's own id. Left out on both sides:
    null ids, null vectors, and vectors with null or non-finite components. Scores are exact whatever the size
    of components; an answer whose score doesn't fit 64 bits is an error, as in SQL. A vector that lacks terms has weight 0
    there, an empty one everywhere. Repeated rows are candidates each; a query id that is there more than once is asked
    once for each different vector, and the best of all are its answer. An empty table gives none; other columns are
    ignored. Each block of queries is one pass over the rows, so passes grow with the queries, not with the rows. At most
    ROUND blocks are broadcast at a time; where there are more, a round's best are written and its blocks given up.
    """
    # whole but still doubles, as those of 2**63 and more aren't longs; from 2**53 on all doubles are whole
    floor = lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: floor(x.cast("double") * scale)).alias("v"), "embedding")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", bad)).drop("embedding")
    queries = rows.where(F.col("vec_id") % every == 0).distinct()
    facts = queries.agg(F.coalesce(F.sum(F.size("v") + 1), F.lit(0))).first()[0]
    blocks = max(1, -(-facts // BLOCK_VALUES))
    queries = written(queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")), "queries")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = lambda df: df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    found = None
    for first in range(0, blocks, ROUND):
        held, some = [], None
        for block in range(first, min(first + ROUND, blocks)):
            few = queries.where(F.col("block") == block).select("vec_id", "v").toArrow()  # about BLOCK_VALUES components
            if few.num_rows:
                held.append(rows.sparkSession.sparkContext.broadcast((_rows(few.column("v")), few.column("vec_id").to_numpy())))
                more = rows.mapInArrow(tidy(_search(held[-1], k)), "query_id long, vec_id long, score long")
                some = more if some is None else some.unionAll(more)
        if some is not None and blocks > ROUND:
            some = written(best(some).drop("rank"), "answers")
            for block in held:
                block.destroy()
        if some is not None:
            found = some if found is None else found.unionAll(some)
    discard(queries)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "query_id long, vec_id long, score long")
    fits = F.when(F.col("score") == LOWEST, F.raise_error(F.lit("a score doesn't fit 64 bits")).cast("long")).otherwise(F.col("score"))
    return best(found).select("query_id", "rank", "vec_id", fits.alias("score"))
