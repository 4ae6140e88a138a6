"""N-gram Jaccard join: a size-aware heavy-light join over word shingles.

Light (small) sets enumerate fixed-size subsets of themselves, heavy (large) sets scan inverted lists of their
rarest shingles; the boundary between the two is chosen by cost. Documents that meet in a list are candidates; each
list first links its members to a few leaders, and only members of different components are then compared. Long lists
bring whole sets to blocks, which verify pairs in place and tell no more links than join their members, so that a
group of copies or near copies never becomes all of its pairs. Every link is verified on whole sets of 64-bit hashes.
"""

from __future__ import annotations

import zlib
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIX_B, U64, discard, mix, shingles, slices, text_or_empty, tidy, utf8, word_hashes, written
from .components import components

#: Counters that estimate how frequent a shingle is. They only order shingles: any order gives the same links.
COUNTER_BITS = 22
#: Largest set that may be light.
MOST_LIGHT = 14
#: Members of a long list's part; a block holds one part or two.
BLOCK = 256
#: Turns in which members of a list are compared with another leader before all of what is left is paired.
LEADERS = 1
#: Lists of more members are verified in blocks; shorter ones tell their pairs, fewer than LONG / 2 for each member.
LONG = 32
#: Lists that are dealt out over HOT_SPLIT parts: those of counters above HOT times the mean.
HOT, HOT_SPLIT = 64, 16


def needed(size):
    """Overlap that a set of this size shares with any partner: ceil(0.8 * size)."""
    return (4 * size + 4) // 5


def deletions(size: int) -> int:
    """How many elements a light set may lack of the subset that it shares with a light partner."""
    return size - needed(size)


def _sets(batch: pa.RecordBatch, size: int):
    for part in slices(batch, "text"):
        data, at = utf8(part.column("text"))
        words, word_at = word_hashes(data, at)
        for i in range(part.num_rows):
            yield part, i, shingles(words[word_at[i] : word_at[i + 1]], size)


def _count(size: int):
    def run(batches):
        counts = np.zeros(1 << COUNTER_BITS, np.uint32)
        sizes = np.zeros(MOST_LIGHT * 2 + 1, np.int64)
        for batch in batches:
            for _, _, s in _sets(batch, size):
                np.add.at(counts, (s >> U64(64 - COUNTER_BITS)).astype(np.int64), 1)
                sizes[min(len(s), len(sizes) - 1)] += 1
        for k, piece in enumerate(np.split(counts, 64)):
            yield _counters(k, piece)
        yield _counters(64, sizes)

    return run


def _counters(k: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"part": pa.array([k], pa.int32()), "counts": [zlib.compress(values.astype("<i8").tobytes(), 1)]})


def _add(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            v = np.frombuffer(zlib.decompress(blob.as_py()), "<i8")
            sums[k] = sums[k] + v if k in sums else v
    for k, v in sums.items():
        yield _counters(k, v)


def shingle_counters(docs: DataFrame, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """How many sets of all documents fall on each of a fixed number of counters, and how many small sets there are.

    Counters are added in two streaming steps; what the driver gets is their fixed number, whatever the input.
    """
    spread = docs.select("text").mapInArrow(tidy(_count(size)), "part int, counts binary")
    some = spread.repartition(64, "part", F.expr("cast(rand(7) * 8 as int)")).mapInArrow(_add, "part int, counts binary")
    rows = some.repartition(16, "part").mapInArrow(_add, "part int, counts binary").collect()
    parts = {r["part"]: np.frombuffer(zlib.decompress(r["counts"]), "<i8") for r in rows}
    if not parts:
        return np.zeros(1 << COUNTER_BITS, np.int32), np.zeros(MOST_LIGHT * 2 + 1, np.int64)
    return np.minimum(np.concatenate([parts[k] for k in range(64)]), 2**31 - 1).astype(np.int32), parts[64]


def light_boundary(counts: np.ndarray, sizes: np.ndarray) -> int:
    """The largest size for which enumerating subsets costs no more than scanning the lists of its rarest shingles."""
    total = counts.sum(dtype=np.float64)
    background = total / len(counts)
    scanned = max(0.0, float((counts.astype(np.float64) ** 2).sum() / max(total, 1)) - background)
    best, least = 0, None
    for bound in range(MOST_LIGHT + 1):
        cost = 0.0
        for n in range(1, len(sizes) - 1):
            rare = n - needed(n) + 1
            if n <= bound:
                cost += sizes[n] * sum(comb(n, k) for k in range(deletions(n) + 1))
            if n > bound or n >= needed(bound + 1):
                cost += sizes[n] * rare * (1 + scanned)
        if least is None or cost <= least:
            best, least = bound, cost
    return best


def subset_keys(s: np.ndarray) -> np.ndarray:
    """Keys of the subsets that a light set shares with any light partner: itself, and itself with a few left out."""
    salted = mix(s ^ MIX_B)
    whole = salted.sum(dtype=U64)
    out: list[np.ndarray] = []
    for k in range(deletions(len(s)) + 1):
        left = len(s) - k
        for gone in combinations(range(len(s)), k):
            out.append(np.array([int(whole) - int(salted[list(gone)].sum(dtype=U64)) + left & 2**64 - 1], U64))
    return mix(np.concatenate(out))


def bitmap(s: np.ndarray) -> bytes:
    """One bit for each hash modulo a power of two of about four times the set's size: bits that differ between two
    sets are elements that differ, and few of those are hidden by others."""
    width = max(64, 1 << int(4 * len(s) - 1).bit_length()) if len(s) else 64
    bits = np.zeros(width, np.uint8)
    bits[(s & U64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _rows(size: int, order, boundary: int):
    def run(batches):
        counts = order.value
        hot_from = max(1000, HOT * float(counts.mean()))
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "n", "sig", "bits", "keys", "hot")}
            for part, i, s in _sets(batch, size):
                n = len(s)
                keys, hot = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if n:
                    if n > boundary or n >= needed(boundary + 1):
                        c = counts[(s >> U64(64 - COUNTER_BITS)).astype(np.int64)]
                        rare = np.argsort(c, kind="stable")[: n - needed(n) + 1]
                        busy = c[rare] > hot_from
                        keys, hot = s[rare[~busy]].view(np.int64), s[rare[busy]].view(np.int64)
                    if n <= boundary:
                        keys = np.concatenate([keys, subset_keys(s).view(np.int64)])
                out["doc_id"].append(part.column("doc_id")[i].as_py())
                out["n"].append(n)
                out["sig"].append(np.array([s.sum(dtype=U64), mix(s).sum(dtype=U64), n], U64).tobytes() if n else None)
                out["bits"].append(bitmap(s))
                out["keys"].append(keys)
                out["hot"].append(hot)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["n"], pa.int64()), pa.array(out["sig"], pa.binary()), pa.array(out["bits"], pa.binary()), pa.array(out["keys"], pa.list_(pa.int64())), pa.array(out["hot"], pa.list_(pa.int64()))],
                names=list(out),
            )

    return run


def _lists(batches):
    """Rows sorted by key, size and node -> the members of lists of two or more, with the list's first as leader.

    Streams: holds the current list's leader alone. A list that is dealt out in parts is kept even where a part has one.
    """
    last = None  # key, salt, node, size of the open list's leader, told
    for batch in batches:
        if not batch.num_rows:
            continue
        key, salt, node, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "salt", "node", "n"))
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
        if last and key[0] == last[0] and salt[0] == last[1]:
            new[0] = False
        head = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
        lead = np.where(head >= 0, node[np.maximum(head, 0)], last[2] if last else 0)
        lead_n = np.where(head >= 0, size[np.maximum(head, 0)], last[3] if last else 0)
        follows = ~new
        told = follows | (salt >= 0)
        told[:-1] |= follows[1:]
        extra = []
        if last and not last[4] and follows[0]:
            extra = [last]
        k = np.flatnonzero(told)
        cols = [key[k], salt[k], node[k], size[k], lead[k], lead_n[k]]
        if extra:
            k0, s0, v0, n0, _ = extra[0]
            cols = [np.concatenate([[x], c]) for x, c in zip((k0, s0, v0, n0, v0, n0), cols, strict=True)]
        if head[-1] >= 0:
            last = (key[-1], salt[-1], lead[-1], lead_n[-1], bool(told[head[-1]]))
        else:
            last = (*last[:4], True) if follows[0] else last
        if len(cols[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["key", "salt", "node", "n", "leader", "leader_n"])


def apart(bits: list[bytes], n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether bitmaps rule out a link of members i and j; of two widths the wider is folded."""
    size = np.array([len(b) for b in bits])
    out = np.zeros(len(i), bool)
    for a in np.unique(size):
        for b in np.unique(size):
            at = np.flatnonzero((size[i] == a) & (size[j] == b))
            if not len(at):
                continue
            w = min(a, b)
            sides = []
            for side, k in ((a, i), (b, j)):
                members = np.unique(k[at])
                grid = np.stack([np.frombuffer(bits[m], np.uint8) for m in members]).reshape(len(members), side // w, w)
                sides.append((np.bitwise_or.reduce(grid, axis=1).view(np.uint64), np.searchsorted(members, k[at])))
            for lo in range(0, len(at), 50_000):
                x, y = (grid[place[lo : lo + 50_000]] for grid, place in sides)
                k = at[lo : lo + 50_000]
                out[k] = 9 * np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) > n[i[k]] + n[j[k]]
    return out


def _pairs(batches):
    """Rows of short lists, sorted by key -> pairs of members of different components whose sizes allow a link."""
    held: list[pd.DataFrame] = []

    def told(frame: pd.DataFrame):
        key, node, comp, n = (frame[c].to_numpy() for c in ("key", "node", "component", "n"))
        xs, ys = [], []
        for step in range(1, LONG):
            i = np.arange(len(key) - step)
            i = i[key[i] == key[i + step]]
            if not len(i):
                break
            j = i + step
            ok = (comp[i] != comp[j]) & (4 * n[i] <= 5 * n[j]) & (4 * n[j] <= 5 * n[i])
            xs.append(np.minimum(node[i], node[j])[ok])
            ys.append(np.maximum(node[i], node[j])[ok])
        if xs:
            p = np.unique(np.stack([np.concatenate(xs), np.concatenate(ys)], 1), axis=0)
            if len(p):
                yield pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], names=["x", "y"])

    for batch in batches:
        frame = batch.to_pandas()
        if not len(frame):
            continue
        whole = pd.concat([*held, frame])
        tail = whole["key"].to_numpy() == frame["key"].iloc[-1]
        held = [whole[tail]]
        if not tail.all():
            yield from told(whole[~tail])
    if held:
        yield from told(pd.concat(held))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """How many elements two sorted sets share."""
    a, b = (a, b) if len(a) < len(b) else (b, a)
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = overlap(a, b)
    return 100 * both >= 80 * (len(a) + len(b) - both)


def spanning_links(node: np.ndarray, component: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links between members of left and members of right that join components, each pair verified on whole sets.

    Pairs whose ends earlier links have joined already are left out, so there are fewer links than members.
    """
    size = np.array([len(x) for x in sets])
    ok = (component[left][:, None] != component[right][None, :]) & (4 * size[left][:, None] <= 5 * size[right][None, :]) & (4 * size[right][None, :] <= 5 * size[left][:, None])
    i, j = np.nonzero(ok)
    i, j = left[i], right[j]
    once = node[i] < node[j] if len(left) == len(right) and (left == right).all() else np.ones(len(i), bool)
    i, j = i[once], j[once]
    bits = [bitmap(x) for x in sets]
    near = ~apart(bits, size, i, j)
    above = dict.fromkeys(component.tolist())

    def root(c):
        while above[c] is not None:
            if above[above[c]] is not None:
                above[c] = above[above[c]]
            c = above[c]
        return c

    out = []
    for x, y in zip(i[near].tolist(), j[near].tolist(), strict=True):
        p, q = root(int(component[x])), root(int(component[y]))
        if p != q and linked(sets[x], sets[y]):
            above[p] = q
            out.append((int(node[x]), int(node[y])))
    return out


def _in_blocks(batches):
    """Rows of blocks (key, bi, bj) with whole sets, sorted by block -> links that join their members' components."""
    held: list[tuple] = []

    def told():
        (_, bi, bj), _, _, _, _ = held[0]
        node, component, own = (np.array([h[c] for h in held], np.int64) for c in (1, 2, 3))
        sets = [np.frombuffer(h[4], U64) for h in held]
        found = spanning_links(node, component, sets, np.flatnonzero(own == bi), np.flatnonzero(own == bj))
        if found:
            a, b = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        for key, bi, bj, node, component, own, elements in zip(*(batch.column(c).to_pylist() for c in ("key", "bi", "bj", "node", "component", "own", "elements")), strict=True):
            if held and held[0][0] != (key, bi, bj):
                yield from told()
                held = []
            held.append(((key, bi, bj), node, component, own, elements))
    if held:
        yield from told()


def _bound(batches):
    """Keep pairs that the bitmaps don't rule out: bits that differ are elements that differ."""
    for batch in batches:
        x, y, nx, ny = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("x", "y", "nx", "ny"))
        keep = np.zeros(len(x), bool)
        for i, (a, b) in enumerate(zip(batch.column("bx").to_pylist(), batch.column("by").to_pylist(), strict=True)):
            a, b = (np.unpackbits(np.frombuffer(v, np.uint8)) for v in (a, b))
            w = min(len(a), len(b))
            a, b = a.reshape(-1, w).any(axis=0), b.reshape(-1, w).any(axis=0)
            keep[i] = 9 * int((a != b).sum()) <= int(nx[i] + ny[i])
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]), pa.array(y[keep])], names=["x", "y"])


def _whole_sets(size: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [(p.column("doc_id")[i].as_py(), s.tobytes()) for p, i, s in _sets(part, size)]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["node", "elements"])

    return run


def _verify(batches):
    for batch in batches:
        x, y = batch.column("x").to_numpy(), batch.column("y").to_numpy()
        sides = zip(batch.column("ex"), batch.column("ey"), strict=True)
        keep = np.array([linked(*(np.frombuffer(v.as_buffer(), U64) for v in pair)) for pair in sides], bool)
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]), pa.array(y[keep])], names=["a", "b"])


#: Bits of the filter that keeps texts without candidates from being shuffled: a fixed size, whatever the input.
FILTER_BITS = 1 << 23


def _elements(ends: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """node, elements: the whole sets of the nodes in ends, whose node is a text's doc_id."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = ends.select(F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS)).alias("p"))
    words = words.groupBy(F.shiftright("p", 5).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 31 as int)))").alias("mask"))
    maybe = docs.select("doc_id", "text", place.alias("p")).withColumn("word", F.shiftright("p", 5)).join(F.broadcast(words), "word").where(F.expr("(shiftright(mask, cast(p & 31 as int)) & 1) = 1"))
    sets = maybe.select("doc_id", "text").mapInArrow(tidy(_whole_sets(size)), "node long, elements binary")
    return written(sets.join(ends, "node", "left_semi").distinct(), "elements")


def _links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """The candidate pairs (x, y) that link: first bounded by bitmaps, then verified on the whole sets. Written."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"b{c}"))
    close = written(pairs.join(side("x"), "x").join(side("y"), "y").mapInArrow(tidy(_bound), "x long, y long"), "close")
    sets = _elements(close.select(F.explode(F.array("x", "y")).alias("node")).distinct(), docs, size)
    side = lambda c: sets.select(F.col("node").alias(c), F.col("elements").alias(f"e{c}"))
    out = written(close.join(side("x"), "x").join(side("y"), "y").mapInArrow(tidy(_verify), "a long, b long").distinct(), "links")
    discard(close, sets)
    return out


def _long_links(open_: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """Links between members (key, members, node, n, component) of long lists, verified in blocks of their parts."""
    part = open_.withColumn("blocks", F.ceil(F.col("members") / BLOCK)).withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    part = part.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    block = part.select("key", "node", "component", "own", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"))
    sets = _elements(open_.select("node").distinct(), docs, size)
    block = block.join(sets, "node")
    block = block.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
    out = written(block.mapInArrow(tidy(_in_blocks), "a long, b long").distinct(), "links", 64)
    discard(sets)
    return out


def jaccard_components(docs: DataFrame, size: int = 5) -> DataFrame:
    """Near-duplicate classes of all documents: doc_id, n_shingles, component_id, n_verified.

    Two documents link when 100 * |A & B| >= 80 * |A | B| for their sets of distinct word shingles; component_id is
    the smallest doc_id that links reach. n_verified counts the links that were verified: enough to join every class, not
    all of its pairs, and none for copies but a text's smallest doc_id. A null or empty text has an empty set and links with nothing. Rows with a null doc_id are kept
    with a null component_id and link with nothing; rows that share a doc_id are one node, with each row's own set.
    Other columns are ignored. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    counts, sizes = shingle_counters(docs, size)
    order, boundary = spark.sparkContext.broadcast(counts), light_boundary(counts, sizes)
    rows = docs.mapInArrow(tidy(_rows(size, order, boundary)), "doc_id long, n long, sig binary, bits binary, keys array<long>, hot array<long>")
    rows = written(rows, "sets")
    known = rows.where("sig is not null and doc_id is not null")
    nodes = known.groupBy("sig").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("bits").alias("bits"), F.first("keys").alias("keys"), F.first("hot").alias("hot"))
    nodes = written(nodes, "nodes")
    copies = known.select("sig", "doc_id").join(nodes.select("sig", "node"), "sig").where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))

    part = F.pmod(F.hash("node"), F.lit(HOT_SPLIT)).cast("long")
    listed = nodes.select(F.explode("keys").alias("key"), F.lit(-1).cast("long").alias("salt"), "node", "n")
    listed = listed.unionAll(nodes.select(F.explode("hot").alias("key"), part.alias("salt"), "node", "n"))
    lists = listed.repartition("key", "salt").sortWithinPartitions("key", "salt", "n", "node").mapInArrow(tidy(_lists), "key long, salt long, node long, n long, leader long, leader_n long")
    lists = written(lists, "lists")
    allowed = "4 * n <= 5 * leader_n and 4 * leader_n <= 5 * n and node <> leader"
    stars = written(lists.where(allowed).select(F.least("node", "leader").alias("x"), F.greatest("node", "leader").alias("y")).distinct(), "stars")
    facts = nodes.select("node", "n", "bits")
    links, tested, open_ = _links(stars, facts, docs, size), stars, lists.select("key", "node", "n")
    done = [nodes, lists, stars]
    for turn in range(LEADERS + 1):
        # lists whose members are in different components; as components only grow, fewer in each turn
        label = components(links)
        member = open_.join(label, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
        lead = F.min_by(F.struct("node", "n", "component"), F.xxhash64("key", "node", F.lit(turn))).alias("lead")
        crossed = member.groupBy("key").agg(F.count("*").alias("members"), F.min("component").alias("lo"), F.max("component").alias("hi"), lead).where("lo < hi").select("key", "members", "lead")
        crossed = written(crossed, "crossed")  # so that the join has shuffles of its own, whose hot keys can be split
        open_ = written(member.join(crossed, "key"), "open")
        done += [crossed, open_]
        if turn == LEADERS:
            break
        # each list has a leader of its own, so that a member of several lists is compared with several others
        near = open_.where("component <> lead.component and 4 * n <= 5 * lead.n and 4 * lead.n <= 5 * n")
        more = near.select(F.least("node", "lead.node").alias("x"), F.greatest("node", "lead.node").alias("y")).distinct().join(tested, ["x", "y"], "left_anti")
        more = written(more, "stars")
        links, tested = links.unionAll(_links(more, facts, docs, size)), tested.unionAll(more)
        done.append(more)
        open_ = open_.select("key", "node", "n")
    open_ = open_.drop("lead")
    links = links.unionAll(_long_links(open_.where(F.col("members") > LONG), docs, size))
    short = open_.where(F.col("members") <= LONG).select("key", "node", "n", "component")
    pairs = short.repartition("key").sortWithinPartitions("key").mapInArrow(tidy(_pairs), "x long, y long").distinct()
    pairs = written(pairs.join(tested, ["x", "y"], "left_anti"), "pairs")
    links = links.unionAll(_links(pairs, facts, docs, size)).distinct()
    final = components(copies.unionAll(links))
    discard(*done, pairs)
    degree = links.select(F.explode(F.array("a", "b")).alias("doc_id")).groupBy("doc_id").agg(F.count("*").alias("n_verified"))
    out = rows.select("doc_id", F.col("n").alias("n_shingles"))
    out = out.join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left").join(degree, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("n_verified", F.lit(0).cast("long")).alias("n_verified"))


def _identified(docs: DataFrame) -> tuple[DataFrame, bool]:
    """docs with rid, one number for each document: the doc_id, or, where texts that differ share it, a number of its own.

    Also whether there are such; they get numbers below all ids. Only ids and hashes are shuffled to find them.
    """
    named = docs.select("doc_id", F.xxhash64("text").alias("h")).where("doc_id is not null")
    shared = written(named.groupBy("doc_id").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo < hi").select(F.col("doc_id").alias("_shared")), "shared-ids")
    if not shared.limit(1).count():
        discard(shared)
        return docs.withColumn("rid", F.col("doc_id").cast("long")), False
    own = docs.join(shared, F.col("doc_id") == F.col("_shared"), "left_semi").select("doc_id", F.col("text").alias("_text")).distinct()
    low = docs.agg(F.min("doc_id").cast("long")).first()[0]
    own = written(own.withColumnRenamed("doc_id", "_id").withColumn("_n", F.lit(low - 1) - F.monotonically_increasing_id()), "shared-texts")
    met = (F.col("doc_id") == F.col("_id")) & F.col("text").eqNullSafe(F.col("_text"))
    return docs.join(own, met, "left").select(*docs.columns, F.coalesce("_n", F.col("doc_id").cast("long")).alias("rid")), True


def keep_one_of_each(docs: DataFrame, size: int = 5) -> DataFrame:
    """Documents without the near duplicates: of each class the rows of its smallest doc_id stay, repeated rows once.

    Rows that share a doc_id but not their text are documents of their own; of those in one class the one whose text
    has the smallest hash stays. Of rows that differ in other columns alone, that of the smallest hash stays. Rows with a
    null doc_id, or without words, all stay.
    """
    told, shared = _identified(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text"))
    if shared:
        told = written(told, "identified")  # so that numbers are the same wherever they are read
    classes = jaccard_components(told.select(F.col("rid").alias("doc_id"), "text"), size)
    if shared:
        member = classes.where("n_shingles > 0").select(F.col("doc_id").alias("rid"), "component_id").distinct()
        place = told.select("rid", F.struct("doc_id", F.xxhash64("text").alias("h")).alias("place")).where("rid is not null").distinct()
        member = member.join(place, "rid")
        kept = member.groupBy("component_id").agg(F.min_by("rid", "place").alias("kept"))
        gone = member.join(kept, "component_id").where("rid <> kept").select("rid")
    else:
        gone = classes.where("component_id <> doc_id").select(F.col("doc_id").alias("rid")).distinct()
    left = told.join(gone, "rid", "left_anti")
    # rows of one document: one stays, but those without words or id, which link with nothing
    loose = F.col("rid").isNull() | ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    several = classes.where("n_shingles > 0").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("rid"))
    single = left.where(loose).select("row").unionByName(left.where(~loose).join(several, "rid", "left_anti").select("row"))
    repeated = left.where(~loose).join(several, "rid", "left_semi").groupBy("rid").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return single.unionByName(repeated.select("row")).select("row.*")
