"""Suffix-array dedup: every byte of a 200-byte string that starts anywhere else is removed.

Each 200-byte window is named by its least 64-byte gram; windows that follow each other and share that gram's place
are one run, and equal windows lie in runs of equal grams. Runs of equal digests repeat whole. Where runs of a gram
differ, one of each text goes to a shard, whose suffix array (induced sorting) and permuted common prefixes tell the
windows that repeat. So a shard holds what may repeat, not the corpus, and all occurrences of a string meet in one.
A gram with more different runs than a shard is to hold goes through the same again with longer grams.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, discard, mix, powers, slices, table_of_bytes, text_or_empty, tidy, utf8, written
from .suffix_arrays import repeated_prefixes, suffix_array

#: Bytes of a gram; windows that are looked at together; bytes of a shard.
GRAM, CHUNK, SHARD = 64, 1 << 18, 1 << 20
#: Runs of different text that one gram brings to a shard; those of others are named by grams one byte short of a
#: window, of which a run has two at most, so that few different ones share a gram.
MOST_RUNS = 20_000
#: Text of which a task joins equal runs before they are dealt out.
COMBINE = 16 << 20

BASE = 0xD6E8FEB86659FD93
LOW = U64(0xFFFFF)
_tables: dict = {}


def _hashing(n: int):
    """Bytes' values, powers and inverse powers of a rolling hash, for n places at least."""
    if _tables.get("n", 0) < n:
        _tables.update(n=n, set=(table_of_bytes(21, False), powers(BASE, n), powers(pow(BASE, -1, 1 << 64), n)))
    return _tables["set"]


def gram_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all grams of length bytes of at most CHUNK bytes and a window."""
    values, up, down = _hashing(CHUNK + 4096)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(values[data] * up[: len(data)], out=sums[1:])
    return mix((sums[length:] - sums[:-length]) * down[: len(data) - length + 1])


def digests(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """64-bit BLAKE2 digests of stretches of bytes; with its gram's hash a run's text is told by 128 bits."""
    raw = data.tobytes()
    return np.frombuffer(b"".join(hashlib.blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(lo.tolist(), hi.tolist(), strict=True)), "<u8")


def sliding_least(a: np.ndarray, width: int) -> np.ndarray:
    """Least of each width values in a row."""
    n = len(a)
    rows = -(-n // width)
    pad = np.full(rows * width, np.iinfo(np.uint64).max, U64)
    pad[:n] = a
    grid = pad.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def runs(data: np.ndarray, at: np.ndarray, window: int, length: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of windows of several texts in one buffer: text, start in it, windows, gram hash, digest of the run's bytes."""
    text_end = np.repeat(at[1:], np.diff(at))
    out = []
    for lo in range(0, max(len(data) - window + 1, 0), CHUNK):
        piece = data[lo : lo + CHUNK + window - 1]
        n = len(piece) - window + 1
        if n < 1:
            break
        valid = np.arange(lo, lo + n) + window <= text_end[lo : lo + n]
        if not valid.any():
            continue
        gram = gram_hashes(piece, length)
        place = np.arange(len(gram))
        least = (sliding_least((gram & ~LOW) | place.astype(U64), window - length + 1) & LOW).astype(np.int64)
        new = valid.copy()
        new[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
        first = np.flatnonzero(new)
        stop = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True)) + 1
        text = np.searchsorted(at, first + lo, side="right") - 1
        out.append((text, first + lo - at[text], stop - first, gram[least[first]], digests(piece, first, stop + window - 1)))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(U64), z.astype(U64)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


RUN = "gram long, same long, again boolean, rid long, start long, windows long"
SPAN = "kind int, gram long, same long, rid long, start long, stop long"


def _merged(rid: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each text joined where they touch."""
    if not len(rid):
        return rid, lo, hi
    order = np.lexsort((lo, rid))
    rid, lo, hi = rid[order], lo[order], hi[order]
    new = np.ones(len(rid), bool)
    # ends only grow within a text: spans of runs are nested or in order
    new[1:] = (rid[1:] != rid[:-1]) | (lo[1:] > hi[:-1])
    heads = np.flatnonzero(new)
    return rid[heads], lo[heads], np.maximum.reduceat(hi, heads)


def _runs(window: int, length: int):
    """Rows: gram and text hash of a run; again tells that the task has seen the run's text more than once.

    Of runs with equal text in a part of a task's input one goes on; the others come out as rows with no windows
    left to compare (start, -stop).
    """

    def told(held):
        rid, start, many, gram, same = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((same, gram))
        g, h = gram[order], same[order]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (h[1:] != h[:-1])
        group = np.cumsum(new) - 1
        twice = (np.bincount(group) > 1)[group] if len(g) else new
        k = order[new]
        yield _rows(gram[k], same[k], twice[new], rid[k], start[k], many[k])
        k = order[twice]
        r, lo, hi = _merged(rid[k], start[k], start[k] + many[k] + window - 1)
        yield _rows(mix(r.view(U64) ^ lo.astype(U64)), np.zeros(len(r), U64), np.ones(len(r), bool), r, lo, -hi)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                data, at = utf8(part.column("text"))
                rid = part.column("rid").to_numpy()
                text, *rest = runs(data, at, window, length)
                if len(text):
                    held.append((rid[text], *rest))
                n += len(data)
                if n >= COMBINE and held:
                    yield from told(held)
                    held, n = [], 0
        if held:
            yield from told(held)

    return run


def _rows(gram, same, again, rid, start, windows) -> pa.RecordBatch:
    signed = lambda a: pa.array(np.ascontiguousarray(a).view(np.int64))
    return pa.RecordBatch.from_arrays([signed(gram), signed(same), pa.array(again), pa.array(rid), pa.array(start), pa.array(windows)], names=["gram", "same", "again", "rid", "start", "windows"])


def _spans(kind: int, gram, same, rid, start, stop) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(rid), kind, np.int32)), *(pa.array(np.asarray(a, np.int64)) for a in (gram, same, rid, start, stop))], names=["kind", "gram", "same", "rid", "start", "stop"])


def _meet(window: int):
    """Runs sorted by gram and text -> kind 0: spans of runs whose text repeats; kind 1: one run of each text of a gram
    that has several. Streams: holds the first run of the open gram and the last row."""

    def run(batches):
        first = last = None  # (gram, same, rid, start, windows, told)
        for batch in batches:
            if not batch.num_rows:
                continue
            gram, same, again, rid, start, many = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            done = many < 0
            if done.any():
                yield _spans(0, gram[done], same[done], rid[done], start[done], -many[done])
                gram, same, again, rid, start, many = (a[~done] for a in (gram, same, again, rid, start, many))
            n = len(gram)
            if not n:
                continue
            new_gram, new = np.ones(n, bool), np.ones(n, bool)
            new_gram[1:] = gram[1:] != gram[:-1]
            new_gram[0] = last is None or gram[0] != last[0]
            new[1:] = new_gram[1:] | (same[1:] != same[:-1])
            new[0] = new_gram[0] or same[0] != last[1]
            covered = again | ~new
            covered[:-1] |= ~new[1:]
            if not new[0] and not last[5]:
                yield _spans(0, *([x] for x in (last[0], last[1], last[2], last[3], last[3] + last[4] + window - 1)))
            head = np.maximum.accumulate(np.where(new_gram, np.arange(n), -1))
            other = new & ~new_gram
            reps = np.unique(np.concatenate([np.flatnonzero(other), head[other & (head >= 0)]]))
            if (other & (head < 0)).any() and not first[5]:
                yield _spans(1, *([x] for x in (*first[:4], first[3] + first[4] + window - 1)))
                first = (*first[:5], True)
            if len(reps):
                yield _spans(1, gram[reps], same[reps], rid[reps], start[reps], start[reps] + many[reps] + window - 1)
            k = np.flatnonzero(covered)
            if len(k):
                r, lo, hi = _merged(rid[k], start[k], start[k] + many[k] + window - 1)
                yield _spans(0, np.zeros(len(r)), np.zeros(len(r)), r, lo, hi)
            if head[-1] >= 0:
                h = head[-1]
                first = (gram[h], same[h], rid[h], start[h], many[h], bool((other & (head == h)).any()))
            last = (gram[-1], same[-1], rid[-1], start[-1], many[-1], bool(covered[-1]))

    return run


def _cut(batches):
    """Texts with the runs that are wanted of them -> the runs' bytes."""
    for batch in batches:
        for part in slices(batch, "text"):
            data, at = utf8(part.column("text"))
            rows = [(w["gram"], w["same"], r.as_py(), w["start"], data[at[i] + w["start"] : at[i] + w["stop"]].tobytes()) for i, (r, ws) in enumerate(zip(part.column("rid"), part.column("wanted"), strict=True)) for w in ws.as_py()]
            for lo in range(0, len(rows), 20_000):
                g, s, r, b, x = zip(*rows[lo : lo + 20_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(s, pa.int64()), pa.array(r, pa.int64()), pa.array(b, pa.int64()), pa.array(x, pa.binary())], names=["gram", "same", "rid", "start", "piece"])


def repeats_in_shard(pieces: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece and start in it of every window that starts more than once in the pieces."""
    size = np.array([len(p) for p in pieces], np.int64)
    at = np.concatenate([[0], np.cumsum(size + 1)])
    data = np.frombuffer(b"\0".join([*pieces, b""]), np.uint8)
    t = data.astype(np.uint16) + np.uint16(2)
    t[at[1:] - 1] = 1
    t = np.append(t, np.uint16(0))
    piece = np.repeat(np.arange(len(pieces)), size + 1)
    able = np.append(np.arange(len(data)) + window <= (at[1:] - 1)[piece], False)
    twice = np.flatnonzero(repeated_prefixes(t, suffix_array(t, 258), able, window))
    return piece[twice], twice - at[piece[twice]]


def _shards(window: int):
    """Runs' bytes sorted by gram -> spans of the windows that repeat; a shard ends with a gram, at SHARD bytes or more."""

    def told(rows):
        piece, start = repeats_in_shard([r[4] for r in rows], window)
        if len(piece):
            rid, base = np.array([r[2] for r in rows], np.int64), np.array([r[3] for r in rows], np.int64)
            lo = base[piece] + start
            r, lo, hi = _merged(rid[piece], lo, lo + window)
            yield _spans(0, np.zeros(len(r)), np.zeros(len(r)), r, lo, hi)

    def run(batches):
        held, n, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if n >= SHARD and row[0] != last[0]:
                    yield from told(held)
                    held, n = [], 0
                held.append(row)
                n += len(row[4])
                last = row
        if held:
            yield from told(held)

    return run


def repeated_spans(docs: DataFrame, window: int = 200, length: int = GRAM) -> tuple[DataFrame, list[DataFrame]]:
    """rid, start, stop of byte spans that consist of windows that also start elsewhere; spans may overlap.

    docs: a written table of rid, one for each row, and text; length: bytes of a gram. Second: written tables that the
    spans are read from, to be discarded once they are there.
    """
    met = docs.mapInArrow(tidy(_runs(window, length)), RUN).repartition("gram").sortWithinPartitions("gram", "same", "rid", "start").mapInArrow(tidy(_meet(window)), SPAN)
    met = written(met, "runs")
    wanted = met.where("kind = 1")
    asked = wanted.groupBy("rid").agg(F.collect_list(F.struct("gram", "same", "start", "stop")).alias("wanted"))
    pieces = written(docs.select("rid", "text").join(asked, "rid").select("rid", "text", "wanted").mapInArrow(tidy(_cut), "gram long, same long, rid long, start long, piece binary"), "pieces")
    held = [met, pieces]
    in_shards, out = pieces, met.where("kind = 0").select("rid", "start", "stop")
    hot = wanted.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > MOST_RUNS).select("gram") if length < window - 1 else None
    if hot is not None and not (hot := written(hot, "hot")).isEmpty():
        in_shards = pieces.join(hot, "gram", "left_anti")
        parts = written(pieces.join(hot, "gram", "left_semi").select(F.monotonically_increasing_id().alias("rid"), F.col("piece").alias("text"), F.col("rid").alias("of"), F.col("start").alias("base")), "parts")
        deeper, more = repeated_spans(parts, window, window - 1)
        held += [hot, parts, *more]
        deeper = deeper.join(parts.select("rid", "of", "base"), "rid")
        out = out.unionAll(deeper.select(F.col("of").alias("rid"), (F.col("base") + F.col("start")).alias("start"), (F.col("base") + F.col("stop")).alias("stop")))
    shard = in_shards.repartition("gram").sortWithinPartitions("gram", "same").mapInArrow(tidy(_shards(window)), SPAN)
    return out.unionAll(shard.select("rid", "start", "stop")).distinct(), held


def _remove(batches):
    kinds = [pa.int64()] * 3 + [pa.string()] + [pa.string()]
    for batch in batches:
        for part in slices(batch, "text"):
            data, at = utf8(part.column("text"))
            rows = []
            for i, spans in enumerate(part.column("spans")):
                own = data[at[i] : at[i + 1]]
                spans = spans.as_py() or []
                gone = np.zeros(len(own) + 1, np.int32)
                for s in spans:
                    gone[s["start"]] += 1
                    gone[s["stop"]] -= 1
                gone = np.cumsum(gone)[:-1] > 0 if spans else np.zeros(len(own), bool)
                kept = own[~gone].tobytes()
                edges = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
                rows.append((len(own), int(gone.sum()), edges, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def without_repeats(docs: DataFrame, window: int = 200) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept text of every row of docs.

    A byte goes if a window-byte string that covers it also starts anywhere else in any text; null texts are empty;
    rows that are there more than once repeat each other. Texts shorter than a window keep every byte. kept replaces
    bytes of a character that was cut apart; the digest is of the bytes themselves. Null doc_ids are kept; other
    columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), F.monotonically_increasing_id().alias("rid"))
    texts = written(texts, "texts")  # numbers of rows hold only once they are written
    spans, held = repeated_spans(texts.select("rid", "text"), window)
    spans = written(spans.groupBy("rid").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "spans")
    discard(*held)
    return texts.join(spans, "rid", "left").select("doc_id", "text", "spans").mapInArrow(tidy(_remove), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string")
