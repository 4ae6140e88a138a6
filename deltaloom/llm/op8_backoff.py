"""Stupid-backoff scores: n-gram count tables partitioned by hash, joined to the documents' n-grams, summed per document.

Documents are packed into chunks. A chunk explodes its n-grams and sends each hash partition the distinct ones that
fall there, with their counts; the partition adds up all chunks' counts, which is the count table, and joins it back
to the chunks that asked. A document's own n-grams are taken off the counts that score it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MIX_A, U64, mix, slices, text_or_empty, tidy, tidy_group, utf8, word_hashes, written

#: Words of the longest n-gram, factor of a step back, bits of an n-gram's hash, up to 64 (of 1e10 n-grams, one in 7 million shares 56).
ORDER, BACKOFF, KEY_BITS = 3, 0.4, 56
#: Bytes of text of a chunk, and for each hash partition.
CHUNK, PART = 4 << 20, 8 << 20


def _zip(a: np.ndarray) -> bytes:
    raw = a.tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def _unzip(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True), kind)


def packed(keys: np.ndarray) -> bytes:
    """Sorted distinct keys by their differences: 40 bits each, and what is above them where there is anything."""
    gap = np.diff(keys, prepend=keys.dtype.type(0))
    high = np.flatnonzero(gap >> U64(40))
    return np.array([len(keys), len(high)], "<u8").tobytes() + gap.astype("<u4").tobytes() + high.astype("<u4").tobytes() + (gap[high] >> U64(40)).astype("<u4").tobytes() + (gap >> U64(32)).astype("u1").tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    n, m = np.frombuffer(blob[:16], "<u8").astype(np.int64)
    low, high, above = np.split(np.frombuffer(blob[16 : 16 + 4 * n + 8 * m], "<u4"), [n, n + m])
    gap = low.astype(U64) | np.frombuffer(blob[16 + 4 * n + 8 * m :], "u1").astype(U64) << U64(32)
    gap[high] += above.astype(U64) << U64(40)
    return np.cumsum(gap, dtype=U64)


def grams(words: np.ndarray, at: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of several texts' words, and the place of each one's last word."""
    last = np.arange(order - 1, len(words))
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    last = last[text[last] == text[last - (order - 1)]] if len(last) else last
    h = np.full(len(last), U64(order))
    for k in range(order):
        h = h * MIX_A + words[last - (order - 1) + k]
    return mix(h) >> U64(64 - KEY_BITS), last


def _chunks(batches):
    """Rows -> chunks: doc_ids, offsets and bytes of about CHUNK bytes of text, compressed."""
    part, made = TaskContext.get().partitionId(), 0
    ids, null, sizes, texts, n = [], [], [], [], 0

    def out():
        text = np.concatenate(texts) if texts else np.zeros(0, np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([(part << 32) + made], pa.int64()), pa.array([len(text)], pa.int64()), pa.array([_zip(np.array(ids, "<i8"))]), pa.array([_zip(np.array(null, "u1"))]), pa.array([_zip(np.array(sizes, "<i8"))]), pa.array([_zip(text)])], names=["chunk", "bytes", "ids", "none", "sizes", "text"])

    for batch in batches:
        for rows in slices(batch, "text", CHUNK):
            data, at = utf8(rows.column("text"))
            own = rows.column("doc_id").to_pylist()
            ids += [x or 0 for x in own]
            null += [x is None for x in own]
            sizes += np.diff(at).tolist()
            texts.append(data.copy())
            n += len(data)
            if n >= CHUNK:
                yield from out()
                made, n = made + 1, 0
                ids, null, sizes, texts = [], [], [], []
    if ids:
        yield from out()


CHUNK_SCHEMA = "chunk long, bytes long, ids binary, none binary, sizes binary, text binary"


def _words(row: dict) -> tuple[np.ndarray, np.ndarray]:
    sizes = _unzip(row["sizes"], "<i8")
    return word_hashes(_unzip(row["text"], "u1"), np.concatenate([[0], np.cumsum(sizes)]))


def _requests(part_bits: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                words, at = _words(row)
                row = {"chunk": row["chunk"]}
                for order in range(1, ORDER + 1):
                    keys, counts = np.unique(grams(words, at, order)[0], return_counts=True)
                    part = (keys >> U64(KEY_BITS - part_bits)).astype(np.int64)
                    cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else [0]
                    rows = [(order, int(part[lo]), row["chunk"], packed(keys[lo:hi]), _zip(counts[lo:hi].astype("<u4"))) for lo, hi in zip(cut[:-1], cut[1:], strict=True)]
                    if rows:
                        columns = zip(*rows, strict=True)
                        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["n", "part", "chunk", "keys", "counts"])

    return run


def _answer(frame: pd.DataFrame) -> pd.DataFrame:
    """All requests of one hash partition -> the count table's counts for each of them, in its order."""
    frame = frame.sort_values("chunk")
    keys, counts = [unpacked(b) for b in frame["keys"]], [_unzip(b, "<u4") for b in frame["counts"]]
    _, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(which, weights=np.concatenate(counts))[which].astype("<u8")
    cut = np.cumsum([len(k) for k in keys])[:-1]
    return pd.DataFrame({"chunk": frame["chunk"].to_numpy(), "n": frame["n"].to_numpy(), "part": frame["part"].to_numpy(), "totals": [_zip(t) for t in np.split(total, cut)], "tokens": [int(c.sum(dtype=np.int64)) for c in counts]})


def score_texts(words: np.ndarray, at: np.ndarray, totals: dict[int, np.ndarray], corpus_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of log scores of each text, and its words that were scored without a step back.

    totals: the corpus counts of the texts' sorted distinct n-grams by order."""
    n_texts = len(at) - 1
    text = np.repeat(np.arange(n_texts), np.diff(at))
    rest: dict[int, np.ndarray] = {}  # counts without the text's own, by order and place of the last word
    for order in range(1, ORDER + 1):
        h, last = grams(words, at, order)
        keys, which = np.unique(h, return_inverse=True)
        pair, back, own = np.unique(text[last] * max(len(keys), 1) + which, return_inverse=True, return_counts=True)
        left = np.zeros(len(words), np.int64)
        left[last] = totals[order].astype(np.int64)[which] - own[back]
        rest[order] = left
    others = corpus_words - np.diff(at)[text]
    whole = rest[1] > 0
    value = np.where(rest[1] > 0, rest[1], 1) / np.where(rest[1] > 0, np.maximum(others, 1), others + 1)
    for order in range(2, ORDER + 1):
        history = np.zeros(len(words), np.int64)
        history[1:] = rest[order - 1][:-1]
        there = np.arange(len(words)) - at[:-1][text] >= order - 1
        seen = there & (rest[order] > 0)
        whole = np.where(there, seen, whole)
        value = np.where(seen, rest[order] / np.maximum(history, 1), np.where(there, BACKOFF * value, value))
    return np.bincount(text, weights=np.log(value), minlength=n_texts).astype(np.float64), np.bincount(text[whole], minlength=n_texts)


def _score(corpus_words: int):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                words, at = _words(row)
                totals = {}
                for order in range(1, ORDER + 1):
                    own = sorted((a["part"], a["totals"]) for a in row["answers"] or [] if a["n"] == order)
                    totals[order] = np.concatenate([_unzip(t, "<u8") for _, t in own]) if own else np.zeros(0, "<u8")
                log, whole = score_texts(words, at, totals, corpus_words)
                n = np.diff(at)
                ids, none = _unzip(row["ids"], "<i8"), _unzip(row["none"], "u1").astype(bool)
                yield pa.RecordBatch.from_arrays([pa.array(ids, mask=none), pa.array(n), pa.array(log), pa.array(log / np.maximum(n, 1)), pa.array(whole / np.maximum(n, 1))], names=["doc_id", "n_words", "log_score", "mean_log_score", "seen_share"])

    return run


def backoff_scores(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, log_score (sum over its words), mean_log_score and seen_share of every row of docs.

    Words are [^\\x20\\x09-\\x0D]+ with A-Z folded. A word scores count(n-gram) / count(history) for the longest n-gram
    that other documents have, times 0.4 for each step back; a word that no other document has counts as one
    among all words. Counts are over all documents; a copy in another row counts as another document. Null and empty
    texts have no words and score 0. seen_share: share of the words that were scored by the longest n-gram that ends
    there, without a step back. Texts are whole: one of more than CHUNK bytes is a chunk of its own. Repeated rows give a
    row each. Other columns, whatever their names, are ignored. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    chunks = written(rows.mapInArrow(tidy(_chunks), CHUNK_SCHEMA), "chunks")
    size = chunks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    part_bits = max(4, int(-(-size // PART)).bit_length())
    asked = chunks.mapInArrow(tidy(_requests(part_bits)), "n int, part long, chunk long, keys binary, counts binary")
    answers = asked.groupBy("n", "part").applyInPandas(tidy_group(_answer), "chunk long, n int, part long, totals binary, tokens long")
    answers = written(answers, "answers")
    total = answers.where("n = 1").agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    # a chunk's answers are as large as its text: so many tasks that few chunks meet in one
    tasks = max(1, 4 * chunks.count())
    chunks, answers = (df.repartition(tasks, "chunk") for df in (chunks, answers))
    by_chunk = answers.groupBy("chunk").agg(F.collect_list(F.struct("n", "part", "totals")).alias("answers"))
    return chunks.join(by_chunk, "chunk", "left").mapInArrow(tidy(_score(total)), "doc_id long, n_words long, log_score double, mean_log_score double, seen_share double")
