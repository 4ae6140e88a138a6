"""Cost-balanced packing: documents in descending length go to the sequence of lowest attention cost with room left.

Every task packs the stream of documents that it reads, a bounded window at a time, so that nothing is shuffled and
no group grows with the input. A sequence's cost is linear plus quadratic in each piece's length.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, tidy

#: Tokens that are packed together, about: what a task holds in memory.
WINDOW_TOKENS = 1 << 21
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long, cost double"


class Tokens:
    """Ids of whole texts by byte-level BPE, as unsigned 16-bit numbers.

    Added tokens, which are none of the ranks, stand for themselves wherever a text has them.
    """

    def __init__(self, vocabulary: str, pattern: str, added: dict[str, int] | None = None):
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.added = added or {}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split if added else None

    def ids(self, text: str) -> np.ndarray:
        if self.split and any(token in text for token in self.added):
            parts = [[self.added[x]] if x in self.added else self.encode(x) for x in self.split(text) if x]
            return np.array([i for part in parts for i in part], "<u2")
        return np.array(self.encode(text), "<u2")


def pack(lengths: list[int], size: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of these lengths, whole but for cuts that fill.

    As many sequences as the tokens need: full ones of size, then, for what is left over, one of each power of two
    that it is the sum of; so no token of padding is needed. Documents of size or more first give whole sequences. The
    rest go, longest first, to the open sequence of lowest cost; what doesn't fit there is cut off, and queues again.
    """
    out, n = [], 0
    queue = []
    for d, length in enumerate(lengths):
        start = 0
        while length - start >= size:
            out.append((d, start, size, n, 0))
            start, n = start + size, n + 1
        if length > start:
            heapq.heappush(queue, (start - length, d, start))
    rest = -sum(q[0] for q in queue)
    room = [size] * (rest // size) + [1 << k for k in range(size.bit_length() - 1, -1, -1) if (rest % size) >> k & 1]
    # a sequence that is meant to be shorter starts with the cost of what it lacks
    full = linear * size + quadratic * size * size
    open_ = [(full * (1 - r / size), n + i, r, 0) for i, r in enumerate(room)]
    heapq.heapify(open_)
    while queue:
        length, d, start = heapq.heappop(queue)
        length = -length
        cost, seq, left, offset = heapq.heappop(open_)
        take = min(length, left)
        out.append((d, start, take, seq, offset))
        if left > take:
            heapq.heappush(open_, (cost + linear * take + quadratic * take * take, seq, left - take, offset + take))
        if length > take:
            heapq.heappush(queue, (take - length, d, start + take))
    return out


def _pack(vocabulary: str, pattern: str, added: dict[str, int], size: int, end: int, linear: float, quadratic: float):
    def run(batches):
        tokens, part, made = Tokens(vocabulary, pattern, added), TaskContext.get().partitionId() << 36, 0
        held: list[tuple[int, np.ndarray]] = []
        n = 0

        def flush():
            nonlocal made
            pieces = pack([len(x) for _, x in held], size, linear, quadratic)
            totals: dict[int, int] = {}
            costs: dict[int, float] = {}
            for _, _, length, seq, _ in pieces:
                totals[seq] = totals.get(seq, 0) + length
                costs[seq] = costs.get(seq, 0.0) + linear * length + quadratic * length * length
            rows = [(held[d][0], s, k, zlib.crc32(held[d][1][s : s + k].astype("<u4").tobytes()), len(held[d][1]), part + made + q, o, totals[q], costs[q]) for d, s, k, q, o in pieces]
            made += len(totals)
            kinds = [pa.int64()] * 8 + [pa.float64()]
            for lo in range(0, len(rows), 50_000):
                columns = zip(*rows[lo : lo + 50_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(tokens.ids(text.as_py()), np.array([end], "<u2"))
                held.append((i, ids))
                n += len(ids)
                if n >= WINDOW_TOKENS:
                    yield from flush()
                    held, n = [], 0
        if held:
            yield from flush()

    return run


def packed_pieces(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, added: dict[str, int] | None = None, size: int = 2048, end: int = 1, linear: float = 1.0, quadratic: float = 1 / 2048) -> DataFrame:
    """Pieces of all documents in sequences of size tokens at most: one row for each piece.

    vocabulary: a rank file of byte-level BPE (default: that of the public 50k vocabulary), pattern: its
    pre-tokenizer's, added: tokens beyond the ranks and their ids (default: those of the vocabulary's tokenizer file,
    whose ids these are). A document is its ids and then the id end; a null text is empty, so that it is the one id end.
    A text of any length is one document, whose ids a task holds with its window's. Null and repeated doc_ids are packed like others, each row for
    itself. Columns: doc_id, start, length, ids_crc32 (of the piece's ids as little-endian unsigned 32-bit numbers),
    doc_tokens, sequence_id, offset, sequence_length, and the sequence's cost. An empty table gives no pieces.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
        if added is None:
            with open(public_tokenizers.path("byte_bpe_50k.json")) as f:
                added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(tidy(_pack(vocabulary, pattern, added or {}, size, end, linear, quadratic)), SCHEMA)
