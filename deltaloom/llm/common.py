"""Shared helpers: written intermediate tables, Arrow text buffers, byte-level word hashing."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Odd multipliers of the hash functions.
MIX_A, MIX_B = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names. Where none is set a local session gets a folder of its own, as in tests;
    on a cluster that is an error, as executors don't share local folders."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="deltaloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, name: str, rows: int = 1000) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors.

    rows: those of a batch that Python gets, fewer where each is large."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with short_batches(spark, rows):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more, what is still to be computed included."""
    for table in tables:
        if path := table.__dict__.pop("_written_at", None):
            spark = table.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def short_batches(spark: SparkSession, rows: int = 1000):
    """Send whole texts to Python in batches of fewer rows for the time of a job, so that both sides hold less."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def tidy(run):
    """A task's function that gives freed memory back when it ends: idle Python workers are kept for later tasks."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def tidy_group(run):
    """The same for a function of one group."""

    @functools.wraps(run)
    def wrapped(frame):
        try:
            return run(frame)
        finally:
            give_back()

    return wrapped


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit."""
    h = h ^ (h >> U64(32))
    h = h * MIX_A
    h = h ^ (h >> U64(29))
    h = h * MIX_B
    return h ^ (h >> U64(32))


def table_of_bytes(seed: int, fold_case: bool) -> np.ndarray:
    """A pseudorandom 64-bit value for each byte; with fold_case A-Z share those of a-z."""
    t = mix(np.arange(1, 257, dtype=U64) * MIX_B + U64(seed))
    if fold_case:
        t[65:91] = t[97:123]
    return t


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    p = np.full(n, U64(base))
    p[0] = 1
    return np.multiply.accumulate(p)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its offsets, without copying; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20):
    """Row slices of a batch of about limit bytes of text; a longer text stands alone."""
    n = batch.num_rows
    if not n:
        return
    _, at = utf8(batch.column(column))
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
        yield batch.slice(lo, min(hi, n) - lo)
        lo = min(hi, n)


SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
WORD_BASE = 0xD6E8FEB86659FD93
WORD_TABLE, WORD_POWERS = table_of_bytes(11, True), powers(WORD_BASE, 1 << 16)
#: Bytes whose terms are held at once, whatever the length of a text.
WORD_BLOCK = 1 << 18


def word_powers(place: np.ndarray) -> np.ndarray:
    """WORD_BASE to the power of each place, however large: a power of the low 16 bits times one of the others."""
    low = WORD_POWERS[place & 0xFFFF]
    most = int(place.max(initial=0)) >> 16
    return low * powers(pow(WORD_BASE, 1 << 16, 1 << 64), most + 1)[place >> 16] if most else low


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ (A-Z folded), and offsets of each text's words."""
    inside = ~SEPARATOR[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = at[:-1][at[:-1] < at[1:]]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    sums = np.zeros(len(starts), U64)
    for lo in range(0, len(data), WORD_BLOCK):
        values = np.flatnonzero(inside[lo : lo + WORD_BLOCK]) + lo
        if not len(values):
            continue
        owner = np.cumsum(first[lo : lo + WORD_BLOCK])[values - lo] + (np.searchsorted(starts, lo) - 1)
        terms = WORD_TABLE[data[values]] * word_powers(values - starts[owner])
        new = np.flatnonzero(np.diff(owner, prepend=-1))
        sums[owner[new]] += np.add.reduceat(terms, new)
    return mix(sums), np.searchsorted(starts, at)


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of one text's size-word shingles; a shorter text is one shingle, none without words."""
    n = len(words)
    if n == 0:
        return np.zeros(0, U64)
    take = min(size, n)
    h = np.full(n - take + 1, U64(take))
    for k in range(take):
        h = h * MIX_A + words[k : n - take + 1 + k]
    return np.unique(mix(h))
