"""Helpers shared by the operators: staged tables, Arrow text batches, hashed words.

Words everywhere are maximal runs of characters other than space and \\t \\n \\v \\f \\r.
"""

from __future__ import annotations

import ctypes
import sys
import types
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporia.session import ensure_checkpoint_dir

SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of text that one vectorised step works on; a longer document is one step of its own.
CHUNK_BYTES = 2 << 20

#: Spark's setting to remove an execution's shuffle files at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_MULT = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the cluster's shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs the tasks that read the table, not those that made it. The shuffle
    files of the write go when it ends, since nothing else reads them.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/emporia-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more."""
    for table in tables:
        path = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(table.staged_path)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def with_small_batches(docs: DataFrame, rows: int = 1000) -> DataFrame:
    """``docs``, with Arrow batches of at most so many rows in the session: texts can be long."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return docs


def crc_of(col: str):
    """crc32 of an integer column written as text (of the empty text for NULL)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")))


def sampled(df: DataFrame, by: list, size: int, salt: int) -> DataFrame:
    """About ``size`` rows (all, if there are fewer), chosen by a hash of the columns ``by``.

    Each task keeps its share before anything moves. Rows that agree in ``by`` are chosen together;
    the limit only bounds what such rows could add.
    """
    total = df.count()
    if total <= size:
        return df
    chance = F.pmod(F.xxhash64(*by, F.lit(salt)), F.lit(1 << 30))
    return df.filter(chance < int(size / total * (1 << 30)) + 1).limit(4 * size)


def release_memory() -> None:
    """Hands memory that this process has freed back to the system: a worker waits beside the executor between its tasks."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def worker_memory(kind: str = "") -> dict:
    """A dict that lives as long as the Python worker, for what one task may leave to the next.

    It holds things of one kind: a worker that goes on to another operator's tasks lets go of the last one's.
    """
    home = sys.modules.setdefault("emporia_worker_memory", types.ModuleType("emporia_worker_memory"))
    kept = home.__dict__.setdefault("kept", {})
    if home.__dict__.get("kind") != kind:
        kept.clear()
        release_memory()
        home.__dict__["kind"] = kind
    return kept


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def _inverse(m: int) -> int:
    """Inverse of an odd number modulo 2^64 (Newton's iteration doubles the right bits)."""
    x = m
    for _ in range(6):
        x = x * (2 - m * x) & _MASK
    return x


class Powers:
    """Growing tables of a multiplier's powers, and of its inverse's, modulo 2^64."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = n + (n >> 3)
            for name, base in (("up", _MULT), ("down", _inverse(_MULT))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))


_BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_chunks(batch, column: str = "text", size: int = CHUNK_BYTES):
    """(first row, data bytes, row starts with the end appended) of slices of an Arrow batch.

    A slice holds whole rows of about ``size`` bytes at most; NULL is the empty text.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = batch.column(batch.schema.get_field_index(column))
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        yield row, raw[at[row] : at[last]], at[row : last + 1] - at[row]
        row = last


def word_spans(low: np.ndarray, at: np.ndarray, breaks: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; no word goes across a row start in ``at``. ``breaks``: which bytes part words."""
    edge = np.zeros(len(low) + 1, bool)
    edge[at] = True
    solid = ~breaks[low]
    first, last = solid.copy(), solid.copy()
    if len(low):
        first[1:] &= ~solid[:-1] | edge[1:-1]
        last[:-1] &= ~solid[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, at: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word (A-Z lowered), and the index of its row.

    The hash is a polynomial over random byte codes, taken for all words at once from one
    running sum; two different words agree with a chance of about 2^-64.
    """
    low = _LOWER[data]
    start, end = word_spans(low, at)
    return span_hashes(low, start, end, powers), np.searchsorted(at, start, "right") - 1


def span_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """The hashes of ``word_hashes`` for given spans of lowered bytes."""
    powers.reach(len(low) + 1)
    total = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[low] * powers.up[: len(low)], out=total[1:])
    codes = (total[end] - total[start]) * powers.down[start]
    return mix64(codes + (end - start).astype(np.uint64) * np.uint64(_MULT))
