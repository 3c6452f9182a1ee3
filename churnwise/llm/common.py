"""Shared helpers: the shared scratch folder and vectorised text scanning.

Text reaches Python as Arrow batches and is scanned as UTF-8 bytes with numpy: byte classes give word
bounds, and a polynomial hash per word comes from one multiply and one segmented sum. All separators used
by the operators are ASCII, so byte scanning and code point scanning see the same words.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from churnwise.operators.materialize import release

#: Bytes of text handled at once inside a task. It bounds a task's memory and never cuts a document.
CHUNK_BYTES = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which the driver and every executor can read.

    Only a local session may leave it unset; it then gets a scratch folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: What `cut` has written and nobody has freed.
_WRITTEN: list[str] = []


def written() -> list[str]:
    return list(_WRITTEN)


def free(spark: SparkSession, paths: list[str]) -> None:
    """Delete intermediates that nothing reads any more."""
    release(spark, paths)
    for path in paths:
        _WRITTEN.remove(path)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it again: lineage ends here, and a lost
    executor costs a re-read of files instead of a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string (UTF-8) or binary column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = column.cast(pa.large_binary() if binary else pa.large_string()).fill_null(b"" if binary else "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def field(batch: pa.RecordBatch, name: str, column: str = "row") -> pa.Array:
    """A text field of rows that travel as one struct column, so that no text crosses to Python twice."""
    return batch.column(column).field(name).cast(pa.string())


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes; a longer row is a range of its own."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


# --- words -----------------------------------------------------------------------------------------------

_RNG = np.random.default_rng(20240229)
BASE = np.uint64(_RNG.integers(1, 2**63, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
CODES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = np.ones(1, np.uint64)
#: Bytes that separate words of the two word patterns in use.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        step = np.full(max(n, 4096), BASE)
        step[0] = 1
        _POWERS = np.cumprod(step)
    return _POWERS


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the rows in `raw`: start and end byte and 64-bit hash of each word, with A-Z lower-cased, and
    the n + 1 offsets of each row's words. Words never span rows."""
    inside = ~separators[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    bounds = offsets[(offsets > 0) & (offsets < len(raw))]
    first[bounds] = inside[bounds]  # a word that touches the end of the row before it
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    lengths = np.add.reduceat(inside, starts, dtype=np.int64)
    codes = np.where(separators, np.uint64(0), CODES[LOWER])
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    np.minimum(place, lengths.max(), out=place)
    values = codes[raw[starts[0] :]] * powers(int(lengths.max()) + 1)[place]
    hashes = mixed(np.add.reduceat(values, starts - starts[0]))
    return starts, starts + lengths, hashes, np.searchsorted(starts, offsets)


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of `n` consecutive word hashes (rows not considered)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        total = total * BASE + hashes[k : len(hashes) - n + 1 + k]
    return mixed(total)


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def fold(hashes: np.ndarray) -> int:
    """One 64-bit hash of a whole sequence of word hashes."""
    if not len(hashes):
        return 0
    return int(mixed(np.array([np.dot(hashes, powers(len(hashes))[: len(hashes)][::-1])], np.uint64))[0])
