"""Helpers shared by the training-data operators.

Intermediate tables go to the folder the cluster names in
``spark.checkpoint.dir``; they cut the lineage, survive lost executors and are
read back by every stage that needs them.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neolake.shipping import ship

#: Bytes of text handled at once by the vectorised helpers (a longer text is handled alone).
SLICE_BYTES = 2 << 20


#: Rows of an Arrow batch at most: texts are long, and a worker holds a batch or two.
BATCH_ROWS = 2000


def prepare(spark: SparkSession) -> None:
    """Send the package to the workers, and bound the session's Arrow batches."""
    ship(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only on a local master without one (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="neolake-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


class Scratch:
    """Tables written to the shared folder by one query."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        prepare(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self.tables: list[tuple[DataFrame, str]] = []

    def store(self, df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
        """Write ``df`` once and return the written table."""
        path = f"{self.root}/{name}-{len(self.tables) + 1}"
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((out, path))
        return out

    def drop(self, *gone: DataFrame) -> None:
        """Delete the files of tables that ``store`` returned and nothing reads any more."""
        for df, name in self.tables:
            if any(df is x for x in gone):
                path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def keep(self, *used: DataFrame) -> None:
        """Delete all tables but those that the operator's result still reads."""
        self.drop(*[df for df, _ in self.tables if not any(df is x for x in used)])


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs started inside, for tables whose rows are long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", most: int = 100_000) -> DataFrame:
    """Join; ``small`` is broadcast only after a count has shown at most ``most`` rows of it."""
    fits = small.limit(most + 1).count() <= most
    return big.join(F.broadcast(small) if fits else small, on, how)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column; a null is an empty row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``most`` bytes of text."""
    if not batch.num_rows:
        return
    _, off = utf8(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(off, off[start] + most, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), element by element."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: An odd multiplier and its inverse modulo 2**64, for polynomial hashes by prefix sums.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    known = _powers.get(str(base))
    if known is None or len(known) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        known = np.ones(size, np.uint64)
        known[1:] = base & (2**64 - 1)
        np.multiply.accumulate(known, out=known)
        _powers[str(base)] = known
    return known[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for every pair, equal for equal spans.

    For keys under which spans meet and are compared; where a hash stands for the
    span itself, ``name_hashes`` is the one to use.
    """
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=sums[1:])
    poly = (sums[ends] - sums[starts]) * powers(INVERSE, n + 1)[starts]
    return mix64(poly + (ends - starts).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))


#: Masks of a little-endian word's first 0 to 8 bytes.
_FIRST = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def name_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of bytes[start:end] for every pair, that may stand for the bytes.

    Up to 16 bytes are mixed whole (one step is a bijection of each half), longer
    ones get XXH3. Unlike ``span_hashes``, whose sums modulo 2**64 are equal for
    some regular long texts, it has no known pairs of equal hashes.
    """
    size = ends - starts
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))  # the eight bytes from every place on
    low = eight[starts] & _FIRST[np.minimum(size, 8)]
    high = eight[np.minimum(starts + 8, len(data))] & _FIRST[np.clip(size - 8, 0, 8)]
    out = mix64(low ^ mix64(high + mix64(size.astype(np.uint64) + np.uint64(1))))
    long = np.flatnonzero(size > 16)
    if len(long):
        raw = memoryview(np.ascontiguousarray(data))
        out[long] = [xxhash.xxh3_64_intdigest(raw[i:j]) for i, j in zip(starts[long].tolist(), ends[long].tolist())]
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every white-space separated word; words never cross rows."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    ink = ~is_space(data)
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    first[edges] |= ink[edges]
    last = ink.copy()
    last[:-1] &= ~ink[1:]
    last[edges - 1] |= ink[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows
