"""What the text operators share: Arrow mapping, byte-level tokenising, scratch tables."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import hashlib
import os
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.scratch import clean, cut, release as release_shuffles, scratch_dir

__all__ = ["clean", "cut", "release_shuffles", "scratch_dir"]

#: Arrow batches are bounded in bytes as well as rows, so that a batch of very long texts stays small.
BATCH_BYTES = "2m"
BATCH_ROWS = "2000"

#: A-Z lower-cased; everything but digits, letters and non-ASCII bytes becomes a space.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a lower-cased (A-Z only) UTF-8 text."""
    return text.translate(WORDS).split()


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every row; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def texts_of(documents: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, the id as a long; other columns, whatever their names, stay behind."""
    return documents.select(*[F.col(f"`{c}`").cast("long").alias(c) if c.endswith("_id") else F.col(f"`{c}`").cast("string").alias(c) for c in columns])


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType) -> DataFrame:
    """One output batch for each input batch, bounded in rows and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield fn(b)
                release()

    return map_batches(df, run, schema)


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """mapInArrow with bounded batches."""
    ship(df.sparkSession)
    conf = df.sparkSession.conf  # read when the plan runs, so the two settings have to stay
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def run_and_release(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return df.mapInArrow(run_and_release, schema)


def release() -> None:
    """Gives freed memory back to the system: workers stay for later tasks, and what they hold counts for the executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers, one to one."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Digests(dict):
    """64-bit BLAKE2b digests of byte strings, remembered within bounds. The same in every process, and without the collisions of sums or products on structured texts."""

    MOST, MOST_BYTES = 300_000, 16 << 20

    def __init__(self):
        super().__init__()
        self.size = 0

    def __missing__(self, key: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), "little")
        if len(self) >= self.MOST or self.size >= self.MOST_BYTES:
            self.forget()
        self.size += len(key)
        self[key] = h
        return h

    def forget(self) -> None:
        self.clear()
        self.size = 0

    def of(self, keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, keys), np.uint64, len(keys))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application; they need not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    if str(root.parent) not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        holder = tempfile.TemporaryDirectory(prefix="kindred-")  # Spark serves the file from here until the end
        atexit.register(holder.cleanup)
        path = Path(holder.name, f"{root.name}.zip")
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        at = list(sys.path)
        spark.sparkContext.addPyFile(str(path))
        sys.path[:] = at  # the driver has the package already
    _shipped.add(app)
