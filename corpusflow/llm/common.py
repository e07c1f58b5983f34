"""Pieces shared by the operators: Arrow text access, vectorised words, sampling, driver-side bounds."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = b" \t\n\x0b\x0c\r"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_U = np.uint64


def table(spark: SparkSession, root: str, name: str, *columns: str) -> DataFrame:
    out = spark.read.parquet(f"{root}/{name}.parquet")
    return out.select(*columns) if columns else out


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds


def lower_ascii(column: Column) -> Column:
    """A-Z to a-z only; null counts as empty."""
    return F.translate(F.coalesce(column, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def small_batches(spark: SparkSession, limit: str = "4m") -> Iterator[None]:
    """What runs inside sends Arrow batches of about ``limit`` to Python; each is held by the JVM and by its worker, whole and in copies."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, limit)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = x.astype(_U)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


# --- Arrow text ---------------------------------------------------------------
def carried(docs: DataFrame, text_column: str) -> tuple[DataFrame, int, str]:
    """Whole rows as one struct ``_row``, the place of the text in it, and its type; no name can clash in there."""
    rows = docs.select(F.struct("*").alias("_row"))
    return rows, docs.columns.index(text_column), rows.schema["_row"].dataType.simpleString()


def text_in(batch: pa.RecordBatch, at: int) -> pa.Array:
    return pc.struct_field(batch.column("_row"), [at])


def slices(batch: pa.RecordBatch, column: str | int, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch whose texts stay near ``limit`` bytes; one longer text comes alone.

    A number instead of a name is the place of the text in ``_row``.
    """
    texts = text_in(batch, column) if isinstance(column, int) else batch.column(column)
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def raw_text(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end and the offsets of each; null is empty."""
    array = pc.fill_null(array, "").cast(pa.large_string())
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64, len(array) + 1, array.offset * 8)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8, int(at[-1] - at[0]), int(at[0])), at - at[0]


# --- words --------------------------------------------------------------------
_BYTE_VALUE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_POWERS: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            row = np.full(size, base, _U)
            row[0] = 1
            _POWERS[k] = np.multiply.accumulate(row)
    return _POWERS


def run_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each byte run: a polynomial modulo 2**64, taken from one running sum over the whole batch."""
    n = len(data)
    power, inverse = _powers(n + 1)
    sums = np.empty(n + 1, _U)
    sums[0] = 0
    np.cumsum(_BYTE_VALUE[data] * power[:n], out=sums[1:])
    return mix((sums[ends] - sums[begins]) * inverse[begins])


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end: runs of bytes other than space and 0x09-0x0D that stay inside a text."""
    n = len(data)
    space = _IS_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, space[:-1]
    begins = np.flatnonzero(~space & (before | cut[:-1]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, space[1:]
    return begins, np.flatnonzero(~space & (after | cut[1:])) + 1


def words(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text in order, after lower-casing A-Z, and where each text's words begin."""
    data, at = raw_text(array)
    if not len(data):
        return np.zeros(0, _U), np.zeros(len(at), np.int64)
    data = np.frombuffer(data.tobytes().translate(_LOWER), np.uint8)
    begins, ends = word_bounds(data, at)
    return run_hashes(data, begins, ends), np.searchsorted(begins, at)


class Memo:
    """Sorted hashes with a row number each: what a worker has met, in 16 bytes an entry."""

    def __init__(self) -> None:
        self.keys = np.zeros(0, _U)
        self.rows = np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 where it is new."""
        if not len(self.keys):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.rows[at], -1)

    def add(self, hashes: np.ndarray, rows: np.ndarray) -> None:
        """Sorted new hashes and their rows."""
        at = np.searchsorted(self.keys, hashes)
        self.keys, self.rows = np.insert(self.keys, at, hashes), np.insert(self.rows, at, rows)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words of one text; of the whole text when it has fewer."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(size, n)
    out = np.full(n - width + 1, width, _U)
    for j in range(width):
        out = out * _U(0x9E3779B97F4A7C15) + hashes[j : n - width + 1 + j]
    return mix(out)


def list_rows(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
