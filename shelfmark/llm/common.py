"""Helpers the operators of this package share: registration, written intermediate tables, and vectorised
work on the bytes of an Arrow text column."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..sources.catalog import drop_path, scratch

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: A-Z to a-z, every other byte unchanged.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

#: True for the bytes that separate words: the space and 0x09 to 0x0D.
IS_GAP = np.zeros(256, bool)
IS_GAP[[0x20, *range(0x09, 0x0E)]] = True

#: Base and byte values of the polynomial hash (mod 2**64); odd base, so that powers have inverses.
_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def query(sql: str | None = None):
    """Registers a query under its function name, with the SQL that must give the same rows."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Paths of the tables written within each open block of ``passing_tables``.
_passing: list[list[str]] = []


@contextmanager
def passing_tables(spark: SparkSession):
    """Tables that ``written`` makes within the block are removed at its end, but for those it keeps. What leaves the
    block must be kept tables: a frame over others could not be computed any more."""
    _passing.append([])
    try:
        yield
    finally:
        for path in _passing.pop():
            drop_path(spark, path)


def written(df: DataFrame, label: str, *, keep: bool = False, **options) -> DataFrame:
    """The rows, written once below ``spark.checkpoint.dir`` and read back: lineage ends here, and a lost
    executor costs no recomputation. Within ``passing_tables`` the table lives until the end of the block, or, to
    ``keep`` it, of the block around that one."""
    path = scratch(df.sparkSession, label)
    blocks = _passing[:-1] if keep else _passing
    if blocks:
        blocks[-1].append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column in one array, and the n + 1 offsets of its rows. Null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_large_binary(column.type) and not pa.types.is_binary(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    width = np.int64 if large else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def lowered(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().translate(LOWER), np.uint8)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word (run of bytes other than gaps) and the index of the first word of each
    row (n + 1 values). Words never cross rows."""
    inside = ~IS_GAP[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    first = np.flatnonzero(starts)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(first, offsets)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads a 64-bit value over all bits (the finalizer of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def running_sums(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums of 64-bit values, from which ``span_hashes`` gets the hash of any span."""
    powers, _ = _power_tables(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], dtype=np.uint64, out=out[1:])
    return out


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of bytes."""
    return running_sums(_VALUES[data])


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of the bytes or values that ``sums`` was made of."""
    _, inverse = _power_tables(len(sums))
    return mixed((sums[ends] - sums[starts]) * inverse[starts])


def tidy(run: Callable) -> Callable:
    """``run``, a function of Arrow batches, which gives the memory it worked in back at the end of each task. A Python
    worker lives on for other tasks, and for a while without any, and would otherwise keep what its largest one took."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]):
        try:
            yield from run(batches)
        finally:
            release()

    return task


def release() -> None:
    """Unused memory back to the system, where the C library can do that."""
    _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def chunked(batches: Iterator[pa.RecordBatch], name: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cuts batches into slices of about ``limit`` bytes of one text column, a row at least, so that the
    arrays made from a slice stay small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(name))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
