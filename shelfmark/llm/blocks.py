"""Documents in blocks, and packed arrays as rows.

A block is one row that holds about ``BLOCK_BYTES`` of text. Blocks are written once, so every later pass sees the
same ones: a pass can ask other tasks about what a block holds and apply the answers when it reads the block again."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunked, text_bytes, tidy, written

BLOCK_BYTES = 2 << 20
#: Stands for a null id, after all others.
NULL_ID = 2**63 - 1


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed value."""
    parts = [np.array([len(arrays), *(a.nbytes for a in arrays)], "<i8"), *arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(p).tobytes() for p in parts))


def unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    """The arrays of a packed value, given their types."""
    held = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(held, "<i8", len(kinds) + 1)[1:]
    ends = 8 * (len(kinds) + 1) + np.cumsum(sizes)
    return [np.frombuffer(held, k, (e - b) // np.dtype(k).itemsize, b) for k, b, e in zip(kinds, ends - sizes, ends)]


def pack_blocks(docs: DataFrame, id: str, text: str) -> DataFrame:
    """A written table of blocks: ``block`` (a number) and ``docs`` (packed)."""
    rows = docs.select(F.coalesce(F.col(id).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]):
        ids, lengths, texts, size = [], [], [], 0

        def flush():
            payload = packed(np.concatenate(ids).astype("<i8"), np.concatenate(lengths).astype("<i8"), np.concatenate(texts))
            return pa.RecordBatch.from_arrays([pa.array([payload], pa.binary())], ["docs"])

        for batch in chunked(batches, "text", BLOCK_BYTES // 4):
            data, offsets = text_bytes(batch.column("text"))
            ids.append(batch.column("id").to_numpy())
            lengths.append(np.diff(offsets))
            texts.append(data.copy())
            size += len(data)
            if size >= BLOCK_BYTES:
                yield flush()
                ids, lengths, texts, size = [], [], [], 0
        if ids:
            yield flush()

    return written(rows.mapInArrow(tidy(run), "docs binary").withColumn("block", F.monotonically_increasing_id()), "blocks")


def unpacked_block(payload: bytes) -> list[np.ndarray]:
    """Ids, byte lengths and joined bytes of a block's texts."""
    return unpacked(payload, "<i8", "<i8", "u1")


def key_counts(blocks: DataFrame, buckets: int, keys_of: Callable[[bytes], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> DataFrame:
    """Per block, the total of each of its keys over all blocks (up to 255), as ``counts``: for each bucket one
    array in the order of the block's keys.

    ``keys_of`` a block gives bucket, 32-bit key and own count of its distinct keys, in ascending order of the first
    two. Sorted keys travel as gaps, byte by byte, which packs them well. Keys of different things may clash:
    that only raises a total."""

    def ask(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("docs")):
                bucket, key, own = keys_of(payload.as_py())
                found = []
                for b, lo in zip(*np.unique(bucket, return_index=True)):
                    some = slice(lo, np.searchsorted(bucket, b, "right"))
                    gaps = np.diff(key[some].astype(np.int64), prepend=0).astype("<u4").view("u1").reshape(-1, 4)
                    found.append((int(b), packed(*(gaps[:, i] for i in range(4)), own[some].astype("u1"))))
                if found:
                    names, payloads = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, pa.int64()), pa.array([block] * len(names), pa.int64()), pa.array(payloads, pa.binary())],
                        ["bucket", "block", "payload"],
                    )

    def close(bucket: int, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        keys, own = [], []
        for _, payload in rows:
            *parts, n = unpacked(payload, *["u1"] * 5)
            keys.append(np.cumsum(np.stack(parts, axis=1).reshape(-1).view("<u4"), dtype=np.int64))
            own.append(n)
        names, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.minimum(np.bincount(inverse, np.concatenate(own), len(names)), 255).astype("u1")
        payloads = [packed(total[i]) for i in np.split(inverse, np.cumsum(list(map(len, keys)))[:-1])]
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket] * len(rows), pa.int64()), pa.array([b for b, _ in rows], pa.int64()), pa.array(payloads, pa.binary())],
            ["bucket", "block", "payload"],
        )

    def answer(batches: Iterator[pa.RecordBatch]):
        now, rows = None, []
        for batch in batches:
            for bucket, block, payload in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "payload"))):
                if rows and bucket != now:
                    yield close(now, rows)
                    rows = []
                now = bucket
                rows.append((block, payload))
        if rows:
            yield close(now, rows)

    schema = "bucket long, block long, payload binary"
    asked = blocks.mapInArrow(tidy(ask), schema).repartition(min(buckets, 20_000), "bucket").sortWithinPartitions("bucket")
    answers = written(asked.mapInArrow(tidy(answer), schema), "key-counts")
    return answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "payload")).alias("counts"))


def counts_of(bucket: np.ndarray, found: list[dict] | None) -> np.ndarray:
    """The answers of ``key_counts`` in the order of a block's keys, given their buckets."""
    out = np.ones(len(bucket), "u1")
    for f in found or []:
        lo, hi = np.searchsorted(bucket, [f["bucket"], f["bucket"] + 1])
        out[lo:hi] = unpacked(f["payload"], "u1")[0]
    return out
