"""Token ids in a packed binary format, and its reader.

A shard file holds the ids of many documents, each id in the fewest bits that the vocabulary needs:

    bytes 0-7    magic "SHLFPK01"
    bytes 8-39   four little-endian int64: bits an id, ids a block, number of ids, number of documents
    then         int64 a document: doc_id                                   (ascending)
    then         int64 a document: number of its ids before the shard's end, running (exclusive ends)
    then         int64 a block: byte offset of the block, counted from the first block
    then         the blocks: ids as ``bits``-bit little-endian fields, each block padded to whole bytes

Any run of ids is read by unpacking only the blocks that hold it. Shards are written by the tasks that encode,
in ascending order of doc_id; a manifest row per shard is committed by Spark's own writer, so a file that a
failed or repeated attempt left behind is in no manifest and never read.

Defined results: a null or empty text has the end id only; documents of one doc_id stand next to each other in
an order fixed by their text; an empty table gives an empty manifest; a null doc_id comes first and is
stored as the least 64-bit integer. Only the id and text columns are read, whatever the others are called.
"""

from __future__ import annotations

import functools
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.catalog import scratch
from .chunk_cache import ChunkIds
from .common import IS_GAP, chunked, query, table, text_bytes, tidy

MAGIC = b"SHLFPK01"
BLOCK_IDS = 4096
NULL_ID = -(2**63)
#: Chunks whose ids a worker keeps.
CHUNKS = 1_000_000

#: UTF-8 forms of the characters beyond ASCII that Unicode calls white space.
WIDE_WHITE = [
    c.encode()
    for c in "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
]


def chunk_spans(data: np.ndarray, offsets: np.ndarray, special: re.Pattern | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of chunks (white space with what follows it) that cover every row, and the index of
    each row's first chunk. No token crosses the start of a chunk: the tokenizer's own pattern never lets
    white space follow another character within a piece. What matches ``special`` is a chunk of its own."""
    white = IS_GAP[data]
    for lead in sorted({form[0] for form in WIDE_WHITE}):
        at = np.flatnonzero(data == lead)
        for form in (f for f in WIDE_WHITE if f[0] == lead) if len(at) else ():
            here = at[at + len(form) <= len(data)]
            for k in range(1, len(form)):
                here = here[data[here + k] == form[k]]
            for k in range(len(form)):
                white[here + k] = True
    starts = white.copy()
    starts[1:] &= ~white[:-1]
    starts[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    if special is not None:
        held = data.tobytes()
        if special.search(held):
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                for found in special.finditer(held, a, b):
                    starts[found.start()] = True
                    if found.end() < b:
                        starts[found.end()] = True
    first = np.flatnonzero(starts)
    return first, np.append(first[1:], len(data)), np.searchsorted(first, offsets)


def pack(ids: np.ndarray, bits: int, block_ids: int = BLOCK_IDS) -> tuple[np.ndarray, bytes]:
    """Byte offsets of the blocks and the packed blocks."""
    block_bytes = -(-block_ids * bits // 8)
    blocks = -(-len(ids) // block_ids)
    out = bytearray()
    lanes = 512  # blocks packed at a time, so that the bit matrix stays small
    for b in range(0, blocks, lanes):
        part = ids[b * block_ids : (b + lanes) * block_ids].astype("<u4")
        n = -(-len(part) // block_ids)
        if len(part) < n * block_ids:
            part = np.concatenate([part, np.zeros(n * block_ids - len(part), "<u4")])
        if bits in (8, 16, 32):
            packed = part.astype(f"<u{bits // 8}").view(np.uint8)
        else:
            field = np.unpackbits(part.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
            packed = np.packbits(field.reshape(n, -1), axis=1, bitorder="little").reshape(-1)
        out += packed.tobytes()
    last = len(ids) - (blocks - 1) * block_ids
    if blocks:
        del out[(blocks - 1) * block_bytes + -(-last * bits // 8) :]
    return np.arange(blocks, dtype="<i8") * block_bytes, bytes(out)


def unpack(held: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The first n ids of packed bytes."""
    if bits in (8, 16, 32):
        return held[: n * bits // 8].view(f"<u{bits // 8}").astype(np.uint32)
    field = np.unpackbits(held, bitorder="little", count=n * bits).reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = field
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1)


def shard_bytes(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    offsets, blocks = pack(ids, bits, block_ids)
    head = np.array([bits, block_ids, len(ids), len(doc_ids)], "<i8")
    parts = [head, np.asarray(doc_ids, "<i8"), np.cumsum(counts, dtype=np.int64).astype("<i8"), offsets]
    return MAGIC + b"".join(p.tobytes() for p in parts) + blocks


class Shard:
    """Random access to one shard file."""

    def __init__(self, file):
        self.file = file
        head = file.read_at(40, 0)
        if head[:8] != MAGIC:
            raise ValueError("not a packed token file")
        self.bits, self.block_ids, self.n_ids, n_docs = map(int, np.frombuffer(head, "<i8", 4, 8))
        blocks = -(-self.n_ids // self.block_ids)
        index = np.frombuffer(file.read_at(8 * (2 * n_docs + blocks), 40), "<i8")
        self.doc_ids, self.ends, self.offsets = index[:n_docs], index[n_docs : 2 * n_docs], index[2 * n_docs :]
        self.base = 40 + 8 * len(index)
        self.size = file.size()

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids start to end (exclusive): reads and unpacks only the blocks between them."""
        if end <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (end - 1) // self.block_ids
        at = self.base + int(self.offsets[first])
        to = self.base + int(self.offsets[last + 1]) if last + 1 < len(self.offsets) else self.size
        held = np.frombuffer(self.file.read_at(to - at, at), np.uint8)
        if self.block_ids * self.bits % 8:
            parts = []
            for b in range(first, last + 1):
                lo = int(self.offsets[b] - self.offsets[first])
                n = min(self.block_ids, self.n_ids - b * self.block_ids)
                parts.append(unpack(held[lo : lo + -(-n * self.bits // 8)], self.bits, n))
            ids = np.concatenate(parts)
        else:
            ids = unpack(held, self.bits, min(self.n_ids, (last + 1) * self.block_ids) - first * self.block_ids)
        return ids[start - first * self.block_ids : end - first * self.block_ids]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


@functools.lru_cache(2)
def _chunk_ids(vocabulary: str, plain: bool, limit: int) -> tuple[ChunkIds, int, re.Pattern | None]:
    """Encoder of one worker, the size of its vocabulary, and the pattern of the special tokens it looks for. The
    missing chunks are encoded as one text in which every chunk starts a new piece; ids are given back to their chunks
    by their lengths in bytes."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    special = None
    if plain:
        tokenizer.encode_special_tokens = True
    elif added := [t for t in tokenizer.get_added_tokens_decoder().values() if t.content]:
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError("special tokens that depend on what is beside them")
        names = sorted((t.content.encode() for t in added), key=lambda c: (-len(c), c))
        special = re.compile(b"|".join(map(re.escape, names)))

    size = tokenizer.get_vocab_size()
    #: A token has one character for each byte it stands for.
    n_bytes = np.array([len(tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
    gap = frozenset(np.flatnonzero(IS_GAP).tolist())

    def encode(chunks: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        joined = [c for c in chunks if c[0] in gap and not c.decode()[-1].isspace()]
        single = list(set(chunks).difference(joined))
        alone = [e.ids for e in tokenizer.encode_batch_fast([c.decode() for c in single], add_special_tokens=False)]
        ids, counts = [np.array([i for x in alone for i in x], np.uint32)], [np.array(list(map(len, alone)), np.int64)]
        for at in range(0, len(joined), 20_000):
            some = joined[at : at + 20_000]
            got = np.array(tokenizer.encode_batch_fast([b"".join(some).decode()], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.searchsorted(np.cumsum(n_bytes[got]), np.cumsum(list(map(len, some)))) + 1
            ids.append(got)
            counts.append(np.diff(ends, prepend=0))
        return single + joined, np.concatenate(ids), np.concatenate(counts)

    return ChunkIds(encode, limit), size, special


def encode_texts(column: pa.Array, vocabulary: str, plain: bool = False, limit: int = CHUNKS) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and how many each has. The names of special tokens within a text become their
    ids, as in the library, unless ``plain``: then they are text like any other. A worker keeps the ids of ``limit`` chunks."""
    data, offsets = text_bytes(column)
    chunk_ids, _, special = _chunk_ids(vocabulary, plain, limit)
    starts, ends, row_first = chunk_spans(data, offsets, special)
    ids, counts = chunk_ids(data, starts, ends)
    return ids, np.diff(np.concatenate([[0], np.cumsum(counts)])[row_first])


def bits_for(size: int) -> int:
    """The fewest bits that hold any id below ``size``."""
    return max(1, int(size - 1).bit_length())


def write_packed(
    docs: DataFrame, folder: str, vocabulary: str, *, end_id: int | None = None, id: str = "doc_id", text: str = "text",
    shard_ids: int = 4_000_000,
) -> DataFrame:
    """Encodes every whole text and writes shards below ``folder`` in ascending order of id; returns the
    manifest: shard order, path, number of documents and of ids. ``folder`` must be one that all executors
    and :mod:`pyarrow.fs` can write."""
    spark = docs.sparkSession
    ordered = (
        docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .repartitionByRange(F.col("id").asc_nulls_first(), F.xxhash64("text"))
        .sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"), "text")
    )

    def write(batches: Iterator[pa.RecordBatch]):
        part = TaskContext.get().partitionId()
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        size = _chunk_ids(vocabulary, False, CHUNKS)[1]
        bits = bits_for(max(size, (end_id or 0) + 1))
        doc_ids, counts, ids, held, number = [], [], [], 0, 0

        def flush():
            nonlocal doc_ids, counts, ids, held, number
            name = f"{part:06d}-{number:04d}-{uuid.uuid4().hex}.pack"
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(shard_bytes(np.concatenate(doc_ids), np.concatenate(counts), np.concatenate(ids), bits))
            row = [[part], [number], [f"{folder.rstrip('/')}/{name}"], [sum(map(len, doc_ids))], [held]]
            doc_ids, counts, ids, held, number = [], [], [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array(r[0:1]) for r in row], ["part", "number", "path", "n_docs", "n_ids"])

        for batch in chunked(batches, "text", 4 << 20):
            got, n = encode_texts(batch.column("text"), vocabulary)
            if end_id is not None:
                got, n = np.insert(got, np.cumsum(n), end_id), n + 1
            doc_ids.append(batch.column("id").fill_null(NULL_ID).to_numpy(zero_copy_only=False))
            counts.append(n)
            ids.append(got)
            held += len(got)
            if held >= shard_ids:
                yield flush()
        if doc_ids:
            yield flush()

    manifest = ordered.mapInArrow(tidy(write), "part long, number long, path string, n_docs long, n_ids long")
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_packed(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files alone: id, position of its first id among all ids, its ids' number
    and CRC-32."""
    # The window runs over one small row per shard file, not over documents.
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    n = max(1, shards.count())

    def read(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                store, path = pafs.FileSystem.from_uri(row["path"])
                with store.open_input_file(path) as file:
                    shard = Shard(file)
                    ends = shard.ends
                    starts = np.concatenate([[0], ends[:-1]])
                    for a in range(0, len(ends), 2000):
                        some = slice(a, a + 2000)
                        first = int(starts[a])
                        held = shard.ids(first, int(ends[some][-1])).astype("<u4")
                        crc = [zlib.crc32(held[s - first : e - first]) for s, e in zip(starts[some], ends[some])]
                        out = [shard.doc_ids[some], starts[some] + row["start"], (ends - starts)[some], np.array(crc, np.int64)]
                        ids = pa.array(out[0], mask=out[0] == NULL_ID)
                        yield pa.RecordBatch.from_arrays([ids, *map(pa.array, out[1:])], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.repartition(n).mapInArrow(tidy(read), "doc_id long, start long, n_tokens long, ids_crc32 long")


@query()
def op10_token_packing(spark, sf_dir):
    """Every document's place in the packed files, read back from them."""
    import public_tokenizers

    folder = scratch(spark, "packed")
    folder = folder if "://" in folder else f"file://{folder}"
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return read_packed(write_packed(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2))
