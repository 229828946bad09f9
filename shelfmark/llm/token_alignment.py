"""Alignment of the tokens of two tokenizers on the same texts.

Side A is a byte-level vocabulary of the ``tokenizers`` library and encodes a space and the text; side B is a
SentencePiece model, which adds that space itself. Both token sequences then spell the same bytes. Per batch, and keyed by
document, ``pandas.merge_asof`` looks up for the start of every token the token of the other side that covers it.
Both directions together give all overlaps; overlapping tokens that end together are linked, and these places cut both
sequences into the smallest groups that spell the same bytes.

``align`` gives every document its ids, groups and overlaps. ``linked_documents`` keeps of these a hash of the groups and the
linked pairs, ``link_counts`` counts each pair in all documents, and ``link_frequencies`` brings the counts back to the
documents.

The table of linked pairs has a bound that the documents cannot exceed: of two tokens that end together, the shorter
one's bytes are the last bytes of the longer one. A token has as many endings as bytes, and no two ids of side A
and at most two of side B (a piece and a byte piece) spell the same bytes. So there are at most as many pairs as side B
has bytes and twice as many as side A has, some hundred thousand for the usual vocabularies (``pair_bound``). A
task keeps its counts until its end; the summed table goes to all workers.

Defined results: null and empty texts, and texts whose joined tokens of either side are not a space and the text
(U+2581 in a text, for one), have no tokens and no groups. Names of special tokens within a text are plain text.
Rows are treated one by one; repeated rows count each. Extra columns pass through unless they are called like a
result. An empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunk_cache import ChunkIds, gathered
from .common import chunked, query, table, text_bytes, tidy, written
from .token_packing import encode_texts

SLICE_BYTES = 1 << 18
#: Chunks whose ids a worker keeps, on each side.
CHUNKS = 1_000_000
INTS = T.ArrayType(T.IntegerType())


class Spelling:
    """The bytes of every id."""

    def __init__(self, spelt: list[bytes]):
        self.ends = np.cumsum([0, *map(len, spelt)], dtype=np.int64)
        self.data = np.frombuffer(b"".join(spelt), np.uint8)

    def lengths(self, ids: np.ndarray) -> np.ndarray:
        return self.ends[ids + 1] - self.ends[ids]

    def join(self, ids: np.ndarray) -> np.ndarray:
        return gathered(self.data, self.ends[ids], self.ends[ids + 1])


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: the printable ones of Latin-1 themselves,
    all others, in ascending order, the characters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(0x100) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(others)}


@functools.lru_cache(2)
def byte_level_spelling(vocabulary: str) -> Spelling:
    from tokenizers import Tokenizer

    tokenizer, alphabet = Tokenizer.from_file(vocabulary), byte_alphabet()
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return Spelling([bytes(alphabet[c] for c in name) if all(c in alphabet for c in name) else name.encode() for name in names])


class PieceModel:
    """A SentencePiece model, and the bytes of its ids. Where no piece goes on behind a space, the ids of a text are
    those of its chunks (spaces and what follows up to the next space), which are encoded once per worker."""

    def __init__(self, model: str):
        import sentencepiece

        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        own = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.spelling = Spelling(own)
        behind = any("▁" in p.lstrip("▁") for i, p in enumerate(pieces) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)))
        # the model keeps spaces as they are and adds one in front
        self.in_chunks = not behind and all(sp.normalize(t) == "▁" + t.replace(" ", "▁") for t in ("a", " a  b ", " "))
        self.space = sp.piece_to_id("▁")
        self.chunk_ids = ChunkIds(self._encode_chunks, CHUNKS)

    def _encode_chunks(self, chunks: list[bytes]):
        encoded = self.processor.encode([c[1:].decode() for c in chunks], num_threads=1)
        return chunks, *self._flat([e or [self.space] for e in encoded])

    @staticmethod
    def _flat(encoded: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        counts = np.fromiter(map(len, encoded), np.int64, len(encoded))
        return np.fromiter(itertools.chain.from_iterable(encoded), np.uint32, int(counts.sum())), counts

    def encode(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each row has. Rows are given with the space the library would add."""
        if not self.in_chunks:
            held = data.tobytes()
            texts = [held[a + 1 : b].decode() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            return self._flat(self.processor.encode(texts, num_threads=1))
        begins = data == 0x20
        begins[1:] &= data[:-1] != 0x20
        begins[ends[:-1]] = True
        starts = np.flatnonzero(begins)
        ids, counts = self.chunk_ids(data, starts, np.append(starts[1:], len(data)))
        return ids, np.diff(np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, ends)])


@functools.lru_cache(2)
def piece_model(model: str) -> PieceModel:
    return PieceModel(model)


def pair_bound(vocabulary: str, model: str) -> int:
    """No corpus has more different linked pairs of ids."""
    return 2 * len(byte_level_spelling(vocabulary).data) + len(piece_model(model).spelling.data)


def _spells(joined: np.ndarray, ends: np.ndarray, want: np.ndarray, want_ends: np.ndarray) -> np.ndarray:
    """For which rows the joined bytes are the wanted ones."""
    good = np.diff(ends) == np.diff(want_ends)
    pick = np.flatnonzero(good)
    differs = gathered(joined, ends[pick], ends[pick + 1]) != gathered(want, want_ends[pick], want_ends[pick + 1])
    good[pick[np.repeat(np.arange(len(pick)), np.diff(want_ends)[pick])[differs]]] = False
    return good


def overlaps(a_starts: np.ndarray, a_docs: np.ndarray, b_starts: np.ndarray, b_docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens that share a byte, in ascending order. Starts are places in the joined bytes of all documents."""
    a = pd.DataFrame({"start": a_starts, "doc": a_docs, "a": np.arange(len(a_starts))})
    b = pd.DataFrame({"start": b_starts, "doc": b_docs, "b": np.arange(len(b_starts))})
    over_a = pd.merge_asof(a, b, on="start", by="doc")
    over_b = pd.merge_asof(b, a, on="start", by="doc")
    # tokens that start together find each other in both directions
    once = a_starts[over_b["a"].to_numpy()] < b_starts
    at_a = np.concatenate([over_a["a"].to_numpy(), over_b["a"].to_numpy()[once]])
    at_b = np.concatenate([over_a["b"].to_numpy(), over_b["b"].to_numpy()[once]])
    order = np.argsort(at_a + at_b, kind="stable")  # one more token of either side makes the next overlap
    return at_a[order], at_b[order]


class Aligned:
    """Ids and groups of the documents of one slice. ``first_a[i]`` is the place of the first token of row i on side A,
    ``last_a[k]`` that of the last token of group k, and ``groups[i]`` the first group of row i; side B likewise. ``at_a`` and
    ``at_b`` are the places of overlapping tokens."""

    def __init__(self, column: pa.Array, vocabulary: str, model: str):
        b_side, a_spelling = piece_model(model), byte_level_spelling(vocabulary)
        data, ends = text_bytes(column)
        data, ends = np.insert(data, ends[:-1], 0x20), ends + np.arange(len(ends))
        spaced = pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data))
        encoded = encode_texts(spaced, vocabulary, plain=True, limit=CHUNKS), b_side.encode(data, ends)
        good, sides = np.diff(ends) > 1, []
        for (ids, counts), spelling in zip(encoded, (a_spelling, b_side.spelling)):
            ids, first = ids.astype(np.int64), np.concatenate([[0], np.cumsum(counts)])
            spelt = np.concatenate([[0], np.cumsum(spelling.lengths(ids))])[first]
            good &= _spells(spelling.join(ids), spelt, data, ends)
            sides.append((ids, first, spelling))
        kept = []
        for ids, first, spelling in sides:
            ids, counts = gathered(ids, first[:-1][good], first[1:][good]), np.diff(first) * good
            lengths = spelling.lengths(ids)
            token_ends = np.cumsum(lengths)
            kept.append((ids, counts, token_ends, token_ends - lengths, np.repeat(np.arange(len(column)), counts)))
        (self.a_ids, a_counts, a_ends, a_starts, self.a_docs), (self.b_ids, b_counts, b_ends, b_starts, self.b_docs) = kept
        self.at_a, self.at_b = overlaps(a_starts, self.a_docs, b_starts, self.b_docs)
        linked = a_ends[self.at_a] == b_ends[self.at_b]
        self.last_a, self.last_b = self.at_a[linked], self.at_b[linked]
        self.groups = np.searchsorted(self.a_docs[self.last_a], np.arange(len(column) + 1))
        self.first_a, self.first_b = (np.concatenate([[0], np.cumsum(c)]) for c in (a_counts, b_counts))

    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of each group on either side."""
        return np.diff(self.last_a, prepend=-1), np.diff(self.last_b, prepend=-1)

    def links(self) -> np.ndarray:
        """The pairs of ids that end the groups, each as one number."""
        return self.a_ids[self.last_a] << 32 | self.b_ids[self.last_b]

    def group_texts(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` for each row."""
        a_sizes, b_sizes = self.sizes()
        # ids in the order of groups, side A first; each has room for the sign after it
        place_a = np.arange(len(self.a_ids)) + np.repeat(self.last_b + 1 - b_sizes, a_sizes)
        place_b = np.arange(len(self.b_ids)) + np.repeat(self.last_a + 1, b_sizes)
        ids, signs = np.zeros(len(self.a_ids) + len(self.b_ids), np.int64), np.full(len(self.a_ids) + len(self.b_ids), ord(","), np.uint8)
        ids[place_a], ids[place_b] = self.a_ids, self.b_ids
        signs[place_a[self.last_a]], signs[place_b[self.last_b]] = ord("|"), ord(";")
        numerals = decimals(1 << max(16, int(ids.max(initial=0)).bit_length()))
        listed = numerals.join(ids).copy()
        ends = np.concatenate([[0], np.cumsum(numerals.lengths(ids))])
        listed[ends[1:] - 1] = signs
        bounds, text = ends[self.first_a + self.first_b].tolist(), listed.tobytes()
        return [text[x : max(x, y - 1)] for x, y in zip(bounds, bounds[1:])]


@functools.lru_cache(2)
def decimals(n: int) -> Spelling:
    """Every id below n in decimal form, with a comma."""
    return Spelling([b"%d," % i for i in range(n)])


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(np.int32)))


def align(docs: DataFrame, vocabulary: str, model: str, *, text: str = "text") -> DataFrame:
    """The documents with ``a_ids`` and ``b_ids``; for each group the number of its tokens on either side, ``a_sizes`` and
    ``b_sizes``; and for each overlap the places of the two tokens, from 0, ``overlap_a`` and ``overlap_b``. Both paths name
    files that every executor has."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    names = ["a_ids", "b_ids", "a_sizes", "b_sizes", "overlap_a", "overlap_b"]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in chunked(batches, "text", SLICE_BYTES):
            x = Aligned(batch.column("text"), vocabulary, model)
            bounds = np.searchsorted(x.a_docs[x.at_a], np.arange(batch.num_rows + 1))
            lists = [(x.a_ids, x.first_a), (x.b_ids, x.first_b), *((s, x.groups) for s in x.sizes())]
            lists += [(x.at_a - x.first_a[x.a_docs[x.at_a]], bounds), (x.at_b - x.first_b[x.b_docs[x.at_b]], bounds)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *(_lists(*v) for v in lists)], ["row", *names])

    schema = T.StructType([*rows.select("row").schema.fields, *(T.StructField(n, INTS) for n in names)])
    out = rows.mapInArrow(tidy(run), schema)
    return out.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in names), *names)


def linked_documents(docs: DataFrame, vocabulary: str, model: str, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``n_a``, ``n_b`` and ``n_groups``, ``groups_sha256``, a hash of ``a1,a2|b1;a3|b2,b3`` (the ids of each group, side A
    first; empty without tokens), and ``links``: the linked pairs in order, eight bytes each (id of side A times 2**32
    plus id of side B, little-endian)."""
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in chunked(batches, "text", SLICE_BYTES):
            x = Aligned(batch.column("text"), vocabulary, model)
            links = x.links().astype("<i8").view(np.uint8)
            digests = [hashlib.sha256(t).hexdigest() if t else "" for t in x.group_texts()]
            columns = [
                *(pa.array(np.diff(v).astype(np.int64)) for v in (x.first_a, x.first_b, x.groups)),
                pa.array(digests, pa.string()),
                pa.BinaryArray.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((x.groups * 8).astype(np.int32)), pa.py_buffer(links)]),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    schema = T.StructType(rows.select("id").schema.fields)
    for c in ("n_a", "n_b", "n_groups"):
        schema.add(c, T.LongType())
    out = rows.mapInArrow(tidy(run), schema.add("groups_sha256", T.StringType()).add("links", T.BinaryType()))
    return out.withColumnRenamed("id", id)


def link_counts(linked: DataFrame) -> DataFrame:
    """``pair`` (as in ``links``) and ``links``, its number in all documents."""

    def run(batches: Iterator[pa.RecordBatch]):
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in chunked(batches, "links", 4 * SLICE_BYTES):
            data, _ = text_bytes(batch.column("links"))
            new, n = np.unique(np.frombuffer(data.tobytes(), "<i8"), return_counts=True)
            pairs, at = np.unique(np.concatenate([pairs, new]), return_inverse=True)
            held = np.zeros(len(pairs), np.int64)
            np.add.at(held, at, np.concatenate([counts, n]))
            counts = held
        for k in range(0, len(pairs), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[k : k + 50_000]), pa.array(counts[k : k + 50_000])], ["pair", "links"])

    return linked.select("links").mapInArrow(tidy(run), "pair long, links long").groupBy("pair").agg(F.sum("links").alias("links"))


def link_frequencies(linked: DataFrame, counts: DataFrame) -> DataFrame:
    """Instead of ``links``: ``n_links``; ``n_best``, the links whose pair is linked as often as any pair of their id of
    side B; and ``count_sum``, the sum of the counts of the links."""
    held = counts.toArrow()  # bounded by the two vocabularies, see above
    pairs, links = (held.column(c).to_numpy().astype(np.int64) for c in ("pair", "links"))
    order = np.argsort(pairs)
    pairs, links = pairs[order], links[order]
    b_ids, of = np.unique(pairs & 0xFFFFFFFF, return_inverse=True)
    most = np.zeros(len(b_ids), np.int64)
    np.maximum.at(most, of, links)
    known = linked.sparkSession.sparkContext.broadcast((pairs, links, (links == most[of]).astype(np.int64)))
    names = ["n_links", "n_best", "count_sum"]
    rows = linked.select(F.struct(*(c for c in linked.columns if c != "links")).alias("row"), "links")

    def run(batches: Iterator[pa.RecordBatch]):
        pairs, links, best = known.value
        for batch in chunked(batches, "links", 4 * SLICE_BYTES):
            data, ends = text_bytes(batch.column("links"))
            at = np.searchsorted(pairs, np.frombuffer(data.tobytes(), "<i8"))
            sums = [np.diff(np.concatenate([[0], np.cumsum(v[at])])[ends // 8]) for v in (best, links)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, (np.diff(ends) // 8, *sums))], ["row", *names])

    schema = T.StructType([*rows.select("row").schema.fields, *(T.StructField(n, T.LongType()) for n in names)])
    return rows.mapInArrow(tidy(run), schema).select("row.*", *names)


@query()
def op13_token_alignment(spark, sf_dir):
    """Groups and links of every document, and how usual its links are in all documents."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    linked = linked_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    linked = written(linked, "linked", compression="zstd")
    found = link_frequencies(linked, link_counts(linked))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
