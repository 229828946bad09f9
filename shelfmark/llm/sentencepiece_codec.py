"""SentencePiece encoding and decoding by a streaming lattice search.

The text is read one character at a time. For every boundary within reach (the longest piece bounds the
reach) a backpointer names the last piece of the best path to it. As soon as the paths of all boundaries that
a later piece can still start at run through one common boundary, the pieces up to it are final: their ids
go out and the window moves there. Nothing behind that boundary is kept, however long the text is.

What makes a path best follows the model's type:

* ``unigram``: the largest sum of piece scores, so several pieces compete for each boundary;
* ``bpe``: the path that merging by rank gives. It is the only one in which no neighbouring pieces would have
  merged across their common boundary, so exactly one piece survives for each boundary.

Both give the ids of the model's own library. Between two characters that no piece holds next to each other all
paths meet, whatever surrounds them. In the usual models this is so before a space sign, so texts fall into
chunks of about a word, and a chunk that repeats is searched once per worker. A chunk of any length goes through the
same search.

Defined results: null and empty texts have no ids and decode to the empty text; a character without a piece
becomes its byte pieces, or the unknown id where the model has none (then it does not come back); the space sign U+2581
in a text decodes to a space, as in the library. Extra columns pass through.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunk_cache import ChunkIds, gathered
from .common import chunked, query, table, text_bytes, tidy

SPACE = "▁"
SLICE_BYTES, SLICE_IDS = 1 << 19, 250_000
#: Characters of a text that the search copies at a time.
PART_CHARS = 4096
#: Model types as the model files number them.
TYPES = {1: "unigram", 2: "bpe"}


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value, shift, at = value | (byte & 0x7F) << shift, shift + 7, at + 1
            if byte < 0x80:
                return value, at

    at = 0
    while at < len(data):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


def model_type(model: bytes) -> str:
    trainer = next((v for k, v in _fields(model) if k == 2), b"")
    return TYPES[next((v for k, v in _fields(trainer) if k == 3), 1)]


class Codec:
    """One loaded model. ``stream`` encodes normalised text given in parts of any size."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.processor = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.type = model_type(model)
        size = sp.vocab_size()
        self.byte_id = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        usable = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.id = {sp.id_to_piece(i): i for i in usable}
        self.score = {p: sp.get_score(i) for p, i in self.id.items()}
        self.reach = max(map(len, self.id), default=1)
        self.lowest = min(self.score.values(), default=0.0) - 10.0
        #: No piece crosses the start of a run of space signs.
        self.splits_at_spaces = not any(SPACE in p.lstrip(SPACE) for p in self.id)
        #: Pairs of ASCII characters that no piece holds next to each other: no piece crosses between them.
        self.never = np.ones((256, 256), bool)
        self.never[0x80:] = self.never[:, 0x80:] = False
        for p in self.id:
            for a, b in zip(p, p[1:]):
                if a.isascii() and b.isascii():
                    self.never[ord(a), ord(b)] = False
        if not self.byte_id:  # neighbouring unknown characters are one unknown id
            unknown = [c for c in range(0x80) if chr(c) not in self.id]
            self.never[np.ix_(unknown, unknown)] = False
        self.made_of: dict[str, tuple[str, str]] = {}
        self.apart: dict[tuple[str, str], bool] = {}
        self.rank, self.whole = {}, set()
        if self.type == "bpe":
            by_score = sorted(self.score, key=lambda p: -self.score[p])
            self.rank = {p: r for r, p in enumerate(by_score) if len(p) > 1}
            self.whole = {p for p in self.rank if self._merges_to_itself(p)}
        self.chunk_ids = ChunkIds(self._encode_chunks, 1_000_000)

    def _merges_to_itself(self, piece: str) -> bool:
        """Whether merging its characters by rank makes the piece; remembers what the last merge joined."""
        parts = list(piece)
        while len(parts) > 2:
            ranks = [self.rank.get(a + b, len(self.rank) * 9) for a, b in zip(parts, parts[1:])]
            k = ranks.index(min(ranks))
            if parts[k] + parts[k + 1] not in self.rank:
                return False
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        self.made_of[piece] = (parts[0], parts[1])
        return True

    def _stay_apart(self, a: str, b: str) -> bool:
        """Whether merging the characters of ``a + b`` by rank never joins across the boundary. Looks backwards
        in time: the later of the two pieces is taken apart, and what then met at the boundary must not have
        had a better rank than the merge that is undone. Of equal ranks the left one merges first."""
        known = self.apart.get((a, b))
        if known is not None:
            return known
        x, y, before = a, b, 1 << 60
        while True:
            if self.rank.get(x + y, 1 << 60) < before:
                result = False
                break
            made_x, made_y = (self.rank[p] if len(p) > 1 else -1 for p in (x, y))
            if made_x > made_y:
                x, before = self.made_of[x][1], made_x
            elif made_y >= 0:
                y, before = self.made_of[y][0], made_y + 1
            else:
                result = True
                break
        if len(self.apart) > 100_000:
            self.apart.clear()
        self.apart[a, b] = result
        return result

    def _emit(self, pieces: list[str], out: list[int]) -> None:
        for p in pieces:
            if p in self.id:
                out.append(self.id[p])
            elif self.byte_id:
                out.extend(self.byte_id[b] for b in p.encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)

    def stream(self, parts: Iterable[str]) -> Iterator[list[int]]:
        """Ids, as they become final."""
        reach, unigram = self.reach, self.type == "unigram"
        whole, apart, stay_apart, scores = self.whole, self.apart, self._stay_apart, self.score
        held = ""  # characters of the part in work, from the last final boundary on
        lo = i = 0  # the last final boundary, and the one that was reached last
        back: list = [None]  # last piece of the best path to each boundary from lo on
        best = [0.0]
        before: str | None = None  # the final piece before lo
        due, out = 4 * reach, []
        for part in parts:
            for at in range(0, len(part), PART_CHARS):
                held, i, lo = held[lo:] + part[at : at + PART_CHARS], i - lo, 0
                while i < len(held):
                    i += 1
                    n = i - lo
                    if unigram:
                        chosen, top = None, -1e300
                        for j in range(n - reach if n > reach else 0, n):
                            piece = held[lo + j : i]
                            score = scores.get(piece)
                            if score is None and j == n - 1:
                                score = self.lowest
                            if score is not None and best[j] + score > top:
                                chosen, top = piece, best[j] + score
                        best.append(top)
                    else:
                        for j in range(n - reach if n > reach else 0, n):
                            chosen = held[lo + j : i]
                            if j == n - 1 or chosen in whole:
                                last = back[j] if j else before
                                if last is None:
                                    break
                                known = apart.get((last, chosen))
                                if stay_apart(last, chosen) if known is None else known:
                                    break
                    back.append(chosen)
                    if n >= due:
                        meet = self._meeting(back, n)
                        if meet:
                            pieces = self._path(back, meet)
                            self._emit(pieces, out)
                            before = pieces[-1]
                            back, lo = [None, *back[meet + 1 :]], lo + meet
                            best = [b - best[meet] for b in best[meet:]] if unigram else best
                            # an unknown id at the cut is kept back, so that unknown characters stay one id
                            cut = len(out) - (not self.byte_id and out[-1] == self.unknown)
                            yield out[:cut]
                            out = out[cut:]
                        due = max(4 * reach, i - lo + reach)
        self._emit(self._path(back, i - lo), out)
        yield out

    def _meeting(self, back: list, i: int) -> int:
        """The last boundary that the paths of all boundaries within reach have in common."""
        alive = set(range(max(0, i - self.reach + 1), i + 1))
        while len(alive) > 1:
            last = max(alive)
            alive.remove(last)
            alive.add(last - len(back[last]))
        return alive.pop()

    @staticmethod
    def _path(back: list, end: int) -> list[str]:
        pieces = []
        while end:
            pieces.append(back[end])
            end -= len(back[end])
        return pieces[::-1]

    def _encode_chunks(self, chunks: list[bytes]):
        out: list[int] = []
        counts = []
        for chunk in chunks:
            n = len(out)
            for ids in self.stream([chunk.decode()]):
                out += ids
            counts.append(len(out) - n)
        return chunks, np.array(out, np.uint32), np.array(counts, np.int64)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        texts = [t.encode() for t in map(self.processor.normalize, column.fill_null("").to_pylist())]
        offsets = np.concatenate([[0], np.cumsum(list(map(len, texts)), dtype=np.int64)])
        data = np.frombuffer(b"".join(texts), np.uint8)
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets[:-1]] = True
        begins[1:-1] |= self.never[data[:-1], data[1:]]
        if self.splits_at_spaces:
            space = SPACE.encode()
            sign = np.flatnonzero(data == space[0])
            sign = sign[sign + 2 < len(data)]
            sign = sign[(data[sign + 1] == space[1]) & (data[sign + 2] == space[2])]
            begins[sign[np.diff(sign, prepend=-3) != 3]] = True
        starts = np.flatnonzero(begins[:-1])
        ids, counts = self.chunk_ids(data, starts, np.append(starts[1:], len(data)))
        return ids, np.diff(np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, offsets)])


class Decoder:
    """The bytes of every id of a model; all that decoding needs."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.prefix = sp.normalize("a") != "a"
        bytes_of = []
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_unknown(i):
                bytes_of.append(" ⁇ ".encode())
            else:
                bytes_of.append(b"" if sp.is_control(i) or sp.is_unused(i) else piece.replace(SPACE, " ").encode())
        self.piece_ends = np.cumsum(list(map(len, bytes_of)), dtype=np.int64)
        self.piece_bytes = np.frombuffer(b"".join(bytes_of), np.uint8)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of many texts, given all their ids and where each text's ids end; with the n + 1 offsets."""
        ids = ids.astype(np.int64)
        starts = self.piece_ends[ids - 1] * (ids > 0)
        data = gathered(self.piece_bytes, starts, self.piece_ends[ids])
        at = np.concatenate([[0], np.cumsum(self.piece_ends[ids] - starts)])
        offsets = at[np.concatenate([[0], ends])]
        if self.prefix and len(data):
            heads = offsets[:-1][offsets[:-1] < offsets[1:]]
            drop = heads[data[heads] == 0x20]
            keep = np.ones(len(data), bool)
            keep[drop] = False
            offsets = offsets - np.searchsorted(drop, offsets)
            data = data[keep]
        return data, offsets

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The decoded texts; bytes that are no UTF-8 become U+FFFD."""
        data, offsets = self.decode(ids, ends)
        held = data.tobytes()
        return pa.array([held[a:b].decode(errors="replace") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.string())


@functools.lru_cache(2)
def decoder(path: str) -> Decoder:
    with open(path, "rb") as file:
        return Decoder(file.read())


@functools.lru_cache(2)
def codec(path: str) -> Codec:
    with open(path, "rb") as file:
        return Codec(file.read())


def encode(docs: DataFrame, model: str, *, text: str = "text", into: str = "ids", decoded: str | None = None) -> DataFrame:
    """The documents with an array of ids. ``model`` is the path of a model file that every executor has. With
    ``decoded`` that column holds what the ids decode to, made by the worker that encoded them."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    names = [into, *([decoded] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in chunked(batches, "text", SLICE_BYTES):
            ids, counts = codec(model).encode(batch.column("text"))
            ends = np.cumsum(counts)
            columns = [batch.column("row"), pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.astype(np.int32)))]
            if decoded:
                columns.append(decoder(model).texts(ids, ends))
            yield pa.RecordBatch.from_arrays(columns, ["row", "ids", "decoded"][: len(columns)])

    schema = rows.select("row").schema.add("ids", T.ArrayType(T.IntegerType()))
    out = rows.mapInArrow(tidy(run), schema.add("decoded", T.StringType()) if decoded else schema)
    results = [F.col(c).alias(n) for c, n in zip(("ids", "decoded"), names)]
    return out.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in names), *results)


def decode(encoded: DataFrame, model: str, *, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """The rows with the text of their ids; bytes that are no UTF-8 become U+FFFD."""
    rows = encoded.select(F.struct("*").alias("row"), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            total = np.cumsum(batch.column("ids").value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < batch.num_rows:  # a slice of bounded size at a time, a row at least
                before = int(total[at - 1]) if at else 0
                to = max(at + 1, int(np.searchsorted(total, before + SLICE_IDS, "right")))
                part = batch.slice(at, to - at)
                flat = part.column("ids").flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([part.column("row"), decoder(model).texts(flat, total[at:to] - before)], ["row", "decoded"])
                at = to

    out = rows.mapInArrow(tidy(run), rows.select("row").schema.add("decoded", T.StringType()))
    return out.select(*(F.col("row")[c].alias(c) for c in encoded.columns if c != into), F.col("decoded").alias(into))


@query()
def op1_sentencepiece(spark, sf_dir):
    """Every document encoded and decoded again: number and hash of its ids, hash of the decoded text, and
    whether that is the document's text."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = encode(docs, model, decoded="decoded")
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )
