"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items go into one automaton. Training words stream through it: the automaton knows
the longest run of words, ending at the current word, that occurs in some item. A run of ``window`` words (or
a whole item, if that is shorter) marks its words as hit.

Items are taken in blocks of at most ``BLOCK_WORDS`` words (one item at least), so what is broadcast is bounded
whatever the size of the benchmark; each block is one more pass over the documents.

Defined results: null or empty texts have no words and no hits; an item without words matches nothing; items
that repeat under one id count once; hits through items whose id is null count, but no id is listed for them.
Further columns of the documents pass through untouched, whatever they are called.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, query, table, text_bytes, tidy, written

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLOCK_WORDS = 500_000

SPANS = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in ("first", "last")]))


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().translate(LOWER))


class ItemAutomaton:
    """Suffix automaton over the word sequences of all items, with the items each window occurs in."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        #: State of a full window -> ids of the items it occurs in.
        self.windows: dict[int, set[str]] = {}
        #: State -> (number of words, ids) of short items that end there.
        self.short: dict[int, tuple[int, set[str]]] = {}
        numbered = [(i, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for i, words in items if words]
        for _, words in numbered:
            last = 0
            for w in words:
                last = self._extend(last, w)
        #: State -> the state that stands for the last ``window`` words of its runs. Links lead to shorter runs.
        by_length = sorted(range(len(self.step)), key=self.length.__getitem__)
        self.anchor = list(range(len(self.step)))
        for state in by_length[1:]:
            if self.length[self.link[state]] >= window:
                self.anchor[state] = self.anchor[self.link[state]]
        for item, words in numbered:
            state, n = 0, 0
            for w in words:
                state, n = self.step[state][w], n + 1
                if n >= window:
                    self.windows.setdefault(self.anchor[state], set()).update([item] if item is not None else [])
            if n < window:
                self.short.setdefault(state, (n, set()))[1].update([item] if item is not None else [])
        self.least = min([window, *(n for n, _ in self.short.values())])
        #: State -> the longest run of its ending, itself included, that is a short item; 0 without one.
        self.ending = [0] * len(self.step)
        for state in by_length[1:]:
            self.ending[state] = state if state in self.short else self.ending[self.link[state]]

    def _copy(self, state: int, at: int, w: int) -> int:
        """The state of the longest run that ends with ``w`` after ``at``: split off from ``state`` if that also
        stands for longer runs."""
        if self.length[state] == self.length[at] + 1:
            return state
        new = len(self.step)
        self.step.append(dict(self.step[state]))
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[state])
        self.link[state] = new
        while at >= 0 and self.step[at].get(w) == state:
            self.step[at][w] = new
            at = self.link[at]
        return new

    def _extend(self, last: int, w: int) -> int:
        if w in self.step[last]:
            return self._copy(self.step[last][w], last, w)
        new = len(self.step)
        self.step.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        at = last
        while at >= 0 and w not in self.step[at]:
            self.step[at][w] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._copy(self.step[at][w], at, w)
        return new

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged spans of hit words (first, last) and ids of the items whose windows occur."""
        known = bytes(map(self.vocabulary.__contains__, words))
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        seen: set[int] = set()  # states whose items are in already
        window, step, link, length = self.window, self.step, self.link, self.length
        for run in re.finditer(rb"\x01{%d,}" % self.least, known):
            state = n = 0
            for i in range(run.start(), run.end()):
                w = self.vocabulary[words[i]]
                while w not in step[state]:
                    state = link[state]
                    n = length[state]
                state, n = step[state][w], n + 1
                size = 0
                if n >= window:
                    at = self.anchor[state]
                    if at not in seen:
                        seen.add(at)
                        items |= self.windows[at]
                    size = window
                at = self.ending[state]
                while at:  # at most as many as there are lengths below the window
                    if (m := self.short[at][0]) <= n:
                        size = max(size, m)
                        if ~at not in seen:
                            seen.add(~at)
                            items |= self.short[at][1]
                    at = self.ending[link[at]]
                if size:
                    first = i - size + 1
                    while spans and spans[-1][1] >= first - 1:
                        first = min(first, spans.pop()[0])
                    spans.append((first, i))
        return spans, items


def _merged(old: list, new: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted([(s["first"], s["last"]) for s in old] + new):
        if out and out[-1][1] >= first - 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def item_blocks(items: DataFrame, id: str, text: str, block_words: int) -> Iterator[list[tuple[str | None, list[bytes]]]]:
    """The items, a bounded block at a time. A block is chosen by hash, so no list of items is kept anywhere."""
    counted = items.select(F.col(id).cast("string").alias("id"), F.col(text).alias("text"))
    size = F.size(F.split("text", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"))
    n = counted.agg(F.sum(F.greatest(size, F.lit(0)))).first()[0] or 0
    blocks = -(-n // block_words) or 1
    for b in range(blocks):
        part = counted.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
        yield [(r["id"], words_of(r["text"])) for r in part.toLocalIterator()]


def mark_contamination(
    docs: DataFrame, items: DataFrame, *, window: int = 10, id: str = "item_id", text: str = "text",
    item_text: str = "text", block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``row`` (all columns of the document), ``text``, ``n_words``, ``spans`` of hit words, ``items`` hit."""
    spark = docs.sparkSession
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    for k, block in enumerate(item_blocks(items, id, item_text, block_words)):
        automaton = spark.sparkContext.broadcast(ItemAutomaton(block, window))
        if k:
            rows = written(rows, "decontamination")

        def scan(batches: Iterator[pa.RecordBatch], automaton=automaton, more=k > 0):
            for batch in batches:
                data, at = text_bytes(batch.column("text"))
                lower = data.tobytes().translate(LOWER)
                n_words, spans, found = [], [], []
                for i in range(batch.num_rows):
                    words = WORD.findall(lower, at[i], at[i + 1])
                    hit, ids = automaton.value.hits(words)
                    if more:
                        hit = _merged(batch.column("spans")[i].as_py(), hit)
                        ids = ids | set(batch.column("items")[i].as_py())
                    n_words.append(len(words))
                    spans.append([{"first": a, "last": b} for a, b in hit])
                    found.append(sorted(ids))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row"),
                        batch.column("text"),
                        pa.array(n_words, pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                        pa.array(found, pa.list_(pa.string())),
                    ],
                    ["row", "text", "n_words", "spans", "items"],
                )

        schema = rows.select("row", "text").schema.add("n_words", T.LongType())
        rows = rows.mapInArrow(tidy(scan), schema.add("spans", SPANS).add("items", T.ArrayType(T.StringType())))
    return rows


def decontaminate(
    docs: DataFrame, items: DataFrame, *, window: int = 10, max_span: int = 0, max_coverage: float = 0.5, text: str = "text", **options,
) -> DataFrame:
    """The documents with hit spans of more than ``max_span`` words cut out of their text; a document goes if
    more than ``max_coverage`` of its words are hit. Documents without a hit are returned as they are."""
    marked = mark_contamination(docs, items, window=window, text=text, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    marked = marked.where(n_hit <= F.lit(max_coverage) * F.col("n_words"))

    def cut(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            out = []
            spans = batch.column("spans").to_pylist()
            texts = batch.column("text")
            for i, found in enumerate(spans):
                wanted = [s for s in found if s["last"] - s["first"] + 1 > max_span]
                if not wanted:
                    out.append(texts[i].as_py())
                    continue
                held = texts[i].as_py().encode()
                places = [m.span() for m in WORD.finditer(held.translate(LOWER))]
                kept, at = [], 0
                for s in wanted:
                    kept.append(held[at : places[s["first"]][0]])
                    at = places[s["last"]][1]
                out.append(b"".join([*kept, held[at:]]).decode())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], ["row", "text"])

    cleaned = marked.select("row", "text", "spans").mapInArrow(tidy(cut), marked.select("row", "text").schema)
    return cleaned.select(*(F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))


_LOWER_SQL = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS_SQL = rf"regexp_extract_all(coalesce({_LOWER_SQL}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(rf"""
WITH item AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
item_window AS (
  SELECT DISTINCT item_id, size, gram FROM (
    SELECT item_id, least(len(w), 10) AS size, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2),
      lambda i: list_slice(w, i, i + least(len(w), 10) - 1))) AS gram FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM item_window),
doc AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
doc_window AS (
  SELECT doc_id, size, p, list_slice(w, p, p + size - 1) AS gram
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM doc, sizes WHERE len(w) >= size)),
hit AS (SELECT doc_id, item_id, p, d.size FROM doc_window d JOIN item_window i ON d.size = i.size AND d.gram = i.gram),
word_hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word_hit USING (doc_id) LEFT JOIN found USING (doc_id)
""")
def op2_decontamination(spark, sf_dir):
    """Hit words and items of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = mark_contamination(docs, table(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return marked.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
