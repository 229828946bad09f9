"""Periodic runs of words in texts, found by minimizers at several scales.

A run is a stretch of consecutive words with smallest period q that is at least ``least`` words and ``exponent``
periods long and that neither neighbouring word prolongs. Two ways lead to candidates, pairs of places at which equal
words stand q apart:

* Periods of up to eight words: every word is compared with the one q places on, for each q.
* Longer ones, by scales. Scale L serves the periods above L/2, up to L. Every stretch of L words has a hash, and
  every window of L/2 neighbouring stretches selects the one with the smallest hash (its minimizer). A run is at least
  four periods long, so its first window and the one q places on lie inside it and hold the same words: both select
  the same stretch, q places apart. No equal stretch stands between the two: it would be as long as a period at
  least, so the run would have a smaller period. Hence the next equal minimizer is the partner to look at, and no
  scale has more candidates than selected stretches, however often a word or a stretch repeats.

Each candidate is extended to both sides as far as words q apart are equal, by binary search over hashes of stretches.
A stretch that is found with several periods keeps the smallest. Words are told apart exactly (by codes of their
bytes within a batch), stretches of words by 64-bit hashes, and every run is compared word by word in the end.

The work is the number of words times the logarithm of the longest text, in numpy over slices of bounded size; one
text is never split, so the longest text sets the memory of a task.

Defined results: null, empty and blank texts have no words, no runs and collapse to the empty text. Rows are treated
one by one, so repeated rows and repeated or null ids change nothing. An empty table gives an empty table. Extra columns
pass through, unless they are called like a result, which then takes their place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunk_cache import gathered
from .common import chunked, mixed, prefix_sums, query, running_sums, span_hashes, table, text_bytes, tidy, word_spans

SLICE_BYTES = 4 << 20
#: Periods of up to so many words are scanned for directly.
SHORT = 8
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")]), False)


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for every word, equal for equal bytes only: words that share a hash are compared byte by byte
    with the first of them, and a word that differs gets a number of its own."""
    _, first, codes = np.unique(span_hashes(prefix_sums(data), starts, ends), return_index=True, return_inverse=True)
    model = first[codes]
    lengths = ends - starts
    same = lengths == lengths[model]
    pick = np.flatnonzero(same)
    differs = gathered(data, starts[pick], ends[pick]) != gathered(data, starts[model[pick]], ends[model[pick]])
    same[pick[np.repeat(np.arange(len(pick)), lengths[pick])[differs]]] = False
    if not same.all():
        held, own = data.tobytes(), {}
        for i in np.flatnonzero(~same).tolist():
            codes[i] = len(first) + own.setdefault(held[starts[i] : ends[i]], len(own))
    return codes


class Stretches:
    """Hashes of stretches of numbers, and how far two places agree."""

    def __init__(self, codes: np.ndarray):
        self.sums = running_sums(mixed(codes.astype(np.uint64) + np.uint64(1)))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return span_hashes(self.sums, starts, ends)

    def agree(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        """How many numbers from ``a`` and ``b`` on (``way`` 1) or before them (-1) are equal, ``most`` at most."""
        known, limit = np.zeros(len(a), np.int64), most.astype(np.int64)
        while True:
            open_ = np.flatnonzero(known < limit)
            if not len(open_):
                return known
            middle = (known[open_] + limit[open_] + 1) >> 1
            x, y = a[open_], b[open_]
            if way > 0:
                equal = self.hashes(x, x + middle) == self.hashes(y, y + middle)
            else:
                equal = self.hashes(x - middle, x) == self.hashes(y - middle, y)
            known[open_] = np.where(equal, middle, known[open_])
            limit[open_] = np.where(equal, limit[open_], middle - 1)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Places of the leftmost smallest value of every window of ``width`` neighbours."""
    best, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = best[:-step], best[step:]
        later = right < left
        at = np.where(later, at[step:], at[:-step])
        best = np.where(later, right, left)
        have += step
    return at


def _short_runs(codes: np.ndarray, rows: np.ndarray, least: int, exponent: int) -> Iterator[tuple]:
    for q in range(1, SHORT + 1):
        if len(codes) <= q:
            return
        equal = (codes[:-q] == codes[q:]) & (rows[:-q] == rows[q:])
        edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).view(np.int8)))
        start, end = edges[::2], edges[1::2] + q
        keep = end - start >= max(least, exponent * q)
        yield start[keep], end[keep], np.full(int(keep.sum()), q)


def _scale_runs(codes: np.ndarray, row_first: np.ndarray, least: int, exponent: int) -> Iterator[tuple]:
    """Runs of longer periods, over rows that are long enough for the scale."""
    n_words = np.diff(row_first)
    scale = 2 * SHORT
    while True:
        fits = n_words >= max(least, exponent * (scale // 2 + 1))
        if not fits.any():
            return
        lo, hi = row_first[:-1][fits], row_first[1:][fits]
        own = gathered(codes, lo, hi)
        first = np.concatenate([[0], np.cumsum(hi - lo)])
        row = np.repeat(np.arange(len(lo)), hi - lo)
        stretches = Stretches(own)
        if len(own) > scale:
            at = np.arange(len(own) - scale + 1)
            hashes = stretches.hashes(at, at + scale)
            hashes[row[at] != row[at + scale - 1]] = np.uint64(2**64 - 1)
            chosen = np.zeros(len(hashes), bool)
            chosen[window_minima(hashes, min(scale // 2, len(hashes)))] = True
            chosen &= row[at] == row[at + scale - 1]
            chosen = np.flatnonzero(chosen)
            order = chosen[np.lexsort((chosen, hashes[chosen]))]
            x, y = order[:-1], order[1:]
            q = y - x
            pair = (hashes[x] == hashes[y]) & (row[x] == row[y]) & (q > scale // 2) & (q <= scale)
            x, y, q = x[pair], y[pair], q[pair]
            start = x - stretches.agree(x, y, x - first[row[x]], -1)
            end = y + stretches.agree(x, y, first[row[x] + 1] - y, 1)
            keep = end - start >= np.maximum(least, exponent * q)
            found = np.unique(np.stack([start[keep], end[keep], q[keep]]), axis=1)
            yield _as_compared(own, *found, lo[row[found[0]]] - first[row[found[0]]])
        scale *= 2


def _as_compared(codes, start, end, q, shift) -> tuple:
    """The runs whose words q apart really are equal, moved to their places in all words."""
    spans = np.maximum(end - start - q, 0)
    differs = gathered(codes, start, end - q) != gathered(codes, start + q, end)
    good = np.ones(len(start), bool)
    good[np.repeat(np.arange(len(start)), spans)[differs]] = False
    return start[good] + shift[good], end[good] + shift[good], q[good]


def runs_of(codes: np.ndarray, row_first: np.ndarray, least: int = 6, exponent: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of all rows, by start, then period. ``codes`` has a number for each word;
    row i has those from ``row_first[i]`` to ``row_first[i + 1]``."""
    rows = np.repeat(np.arange(len(row_first) - 1), np.diff(row_first))
    found = [*_short_runs(codes, rows, least, exponent), *_scale_runs(codes, row_first, least, exponent)]
    start, end, q = (np.concatenate([np.zeros(0, np.int64), *part]).astype(np.int64) for part in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    once = np.ones(len(start), bool)
    once[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[once], end[once], q[once]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def mark_runs(docs: DataFrame, *, text: str = "text", least: int = 6, exponent: int = 4) -> DataFrame:
    """The documents with ``n_words``, ``runs`` (start, length and period of each run, in words, by start, then
    period) and ``collapsed``: the words that are not in a run after its first period, joined by one space.

    A run is ``least`` words and ``exponent`` periods long at least; ``exponent`` is 4 or more."""
    if exponent < 4:
        raise ValueError("runs of less than four periods have no pair of windows to be found by")
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    results = T.StructType().add("n_words", T.LongType()).add("runs", RUNS).add("collapsed", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in chunked(batches, "text", SLICE_BYTES):
            data, offsets = text_bytes(batch.column("text"))
            starts, ends, row_first = word_spans(data, offsets)
            codes = word_codes(data, starts, ends)
            start, end, q = runs_of(codes, row_first, least, exponent)
            run_ends = np.searchsorted(start, row_first)
            row = np.searchsorted(row_first, start, "right") - 1
            runs = pa.StructArray.from_arrays(
                [pa.array(start - row_first[row]), pa.array(end - start), pa.array(q)],
                fields=[pa.field(c, pa.int64(), False) for c in ("start", "length", "period")],
            )
            runs = pa.ListArray.from_arrays(pa.array(run_ends.astype(np.int32)), runs)
            runs = runs.cast(pa.list_(pa.field("element", runs.type.value_type, False)))
            # every word in a run after its first period goes
            depth = np.zeros(len(codes) + 1, np.int64)
            np.add.at(depth, start + q, 1)
            np.add.at(depth, end, -1)
            kept = np.flatnonzero(np.cumsum(depth)[:-1] == 0)
            joined = gathered(np.append(data, np.uint8(0x20)), starts[kept], ends[kept] + 1).copy()
            word_ends = np.cumsum(ends[kept] - starts[kept] + 1)
            joined[word_ends - 1] = 0x20
            bounds = np.concatenate([[0], word_ends])[np.searchsorted(kept, row_first)].tolist()
            held = joined.tobytes()
            collapsed = [held[a : max(a, b - 1)].decode() for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.diff(row_first)), runs, pa.array(collapsed, pa.string())],
                ["row", "n_words", "runs", "collapsed"],
            )

    schema = T.StructType([*rows.select("row").schema.fields, *results.fields])
    out = rows.mapInArrow(tidy(run), schema)
    return out.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in results.names), *results.names)


def strongest(runs: Column) -> Column:
    """The run with the most periods, compared exactly; of equal ones the first. Null without runs."""
    more = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    none = F.lit(None).cast(RUNS.elementType)
    return F.reduce(runs, none, lambda best, r: F.when(best.isNull() | more(best, r), r).otherwise(best))


def with_planted_period(docs: DataFrame) -> DataFrame:
    """The rows of ``doc_id`` and ``text``, in which every document whose h = crc32 of the decimal id is a multiple of
    ten repeats its words from word g % n on with the period 1 + (n - a) // (3 + g % 8), g = h // 10."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = docs.where(h % 10 == 0).select("doc_id", words.alias("words"), F.floor(h / 10).alias("g"))
    planted = planted.withColumn("n", F.size("words").cast("long")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    planted = planted.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    head = F.slice("words", F.lit(1), F.col("a").cast("int"))
    cycle = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p"))
    tail = F.slice(F.flatten(F.array_repeat(cycle, times.cast("int"))), F.lit(1), (F.col("n") - F.col("a")).cast("int"))
    text = F.when(F.col("n") > 0, F.array_join(F.concat(head, tail), " "))
    return docs.where(F.coalesce(h % 10 != 0, F.lit(True))).unionAll(planted.select("doc_id", text.alias("text")))


@query()
def op12_periodic_runs(spark, sf_dir):
    """The runs of every document, the strongest one, and hashes of all runs and of the text without repeats."""
    marked = mark_runs(with_planted_period(table(spark, sf_dir, "documents").select("doc_id", "text")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return marked.withColumn("best", strongest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
