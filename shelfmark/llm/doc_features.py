"""Counts over whole texts as DataFrame expressions. Each document is counted in its own row: no explode, no
shuffle. Null counts as the empty text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

GAP = "[\\x20\\x09-\\x0D]+"
GAPS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STOPS = ".!?"

COUNTS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_distinct n_echo n_upper n_digits n_stops".split()
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_of(text: Column, characters: str) -> Column:
    """How many of some characters a text holds."""
    return (F.char_length(text) - F.char_length(F.translate(text, characters, ""))).cast("long")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


def repeated_words(words: Column, size: int) -> Column:
    """Words inside windows of ``size`` words that occur twice or more, the first included. Only texts with a
    repeated window are sorted; covered words are then counted from the gaps between window starts."""

    def covered(grams: Column) -> Column:
        def starts(pairs: Column) -> Column:
            n = F.size(pairs)

            def twice(i: Column) -> Column:
                here = F.get(pairs, i)["h"]
                return F.coalesce(here == F.get(pairs, i - 1)["h"], F.lit(False)) | F.coalesce(here == F.get(pairs, i + 1)["h"], F.lit(False))

            return F.array_sort(F.transform(F.filter(F.sequence(F.lit(0), n - 1), twice), lambda i: F.get(pairs, i)["i"]))

        def total(at: Column) -> Column:
            after = F.concat(F.slice(at, 2, F.size(at)), F.array(F.lit(2**31 - 1)))
            return F.aggregate(F.zip_with(at, after, lambda a, b: F.least(b - a, F.lit(size))), F.lit(0).cast("long"), lambda x, y: x + y)

        pairs = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(let(let(pairs, starts), total))

    grams = F.transform(F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: F.xxhash64(F.slice(words, i, size)))
    return F.when(F.size(words) <= size, F.lit(0).cast("long")).otherwise(let(grams, covered))


def counts(text: Column) -> Column:
    """A struct of all ``COUNTS``."""

    def of(text: Column) -> Column:
        return let(
            words_of(text),
            lambda words: let(
                F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")),
                lambda lines: F.struct(
                    F.size(words).cast("long").alias("n_words"),
                    F.char_length(F.translate(text, GAPS, "")).cast("long").alias("word_chars"),
                    n_of(text, SYMBOLS).alias("n_symbols"),
                    (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                    repeated_words(words, 5).alias("n_repeat_words"),
                    F.size(lines).cast("long").alias("n_lines"),
                    F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
                    F.when(F.size(words) < 2, 0)
                    .otherwise(F.size(F.filter(F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: a == b), lambda e: e)))
                    .cast("long")
                    .alias("n_echo"),
                    n_of(text, UPPER).alias("n_upper"),
                    n_of(text, "0123456789").alias("n_digits"),
                    n_of(text, STOPS).alias("n_stops"),
                ),
            ),
        )

    return let(F.coalesce(text, F.lit("")), of)
