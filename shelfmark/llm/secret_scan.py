"""Secret scan: fixed patterns, and guess costs of values that stand in a credential context.

A value after a credential word may be a real secret or a placeholder. Its guess cost is the smallest sum, over
all ways to cut it into parts, of the base-10 logarithm of the guesses for each part: a ranked word, a date, a
repeat, a keyboard walk, or brute force. Values that cost at least ``min_cost`` are reported as ``guess`` spans,
unless a fixed pattern's span covers them already. Words and their ranks come from a public vocabulary file,
earlier entries being more frequent.

Defined results: null and empty texts have no spans. Offsets count code points, the end is exclusive. A value
longer than ``WINDOW`` characters is cut freely, with parts of at most that length. Extra columns pass through.
"""

from __future__ import annotations

import functools
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import query, table

KINDS = ("assign", "access", "hex", "guess")
#: The patterns of the base kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the same as whole runs of 16 or more
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

#: Credential words whose values are weighed, with what may stand between. They may end a longer name. The scheme after
#: ``Authorization:`` is no value. After a scheme, a space alone is enough, if no plain word follows.
CONTEXT = re.compile(
    r"""(?:(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth(?:orization)?|bearer|"""
    r"""(?:(?:api|access|private|secret|client|encryption)[_\x20-]?)+key)["']?\x20*(?::|=>?|\bis\b)\x20*(["']?)"""
    r"""(?:(?:bearer|basic|digest|negotiate|token|apikey)\x20+)?|"""
    r"""\b(?:bearer|basic)\x20+(?-i:(?![A-Z]?[a-z]+(?![A-Za-z0-9+/_=~-]))))([^\s"']{6,})""",
    re.IGNORECASE | re.ASCII,
)
SCHEME = re.compile("bearer |basic ", re.IGNORECASE)
#: Rows of keys, and a few words that stand first in any list of passwords.
KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz", "1qaz2wsx3edc4rfv5tgb6yhn7ujm8ik9ol0p")
COMMON = "password passwort secret admin user test example changeme letmein welcome login master root default dummy sample".split()
LOOKALIKE = str.maketrans("013457@$!", "oleastasi")
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")

WINDOW = 40
PART = math.log10(2)  # for each further part, as the guesser does not know where to cut


def _brute(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 1000)


def ranked_words(vocabulary: str) -> dict[str, int]:
    """Rank of each word of three or more letters in a vocabulary file (token -> id, as JSON)."""
    with open(vocabulary, encoding="utf-8") as file:
        ids = json.load(file)["model"]["vocab"]
    ranks: dict[str, int] = {w: r for r, w in enumerate(COMMON, 1)}
    for token in sorted(ids, key=ids.get):
        word = token.removeprefix("Ġ").lower()
        if len(word) >= 3 and word.isascii() and word.isalpha():
            ranks.setdefault(word, len(ranks) + 1)
    return ranks


class GuessCost:
    def __init__(self, ranks: dict[str, int]):
        self.ranks = ranks
        self.longest = min(WINDOW, max(map(len, ranks), default=0))
        self.next_key = {(a, b) for row in KEY_ROWS for a, b in zip(row, row[1:])}
        self.next_key |= {(b, a) for a, b in self.next_key}

    def _parts(self, value: str) -> dict[int, list[tuple[int, float]]]:
        """End of each possible part -> its starts and costs (brute force aside)."""
        parts: dict[int, list[tuple[int, float]]] = {}
        lower = value.lower()
        plain = lower.translate(LOOKALIKE)
        n = len(value)
        for i in range(n):
            for j in range(i + 3, min(n, i + self.longest) + 1):
                for text in {lower[i:j], plain[i:j]}:
                    if text in self.ranks:
                        changed = sum(a != b for a, b in zip(text, value[i:j]))
                        parts.setdefault(j, []).append((i, math.log10(self.ranks[text] + 1) + PART * min(changed, 3)))
            if m := DATE.match(value, i):
                parts.setdefault(m.end(), []).append((i, math.log10(200 * (365 if m.end() - i > 4 else 1))))
            j = i + 1
            while j < n and j - i < WINDOW and (lower[j - 1], lower[j]) in self.next_key:
                j += 1
                if j - i >= 3:
                    parts.setdefault(j, []).append((i, math.log10(80 * (j - i))))
            for size in range(1, 5):
                unit, j = value[i : i + size], i + size
                while value[j : j + size] == unit and j + size - i <= WINDOW:
                    j += size
                    if j - i >= 3:
                        parts.setdefault(j, []).append((i, sum(map(_brute, unit)) + math.log10((j - i) / size)))
        return parts

    def __call__(self, value: str) -> float:
        """Base-10 logarithm of the guesses for the cheapest way to cut the value."""
        parts = self._parts(value)
        # per place, the cheapest way that ends in a brute-force part, which one more character extends, and of all others
        brute, other = [math.inf], [-PART]
        for j in range(1, len(value) + 1):
            ways = [min(brute[i], other[i]) + PART + own for i, own in parts.get(j, ())]
            brute.append(min(brute[j - 1], other[j - 1] + PART) + _brute(value[j - 1]))
            other.append(min(ways, default=math.inf))
        return min(brute[-1], other[-1]) if value else 0.0


@functools.lru_cache(2)
def guess_cost(vocabulary: str) -> GuessCost:
    return GuessCost(ranked_words(vocabulary))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of the fixed patterns' matches."""
    found = []
    if ":" in text or "=" in text:
        found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return found


def guess_spans(text: str, cost: GuessCost, min_cost: float, covered: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    if ":" not in text and "=" not in text and " is " not in text.lower() and not SCHEME.search(text):
        return []
    out = []
    covering, reach = sorted(covered)[::-1], 0  # how far spans reach that begin before a value
    for m in CONTEXT.finditer(text):
        start, end = m.span(2)
        if not m[1]:
            end = start + len(m[2].rstrip(".,;:!?)]}>"))
        while covering and covering[-1][0] <= start:
            reach = max(reach, covering.pop()[1])
        if end - start < 6 or end <= reach:
            continue
        if cost(text[start:end]) >= min_cost:
            out.append((start, end, "guess"))
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))))


def scan_secrets(docs: DataFrame, vocabulary: str, *, text: str = "text", min_cost: float = 10.0) -> DataFrame:
    """``row`` (all columns of the document) with counts of each base kind, ``base`` and ``spans`` as
    kind:start:end lists."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    counts = ["n_assign", "n_access", "n_hex"]

    def run(batches: Iterator[pa.RecordBatch]):
        cost = guess_cost(vocabulary)
        for batch in batches:
            out: dict[str, list] = {n: [] for n in (*counts, "base", "spans")}
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                for name, kind in zip(counts, KINDS):
                    out[name].append(sum(s[2] == kind for s in base))
                out["base"].append(joined(base))
                out["spans"].append(joined(base + guess_spans(text or "", cost, min_cost, base)))
            arrays = [pa.array(out[n], pa.int64()) for n in counts] + [pa.array(out[n], pa.string()) for n in ("base", "spans")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *arrays], ["row", *out])

    schema = rows.select("row").schema
    for name in counts:
        schema = schema.add(name, T.LongType())
    return rows.mapInArrow(run, schema.add("base", T.StringType()).add("spans", T.StringType()))


@query()
def op9_secret_scan(spark, sf_dir):
    """Secrets in every document: counts and hash of the fixed patterns' spans, and all spans."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_secrets(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans"
    )
