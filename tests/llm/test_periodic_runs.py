import hashlib
import random
import re
import zlib

import edges
import numpy as np
import pytest

from shelfmark.llm import periodic_runs as pr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=6, exponent=4):
    """Every maximal stretch of every period, straight from the definition."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        s = 0
        while s + q < n:
            if words[s] != words[s + q]:
                s += 1
                continue
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e + q - s >= max(least, exponent * q):
                found.setdefault((s, e + q), q)  # q ascends: the smallest period of the stretch comes first
            s = e + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def planted(doc_id, words):
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = None
    for s, length, q in runs:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    milli = best and 1000 * best[1] // best[2]
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))


def some_words(rng):
    kind = rng.randrange(5)
    if kind == 0:
        return [rng.choice("ab") for _ in range(rng.randint(0, 200))]
    if kind == 1:  # nested repeats
        inner = [rng.choice("abc") for _ in range(rng.randint(1, 5))] * rng.randint(1, 8)
        return (inner + ["x"]) * rng.randint(1, 9) + inner[: rng.randint(0, 9)]
    if kind == 2:  # long periods between other words
        cycle = [f"w{rng.randrange(40)}" for _ in range(rng.randint(1, 90))]
        return [f"h{i}" for i in range(rng.randint(0, 30))] + (cycle * 6)[: rng.randint(1, 6 * len(cycle))] + ["end"] * rng.randint(0, 9)
    if kind == 3:  # two runs that overlap
        a, b = ["a"] * rng.randint(1, 40), [rng.choice("ab") for _ in range(rng.randint(9, 20))] * 5
        return a + b + a
    return [f"v{rng.randrange(1000)}" for _ in range(rng.randint(0, 300))]


@pytest.mark.parametrize("seed", range(40))
def test_against_the_definition(seed):
    rng = random.Random(seed)
    rows = [some_words(rng) for _ in range(rng.randint(0, 40))]
    codes = {}
    flat = np.array([codes.setdefault(w, len(codes)) for r in rows for w in r], np.int64)
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)]).astype(np.int64)
    start, end, q = pr.runs_of(flat, first)
    got = [[] for _ in rows]
    for s, e, p in zip(start.tolist(), end.tolist(), q.tolist()):
        i = int(np.searchsorted(first, s, "right")) - 1
        got[i].append((s - int(first[i]), e - s, p))
    assert got == [brute_runs(r) for r in rows]


def test_every_period_is_found():
    for q in range(1, 140):
        cycle = [f"c{i}" for i in range(q)]
        words = ["left"] + (cycle * 6)[: max(6, 4 * q)] + ["right"]
        codes = {}
        flat = np.array([codes.setdefault(w, len(codes)) for w in words], np.int64)
        start, end, period = pr.runs_of(flat, np.array([0, len(flat)]))
        assert (start.tolist(), end.tolist(), period.tolist()) == ([1], [len(words) - 1], [q])


def test_word_codes_tell_words_apart():
    data = np.frombuffer(b"ab abc ab b abc", np.uint8)
    starts, ends = np.array([0, 3, 7, 10, 12]), np.array([2, 6, 9, 11, 15])
    codes = pr.word_codes(data, starts, ends)
    assert codes[0] == codes[2] and codes[1] == codes[4] and len(set(codes.tolist())) == 3


def test_words_of_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(pr, "span_hashes", lambda sums, starts, ends: np.zeros(len(starts), np.uint64))
    data = np.frombuffer(b"ab cd ab efg cd", np.uint8)
    starts, ends = np.array([0, 3, 6, 9, 13]), np.array([2, 5, 8, 12, 15])
    codes = pr.word_codes(data, starts, ends)
    assert codes[0] == codes[2] and codes[1] == codes[4] and len({codes[0], codes[1], codes[3]}) == 3


def test_query(spark, tmp_path):
    rng = random.Random(5)
    sep = lambda: rng.choice([" ", "  ", "\n", "\t ", "\x0b", "\r\n"])
    texts = ["".join(w + sep() for w in some_words(rng)) for _ in range(150)]
    texts += [None, "", " \n ", "é日 " * 9, "a\xa0b a\xa0b " * 4, "same words here " * 400]
    rows = [*enumerate(texts), (3, texts[3]), (3, texts[4]), (None, "a a a a a a a"), (-7, "z " * 30)]
    spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, runs int").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in pr.op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((expected(*r) for r in rows), key=str)
    assert sum(r[1] for r in got) > 200 and any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(150))


def test_edges(spark):
    docs = edges.documents(spark).withColumn("collapsed", pr.F.lit("other"))
    got = pr.mark_runs(docs)
    assert set(docs.columns) <= set(got.columns)
    for r in got.collect():
        words = WORD.findall(r.text or "")
        assert r.n_words == len(words)
        runs = [tuple(x) for x in r.runs]
        assert runs == (brute_runs(words) if len(words) < 1000 else [(0, 80_000, 4)])
    assert pr.mark_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError, match="four periods"):
        pr.mark_runs(docs, exponent=3)
