import random
import re

import edges
import pytest

from shelfmark.llm import blocks, components
from shelfmark.llm import ngram_jaccard as nj

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, size, percent):
    sets = []
    for _, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)), key=lambda k: rows[k][0])
                parent[b] = a
    return sorted((rows[i][0], len(sets[i]), rows[root(i)][0]) for i in range(len(rows)))


def texts(seed, copies=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(300)] + ["the", "The", "of"] * 40
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 80))] for _ in range(12)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    rows = [None, "", " \n ", "one", "one", "ONE", "one two", "one  two", "one two three"]
    for _ in range(copies):
        words = list(rng.choice(base[:4]))
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append(" ".join(words))
    for b in base:
        rows += [" ".join(b), " ".join(b + passage), "\n".join(passage + b[:3])]
    chain = [f"c{i}" for i in range(120)]
    rows += [" ".join(chain[i : i + 60]) for i in range(0, 30, 2)]  # each links with the next only
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_against_all_pairs(spark, monkeypatch, size, percent):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(nj, "TARGET_BYTES", 5000)
    monkeypatch.setattr(nj, "CHUNK_TOKENS", 200)
    monkeypatch.setattr(nj, "CHUNK_QUERIES", 3)
    rows = texts(size)
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, tokens int").repartition(3)
    got = sorted(tuple(r) for r in nj.similar_documents(docs, size=size, percent=percent).collect())
    assert got == brute(rows, size, percent)


def test_rows_of_one_id_and_of_none(spark):
    rows = [(7, "x y z w"), (7, "a b c d e"), (8, "x y z w"), (8, "q r s t u"), (4, "a b c d e"), (None, "a b c d e"), (None, "a b c d e"), (None, "own words of its own")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, _gone int, key string")
    kept = nj.keep_one_of_each(docs, size=3, percent=90)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(7, "x y z w"), (8, "q r s t u"), (4, "a b c d e"), (None, "own words of its own")], key=str)
    found = sorted(((r.doc_id, r.component_id) for r in nj.similar_documents(docs, size=3, percent=90).collect()), key=str)
    assert found == sorted([(7, 7), (7, 4), (8, 7), (8, 8), (4, 4), (None, 4), (None, 4), (None, None)], key=str)


def test_a_chain_in_ascending_order_takes_few_rounds(spark, monkeypatch):
    rounds, write = [], components.written
    monkeypatch.setattr(components, "written", lambda df, label: (rounds.append(label), write(df, label))[1])
    links = spark.range(1000).selectExpr("id AS a", "id + 1 AS b").unionAll(spark.createDataFrame([(-5, -9), (2000, 2000)], "a long, b long"))
    got = {r.v: r.c for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(1001)}, -5: -9, -9: -9, 2000: 2000}
    assert rounds.count("link-parents") <= 20


def test_edges(spark):
    docs = edges.documents(spark)
    want = brute([(i, r.text) for i, r in enumerate(docs.collect())], 3, 90)
    got = nj.similar_documents(docs, size=3, percent=90).collect()
    assert sorted(r.n_shingles for r in got) == sorted(n for _, n, _ in want)
    kept = nj.keep_one_of_each(docs, size=3, percent=90)
    assert kept.columns == docs.columns
    assert kept.count() == len({c for _, n, c in want if n}) + sum(n == 0 for _, n, _ in want)
    assert nj.keep_one_of_each(docs.limit(0)).count() == 0


def test_keeps_one_of_each_and_all_columns(spark):
    docs = spark.createDataFrame([(5, "a b c d", "x"), (3, "A b c d", "y"), (7, None, "z"), (8, "", "z")], "doc_id long, text string, n string")
    assert sorted(r.doc_id for r in nj.keep_one_of_each(docs, size=3, percent=90).collect()) == [3, 7, 8]
    assert nj.keep_one_of_each(docs).columns == docs.columns
    assert nj.similar_documents(docs.limit(0)).count() == 0
