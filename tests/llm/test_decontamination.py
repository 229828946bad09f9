import random
import time

import edges
import pytest

from shelfmark.llm import decontamination as dc


def brute(docs, items, window):
    out = []
    for doc_id, text in docs:
        words, hit, found = dc.words_of(text), set(), set()
        for item, other in items:
            w = dc.words_of(other)
            size = min(window, len(w))
            grams = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if size else set()
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in grams:
                    hit.update(range(i, i + size))
                    found.add(str(item))
        out.append((doc_id, len(words), len(hit), sorted(found)))
    return sorted(out)


@pytest.mark.parametrize("block_words", [10**6, 40])
def test_against_all_windows(spark, block_words):
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice(["A", "b", "c", "é", "D1"]) for _ in range(n))
    items = [(i, text(rng.randint(1, 9))) for i in range(30)] + [(99, None), (98, ""), (97, "--")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(60)]
    marked = dc.mark_contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=5, block_words=block_words
    )
    got = sorted((r.row.doc_id, r.n_words, sum(s.last - s.first + 1 for s in r.spans), sorted(r["items"])) for r in marked.collect())
    assert got == brute(docs, items, 5)


def test_cut_and_coverage(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame(
        [(1, f"before, {item.upper()}! " + "after " * 20), (2, f"x {item}"), (3, "clean"), (4, None)], "doc_id long, text string"
    )
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: r.text for r in dc.decontaminate(docs, items).collect()}
    assert got == {1: "before, ! " + "after " * 20, 3: "clean", 4: None}


def test_edges(spark):
    docs = edges.documents(spark)
    items = spark.createDataFrame([(1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (1, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (None, "a tie"), (2, None)], "item_id long, text string")
    rows = dc.mark_contamination(docs, items).collect()
    assert len(rows) == docs.count()
    hits = {r.row.doc_id: (len(r.spans), list(r["items"])) for r in rows if r.spans}
    assert hits == {8: (1, []), 9: (1, []), 11: (1, ["1"])}
    cleaned = dc.decontaminate(docs, items)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count() - 3
    assert dc.mark_contamination(docs.limit(0), items).count() == 0
    assert dc.decontaminate(docs, items.limit(0)).count() == docs.count()


def test_items_of_equal_words_take_time_in_proportion():
    words = [b"a"] * 60_000
    started = time.process_time()
    automaton = dc.ItemAutomaton([("long", words), ("short", words[:4]), ("tiny", words[:1])], 10)
    spans, items = automaton.hits(words)
    assert spans == [(0, len(words) - 1)] and items == {"long", "short", "tiny"}
    assert time.process_time() - started < 10
