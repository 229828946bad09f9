import datetime
import random
import zlib
from collections import Counter, defaultdict

import edges
import pytest
from conftest import plan

from shelfmark.llm import kd_sharding as kd


def brute_shards(rows, n, shards):
    """The tree over listed rows: nodes are sorted along their widest dimension and cut where the bytes are nearest."""
    rows = [{**r, "values": [r[f"value{i}"] or 0 for i in range(n)]} for r in rows]

    def split(node, lo, hi):
        if hi - lo < 2 or not node:
            return {r["key"]: lo for r in node}
        widths = [max(r["values"][d] for r in node) - min(r["values"][d] for r in node) for d in range(n)]
        d = widths.index(max(widths))
        place = lambda r: (r["values"][d] << 48) + r["tie"]
        total, k = sum(r["size"] for r in node), hi - lo
        want, before = total * (k // 2) // k, 0
        by_place = defaultdict(int)
        for r in node:
            by_place[place(r) >> 3] += r["size"]
        for at, size in sorted(by_place.items()):
            if before + size >= want:
                cut = at + (abs(before + size - want) < abs(before - want))
                break
            before += size
        left = [r for r in node if place(r) >> 3 < cut]
        right = [r for r in node if place(r) >> 3 >= cut]
        return split(left, lo, lo + k // 2) | split(right, lo + k // 2, hi)

    return split(rows, 0, shards)


def some_docs(spark, seed, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "a copy of a third of all" if i % 3 == 0 else "b", "é" * rng.randint(0, 300), "x" * int(rng.paretovariate(0.9))])
        rows.append((i, text, rng.choice(["en", "en", "en", "de", None]), f"s{rng.randrange(30)}", rng.choice([None, -5, rng.randrange(10**6)])))
    rows += rows[:40] + [rows[0]] * 80
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_against_a_tree_over_listed_rows(spark, shards, monkeypatch):
    docs = some_docs(spark, shards)
    dims = ["lang", "source", "n_chars"]
    held = kd.written(kd.document_places(docs, dims), "test-places")
    monkeypatch.setattr(kd, "document_places", lambda *a, **k: held)
    kept = {}
    monkeypatch.setattr(kd, "with_slots", lambda rows, s, c: kept.setdefault("rows", rows).withColumn("slot", kd.F.lit(0)))
    kd.kd_shards(docs, dims, shards=shards, tolerance=0)
    got = {r.key: r.shard for r in kept["rows"].collect()}
    assert got == brute_shards([r.asDict() for r in held.collect()], 3, shards)


def test_shards_are_near_equal_and_slots_gapless(spark):
    docs = some_docs(spark, 9, 3000)
    rows = kd.kd_shards(docs, ["lang", "source", "n_chars"], shards=16).collect()
    size, slots = Counter(), defaultdict(list)
    for r in rows:
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.id, r["size"], r.text_crc32) for r in rows) == want
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean, largest = sum(size.values()) / 16, max(r["size"] for r in rows)
    assert all(abs(size[k] - mean) <= largest + 0.01 * mean for k in range(16))


def test_one_text_everywhere_is_cut_apart(spark):
    docs = spark.range(4000).selectExpr("id % 7 AS doc_id", "'the same text' AS text", "'en' AS lang")
    rows = kd.kd_shards(docs, ["lang"], shards=10).collect()
    counts = Counter(r.shard for r in rows)
    assert len(rows) == 4000 and max(counts.values()) - min(counts.values()) <= 2 and len(counts) == 10


def test_slots_do_not_depend_on_the_pieces(spark, monkeypatch):
    rows = kd.written(kd.document_places(some_docs(spark, 3), ["lang"]).withColumn("shard", kd.F.col("key") % 3), "test-slots")
    got = []
    for slot_rows in (10**9, 5):
        monkeypatch.setattr(kd, "SLOT_ROWS", slot_rows)
        got.append(sorted((r.key, r.slot) for r in kd.with_slots(rows, 3, 720).collect()))
    assert got[0] == got[1]


def test_target_bytes_and_kinds_of_dimensions(spark):
    t = datetime.datetime(2024, 1, 1)
    rows = [(i, "x" * 84, t + datetime.timedelta(days=i), (t + datetime.timedelta(days=i)).date(), float("nan") if i % 5 == 0 else i / 7, i % 2 == 0) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at timestamp, day date, share double, flag boolean")
    for dims in (["at"], ["day"], ["share"], ["flag"], ["at", "day", "share", "flag"]):
        got = kd.kd_shards(docs, dims, target_bytes=1000).collect()
        counts = Counter(r.shard for r in got)
        assert len(counts) == 10 and set(counts.values()) == {10}
    by_day = kd.kd_shards(docs, ["day"], target_bytes=1000).collect()
    assert {r.id: r.shard for r in by_day} == {i: i // 10 for i in range(100)}
    for bad in ({}, {"shards": 0}, {"shards": 2, "target_bytes": 3}):
        with pytest.raises(ValueError, match="one of shards"):
            kd.kd_shards(docs, ["day"], **bad)


def test_edges(spark):
    docs = edges.documents(spark)
    got = kd.kd_shards(docs, ["row", "ids", "c"], shards=3)
    assert "Python" not in plan(got) and "Arrow" not in plan(got)
    rows = got.collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16) for r in docs.collect())
    assert Counter((r.id, r["size"]) for r in rows) == want
    assert kd.kd_shards(docs.limit(0), ["row", "c"], shards=3).count() == 0
    few = kd.kd_shards(docs.limit(2), ["row"], shards=40).collect()
    assert len(few) == 2 and all(0 <= r.shard < 40 and r.slot >= 0 for r in few)
