"""Keyed writes against a plain Python simulation, and the reference cases."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

import shelfmark as sm
from shelfmark.operators import batch, merge

COLUMNS = "id string, seq int, a int, b string, s struct<x:int,y:int>"


def make(rnd, n, ids, seqs=True):
    out = []
    for i in range(n):
        # one id holds about a third of the rows
        key = "hot" if rnd.random() < 0.33 else f"k{rnd.randint(0, ids)}"
        s = None if rnd.random() < 0.3 else (rnd.choice([None, 1, 2]), rnd.choice([None, 3, 4]))
        out.append((key, i if seqs else 0, rnd.choice([None, 1, 2, 3]), rnd.choice([None, "x", "y"]), s))
    return out


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(5)
    target, seen = [], set()
    for r in make(rnd, 60, 40):
        if r[0] not in seen:
            seen.add(r[0])
            target.append(r)
    source = make(rnd, 400, 60)
    return target, source, spark.createDataFrame(target, COLUMNS).cache(), spark.createDataFrame(source, COLUMNS).repartition(5).cache()


def plain(df):
    def clean(v):
        return tuple(v) if isinstance(v, tuple) else v

    return sorted(tuple(clean(v) for v in r) for r in df.select("id", "seq", F.to_json("s").alias("s"), F.to_json(F.struct("a", "b")).alias("ab")).collect())


def frame(spark, rows_):
    return spark.createDataFrame(rows_, COLUMNS)


def merge_docs(old, new):
    s = new[4] if old[4] is None else old[4] if new[4] is None else tuple(n if n is not None else o for o, n in zip(old[4], new[4]))
    return (old[0], *(n if n is not None else o for o, n in zip(old[1:4], new[1:4])), s)


def test_index(spark, data):
    target, source, t, s = data
    docs = {r[0]: r for r in target}
    docs.update({r[0]: r for r in sorted(source, key=lambda r: r[1])})
    result = sm.write_index(t, s, "id", "seq")
    assert plain(result.target) == plain(frame(spark, list(docs.values()))) and result.rejected.count() == 0


def test_create(spark, data):
    target, source, t, s = data
    docs, bad = {r[0]: r for r in target}, []
    for r in sorted(source, key=lambda r: r[1]):
        if r[0] in docs:
            bad.append(r)
        else:
            docs[r[0]] = r
    result = sm.write_create(t, s, "id", "seq")
    assert plain(result.target) == plain(frame(spark, list(docs.values())))
    assert plain(result.rejected) == plain(frame(spark, bad))
    assert result.rejected.select("_status", "_error_type").distinct().collect() == [(409, "version_conflict")]


@pytest.mark.parametrize("small", [True, False])
def test_upsert_and_update(spark, data, monkeypatch, small):
    monkeypatch.setattr(merge, "is_small", lambda df: small)
    target, source, t, s = data
    docs, bad = {r[0]: r for r in target}, []
    up = dict(docs)
    for r in sorted(source, key=lambda r: r[1]):
        up[r[0]] = merge_docs(up[r[0]], r) if r[0] in up else r
        if r[0] in docs:
            docs[r[0]] = merge_docs(docs[r[0]], r)
        else:
            bad.append(r)
    assert plain(sm.write_upsert(t, s, "id", "seq").target) == plain(frame(spark, list(up.values())))
    result = sm.write_update(t, s, "id", "seq")
    assert plain(result.target) == plain(frame(spark, list(docs.values())))
    assert plain(result.rejected) == plain(frame(spark, bad))


def test_hot_ids_take_the_broadcast_way(spark, data, monkeypatch):
    monkeypatch.setattr(batch, "HOT_ROWS", 20)
    target, source, t, s = data
    known = {r[0] for r in target}
    got = batch.absent_rows(s, sm.operators.merge.present_ids(t, s, "id"), "id")
    assert plain(got) == plain(frame(spark, [r for r in source if r[0] not in known]))
    no_hot = t.where("id <> 'hot'")
    got = batch.absent_rows(s, sm.operators.merge.present_ids(no_hot, s, "id"), "id")
    assert plain(got) == plain(frame(spark, [r for r in source if r[0] not in known - {"hot"}]))


def test_delete(spark, data):
    target, source, t, s = data
    gone = {r[0] for r in source}
    assert plain(sm.write_delete(t, s, "id").target) == plain(frame(spark, [r for r in target if r[0] not in gone]))
    for bad in ({"id": None}, {"id": "id", "json_input": True}, {"id": "id", "include": ["a"]}):
        with pytest.raises(ValueError):
            sm.write_delete(t, s, **bad)


def test_identical_copies_keep_one(spark):
    t = spark.createDataFrame([("z", 0)], "id string, n int")
    s = spark.createDataFrame([("a", 1)] * 50 + [("z", 1)] * 3, "id string, n int")
    result = sm.write_create(t, s, "id", "n")
    assert rows(result.target) == [("a", 1), ("z", 0)]
    assert result.rejected.groupBy("id").count().orderBy("id").collect() == [("a", 49), ("z", 3)]


def test_duplicates_need_an_order(spark, data):
    _, _, t, s = data
    with pytest.raises(Exception, match="several documents with id"):
        sm.write_upsert(t, s, "id").target.collect()


def test_operations_need_an_id(spark, data):
    _, _, t, s = data
    for write in (sm.write_update, sm.write_upsert, sm.write_create):
        with pytest.raises(ValueError, match="requires an id"):
            write(t, s, None)
    assert sm.write_index(t, s).target.count() == t.count() + s.count()


def test_upsert_bumps_version_only_on_change(spark):
    t = spark.createDataFrame([(1, "Spark", 1), (2, "Hadoop", 1), (3, "YARN", 1)], "id int, name string, _version int")
    s = spark.createDataFrame([(1, "Spark"), (2, "Hadoop2"), (3, "YARN"), (4, "Hive")], "id int, name string")
    out = sm.write_upsert(t, s, "id", version="_version").target
    assert rows(out.select("id", "name", "_version")) == [(1, "Spark", 1), (2, "Hadoop2", 2), (3, "YARN", 1), (4, "Hive", 1)]


def test_write_null(spark):
    t = spark.createDataFrame([("1", "a", (1, 2)), ("2", "b", (3, 4))], "id string, v string, s struct<x:int,y:int>")
    s = spark.createDataFrame([("1", None, (None, 5)), ("2", "c", None)], "id string, v string, s struct<x:int,y:int>")
    assert rows(sm.write_update(t, s, "id").target) == [("1", "a", (1, 5)), ("2", "c", (3, 4))]
    assert rows(sm.write_update(t, s, "id", write_null=True).target) == [("1", None, (None, 5)), ("2", "c", None)]


def test_new_fields_are_added(spark):
    t = spark.createDataFrame([("1", ("x",))], "id string, o struct<a:string>")
    s = spark.createDataFrame([("1", ("y",), 7), ("2", ("z",), 8)], "id string, o struct<b:string>, n int")
    out = sm.write_upsert(t, s, "id").target
    assert rows(out.select("id", "o.a", "o.b", "n")) == [("1", "x", "y", 7), ("2", None, "z", 8)]


def test_scripted_upsert_counts(spark):
    source = spark.createDataFrame([("1", 3)], "id string, count int")
    target = spark.createDataFrame([], "id string, counter int")
    script = {"counter": "CASE WHEN t.counter IS NULL THEN params.count ELSE t.counter + params.count END"}
    for expected in (4, 8):
        target = sm.write_script(target, source, "id", script, "count: <4>", upsert=True, scripted_upsert=True).target
        assert rows(target) == [("1", expected)]


def test_nested_upserts(spark):
    ddl = "id string, samples array<struct<text:string>>"
    target = spark.createDataFrame([], ddl)
    script = {"samples": "params.new_samples"}
    rounds = [
        [("2", [("hello",), ("world",)]), ("1", [])],
        [("1", [("goodbye",), ("world",)])],
        [("2", [("goodbye",), ("again",)])],
    ]
    for batch_rows in rounds:
        source = spark.createDataFrame(batch_rows, ddl)
        target = sm.write_script(target, source, "id", script, "new_samples: samples", upsert=True).target
    assert rows(target) == [("1", [("goodbye",), ("world",)]), ("2", [("goodbye",), ("again",)])]


def test_script_rejects_missing_and_bad_params(spark):
    t = spark.createDataFrame([("1", 1)], "id string, n int")
    s = spark.createDataFrame([("1", 2), ("9", 2)], "id string, k int")
    result = sm.write_script(t, s, "id", {"n": F.col("t.n") * F.col("params.k")}, {"k": "k"})
    assert rows(result.target) == [("1", 2)] and result.rejected.select("id", "_status").collect() == [("9", 404)]
    with pytest.raises(ValueError):
        sm.write_script(t, s, "id", {"n": "1"}, {"k": "nope"})


VERSION_CASES = {
    "external": ({"a": 5, "b": 2, "c": 9}, {("a", 3), ("b", 2), ("a", 1)}),
    "external_gte": ({"a": 5, "b": 2, "c": 9}, {("a", 3), ("a", 1)}),
    "internal": ({"a": 4, "b": 3}, {("a", 5), ("a", 3), ("a", 1), ("c", 9)}),
}


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("mode", VERSION_CASES)
def test_versions(spark, mode, small, monkeypatch):
    monkeypatch.setattr(merge, "is_small", lambda df: small)
    t = spark.createDataFrame([("a", 4), ("b", 2)], "id string, v int")
    s = spark.createDataFrame([("a", 3), ("a", 5), ("a", 1), ("b", 2), ("c", 9)], "id string, v int")
    target, rejected = VERSION_CASES[mode]
    result = sm.write_versioned(t, s, "id", "v", mode)
    assert dict(rows(result.target)) == target
    assert {(r.id, r.v) for r in result.rejected.collect()} == rejected


def test_force_version(spark):
    t = spark.createDataFrame([("a", 4, 0)], "id string, v int, n int")
    s = spark.createDataFrame([("a", 3, 1), ("a", 1, 2)], "id string, v int, n int")
    assert rows(sm.write_versioned(t, s, "id", "v", "force", "n").target) == [("a", 1, 2)]


def test_unfit_values_and_null_ids_are_rejected(spark):
    t = spark.createDataFrame([("1", 1)], "id string, n int")
    s = spark.createDataFrame([("1", "2"), ("2", "x"), (None, "3")], "id string, n string")
    result = sm.write_index(t, s, "id")
    assert rows(result.target) == [("1", 2)]
    assert rows(result.rejected.select("n", "_status", "_error_reason")) == [("3", 400, "no id"), ("x", 400, "failed to parse field [n]")]


def test_json_documents(spark):
    t = spark.createDataFrame([("1", 1, "old")], "_id string, n int, s string")
    docs = ['{"k":{"id":1},"n":5,"at":1}', '{"k":{"id":2},"n":6,"at":1}', '{"k":{"id":2},"n":7,"at":2}']
    s = spark.createDataFrame([(d,) for d in docs], "data string")
    mapping = {"properties": {"n": {"type": "integer"}, "s": {"type": "keyword"}}}
    out = sm.write_json_docs(t, s, "data", "k.id", mapping, order="at").target
    assert rows(out) == [("1", 5, None), ("2", 7, None)]
    with pytest.raises(ValueError):
        sm.write_json_docs(t, s, "data", "k.id", mapping, include=["n"])


def test_write_metadata_and_routing(spark):
    df = spark.createDataFrame([("c1", ("company", None)), ("e1", ("employee", "c1"))], "id string, joiner struct<name:string,parent:string>")
    out = sm.with_write_meta(df, id="id", routing=sm.routing_of(df, join="joiner"), version="<7>", parent=lambda d: d["joiner.parent"])
    assert rows(out.select("_id", "_routing", "_version", "_parent")) == [("c1", None, 7, None), ("e1", "c1", 7, "c1")]
    with pytest.raises(Exception, match="no routing"):
        df.select(sm.routing_of(df, routing="joiner.parent")).collect()
    with pytest.raises(ValueError):
        sm.with_write_meta(df, id="nope")


def test_children_share_their_parents_bucket(spark):
    df = spark.createDataFrame([("c1", None), ("e1", "c1"), ("e2", "c1"), ("c2", None)], "_id string, _routing string")
    got = {r["_id"]: r["_bucket"] for r in sm.place_by_routing(df, 1000).collect()}
    assert got["c1"] == got["e1"] == got["e2"] != got["c2"]


def test_delete_by_query_keeps_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert rows(sm.delete_by_query(df, sm.range("x", gte=2))) == [(1,), (None,)]


def test_stats(spark):
    t = spark.createDataFrame([("1", 1)], "id string, n int")
    s = spark.createDataFrame([("1", 2), ("2", 3)], "id string, n int")
    stats = sm.write_create(t, s, "id").stats().first().asDict()
    assert (stats["docs_sent"], stats["docs_accepted"], stats["docs_rejected"]) == (2, 1, 1)
    assert stats["bytes_sent"] == 2 * len('{"id":"1","n":2}')


def test_target_is_not_shuffled_for_a_small_source(spark, tmp_path):
    from conftest import plan

    spark.range(200000).selectExpr("cast(id AS string) AS id", "id AS n").repartition(4).write.parquet(f"{tmp_path}/t")
    spark.range(10).selectExpr("cast(id AS string) AS id", "id AS n").write.parquet(f"{tmp_path}/s")
    t, s = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")
    out = sm.write_upsert(t, s, "id").target
    assert out.count() == 200000
    out.collect()
    text = plan(out)
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_large_merge_shuffles_each_side_once(spark, tmp_path):
    from conftest import plan

    spark.range(1000).selectExpr("cast(id AS string) AS id", "id AS n").write.parquet(f"{tmp_path}/t")
    t = s = spark.read.parquet(f"{tmp_path}/t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(sm.write_upsert(t, s, "id").target)
        assert text.count("Exchange hashpartitioning") == 2 and "FullOuter" in text
        assert plan(sm.write_upsert(t, s, "id", unique=True).target).count("Exchange hashpartitioning") == 2
        assert plan(sm.write_versioned(t, s, "id", "n").target).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_names_with_dots_and_signs(spark):
    ddl = "id string, `@timestamp` long, `a.b` int"
    t = spark.createDataFrame([("1", 1, 1), ("2", 1, 1)], ddl)
    s = spark.createDataFrame([("1", 2, None), ("3", 2, 5)], ddl)
    assert rows(sm.write_upsert(t, s, "id").target) == [("1", 2, 1), ("2", 1, 1), ("3", 2, 5)]
    assert rows(sm.write_index(t, s, "id", "@timestamp").target) == [("1", 2, None), ("2", 1, 1), ("3", 2, 5)]
    assert rows(sm.write_create(t, s, "id").rejected.select("id", "`a.b`")) == [("1", None)]
    assert sm.write_index(t, s.selectExpr("id", "cast(`a.b` AS string) AS `a.b`")).target.count() == 4


def test_copies_spread_over_salted_groups(spark):
    """A third of all rows are one identical row: everything but one copy is rejected, from many groups."""
    hot = spark.range(0, 3000, 1, 12).selectExpr("'hot' AS id", "1 AS n", "map('k', 1) AS m")
    cold = spark.range(6000).selectExpr("concat('c', id % 2000) AS id", "cast(id AS int) AS n", "map('k', cast(id AS int)) AS m")
    t = spark.createDataFrame([("c7", 0, {"k": 0})], "id string, n int, m map<string,int>")
    s = hot.unionByName(cold)
    result = sm.write_create(t, s, "id", "n")
    assert result.target.count() == 2001
    counts = {r.id: r["count"] for r in result.rejected.groupBy("id").count().collect()}
    assert counts["hot"] == 2999 and counts["c7"] == 3 and all(n == 2 for k, n in counts.items() if k not in ("hot", "c7"))
    assert {r.n for r in result.rejected.where("id = 'c9'").collect()} == {2009, 4009}


@pytest.mark.parametrize("lot", [2, 10_000])
def test_scripts_of_one_id_in_order(spark, lot, monkeypatch):
    monkeypatch.setattr(merge, "SCRIPTS", lot)
    t = spark.createDataFrame([("a", 1, "x", None), ("b", 2, "y", None)], "id string, n bigint, tag string, log string")
    s = spark.createDataFrame([("a", 10, 3), ("a", 20, 1), ("a", 30, 2), ("c", 5, 1), ("c", 7, 2), ("c", 9, 3), (None, 1, 1)], "id string, k bigint, at int")
    script = {"n": "coalesce(t.n, 0) * 2 + params.k", "log": "concat_ws(',', t.log, params.k)"}
    plain = sm.write_script(t, s, "id", script, {"k": "k"}, order="at")
    assert rows(plain.target.select("id", "n", "tag", "log")) == [("a", ((1 * 2 + 20) * 2 + 30) * 2 + 10, "x", "20,30,10"), ("b", 2, "y", None)]
    assert rows(plain.rejected.select("id", "k", "_status")) == [("c", 5, 404), ("c", 7, 404), ("c", 9, 404), (None, 1, 400)]
    scripted = sm.write_script(t, s, "id", script, {"k": "k"}, upsert=True, scripted_upsert=True, order="at")
    assert ("c", 43, None, "5,7,9") in rows(scripted.target.select("id", "n", "tag", "log"))
    first = sm.write_script(t, s.withColumnRenamed("k", "n"), "id", {"n": "t.n * 2 + params.k"}, {"k": "n"}, upsert=True, order="at")
    assert ("c", (5 * 2 + 7) * 2 + 9) in rows(first.target.select("id", "n"))
    with pytest.raises(ValueError, match="SQL text"):
        sm.write_script(t, s, "id", {"n": F.col("params.k")}, {"k": "k"}, order="at")


@pytest.mark.parametrize("small", [True, False])
def test_versions_of_one_id_in_order(spark, small, monkeypatch):
    monkeypatch.setattr(merge, "is_small", lambda df: small)
    t = spark.createDataFrame([("a", 4, 0), ("d", 9, 0)], "id string, v int, at int")
    s = spark.createDataFrame(
        [("a", 3, 1), ("a", 5, 2), ("a", 5, 3), ("b", 3, 1), ("b", 5, 2), ("c", 5, 1), ("c", 3, 2), ("d", 8, 1), ("e", None, 1)], "id string, v int, at int"
    )
    up = sm.write_versioned(t, s, "id", "v", order="at")
    assert rows(up.target) == [("a", 5, 2), ("b", 5, 2), ("c", 5, 1), ("d", 9, 0)]
    assert rows(up.rejected.select("id", "v", "at", "_status")) == [("a", 3, 1, 409), ("a", 5, 3, 409), ("c", 3, 2, 409), ("d", 8, 1, 409), ("e", None, 1, 400)]
    same = sm.write_versioned(t, s, "id", "v", "external_gte", order="at")
    assert ("a", 5, 3) in rows(same.target) and rows(same.rejected.where("v IS NOT NULL").select("id", "v", "at")) == [("a", 3, 1), ("c", 3, 2), ("d", 8, 1)]


def test_json_documents_in_the_order_of_any_number(spark):
    empty = spark.createDataFrame([], "_id string, n double, s string")
    mapping = {"properties": {"n": {"type": "double"}, "s": {"type": "keyword"}}}

    def last(*texts):
        docs = spark.createDataFrame([(f'{{"id": "1", "n": {n}, "s": "{i}"}}',) for i, n in enumerate(texts)], "json string")
        return sm.write_json_docs(empty, docs, "json", id="id", order="n", mapping=mapping, on_error="keep").target.first().s

    assert last("9", "1e30") == "1" and last("1e30", "9") == "0" and last("10", "9") == "0"
    assert last("9007199254740993", "9007199254740992") == "0" and last("-1e300", "-1e299") == "1"
