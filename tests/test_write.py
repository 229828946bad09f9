import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

import shelfmark as sm
from shelfmark.operators.write import index_name, valid_name
from shelfmark.sources.catalog import current_version, locate_collection


def frame(spark, n=2):
    return spark.createDataFrame([(i, f"n{i}") for i in range(n)], "id int, name string")


def test_save_modes(spark, tmp_path):
    root = str(tmp_path)
    df = frame(spark)
    sm.save_collection(df, "c", root, "error")
    with pytest.raises(FileExistsError):
        sm.save_collection(df, "c", root, "error")
    sm.save_collection(df, "c", root, "ignore")
    assert sm.read_collection(spark, "c", root=root).count() == 2
    sm.save_collection(df, "c", root, "append")
    assert sm.read_collection(spark, "c", root=root).count() == 4
    before = sm.read_collection(spark, "c", root=root)
    sm.save_collection(before.where("id = 0").select("id"), "c", root, "overwrite")  # reads what it replaces
    after = sm.read_collection(spark, "c", root=root)
    assert rows(after) == [(0, None), (0, None)] and before.count() == 4
    sm.save_collection(after.where("false"), "c", root, "overwrite")
    sm.save_collection(df, "c", root, "error")  # it has no rows, so it does not "exist"
    assert sm.read_collection(spark, "c", root=root).count() == 2


def test_append_takes_the_collections_types(spark, tmp_path):
    sm.save_collection(frame(spark), "c", str(tmp_path))
    sm.save_collection(spark.createDataFrame([("7", "x", 1.5)], "id string, name string, extra double"), "c", str(tmp_path))
    assert (7, "x") in rows(sm.read_collection(spark, "c", root=str(tmp_path)).select("id", "name"))


def test_versions_expire(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(4):
        sm.save_collection(frame(spark), "c", root, "overwrite")
    assert current_version(spark, f"{root}/c") == 4
    assert sm.expire_versions(spark, "c", root, keep=1) == ["v=000001", "v=000002", "v=000003"]
    assert sm.read_collection(spark, "c", root=root).count() == 2


def test_unfinished_versions_are_not_read(spark, tmp_path):
    root = str(tmp_path)
    sm.save_collection(frame(spark), "c", root)
    (tmp_path / "c" / "v=000002").mkdir()
    (tmp_path / "d" / "v=000001").mkdir(parents=True)
    assert locate_collection(spark, "c", root).endswith("v=000001")
    assert locate_collection(spark, "d", root) is None
    assert sm.save_collection(frame(spark), "c", root, "overwrite").endswith("v=000003")


def test_auto_create_and_streams_refused(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sm.save_collection(frame(spark), "c", str(tmp_path), auto_create=False)
    stream = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="streaming"):
        sm.save_collection(stream, "c", str(tmp_path))


GOOD = ["abc", "a-b_c.1", "été"]
BAD = ["_a", "+a", "-a", "A", "aB", "a b", 'a"b', "a*b", "a\\b", "a<b", "a|b", "a,b", "a>b", "a/b", "a?b", "É"]


def test_names(spark, tmp_path):
    assert all(sm.is_valid_name(n) for n in GOOD) and not any(sm.is_valid_name(n) for n in BAD)
    df = spark.createDataFrame([(n,) for n in GOOD + BAD], "n string")
    assert [r[0] for r in df.where(valid_name(F.col("n"))).collect()] == GOOD
    with pytest.raises(ValueError, match="illegal"):
        sm.save_collection(frame(spark), "Bad Name", str(tmp_path))


def test_alias_targets(spark, tmp_path):
    one = {"a": [{"collection": "x"}]}
    many = {"a": [{"collection": "x"}, {"collection": "y", "is_write_index": True}]}
    none = {"a": [{"collection": "x"}, {"collection": "y"}]}
    assert sm.write_target("a", one) == "x" and sm.write_target("a", many) == "y"
    for bad in (none, {"a": []}, {}):
        with pytest.raises(ValueError):
            sm.write_target("a", bad)
    sm.save_collection(frame(spark), "a", str(tmp_path), aliases=many)
    assert sm.read_collection(spark, "y", root=str(tmp_path)).count() == 2


def test_dynamic_names(spark, tmp_path):
    df = spark.createDataFrame(
        [("x", "2015-12-28T20:03:10Z", 1451332990000, dt.datetime(2015, 12, 28), ("q",))],
        "k string, text string, millis long, ts timestamp, o struct<p:string>",
    )

    def name(pattern, **more):
        return sm.with_index(df, pattern, **more).first()["_index"]

    assert name("logs-{k}") == "logs-x"
    assert name("{o.p}-{ts|yyyy.MM.dd}-end") == "q-2015.12.28-end"
    assert name("a-{text|YYYY-MM-dd}") == name("a-{millis|YYYY-MM-dd}") == "a-2015-12-28"
    assert name("a-{k|up}", formatter=lambda c, form: F.concat(c, F.lit(form))) == "a-xup"
    for bad in ("logs-{}", "logs-{k|}", "logs-{nope}"):
        with pytest.raises(ValueError):
            name(bad)


def test_write_dynamic(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "Big One")], "id int, k string")
    with pytest.raises(Exception, match="no valid collection name"):
        sm.write_dynamic(df, "logs-{k}", f"{tmp_path}/fail")
    rejected = sm.write_dynamic(df, "logs-{k}", f"{tmp_path}/out", on_error="reject")
    assert rows(rejected.select("id", "_error_type")) == [(3, "invalid_index_name"), (4, "invalid_index_name")]
    assert rows(sm.read_collection(spark, "logs-a", root=f"{tmp_path}/out").select("id")) == [(1,)]
    assert sm.read_collections(spark, "logs-*", root=f"{tmp_path}/out").count() == 2


def test_save_many_and_projection(spark, tmp_path):
    paths = sm.save_many(frame(spark), [lambda d, n=n: sm.save_collection(d, n, str(tmp_path), include=["id"]) for n in "ab"])
    assert len(paths) == 2 and sm.read_collection(spark, "b", root=str(tmp_path)).columns == ["id"]


def test_insert_overwrite(spark, tmp_path):
    root = str(tmp_path)
    for overwrite, n in ((True, 2), (False, 4), (True, 2)):
        sm.insert_overwrite(frame(spark), "t", root, "id bigint, title string", {"title": "o.name"}, overwrite)
        out = sm.read_collection(spark, "t", root=root)
        assert out.count() == n and out.schema.simpleString() == "struct<id:bigint,o:struct<name:string>>"
    with pytest.raises(ValueError):
        sm.insert_overwrite(frame(spark), "t", root, "id bigint")


def test_commit_merge(spark, tmp_path):
    root = str(tmp_path)
    sm.save_collection(frame(spark, 5), "c", root)
    result = sm.write_upsert(sm.read_collection(spark, "c", root=root), frame(spark, 7).withColumn("name", F.lit("z")), "id")
    sm.commit_merge(result, "c", root)
    assert sm.read_collection(spark, "c", root=root).where("name = 'z'").count() == 7


def test_appends_agree_on_fields_and_layout(spark, tmp_path):
    root = str(tmp_path)
    one = spark.createDataFrame([(1, 0), (2, 1)], "id int, _bucket int")
    more = spark.createDataFrame([(3, 0, "x")], "id int, _bucket int, extra string")
    sm.save_collection(one, "docs", root, partition_by=["_bucket"])
    sm.save_collection(more, "docs", root)
    sm.save_collection(one.selectExpr("id + 10 AS id", "_bucket"), "docs", root)
    got = sm.read_collection(spark, "docs", root=root).select("id", "_bucket", "extra")
    assert rows(got) == [(1, 0, None), (11, 0, None), (12, 1, None), (2, 1, None), (3, 0, "x")]
    with pytest.raises(ValueError, match="partitioned by"):
        sm.save_collection(one, "docs", root, partition_by=["id"])
    merged = sm.write_delete(sm.read_collection(spark, "docs", root=root), spark.createDataFrame([(3,)], "id int"), "id")
    path = sm.commit_merge(merged, "docs", root)
    assert len(list((tmp_path / path.removeprefix(root + "/")).glob("_bucket=*"))) == 2
    assert sm.read_collection(spark, "docs", root=root).count() == 4


def test_open_brace_in_a_pattern(spark):
    with pytest.raises(ValueError, match="invalid pattern"):
        index_name(spark.range(1), "logs-{id")


def _files(path):
    import glob
    import os

    return {f: os.path.getmtime(f) for f in glob.glob(f"{glob.escape(path)}/_bucket=*/*.parquet")}


def test_a_merge_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    root = f"{tmp_path}/g[1]"
    docs = spark.range(200).selectExpr("id", "id * 2 AS n")
    path = sm.save_collection(docs, "docs", root, id="id", buckets=8)
    before = _files(path)
    assert len({f.split("_bucket=")[1].split("/")[0] for f in before}) == 8
    report = sm.merge_collection(spark, "docs", root, sm.write_delete, spark.createDataFrame([(17,)], "id long"), "id")
    after = _files(path)
    gone = {f.split("_bucket=")[1].split("/")[0] for f in before.keys() - after.keys()}
    assert len(gone) == 1 and len(report.buckets) == 1 and all(after[f] == before[f] for f in before.keys() & after.keys())
    assert sm.read_collection(spark, "docs", root=root).columns == ["id", "n"]
    assert rows(sm.read_collection(spark, "docs", root=root).selectExpr("count(*)", "sum(id)")) == [(199, 19900 - 17)]
    assert rows(report.stats().select("docs_sent", "docs_accepted", "docs_rejected")) == [(1, 1, 0)]
    # a new field, a new id and a changed one; a rejected row stays data
    more = spark.createDataFrame([(5, 1, "x"), (777, 2, "y"), (None, 3, "z")], "id long, n long, s string")
    report = sm.merge_collection(spark, "docs", root, sm.write_upsert, more, "id")
    got = sm.read_collection(spark, "docs", root=root)
    assert rows(got.where("s IS NOT NULL")) == [(5, 1, "x"), (777, 2, "y")] and got.count() == 200
    assert rows(report.rejected.select("s", "_error_type")) == [("z", "mapper_parsing")] and report.counts["docs_rejected"] == 1
    # an append is dealt as well; a bucket that loses its last document goes
    sm.save_collection(spark.createDataFrame([(900, 9)], "id long, n long"), "docs", root)
    sm.merge_collection(spark, "docs", root, sm.write_delete, got.select("id"), "id")
    assert rows(sm.read_collection(spark, "docs", root=root).select("id")) == [(900,)]
    for bad in ({"id": "id", "buckets": 4}, {"partition_by": ["n"]}):
        with pytest.raises(ValueError, match="buckets|partitioned"):
            sm.save_collection(docs, "docs", root, **bad)
    with pytest.raises(ValueError, match="buckets by"):
        sm.merge_collection(spark, "docs", root, sm.write_index, docs, "n")
    with pytest.raises(FileNotFoundError):
        sm.merge_collection(spark, "none", root, sm.write_index, docs, "id")


def test_merges_of_collections_without_buckets(spark, tmp_path):
    root = str(tmp_path)
    sm.save_collection(spark.range(5).selectExpr("id", "id AS n"), "docs", root)
    report = sm.merge_collection(spark, "docs", root, sm.write_index, spark.createDataFrame([(1, 100), (9, 9)], "id long, n long"), "id")
    assert report.buckets is None and report.counts["docs_accepted"] == 2
    assert rows(sm.read_collection(spark, "docs", root=root)) == [(0, 0), (1, 100), (2, 2), (3, 3), (4, 4), (9, 9)]
    result = sm.write_delete(sm.read_collection(spark, "docs", root=root), spark.range(2), "id")
    sm.save_collection(sm.read_collection(spark, "docs", root=root), "dealt", root, id="id", buckets=3)
    sm.commit_merge(result, "dealt", root)
    assert rows(sm.read_collection(spark, "dealt", root=root).select("id")) == [(2,), (3,), (4,), (9,)]


def test_roots_with_signs_of_patterns(spark, tmp_path):
    root = f"{tmp_path}/g[1]{{a,b}}"
    for _ in range(2):
        sm.save_collection(spark.range(3), "c", root)
    assert sm.read_collection(spark, "c", root=root).count() == 6
    assert rows(sm.read_collections(spark, "*", root=root).groupBy("_index").count()) == [("c", 6)]


def test_names_of_dynamic_collections_stay_text(spark, tmp_path):
    df = spark.createDataFrame([("007", 1), ("2024", 2)], "name string, n int")
    sm.write_dynamic(df, "{name}", f"{tmp_path}/r")
    assert rows(sm.read_collection(spark, f"{tmp_path}/r").select("_index", "n")) == [("007", 1), ("2024", 2)]
