import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

import shelfmark as sm
from shelfmark.operators.project import is_kept, numbered

KEPT = [
    ("foo.bar", [], [], True),
    ("foo.bar", ["bar"], [], False),
    ("fo", ["foo.bar.baz"], [], False),
    ("foo", ["foo.bar.baz"], [], True),
    ("foo.ba", ["foo.bar.baz"], [], False),
    ("foo.bar", ["foo.bar.baz"], [], True),
    ("foo.bar.ba", ["foo.bar.baz"], [], False),
    ("foo.bar.baz", ["foo.bar.baz"], [], True),
    ("foo.bar.baz.qux", ["foo.bar.baz"], [], False),
    ("foo.bar", ["foo"], [], False),
    ("foo.bar", ["foo.*"], [], True),
    ("foo.bar", ["*.bar"], [], True),
    ("foo.bar.taz", ["foo.*ar.taz"], [], True),
    ("foo.bar.taz", ["foo.br*.taz"], [], False),
    ("foo.bar", [], ["foo"], True),
    ("foo.bar", [], ["foo.bar"], False),
    ("foo.bar", [], ["foo*"], False),
    ("foo.bar", [], ["*.bar"], False),
    ("foo.bar.taz", [], ["foo.*.taz"], False),
    ("foo.bar", ["foo", "foo.bar"], ["foo.bar"], False),
    ("foo.bar.taz", ["foo.bar.*"], ["foo.*.taz"], False),
    ("foo.bar", ["foo.bar"], ["foo.*"], False),
    ("nested.what", ["nested.bar"], [], False),
]


@pytest.mark.parametrize("path,include,exclude,kept", KEPT)
def test_field_filter(path, include, exclude, kept):
    assert is_kept(path, include, exclude) is kept


def test_numbered_filters():
    assert numbered(["a", "b:4"]) == [("a", 1), ("b", 4)]
    with pytest.raises(ValueError):
        numbered(["a:broken"])


@pytest.fixture(scope="module")
def hashtags(spark):
    return spark.createDataFrame(
        [(1, ([("hello", "2"), ("world", "1")], "x")), (2, None), (3, (None, "y"))],
        "id int, features struct<hashtags:array<struct<text:string,count:string>>,other:string>",
    )


def test_nested_projection(hashtags):
    assert sm.project_fields(hashtags, include=["features.hashtags.*"]).schema == sm.project_fields(
        hashtags, exclude=["id", "features.other"]
    ).schema
    out = sm.project_fields(hashtags, include=["id", "features.hashtags.text"])
    assert out.schema.simpleString() == "struct<id:int,features:struct<hashtags:array<struct<text:string>>>>"
    assert rows(out) == [(1, (([("hello",), ("world",)]),)), (2, None), (3, (None,))]
    with pytest.raises(ValueError):  # a parent without its leaves keeps nothing
        sm.project_fields(hashtags, include=["features.hashtags"])


def test_scan_reads_only_wanted_leaves(spark, hashtags, tmp_path):
    hashtags.write.parquet(f"{tmp_path}/h")
    out = sm.read_collection(spark, "h", root=str(tmp_path), include=["features.hashtags.text"])
    assert "ReadSchema: struct<features:struct<hashtags:array<struct<text:string>>>>" in plan(out)
    assert rows(out) == rows(sm.project_fields(hashtags, include=["features.hashtags.text"]))
    query = sm.term("features.hashtags.count", "1")
    out = sm.read_collection(spark, "h", query, root=str(tmp_path), include=["features.hashtags.text"])
    assert out.count() == 1 and out.schema.simpleString().count("count") == 0


def test_validation(hashtags, caplog):
    with pytest.raises(ValueError, match="nope"):
        sm.project_fields(hashtags, include=["id", "nope"], validate="strict")
    assert sm.project_fields(hashtags, include=["id", "nope"], validate="warn").columns == ["id"]
    assert "nope" in caplog.text
    assert sm.validate_fields(hashtags.schema, ["_id", "id", "features.other", "features"]) == []


def test_flatten(hashtags):
    assert sm.flatten_schema(hashtags.schema) == {
        "id": "int",
        "features.hashtags.text": "string",
        "features.hashtags.count": "string",
        "features.other": "string",
    }
    assert sm.flatten(hashtags).where("id = 1").first()["features.hashtags.text"] == ["hello", "world"]


def test_write_projection_filters_map_keys(spark):
    df = spark.sql("SELECT 1 AS id, map('a', 1, 'b.c', 2, 'secret', 3) AS m")
    assert sm.project_for_write(df, exclude=["m.s*"]).first().m == {"a": 1, "b.c": 2}
    assert sm.project_for_write(df, include=["m", "m.a"]).first().asDict() == {"m": {"a": 1}}


def test_source_filter_conflict(spark, hashtags, tmp_path):
    hashtags.write.parquet(f"{tmp_path}/h")
    assert sm.read_collection(spark, "h", root=str(tmp_path), source_filter=["id"]).columns == ["id"]
    with pytest.raises(ValueError):
        sm.read_collection(spark, "h", root=str(tmp_path), source_filter=["id"], include=["id"])


def test_struct_leaf_projection_is_pruned_by_catalyst(spark, tmp_path):
    spark.range(3).select(F.struct("id", F.lit("x").alias("big")).alias("s")).write.parquet(f"{tmp_path}/s")
    out = sm.project_fields(spark.read.parquet(f"{tmp_path}/s"), include=["s.id"])
    assert "ReadSchema: struct<s:struct<id:bigint>>" in plan(out)
