import pytest
from conftest import plan, rows
from pyspark.sql import functions as F, types as T

import shelfmark as sm
from shelfmark.sources.catalog import is_named, select_names
from shelfmark.sources.mapping import common_type, resolve_type


@pytest.fixture()
def root(spark, tmp_path):
    spark.createDataFrame([("Buckethead", "album1", "blah")], "artist string, album string, data string").write.parquet(f"{tmp_path}/a1")
    spark.createDataFrame([("Eminem", "album2", 42)], "artist string, album string, data int").write.parquet(f"{tmp_path}/a2")
    spark.createDataFrame([(1, 1.5)], "id long, data double").write.parquet(f"{tmp_path}/b1")
    return str(tmp_path)


def test_several_collections(spark, root):
    out = sm.read_collections(spark, "a1,a2", root=root)
    assert rows(out) == [("Buckethead", "album1", "blah", "a1"), ("Eminem", "album2", "42", "a2")]
    out = sm.read_collections(spark, ["a2", "b1"], root=root).select("_index", "data")
    assert out.schema["data"].dataType == T.StringType() and rows(out) == [("a2", "42"), ("b1", "1.5")]
    only = sm.read_collections(spark, "a1,a2", root=root).where("_index = 'a1'")
    assert plan(only).count("FileScan") <= 1


def test_patterns(spark, root):
    assert select_names(["a1", "a2", "b1"], "a*") == ["a1", "a2"]
    assert select_names(["a1", "a2", "b1"], "_all,-a2") == ["a1", "b1"]
    assert select_names(["a1", "a2", "b1"], "b1,+a1") == ["b1", "a1"]
    assert sm.read_collections(spark, "*,-b*", root=root).count() == 2
    with pytest.raises(FileNotFoundError):
        sm.read_collections(spark, "z*", root=root)


def test_missing(spark, root):
    with pytest.raises(FileNotFoundError):
        sm.read_collection(spark, "zz", root=root)
    empty = sm.read_collection(spark, "zz", root=root, missing_as_empty=True, schema="a int")
    assert empty.count() == 0 and empty.columns == ["a"]
    assert sm.read_collections(spark, "a1,zz", root=root, missing_as_empty=True).count() == 1
    assert sm.is_empty(spark, "zz", root) and not sm.is_empty(spark, "a1", root)


@pytest.mark.parametrize(
    "old,new,expected",
    [
        ("byte", "long", "long"), ("long", "byte", "long"), ("integer", "float", "keyword"), ("long", "double", "keyword"),
        ("half_float", "double", "double"), ("scaled_float", "float", "double"), ("text", "keyword", "keyword"),
        ("text", "string", "keyword"), ("date", "boolean", "keyword"), ("float", "knn_vector", "float"),
    ],
)
def test_type_resolution(old, new, expected):
    assert resolve_type("f", old, new) == expected


def test_type_conflicts():
    for pair in (("object", "keyword"), ("geo_point", "text"), ("nested", "object")):
        with pytest.raises(ValueError, match="conflicting"):
            resolve_type("f", *pair)
    assert common_type("f", T.ArrayType(T.IntegerType()), T.LongType()) == T.ArrayType(T.LongType())


def test_mapping_to_schema():
    mapping = {
        "idx": {
            "mappings": {
                "properties": {
                    "n": {"type": "integer"}, "t": {"type": "text"}, "ts": {"type": "date"}, "hf": {"type": "half_float"},
                    "sf": {"type": "scaled_float"}, "c": {"type": "completion"}, "ip": {"type": "ip"}, "tc": {"type": "token_count"},
                    "o": {"properties": {"type": {"type": "keyword"}, "properties": {"type": "long"}}},
                    "ns": {"type": "nested", "properties": {"x": {"type": "double"}}},
                    "g": {"type": "geo_point"}, "sh": {"type": "geo_shape"}, "odd": {"type": "murmur3"},
                }
            }
        }
    }
    fields = sm.parse_mapping(mapping)
    schema = sm.to_schema(fields, as_array=["n:2"], geo={"g": "lon_lat_array", "sh": "linestring"})
    assert schema.simpleString() == (
        "struct<n:array<array<int>>,t:string,ts:timestamp,hf:float,sf:double,ip:string,tc:bigint,"
        "o:struct<type:string,properties:bigint>,ns:array<struct<x:double>>,g:array<double>,"
        "sh:struct<type:string,coordinates:array<array<double>>>>"
    )
    assert sm.to_schema(fields, rich_dates=False)["ts"].dataType == T.StringType()
    with pytest.raises(ValueError):
        sm.parse_mapping({"settings": 1})


def test_merged_mappings():
    a = sm.parse_mapping({"properties": {"x": {"type": "integer"}, "o": {"properties": {"p": {"type": "float"}}}}})
    b = sm.parse_mapping({"properties": {"x": {"type": "long"}, "o": {"properties": {"p": {"type": "double"}, "q": {"type": "text"}}}, "y": {"type": "date"}}})
    merged = sm.to_schema(sm.merge_mappings([a, b])).simpleString()
    assert merged == "struct<x:bigint,o:struct<p:double,q:string>,y:timestamp>"


def test_user_schema(spark, root):
    out = sm.read_collection(spark, "a2", root=root, schema="data string, extra double")
    assert rows(out) == [("42", None)]


ALIASES = {
    "alias1": [{"collection": "index1", "filter": {"term": {"system": "hadoop"}}, "search_routing": "1,2"}],
    "alias2": [{"collection": "index1", "filter": {"term": {"system": "spark"}}, "search_routing": "2, 3"}],
    "plain": [{"collection": "index1"}],
}


def test_alias_filters(spark, tmp_path):
    data = [(s, u, r) for s in ("hadoop", "spark", "hive") for u in ("ann", "kim") for r in ("1", "3")]
    spark.createDataFrame(data, "system string, user string, _routing string").write.parquet(f"{tmp_path}/index1")

    def read(names, query=None):
        return sm.read_alias(spark, names, ALIASES, query, root=str(tmp_path))

    assert rows(read("alias1").select("system", "_routing")) == [("hadoop", "1")] * 2
    assert read("alias*,-alias2").count() == 2
    assert read("alias1,alias2").select("system").distinct().count() == 2
    assert rows(read("alias1", sm.term("user", "ann")).select("user")) == [("ann",)]
    assert read("alias1,alias2", sm.term("user", "kim")).count() == 4
    assert read("alias1,+index1").count() == read("index1").count() == len(data)
    assert read("plain").count() == len(data)
    assert read("alias1,_all").count() == len(data)
    with pytest.raises(FileNotFoundError):
        read("nope")


def test_named():
    assert not is_named("index1", "_all") and not is_named("index1", "index*,*")
    assert is_named("index1", "a*1,index*") and not is_named("index1", "+index1,-index1")


def test_metadata_and_pairs(spark, root):
    out = sm.read_collection(spark, "a2", root=root, metadata=True, version=True, id="artist")
    assert out.first()["_metadata"] == {"_index": "a2", "_id": "Eminem", "_version": "1"}
    assert "map" not in plan(out.select("album"))
    docs = sm.read_json_docs(sm.read_collection(spark, "a2", root=root), "artist", metadata=True).first()
    assert docs["_id"] == "Eminem" and '"_metadata":{"_id":"Eminem"}' in docs.json
    assert sm.read_pairs(sm.read_collection(spark, "a2", root=root), "artist").first().doc.album == "album2"


def test_view_options(spark, root):
    sm.register_view(spark, "v1", {"resource": f"{root}/a2", "path": "nope", "read_metadata": "true", "mapping_id": "artist"})
    assert spark.sql("SELECT _metadata['_id'] AS i FROM v1").first().i == "Eminem"
    sm.register_view(spark, "v2", path=f"{root}/a1", query='{"term":{"artist":"nobody"}}', read_field_include="artist,album")
    assert spark.table("v2").count() == 0 and spark.table("v2").columns == ["artist", "album"]
    with pytest.raises(ValueError, match="resource"):
        sm.register_view(spark, "v3", {})
    with pytest.raises(ValueError, match="unknown option"):
        sm.register_view(spark, "v3", {"path": f"{root}/a1", "nope": 1})


def test_tables_are_collections(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert sm.read_collection(spark, "three").count() == 3


def test_count_reads_only_what_the_query_needs(spark, root):
    df = sm.read_collection(spark, "a1", root=root)
    assert sm.count_docs(df, sm.term("artist", "Buckethead")).first().n == 1
    assert "ReadSchema: struct<artist:string>" in plan(sm.count_docs(df, sm.term("artist", "x")))


def test_slices(spark):
    sizes = {"hot": 5000, "mid": 900, "small": 3, None: 40}
    df = spark.createDataFrame([(f"{g}-{i}", g) for g, n in sizes.items() for i in range(n)], "_id string, g string")
    out = sm.slice_scan(df, 100, "g")
    assert out.count() == sum(sizes.values())
    per = out.groupBy("g", "_slice", F.spark_partition_id().alias("p")).count().collect()
    assert {(r.g, r["_slice"]) for r in per} == {(g, s) for g, n in sizes.items() for s in range(max(1, n // 100))}
    assert len({r.p for r in per}) == len(per) and max(r["count"] for r in per) < 200


def test_slices_of_many_groups(spark, monkeypatch):
    monkeypatch.setattr(sm.operators.paging, "MAX_GROUPS", 2)
    df = spark.range(1000).selectExpr("cast(id AS string) AS _id", "id % 7 AS g")
    out = sm.slice_scan(df, 50, "g")
    assert out.count() == 1000 and out.select("g", "_slice").distinct().count() == 7 * 2


@pytest.mark.parametrize("n", [2, 1500])
def test_limit_per_partition(spark, n):
    df = spark.createDataFrame([(f"{i:05d}", "hot" if i % 3 else "cold") for i in range(6000)], "_id string, g string")
    got = rows(sm.limit_per_partition(df, n, "g").select("g", "_id"))
    ids = {"hot": [f"{i:05d}" for i in range(6000) if i % 3], "cold": [f"{i:05d}" for i in range(6000) if i % 3 == 0]}
    assert got == sorted((g, i) for g, every in ids.items() for i in every[:n])


def test_pages(spark):
    df = spark.createDataFrame([(f"{i:02d}",) for i in range(25)], "_id string")
    seen, last = [], None
    while page := [r[0] for r in sm.page_after(df, last, 10).collect()]:
        seen += page
        last = page[-1]
    assert seen == [f"{i:02d}" for i in range(25)]
    assert "TakeOrderedAndProject" in plan(sm.page_after(df, "03", 10))


def test_external_table(spark):
    df = spark.createDataFrame([(1, ("x", 2))], "Id int, Place struct<Name:string,Zip:int>")
    out = sm.external_table(df, "ID bigint, town string, zip string, none int", {"TOWN": "place.name", "zip": "place.zip"})
    assert out.schema.simpleString() == "struct<ID:bigint,town:string,zip:string,none:int>"
    assert rows(out) == [(1, "x", "2", None)]
    assert sm.external_table(df, "data string", json_output=True).first().data == '{"Id":1,"Place":{"Name":"x","Zip":2}}'
    with pytest.raises(ValueError):
        sm.external_table(df, "a int, b string", json_output=True)


def test_routing(spark, tmp_path):
    df = spark.createDataFrame([(str(i), f"r{i % 20}") for i in range(100)], "_id string, _routing string")
    sm.place_by_routing(df, 16).write.partitionBy("_bucket").parquet(f"{tmp_path}/c")
    out = sm.read_collection(spark, "c", root=str(tmp_path), routing=["r3", "r4"], buckets=16)
    assert out.count() == 10 and "PartitionFilters: [_bucket" in plan(out).replace("isnotnull(_bucket", "[_bucket")


def test_collections_of_one_schema_are_one_scan(spark, tmp_path):
    root = f"{tmp_path}/r [1]"
    for i in range(40):
        df = spark.range(i, i + 2).withColumn("n", F.lit(i)) if i % 2 else spark.range(i, i + 2).withColumn("s", F.lit(f"v{i}"))
        sm.save_collection(df.coalesce(1), f"c%{i:02d}+x", root)
    spark.range(3).withColumn("n", F.lit(7)).coalesce(1).write.parquet(f"{root}/file.parquet")
    got = sm.read_collections(spark, "*", root=root)
    assert plan(got).count("FileScan") == 2
    want = [(f"c%{i:02d}+x", i + k, i if i % 2 else None, None if i % 2 else f"v{i}") for i in range(40) for k in (0, 1)]
    want += [("file", k, 7, None) for k in range(3)]
    assert rows(got.select("_index", "id", "n", "s")) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    one = got.where(F.col("_index") == "c%07+x")
    assert rows(one.select("id")) == [(7,), (8,)]
    # the filter reaches the list of files: one is read, of 41 in all
    one.collect()
    leaves = one._jdf.queryExecution().executedPlan().collectLeaves()
    assert sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size())) == 1


def test_persisted_rows_are_released(spark, tmp_path):
    root = str(tmp_path)
    sm.save_collection(spark.range(100), "c", root)
    df = sm.read_collection(spark, "c", root=root)
    with sm.persisted(df) as kept:
        assert kept.storageLevel.useDisk and not kept.storageLevel.useMemory
        assert kept.count() == 100 and kept.where("id > 50").count() == 49
    assert not df.storageLevel.useDisk
    with pytest.raises(RuntimeError), sm.persisted(df):
        raise RuntimeError("in the block")
    assert not df.storageLevel.useDisk
