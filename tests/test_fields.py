import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

import shelfmark as sm


def one(spark, column, ddl="s string", *values):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return [r[0] for r in df.select(column).collect()]


def test_extended_boolean(spark):
    texts = ["", " ", "false", "FALSE", "0", "off", "no", "No ", "true", "yes", "1", "on", "anything", None]
    got = one(spark, sm.parse_bool(F.col("s")), "s string", *texts)
    assert got == [False] * 8 + [True] * 5 + [None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_dates(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = {
            "2015-12-28T20:03:10Z": 1451332990000,
            "2015-12-28T20:03:10.5+01:00": 1451329390500,
            "2015-12-28T20:03:10+0130": 1451327590000,
            "2015-12-28T20:03:10-03": 1451343790000,
            "2015-12-28T20:03:10": 1451332990000,
            "2015-12-28": 1451260800000,
            "2015-12": 1448928000000,
            "2015": 1420070400000,
            "1451332990000": 1451332990000,
            "12:30": None,
            "soon": None,
            "": None,
        }
        got = one(spark, F.unix_millis(sm.parse_date(F.col("s"), "UTC")), "s string", *texts)
        assert dict(zip(texts, got)) == texts
        nanos = one(spark, F.unix_micros(sm.parse_date_nanos(F.col("s"))), "s string", "2015-12-28T20:03:10.123456789Z", "2015-12-28")
        assert nanos == [1451332990123456, 1451260800000000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_decode_numbers(spark):
    texts = ["12", " 7 ", "", "x", "300", None]
    assert one(spark, sm.decode(F.col("s"), "long"), "s string", *texts) == [12, 7, None, None, 300, None]
    assert one(spark, sm.decode(F.col("s"), "byte"), "s string", *texts) == [12, 7, None, None, None, None]
    assert one(spark, sm.decode(F.col("s"), "double"), "s string", "1.5", "NaN x") == [1.5, None]


def test_empty_as_null(spark):
    df = spark.createDataFrame([("Java", "20000"), ("Python", ""), ("Go", " \t\n"), ("Scala", "3000")], "language string, description string")
    assert [r.description for r in sm.empty_as_null(df).collect()] == ["20000", None, None, "3000"]


MAPPING = {"properties": {"id": {"type": "long"}, "status_code": {"type": "long"}}}


def test_arrays_and_nulls(spark):
    docs = spark.createDataFrame(
        [('{"id":1,"status_code":[123]}',), ('{"id":2,"status_code":[]}',), ('{"id":3,"status_code":null}',), ('{"id":4,"status_code":7}',), ('{"id":5}',)],
        "json string",
    )
    got = rows(sm.parse_docs(docs, "json", MAPPING, as_array=["status_code"]))
    assert got == [(1, [123]), (2, []), (3, None), (4, [7]), (5, None)]
    got = rows(sm.parse_docs(docs, "json", MAPPING, as_array=["status_code:2"]))
    assert got == [(1, [[123]]), (2, [[]]), (3, None), (4, [[7]]), (5, None)]


def test_as_array_on_typed_columns(spark):
    df = spark.createDataFrame([(1, [2]), (None, None)], "a int, b array<int>")
    out = sm.as_array(df, include=["a", "b:2"])
    assert [tuple(r) for r in out.collect()] == [([1], [[2]]), (None, None)]
    assert sm.as_array(df, include=["*"], exclude=["b"]).schema["b"].dataType.simpleString() == "array<int>"


FULL = {
    "mappings": {
        "properties": {
            "l": {"type": "long"},
            "b": {"type": "boolean"},
            "d": {"type": "date"},
            "bin": {"type": "binary"},
            "v": {"type": "knn_vector", "dimension": 2},
            "j": {"type": "join", "relations": {"company": "employee"}},
            "g": {"type": "geo_point"},
            "raw": {"type": "object", "enabled": False},
            "o": {"properties": {"p": {"type": "text"}, "q": {"type": "double"}}},
            "n": {"type": "nested", "properties": {"name": {"type": "keyword"}, "salary": {"type": "long"}}},
            "c": {"type": "completion"},
        }
    }
}


def parse(spark, text, **options):
    df = spark.createDataFrame([(text if isinstance(text, str) else json.dumps(text),)], "json string")
    return sm.parse_docs(df, "json", FULL, **options).first()


def test_parse_values(spark):
    r = parse(
        spark,
        {
            "l": "12", "b": 0, "d": 1451332990000, "bin": "aGk=", "v": [1, 2.5], "j": "company", "g": "41.12,-71.34",
            "raw": {"z": 1, "a": [2]}, "o": {"p": " ", "q": "1.5"}, "n": {"name": "q", "salary": 3}, "other": 1,
        },
        on_error="keep",
    )
    assert (r.l, r.b, r.d) == (12, False, dt.datetime(2015, 12, 28, 20, 3, 10))
    assert (bytes(r.bin), r.v, tuple(r.j)) == (b"hi", [1.0, 2.5], ("company", None))
    assert tuple(r.g) == (41.12, -71.34, None) and json.loads(r.raw) == {"z": 1, "a": [2]}
    assert tuple(r.o) == (None, 1.5) and [tuple(x) for x in r.n] == [("q", 3)] and not r["_malformed"]
    assert "c" not in r.asDict()
    r = parse(spark, {"b": "off", "d": "2015-12-28", "j": {"name": "employee", "parent": "1"}, "n": [], "o": None}, empty_as_null=False)
    assert (r.b, r.d, tuple(r.j), r.n, r.o) == (False, dt.datetime(2015, 12, 28), ("employee", "1"), [], None)
    assert parse(spark, {"o": {"p": ""}}, empty_as_null=False).o.p == ""
    assert parse(spark, {"d": "2015-12-28"}, rich_dates=False).d == "2015-12-28"


@pytest.mark.parametrize("text", ["{bad", "[1]", '"x"', '{"l":"many"}', '{"l":{"a":1}}', '{"o":{"q":"x"}}', '{"n":[{"salary":1},{"salary":"x"}]}', '{"d":"soon"}'])
def test_malformed_documents(spark, text):
    assert parse(spark, text, on_error="skip") is None
    assert parse(spark, text, on_error="keep")["_malformed"]
    assert parse(spark, text, on_error=lambda c: F.lit('{"l": 5}')).l == 5
    with pytest.raises(Exception, match="malformed document"):
        parse(spark, text)


def test_blank_values_are_not_malformed(spark):
    r = parse(spark, {"l": " ", "d": "", "o": {"q": ""}})
    assert (r.l, r.d, tuple(r.o)) == (None, None, (None, None))


def test_unmapped_fields_at_any_depth(spark):
    mapping = {"properties": {"a": {"properties": {"x": {"type": "long"}, "b": {"properties": {"y": {"type": "long"}}}}}, "n": {"type": "nested", "properties": {"k": {"type": "long"}, "o": {"properties": {"p": {"type": "long"}}}}}}}
    doc = {"a": {"x": 1, "u": "t", "b": {"y": 2, "v": [1, 2]}}, "n": [{"k": 1, "w": 3}, {"w": {"z": None}, "o": {"p": 1, "q": 7}}, 5], "top": None}
    df = spark.createDataFrame([(json.dumps(doc),), ('{"a": {"x": 1}}',), ('{"a": 3}',)], "json string")
    got = [r["_unmapped"] for r in sm.parse_docs(df, "json", mapping, unmapped="keep", on_error="keep").collect()]
    assert got[0] == {"a.u": '"t"', "a.b.v": "[1,2]", "n.w": '[3,{"z":null}]', "n.o.q": "[7]", "top": "null"}
    assert got[1:] == [{}, {}]


def test_dates_by_token(spark):
    mapping = {"properties": {"d": {"type": "date"}}}
    texts = ["1234", '"1234"', '"20240101"', "20240101", '"2024-01-01"', "null", "1.5e3", '"0"', "-5"]
    df = spark.createDataFrame([(f'{{"d": {t}}}',) for t in texts], "json string")
    got = sm.parse_docs(df, "json", mapping, on_error="keep").select(F.unix_millis("d").alias("d"), "_malformed").collect()
    year = int((dt.datetime(1234, 1, 1) - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    assert [r.d for r in got] == [1234, year, None, 20240101, 1704067200000, None, 1500, None, -5]
    assert [r["_malformed"] for r in got] == [False, False, True, False, False, False, False, True, False]
    numbers = spark.createDataFrame([(1234, 7.0)], "whole bigint, fraction double")
    assert numbers.select(F.unix_millis(sm.parse_date(F.col("whole"))), F.unix_millis(sm.parse_date(F.col("fraction")))).first() == (1234, 7)


def test_repair_reads_only_malformed_documents_again(spark):
    mapping = {"properties": {"k": {"type": "long"}}}
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": "',), ('{"k": ',)], "json string")
    repair = lambda t: F.when(t.endswith('"'), F.substring(t, 1, 6)).otherwise(F.concat(t, F.lit("2}")))
    twice = sm.parse_docs(df, "json", mapping, on_error=repair, tries=2)
    assert sorted(r.k for r in twice.collect()) == [1, 2, 2]
    text = twice._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("parseJson") == 3 and text.count("THEN static_invoke(VariantExpressionEvalUtils.parseJson") == 2
    with pytest.raises(Exception, match="malformed document"):
        sm.parse_docs(df, "json", mapping, on_error=repair).collect()


def test_unmapped_and_decoders(spark):
    r = parse(spark, {"l": 1, "extra": {"k": 1}}, unmapped="keep")
    assert r["_unmapped"] == {"extra": '{"k":1}'}
    r = parse(spark, {"d": "28/12/2015"}, decoders={"date": lambda c: F.to_date(c, "dd/MM/yyyy")})
    assert r.d == dt.date(2015, 12, 28)


def test_json_as_bytes_and_include(spark):
    df = spark.createDataFrame([(bytearray(b'{"l":1,"o":{"p":"x","q":2}}'),)], "json binary")
    out = sm.parse_docs(df, "json", FULL, include=["o.p"])
    assert out.schema.simpleString() == "struct<o:struct<p:string>>" and out.first().o.p == "x"


def test_geo_points(spark):
    values = ["[-71.34, 41.12]", "[1, 2]", "41.12,-71.34", "drm3btev3e86", '{"lat": 41.12, "lon": -71.34}', "", None]
    df = spark.createDataFrame([(v,) for v in values], "p string")
    point = sm.geo_point(F.col("p"))
    got = [tuple(r[0]) if r[0] else None for r in df.select(point).collect()]
    assert got == [(41.12, -71.34, None), (2.0, 1.0, None), (41.12, -71.34, None), (None, None, "drm3btev3e86"), (41.12, -71.34, None), None, None]
    formats = [r[0] for r in df.select(sm.geo_point_format(F.col("p"))).collect()]
    assert formats == ["lon_lat_array", "lon_lat_array", "lat_lon_string", "geohash", "lat_lon_object", None, None]
    assert sm.detect_geo_point(df.where("p LIKE '41%'"), "p") == "lat_lon_string"
    assert sm.detect_geo_point(df.where("p IS NULL"), "p") is None


SHAPES = {
    "point": [1.0, 2.0],
    "linestring": [[1.0, 2.0], [3.0, 4.0]],
    "polygon": [[[0.0, 0.0], [1.0, 0.0], [0.0, 0.0]]],
    "multipoint": [[1.0, 2.0]],
    "multilinestring": [[[1.0, 2.0], [3.0, 4.0]]],
    "multipolygon": [[[[0.0, 0.0], [1.0, 0.0], [0.0, 0.0]]]],
    "envelope": [[0.0, 1.0], [1.0, 0.0]],
    "circle": [1.0, 2.0],
}


@pytest.mark.parametrize("shape", SHAPES)
def test_geo_shapes(spark, shape):
    doc = {"type": shape, "coordinates": SHAPES[shape], "radius": "5m", "orientation": "cw"}
    df = spark.createDataFrame([(json.dumps(doc),)], "s string")
    value = df.select(sm.geo_shape(F.col("s"), shape)).first()[0]
    assert value.type == shape and value.coordinates == SHAPES[shape]
    assert sm.detect_geo_shape(df, "s") == shape


def test_geometry_collection_refused(spark):
    with pytest.raises(ValueError):
        sm.geo_shape(F.col("s"), "geometrycollection")


def test_join_and_nested(spark):
    texts = ['"company"', "company", '{"name":"employee","parent":"1"}', None]
    got = one(spark, sm.normalize_join(F.col("s")), "s string", *texts)
    assert [tuple(g) if g else None for g in got] == [("company", None), ("company", None), ("employee", "1"), None]
    df = spark.sql("SELECT named_struct('a', 1) AS s UNION ALL SELECT NULL")
    assert rows(df.select(sm.as_nested(F.col("s")))) == [([(1,)],), (None,)]


def test_json_paths(spark):
    doc = '{"age":25,"address":{"state":"NY","zip":{"a":1}},"state":null}'
    df = spark.createDataFrame([(doc,), ("{bad",)], "j string")
    got = df.select(*sm.json_paths(F.col("j"), ["age", "address.state", "nosuch", "address.none"])).collect()
    assert [tuple(r) for r in got] == [("25", "NY", None, None), (None,) * 4]
    overlapping = df.select(*sm.json_paths(F.col("j"), ["address", "address.zip.a"])).first()
    assert json.loads(overlapping[0]) == {"state": "NY", "zip": {"a": 1}} and overlapping[1] == "1"


def test_extraction(spark):
    df = spark.createDataFrame([(1, (None, 2)), (None, (3, 4))], "a int, s struct<x:int,y:int>")
    assert sm.extract(df, "s.none") is sm.NOT_FOUND
    assert [r[0] for r in df.select(sm.extract(df, "s.x")).collect()] == [None, 3]
    constants = ["<4>", "<-5>", "<true>", "<null>", "<text>", '<"7">']
    assert list(df.select(*(sm.field_or_const(df, c) for c in constants)).first()) == [4, -5, True, None, "text", "7"]
    texts = ["1.5", "NaN", "[1]", "007", "", "two words", "{", "-"]
    assert list(df.select(*(sm.field_or_const(df, f"<{t}>").alias(f"c{i}") for i, t in enumerate(texts))).first()) == texts
    assert [r[0] for r in df.select(sm.first_found(df, ["zzz", "a", "s.x"])).collect()] == [1, 3]
    with pytest.raises(Exception, match="found"):
        df.select(sm.first_found(df, ["s.x"], on_missing="error")).collect()


def test_to_document(spark):
    df = spark.sql(
        "SELECT 1 AS id, timestamp'2015-12-28 20:03:10.5Z' AS t, timestamp_ntz'1970-01-01 00:00:01' AS z, date'1970-01-02' AS d, "
        "named_struct('t', timestamp_ntz'1970-01-01', 'n', cast(null AS int)) AS s, array(date'1970-01-03') AS a, "
        "map('k', cast(null AS int)) AS m, binary('hi') AS b, cast(null AS string) AS gone"
    )
    doc = json.loads(sm.to_document(df).first().json)
    assert doc == {"id": 1, "t": 1451332990500, "z": 1000, "d": 86400000, "s": {"t": 0}, "a": [172800000], "m": {"k": None}, "b": "aGk="}
    full = json.loads(sm.to_document(df, write_null=True).first().json)
    assert full["gone"] is None and full["s"]["n"] is None
    with pytest.raises(ValueError, match="decimal"):
        sm.to_document(spark.sql("SELECT cast(1 AS decimal(10,0)) AS decimal"))


def test_detected_geo_formats_feed_the_reader(spark):
    mapping = {
        "properties": {
            "p": {"type": "geo_point"},
            "o": {"properties": {"q": {"type": "geo_point"}, "s": {"type": "geo_shape"}}},
        }
    }
    docs = spark.createDataFrame(
        [('{"p":null}',), ('{"p":[1.5,2.5],"o":{"q":"u1"}}',), ('{"o":{"s":{"type":"Point","coordinates":[1,2]}}}',)], "json string"
    )
    geo = sm.detect_geo(docs, "json", mapping)
    assert geo == {"p": "lon_lat_array", "o.q": "geohash", "o.s": "point"}
    out = sm.parse_docs(docs, "json", mapping, geo=geo).collect()
    assert out[1].p == [1.5, 2.5] and out[1].o.q == "u1" and out[2].o.s.coordinates == [1.0, 2.0]
