"""Decoding of field values derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import decode as d
from ..functions.documents import extract, field_or_const, first_found, json_paths as paths_of, to_document as as_document
from ..sources.json_docs import parse_docs
from .registry import query, table


@query("""
    SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE event_type END AS kind FROM events
""")
def empty_as_null(spark, sf):
    blanked = F.when(F.col("event_type") == "error", "").when(F.col("event_type") == "view", " \t ").otherwise(F.col("event_type"))
    return d.empty_as_null(table(spark, sf, "events").select("event_id", blanked.alias("kind")), ["kind"])


@query("""
    SELECT event_id, CASE event_type WHEN 'signup' THEN epoch_us(ts) // 1000
        WHEN 'purchase' THEN (epoch_us(ts) // 1000000 - 5400) * 1000
        WHEN 'view' THEN (epoch_us(ts) // 1000000 + 10800) * 1000
        WHEN 'click' THEN (epoch_us(ts) // 86400000000) * 86400000 ELSE NULL END AS millis
    FROM events
""")
def parse_date(spark, sf):
    """Epoch milliseconds, ``+hh:mm``, ``-hhmm`` / ``-hh`` offsets, a bare date and an unreadable text."""
    kind, ts = F.col("event_type"), F.col("ts")
    second = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    epoch = F.unix_millis(d.as_instant(ts, table(spark, sf, "events").schema["ts"].dataType))
    text = (
        F.when(kind == "signup", epoch.cast("string"))
        .when(kind == "purchase", F.concat(second, F.lit("+0130")))
        .when(kind == "view", F.concat(second, F.lit("-03")))
        .when(kind == "click", F.date_format(ts, "yyyy-MM-dd"))
        .otherwise("never")
    )
    return table(spark, sf, "events").select("event_id", F.unix_millis(d.parse_date(text, "UTC")).alias("millis"))


@query("SELECT event_id, epoch_us(ts) AS micros FROM events")
def parse_date_nanos(spark, sf):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("789Z"))
    return table(spark, sf, "events").select("event_id", F.unix_micros(d.parse_date_nanos(text)).alias("micros"))


@query("""
    SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN false WHEN 'PROMO' THEN false WHEN 'STANDARD' THEN false ELSE true END AS flag
    FROM part
""")
def parse_bool(spark, sf):
    text = F.when(F.col("p_type") == "ECONOMY", " Off ").when(F.col("p_type") == "PROMO", "0")
    text = text.when(F.col("p_type") == "STANDARD", "").otherwise(F.lower("p_type"))
    return table(spark, sf, "part").select("p_partkey", d.parse_bool(text).alias("flag"))


@query("""
    SELECT p_partkey, p_size AS whole, p_retailprice AS price, NULL::BIGINT AS word, CAST(p_size AS TINYINT) AS tiny FROM part
""")
def decode_values(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        d.decode(F.col("p_size").cast("string"), "integer").alias("whole"),
        d.decode(F.concat(F.lit(" "), F.col("p_retailprice").cast("string")), "double").alias("price"),
        d.decode(F.col("p_name"), "long").alias("word"),
        d.decode(F.col("p_size").cast("string"), "byte").alias("tiny"),
    )


@query("""
    SELECT doc_id, quality IS NULL AS is_null, quality AS first_value, CASE WHEN quality IS NULL THEN NULL ELSE toxic END AS deep_value
    FROM documents LEFT JOIN labels USING (doc_id)
""")
def as_array(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").select("doc_id", "quality", "toxic")
    out = d.as_array(rows, include=["quality", "toxic:2"])
    return out.select(
        "doc_id",
        F.col("quality").isNull().alias("is_null"),
        F.get("quality", 0).alias("first_value"),
        F.get(F.get("toxic", 0), 0).alias("deep_value"),
    )


@query("SELECT c_custkey, 1 AS items, c_name AS first_name FROM customer")
def as_nested(spark, sf):
    rows = table(spark, sf, "customer").withColumn("nested", d.as_nested(F.struct("c_name", "c_nationkey")))
    return rows.select("c_custkey", F.size("nested").alias("items"), F.col("nested")[0]["c_name"].alias("first_name"))


@query("""
    SELECT 'c' || c_custkey AS id, 'customer' AS name, NULL::VARCHAR AS parent FROM customer
    UNION ALL SELECT 'o' || o_orderkey, 'order', 'c' || o_custkey FROM orders
""")
def normalize_join(spark, sf):
    """Parents give the short form of the join field, children the long one."""
    parents = table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.lit('"customer"').alias("joiner"))
    child = F.to_json(F.struct(F.lit("order").alias("name"), F.concat(F.lit("c"), "o_custkey").alias("parent")))
    children = table(spark, sf, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("id"), child.alias("joiner"))
    rows = parents.unionByName(children).withColumn("j", d.normalize_join(F.col("joiner")))
    return rows.select("id", "j.name", "j.parent")


def _geo_text():
    lat, lon = F.col("c_nationkey").cast("double"), (F.col("c_acctbal") / 100).cast("int").cast("double")
    segment = F.col("c_mktsegment")
    return (
        F.when(segment == "BUILDING", F.to_json(F.array(lon, lat)))
        .when(segment == "MACHINERY", F.concat_ws(", ", lat.cast("string"), lon.cast("string")))
        .when(segment == "HOUSEHOLD", F.to_json(F.struct(lat.alias("lat"), lon.alias("lon"))))
        .when(segment == "FURNITURE", F.lit("drm3btev3e86"))
    )


@query("""
    SELECT c_custkey,
        CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN CAST(c_nationkey AS DOUBLE) END AS lat,
        CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN CAST(CAST(trunc(c_acctbal / 100) AS INTEGER) AS DOUBLE) END AS lon,
        CASE WHEN c_mktsegment = 'FURNITURE' THEN 'drm3btev3e86' END AS geohash,
        CASE c_mktsegment WHEN 'BUILDING' THEN 'lon_lat_array' WHEN 'MACHINERY' THEN 'lat_lon_string'
            WHEN 'HOUSEHOLD' THEN 'lat_lon_object' WHEN 'FURNITURE' THEN 'geohash' END AS format
    FROM customer
""")
def geo_point(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", _geo_text().alias("place"))
    point = d.geo_point(F.col("place"))
    out = rows.select("c_custkey", point.alias("p"), d.geo_point_format(F.col("place")).alias("format"))
    return out.select("c_custkey", "p.lat", "p.lon", "p.geohash", "format")


@query("""
    SELECT p_partkey, 'polygon' AS type, 5 AS points, CAST(p_size AS DOUBLE) AS corner, 'cw' AS orientation FROM part
""")
def geo_shape(spark, sf):
    size = F.col("p_size").cast("double")
    ring = F.array(*(F.array(x, y) for x, y in ((F.lit(0.0), F.lit(0.0)), (size, F.lit(0.0)), (size, size), (F.lit(0.0), size), (F.lit(0.0), F.lit(0.0)))))
    text = F.to_json(F.struct(F.lit("polygon").alias("type"), F.array(ring).alias("coordinates"), F.lit("cw").alias("orientation")))
    rows = table(spark, sf, "part").select("p_partkey", d.geo_shape(text, "polygon").alias("s"))
    outer = F.col("s.coordinates")[0]
    return rows.select("p_partkey", "s.type", F.size(outer).alias("points"), outer[2][1].alias("corner"), "s.orientation")


@query("SELECT vec_id, len(embedding) AS dims, embedding[1] AS first_value, list_max(embedding) AS high FROM embeddings")
def vector_field(spark, sf):
    """Vectors sent as JSON number lists come back as float arrays."""
    text = F.to_json("embedding")
    rows = table(spark, sf, "embeddings").select("vec_id", d.vector(F.from_json(text, "array<double>")).alias("v"))
    return rows.select("vec_id", F.size("v").alias("dims"), F.get("v", 0).alias("first_value"), F.array_max("v").alias("high"))


@query("""
    SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k, event_type AS kind,
           CAST(user_id AS VARCHAR) AS user_text, NULL::VARCHAR AS absent
    FROM events
""")
def json_paths(spark, sf):
    doc = F.to_json(
        F.struct(
            F.from_json("props", "k int").alias("props"),
            F.struct("event_type", F.struct("user_id").alias("who")).alias("meta"),
        )
    )
    k, kind, user, absent = paths_of(F.col("doc"), ["props.k", "meta.event_type", "meta.who.user_id", "meta.none"])
    rows = table(spark, sf, "events").select("event_id", doc.alias("doc"))
    return rows.select("event_id", k.alias("k"), kind.alias("kind"), user.alias("user_text"), absent.alias("absent"))


@query("""
    SELECT doc_id, coalesce(CAST(quality AS VARCHAR), lang, 'none') AS first_value, -5 AS constant, lang AS dotted,
           true AS not_found
    FROM documents LEFT JOIN labels USING (doc_id)
""")
def field_extraction(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    rows = rows.select("doc_id", F.col("quality").cast("string").alias("quality"), F.struct("lang").alias("meta"))
    return rows.select(
        "doc_id",
        first_found(rows, ["no.such", "quality", "meta.lang", "<none>"], on_missing="error").alias("first_value"),
        field_or_const(rows, "<-5>").alias("constant"),
        extract(rows, "meta.lang").alias("dotted"),
        F.lit(repr(extract(rows, "meta.none")) == "NOT_FOUND").alias("not_found"),
    )


_DOC_SQL = """
    SELECT CAST(json_object('doc_id', doc_id, 'lang', lang, 'quality', quality, 'toxic', toxic) AS VARCHAR) AS json
    FROM documents LEFT JOIN labels USING (doc_id) {}
"""


@query(
    _DOC_SQL.format("WHERE quality IS NOT NULL")
    + " UNION ALL SELECT CAST(json_object('doc_id', doc_id, 'lang', lang) AS VARCHAR) FROM documents ANTI JOIN labels USING (doc_id)"
)
def documents_without_nulls(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return as_document(rows.select("doc_id", "lang", "quality", "toxic"))


@query(_DOC_SQL.format(""))
def documents_with_nulls(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return as_document(rows.select("doc_id", "lang", "quality", "toxic"), write_null=True)


@query("""
    SELECT event_id, CASE event_type WHEN 'signup' THEN event_id WHEN 'view' THEN epoch_ms(make_timestamp(1000 + event_id % 9000, 1, 1, 0, 0, 0.0))
        WHEN 'click' THEN 86400000 * (epoch_us(ts) // 86400000000) END AS millis, event_type = 'purchase' AS malformed
    FROM events
""")
def dates_by_token(spark, sf):
    """A JSON number is epoch milliseconds however short, four digits of text are a year, eight are no date."""
    kind = F.col("event_type")
    token = (
        F.when(kind == "signup", F.col("event_id").cast("string"))
        .when(kind == "view", F.concat(F.lit('"'), (1000 + F.col("event_id") % 9000).cast("string"), F.lit('"')))
        .when(kind == "click", F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('"')))
        .when(kind == "purchase", '"20240101"').otherwise("null")
    )
    docs = table(spark, sf, "events").select("event_id", F.concat(F.lit('{"at": '), token, F.lit("}")).alias("json"))
    rows = parse_docs(docs, "json", {"properties": {"at": {"type": "date"}}}, zone="UTC", on_error="keep")
    return rows.select("event_id", F.unix_millis("at").alias("millis"), F.col("_malformed").alias("malformed"))


@query("""
    SELECT event_id, user_id, CAST(event_id AS VARCHAR) AS outer_text, '"' || event_type || '"' AS inner_text,
        '[' || event_id || ',' || user_id || ']' AS listed FROM events
""")
def unmapped_nested(spark, sf):
    """Fields outside the mapping inside mapped objects, and inside arrays of them, by dotted name."""
    user = F.struct("user_id", F.col("event_id").alias("seen"), F.struct(F.col("event_type").alias("kind"), F.lit(1).alias("known")).alias("deep"))
    items = F.array(F.struct(F.col("event_id").alias("of"), F.lit(1).alias("k")), F.struct(F.col("user_id").alias("of"), F.lit(2).alias("k")))
    docs = table(spark, sf, "events").select("event_id", F.to_json(F.struct(user.alias("user"), items.alias("items"))).alias("json"))
    mapping = {"properties": {
        "user": {"properties": {"user_id": {"type": "long"}, "deep": {"properties": {"known": {"type": "long"}}}}},
        "items": {"type": "nested", "properties": {"k": {"type": "long"}}},
    }}
    rows = parse_docs(docs, "json", mapping, unmapped="keep")
    extra = F.col("_unmapped")
    return rows.select(
        "event_id", "user.user_id", extra["user.seen"].alias("outer_text"), extra["user.deep.kind"].alias("inner_text"), extra["items.of"].alias("listed")
    )
