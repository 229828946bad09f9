"""Reading collections: many at once, aliases, routing, JSON, views, slices, pages."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.merge import place_by_routing
from ..operators.paging import limit_per_partition, page_after, slice_scan
from ..operators.write import external_table, save_collection, write_dynamic
from ..sources.catalog import scratch
from ..sources.collections import is_empty, persisted, read_alias, read_collection, read_collections, register_view
from ..functions.predicates import term
from ..sources.json_docs import parse_docs, read_json_docs, read_pairs, with_metadata
from .registry import query, table


@query("""
    SELECT 'customer' AS _index, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
           NULL::BIGINT AS s_suppkey, NULL::VARCHAR AS s_name, NULL::INTEGER AS s_nationkey, NULL::DOUBLE AS s_acctbal
    FROM customer
    UNION ALL
    SELECT 'supplier', NULL, NULL, NULL, NULL, NULL, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
""")
def multi_collection(spark, sf):
    return read_collections(spark, "customer,supplier", root=sf)


@query("""
    SELECT 'labels' AS _index, CAST(CAST(doc_id AS DOUBLE) AS VARCHAR) AS doc_id, CAST(quality AS BIGINT) AS quality FROM labels
    UNION ALL SELECT 'documents', CAST(doc_id AS VARCHAR), NULL FROM documents
""")
def multi_collection_upcast(spark, sf):
    """Whole and fractional numbers have only text in common."""
    mappings = {
        "labels": {"properties": {"doc_id": {"type": "double"}, "quality": {"type": "long"}}},
        "documents": {"properties": {"doc_id": {"type": "long"}}},
    }
    return read_collections(spark, ["labels", "documents"], root=sf, mappings=mappings)


@query("""
    SELECT 'supplier' AS _index, s_suppkey, s_name, NULL::BIGINT AS p_partkey, NULL::VARCHAR AS p_name FROM supplier
    UNION ALL SELECT 'part', NULL, NULL, p_partkey, p_name FROM part
""")
def collection_patterns(spark, sf):
    rows = read_collections(spark, "*er,part,-customer", root=sf)
    return rows.select("_index", "s_suppkey", "s_name", "p_partkey", "p_name")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_totalprice, NULL::VARCHAR AS note FROM orders")
def schema_override(spark, sf):
    return table(spark, sf, "orders", schema="o_orderkey string, o_totalprice double, note string")


@query("SELECT 'orders' AS _index, o_orderkey, o_orderstatus FROM orders")
def missing_as_empty(spark, sf):
    names = ["orders", "no-such-collection"]
    return read_collections(spark, names, root=sf, missing_as_empty=True).select("_index", "o_orderkey", "o_orderstatus")


@query("""
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE (o_orderstatus = 'F' OR o_totalprice > 400000) AND o_orderpriority = '2-HIGH'
""")
def alias_read(spark, sf):
    aliases = {
        "finished": [{"collection": "orders", "filter": {"term": {"o_orderstatus": "F"}}}],
        "large": [{"collection": "orders", "filter": {"range": {"o_totalprice": {"gt": 400000}}}}],
    }
    found = read_alias(spark, "finished,large", aliases, {"term": {"o_orderpriority": "2-HIGH"}}, root=sf)
    return found.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("SELECT doc_id, lang FROM documents WHERE lang IN ('fr', 'de')")
def routing_read(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang").withColumn("_routing", F.col("lang"))
    root = scratch(spark, "routing")
    place_by_routing(docs, 8, "doc_id").write.partitionBy("_bucket").parquet(f"{root}/docs")
    return read_collection(spark, "docs", root=root, routing=["fr", "de"], buckets=8).select("doc_id", "lang")


@query("""
    SELECT event_type, greatest(1, count(*) // 1000) AS slices, count(*) AS docs FROM events GROUP BY 1
""")
def slices(spark, sf):
    cut = slice_scan(table(spark, sf, "events").select("event_id", "event_type"), 1000, "event_type", "event_id")
    return cut.groupBy("event_type", "_slice").agg(F.count(F.lit(1)).alias("n")).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("slices"), F.sum("n").alias("docs")
    )


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS _id,
           CAST(json_object('c_custkey', c_custkey, 'c_name', c_name, 'c_nationkey', c_nationkey,
                            'c_acctbal', c_acctbal, 'c_mktsegment', c_mktsegment) AS VARCHAR) AS json
    FROM customer
""")
def json_docs(spark, sf):
    return read_json_docs(table(spark, sf, "customer"), "c_custkey")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS _id, s_name, s_acctbal FROM supplier")
def doc_pairs(spark, sf):
    return read_pairs(table(spark, sf, "supplier"), "s_suppkey").select("_id", "doc.s_name", "doc.s_acctbal")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def parse_props(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.col("props").alias("json"))
    return parse_docs(rows, "json", {"properties": {"k": {"type": "long"}}})


@query("""
    SELECT event_id, epoch_us(ts) // 1000 AS ts_millis, user_id, event_type, value,
           CAST(json_extract(props, '$.k') AS INTEGER) AS k
    FROM events
""")
def json_round_trip(spark, sf):
    """Rows to JSON documents and back through a mapping with a date and a nested object."""
    events = table(spark, sf, "events").withColumn("props", F.from_json("props", "k int"))
    mapping = {
        "mappings": {
            "properties": {
                "event_id": {"type": "long"},
                "ts": {"type": "date"},
                "user_id": {"type": "long"},
                "event_type": {"type": "keyword"},
                "value": {"type": "double"},
                "props": {"properties": {"k": {"type": "integer"}}},
            }
        }
    }
    docs = parse_docs(read_json_docs(events, "event_id", millis=True), "json", mapping)
    return docs.select("event_id", F.unix_millis("ts").alias("ts_millis"), "user_id", "event_type", "value", "props.k")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k_text FROM events")
def parse_unmapped(spark, sf):
    rows = table(spark, sf, "events").select("event_id", F.col("props").alias("json"))
    docs = parse_docs(rows, "json", {"properties": {"none": {"type": "keyword"}}}, unmapped="keep")
    return docs.select("event_id", F.col("_unmapped")["k"].alias("k_text"))


@query("SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS hit_id, 'part' AS hit_index, '1' AS hit_version FROM part")
def metadata_col(spark, sf):
    rows = with_metadata(table(spark, sf, "part"), "p_partkey", index="part", version=True)
    return rows.select(
        "p_partkey",
        F.col("_metadata")["_id"].alias("hit_id"),
        F.col("_metadata")["_index"].alias("hit_index"),
        F.col("_metadata")["_version"].alias("hit_version"),
    )


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice >= 1000 AND o_totalprice < 300000 GROUP BY 1")
def sql_view(spark, sf):
    view = f"orders_{uuid.uuid4().hex}"
    register_view(spark, view, {"resource": f"{sf}/orders.parquet", "path": "ignored", "double_filtering": "false"})
    return spark.sql(
        f"SELECT o_orderstatus, count(*) AS n FROM {view} WHERE o_totalprice >= 1000 AND o_totalprice < 300000 GROUP BY 1"
    )


@query("SELECT c_custkey AS id, c_name AS title, CAST(c_nationkey AS BIGINT) AS region, NULL::VARCHAR AS note FROM customer")
def external_columns(spark, sf):
    columns = "id bigint, title string, region bigint, note string"
    aliases = {"id": "c_custkey", "TITLE": "C_NAME", "region": "c_nationkey"}
    return external_table(table(spark, sf, "customer"), columns, aliases)


@query("""
    SELECT CAST(json_object('p_partkey', p_partkey, 'p_name', p_name, 'p_brand', p_brand, 'p_type', p_type,
                            'p_size', p_size, 'p_retailprice', p_retailprice) AS VARCHAR) AS data FROM part
""")
def external_json(spark, sf):
    return external_table(table(spark, sf, "part"), "data string", json_output=True)


@query("""
    SELECT o_custkey, o_orderkey FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <= 3
""")
def first_per_group(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return limit_per_partition(rows, 3, "o_custkey", "o_orderkey")


@query("SELECT event_id, event_type FROM events WHERE event_id > 499 ORDER BY event_id LIMIT 100")
def next_page(spark, sf):
    return page_after(table(spark, sf, "events").select("event_id", "event_type"), 499, 100, "event_id")


@query("SELECT 'customer' AS _index, c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")
def several_pruned(spark, sf):
    """Several collections, filtered by a field that is not returned and that only one of them has."""
    return read_collections(spark, "customer,supplier", term("c_mktsegment", "BUILDING"), root=sf, include=["c_custkey"])


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'")
def alias_pruned(spark, sf):
    """An alias whose filter and query test fields that are not returned."""
    aliases = {"finished": [{"collection": "orders", "filter": {"term": {"o_orderstatus": "F"}}}]}
    return read_alias(spark, "finished", aliases, {"term": {"o_orderpriority": "2-HIGH"}}, root=sf, include=["o_orderkey"])


@query("SELECT p_name, 'part' AS _index, p_partkey::VARCHAR AS _id FROM part")
def metadata_pruned(spark, sf):
    """Metadata beside pruned columns, from an id that is not returned."""
    rows = read_collection(spark, "part", root=sf, metadata=True, include=["p_name"], id="p_partkey")
    return rows.select("p_name", F.col("_metadata")["_index"].alias("_index"), F.col("_metadata")["_id"].alias("_id"))


@query("SELECT source AS _index, lang, count(*) AS docs, max(doc_id) AS doc_id FROM documents WHERE source <> 'src0' GROUP BY 1, 2")
def one_scan(spark, sf):
    """A collection per source, all but one of them read as one scan."""
    root = scratch(spark, "sources")
    write_dynamic(table(spark, sf, "documents").select("doc_id", "lang", "source"), "{source}", root)
    rows = read_collections(spark, "src*,-src0", root=root)
    return rows.groupBy("_index", "lang").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("doc_id"))


@query("""
    SELECT source, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars, (SELECT max(n_chars) FROM documents) AS longest FROM documents GROUP BY 1
""")
def kept_on_disk(spark, sf):
    """Rows of a collection that several results are made from, kept on disk meanwhile."""
    path = scratch(spark, "kept")
    with persisted(table(spark, sf, "documents").select("source", "n_chars")) as rows:
        longest = rows.agg(F.max("n_chars")).first()[0]
        sums = rows.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_chars").alias("chars"))
        sums.withColumn("longest", F.lit(longest).cast("bigint")).write.parquet(path)
    return spark.read.parquet(path)


@query("""
    SELECT 'documents' AS name, (SELECT count(*) = 0 FROM documents) AS empty
    UNION ALL SELECT 'drained', true UNION ALL SELECT 'none', true UNION ALL SELECT 'labels', (SELECT count(*) = 0 FROM labels)
""")
def empty_collections(spark, sf):
    """Whether collections have rows: given ones, one that lost its rows, and one that is not there."""
    root = scratch(spark, "drained")
    labels = table(spark, sf, "labels")
    for rows in (labels, labels.where("doc_id IS NULL")):
        save_collection(rows, "drained", root, mode="overwrite")
    found = [(n, is_empty(spark, n, r)) for n, r in (("documents", sf), ("drained", root), ("none", root), ("labels", sf))]
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{n}', {str(e).lower()})" for n, e in found) + " AS t(name, empty)")


@query("SELECT event_id, user_id FROM events")
def strict_fields(spark, sf):
    """Asked for strictly, a field that the collection does not have ends the call; as a warning it is left out."""
    try:
        table(spark, sf, "events", include=["event_id", "nope.deep"], validate="strict")
    except ValueError as refused:
        if "nope.deep" not in str(refused):
            raise
    else:
        raise AssertionError("an unknown field was taken")
    return table(spark, sf, "events", include=["event_id", "user_id", "nope"], validate="warn")


@query("""
    SELECT event_id, '{"user_id":' || user_id || ',"kind":"' || event_type || '"}' AS detail, user_id FROM events
""")
def disabled_object(spark, sf):
    """An object the mapping leaves unread stays JSON text."""
    detail = F.struct("user_id", F.col("event_type").alias("kind"))
    docs = table(spark, sf, "events").select("event_id", F.to_json(F.struct(detail.alias("detail"), "user_id")).alias("json"))
    mapping = {"properties": {"detail": {"type": "object", "enabled": False}, "user_id": {"type": "long"}}}
    return parse_docs(docs, "json", mapping).select("event_id", "detail", "user_id")


@query("SELECT event_id, CAST(epoch_us(ts) // 86400000000 AS BIGINT) AS day, upper(event_type) AS kind FROM events")
def own_decoders(spark, sf):
    """Document types that are decoded by functions of the caller."""
    docs = table(spark, sf, "events").select("event_id", F.to_json(F.struct(F.date_format("ts", "dd/MM/yyyy").alias("day"), F.col("event_type").alias("kind"))).alias("json"))
    mapping = {"properties": {"day": {"type": "date"}, "kind": {"type": "keyword"}}}
    rows = parse_docs(docs, "json", mapping, decoders={"date": lambda c: F.to_date(c, "dd/MM/yyyy"), "keyword": F.upper})
    return rows.select("event_id", F.datediff("day", F.lit("1970-01-01")).cast("bigint").alias("day"), "kind")
