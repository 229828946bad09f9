"""Include / exclude of fields at any depth, and flattening."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.project import flatten, project_fields, project_for_write
from ..sources.catalog import scratch
from ..sources.collections import read_collection
from .registry import query, table


def _nested_items(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.struct("l_orderkey", F.struct("l_linenumber", "l_returnflag").alias("line")).alias("ref"),
        F.array(
            F.struct(F.lit("price").alias("kind"), F.col("l_extendedprice").alias("amount"), F.col("l_tax").alias("rate")),
            F.struct(F.lit("discount").alias("kind"), F.col("l_quantity").alias("amount"), F.col("l_discount").alias("rate")),
        ).alias("items"),
        "l_partkey",
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS price, l_quantity AS quantity,
           'struct<kind:string,amount:double>' AS item_type
    FROM lineitem
""")
def project_nested(spark, sf):
    """Drops one leaf of an array of structs and one of a nested struct."""
    out = project_fields(_nested_items(spark, sf), exclude=["items.rate", "*.l_returnflag"])
    item = out.schema["items"].dataType.elementType.simpleString()
    return out.select(
        "ref.l_orderkey",
        "ref.line.l_linenumber",
        "l_partkey",
        F.col("items")[0]["amount"].alias("price"),
        F.col("items")[1]["amount"].alias("quantity"),
        F.lit(item).alias("item_type"),
    )


@query("SELECT l_orderkey, l_discount AS rate FROM lineitem")
def project_nested_scan(spark, sf):
    """The pruned schema goes to the Parquet reader: unwanted leaves inside the array are not read."""
    root = scratch(spark, "nested")
    _nested_items(spark, sf).write.parquet(f"{root}/items")
    out = read_collection(spark, "items", root=root, include=["ref.l_orderkey", "items.rate"], validate="strict")
    return out.select("ref.l_orderkey", F.col("items")[1]["rate"].alias("rate"))


@query("SELECT p_partkey, p_name, p_size FROM part")
def source_filter(spark, sf):
    return table(spark, sf, "part", source_filter=["p_partkey", "p_name", "p_size"], validate="strict")


@query("SELECT doc_id AS key, lang AS lang, n_chars AS chars FROM documents")
def flatten_nested(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("key"), F.struct("lang", F.struct(F.col("n_chars").alias("chars")).alias("size")).alias("meta")
    )
    return flatten(docs).select("key", F.col("`meta.lang`").alias("lang"), F.col("`meta.size.chars`").alias("chars"))


@query("""
    SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k, 1 AS kept_keys FROM events
""")
def project_write(spark, sf):
    """Map keys count as fields on the way out."""
    tagged = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("secret"), F.col("event_type")))
    events = table(spark, sf, "events").select("event_id", tagged.alias("props"))
    out = project_for_write(events, exclude=["props.secr*"])
    return out.select("event_id", F.col("props")["k"].alias("k"), F.size("props").alias("kept_keys"))
