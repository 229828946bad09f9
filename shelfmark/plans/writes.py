"""Keyed writes, routing, dynamic names, save modes and tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merge as m
from ..operators.write import (
    commit_merge,
    external_table,
    insert_overwrite as insert_into,
    merge_collection,
    save_collection,
    save_many as save_to_many,
    split_index,
    with_index,
    write_dynamic,
    write_target,
)
from ..sources.catalog import scratch
from ..sources.collections import read_collection, read_collections
from .registry import query, table


def _documents(spark, sf):
    return table(spark, sf, "documents", include=["doc_id", "lang", "n_chars"])


def _labels(spark, sf):
    return table(spark, sf, "labels")


def _profiles(spark, sf):
    """User profiles from the event stream, keyed like customers."""
    return table(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("events"), F.max("event_type").alias("c_mktsegment")
    )


def _customers(spark, sf):
    return table(spark, sf, "customer", include=["c_custkey", "c_name", "c_mktsegment"])


_PROFILES = "SELECT user_id AS c_custkey, count(*) AS events, max(event_type) AS c_mktsegment FROM events GROUP BY 1"


@query("""
    SELECT doc_id, lang, n_chars, NULL::INTEGER AS quality, NULL::INTEGER AS toxic FROM documents ANTI JOIN labels USING (doc_id)
    UNION ALL SELECT doc_id, NULL, NULL, quality, toxic FROM labels
""")
def index_replace(spark, sf):
    return m.write_index(_documents(spark, sf), _labels(spark, sf), "doc_id").target


@query("""
    SELECT c_custkey, coalesce(o_orderkey, NULL) AS o_orderkey, o_orderstatus,
           CASE WHEN o_orderkey IS NULL THEN c_mktsegment END AS c_mktsegment
    FROM customer LEFT JOIN (
        SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    ) ON o_custkey = c_custkey
""")
def index_last_wins(spark, sf):
    """Many rows per id in one batch: the newest order replaces the customer document."""
    customers = table(spark, sf, "customer", include=["c_custkey", "c_mktsegment"])
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus", "o_orderdate"
    )
    return m.write_index(customers, orders, "c_custkey", ["o_orderdate", "o_orderkey"]).target.drop("o_orderdate")


@query("""
    SELECT doc_id, quality, toxic, NULL::VARCHAR AS lang, NULL::BIGINT AS n_chars FROM labels
    UNION ALL SELECT doc_id, NULL, NULL, lang, n_chars FROM documents ANTI JOIN labels USING (doc_id)
""")
def create_only(spark, sf):
    return m.write_create(_labels(spark, sf), _documents(spark, sf), "doc_id").target


@query("""
    SELECT o_custkey AS c_custkey, o_orderkey, 409 AS _status, 'version_conflict' AS _error_type FROM orders
    WHERE o_custkey IN (SELECT user_id FROM events)
    UNION ALL
    SELECT o_custkey, o_orderkey, 409, 'version_conflict' FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) > 1
""")
def create_rejects(spark, sf):
    """Rejected: ids already there, and every further row of an id the batch itself creates."""
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    rejected = m.write_create(_profiles(spark, sf), orders, "c_custkey", "o_orderkey").rejected
    return rejected.select("c_custkey", "o_orderkey", "_status", "_error_type")


@query("""
    SELECT doc_id, coalesce(l.quality::BIGINT, n_chars) AS n_chars, lang, toxic FROM documents LEFT JOIN labels l USING (doc_id)
""")
def partial_update(spark, sf):
    changes = _labels(spark, sf).select("doc_id", F.col("quality").cast("bigint").alias("n_chars"), "toxic")
    return m.write_update(_documents(spark, sf), changes, "doc_id").target


@query("""
    SELECT doc_id, 404 AS _status, 'document_missing' AS _error_type FROM documents ANTI JOIN labels USING (doc_id)
""")
def update_rejects(spark, sf):
    rejected = m.write_update(_labels(spark, sf), _documents(spark, sf), "doc_id").rejected
    return rejected.select("doc_id", "_status", "_error_type")


@query("""
    SELECT c_custkey, o_orderkey, paid FROM customer LEFT JOIN (
        SELECT o_custkey AS c_custkey, max(o_orderkey) AS o_orderkey,
               arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS paid
        FROM orders GROUP BY 1) USING (c_custkey)
""")
def update_in_order(spark, sf):
    """Partial documents of one id applied in order: a null leaves the earlier value."""
    changes = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("paid")
    )
    return m.write_update(table(spark, sf, "customer", include=["c_custkey"]), changes, "c_custkey", "o_orderkey").target


@query(f"""
    SELECT c_custkey, events, coalesce(c.c_mktsegment, p.c_mktsegment) AS c_mktsegment, c_name
    FROM ({_PROFILES}) p FULL OUTER JOIN customer c USING (c_custkey)
""")
def upsert(spark, sf):
    return m.write_upsert(_profiles(spark, sf), _customers(spark, sf), "c_custkey").target


@query("""
    SELECT doc_id, coalesce(CAST(quality AS BIGINT), n_chars) AS n_chars, NULL::INTEGER AS toxic,
           CASE WHEN quality IS NOT NULL AND quality <> n_chars THEN 2 ELSE 1 END AS _version
    FROM documents LEFT JOIN labels USING (doc_id)
""")
def upsert_versions(spark, sf):
    """Only documents that really change count their version up."""
    target = _documents(spark, sf).drop("lang").withColumns({"toxic": F.lit(None).cast("int"), "_version": F.lit(1)})
    changes = _labels(spark, sf).select("doc_id", F.col("quality").cast("bigint").alias("n_chars"))
    return m.write_upsert(target, changes, "doc_id", version="_version").target


@query("SELECT doc_id, lang, n_chars FROM documents ANTI JOIN labels USING (doc_id)")
def delete_by_id(spark, sf):
    return m.write_delete(_documents(spark, sf), _labels(spark, sf), "doc_id").target


_SPENT = "SELECT o_custkey, count(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"


@query(f"""
    SELECT c_custkey, c_nationkey + CASE WHEN orders IS NULL THEN 0 ELSE orders * 4 END AS counter
    FROM customer LEFT JOIN ({_SPENT}) ON o_custkey = c_custkey
""")
def script_update(spark, sf):
    target = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("counter"))
    counts = table(spark, sf, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    script = {"counter": "t.counter + params.n * params.factor"}
    return m.write_script(target, counts, "c_custkey", script, "n:orders, factor:<4>").target


@query(f"""
    SELECT c_custkey, coalesce(events, 0) + 4 AS events, p.c_mktsegment FROM customer LEFT JOIN ({_PROFILES}) p USING (c_custkey)
""")
def scripted_upsert(spark, sf):
    """The script also runs for absent documents, over an empty one."""
    script = {"events": "coalesce(t.events, 0) + params.inc"}
    return m.write_script(
        _profiles(spark, sf), _customers(spark, sf), "c_custkey", script, {"inc": "<4>"}, upsert=True, scripted_upsert=True
    ).target


@query(f"""
    SELECT c_custkey, CASE WHEN p.events IS NULL THEN NULL ELSE p.events + 1 END AS events,
           coalesce(p.c_mktsegment, c.c_mktsegment) AS c_mktsegment,
           CASE WHEN p.events IS NULL THEN c.c_name END AS c_name
    FROM customer c LEFT JOIN ({_PROFILES}) p USING (c_custkey)
""")
def script_or_insert(spark, sf):
    """The script for present documents; the source row itself for absent ones."""
    script = {"events": "t.events + 1"}
    return m.write_script(_profiles(spark, sf), _customers(spark, sf), "c_custkey", script, upsert=True).target


_SHIPPED = "SELECT l_orderkey, max(epoch_us(l_shipdate) // 86400000000) AS v FROM lineitem GROUP BY 1"


def _dated_orders(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", F.datediff("o_orderdate", F.lit("1970-01-01")).cast("bigint").alias("v"), "o_orderstatus")


def _shipments(spark, sf):
    days = F.datediff("l_shipdate", F.lit("1970-01-01")).cast("bigint")
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), days.alias("v"))


@query(f"""
    SELECT o_orderkey, CASE WHEN s.v > o.v THEN s.v ELSE o.v END AS v, CASE WHEN s.v > o.v THEN NULL ELSE o_orderstatus END AS o_orderstatus
    FROM (SELECT o_orderkey, epoch_us(o_orderdate) // 86400000000 AS v, o_orderstatus FROM orders) o
    LEFT JOIN ({_SHIPPED}) s ON l_orderkey = o_orderkey
""")
def versioned(spark, sf):
    """External versions: the shipping day wins only over an earlier order day."""
    return m.write_versioned(_dated_orders(spark, sf), _shipments(spark, sf), "o_orderkey", "v").target


@query("""
    SELECT o_orderkey, count(*) AS n FROM (
        SELECT l_orderkey AS o_orderkey, l_shipdate, o_orderdate,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC) AS r
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    WHERE r > 1 OR l_shipdate <= o_orderdate GROUP BY 1
""")
def versioned_rejects(spark, sf):
    rejected = m.write_versioned(_dated_orders(spark, sf), _shipments(spark, sf), "o_orderkey", "v").rejected
    return rejected.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT CAST(c_custkey AS VARCHAR) AS _id, CAST(c_nationkey AS VARCHAR) AS _routing, 'nation' AS _parent, 3 AS _version, c_name
    FROM customer
""")
def write_metadata(spark, sf):
    rows = table(spark, sf, "customer").withColumn("ref", F.struct(F.col("c_nationkey").alias("key")))
    out = m.with_write_meta(rows, id="c_custkey", routing=lambda df: F.col("ref.key"), parent="<nation>", version="<3>")
    return out.select("_id", "_routing", "_parent", "_version", "c_name")


@query("""
    SELECT 'c' || c_custkey AS id, NULL::VARCHAR AS routing FROM customer
    UNION ALL SELECT 'o' || o_orderkey, 'c' || o_custkey FROM orders
""")
def join_routing(spark, sf):
    """A child is routed by its parent; a parent has no routing of its own."""

    def rows(frame, key, parent):
        joiner = F.struct(F.lit("x").alias("name"), parent.cast("string").alias("parent"))
        return frame.select(key.alias("id"), joiner.alias("joiner"))

    orders = rows(table(spark, sf, "orders"), F.concat(F.lit("o"), "o_orderkey"), F.concat(F.lit("c"), "o_custkey"))
    customers = rows(table(spark, sf, "customer"), F.concat(F.lit("c"), "c_custkey"), F.lit(None))
    both = customers.unionByName(orders)
    return both.select("id", m.routing_of(both, join="joiner").alias("routing"))


@query("SELECT lang, 1 AS buckets, count(*) AS docs FROM documents GROUP BY 1")
def placed_by_routing(spark, sf):
    docs = _documents(spark, sf).withColumn("_routing", F.col("lang"))
    placed = m.place_by_routing(docs, 16, "doc_id")
    per = placed.groupBy("lang", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("lang").agg(F.count(F.lit(1)).cast("int").alias("buckets"), F.sum("n").alias("docs"))


@query("""
    SELECT 'events-' || event_type || '-' || strftime(ts, '%Y.%m') AS _index, count(*) AS n, min(event_id) AS first_id
    FROM events GROUP BY 1
""")
def dynamic_index(spark, sf):
    root = scratch(spark, "dynamic")
    write_dynamic(table(spark, sf, "events"), "events-{event_type}-{ts|YYYY.MM}", root)
    rows = spark.read.parquet(root)
    return rows.groupBy("_index").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"))


@query("SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def json_write(spark, sf):
    """Documents given as JSON text; the id is a path into the text."""
    target = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("_id"))
    text = F.to_json(F.struct(F.struct("doc_id").alias("meta"), F.struct("quality", "toxic").alias("label")))
    docs = _labels(spark, sf).select(F.encode(text, "utf-8").alias("data"))
    mapping = {"properties": {"label": {"properties": {"quality": {"type": "integer"}, "toxic": {"type": "integer"}}}}}
    out = m.write_json_docs(target, docs, "data", "meta.doc_id", mapping).target
    return out.select(F.col("_id").cast("bigint").alias("doc_id"), "label.quality", "label.toxic")


@query("""
    SELECT doc_id, coalesce(nullif(CAST(quality AS BIGINT), 0), n_chars) AS kept,
           CASE WHEN quality IS NULL THEN n_chars ELSE nullif(CAST(quality AS BIGINT), 0) END AS overwritten
    FROM documents LEFT JOIN labels USING (doc_id)
""")
def null_overwrite(spark, sf):
    docs = _documents(spark, sf).select("doc_id", "n_chars")
    changes = _labels(spark, sf).select("doc_id", F.expr("nullif(cast(quality AS bigint), 0)").alias("n_chars"))
    kept = m.write_upsert(docs, changes, "doc_id").target.withColumnRenamed("n_chars", "kept")
    overwritten = m.write_upsert(docs, changes, "doc_id", write_null=True).target.withColumnRenamed("n_chars", "overwritten")
    return kept.join(overwritten, "doc_id")


@query("""
    SELECT 'append' AS mode, 2 * count(*) AS n, 5 AS columns FROM customer
    UNION ALL SELECT 'ignore', 2 * count(*), 5 FROM customer
    UNION ALL SELECT 'overwrite', count(*), 9 FROM supplier
""")
def save_modes(spark, sf):
    """What a collection holds after each mode; an overwrite keeps the fields it already knew."""
    root = scratch(spark, "modes")
    customer, supplier = table(spark, sf, "customer"), table(spark, sf, "supplier")

    def state(mode):
        rows = read_collection(spark, "people", root=root)
        return rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(mode).alias("mode"), "n", F.lit(len(rows.columns)).alias("columns"))

    save_collection(customer, "people", root, "error")
    save_collection(customer, "people", root, "append")
    states = [state("append")]
    save_collection(supplier, "people", root, "ignore")
    states.append(state("ignore"))
    save_collection(supplier, "people", root, "overwrite")
    states.append(state("overwrite"))
    return states[0].unionByName(states[1]).unionByName(states[2])


@query("SELECT event_id, event_type FROM events WHERE NOT (event_type = 'error' OR value < 20)")
def delete_matching(spark, sf):
    events = table(spark, sf, "events", include=["event_id", "event_type", "value"])
    gone = {"bool": {"should": [{"term": {"event_type": "error"}}, {"range": {"value": {"lt": 20}}}]}}
    return m.delete_by_query(events, gone).select("event_id", "event_type")


@query("SELECT 'people-new' AS _index, c_custkey, c_name FROM customer")
def alias_write(spark, sf):
    aliases = {"people": [{"collection": "people-old"}, {"collection": "people-new", "is_write_index": True}]}
    root = scratch(spark, "alias")
    save_collection(table(spark, sf, "customer"), "people", root, aliases=aliases)
    return read_collections(spark, [write_target("people", aliases)], root=root).select("_index", "c_custkey", "c_name")


@query("""
    SELECT o_orderkey, 400 AS _status, 'invalid_index_name' AS _error_type FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
    UNION ALL SELECT o_orderkey, 400, 'invalid_index_name' FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority <> '4-NOT SPECIFIED'
""")
def invalid_names(spark, sf):
    """Names made from data: blanks and upper case are illegal, a null part has no name."""
    key = F.when(F.col("o_orderstatus") == "P", None).when(
        F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lower("o_orderpriority")
    ).otherwise(F.lower(F.col("o_orderstatus")))
    rows = table(spark, sf, "orders").withColumn("key", key)
    return split_index(rows, "orders-{key}")[1].select("o_orderkey", "_status", "_error_type")


@query("SELECT 'a' AS _index, c_custkey FROM customer UNION ALL SELECT 'b', c_custkey FROM customer")
def save_many(spark, sf):
    root = scratch(spark, "many")
    save_to_many(table(spark, sf, "customer"), [lambda df, n=n: save_collection(df, n, root) for n in ("a", "b")])
    return read_collections(spark, "a,b", root=root).select("_index", "c_custkey")


@query("SELECT c_custkey AS id, c_name AS title, CAST(c_nationkey AS BIGINT) AS region FROM customer")
def insert_overwrite(spark, sf):
    """A query into a declared table whose columns live under nested document fields, twice."""
    root = scratch(spark, "insert")
    columns, aliases = "id bigint, title string, region bigint", {"title": "place.name", "region": "place.region"}
    for _ in range(2):
        insert_into(table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey"), "t", root, columns, aliases)
    return external_table(read_collection(spark, "t", root=root), columns, aliases)


@query("SELECT doc_id, lang FROM documents ANTI JOIN labels USING (doc_id)")
def saved_merge(spark, sf):
    """A keyed write saved as the collection's next version."""
    root = scratch(spark, "merge")
    save_collection(_documents(spark, sf), "docs", root)
    result = m.write_delete(read_collection(spark, "docs", root=root), _labels(spark, sf), "doc_id")
    commit_merge(result, "docs", root)
    return read_collection(spark, "docs", root=root, include=["doc_id", "lang"])


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment END AS c_mktsegment FROM customer")
def appended_fields(spark, sf):
    """Three writes, of which the second alone brings a new field: it stays, whichever file is read first."""
    root = scratch(spark, "fields")
    customers = _customers(spark, sf)
    for part in range(3):
        rows = customers.where(F.col("c_custkey") % 3 == part)
        save_collection(rows if part == 1 else rows.drop("c_mktsegment"), "customers", root)
    return read_collection(spark, "customers", root=root)


@query("SELECT doc_id, lang FROM documents ANTI JOIN labels USING (doc_id)")
def bucket_appends(spark, sf):
    """A collection placed by routing keeps its layout through a plain append and a merge."""
    root = scratch(spark, "buckets")
    docs = m.place_by_routing(_documents(spark, sf).withColumn("_routing", F.col("lang")), 4, "doc_id")
    save_collection(docs.where("doc_id % 2 = 0"), "docs", root, partition_by=["_bucket"])
    save_collection(docs.where("doc_id % 2 = 1"), "docs", root)
    result = m.write_delete(read_collection(spark, "docs", root=root), _labels(spark, sf), "doc_id")
    commit_merge(result, "docs", root)
    return read_collection(spark, "docs", root=root, include=["doc_id", "lang"])


@query(f"""
    SELECT o_orderkey, CASE WHEN s.v > o.v THEN s.v ELSE o.v END AS v
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN epoch_us(o_orderdate) // 86400000000 END AS v FROM orders) o
    LEFT JOIN ({_SHIPPED}) s ON l_orderkey = o_orderkey
    WHERE o.v IS NOT NULL OR s.v IS NULL
    UNION ALL
    SELECT o_orderkey, s.v FROM orders JOIN ({_SHIPPED}) s ON l_orderkey = o_orderkey WHERE o_orderkey % 5 = 0
""")
def null_versions(spark, sf):
    """Rows without a version are rejected and hide no other; a stored document without one takes any."""
    orders = _dated_orders(spark, sf).select("o_orderkey", F.when(F.col("o_orderkey") % 5 > 0, F.col("v")).alias("v"))
    shipped = _shipments(spark, sf)
    unversioned = shipped.select("o_orderkey", F.lit(None).cast("bigint").alias("v"))
    return m.write_versioned(orders, shipped.unionByName(unversioned), "o_orderkey", "v").target


@query("SELECT user_id::VARCHAR AS _id, max(event_id) AS n FROM events GROUP BY 1")
def json_number_order(spark, sf):
    """JSON documents of one id, in the order of a number: 10 comes after 9."""
    events = table(spark, sf, "events").select(F.to_json(F.struct(F.col("user_id").cast("string").alias("user"), F.col("event_id").alias("n"))).alias("text"))
    mapping = {"properties": {"user": {"type": "keyword"}, "n": {"type": "long"}}}
    empty = spark.createDataFrame([], "_id string, user string, n long")
    return m.write_json_docs(empty, events, "text", id="user", mapping=mapping, order="n").target.select("_id", "n")


@query("SELECT 'events-' || strftime(ts, '%H') || ':00' AS _index, event_id FROM events")
def timed_names(spark, sf):
    """Names with a colon, written by field values and read back by name."""
    root = scratch(spark, "timed")
    write_dynamic(table(spark, sf, "events").select("event_id", "ts"), "events-{ts|HH}:00", root)
    return read_collections(spark, "events-*", root=root).select("_index", "event_id")


@query("""
    SELECT doc_id, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE doc_id % 3 > 0
    UNION ALL SELECT doc_id, NULL, NULL, quality, toxic FROM labels ANTI JOIN documents USING (doc_id)
""")
def bucket_merges(spark, sf):
    """Three merges into a collection of 16 buckets: an upsert that brings fields, a delete, and one that takes nothing."""
    root = scratch(spark, "dealt")
    docs = _documents(spark, sf)
    save_collection(docs, "docs", root, id="doc_id", buckets=16)
    merge_collection(spark, "docs", root, m.write_upsert, _labels(spark, sf), "doc_id")
    merge_collection(spark, "docs", root, m.write_delete, docs.where("doc_id % 3 = 0").select("doc_id"), "doc_id")
    merge_collection(spark, "docs", root, m.write_delete, docs.where("false").select("doc_id"), "doc_id")
    return read_collection(spark, "docs", root=root)


@query("""
    WITH sent AS (SELECT doc_id, strlen(CAST(json_object('doc_id', doc_id, 'lang', lang) AS VARCHAR)) AS size, doc_id IN (SELECT doc_id FROM labels) AS taken FROM documents)
    SELECT count(*) AS docs_sent, CAST(sum(size) AS BIGINT) AS bytes_sent, count(*) FILTER (WHERE taken) AS docs_rejected,
        CAST(coalesce(sum(size) FILTER (WHERE taken), 0) AS BIGINT) AS bytes_rejected, count(*) FILTER (WHERE NOT taken) AS docs_accepted,
        CAST(coalesce(sum(size) FILTER (WHERE NOT taken), 0) AS BIGINT) AS bytes_accepted FROM sent
""")
def merge_report(spark, sf):
    """Statistics of a write that the write itself counted."""
    root = scratch(spark, "report")
    save_collection(_labels(spark, sf), "labels", root, id="doc_id", buckets=4)
    sent = table(spark, sf, "documents", include=["doc_id", "lang"])
    return merge_collection(spark, "labels", root, m.write_create, sent, "doc_id").stats()


@query("""
    SELECT o_orderkey, CAST(o_orderkey % 7 * power(2, coalesce(k, 0)) + coalesce(added, 0) AS BIGINT) AS counter, coalesce(k, 0) AS runs
    FROM orders LEFT JOIN (
        SELECT l_orderkey, count(*) AS k, sum(l_partkey * power(2, k - r)) AS added FROM (
            SELECT l_orderkey, l_partkey, row_number() OVER w AS r, count(*) OVER (PARTITION BY l_orderkey) AS k
            FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey))
        GROUP BY 1) ON l_orderkey = o_orderkey
""")
def scripts_in_order(spark, sf):
    """Several scripts of one document: each runs over what the one before it left."""
    orders = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 7).alias("counter"), F.lit(0).cast("bigint").alias("runs"))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_linenumber")
    script = {"counter": "t.counter * 2 + params.part", "runs": "t.runs + 1"}
    return m.write_script(orders, lines, "o_orderkey", script, "part:l_partkey", order=["l_linenumber", "l_partkey"]).target


@query("""
    WITH given AS (SELECT user_id, event_id, event_id * 37 % 101 AS v FROM events),
    judged AS (SELECT *, max(v) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
        CASE WHEN user_id % 2 = 0 THEN user_id % 90 END AS stored FROM given),
    ruled AS (SELECT *, v > coalesce(greatest(before, stored), -1) AS ok FROM judged)
    SELECT user_id, event_id, v, false AS rejected FROM ruled WHERE ok QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
    UNION ALL SELECT user_id, event_id, v, true FROM ruled WHERE NOT ok
    UNION ALL SELECT DISTINCT user_id, NULL, stored, false FROM ruled WHERE stored IS NOT NULL AND user_id NOT IN (SELECT user_id FROM ruled WHERE ok)
""")
def versions_in_order(spark, sf):
    """Versions of one document in the order given: each is judged by the highest one before it."""
    given = table(spark, sf, "events").select("user_id", "event_id", (F.col("event_id") * 37 % 101).alias("v"))
    stored = given.where("user_id % 2 = 0").select("user_id", F.lit(None).cast("bigint").alias("event_id"), (F.col("user_id") % 90).alias("v"))
    result = m.write_versioned(stored.distinct(), given, "user_id", "v", order="event_id")
    kept = result.target.select("user_id", "event_id", "v", F.lit(False).alias("rejected"))
    return kept.unionByName(result.rejected.select("user_id", "event_id", "v", F.lit(True).alias("rejected")))


@query("SELECT doc_id, quality FROM labels")
def known_collections_only(spark, sf):
    """Without automatic creation only a collection that is there takes rows."""
    root = scratch(spark, "known")
    labels = _labels(spark, sf).select("doc_id", "quality")
    save_collection(labels.where("doc_id % 2 = 0"), "labels", root)
    save_collection(labels.where("doc_id % 2 = 1"), "labels", root, auto_create=False)
    try:
        save_collection(labels, "label", root, auto_create=False)
    except FileNotFoundError:
        return read_collections(spark, "label*", root=root, index_column=None)
    raise AssertionError("a collection was made")


@query("SELECT 'of-' || upper(lang[1:1]) || lang[2:] AS name, count(*) AS n FROM documents GROUP BY 1")
def own_name_format(spark, sf):
    """Names by a formatter of the caller."""
    named = with_index(table(spark, sf, "documents").select("doc_id", "lang"), "of-{lang|title}", lambda c, form: F.initcap(c) if form == "title" else c)
    return named.groupBy(F.col("_index").alias("name")).agg(F.count(F.lit(1)).alias("n"))
