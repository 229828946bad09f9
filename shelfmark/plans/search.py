"""Search language over the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import predicates as p
from ..operators.search import count_docs, search
from .registry import query, table

WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"
TEXT_WORDS = WORDS.format("text")


@query("SELECT l_orderkey, l_extendedprice, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 30")
def returned_items(spark, sf):
    """Flagship: filters and projection reach the Parquet scan."""
    wanted = p.bool_(filter=[p.term("l_returnflag", "R"), p.range("l_quantity", gt=30)])
    return table(spark, sf, "lineitem", query=wanted, include=["l_orderkey", "l_extendedprice", "l_quantity"])


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def match_all(spark, sf):
    rows = search(table(spark, sf, "lineitem"), p.match_all())
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'")
def term_filter(spark, sf):
    return search(table(spark, sf, "customer"), p.term("c_mktsegment", "BUILDING")).select("c_custkey", "c_name", "c_acctbal")


@query(f"SELECT doc_id, lang FROM documents WHERE list_contains({TEXT_WORDS}, 'and')")
def term_text(spark, sf):
    return search(table(spark, sf, "documents"), p.term("text", "and"), text=["text"]).select("doc_id", "lang")


@query("SELECT page_id, url FROM pages WHERE list_contains(string_split_regex(url, '[/?&#.]'), 'page=2')")
def term_array(spark, sf):
    """A term on an array field matches when any element does."""
    pages = table(spark, sf, "pages").withColumn("parts", F.split("url", "[/?&#.]"))
    return search(pages, p.term("parts", "page=2")).select("page_id", "url")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def terms_filter(spark, sf):
    wanted = p.terms("o_orderpriority", ["1-URGENT", "2-HIGH", "2-HIGH", None])
    return search(table(spark, sf, "orders"), wanted).select("o_orderkey", "o_totalprice")


@query(f"SELECT doc_id, n_chars FROM documents WHERE list_has_any({TEXT_WORDS}, ['the', 'data'])")
def match_text(spark, sf):
    return search(table(spark, sf, "documents"), p.match("text", "The, data!"), text=["text"]).select("doc_id", "n_chars")


@query(f"SELECT doc_id, n_chars FROM documents WHERE list_has_all({TEXT_WORDS}, ['the', 'and'])")
def match_text_and(spark, sf):
    both = p.match("text", "the AND", operator="and")
    return search(table(spark, sf, "documents"), both, text=["text"]).select("doc_id", "n_chars")


@query(f"""
    SELECT d.doc_id, l.quality FROM documents d JOIN labels l USING (doc_id)
    WHERE l.quality = 1 AND list_has_any({WORDS.format("d.text")}, ['of', 'les'])
""")
def match_any_values(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    both = p.match_any("quality", [1, 7]) & p.match_any("text", ["of", "les"])
    return search(rows, both, text=["text"]).select("doc_id", "quality")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1997-07-01' AND l_discount <= 0.02
""")
def range_filter(spark, sf):
    wanted = p.range("l_shipdate", gte="1997-01-01", lt="1997-07-01") & p.range("l_discount", lte=0.02)
    return search(table(spark, sf, "lineitem"), wanted).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )


@query("""
    SELECT CASE WHEN quality IS NULL THEN 'missing' ELSE 'exists' END AS state, count(*) AS n, min(doc_id) AS first_id
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1
""")
def exists_missing(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    parts = [
        search(rows, q).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")).withColumn("state", F.lit(state))
        for state, q in (("missing", p.missing("quality")), ("exists", p.exists("quality")))
    ]
    return parts[0].unionByName(parts[1]).select("state", "n", "first_id")


@query("""
    SELECT p_partkey, p_name FROM part
    WHERE p_name LIKE 'red%' OR p_name LIKE '%ring' OR p_name LIKE '%l b%' OR p_name LIKE 'h%t p%e'
""")
def wildcards(spark, sf):
    wanted = p.bool_(
        should=[
            p.starts_with("p_name", "RED"),
            p.ends_with("p_name", "ring"),
            p.contains("p_name", "l b", strict=True),
            p.wildcard("p_name", "h*t p*e"),
        ]
    )
    return search(table(spark, sf, "part"), wanted, recheck=False).select("p_partkey", "p_name")


@query(f"""
    SELECT doc_id FROM documents
    WHERE len(list_filter({TEXT_WORDS}, lambda w: w LIKE 'wh%th')) > 0 OR len(list_filter({TEXT_WORDS}, lambda w: w LIKE '%sch')) > 0
""")
def wildcard_text(spark, sf):
    wanted = p.wildcard("text", "wh*th") | p.ends_with("text", "SCH")
    return search(table(spark, sf, "documents"), wanted, text=["text"], recheck=False).select("doc_id")


@query("""
    SELECT quality, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id)
    WHERE quality IS NOT DISTINCT FROM NULL OR quality IS NOT DISTINCT FROM 1 GROUP BY 1
""")
def null_safe_eq(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    wanted = p.null_safe_eq("quality", None) | p.null_safe_eq("quality", 1)
    return search(rows, wanted).groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice > 100000
      AND NOT (o_orderpriority = '5-LOW') AND (o_totalprice < 200000 OR o_orderdate >= TIMESTAMP '2000-01-01')
""")
def bool_query(spark, sf):
    wanted = p.bool_(
        must=[p.term("o_orderstatus", "F")],
        filter=[
            p.range("o_totalprice", gt=100000),
            p.bool_(should=[p.range("o_totalprice", lt=200000), p.range("o_orderdate", gte="2000-01-01")]),
        ],
        should=[p.term("o_orderpriority", "1-URGENT")],
        must_not=[p.term("o_orderpriority", "5-LOW")],
    )
    return search(table(spark, sf, "orders"), wanted).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("""
    SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id) WHERE NOT coalesce(toxic = 0, false)
""")
def bool_must_not(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return search(rows, p.bool_(must_not=[p.term("toxic", 0)])).select("doc_id", "quality", "toxic")


@query("SELECT event_id, value FROM events WHERE event_type = 'click' AND value >= 10 AND value < 90.5")
def filtered_query(spark, sf):
    wanted = p.filtered(
        p.constant_score({"term": {"event_type": "click"}}), [p.range("value", gte=10), {"range": {"value": {"lt": 90.5}}}]
    )
    return search(table(spark, sf, "events"), wanted).select("event_id", "value")


@query("""
    SELECT event_id, event_type, value FROM events
    WHERE event_type LIKE '%i%' AND value BETWEEN 5 AND 50 AND NOT (event_type IN ('view', 'error'))
""")
def dsl_json(spark, sf):
    text = """{"query": {"bool": {"must": {"wildcard": {"event_type": "*i*"}},
        "filter": [{"range": {"value": {"gte": 5, "lte": 50}}}],
        "must_not": [{"terms": {"event_type": ["view", "error"]}}]}}}"""
    return search(table(spark, sf, "events"), text).select("event_id", "event_type", "value")


@query("SELECT event_id, event_type FROM events WHERE event_type LIKE 'cl%' OR event_type = 'error'")
def query_string(spark, sf):
    return search(table(spark, sf, "events"), "?q=event_type:cl* event_type:error").select("event_id", "event_type")


@query(f"""
    SELECT conv_id, turn FROM conversations
    WHERE (list_contains({TEXT_WORDS}, 'the') OR role = 'the')
      AND (len(list_filter({TEXT_WORDS}, lambda w: starts_with(w, 'that'))) > 0 OR starts_with(role, 'that'))
""")
def query_string_all_fields(spark, sf):
    rows = table(spark, sf, "conversations")
    return search(rows, "?q=the that*&default_operator=AND&lenient=true", text=["text"]).select("conv_id", "turn")


_PAGE_WORDS = WORDS.format("url")


@query(f"""
    SELECT 'strict' AS mode, count(*) AS n FROM pages WHERE list_contains({_PAGE_WORDS}, 'EN')
    UNION ALL SELECT 'analyzed', count(*) FROM pages WHERE list_contains({_PAGE_WORDS}, 'en')
    UNION ALL SELECT 'rechecked', count(*) FROM pages WHERE list_contains({_PAGE_WORDS}, 'en') AND url = 'EN'
    UNION ALL SELECT 'prefix', count(*) FROM pages
        WHERE len(list_filter({_PAGE_WORDS}, lambda w: starts_with(w, 'https'))) > 0
    UNION ALL SELECT 'prefix_rechecked', count(*) FROM pages
        WHERE len(list_filter({_PAGE_WORDS}, lambda w: starts_with(w, 'https'))) > 0 AND starts_with(url, 'https')
    UNION ALL SELECT 'pushdown_off', count(*) FROM pages WHERE starts_with(url, 'https')
""")
def search_modes(spark, sf):
    """One engine filter in its modes: only the search side, rechecked by Spark, or Spark alone."""
    pages = table(spark, sf, "pages")
    word, prefix = p.equals("url", "EN"), p.starts_with("url", "https")
    runs = {
        "strict": (word, {"strict": True, "recheck": False}),
        "analyzed": (word, {"recheck": False}),
        "rechecked": (word, {}),
        "prefix": (prefix, {"recheck": False}),
        "prefix_rechecked": (prefix, {}),
        "pushdown_off": (prefix, {"pushdown": False}),
    }
    counts = [count_docs(search(pages, q, ["url"], **o)).withColumn("mode", F.lit(m)) for m, (q, o) in runs.items()]
    return reduce(lambda a, b: a.unionByName(b), counts).select("mode", "n")


@query("SELECT count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' AND l_linestatus = 'O'")
def count_matching(spark, sf):
    return count_docs(table(spark, sf, "lineitem"), p.range("l_shipdate", gte="1999-01-01") & p.term("l_linestatus", "O"))


@query("""
    SELECT c_mktsegment, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderpriority = '1-URGENT' AND c_acctbal > 0 GROUP BY 1
""")
def search_join(spark, sf):
    orders = search(table(spark, sf, "orders"), p.term("o_orderpriority", "1-URGENT"))
    customers = search(table(spark, sf, "customer"), p.range("c_acctbal", gt=0))
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
    )


@query("""
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 50
""")
def search_sort_take(spark, sf):
    rows = search(table(spark, sf, "orders"), p.term("o_orderstatus", "O"))
    return rows.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50).select("o_orderkey", "o_totalprice")
