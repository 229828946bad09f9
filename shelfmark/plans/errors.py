"""Rejected documents as data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import errors as e
from ..operators import merge as m
from ..operators.write import commit_merge, save_collection
from ..sources.catalog import scratch
from ..sources.collections import read_collection
from ..sources.json_docs import parse_docs
from .registry import query, table


def _conflicts(spark, sf):
    labels = table(spark, sf, "labels")
    return m.write_create(labels, table(spark, sf, "documents", include=["doc_id", "lang"]), "doc_id")


@query("SELECT doc_id, 'version_conflict' AS _error_type FROM labels")
def handler_chain(spark, sf):
    """The first handler takes one language and passes the rest on, the log handler takes the rest."""

    def english_only(rejected):
        return rejected.where("lang = 'en'"), rejected.where("NOT (lang <=> 'en')")

    return e.handle(_conflicts(spark, sf).rejected, [english_only, "log"]).select("doc_id", "_error_type")


@query("""
    SELECT 'version_conflict' AS code, 'error' AS category, 'bulk_failure' AS type, '0.992' AS version,
           CAST(json_object('doc_id', doc_id, 'lang', lang) AS VARCHAR) AS raw, 'nightly' AS job, 'Encountered Bulk Failure' AS message
    FROM labels JOIN documents USING (doc_id)
""")
def dead_letters(spark, sf):
    path = scratch(spark, "letters")
    e.handle(_conflicts(spark, sf).rejected, [e.collect_to(path, labels={"job": "nightly"}, tags=["t1"])])
    letters = spark.read.parquet(path)
    return letters.select(
        "error.code", "event.category", "event.type", "event.version", "event.raw", F.col("labels.job").alias("job"), "message"
    )


_BROKEN = "CASE event_type WHEN 'error' THEN '{\"k\": \"many\"}' WHEN 'view' THEN '{\"k\": ' ELSE props END"


def _broken_props(spark, sf):
    return table(spark, sf, "events").select("event_id", "event_type", F.expr(_BROKEN.replace('\\"', '"')).alias("json"))


_MAPPING = {"properties": {"k": {"type": "long"}}}


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type NOT IN ('error', 'view')")
def malformed_skipped(spark, sf):
    return parse_docs(_broken_props(spark, sf), "json", _MAPPING, on_error="skip").select("event_id", "k")


@query("""
    SELECT event_type, count(*) AS n, CAST(sum(CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 2
        ELSE CAST(json_extract(props, '$.k') AS BIGINT) END) AS BIGINT) AS k FROM events GROUP BY 1
""")
def malformed_repaired(spark, sf):
    """Documents that cannot be read are edited by an expression and read once more."""

    def repair(text):
        return F.when(text.contains("many"), '{"k": 1}').otherwise(F.concat(text, F.lit("2}")))

    rows = parse_docs(_broken_props(spark, sf), "json", _MAPPING, on_error=repair)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"))


@query("""
    SELECT event_type, count(*) AS n, CAST(sum(CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 12
        ELSE CAST(json_extract(props, '$.k') AS BIGINT) END) AS BIGINT) AS k FROM events GROUP BY 1
""")
def repaired_in_rounds(spark, sf):
    """Some documents can be read after a second edit only."""

    def repair(text):
        closed = F.when(text.endswith(" "), F.concat(text, F.lit('"1'))).otherwise(F.concat(F.replace(text, F.lit('"1'), F.lit("12")), F.lit("}")))
        return F.when(text.contains("many"), '{"k": 1}').otherwise(closed)

    rows = parse_docs(_broken_props(spark, sf), "json", _MAPPING, on_error=repair, tries=2)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k"))


@query("""
    SELECT doc_id, quality, lang FROM labels LEFT JOIN (SELECT NULL::BIGINT AS d, NULL::VARCHAR AS lang) ON d = doc_id
    UNION ALL SELECT doc_id, NULL, lang FROM documents ANTI JOIN labels USING (doc_id)
    UNION ALL SELECT -doc_id - 1, NULL, lang FROM documents SEMI JOIN labels USING (doc_id)
""")
def retry_with_new_ids(spark, sf):
    """Conflicting documents get another id and are written again."""
    result = e.retry_rejected(_conflicts(spark, sf), {"doc_id": "-doc_id - 1"})
    return result.target.select("doc_id", "quality", "lang")


@query("""
    SELECT (SELECT count(*) FROM documents) AS docs_sent,
           (SELECT count(*) FROM documents ANTI JOIN labels USING (doc_id)) AS docs_accepted,
           (SELECT count(*) FROM labels) AS docs_rejected, 0::BIGINT AS docs_retried,
           (SELECT CAST(sum(strlen(CAST(json_object('doc_id', doc_id, 'lang', lang) AS VARCHAR))) AS BIGINT) FROM documents) AS bytes_sent,
           (SELECT CAST(sum(strlen(CAST(json_object('doc_id', doc_id, 'lang', lang) AS VARCHAR))) AS BIGINT)
            FROM documents ANTI JOIN labels USING (doc_id)) AS bytes_accepted
""")
def write_stats(spark, sf):
    return _conflicts(spark, sf).stats()


@query("""
    SELECT p_partkey, 400 AS _status, 'mapper_parsing' AS _error_type FROM part
""")
def unfit_values(spark, sf):
    """Values the target's field type cannot hold reject their document."""
    target = table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("p_name"))
    return m.write_index(target, table(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey").rejected.select(
        "p_partkey", "_status", "_error_type"
    )


@query("SELECT doc_id, quality, 'version_conflict' AS _error_type FROM labels")
def abort_on_rejects(spark, sf):
    """Rejected rows that no handler took end the job, and nothing is saved."""
    root = scratch(spark, "abort")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    save_collection(labels, "labels", root)
    result = m.write_create(read_collection(spark, "labels", root=root), table(spark, sf, "documents", include=["doc_id"]), "doc_id")
    try:
        e.handle(result.rejected, ["fail"])
        commit_merge(result, "labels", root)
    except e.RejectedDocuments as stopped:
        kind = str(stopped).split(":")[0]
        return read_collection(spark, "labels", root=root).withColumn("_error_type", F.lit(kind))
    raise AssertionError("rejected rows were taken")
