"""The streaming sink, driven to the end over the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.write import save_collection
from ..sources.catalog import is_directory, scratch
from ..sources.collections import read_collections
from ..streaming.sink import (
    commit_history,
    compact_stream,
    is_committed,
    read_stream_collection,
    read_stream_errors,
    stream_to_collection,
    writer_of,
)
from .registry import query, table


def stream_table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table as a file stream, whether it is one file or a folder."""
    path = f"{sf}/{name}.parquet"
    reader = spark.readStream.schema(table(spark, sf, name).schema)
    if is_directory(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def _drain(sdf: DataFrame, label: str, mode: str = "append", **options) -> str:
    path = scratch(sdf.sparkSession, label)
    stream_to_collection(sdf, path, f"{path}-checkpoint", mode, **options).awaitTermination()
    return path


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_append(spark, sf):
    return read_stream_collection(spark, _drain(stream_table(spark, sf, "events"), "append"))


@query("""
    SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id,
           arg_max(value, event_id) FILTER (WHERE event_type = 'purchase') AS paid
    FROM events GROUP BY 1
""")
def stream_update(spark, sf):
    """Upserts by user: per field the last value given."""
    paid = F.when(F.col("event_type") == "purchase", F.col("value"))
    sdf = stream_table(spark, sf, "events").select("user_id", "event_type", "event_id", paid.alias("paid"))
    path = _drain(sdf, "update", "update", id="user_id", order="event_id")
    return read_stream_collection(spark, path, "user_id", "upsert")


@query("""
    SELECT user_id, event_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1
""")
def stream_index(spark, sf):
    """Whole documents by id, read after the batches were folded into a base."""
    sdf = stream_table(spark, sf, "events").select("user_id", "event_id", "event_type")
    path = _drain(sdf, "index", id="user_id", order="event_id")
    compact_stream(spark, path, "user_id")
    return read_stream_collection(spark, path, "user_id")


@query("SELECT 0::BIGINT AS batch_id, count(*) AS records FROM events")
def stream_commits(spark, sf):
    path = _drain(stream_table(spark, sf, "events"), "commits")
    return commit_history(spark, path).groupBy("batch_id").agg(F.sum("records").alias("records"))


@query("SELECT 'events-' || event_type AS _index, count(*) AS n FROM events GROUP BY 1")
def stream_dynamic(spark, sf):
    sdf = stream_table(spark, sf, "events")
    path = _drain(sdf, "names", index_pattern="events-{event_type}", exclude=["props"])
    return read_stream_collection(spark, path).groupBy("_index").agg(F.count(F.lit(1)).alias("n"))


def _in_batches(df: DataFrame, parts: list, label: str, mode: str = "append", **options) -> str:
    """Streams the rows as one micro-batch per condition, in order, and returns the collection's path."""
    spark = df.sparkSession
    source, path = scratch(spark, "parts"), scratch(spark, label)
    for part in parts:
        df.where(part).write.mode("append").parquet(source)
        sdf = spark.readStream.schema(df.schema).parquet(source)
        stream_to_collection(sdf, path, f"{path}-checkpoint", mode, **options).awaitTermination()
    return path


@query("""
    SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1
""")
def stream_batches(spark, sf):
    """Four micro-batches: the last document of an id wins across batches."""
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    edges = events.select(F.percentile_approx("event_id", F.lit([0.25, 0.5, 0.75]), 1000).alias("q")).first()["q"]
    bounds = [None, *edges, None]
    parts = []
    for low, high in zip(bounds, bounds[1:]):
        above = F.lit(True) if low is None else F.col("event_id") > low
        parts.append(above if high is None else above & (F.col("event_id") <= high))
    path = _in_batches(events, parts, "batches", id="user_id", order="event_id")
    if not is_committed(spark, path, writer_of(f"{path}-checkpoint"), 3):
        raise ValueError("the last batch is not committed")
    compact_stream(spark, path, "user_id")
    return read_stream_collection(spark, path, "user_id")


@query("""
    WITH given AS (SELECT event_id, event_type,
        CASE WHEN event_id % 22 = 11 THEN event_id - 1 WHEN event_id % 50 = 1 THEN NULL ELSE event_id END AS id,
        CASE WHEN event_id % 7 = 3 THEN 'n/a' ELSE CAST(event_id * 2 AS VARCHAR) END AS amount, (event_id // 2) % 3 AS batch_id FROM events),
    named AS (SELECT *, CASE event_type WHEN 'error' THEN NULL WHEN 'purchase' THEN 'Events' ELSE event_type END AS name FROM given),
    fit AS (SELECT * FROM named WHERE name = lower(name) AND id IS NOT NULL AND amount <> 'n/a'),
    twice AS (SELECT name, id FROM fit GROUP BY 1, 2 HAVING count(*) > 1)
    SELECT event_id, 'of-' || name AS _index, CAST(amount AS BIGINT) AS amount, NULL::BIGINT AS batch_id, NULL::VARCHAR AS code FROM fit ANTI JOIN twice USING (name, id)
    UNION ALL SELECT event_id, NULL, NULL, batch_id, 'version_conflict' FROM fit SEMI JOIN twice USING (name, id)
    UNION ALL SELECT event_id, NULL, NULL, batch_id, CASE WHEN name = lower(name) THEN 'mapper_parsing' ELSE 'invalid_index_name' END
    FROM named WHERE name IS NULL OR name <> lower(name) OR id IS NULL OR amount = 'n/a'
""")
def stream_rejects(spark, sf):
    """Three micro-batches with rows that cannot be taken: those are error events, the others documents."""
    even = F.col("event_id") % 22 == 11
    rows = table(spark, sf, "events").select(
        "event_id", "event_type",
        F.when(even, F.col("event_id") - 1).when(F.col("event_id") % 50 != 1, F.col("event_id")).alias("id"),
        F.when(F.col("event_id") % 7 == 3, "n/a").otherwise((F.col("event_id") * 2).cast("string")).alias("amount"),
        F.when(F.col("event_type") == "purchase", "Events").when(F.col("event_type") != "error", F.col("event_type")).alias("name"),
    )
    parts = [F.expr(f"event_id div 2 % 3 = {k}") for k in (0, 1, 2)]
    path = _in_batches(rows, parts, "rejects", id="id", index_pattern="of-{name}", on_error="reject", schema="amount bigint")
    kept = read_stream_collection(spark, path, "id")
    kept = kept.select("event_id", "_index", "amount", F.lit(None).cast("bigint").alias("batch_id"), F.lit(None).cast("string").alias("code"))
    events = read_stream_errors(spark, path).select(
        F.get_json_object("event.raw", "$.event_id").cast("bigint").alias("event_id"), F.lit(None).cast("string").alias("_index"),
        F.lit(None).cast("bigint").alias("amount"), "batch_id", "error.code",
    )
    return kept.unionByName(events)


@query("""
    SELECT 'events-' || event_type AS _index, user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value
    FROM events WHERE event_type <> 'error' GROUP BY 1, 2
""")
def stream_collections(spark, sf):
    """A collection for each name the rows of a stream give, each read by its name; the last document of an id wins."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    # the second batch holds the newest document of every user
    rows = events.join(events.groupBy("user_id", "event_type").agg(F.max("event_id").alias("newest")), ["user_id", "event_type"])
    parts = [F.col("event_id") < F.col("newest"), F.col("event_id") == F.col("newest")]
    path = _in_batches(rows, parts, "collections", id="user_id", order="event_id", index_pattern="events-{event_type}", exclude=["newest"])
    return read_collections(spark, "events-*,-events-error", root=path).select("_index", "user_id", "event_id", "value")


@query("""
    SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) ELSE 'e' || event_id END AS mark,
           CASE WHEN event_id % 2 = 1 THEN user_id END AS user_id
    FROM events
""")
def stream_writers(spark, sf):
    """Two streams that write a field in different types, and not the same fields, into one collection."""
    events = stream_table(spark, sf, "events")
    path = scratch(spark, "writers")
    whole = events.where("event_id % 2 = 0").select("event_id", F.col("event_id").alias("mark"))
    text = events.where("event_id % 2 = 1").select("event_id", F.concat(F.lit("e"), F.col("event_id")).alias("mark"), "user_id")
    for sdf, name in ((whole, "one"), (text, "two")):
        stream_to_collection(sdf, path, f"{path}-{name}").awaitTermination()
    return read_stream_collection(spark, path)


@query("SELECT event_id, event_type FROM events")
def stream_refusals(spark, sf):
    """What a stream must not be written as is refused before it starts; then it is appended."""
    sdf = stream_table(spark, sf, "events").select("event_id", "event_type")
    path = scratch(spark, "refused")
    refused = [
        lambda: stream_to_collection(sdf, path, f"{path}-c", "complete"),
        lambda: stream_to_collection(sdf, path, f"{path}-c", partition_columns=["event_type"]),
        lambda: stream_to_collection(sdf, path, f"{path}-c", "update"),
        lambda: stream_to_collection(table(spark, sf, "events"), path, f"{path}-c"),
        lambda: save_collection(sdf, "events", path),
    ]
    for call in refused:
        try:
            call()
        except ValueError:
            continue
        raise AssertionError("a stream was taken that must be refused")
    return read_stream_collection(spark, _drain(sdf, "taken"))
