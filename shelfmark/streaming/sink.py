"""A Structured Streaming sink whose collections survive replays.

Each micro-batch is written to its own folder, named by start time, writer (the query's checkpoint) and
batch number, and becomes visible with its commit record. A batch the writer has already committed is
skipped, an attempt lost before its commit stays invisible, and a batch costs what it brings, never a
rewrite of the collection. Several queries may write to one collection.

With ``index_pattern`` the rows name their collections: the batch is written to one folder per name, all of which become
visible with the one commit, and ``read_collection(name, root=path)`` finds each. With ``on_error="reject"`` rows that
cannot be taken are written as error events beside the batch, under the same commit, and the stream goes on.

Reading a keyed collection folds the batches: per id, the last document (append) or the last value of
each field (update). ``compact_stream`` folds committed batches once and for all.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.fields import columns_of, quote
from ..operators.errors import to_error_events
from ..operators.merge import reject, split_unfit
from ..operators.project import project_for_write
from ..operators.write import checked_index, split_index
from ..sources.catalog import children, drop_path, finished, literal, read_layout, save_layout
from ..sources.mapping import parse_mapping, to_schema
from ..sources.streamed import (
    BATCH,
    INDEX,
    NO_LOG,
    base,
    keyed,
    one_per_document,
    stream_state,
    visible,
    writer_and_number,
)

log = logging.getLogger(__name__)


def stream_to_collection(
    sdf: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    *,
    id: str | None = None,
    operation: str | None = None,
    order=None,
    unique: bool = False,
    index_pattern: str | None = None,
    include=(),
    exclude=(),
    write_null: bool = False,
    partition_columns=(),
    commit_log: bool = True,
    trigger: dict | None = None,
    name: str | None = None,
    on_error: str = "fail",
    schema: T.StructType | str | None = None,
    mapping=None,
    labels: dict | None = None,
    tags=(),
) -> StreamingQuery:
    """Starts writing a stream to the collection at ``path``.

    ``append`` indexes documents (by ``id`` when given), ``update`` upserts them and needs an ``id``.
    ``complete`` mode and partition columns are refused: use ``index_pattern`` to split by field values.
    With ``commit_log=False`` batches are plainly appended and a replay duplicates rows.

    ``schema`` or ``mapping`` declares field types. ``on_error="fail"`` stops the stream at a row without a legal
    collection name, and at an id that repeats within a batch when no ``order`` says which row is last. With
    ``"reject"`` such rows, all rows of such an id, rows without an id and rows with a value that its declared field
    cannot hold become error events (``read_stream_errors``), with ``labels`` and ``tags``."""
    if not sdf.isStreaming:
        raise ValueError("not a streaming frame; use save_collection")
    if partition_columns:
        raise ValueError("partition columns are not supported; use an index pattern instead")
    if mode not in ("append", "update"):
        raise ValueError(f"[{mode}]: the only supported output modes of a collection are append and update")
    if mode == "update":
        if operation not in (None, "upsert"):
            raise ValueError("output mode update is only supported with operation upsert")
        operation = "upsert"
    operation = operation or "index"
    if operation not in ("index", "upsert"):
        raise ValueError(f"operation [{operation}] is not supported by the stream sink")
    if operation == "upsert" and not id:
        raise ValueError("[upsert] finds its documents by a column and so requires an id")
    if on_error not in ("fail", "reject"):
        raise ValueError(f"unknown on_error [{on_error}]")
    if on_error == "reject" and not commit_log:
        raise ValueError("without a commit log a replay would repeat rejected rows")
    if not commit_log:
        log.warning("commit log is off: replayed batches will be written twice")
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if declared is None and mapping is not None:
        declared = to_schema(parse_mapping(mapping))
    writer_id = writer_of(checkpoint) if commit_log else None
    key = {"id": id, "operation": operation, "write_null": write_null} if id else None
    own = {}  # the batch this query wrote last, so that commits are listed only when it starts

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        started_here = own.get("batch_id") == batch_id - 1
        if writer_id and not started_here and is_committed(session, path, writer_id, batch_id):
            return
        out = batch
        if on_error == "reject":
            out = batch.persist()
        try:
            rejected = []
            if on_error == "reject":
                if index_pattern:
                    out, bad = split_index(out, index_pattern)
                    rejected.append(bad)
                if id or declared is not None:
                    fits = declared if declared is not None else T.StructType()
                    out, bad = split_unfit(fits, out, id)
                    rejected.append(bad.drop(INDEX) if index_pattern else bad)
                if id and not unique and order is None:
                    out, bad = _split_repeated(out, id)
                    rejected.append(bad.drop(INDEX) if index_pattern else bad)
            else:
                out = checked_index(out, index_pattern) if index_pattern else out
                out = _declared(out, declared) if declared is not None else out
            if include or exclude:
                keep = [id] if id and include else []
                out = project_for_write(out, [*include, *keep, *([INDEX] if index_pattern and include else [])], exclude)
            if id and not unique:
                out = one_per_document(out, id, order, operation, write_null)
            # as events first: the rejected rows of one step may have other types than those of the next
            events = reduce(DataFrame.unionByName, [to_error_events(bad, labels, tags) for bad in rejected]) if rejected else None
            own["name"] = save_batch(out, path, writer_id, batch_id, key, events, own.get("name") if started_here else None)
            own["batch_id"] = batch_id
        finally:
            if on_error == "reject":
                batch.unpersist()

    options = {"availableNow": True} if trigger is None else trigger
    writer = sdf.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**options)
    return (writer.queryName(name) if name else writer).start()


def _declared(df: DataFrame, declared: T.StructType) -> DataFrame:
    """The declared fields in their types; a value its field cannot hold ends the job."""
    casts = {f.name: F.col(quote(f.name)).cast(f.dataType) for f in declared.fields if f.name in df.columns}
    return df.withColumns(casts)


def _split_repeated(df: DataFrame, id: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose id is the only one of its kind, and all others as rejected."""
    rows = df.withColumn("__key", keyed(df, id))
    repeated = rows.groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__key")
    reason = F.concat(F.lit("several documents with id "), F.col(quote(id)).cast("string"), F.lit("; name an order column"))
    bad = rows.join(repeated, "__key", "left_semi").select(*columns_of(df))
    good = rows.join(repeated, "__key", "left_anti").select(*columns_of(df))
    return good, reject(bad, 409, "version_conflict", reason)


def writer_of(checkpoint: str) -> str:
    """Short stable name of the query that owns a checkpoint."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def save_batch(
    df: DataFrame, path: str, writer: str | None, batch_id: int, key: dict | None = None, events: DataFrame | None = None,
    before: str | None = None,
) -> str | None:
    """Writes one micro-batch with its error events and then its commit record: task files, time and rows. ``before`` is
    the name of the writer's batch before this one, if known. Without a writer the rows are plainly appended.
    Returns the batch's name."""
    spark = df.sparkSession
    divided = [INDEX] if INDEX in df.columns else []
    if writer is None:
        df.write.mode("append").partitionBy(*divided).parquet(f"{path}/docs/{BATCH}={NO_LOG}")
        return None
    started = dt.datetime.now(dt.timezone.utc)
    # a writer's batches are read in the order of their numbers, whatever the driver's clock does
    if before is None and batch_id:
        before = max(finished(spark, f"{path}/commits", f"{BATCH}=*-{writer}-{batch_id - 1:010d}"), default=None)
    last = int(before.split("=", 1)[1].split("-", 1)[0]) if before else 0
    name = f"{BATCH}={max(int(started.timestamp() * 1000), last + 1):013d}-{writer}-{batch_id:010d}"
    rows = df.hint("rebalance", F.col(INDEX)) if divided else df
    rows.write.mode("overwrite").partitionBy(*divided).parquet(f"{path}/docs/{name}")
    fields, since = _fields_of_writer(df.schema, read_layout(spark, f"{path}/docs/{before}") if before else None, batch_id)
    save_layout(spark, f"{path}/docs/{name}", fields, divided, since=since, key=key)
    if events is not None:
        events.write.mode("overwrite").parquet(f"{path}/errors/{name}")
    written = spark.read.option("basePath", f"{path}/docs/{name}").schema(fields).parquet(literal(f"{path}/docs/{name}"))
    records = written.groupBy(F.col("_metadata.file_name").alias("task")).agg(F.count(F.lit(1)).alias("records"))
    facts = {"started": started, "resource": path, "writer": writer, "batch_id": batch_id}
    commit = records.withColumns({k: F.lit(v) for k, v in facts.items()})
    commit = commit.withColumn("batch_id", F.col("batch_id").cast("bigint"))
    commit.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/{name}")
    return name


def _fields_of_writer(schema: T.StructType, before: dict | None, batch_id: int) -> tuple[T.StructType, int]:
    """The fields a writer has brought in batches that can be read with one schema, and the first such batch. A field
    in another type than before begins a new stretch."""
    fields = {f.name: T.StructField(f.name, f.dataType, True) for f in schema.fields}
    if before is None:
        return T.StructType(list(fields.values())), batch_id
    known = T.StructType.fromJson(before["schema"])
    if any(f.name in fields and fields[f.name].dataType != f.dataType for f in known.fields):
        return T.StructType(list(fields.values())), batch_id
    for f in known.fields:
        fields.setdefault(f.name, f)
    return T.StructType(list(fields.values())), before.get("since", 0)


def is_committed(spark: SparkSession, path: str, writer: str, batch_id: int) -> bool:
    return bool(finished(spark, f"{path}/commits", f"{BATCH}=*-{writer}-{batch_id:010d}"))


def commit_history(spark: SparkSession, path: str) -> DataFrame:
    """One row per written file of each committed batch."""
    schema = "task string, records bigint, started timestamp, resource string, writer string, batch_id bigint"
    names = finished(spark, f"{path}/commits", f"{BATCH}=*")
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(literal(f"{path}/commits/{n}") for n in names))


def read_stream_collection(
    spark: SparkSession,
    path: str,
    id: str | None = None,
    operation: str = "index",
    write_null: bool = False,
) -> DataFrame:
    """The documents a stream has committed so far; with an ``id``, one row per document (and collection, where rows
    name theirs)."""
    return stream_state(spark, path, id, operation, write_null)


def read_stream_errors(spark: SparkSession, path: str) -> DataFrame:
    """The error events of all committed batches, with the ``writer`` and ``batch_id`` they came from."""
    kept = set(children(spark, f"{path}/errors", f"{BATCH}=*"))
    names = [n for n in finished(spark, f"{path}/commits", f"{BATCH}=*") if n in kept]
    if not names:
        raise FileNotFoundError(f"no batch of [{path}] was written with on_error='reject'")
    reader = spark.read.option("basePath", f"{path}/errors").option("mergeSchema", "true")
    events = reader.parquet(*(literal(f"{path}/errors/{n}") for n in names))
    parts = F.split(F.col(BATCH).cast("string"), "-")
    return events.withColumns({"writer": F.get(parts, F.lit(1)), "batch_id": F.get(parts, F.lit(2)).cast("bigint")}).drop(BATCH)


def compact_stream(
    spark: SparkSession, path: str, id: str, operation: str = "index", write_null: bool = False
) -> dict[str, int]:
    """Folds all committed batches into a new base, which later reads start from. Returns, per writer, the
    last batch it covers. The batches stay until ``expire_batches``, so readers at work are not disturbed.
    Run it from one place at a time."""
    if children(spark, f"{path}/docs", f"{BATCH}={NO_LOG}"):
        raise ValueError("rows written without a commit log have no order to be folded in: read the collection without compaction")
    _, covered = base(spark, path)
    names = [n for n in visible(spark, path, covered) if not n.endswith(NO_LOG)]
    if not names:
        return covered
    covered = dict(covered)
    for writer, number in map(writer_and_number, names):
        covered[writer] = max(number, covered.get(writer, -1))
    key = (read_layout(spark, f"{path}/docs/{max(names)}") or {}).get("key")
    name = f"at={int(dt.datetime.now(dt.timezone.utc).timestamp() * 1000):013d}"
    state = read_stream_collection(spark, path, id, operation, write_null)
    divided = [INDEX] if INDEX in state.columns else []
    rows = spark.createDataFrame(list(covered.items()), "writer string, batch_id bigint")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/covered/{name}")
    folded = state.hint("rebalance", F.col(INDEX)) if divided else state
    # a base is finished, and so read, once Spark's own mark is there; what stands beside it is put there first
    save_layout(spark, f"{path}/base/{name}", state.schema, divided, key=key)
    folded.write.mode("append").partitionBy(*divided).parquet(f"{path}/base/{name}")
    return covered


def expire_batches(spark: SparkSession, path: str) -> list[str]:
    """Deletes the batch folders the newest base covers, and older bases. Commit records and error events stay, so a
    replay of such a batch is still skipped."""
    at, covered = base(spark, path)
    names = [n for n in children(spark, f"{path}/docs", f"{BATCH}=*") if not n.endswith(NO_LOG)]
    gone = [f"docs/{n}" for n, (w, k) in ((n, writer_and_number(n)) for n in names) if k <= covered.get(w, -1)]
    gone += [f"base/{n}" for n in finished(spark, f"{path}/base", "at=*") if n != at]
    for name in gone:
        drop_path(spark, f"{path}/{name}")
    return gone
