"""Collections that streams write: which batches are visible, and their rows.

Below a stream's folder lie ``docs`` (one folder per micro-batch, divided by collection name where rows name one),
``errors`` (the rejected rows of a batch, as error events) and ``commits``. A batch, all its names and its errors
together, is visible once its commit is there.

Beside each batch stand the fields its writer has brought so far. Where a writer changes the type of a field, a new
stretch of batches begins, and the batch before it is noted. So a reader looks at one batch per writer and change of
types, reads each stretch with its own types, and brings all to the types they agree on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.fields import quote
from ..operators.batch import fold, latest
from .catalog import children, escaped, finished, literal, path_exists, read_layout, unescaped
from .mapping import common_schema, conform_frame

BATCH = "batch"
NO_LOG = "0-plain-0"  # the folder of streams that keep no commit log
INDEX = "_index"


def is_stream(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/commits") and path_exists(spark, f"{path}/docs")


def writer_and_number(name: str) -> tuple[str, int]:
    _, writer, number = name.rsplit("-", 2)
    return writer, int(number)


def visible(spark: SparkSession, path: str, covered: dict[str, int]) -> list[str]:
    """Committed batches beyond those that a base covers, and rows written without a commit log."""
    names = finished(spark, f"{path}/commits", f"{BATCH}=*")
    names = [n for n, (w, k) in ((n, writer_and_number(n)) for n in names) if k > covered.get(w, -1)]
    return names + children(spark, f"{path}/docs", f"{BATCH}={NO_LOG}")


def base(spark: SparkSession, path: str) -> tuple[str | None, dict[str, int]]:
    """The newest finished base, and per writer the last batch it covers (one row per writer)."""
    done = finished(spark, f"{path}/base", "at=*")
    if not done:
        return None, {}
    rows = spark.read.schema("writer string, batch_id bigint").parquet(literal(f"{path}/covered/{done[-1]}")).collect()
    return done[-1], {r["writer"]: r["batch_id"] for r in rows}


def collection_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the collections that the visible rows of a stream's folder belong to."""
    at, covered = base(spark, path)
    shown = set(visible(spark, path, covered))
    found = {i for b, i in (p.rsplit("/", 2)[1:] for p in _name_folders(spark, path, f"{INDEX}=*")) if b in shown}
    found |= set(children(spark, f"{path}/base/{at}", f"{INDEX}=*")) if at else set()
    return sorted(unescaped(spark, i.removeprefix(f"{INDEX}=")) for i in found)


def _name_folders(spark: SparkSession, path: str, pattern: str) -> list[str]:
    from .catalog import glob_paths

    return glob_paths(spark, f"{literal(path)}/docs/{BATCH}=*/{pattern}")


def _stretches(spark: SparkSession, path: str, names: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Batches with one schema each for reading them; an unknown schema (plain rows) counts as none."""
    of_writer: dict[str, list[tuple[int, str]]] = {}
    for name in names:
        if not name.endswith(NO_LOG):
            writer, number = writer_and_number(name)
            of_writer.setdefault(writer, []).append((number, name))
    out = []
    for batches in of_writer.values():
        batches.sort()
        while batches:
            kept = read_layout(spark, f"{path}/docs/{batches[-1][1]}")
            since = kept.get("since", 0) if kept else batches[-1][0]
            out.append((T.StructType.fromJson(kept["schema"]) if kept else None, [n for k, n in batches if k >= since]))
            batches = [(k, n) for k, n in batches if k < since]
    plain = [n for n in names if n.endswith(NO_LOG)]
    return out + ([(None, plain)] if plain else [])


def committed_rows(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """All visible rows with the batch they came from: the newest base, then the batches it does not cover.
    With a ``name``, only the folders of that collection are read."""
    at, covered = base(spark, path)
    parts = []
    if at is not None:
        own = f"/{INDEX}={escaped(spark, name)}" if name is not None else ""
        if path_exists(spark, f"{path}/base/{at}{own}"):
            kept = read_layout(spark, f"{path}/base/{at}")
            reader = spark.read.option("basePath", f"{path}/base/{at}")
            reader = reader.schema(T.StructType.fromJson(kept["schema"])) if kept else reader
            parts.append(reader.parquet(literal(f"{path}/base/{at}{own}")).withColumn(BATCH, F.lit("")))
    folders = None
    if name is not None:
        own = {p.rsplit("/", 2)[1]: p for p in _name_folders(spark, path, f"{INDEX}={literal(escaped(spark, name))}")}
        folders = {b: f"{path}/docs/{b}/{INDEX}={escaped(spark, name)}" for b in own}
    for schema, names in _stretches(spark, path, visible(spark, path, covered)):
        paths = [f"{path}/docs/{n}" if folders is None else folders[n] for n in names if folders is None or n in folders]
        if not paths:
            continue
        reader = spark.read.option("basePath", f"{path}/docs")
        if schema is None:
            reader = reader.option("mergeSchema", "true")
        else:
            reader = reader.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())]))
        docs = reader.parquet(*map(literal, paths))
        parts.append(docs.withColumn(BATCH, F.col(BATCH).cast("string")))
    if not parts:
        raise FileNotFoundError(f"nothing was written to [{path if name is None else f'{path}: {name}'}] yet")
    agreed = common_schema([p.schema for p in parts])
    return reduce(lambda a, b: a.unionByName(b), [conform_frame(p, agreed) for p in parts])


def keyed(df: DataFrame, id: str) -> Column:
    """What a document is told apart by: its id, within its collection."""
    return F.struct(INDEX, quote(id)) if INDEX in df.columns else F.col(quote(id))


def one_per_document(df: DataFrame, id: str, order, operation: str, write_null: bool = False) -> DataFrame:
    """The last document (or the last value of each field) of every id, by ``order``; without an order ids must
    not repeat."""
    rows = df.withColumn("__key", keyed(df, id))
    if order is None or operation == "index":
        return latest(rows, "__key", order).drop("__key")
    return fold(rows, "__key", order, write_null).drop("__key")


def stream_state(spark: SparkSession, path: str, id: str | None, operation: str, write_null: bool, name: str | None = None) -> DataFrame:
    """The documents a stream has committed so far; with an ``id``, one row per document."""
    rows = committed_rows(spark, path, name)
    body = [c for c in rows.columns if c != BATCH]
    rows = rows if id is None else one_per_document(rows, id, BATCH, operation, write_null)
    return rows.select(*(F.col(quote(c)) for c in body))


def named_state(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A collection of a stream by its name, folded as its writer says (by what stands beside its newest batch)."""
    at, covered = base(spark, path)
    names = [n for n in visible(spark, path, covered) if not n.endswith(NO_LOG)] or children(spark, f"{path}/commits", f"{BATCH}=*")
    kept = (read_layout(spark, f"{path}/docs/{max(names)}") or read_layout(spark, f"{path}/base/{at}") or {}) if names else {}
    key = kept.get("key") or {}
    df = stream_state(spark, path, key.get("id"), key.get("operation", "index"), key.get("write_null", False), name)
    return df.drop(INDEX)
