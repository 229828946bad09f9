"""Saving frames as collections: save modes, aliases, names made from data, several outputs.

A saved collection is a folder of finished versions (``v=000001`` …), each plain Parquet. Appends add
files to the current version; everything that replaces rows writes the next version, which becomes
current the moment Spark marks it finished. Readers of the old version are not disturbed.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..functions.decode import parse_date
from ..functions.documents import NOT_FOUND, document, extract
from ..functions.fields import locate, quote
from ..sources.catalog import (
    VERSION,
    children,
    current_version,
    drop_path,
    home,
    literal,
    locate_collection,
    open_parquet,
    read_layout,
    save_layout,
    saved_layout,
    scratch,
    version_numbers,
    version_path,
)
from ..sources.collections import ROUTING_BUCKET, is_empty, routing_bucket
from ..sources.mapping import conform_frame, settled_type
from .merge import REJECTION, WriteResult, reject
from .project import project_for_write

# Characters a collection name must not contain, and must not start with.
ILLEGAL = ' "*\\<|,>/?'
ILLEGAL_START = "_+-"


def is_valid_name(name: str) -> bool:
    return bool(name) and name[0] not in ILLEGAL_START and not set(name) & set(ILLEGAL) and name == name.lower()


def valid_name(c: Column) -> Column:
    """Per-row form of :func:`is_valid_name`."""
    banned = "[" + re.sub(r"(.)", r"\\\1", ILLEGAL) + "]"
    starts = "^[" + re.sub(r"(.)", r"\\\1", ILLEGAL_START) + "]"
    return (F.length(c) > 0) & ~c.rlike(banned) & ~c.rlike(starts) & (c == F.lower(c))


def write_target(alias: str, aliases: dict) -> str:
    """The one collection an alias writes to: its only target, or the one marked as write index."""
    targets = aliases.get(alias) or []
    if not targets:
        raise ValueError(f"alias [{alias}] has no collection to write to")
    if len(targets) == 1:
        return targets[0]["collection"]
    marked = [t["collection"] for t in targets if t.get("is_write_index")]
    if not marked:
        raise ValueError(f"alias [{alias}] has {len(targets)} collections and no write index")
    return marked[0]


def save_collection(
    df: DataFrame,
    name: str,
    root: str,
    mode: str = "append",
    auto_create: bool = True,
    aliases: dict | None = None,
    include=(),
    exclude=(),
    partition_by=(),
    id: str | None = None,
    buckets: int | None = None,
) -> str:
    """Saves a frame and returns the path written.

    ``append``, ``overwrite``, ``error`` and ``ignore`` look at whether the collection *has rows*.
    Overwriting drops the documents but keeps the fields the collection already knew. With ``buckets`` the documents
    are dealt into so many folders by a hash of their ``id``, so that ``merge_collection`` rewrites only those it touches."""
    spark = df.sparkSession
    if df.isStreaming:
        raise ValueError("a streaming frame cannot be saved as a batch; use stream_to_collection")
    mode = {"errorifexists": "error"}.get(mode, mode)
    if mode not in ("append", "overwrite", "error", "ignore"):
        raise ValueError(f"unknown save mode [{mode}]")
    if aliases and name in aliases:
        name = write_target(name, aliases)
    if not is_valid_name(name):
        raise ValueError(f"illegal collection name [{name}]")
    if include or exclude:
        df = project_for_write(df, include, exclude)
    existing = locate_collection(spark, name, root)
    if existing is None and not auto_create:
        raise FileNotFoundError(f"target collection [{name}] does not exist and auto-creation is disabled")
    if mode in ("error", "ignore") and not is_empty(spark, name, root):
        if mode == "ignore":
            return existing
        raise FileExistsError(f"collection [{name}] holds documents; mode [error] only fills empty ones")
    if buckets and (partition_by or id not in df.columns):
        raise ValueError("buckets need an id column, and no other partitioning")
    kept: list[str] = []
    dealt = {"id": id, "buckets": buckets} if buckets else None
    if existing is not None:
        layout = saved_layout(spark, existing)
        had = (read_layout(spark, existing) or {}).get("dealt")
        if mode != "overwrite" and had and dealt and had != dealt:
            raise ValueError(f"[{name}] has {had['buckets']} buckets by [{had['id']}], rows cannot be added in another way")
        dealt = dealt or had
        known, kept = layout or (open_parquet(spark, existing).schema, [])
        df = conform_frame(df, settled_type(known, df.schema))
    if existing is not None and mode != "overwrite":
        if buckets and not had:
            raise ValueError(f"[{name}] was saved without buckets: overwrite it to deal its documents into some")
        if partition_by and list(partition_by) != kept and layout:
            raise ValueError(f"[{name}] is partitioned by {kept}, rows cannot be added by {list(partition_by)}")
        path, how = existing, "append"
    else:
        path, how = next_version(spark, name, root), "errorifexists"
    _write(df, path, how, list(partition_by) or kept, dealt)
    return path


def _write(df: DataFrame, path: str, how: str, partition_by: list[str], dealt: dict | None = None) -> None:
    """Writes the rows in the collection's layout, and keeps schema and layout beside them."""
    if dealt:
        df, partition_by = _dealt(df, dealt), [ROUTING_BUCKET]
    writer = df.write.mode(how)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    save_layout(df.sparkSession, path, _nullable(df.schema), partition_by, dealt=dealt)


def _dealt(df: DataFrame, dealt: dict) -> DataFrame:
    """The rows with the bucket of their id; a bucket that takes many rows is written by several tasks."""
    placed = df.withColumn(ROUTING_BUCKET, _bucket(dealt))
    return placed.hint("rebalance", F.col(ROUTING_BUCKET))


def _bucket(dealt: dict) -> Column:
    return routing_bucket(F.coalesce(F.col(quote(dealt["id"])).cast("string"), F.lit("")), dealt["buckets"])


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def next_version(spark: SparkSession, name: str, root: str) -> str:
    """Path of a version nobody has started. An unfinished one left by a lost job is passed over."""
    base = home(name, root)
    return version_path(base, max(version_numbers(spark, base), default=0) + 1)


def commit_merge(result: WriteResult, name: str, root: str, partition_by=()) -> str:
    """Saves the target of a keyed write as the collection's next version, laid out as the current one is
    unless ``partition_by`` says otherwise."""
    spark = result.target.sparkSession
    existing = locate_collection(spark, name, root)
    layout = saved_layout(spark, existing) if existing is not None else None
    kept = [c for c in (layout[1] if layout else []) if c in result.target.columns]
    dealt = (read_layout(spark, existing) or {}).get("dealt") if existing is not None else None
    path = next_version(spark, name, root)
    target = result.target.drop(ROUTING_BUCKET) if dealt else result.target
    _write(target, path, "errorifexists", [] if dealt else list(partition_by) or kept, dealt)
    return path


@dataclass
class MergeReport:
    """What a merge did to a saved collection: the rejected rows (written), the buckets it rewrote (None for a
    collection without), and statistics that the writes themselves counted."""

    rejected: DataFrame
    buckets: list[int] | None
    counts: dict[str, int]

    def stats(self) -> DataFrame:
        """One row: documents and bytes sent, accepted and rejected. Runs no job."""
        spark = self.rejected.sparkSession
        listed = ", ".join(f"CAST({v} AS BIGINT) AS {k}" for k, v in self.counts.items())
        return spark.sql(f"SELECT {listed}")


def merge_collection(
    spark: SparkSession, name: str, root: str, write: Callable[..., WriteResult], source: DataFrame, id: str, **options
) -> MergeReport:
    """Runs a keyed write (``write_index``, ``write_update``, ``write_delete`` …) against a saved collection and saves the
    outcome.

    The source is written once and counted on the way, so the merge reads it from there and nothing is computed again
    for statistics. Of a collection with buckets only those that ids of the source fall into are read (partition
    pruning) and replaced (dynamic partition overwrite): a merge costs what it touches. The new buckets are
    complete in a scratch table before the first old one is replaced. Replacing them is not one step: readers at work
    should read again, and a run that was lost there is finished by running the merge once more. Other collections
    get a whole next version."""
    path = locate_collection(spark, name, root)
    if path is None or path.startswith(("table:", "stream:")):
        raise FileNotFoundError(f"no saved collection [{name}]")
    layout = read_layout(spark, path) or {}
    dealt = layout.get("dealt")
    if dealt and dealt["id"] != id:
        raise ValueError(f"[{name}] has buckets by [{dealt['id']}], not by [{id}]")
    sent = Observation()
    source = _observed(source, sent, "merge-source")
    target, touched = open_parquet(spark, path), None
    if dealt:
        rows = source.where(F.col(quote(id)).isNotNull()).select(_bucket(dealt).alias("bucket")).distinct().collect()
        touched = sorted(r["bucket"] for r in rows)  # one row a bucket at most
        target = target.where(F.col(ROUTING_BUCKET).isin(touched)).drop(ROUTING_BUCKET)
    result = write(target, source, id, **options)
    refused = Observation()
    rejected = _observed(result.rejected, refused, "merge-rejected")
    if dealt:
        _replace_buckets(spark, path, result.target, dealt, touched, layout)
    else:
        commit_merge(result, name, root)
    counts = {f"{k}_{kind}": v for kind, seen in (("sent", sent), ("rejected", refused)) for k, v in seen.get.items()}
    counts |= {f"{k}_accepted": counts[f"{k}_sent"] - counts[f"{k}_rejected"] for k in ("docs", "bytes")}
    return MergeReport(rejected, touched, counts)


def _observed(df: DataFrame, seen: Observation, label: str) -> DataFrame:
    """The rows written to a scratch table; Spark counts documents and their bytes while it writes."""
    body = F.octet_length(document(df, [c for c in df.columns if c not in REJECTION])).cast("bigint")
    path = scratch(df.sparkSession, label)
    watched = df.observe(seen, F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum(body), F.lit(0)).alias("bytes"))
    watched.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(literal(path))


def _replace_buckets(spark: SparkSession, path: str, target: DataFrame, dealt: dict, touched: list[int], layout: dict) -> None:
    known = T.StructType([f for f in T.StructType.fromJson(layout["schema"]).fields if f.name != ROUTING_BUCKET])
    agreed = _nullable(settled_type(known, target.schema))
    fresh = scratch(spark, "merge-buckets")
    _dealt(conform_frame(target, agreed), dealt).write.partitionBy(ROUTING_BUCKET).parquet(fresh)
    held = {int(n.split("=", 1)[1]) for n in children(spark, fresh, f"{ROUTING_BUCKET}=*")}
    if held:
        agreed = T.StructType([*agreed.fields, T.StructField(ROUTING_BUCKET, T.IntegerType())])
        merged = spark.read.schema(agreed).parquet(literal(fresh)).hint("rebalance", F.col(ROUTING_BUCKET))
        writer = merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(ROUTING_BUCKET).parquet(path)
        save_layout(spark, path, agreed, [ROUTING_BUCKET], dealt=dealt)
    for bucket in touched:  # one that lost its last document has no folder to replace it
        if bucket not in held:
            drop_path(spark, f"{path}/{ROUTING_BUCKET}={bucket}")


def expire_versions(spark: SparkSession, name: str, root: str, keep: int = 2) -> list[str]:
    """Deletes finished versions older than the ``keep`` newest ones."""
    base = home(name, root)
    current = current_version(spark, base)
    if keep < 1 or current is None:
        return []
    gone = [n for n in version_numbers(spark, base) if n <= current][:-keep]
    for n in gone:
        drop_path(spark, version_path(base, n))
    return [f"{VERSION}{n:06d}" for n in gone]


# -- names made from data ---------------------------------------------------------------------------


def index_name(df: DataFrame, pattern: str, formatter: Callable[[Column, str], Column] | None = None) -> Column:
    """``logs-{field}`` or ``logs-{ts|yyyy.MM.dd}`` as a Column; null where a field is null. A field the
    frame does not have raises."""
    if not re.fullmatch(r"(?:[^{}]|\{[^{}]*\})+", pattern):
        raise ValueError(f"invalid pattern [{pattern}]")
    parts = []
    for literal, braces in re.findall(r"([^{}]+)|\{([^{}]*)\}", pattern):
        if literal:
            parts.append(F.lit(literal))
            continue
        name, bar, form = braces.partition("|")
        if not name or (bar and not form):
            raise ValueError(f"invalid pattern [{pattern}]")
        value = extract(df, name)
        if value is NOT_FOUND:
            raise ValueError(f"cannot find [{name}] of pattern [{pattern}]")
        if bar:
            value = formatter(value, form) if formatter else format_date(value, locate(df.schema, name)[1], form)
        parts.append(value.cast("string"))
    if not parts:
        raise ValueError(f"invalid pattern [{pattern}]")
    return F.concat(*parts)


def format_date(value: Column, kind: T.DataType, form: str) -> Column:
    """Date text, epoch milliseconds or a timestamp, formatted. ``Y`` counts as the calendar year."""
    if isinstance(kind, T.StringType):
        value = parse_date(value)
    elif isinstance(kind, T.LongType):
        value = F.timestamp_millis(value)
    return F.date_format(value, form.replace("Y", "y"))


def with_index(df: DataFrame, pattern: str, formatter=None, name: str = "_index") -> DataFrame:
    return df.withColumn(name, index_name(df, pattern, formatter))


def split_index(df: DataFrame, pattern: str, formatter=None) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``_index``, and rejected rows: a null part, or a name no collection may have."""
    named = with_index(df, pattern, formatter)
    ok = F.coalesce(valid_name(F.col("_index")), F.lit(False))
    reason = F.when(F.col("_index").isNull(), F.lit(f"null value for {pattern}")).otherwise(
        F.concat(F.lit("illegal collection name "), F.col("_index"))
    )
    bad = reject(named.where(~ok), 400, "invalid_index_name", reason).drop("_index")
    return named.where(ok), bad


def checked_index(df: DataFrame, pattern: str, formatter=None) -> DataFrame:
    """Rows with their ``_index``; a null part, or a name no collection may have, ends the job."""
    named = with_index(df, pattern, formatter)
    ok = F.coalesce(valid_name(F.col("_index")), F.lit(False))
    reason = F.concat(F.lit(f"no valid collection name for {pattern}: "), F.coalesce("_index", F.lit("null")))
    return named.withColumn("_index", F.when(ok, F.col("_index")).otherwise(F.raise_error(reason).cast("string")))


def write_dynamic(
    df: DataFrame, pattern: str, root: str, on_error: str = "fail", formatter=None, mode: str = "append"
) -> DataFrame:
    """Writes each row to the collection its own fields name, below ``root``; returns the rejected rows.

    Rows are rebalanced by collection, so a collection that takes most rows is still written by many
    tasks and a small one gets one file."""
    good, bad = split_index(df, pattern, formatter)
    if on_error == "fail":
        good = checked_index(df, pattern, formatter)
    elif on_error != "reject":
        raise ValueError(f"unknown on_error [{on_error}]")
    good.hint("rebalance", F.col("_index")).write.mode(mode).partitionBy("_index").parquet(root)
    return bad


# -- several outputs and tables ---------------------------------------------------------------------


def save_many(df: DataFrame, sinks) -> list:
    """One frame to several outputs: each sink is a function of the frame. The frame is computed once, into
    a table in the shared scratch folder, so every output gets the same rows even when executors are lost."""
    spark = df.sparkSession
    path = scratch(spark, "shared")
    df.write.parquet(path)
    try:
        shared = spark.read.schema(df.schema).parquet(path)
        return [sink(shared) for sink in sinks]
    finally:
        drop_path(spark, path)


def external_table(df: DataFrame, columns, aliases: dict[str, str] | None = None, json_output: bool = False) -> DataFrame:
    """A frame as an external table declares it: named, typed columns over (dotted) document fields,
    names compared without case. ``columns`` is a DDL text or ``{name: type}``. With ``json_output`` the single
    string column holds the whole document."""
    from ..functions.documents import document

    schema = _declared(columns)
    if json_output:
        if len(schema) != 1 or not isinstance(schema[0].dataType, T.StringType):
            raise ValueError("JSON output needs exactly one string column")
        return df.select(document(df, millis=False).alias(schema[0].name))
    by_column = {k.lower(): v for k, v in (aliases or {}).items()}
    out = []
    for f in schema.fields:
        path = actual_path(df.schema, by_column.get(f.name.lower(), f.name))
        value = F.lit(None) if path is None else locate(df.schema, path)[0]
        out.append(value.cast(f.dataType).alias(f.name))
    return df.select(*out)


def _declared(columns) -> T.StructType:
    if isinstance(columns, T.StructType):
        return columns
    if isinstance(columns, dict):
        columns = ", ".join(f"{quote(n)} {t}" for n, t in columns.items())
    return T.StructType.fromDDL(columns)


def actual_path(schema: T.StructType, path: str) -> str | None:
    """The dotted path as the schema spells it, or None."""
    kind: T.DataType = schema
    out = []
    for part in [path] if path.lower() in [n.lower() for n in schema.fieldNames()] else path.split("."):
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if not isinstance(kind, T.StructType):
            return None
        hit = next((n for n in kind.fieldNames() if n.lower() == part.lower()), None)
        if hit is None:
            return None
        out.append(hit)
        kind = kind[hit].dataType
    return ".".join(out)


def insert_overwrite(
    df: DataFrame, name: str, root: str, columns=None, aliases: dict[str, str] | None = None, overwrite: bool = True
) -> str:
    """``INSERT [OVERWRITE]`` of a query into a collection: columns by position as the table declares them,
    stored under the aliased (dotted) document fields."""
    if columns is not None:
        schema = _declared(columns)
        if len(schema) != len(df.columns):
            raise ValueError(f"the table declares {len(schema)} columns, the query has {len(df.columns)}")
        df = df.select(*(F.col(quote(c)).cast(f.dataType).alias(f.name) for c, f in zip(df.columns, schema.fields)))
    by_column = {k.lower(): v for k, v in (aliases or {}).items()}
    tree: dict = {}
    for c in df.columns:
        *parents, leaf = by_column.get(c.lower(), c).split(".")
        node = tree
        for p in parents:
            node = node.setdefault(p, {})
        node[leaf] = F.col(quote(c))
    return save_collection(df.select(*_structs(tree)), name, root, "overwrite" if overwrite else "append")


def _structs(tree: dict) -> list[Column]:
    return [(F.struct(*_structs(v)) if isinstance(v, dict) else v).alias(n) for n, v in tree.items()]
