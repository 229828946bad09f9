"""Reading one or many collections as DataFrames."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.predicates import as_predicate, bool_
from ..operators.project import prune_schema, source_filter as keep_source, validate_fields
from ..operators.search import search
from .catalog import (
    children,
    is_named,
    is_pattern,
    list_collections,
    literal,
    locate_collection,
    open_parquet,
    qualified_uri,
    read_layout,
    select_names,
    split_names,
)
from .json_docs import with_metadata as add_metadata
from .mapping import common_schema, conform_frame, merge_mappings, parse_mapping, to_schema
from .streamed import named_state

ROUTING_BUCKET = "_bucket"
LOOKUPS = 8  # schema look-ups at a time


def read_collection(
    spark: SparkSession,
    name: str,
    query=None,
    *,
    root: str | None = None,
    schema: T.StructType | str | None = None,
    mapping=None,
    include=(),
    exclude=(),
    validate: str = "ignore",
    source_filter=(),
    routing=None,
    buckets: int | None = None,
    missing_as_empty: bool = False,
    metadata: bool | str = False,
    version: bool = False,
    id: str = "_id",
    text=(),
    strict: bool = False,
    pushdown: bool = True,
    recheck: bool = True,
) -> DataFrame:
    """A collection (name below ``root``, Parquet path, or table) as a DataFrame.

    A ``schema`` or document ``mapping`` overrides the discovered one. ``include`` / ``exclude``
    prune the read schema itself, so unwanted leaves are not read even inside arrays of structs.
    ``routing`` keeps only rows with those routing values, by folder when the collection was placed
    with ``place_by_routing(buckets)``."""
    found = locate_collection(spark, name, root)
    wanted = _schema(schema, mapping)
    if found is None:
        if not missing_as_empty:
            raise FileNotFoundError(f"collection [{name}] does not exist")
        return spark.createDataFrame([], prune_schema(wanted or T.StructType(), include, exclude) if wanted else T.StructType())
    raw = open_found(spark, found, name)
    have = raw.schema
    target = wanted or have
    if include or exclude:
        if source_filter:
            raise ValueError("a source filter cannot be combined with include / exclude")
        validate_fields(target, [*include, *exclude], validate)
        pruned = prune_schema(target, include, exclude)
    else:
        pruned = target
    filtered = query is not None or routing is not None
    noted = metadata if isinstance(metadata, str) else "_metadata"
    if filtered or metadata:  # the query may test any field, metadata any id; Catalyst drops what nobody uses
        extra = [f for f in have.fields if f.name not in target.fieldNames()]
        df = _scan(spark, raw, found, T.StructType([*target.fields, *extra]))
        df = _routed(df, routing, buckets)
        if query is not None:
            df = search(df, query, text, strict, pushdown, recheck)
        if metadata:
            df = add_metadata(df, id, noted, index=name, version=version)
            pruned = T.StructType([*(f for f in pruned.fields if f.name != noted), df.schema[noted]])
        df = conform_frame(df, pruned)
    else:
        df = _scan(spark, raw, found, pruned)
    if source_filter:
        validate_fields(target, source_filter, validate)
        df = keep_source(df, [*source_filter, *([noted] if metadata else [])])
    return df


def open_found(spark: SparkSession, found: str, name: str) -> DataFrame:
    """The rows behind what ``locate_collection`` found."""
    if found.startswith("table:"):
        return spark.table(found[6:])
    if found.startswith("stream:"):
        return named_state(spark, found[7:], name)
    rows = open_parquet(spark, found)
    # buckets by id are for merges alone; those by routing are data
    return rows.drop(ROUTING_BUCKET) if ROUTING_BUCKET in rows.columns and (read_layout(spark, found) or {}).get("dealt") else rows


def _schema(schema, mapping) -> T.StructType | None:
    if isinstance(schema, str):
        return T.StructType.fromDDL(schema)
    return schema if schema is not None else to_schema(parse_mapping(mapping)) if mapping is not None else None


def _scan(spark: SparkSession, raw: DataFrame, found: str, want: T.StructType) -> DataFrame:
    """The scan as ``want``. Catalyst itself prunes columns and struct fields; only to skip leaves inside
    arrays of structs the pruned schema has to be handed to the Parquet reader."""
    if raw.schema == want:
        return raw
    if not found.startswith(("table:", "stream:")) and _is_part(want, raw.schema) and _prunes_arrays(want, raw.schema):
        return spark.read.schema(want).parquet(literal(found))
    return conform_frame(raw, want)


def _prunes_arrays(want: T.DataType, have: T.DataType) -> bool:
    if isinstance(want, T.StructType):
        return any(_prunes_arrays(f.dataType, have[f.name].dataType) for f in want.fields)
    return isinstance(want, T.ArrayType) and want != have


def _is_part(want: T.DataType, have: T.DataType) -> bool:
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        return all(f.name in have.fieldNames() and _is_part(f.dataType, have[f.name].dataType) for f in want.fields)
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return _is_part(want.elementType, have.elementType)
    return want == have


def _routed(df: DataFrame, routing, buckets: int | None) -> DataFrame:
    if routing is None:
        return df
    values = [str(v) for v in ([routing] if isinstance(routing, (str, int)) else routing)]
    if "_routing" not in df.columns:
        raise ValueError("the collection has no _routing column")
    df = df.where(F.col("_routing").cast("string").isin(values))
    if buckets and ROUTING_BUCKET in df.columns:
        df = df.where(F.col(ROUTING_BUCKET).isin([routing_bucket(F.lit(v), buckets) for v in values]))
    return df


def routing_bucket(key, buckets: int):
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def read_collections(
    spark: SparkSession,
    names,
    query=None,
    *,
    root: str | None = None,
    mappings: dict | None = None,
    index_column: str | None = "_index",
    missing_as_empty: bool = False,
    text=(),
    include=(),
    exclude=(),
    strict: bool = False,
    pushdown: bool = True,
    recheck: bool = True,
    **options,
) -> DataFrame:
    """Several collections (comma list, ``*`` patterns, ``_all``, ``+`` / ``-``) as one frame.

    Differing field types meet by the document type rules (whole with fractional numbers as text),
    never by Spark's own widening. ``_index`` holds the collection each row came from; a filter on
    it drops the other scans at planning time."""
    if is_pattern(names):
        if root is None:
            raise ValueError("name patterns need a root folder")
        picked = select_names(list_collections(spark, root), names)
    else:
        picked = split_names(names)

    def read(name: str) -> tuple[str, DataFrame, str | None] | None:
        mapping, found = (mappings or {}).get(name), locate_collection(spark, name, root)
        if missing_as_empty and found is None:
            return None
        df = read_collection(spark, name, root=root, mapping=mapping, **options)
        alone = bool(options) or mapping is not None or found.startswith(("table:", "stream:")) or bool(children(spark, found, "*=*"))
        return name, df, None if alone else found

    # each collection's schema is looked up in its files: many look-ups run side by side
    with ThreadPoolExecutor(max_workers=LOOKUPS) as pool:
        frames = [f for f in pool.map(inheritable_thread_target(spark)(read), picked) if f is not None]
    if not frames:
        if missing_as_empty:
            return spark.createDataFrame([], T.StructType())
        raise FileNotFoundError(f"no collection matches [{names}]")
    if mappings and all(n in mappings for n, _, _ in frames):
        agreed = to_schema(merge_mappings([parse_mapping(mappings[n]) for n, _, _ in frames]))
    else:
        agreed = common_schema([df.schema for _, df, _ in frames])
    out = union_frames(_in_one_scan(spark, frames, index_column), agreed, index_column)
    if query is not None:
        out = search(out, query, text, strict, pushdown, recheck)
    return _pruned(out, include, exclude, index_column, options.get("metadata"))


def _pruned(df: DataFrame, include, exclude, index_column: str | None, metadata) -> DataFrame:
    """What is left of the agreed fields, after the query: it may test fields that are not returned, and a field
    need not be in every collection."""
    if not include and not exclude:
        return df
    noted = [index_column, metadata if isinstance(metadata, str) else "_metadata" if metadata else None]
    extra = [f for f in df.schema.fields if f.name in noted]
    body = T.StructType([f for f in df.schema.fields if f.name not in noted])
    return conform_frame(df, T.StructType([*prune_schema(body, include, exclude).fields, *extra]))


def _in_one_scan(spark: SparkSession, frames, index_column: str | None) -> list[tuple[str | None, DataFrame]]:
    """Collections of one schema as one scan over all their paths; the name of a row's collection then comes from the path
    of its file. A filter on the name reaches the list of files, so those of other collections are not opened.
    Collections without a path of their own (None) stay as they are."""
    groups: dict[str, list] = {}
    out = []
    for name, df, found in frames:
        if found is None:
            out.append((name, df))
        else:
            groups.setdefault(df.schema.json(), []).append((name, df, found))
    for same in groups.values():
        if len(same) == 1:
            out.append(same[0][:2])
            continue
        rows = spark.read.schema(same[0][1].schema).parquet(*(literal(found) for _, _, found in same))
        if index_column:
            rows = rows.withColumn(index_column, _name_by_path(spark, {found: name for name, _, found in same}))
        out.append((None, rows))
    return out


def _name_by_path(spark: SparkSession, names: dict[str, str]) -> Column:
    """The collection whose path (of a file or a folder) begins the path of the row's file."""
    places = [(re.sub("^file:/+", "file:/", qualified_uri(spark, path)), name) for path, name in names.items()]
    file = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
    entries = F.create_map(*(F.lit(x) for pair in places for x in pair))
    depths = sorted({place.count("/") for place, _ in places})
    # a place is found by the leading parts of the file's path, so the number of collections adds nothing per row
    return F.coalesce(*(F.element_at(entries, F.substring_index(file, "/", depth + 1)) for depth in depths))


def union_frames(frames, agreed: T.StructType, index_column: str | None) -> DataFrame:
    shaped = []
    for name, df in frames:
        named = index_column if name is None else None
        want = T.StructType([*agreed.fields, T.StructField(named, T.StringType())]) if named else agreed
        df = conform_frame(df, want)
        shaped.append(df.withColumn(index_column, F.lit(name)) if index_column and name is not None else df)
    return reduce(lambda a, b: a.unionByName(b), shaped)


def alias_targets(alias: str, aliases: dict) -> list[dict]:
    if alias not in aliases:
        raise KeyError(f"alias [{alias}] is not defined")
    return aliases[alias]


def alias_condition(collection: str, names, aliases: dict):
    """Filter (or None) and routing values that the requested aliases put on one collection; nothing
    when the collection itself was named."""
    if is_named(collection, names):
        return None, []
    filters, routing = [], []
    for alias, targets in sorted(aliases.items()):
        if not is_named(alias, names):
            continue
        for t in targets:
            if t["collection"] != collection:
                continue
            if t.get("filter") is not None:
                filters.append(t["filter"])
            given = t.get("search_routing")
            for value in given.split(",") if isinstance(given, str) else given or ():
                if str(value).strip() not in routing:
                    routing.append(str(value).strip())
    condition = None if not filters else as_predicate(filters[0]) if len(filters) == 1 else bool_(should=filters)
    return condition, routing


def read_alias(
    spark: SparkSession, names, aliases: dict, query=None, *, root: str | None = None, text=(), include=(), exclude=(),
    strict: bool = False, pushdown: bool = True, recheck: bool = True, **options,
) -> DataFrame:
    """Reads through aliases (``{alias: [{collection, filter, search_routing}]}``); ``names`` may mix
    aliases, collections and patterns. The filters of all requested aliases of a collection are
    OR-ed and then AND-ed to the query, their search routings united."""
    known = sorted({t["collection"] for targets in aliases.values() for t in targets})
    universe = sorted(set(known) | set(list_collections(spark, root) if root and is_pattern(names) else ()))
    collections: list[str] = []
    for name in select_names(sorted({*universe, *aliases}), names):
        collections += [t["collection"] for t in aliases[name]] if name in aliases else [name]
    frames = []
    for collection in dict.fromkeys(collections):
        condition, routing = alias_condition(collection, names, aliases)
        df = read_collection(spark, collection, root=root, routing=routing or None, text=text, **options)
        if condition is not None:
            df = search(df, condition, text)
        if query is not None:
            df = search(df, query, text, strict, pushdown, recheck)
        frames.append((collection, df))
    if len(frames) == 1:
        return _pruned(frames[0][1], include, exclude, None, options.get("metadata"))
    united = union_frames(frames, common_schema([df.schema for _, df in frames]), "_index")
    return _pruned(united, include, exclude, "_index", options.get("metadata"))


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.DISK_ONLY):
    """The rows kept on the executors' disks (or as ``level`` says) for several uses, and released at the end of the block. What
    an executor held when it was lost is read again from the collection."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def is_empty(spark: SparkSession, name: str, root: str | None = None) -> bool:
    """Whether a collection has no rows; a missing one counts as empty."""
    found = locate_collection(spark, name, root)
    return found is None or read_collection(spark, name, root=root).isEmpty()


def register_view(spark: SparkSession, view: str, options: dict | None = None, **more) -> DataFrame:
    """A temporary view over a collection, from SQL-style options: ``_`` in an option name reads as
    ``.``, and ``resource`` wins over ``path``."""
    given = {str(k).replace("_", "."): v for k, v in {**(options or {}), **more}.items()}
    name = given.pop("resource", None) or given.get("path")
    given.pop("path", None)
    if not name:
        raise ValueError("resource must be specified")
    call: dict = {}
    for key, value in given.items():
        if key not in _VIEW_OPTIONS:
            raise ValueError(f"unknown option [{key}]")
        argument, read = _VIEW_OPTIONS[key]
        call[argument] = read(value)
    many = is_pattern(name) or "," in name
    df = (read_collections if many else read_collection)(spark, name, **call)
    df.createOrReplaceTempView(view)
    return df


def _flag(value) -> bool:
    return str(value).strip().lower() not in ("", "false", "0", "off", "no")


def _names(value) -> list[str]:
    return split_names(value)


# Option names a view accepts, and how each reads.
_VIEW_OPTIONS = {
    "query": ("query", lambda v: v),
    "root": ("root", str),
    "pushdown": ("pushdown", _flag),
    "strict": ("strict", _flag),
    "double.filtering": ("recheck", _flag),
    "text": ("text", _names),
    "read.field.include": ("include", _names),
    "read.field.exclude": ("exclude", _names),
    "read.source.filter": ("source_filter", _names),
    "read.metadata": ("metadata", _flag),
    "read.metadata.version": ("version", _flag),
    "read.missing.as.empty": ("missing_as_empty", _flag),
    "mapping.id": ("id", str),
}
