"""Rows to JSON documents, paths out of JSON documents, and values out of rows."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .decode import as_instant
from .fields import TEMPORAL, locate, quote


class _NotFound:
    def __repr__(self):
        return "NOT_FOUND"


NOT_FOUND = _NotFound()


def document_schema_check(kind: T.DataType, path: str = "") -> None:
    """Documents have no decimal type."""
    if isinstance(kind, T.DecimalType):
        raise ValueError(f"decimal field [{path}] is not supported in a document; use a double or a string")
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            document_schema_check(f.dataType, f"{path}.{f.name}" if path else f.name)
    elif isinstance(kind, T.ArrayType):
        document_schema_check(kind.elementType, path)
    elif isinstance(kind, T.MapType):
        document_schema_check(kind.valueType, path)


def _millis(column: Column, kind: T.DataType) -> Column:
    """Dates and timestamps as epoch milliseconds, at any depth."""
    if isinstance(kind, TEMPORAL):
        return F.unix_millis(as_instant(column, kind))
    if not _has_time(kind):
        return column
    if isinstance(kind, T.StructType):
        parts = [_millis(column.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _millis(x, kind.elementType))
    return F.transform_values(column, lambda k, v: _millis(v, kind.valueType))


def _has_time(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_time(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_time(kind.elementType)
    if isinstance(kind, T.MapType):
        return _has_time(kind.valueType)
    return isinstance(kind, TEMPORAL)


def document(df: DataFrame, columns=None, write_null: bool = False, millis: bool = True) -> Column:
    """One JSON document per row: nulls dropped unless ``write_null``, dates as epoch milliseconds
    (or ISO text with ``millis=False``), binary as base64, decimals refused."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    document_schema_check(T.StructType(fields))
    parts = [
        (_millis(F.col(quote(f.name)), f.dataType) if millis else F.col(quote(f.name))).alias(f.name) for f in fields
    ]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": str(not write_null).lower()})


def to_document(df: DataFrame, write_null: bool = False, millis: bool = True, name: str = "json") -> DataFrame:
    return df.select(document(df, None, write_null, millis).alias(name))


# -- values out of JSON -----------------------------------------------------------------------------


def json_paths(c: Column, paths: list[str]) -> list[Column]:
    """The values at several dotted paths as text. The document is parsed once: all paths form one
    nested schema. A missing path is null."""
    tree: dict = {}
    for path in paths:
        node = tree
        for part in path.split("."):
            node = node.setdefault(part, {})
    if any(_node(tree, p) for p in paths):  # one path leads through another
        return [F.get_json_object(c, _json_path(p)).alias(p) for p in paths]
    parsed = F.from_json(c, _tree_type(tree))
    return [_walk(parsed, p).alias(p) for p in paths]


def _node(tree: dict, path: str) -> dict:
    for part in path.split("."):
        tree = tree[part]
    return tree


def _json_path(path: str) -> str:
    return "$" + "".join(f"['{p}']" for p in path.split("."))


def _tree_type(tree: dict) -> T.StructType:
    return T.StructType([T.StructField(n, _tree_type(t) if t else T.StringType()) for n, t in tree.items()])


def _walk(column: Column, path: str) -> Column:
    for part in path.split("."):
        column = column.getField(part)
    return column


# -- values out of rows -----------------------------------------------------------------------------


def extract(df: DataFrame, path: str):
    """The column at a dotted path, or ``NOT_FOUND`` when the schema does not have it (a null value
    is a found value)."""
    try:
        return locate(df.schema, path)[0]
    except KeyError:
        return NOT_FOUND


def field_or_const(df: DataFrame, text: str):
    """``<value>`` is a constant, anything else a field path. A constant is a JSON scalar other than a fraction; what
    is none is text as it stands."""
    if not (text.startswith("<") and text.endswith(">")):
        return extract(df, text)
    inner = text[1:-1]
    try:
        found = json.loads(inner, parse_float=str, parse_constant=str)
    except ValueError:
        return F.lit(inner)
    return F.lit(inner if isinstance(found, (list, dict)) else found)


def resolve(df: DataFrame, source):
    """A Column, a callable on the frame, a constant or a path, as a Column or ``NOT_FOUND``."""
    if isinstance(source, Column):
        return source
    return source(df) if callable(source) else field_or_const(df, source)


def first_found(df: DataFrame, sources, on_missing: str = "skip"):
    """The first source that exists and is not null on a row. When a row has none it stays null
    (``skip``) or the job fails (``error``)."""
    found = [c for c in (resolve(df, s) for s in sources) if c is not NOT_FOUND]
    if on_missing == "error":
        found.append(F.raise_error(F.lit(f"none of {[str(s) for s in sources]} found")).cast("string"))
    return F.coalesce(*found) if found else F.lit(None)
