"""Include / exclude of fields, deep inside structs and arrays of structs."""

from __future__ import annotations

import logging
import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.fields import quote

log = logging.getLogger(__name__)

# Metadata names that every document has.
BUILT_IN = {
    "_uid", "_id", "_type", "_source", "_all", "_analyzer", "_boost",
    "_parent", "_routing", "_index", "_size", "_field_names", "_meta",
}


def simple_match(pattern: str, name: str) -> bool:
    """``*`` stands for any run of characters; everything else is literal."""
    return re.fullmatch(".*".join(map(re.escape, pattern.split("*"))), name, re.S) is not None


def numbered(include) -> list[tuple[str, int]]:
    """``["a", "b:2"]`` as pattern and array depth."""
    out = []
    for item in include or ():
        name, colon, depth = item.partition(":")
        if colon and not depth.isdigit():
            raise ValueError(f"cannot read [{item}] as field:depth")
        out.append((name, int(depth) if colon else 1))
    return out


def is_kept(path: str, include, exclude, partial: bool = True) -> bool:
    """Whether a dotted path survives: exclude wins; with no include everything stays; otherwise
    the path has to match an include, or (``partial``) lead to one."""
    if any(simple_match(p, path) for p in exclude or ()):
        return False
    if not include:
        return True
    return any(
        simple_match(p, path) or (partial and p.startswith(path + ".")) for p, _ in numbered(include)
    )


def matched_depth(path: str, wanted: list[tuple[str, int]], exclude) -> int | None:
    if any(simple_match(p, path) for p in exclude or ()):
        return None
    return next((depth for p, depth in wanted if simple_match(p, path)), None)


def prune_type(kind: T.DataType, include, exclude, path: str = "") -> T.DataType | None:
    """The type without its unwanted fields; None when no leaf is left (a parent named without its
    leaves keeps nothing)."""
    if isinstance(kind, T.ArrayType):
        element = prune_type(kind.elementType, include, exclude, path)
        return None if element is None else T.ArrayType(element, kind.containsNull)
    if not isinstance(kind, T.StructType):
        return kind
    kept = []
    for f in kind.fields:
        here = f"{path}.{f.name}" if path else f.name
        if is_kept(here, include, exclude):
            pruned = prune_type(f.dataType, include, exclude, here)
            if pruned is not None:
                kept.append(T.StructField(f.name, pruned, f.nullable, f.metadata))
    return T.StructType(kept) if kept else None


def prune_schema(schema: T.StructType, include=(), exclude=()) -> T.StructType:
    pruned = prune_type(schema, include, exclude)
    if pruned is None:
        raise ValueError(f"no field left by include {list(include)} and exclude {list(exclude)}")
    return pruned


def narrow(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """The column rebuilt with only the fields of ``want``; null structs and arrays stay null."""
    if have == want:
        return column
    if isinstance(have, T.ArrayType):
        return F.transform(column, lambda x: narrow(x, have.elementType, want.elementType))
    parts = [narrow(column.getField(f.name), have[f.name].dataType, f.dataType).alias(f.name) for f in want.fields]
    return F.when(column.isNotNull(), F.struct(*parts))


def project_fields(df: DataFrame, include=(), exclude=(), validate: str = "ignore") -> DataFrame:
    """Only the wanted fields, in schema order. On a fresh scan prefer ``read_collection(include=…)``,
    which hands the pruned schema to the reader (arrays of structs included)."""
    validate_fields(df.schema, [*include, *exclude], validate)
    want = prune_schema(df.schema, include, exclude)
    return df.select(
        *(narrow(F.col(quote(f.name)), df.schema[f.name].dataType, f.dataType).alias(f.name) for f in want.fields)
    )


def validate_fields(schema: T.StructType, names, validation: str = "strict") -> list[str]:
    """Requested fields the schema does not have: ``ignore`` them, ``warn``, or raise (``strict``)."""
    if validation not in ("ignore", "warn", "strict"):
        raise ValueError(f"unknown validation [{validation}]")
    if validation == "ignore":
        return []
    known = set(flatten_schema(schema))
    absent = [
        n for n, _ in numbered(names)
        if "*" not in n and n not in known and n not in BUILT_IN and not any(k.startswith(n + ".") for k in known)
    ]
    if absent and validation == "strict":
        raise ValueError(f"field(s) {absent} not found in the schema")
    if absent:
        log.warning("field(s) %s not found in the schema", absent)
    return absent


def flatten_schema(schema) -> dict[str, str]:
    """Dotted leaf name -> Spark type, arrays looked through."""
    schema = schema.schema if isinstance(schema, DataFrame) else schema
    out: dict[str, str] = {}

    def walk(kind: T.DataType, path: str):
        inner = kind
        while isinstance(inner, T.ArrayType):
            inner = inner.elementType
        if isinstance(inner, T.StructType):
            for f in inner.fields:
                walk(f.dataType, f"{path}.{f.name}" if path else f.name)
        else:
            out[path] = kind.simpleString()

    walk(schema, "")
    return out


def flatten(df: DataFrame) -> DataFrame:
    """Every leaf as a top-level column named by its dotted path."""
    return df.select(*(F.col(quote(*n.split("."))).alias(n) for n in flatten_schema(df.schema)))


def project_for_write(df: DataFrame, include=(), exclude=()) -> DataFrame:
    """Include / exclude on the way out: like :func:`project_fields`, and map keys count as fields."""
    out = project_fields(df, include, exclude)
    changes = {
        f.name: _filter_keys(F.col(quote(f.name)), f.name, include, exclude)
        for f in out.schema.fields
        if isinstance(f.dataType, T.MapType) and isinstance(f.dataType.keyType, T.StringType)
    }
    return out.withColumns(changes) if changes else out


def _filter_keys(column: Column, path: str, include, exclude) -> Column:
    def like(key: Column, patterns) -> Column:
        name = F.concat(F.lit(path + "."), key)
        tests = [name.rlike("(?s)^" + ".*".join(map(_literal, p.split("*"))) + "$") for p, _ in numbered(patterns)]
        result = F.lit(False)
        for t in tests:
            result = result | t
        return result

    def keep(key: Column, _value: Column) -> Column:
        wanted = like(key, include) if include else F.lit(True)
        return wanted & ~like(key, exclude)

    return F.map_filter(column, keep)


def _literal(text: str) -> str:
    return re.sub(r"([^\w])", r"\\\1", text)


def source_filter(df: DataFrame, fields, projected=None) -> DataFrame:
    """A user's own list of source fields. It cannot be combined with another projection."""
    if projected:
        raise ValueError("a source filter cannot be combined with include / exclude or selected columns")
    return project_fields(df, include=[p for f in fields for p in (f, f + ".*")])
