"""Document mappings: parsing, resolving several to one, and their Spark schema."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.sql import Column, functions as F, types as T

from ..functions.decode import NUMERIC_TYPES, geo_shape_type
from ..operators.project import is_kept, matched_depth, numbered

# For each document type, its wider types in order of preference.
WIDER: dict[str, tuple[str, ...]] = {
    "boolean": ("keyword",),
    "byte": ("short", "integer", "long", "keyword"),
    "short": ("integer", "long", "keyword"),
    "integer": ("long", "keyword"),
    "long": ("keyword",),
    "token_count": ("long", "keyword"),
    "half_float": ("float", "double", "keyword"),
    "float": ("double", "keyword"),
    "scaled_float": ("double", "keyword"),
    "double": ("keyword",),
    "string": ("keyword",),
    "text": ("keyword",),
    "wildcard": ("keyword",),
    "date": ("keyword",),
    "date_nanos": ("keyword",),
    "binary": ("keyword",),
    "ip": ("keyword",),
    "knn_vector": ("float",),
}

# The other document types a schema can hold. Types outside both lists are dropped.
OTHER_TYPES = ("null", "keyword", "geo_point", "geo_shape", "object", "nested", "join")
COMPOUND = ("object", "nested", "join")
_LAT_LON = T.StructType().add("lat", T.DoubleType()).add("lon", T.DoubleType())
GEO_POINT_TYPES = {
    "lon_lat_array": T.ArrayType(T.DoubleType()),
    "geohash": T.StringType(),
    "lat_lon_string": T.StringType(),
    "lat_lon_object": _LAT_LON,
}
_LEAF_TYPES = {
    "null": T.NullType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
    "knn_vector": T.ArrayType(T.FloatType()),
}
_NUMBERS = {t.simpleString(): t for t in (
    T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()
)}


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    fields: tuple["Field", ...] = ()
    raw: bool = False  # an object kept as raw JSON text


def parse_mapping(mapping) -> tuple[Field, ...]:
    """Fields of a mapping given as dict or JSON text: bare ``{"properties": …}``, wrapped in
    ``mappings``, or under one index name."""
    if isinstance(mapping, tuple):
        return mapping
    body = json.loads(mapping) if isinstance(mapping, str) else mapping
    for _ in range(2):
        if "properties" not in body:
            inner = body.get("mappings") or (next(iter(body.values())) if len(body) == 1 else None)
            if not isinstance(inner, dict):
                break
            body = inner
    if not isinstance(body.get("properties"), dict):
        raise ValueError("cannot find mapping: it has no properties")
    return _properties(body["properties"])


def _properties(properties: dict) -> tuple[Field, ...]:
    parsed = (_field(name, spec) for name, spec in properties.items())
    return tuple(f for f in parsed if f is not None)


def _field(name: str, spec: dict) -> Field | None:
    if not isinstance(spec, dict):
        raise ValueError(f"invalid mapping of field [{name}]")
    kind = str(spec.get("type", "object")).lower()
    if kind not in WIDER and kind not in OTHER_TYPES:
        return None
    if kind in ("object", "nested") and spec.get("enabled") is False:
        return Field(name, "string", raw=True)
    if kind == "join":
        return Field(name, "join", (Field("name", "keyword"), Field("parent", "keyword")))
    if kind in COMPOUND:
        return Field(name, kind, _properties(spec.get("properties", {})))
    return Field(name, kind)


def filter_mapping(fields, include=(), exclude=(), path: str = "") -> tuple[Field, ...]:
    kept = []
    for f in fields:
        here = path + f.name
        if is_kept(here, include, exclude):
            kept.append(replace(f, fields=filter_mapping(f.fields, include, exclude, here + ".")))
    return tuple(kept)


# -- several mappings to one -----------------------------------------------------------------------


def resolve_type(name: str, existing: str, incoming: str) -> str:
    """The narrowest type that holds the values of both types a field is declared with: of the types both can
    widen to, the one that can widen furthest itself. Whole and fractional numbers have only ``keyword`` in common."""
    if existing == incoming:
        return existing
    shared = {existing, *WIDER.get(existing, ())} & {incoming, *WIDER.get(incoming, ())}
    if not shared:
        raise ValueError(f"no type holds both [{existing}] and [{incoming}], the conflicting types of field [{name}]")
    return max(shared, key=lambda t: (len(WIDER.get(t, ())), t))


def merge_mappings(mappings) -> tuple[Field, ...]:
    """The union of several mappings, conflicts resolved in the order given."""
    merged: dict[str, Field] = {}
    for fields in mappings:
        for f in fields:
            merged[f.name] = _merge_field(merged[f.name], f) if f.name in merged else f
    return tuple(merged.values())


def _merge_field(old: Field, new: Field) -> Field:
    kind = resolve_type(old.name, old.type, new.type)
    return Field(old.name, kind, merge_mappings([old.fields, new.fields]), old.raw and new.raw)


# -- mapping to Spark -------------------------------------------------------------------------------


def to_schema(
    fields, as_array=(), as_array_exclude=(), rich_dates: bool = True, geo=None, path: str = ""
) -> T.StructType:
    """Spark schema of a mapping. ``as_array`` lists ``field[:depth]`` to hold as arrays; ``geo`` gives
    the sampled format of geo fields by dotted name (default: normalised point, raw JSON shape)."""
    wanted = numbered(as_array)
    out = T.StructType()
    for f in fields:
        here = path + f.name
        if f.type in COMPOUND:
            inner = to_schema(f.fields, as_array, as_array_exclude, rich_dates, geo, here + ".")
            kind = T.ArrayType(inner) if f.type == "nested" else inner
        else:
            kind = leaf_type(f, rich_dates, (geo or {}).get(here))
        for _ in range(matched_depth(here, wanted, as_array_exclude) or 0):
            kind = T.ArrayType(kind)
        out.add(f.name, kind, True)
    return out


def leaf_type(f: Field, rich_dates: bool = True, geo: str | None = None) -> T.DataType:
    if f.type in NUMERIC_TYPES:
        return _NUMBERS[NUMERIC_TYPES[f.type]]
    if f.type in ("date", "date_nanos"):
        return T.TimestampType() if rich_dates else T.StringType()
    if f.type == "geo_point":
        return GEO_POINT_TYPES[geo] if geo else T.StructType([*_LAT_LON.fields, T.StructField("geohash", T.StringType())])
    if f.type == "geo_shape":
        return geo_shape_type(geo) if geo else T.StringType()
    return _LEAF_TYPES.get(f.type, T.StringType())


# -- Spark schemas to one ---------------------------------------------------------------------------

_DOC_TYPES = {
    T.StringType: "keyword",
    T.ByteType: "byte",
    T.ShortType: "short",
    T.IntegerType: "integer",
    T.LongType: "long",
    T.FloatType: "float",
    T.DoubleType: "double",
    T.BooleanType: "boolean",
    T.BinaryType: "binary",
    T.DateType: "date",
    T.TimestampType: "date",
    T.TimestampNTZType: "date",
}
_SPARK_TYPES = {"keyword": T.StringType(), **{n: _NUMBERS[t] for n, t in NUMERIC_TYPES.items()}}


def common_type(name: str, old: T.DataType, new: T.DataType) -> T.DataType:
    """The type two collections agree on for one field, by the same rules as for mappings."""
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.NullType):
        return new
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return common_schema([old, new], name + ".")
    if isinstance(old, T.ArrayType) or isinstance(new, T.ArrayType):
        a = old.elementType if isinstance(old, T.ArrayType) else old
        b = new.elementType if isinstance(new, T.ArrayType) else new
        return T.ArrayType(common_type(name, a, b))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(
            common_type(name, old.keyType, new.keyType), common_type(name, old.valueType, new.valueType)
        )
    a, b = _DOC_TYPES.get(type(old)), _DOC_TYPES.get(type(new))
    if a is None or b is None:
        raise ValueError(f"field [{name}] has conflicting types [{old.simpleString()}] and [{new.simpleString()}]")
    resolved = resolve_type(name, a, b)
    return old if resolved == a else new if resolved == b else _SPARK_TYPES[resolved]


def common_schema(schemas, path: str = "") -> T.StructType:
    merged: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            seen = merged.get(f.name)
            merged[f.name] = f.dataType if seen is None else common_type(path + f.name, seen, f.dataType)
    return T.StructType([T.StructField(n, k, True) for n, k in merged.items()])


def settled_type(known: T.DataType, new: T.DataType) -> T.DataType:
    """The type a stored field keeps when ``new`` values arrive: its own, plus struct fields it did not
    have yet."""
    if isinstance(known, T.StructType) and isinstance(new, T.StructType):
        fields = [
            T.StructField(f.name, settled_type(f.dataType, new[f.name].dataType) if f.name in new.fieldNames() else f.dataType)
            for f in known.fields
        ]
        return T.StructType(fields + [f for f in new.fields if f.name not in known.fieldNames()])
    if isinstance(known, T.ArrayType):
        return T.ArrayType(settled_type(known.elementType, new.elementType if isinstance(new, T.ArrayType) else new))
    return known


def conform(column: Column, have: T.DataType, want: T.DataType, cast: str = "cast") -> Column:
    """The column as type ``want``: fields added as null, scalars wrapped where an array is wanted.
    ``cast="try_cast"`` turns values that do not fit into null instead of failing."""
    if have == want:
        return column
    if isinstance(want, T.ArrayType):
        if isinstance(have, T.ArrayType):
            return F.transform(column, lambda x: conform(x, have.elementType, want.elementType, cast))
        return F.when(column.isNotNull(), F.array(conform(column, have, want.elementType, cast)))
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        parts = [
            (
                conform(column.getField(f.name), have[f.name].dataType, f.dataType, cast)
                if f.name in have.fieldNames()
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in want.fields
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    return getattr(column, cast)(want)


def conform_frame(df, want: T.StructType, cast: str = "cast"):
    """``df`` with exactly the columns of ``want``."""
    from ..functions.fields import quote

    have = df.schema
    return df.select(
        *(
            (
                conform(F.col(quote(f.name)), have[f.name].dataType, f.dataType, cast)
                if f.name in have.fieldNames()
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in want.fields
        )
    )
