"""Documents as raw JSON or as pairs, and the way back from JSON text to typed rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.decode import (
    NUMERIC_TYPES,
    blank_to_null,
    detect_geo_point,
    detect_geo_shape,
    geo_shape,
    geo_value,
    join_value,
    number_to_bool,
    parse_bool,
    parse_date,
    parse_date_nanos,
)
from ..functions.documents import document
from ..functions.fields import quote
from ..operators.project import matched_depth, numbered
from .mapping import Field, filter_mapping, leaf_type, parse_mapping, to_schema

CORRUPT = "_malformed"


def with_metadata(
    df: DataFrame, id: str = "_id", field: str = "_metadata", index: str | None = None, version: bool = False
) -> DataFrame:
    """Adds the hit metadata as one ``map<string,string>`` column."""
    entries = {"_index": F.col("_index") if index is None and "_index" in df.columns else F.lit(index)}
    entries["_id"] = F.col(quote(id))
    if "_routing" in df.columns:
        entries["_routing"] = F.col("_routing")
    if version:
        entries["_version"] = F.col("_version") if "_version" in df.columns else F.lit(1)
    pairs = [x for k, c in entries.items() for x in (F.lit(k), c.cast("string"))]
    whole = F.create_map(*pairs).cast("map<string,string>")
    return df.withColumn(field, F.map_filter(whole, lambda k, v: v.isNotNull()))


def read_json_docs(df: DataFrame, id: str = "_id", metadata: bool = False, millis: bool = False) -> DataFrame:
    """``(_id, json)`` pairs; with ``metadata`` the document carries a nested ``_metadata``."""
    if metadata:
        source = [n for n in df.columns if n not in ("_index", "_routing", "_version")]
        df = with_metadata(df, id)
        body = document(df, [*source, "_metadata"], millis=millis)
    else:
        body = document(df, millis=millis)
    return df.select(F.col(quote(id)).cast("string").alias("_id"), body.alias("json"))


def read_pairs(df: DataFrame, id: str = "_id") -> DataFrame:
    """``(_id, doc)`` pairs, the document as one struct."""
    return df.select(F.col(quote(id)).cast("string").alias("_id"), F.struct("*").alias("doc"))


FALLIBLE = {*NUMERIC_TYPES, "date", "date_nanos", "binary", "knn_vector", "boolean"}


class _Reader:
    """Value Columns of mapped fields. A field is addressed by a path from ``base`` (the whole document,
    or one element of an array), so that expressions stay small however deep the mapping is."""

    def __init__(self, rich_dates, zone, empty_as_null, as_array, as_array_exclude, geo, decoders):
        self.rich_dates, self.zone, self.empty_as_null = rich_dates, zone, empty_as_null
        self.arrays, self.arrays_exclude = numbered(as_array), as_array_exclude
        self.geo, self.decoders = geo or {}, decoders or {}

    def depth(self, here: str) -> int:
        return matched_depth(here, self.arrays, self.arrays_exclude) or 0

    def field(self, base: Column, parent: str, f: Field, here: str) -> Column:
        path = parent + _step(f.name)
        return self.array(base, path, f, here, self.depth(here))

    def array(self, base: Column, path: str, f: Field, here: str, depth: int) -> Column:
        """An array of ``depth`` levels; a value with fewer levels is wrapped from the outside."""
        if depth == 0:
            return self.value(base, path, f, here)
        items = F.try_variant_get(base, path, "array<variant>")
        deep_enough = items.isNotNull()
        if depth > 1:
            first = path + "[0]" * (depth - 1)
            deep_enough = deep_enough & F.try_variant_get(base, first, "array<variant>").isNotNull()
        deep = F.transform(items, lambda x: self.array(x, "$", f, here, depth - 1))
        flat = F.array(self.array(base, path, f, here, depth - 1))
        return F.when(deep_enough, deep).when(_present(base, path), flat)

    def value(self, base: Column, path: str, f: Field, here: str) -> Column:
        if f.type == "nested" and f.fields:
            return F.transform(_items(base, path), lambda x: self.struct(x, "$", f, here))
        if f.type in ("object", "nested") and f.fields:
            return self.struct(base, path, f, here)
        return self.leaf(base, path, f, here)

    def struct(self, base: Column, path: str, f: Field, here: str) -> Column:
        parts = [self.field(base, path, c, f"{here}.{c.name}").alias(c.name) for c in f.fields]
        return F.when(_present(base, path), F.struct(*parts))

    def faults(self, base: Column, path: str, f: Field, here: str, value: Column) -> Column | None:
        """Whether some text below ``path`` could not be read, given the value already read from it;
        None when nothing there can fail."""
        if f.raw:
            return None
        if self.depth(here):
            if f.type not in FALLIBLE:
                return None
            return _lost(_text(base, path), value) | F.coalesce(
                F.exists(_items(base, path), lambda x: _lost(_text(x, "$"), self.value(x, "$", f, here))), F.lit(False)
            )
        if f.type == "nested" and f.fields:
            inner = lambda x: self.child_faults(x, "$", f, here, lambda c: self.field(x, "$", c, f"{here}.{c.name}"))
            if inner(base) is None:
                return None
            return F.coalesce(F.exists(_items(base, path), inner), F.lit(False))
        if f.type in ("object", "nested") and f.fields:
            return self.child_faults(base, path, f, here, lambda c: value.getField(c.name))
        return _lost(_text(base, path), value) if f.type in FALLIBLE else None

    def child_faults(self, base: Column, path: str, f: Field, here: str, value_of) -> Column | None:
        found = [self.faults(base, path + _step(c.name), c, f"{here}.{c.name}", value_of(c)) for c in f.fields]
        found = [c for c in found if c is not None]
        return reduce(lambda a, b: a | b, found) if found else None

    def leaf(self, base: Column, path: str, f: Field, here: str) -> Column:
        text = _text(base, path)
        if f.type in self.decoders:
            return self.decoders[f.type](text)
        if f.type in NUMERIC_TYPES:
            return F.try_variant_get(base, path, NUMERIC_TYPES[f.type])
        if f.type == "boolean":
            number = F.try_variant_get(base, path, "double")
            return F.when(_is_number(base, path), number_to_bool(number)).otherwise(parse_bool(text))
        if f.type in ("date", "date_nanos"):
            if not self.rich_dates:
                return blank_to_null(text)
            parsed = parse_date_nanos(text, False) if f.type == "date_nanos" else parse_date(text, self.zone, False)
            millis = F.timestamp_millis(F.try_variant_get(base, path, "bigint"))
            return F.when(_is_number(base, path), millis).otherwise(parsed)
        if f.type == "binary":
            return F.try_to_binary(text, F.lit("base64"))
        if f.type == "knn_vector":
            return F.try_variant_get(base, path, "array<float>")
        if f.type == "join":
            return join_value(F.try_variant_get(base, path, "variant"))
        if f.type == "geo_point":
            shape = self.geo.get(here)
            if shape is None:
                return geo_value(F.try_variant_get(base, path, "variant"))
            return F.try_variant_get(base, path, leaf_type(f, geo=shape).simpleString())
        if f.type == "geo_shape" and self.geo.get(here):
            return geo_shape(text, self.geo[here])
        if f.type == "null":
            return F.lit(None)
        return blank_to_null(text) if self.empty_as_null else text


def _step(name: str) -> str:
    return "['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def _text(base: Column, path: str) -> Column:
    """A scalar as its text, an object or array as JSON text, JSON null as null."""
    return F.try_variant_get(base, path, "string")


def _present(base: Column, path: str) -> Column:
    v = F.try_variant_get(base, path, "variant")
    return v.isNotNull() & ~F.is_variant_null(v)


def _is_number(base: Column, path: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(base, path, "variant"))
    return kind.startswith("BIGINT") | kind.startswith("D") & ~kind.startswith("DATE")


def _items(base: Column, path: str) -> Column:
    """The elements of an array; a single value counts as an array of one."""
    one = F.try_variant_get(base, path, "variant")
    return F.coalesce(F.try_variant_get(base, path, "array<variant>"), F.when(_present(base, path), F.array(one)))


def _lost(text: Column, value: Column) -> Column:
    """A value that is null although there is text: only then is the text looked at."""
    return value.isNull() & blank_to_null(text).isNotNull()


def parse_docs(
    df: DataFrame,
    json_col: str = "json",
    mapping=None,
    *,
    unmapped: str = "ignore",
    on_error: str | Column | Callable[[Column], Column] = "fail",
    tries: int = 1,
    include=(),
    exclude=(),
    rich_dates: bool = True,
    zone: str | None = None,
    empty_as_null: bool = True,
    as_array=(),
    as_array_exclude=(),
    geo: dict[str, str] | None = None,
    decoders: dict[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """JSON text documents as typed rows; the frame's other columns are kept.

    A document is malformed when it is not a JSON object or when a value cannot be read as its
    mapped type. ``on_error``: ``fail`` the job, ``skip`` the document, ``keep`` it with the flag
    ``_malformed``, or an expression giving the edited text to read instead, up to ``tries`` times (what is still
    malformed then fails). Only malformed documents are edited and read again. ``unmapped="keep"`` adds the fields
    outside the mapping, as JSON text by their dotted name, in ``_unmapped``; of an array of objects, all values of such a
    field as one JSON array. ``decoders`` replaces the decoding of a document type by a Column -> Column
    function on the text. In dates, a JSON number is epoch milliseconds and JSON text an ISO date."""
    fields = filter_mapping(parse_mapping(mapping), include, exclude)
    reader = _Reader(rich_dates, zone, empty_as_null, as_array, as_array_exclude, geo, decoders)
    repair = on_error if not isinstance(on_error, str) else None
    if repair is None and on_error not in ("fail", "skip", "keep"):
        raise ValueError(f"unknown on_error [{on_error}]")
    if unmapped not in ("ignore", "keep"):
        raise ValueError(f"unknown unmapped [{unmapped}]")

    source = F.col(quote(json_col)).cast("string")  # JSON may arrive as bytes
    kept = [c for c in df.columns if c != json_col]
    work = df.withColumn("__json", source)
    work = _read(work, fields, reader)
    for _ in range(tries if repair is not None else 0):
        work = _read_again(work, fields, reader, repair(F.col("__json")) if callable(repair) else repair)

    columns = []
    for f in fields:
        value = F.col("__v").getField(f.name)
        if not decoders:
            value = value.cast(to_schema([f], as_array, as_array_exclude, rich_dates, geo)[0].dataType)
        columns.append(value.alias(f.name))
    if unmapped == "keep":
        columns.append(_unmapped(F.col("__doc"), "$", fields, "").alias("_unmapped"))
    flag = _malformed(fields, reader)
    if on_error == "skip":
        work = work.where(~flag)
    elif on_error == "keep":
        columns.append(flag.alias(CORRUPT))
    else:
        reason = F.concat(F.lit("malformed document: "), F.coalesce("__json", F.lit("null")))
        work = work.where(F.when(flag, F.raise_error(reason).cast("boolean")).otherwise(True))
    return work.select(*kept, *columns)


def _read(work: DataFrame, fields, reader: _Reader) -> DataFrame:
    """Adds the parsed document (``__doc``) and the values read from it (``__v``).

    Each is made by a one-element explode, which Spark keeps as a step of its own. As plain columns they
    would be inlined into every filter pushed below them, parsing the text again for each use."""
    work = _step_of(work, "__doc", F.try_parse_json("__json"))
    values = _values(fields, reader)
    return _step_of(work, "__v", values) if values is not None else work


def _values(fields, reader: _Reader) -> Column | None:
    values = []
    for f in fields:
        raw = F.get_json_object("__json", "$" + _step(f.name))
        values.append((raw if f.raw else reader.field(F.col("__doc"), "$", f, f.name)).alias(f.name))
    return F.struct(*values) if values else None


def _step_of(work: DataFrame, name: str, value: Column) -> DataFrame:
    """The frame with a column that is computed in a step of its own."""
    others = [F.col(quote(c)) for c in work.columns if c != name]
    return work.select(*others, F.explode(F.array(value)).alias(name))


def _read_again(work: DataFrame, fields, reader: _Reader, fixed: Column) -> DataFrame:
    """Malformed documents edited and read once more; of the others everything stays as it was read."""
    flag = F.col("__flag")
    work = _step_of(work, "__flag", _malformed(fields, reader))
    work = _step_of(work, "__json", F.when(flag, fixed).otherwise(F.col("__json")))
    work = _step_of(work, "__doc", F.when(flag, F.try_parse_json("__json")).otherwise(F.col("__doc")))
    values = _values(fields, reader)
    if values is not None:
        work = _step_of(work, "__v", F.when(flag, values).otherwise(F.col("__v")))
    return work.drop("__flag")


def _malformed(fields, reader: _Reader) -> Column:
    doc = F.col("__doc")
    bad = doc.isNull() | ~F.ltrim(F.col("__json"), F.lit(" \t\r\n")).startswith("{")
    for f in fields:
        fault = reader.faults(doc, "$" + _step(f.name), f, f.name, F.col("__v").getField(f.name))
        bad = bad if fault is None else bad | fault
    return F.coalesce(bad, F.lit(True))


def _unmapped(base: Column, path: str, fields, prefix: str) -> Column:
    """Fields outside the mapping at ``path`` and in all mapped objects below it, by dotted name; null where there is
    no object."""
    every = F.try_variant_get(base, path, "map<string,variant>")
    known = [f.name for f in fields]
    rest = F.map_filter(every, lambda k, v: ~k.isin(known)) if known else every
    own = F.transform_values(F.transform_keys(rest, lambda k, v: F.concat(F.lit(prefix), k)), lambda k, v: F.to_json(v))
    inner = [_unmapped_below(base, path + _step(f.name), f, f"{prefix}{f.name}.") for f in fields if f.type in ("object", "nested") and f.fields]
    none = F.create_map().cast("map<string,string>")
    return F.when(every.isNotNull(), F.map_concat(own, *(F.coalesce(m, none) for m in inner))) if inner else own


def _unmapped_below(base: Column, path: str, f: Field, prefix: str) -> Column:
    """The same of one object, or of an array of objects: there the values of a name are one JSON array."""
    each = F.transform(F.try_variant_get(base, path, "array<variant>"), lambda x: _unmapped(x, "$", f.fields, prefix))

    def together(maps: Column) -> Column:
        names = F.array_distinct(F.flatten(F.transform(maps, lambda m: F.map_keys(m))))
        values = lambda n: F.filter(F.transform(maps, lambda m: m[n]), lambda v: v.isNotNull())
        return F.map_from_arrays(names, F.transform(names, lambda n: F.concat(F.lit("["), F.array_join(values(n), ","), F.lit("]"))))

    several = together(F.filter(each, lambda m: m.isNotNull()))
    return F.when(each.isNotNull(), several).otherwise(_unmapped(base, path, f.fields, prefix))


def detect_geo(df: DataFrame, json_col: str, mapping) -> dict[str, str]:
    """Format of each geo field of the mapping, by its dotted name; all documents that have the field must agree
    on one. What it returns is the ``geo`` argument of :func:`parse_docs`."""
    found = {}
    for name, kind in _geo_fields(parse_mapping(mapping), ""):
        path = "$" + "".join(_step(p) for p in name.split("."))
        text = df.select(F.get_json_object(F.col(quote(json_col)).cast("string"), path).alias("value"))
        detected = (detect_geo_point if kind == "geo_point" else detect_geo_shape)(text, "value")
        if detected:
            found[name] = detected
    return found


def _geo_fields(fields, parent: str):
    for f in fields:
        if f.type in ("geo_point", "geo_shape"):
            yield parent + f.name, f.type
        elif f.type == "object":
            yield from _geo_fields(f.fields, parent + f.name + ".")


def mapped_schema(mapping, **options) -> T.StructType:
    return to_schema(parse_mapping(mapping), **options)
