"""Where a dotted field lives in a frame's schema, and how its values compare with literals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F, types as T

NUMERIC = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
)
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def quote(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def columns_of(df) -> list[Column]:
    """The frame's columns, whatever characters their names hold."""
    return [F.col(quote(c)) for c in df.columns]


def locate(schema: T.StructType, name: str) -> tuple[Column, T.DataType, int]:
    """Column, leaf type and array depth of a (dotted) field; KeyError when it does not exist."""
    if name in schema.fieldNames():
        parts, kind = [name], schema[name].dataType
    else:
        parts, kind = [], schema
        for part in name.split("."):
            while isinstance(kind, T.ArrayType):
                kind = kind.elementType
            if isinstance(kind, T.MapType):
                kind = kind.valueType
            elif isinstance(kind, T.StructType) and part in kind.fieldNames():
                kind = kind[part].dataType
            else:
                raise KeyError(name)
            parts.append(part)
    return F.col(quote(*parts)), *_depth(schema, parts)


def _depth(schema: T.DataType, parts: list[str]) -> tuple[T.DataType, int]:
    kind, depth = schema, 0
    for part in parts:
        while isinstance(kind, T.ArrayType):
            kind, depth = kind.elementType, depth + 1
        kind = kind.valueType if isinstance(kind, T.MapType) else kind[part].dataType
    while isinstance(kind, T.ArrayType):
        kind, depth = kind.elementType, depth + 1
    return kind, depth


def literal(value, kind: T.DataType) -> Column:
    """``value`` as a foldable literal of the field's own type, so that comparisons reach the
    Parquet reader without a cast around the column. A value that cannot be of that type becomes
    null, which matches nothing."""
    null = F.lit(None).cast(kind)
    if value is None:
        return null
    if isinstance(kind, T.BooleanType):
        if isinstance(value, str):
            return {"true": F.lit(True), "false": F.lit(False)}.get(value.lower(), null)
        return F.lit(bool(value))
    if isinstance(kind, NUMERIC):
        if isinstance(value, bool):
            return null
        if isinstance(value, str):
            try:
                value = float(value) if not value.strip().lstrip("+-").isdigit() else int(value)
            except ValueError:
                return null
        return _number(value, kind)
    if isinstance(kind, TEMPORAL):
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            value = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=value)
            text = value.isoformat() + ("Z" if isinstance(kind, T.TimestampType) else "")
        else:
            text = value.isoformat() if isinstance(value, dt.date) else str(value)
        return F.lit(text).try_cast(kind)
    if isinstance(kind, T.StringType):
        return F.lit(_as_text(value))
    return F.lit(value)


_WHOLE_BITS = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}


def _number(value, kind: T.DataType) -> Column:
    """A number as the field's own type where that keeps its value; otherwise as it is, so that bounds
    beyond the type's range still compare."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.lit(float(value)).cast(kind)
    bits = _WHOLE_BITS.get(type(kind))
    if bits is not None and float(value).is_integer() and -(1 << bits) <= int(value) < 1 << bits:
        return F.lit(int(value)).cast(kind)
    return F.lit(value if isinstance(value, float) or abs(value) < 1 << 63 else float(value))


def _as_text(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, dt.date):
        return value.isoformat()
    return str(value)


class Fields:
    """The fields of one frame as predicates see them.

    ``text`` names the analyzed fields (matched by lower-cased word); every other string field is
    matched by whole value. ``mode`` selects how engine-side filters are rendered: ``analyzed``,
    ``strict`` or ``exact`` (plain Spark semantics).
    """

    def __init__(self, schema: T.StructType, text=(), mode: str = "analyzed"):
        self.schema, self.text, self.mode = schema, frozenset(text), mode

    def with_mode(self, mode: str) -> "Fields":
        return Fields(self.schema, self.text, mode)

    def kind(self, name: str) -> T.DataType | None:
        try:
            return locate(self.schema, name)[1]
        except KeyError:
            return None

    def is_text(self, name: str) -> bool:
        return name in self.text

    def strings(self) -> list[str]:
        """Dotted names of all string fields outside maps."""
        names: list[str] = []

        def walk(kind, path):
            while isinstance(kind, T.ArrayType):
                kind = kind.elementType
            if isinstance(kind, T.StructType):
                for f in kind.fields:
                    walk(f.dataType, path + [f.name])
            elif isinstance(kind, T.StringType):
                names.append(".".join(path))

        walk(self.schema, [])
        return names

    def any_value(self, name: str, test) -> Column:
        """``test`` on the field's value, or on some element when it holds arrays. A field the
        frame does not have never matches."""
        try:
            column, kind, depth = locate(self.schema, name)
        except KeyError:
            return F.lit(False)
        if depth == 0:
            return test(column, kind)
        for _ in range(depth - 1):
            column = F.flatten(column)
        return F.exists(column, lambda x: test(x, kind))

    def column(self, name: str) -> Column:
        return locate(self.schema, name)[0]
