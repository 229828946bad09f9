"""Decoding of single field values. Everything is a Column expression evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .fields import locate, quote

# The texts that read as false.
FALSE_TEXTS = ("", "false", "0", "off", "no")

# Geo shape name -> (array depth of the coordinates, extra string field).
GEO_SHAPES = {
    "point": (1, None),
    "linestring": (2, None),
    "polygon": (3, "orientation"),
    "multipoint": (2, None),
    "multilinestring": (3, None),
    "multipolygon": (4, None),
    "envelope": (2, None),
    "circle": (1, "radius"),
}

# Numeric document type -> Spark type.
NUMERIC_TYPES = {
    "byte": "tinyint",
    "short": "smallint",
    "integer": "int",
    "long": "bigint",
    "token_count": "bigint",
    "float": "float",
    "half_float": "float",
    "double": "double",
    "scaled_float": "double",
}


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c, F.lit(" \t\n\r\f\x0b")) != "", c)


def empty_as_null(df: DataFrame, cols=None) -> DataFrame:
    """Empty and whitespace-only text becomes null, in the named columns or all string columns."""
    names = cols or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: blank_to_null(F.col(quote(n))) for n in names})


def parse_date(c: Column, zone: str | None = None, digits: bool = True) -> Column:
    """ISO date with optional time and an offset written ``hh:mm``, ``hhmm`` or ``hh``. ``zone`` applies where the text names
    no offset (default: the session time zone). Unreadable text becomes null.

    A number is epoch milliseconds, whatever its length. Text that has lost what it was takes ``digits``: a whole
    number of five or more digits then counts as milliseconds too, four digits as a year."""
    text = F.trim(c.cast("string"))
    moment = _moment(text, zone)
    if digits:
        dated = (F.substring(text, 5, 1) == "-") | (F.length(text) == 4)
        moment = F.when(dated, moment).otherwise(F.timestamp_millis(text.try_cast("bigint")))
    else:
        moment = F.when((F.substring(text, 5, 1) == "-") | text.rlike("^[0-9]{4}$"), moment)
    number = F.typeof(c).rlike("^(tinyint|smallint|int|bigint|float|double|decimal.*)$")
    return F.when(number, F.timestamp_millis(text.try_cast("decimal(38,0)").try_cast("bigint"))).otherwise(moment)


def parse_date_nanos(c: Column, digits: bool = True) -> Column:
    """ISO date, optional time with up to nine fraction digits, UTC unless an offset is given. Spark
    keeps microseconds: the last three digits are cut."""
    return parse_date(c, "UTC", digits)


def _moment(text: Column, zone: str | None) -> Column:
    if zone is None or zone == _session_zone():
        return text.try_cast("timestamp")
    time = F.substring(text, 11, 30)
    day = F.when(F.length(text) == 4, F.concat(text, F.lit("-01-01")))
    day = day.when(F.length(text) == 7, F.concat(text, F.lit("-01"))).otherwise(text)
    full = F.when(time != "", text).otherwise(F.concat(day, F.lit("T00:00:00")))
    zoned = time.contains("+") | time.contains("-") | time.endswith("Z")
    return F.when(zoned, text).otherwise(F.concat(full, F.lit(" " + zone))).try_cast("timestamp")


def _session_zone() -> str | None:
    session = SparkSession.getActiveSession()
    return session.conf.get("spark.sql.session.timeZone") if session else None


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def as_instant(c: Column, kind: T.DataType) -> Column:
    """Timestamp of a date, zoned or zone-less column; zone-less values are taken as UTC whatever
    the session time zone is."""
    if isinstance(kind, T.TimestampType):
        return c
    if _session_zone() in ("UTC", "Etc/UTC", "Z", "+00:00"):
        return c.cast("timestamp")
    second = F.date_part(F.lit("SECOND"), c.cast("timestamp_ntz"))
    parts = [f(c.cast("timestamp_ntz")) for f in (F.year, F.month, F.day, F.hour, F.minute)]
    return F.make_timestamp_ltz(*parts, second, F.lit("UTC"))


def parse_bool(c: Column) -> Column:
    """Extended boolean of a text: blank, false, 0, off and no are false, any other text is true."""
    text = F.lower(F.trim(c.cast("string")))
    return F.when(text.isNotNull(), ~text.isin(list(FALSE_TEXTS)))


def number_to_bool(c: Column) -> Column:
    """A number is true unless its integer part is 0."""
    return c.cast("bigint") != 0


def decode(c: Column, kind: str, zone: str | None = None) -> Column:
    """A value given as text, as the Spark value of document type ``kind``; null when unreadable."""
    if kind in NUMERIC_TYPES:
        return blank_to_null(c.cast("string")).try_cast(NUMERIC_TYPES[kind])
    if kind == "boolean":
        return parse_bool(c)
    if kind == "date":
        return parse_date(c, zone)
    if kind == "date_nanos":
        return parse_date_nanos(c)
    if kind == "binary":
        return F.try_to_binary(c, F.lit("base64"))
    if kind == "knn_vector":
        return vector(c)
    return blank_to_null(c.cast("string"))


def vector(c: Column) -> Column:
    return c.cast("array<float>")


def as_nested(c: Column) -> Column:
    """A nested field given as one object becomes a one-element array; null stays null."""
    return F.when(c.isNotNull(), F.array(c))


def as_array(df: DataFrame, include=(), exclude=()) -> DataFrame:
    """Top-level fields named by ``include`` (``field`` or ``field:depth``, ``*`` allowed) become
    arrays of that depth: null stays null, shallower values are wrapped from the outside."""
    from ..operators.project import numbered, matched_depth

    wanted = numbered(include)
    changes = {}
    for field in df.schema.fields:
        depth = matched_depth(field.name, wanted, exclude)
        if depth is None:
            continue
        _, kind, have = locate(df.schema, field.name)
        column = F.col(quote(field.name))
        for _ in range(max(0, depth - have)):
            column = F.when(column.isNotNull(), F.array(column))
        changes[field.name] = column
    return df.withColumns(changes) if changes else df


def normalize_join(c: Column) -> Column:
    """A join field in short (``"company"``) or long (``{"name":…,"parent":…}``) JSON form, as
    ``struct<name,parent>``. ``c`` is JSON text or a variant; text that is not JSON is the short form."""
    short = F.struct(c.cast("string").alias("name"), F.lit(None).cast("string").alias("parent"))
    return F.when(c.isNotNull(), F.coalesce(let(F.try_parse_json(c), join_value), short))


def join_value(v: Column) -> Column:
    """``struct<name,parent>`` of a variant; null when it is neither a text nor an object."""
    name = F.try_variant_get(v, "$", "string")
    long_form = F.struct(
        F.try_variant_get(v, "$.name", "string").alias("name"),
        F.try_variant_get(v, "$.parent", "string").alias("parent"),
    )
    short_form = F.struct(name.alias("name"), F.lit(None).cast("string").alias("parent"))
    return F.when(long_form["name"].isNotNull(), long_form).when(
        F.schema_of_variant(v).isin("OBJECT<>", "VOID") | name.isNull(), None
    ).otherwise(short_form)


# -- geo --------------------------------------------------------------------------------------------


def geo_point_format(c: Column) -> Column:
    """Format name of a geo point given as JSON text or plain text."""

    def name(v: Column) -> Column:
        text = F.trim(F.coalesce(F.try_variant_get(v, "$", "string"), c))
        return (
            F.when(F.try_variant_get(v, "$", "array<double>").isNotNull(), "lon_lat_array")
            .when(F.try_variant_get(v, "$.lat", "double").isNotNull(), "lat_lon_object")
            .when(text.contains(","), "lat_lon_string")
            .otherwise("geohash")
        )

    return F.when(blank_to_null(c).isNotNull(), let(F.try_parse_json(c), name))


def detect_geo_point(df: DataFrame, column: str) -> str | None:
    """The one format that all values of this field have; None when there is no value. Mixed formats raise."""
    return _only_value(df, geo_point_format(F.col(column)), column)


def _only_value(df: DataFrame, value: Column, column: str) -> str | None:
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low != high:
        raise ValueError(f"field [{column}] mixes the formats [{low}] and [{high}]")
    return low


def geo_point(c: Column) -> Column:
    """Any geo point form as ``struct<lat,lon,geohash>``; a geohash keeps its text and no numbers."""
    plain = F.to_variant_object(F.struct(c.alias("text")))
    return F.when(c.isNotNull(), let(F.coalesce(F.try_parse_json(c), plain), geo_value))


def geo_value(v: Column) -> Column:
    pair = F.try_variant_get(v, "$", "array<double>")
    plain = F.trim(F.coalesce(F.try_variant_get(v, "$.text", "string"), F.try_variant_get(v, "$", "string")))
    halves = F.split(plain, r"\s*,\s*")

    def point(lat, lon, geohash=None):
        return F.struct(
            lat.cast("double").alias("lat"),
            lon.cast("double").alias("lon"),
            (F.lit(None) if geohash is None else geohash).cast("string").alias("geohash"),
        )

    none = F.lit(None)
    return (
        F.when(F.size(pair) >= 2, point(F.get(pair, 1), F.get(pair, 0)))
        .when(
            F.try_variant_get(v, "$.lat", "double").isNotNull(),
            point(F.try_variant_get(v, "$.lat", "double"), F.try_variant_get(v, "$.lon", "double")),
        )
        .when(plain.contains(","), point(F.get(halves, 0).try_cast("double"), F.get(halves, 1).try_cast("double")))
        .when(blank_to_null(plain).isNotNull(), point(none, none, plain))
    )


def geo_shape_type(shape: str) -> T.StructType:
    """Spark type of one kind of geo shape."""
    name = shape.lower().replace("_", "")
    if name not in GEO_SHAPES:
        raise ValueError(f"geo shape [{shape}] is not supported")
    depth, extra = GEO_SHAPES[name]
    coordinates: T.DataType = T.DoubleType()
    for _ in range(depth):
        coordinates = T.ArrayType(coordinates)
    out = T.StructType().add("type", "string").add("coordinates", coordinates)
    return out.add(extra, "string") if extra else out


def geo_shape(c: Column, shape: str) -> Column:
    """A geo shape given as JSON text, as its typed struct."""
    return F.from_json(c, geo_shape_type(shape))


def detect_geo_shape(df: DataFrame, column: str) -> str | None:
    kind = F.lower(F.get_json_object(F.col(column), "$.type"))
    shape = _only_value(df, kind, column)
    if shape is not None and shape not in GEO_SHAPES:
        raise ValueError(f"geo shape [{shape}] is not supported")
    return shape
