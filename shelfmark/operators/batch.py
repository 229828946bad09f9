"""Several rows for one document id inside one batch, without ever sending all rows of an id to one
task: folding is a partial aggregate, ranking is two-level over salted groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.fields import columns_of, quote
from ..sources.catalog import literal, scratch

SALT = 64
HOT_ROWS = 1_000_000


def hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(hashable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def row_hash(df: DataFrame) -> Column:
    """Hash of a row's content; columns Spark cannot hash count with their JSON text."""
    parts = []
    for f in df.schema.fields:
        column = F.col(quote(f.name))
        parts.append(column if hashable(f.dataType) else F.to_json(F.struct(column)))
    return F.xxhash64(*parts)


def order_key(df: DataFrame, order) -> Column:
    """One comparable struct: the order columns, then a hash of the row so that ties are settled
    the same way on every run."""
    names = [order] if isinstance(order, str) else list(order)
    return F.struct(*(F.col(quote(n)) for n in names), row_hash(df).alias("__tie"))


def latest(df: DataFrame, id: str, order=None, first: bool = False) -> DataFrame:
    """One row per id: the last (or ``first``) by ``order``. Without an order, two rows of one id fail
    the job."""
    others = [c for c in df.columns if c != id]
    if not others:
        return df.select(id).distinct()
    body = F.struct(*(F.col(quote(c)) for c in others))
    groups = df.groupBy(F.col(quote(id)).alias(id))
    if order is None:
        kept = groups.agg(F.any_value(body).alias("__row"), F.count(F.lit(1)).alias("__n"))
        kept = kept.where(_single(id))
    else:
        pick = F.min_by if first else F.max_by
        kept = groups.agg(pick(body, order_key(df, order)).alias("__row"))
    return kept.select(
        *(F.col(quote(c)) if c == id else F.col("__row").getField(c).alias(c) for c in df.columns)
    )


def _single(id: str) -> Column:
    """True, or the job fails. A filter, so that the frame stays partitioned by its id column."""
    text = F.concat(F.lit("several documents with id "), F.col(quote(id)).cast("string"), F.lit("; name an order column"))
    return F.when(F.col("__n") == 1, True).otherwise(F.raise_error(text).cast("boolean"))


def all_but_first(df: DataFrame, id: str, order=None) -> DataFrame:
    """Every row that is not the first of its id (the one ``latest(first=True)`` gives).

    Rows are ranked per (id, salt) first; then only the leaders of an id, at most ``SALT``, meet in one
    group, while all others stay in their salted groups. The salt differs by input partition, so that even
    identical copies of one row are spread."""
    if order is None:  # latest() has made sure that ids do not repeat
        return df.limit(0)
    names = [order] if isinstance(order, str) else list(order)
    ranking = [F.col(quote(n)) for n in names] + [F.col("__tie")]
    key = F.col(quote(id))
    salted = df.withColumn("__tie", row_hash(df))
    salted = salted.withColumn("__salt", F.pmod(F.xxhash64(F.spark_partition_id(), "__tie"), F.lit(SALT)))
    ranked = salted.withColumn("__local", F.row_number().over(Window.partitionBy(key, "__salt").orderBy(*ranking)))
    ranked = ranked.withColumn("__group", F.when(F.col("__local") == 1, F.lit(-1)).otherwise(F.col("__salt")))
    ranked = ranked.withColumn("__rank", F.row_number().over(Window.partitionBy(key, "__group").orderBy(*ranking)))
    return ranked.where((F.col("__local") > 1) | (F.col("__rank") > 1)).select(*columns_of(df))


def in_pieces(df: DataFrame, id: str, order) -> DataFrame:
    """The rows with ``__order`` (a comparable key) and ``__piece``: all rows sorted by id and order, cut into the pieces of
    one range partitioning and written. An id with very many rows spans several pieces, in order, so nothing that
    goes through the rows of an id one after the other has to hold them all."""
    spark = df.sparkSession
    ordered = df.withColumn("__order", order_key(df, order)).repartitionByRange(F.col(quote(id)), F.col("__order"))
    path = scratch(spark, "pieces")
    ordered.withColumn("__piece", F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(literal(path))


def numbered_in_pieces(pieces: DataFrame, id: str) -> DataFrame:
    """Adds ``__rank``, the number of a row among those of its id, from 0."""
    key = F.col(quote(id))
    held = pieces.groupBy(key.alias(id), "__piece").agg(F.count(F.lit(1)).alias("__held"))
    before = Window.partitionBy(key).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(key, "__piece", F.coalesce(F.sum("__held").over(before), F.lit(0)).alias("__start"))
    local = F.row_number().over(Window.partitionBy(key, "__piece").orderBy("__order")) - 1
    ranked = pieces.withColumn("__local", local).join(starts, [id, "__piece"])
    return ranked.withColumn("__rank", F.col("__start") + F.col("__local")).drop("__start", "__local")


def highest_before(pieces: DataFrame, id: str, value: str) -> DataFrame:
    """Adds ``__before``, the highest ``value`` in earlier rows of the id; null for the first."""
    key, earlier = F.col(quote(id)), (Window.unboundedPreceding, -1)
    held = pieces.groupBy(key.alias(id), "__piece").agg(F.max(quote(value)).alias("__high"))
    carried = F.max("__high").over(Window.partitionBy(key).orderBy("__piece").rowsBetween(*earlier))
    starts = held.select(key, "__piece", carried.alias("__carried"))
    local = F.max(quote(value)).over(Window.partitionBy(key, "__piece").orderBy("__order").rowsBetween(*earlier))
    found = pieces.withColumn("__local", local).join(starts, [id, "__piece"])
    return found.withColumn("__before", F.greatest("__local", "__carried")).drop("__local", "__carried")


def fold(df: DataFrame, id: str, order, write_null: bool = False) -> DataFrame:
    """All partial documents of an id applied in order: per leaf, the last value given. With
    ``write_null`` a null is a value too."""
    key = order_key(df, order)

    def last(column: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType) and not write_null:
            parts = [last(column.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
            return F.when(F.bool_or(column.isNotNull()), F.struct(*parts))
        if write_null:
            return F.max_by(F.struct(column.alias("v")), key)["v"]
        return F.max_by(column, F.when(column.isNotNull(), key))

    others = [f for f in df.schema.fields if f.name != id]
    if not others:
        return df.select(id).distinct()
    return (
        df.groupBy(F.col(quote(id)).alias(id))
        .agg(*(last(F.col(quote(f.name)), f.dataType).alias(f.name) for f in others))
        .select(*columns_of(df))
    )


def absent_rows(rows: DataFrame, keys: DataFrame, id: str) -> DataFrame:
    """All rows whose id is not among ``keys`` (one row per id), when an id may repeat without bound.

    Ids with more than ``HOT_ROWS`` rows are joined by broadcast: there are at most
    ``rows / HOT_ROWS`` of them, so that list is small whatever the data."""
    hot = (
        rows.groupBy(F.col(quote(id)).alias(id)).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > HOT_ROWS).select(id)
    )
    cold_rows = rows.join(F.broadcast(hot), id, "left_anti").join(keys, id, "left_anti")
    hot_present = keys.join(F.broadcast(hot), id, "left_semi")
    hot_absent = hot.join(hot_present, id, "left_anti")
    return cold_rows.unionByName(rows.join(F.broadcast(hot_absent), id, "left_semi"))
