"""Limits, stable pages and bounded slices of a scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.fields import literal, quote
from .batch import SALT

GROUP_LIMIT = 100  # up to here it is enough that Spark cuts each group to n rows per task before the shuffle
MAX_GROUPS = 10_000
MAX_PARTITIONS = 100_000


def limit_per_partition(df: DataFrame, n: int, by, order: str = "_id") -> DataFrame:
    """The first ``n`` rows of each group by the unique column ``order``. A large ``n`` is cut within
    salted parts of a group first, so no task sees a whole hot group."""
    names = [by] if isinstance(by, str) else list(by)
    keys = [F.col(quote(c)) for c in names]
    ordering = F.col(quote(order))
    if n > GROUP_LIMIT:
        part = F.pmod(F.xxhash64(ordering), F.lit(SALT))
        df = (
            df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys, part).orderBy(ordering)))
            .where(F.col("__rn") <= n)
            .drop("__rn")
        )
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(ordering)))
    return ranked.where(F.col("__rn") <= n).drop("__rn")


def page_after(df: DataFrame, after_id, size: int, id: str = "_id") -> DataFrame:
    """The next ``size`` rows by id, after ``after_id`` (None: from the start)."""
    column = F.col(quote(id))
    rest = df if after_id is None else df.where(column > literal(after_id, df.schema[id].dataType))
    return rest.orderBy(column).limit(size)


def slice_counts(df: DataFrame, max_docs: int, by) -> DataFrame:
    """Per group: its rows, and into how many slices it is cut: rows // max_docs, at least one."""
    names = [by] if isinstance(by, str) else list(by)
    counts = df.groupBy(*(F.col(quote(c)).alias(c) for c in names)).agg(F.count(F.lit(1)).alias("docs"))
    return counts.withColumn("slices", F.greatest(F.lit(1), F.floor(F.col("docs") / max_docs)).cast("bigint"))


def slice_scan(df: DataFrame, max_docs: int, by, id: str = "_id") -> DataFrame:
    """Spreads the rows so that a partition holds one slice (``_slice``) of one group, fewer than about
    two times ``max_docs`` rows.

    Only group counts are looked at beforehand. Up to ``MAX_GROUPS`` groups they are broadcast and every
    slice gets its own partition. With more groups, those with over 1 / ``MAX_GROUPS`` of all rows (so at most
    ``MAX_GROUPS``) are still broadcast, the others are joined, and slices are hashed to partitions."""
    if max_docs < 1:
        raise ValueError("max_docs must be positive")
    names = [by] if isinstance(by, str) else list(by)
    counts = slice_counts(df, max_docs, names)
    groups, total, docs = counts.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("slices"), F.lit(1)), F.coalesce(F.sum("docs"), F.lit(0))
    ).first()
    columns = [F.col(quote(c)) for c in df.columns] + [F.col("_slice")]
    if groups <= MAX_GROUPS:
        before = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)  # over at most MAX_GROUPS rows
        counts = counts.withColumn("__first", F.coalesce(F.sum("slices").over(before), F.lit(0)))
        cut = _cut(df, F.broadcast(counts), names, id)
        return cut.repartitionById(int(max(1, total)), (F.col("__first") + F.col("_slice")).cast("int")).select(*columns)
    large = F.col("docs") > docs / MAX_GROUPS
    hot, cold = F.broadcast(counts.where(large)), counts.where(~large)
    same = [F.col(quote(c)).eqNullSafe(F.col(quote(f"__g_{c}"))) for c in names]
    cold_rows = df.join(_keyed(hot, names), same, "left_anti")
    cut = _cut(df, hot, names, id).select(*columns).unionByName(_cut(cold_rows, cold, names, id).select(*columns))
    return cut.repartition(int(min(total, MAX_PARTITIONS)), *(F.col(quote(c)) for c in names), "_slice")


def _keyed(counts: DataFrame, names: list[str]) -> DataFrame:
    extra = [c for c in counts.columns if c not in (*names, "docs")]
    return counts.select(*(F.col(quote(c)).alias(f"__g_{c}") for c in names), *extra)


def _cut(df: DataFrame, counts: DataFrame, names: list[str], id: str) -> DataFrame:
    same = [F.col(quote(c)).eqNullSafe(F.col(quote(f"__g_{c}"))) for c in names]
    joined = df.join(_keyed(counts, names), same, "inner")
    return joined.withColumn("_slice", F.pmod(F.xxhash64(F.col(quote(id))), F.col("slices")))
