"""Searching and counting a collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.fields import Fields
from ..functions.predicates import as_predicate


def search(
    df: DataFrame,
    query=None,
    text=(),
    strict: bool = False,
    pushdown: bool = True,
    recheck: bool = True,
) -> DataFrame:
    """Rows of ``df`` matching ``query`` (a Predicate, dict, JSON text or ``?q=`` text).

    Engine filters (``equals``, ``is_in``, ``starts_with`` …) are answered by the search side,
    analyzed or ``strict``, and with ``recheck`` once more by plain Spark comparison; ``is_in`` is
    always rechecked. With ``pushdown=False`` only Spark evaluates them.
    """
    fields = Fields(df.schema, text, "strict" if strict else "analyzed")
    exact = fields.with_mode("exact")
    for part in as_predicate(query).conjuncts:
        if pushdown:
            df = df.where(part.column(fields))
        if recheck or part.recheck or not pushdown:
            df = df.where(part.column(exact))
    return df


def count_docs(df: DataFrame, query=None, text=(), name: str = "n") -> DataFrame:
    """One row with the number of matching documents; no source column is read beyond those the
    query tests."""
    return search(df, query, text).agg(F.count(F.lit(1)).alias(name))
