"""Keyed writes: one batch of documents against a collection, by document id.

Each function is pure: target frame and source frame in, :class:`WriteResult` out (saving is
``operators.write``). A row that the collection would refuse is data in ``rejected``: the source
columns plus ``_status``, ``_error_type`` and ``_error_reason``.

The target is only ever on the streamed side of its joins. When the source is known to be small the
target is not shuffled at all; otherwise both sides are shuffled once on the id.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.documents import NOT_FOUND, document, field_or_const, json_paths, resolve
from ..functions.fields import columns_of, quote
from ..functions.predicates import as_predicate, negate
from ..sources.catalog import literal, scratch
from ..sources.mapping import common_schema, conform, conform_frame, settled_type
from .batch import absent_rows, all_but_first, fold, highest_before, in_pieces, latest, numbered_in_pieces

REJECTION = ("_status", "_error_type", "_error_reason")
#: Rows of one id whose scripts run in one go.
SCRIPTS = 10_000


@dataclass
class WriteResult:
    target: DataFrame
    rejected: DataFrame
    source: DataFrame
    retry: Callable[[DataFrame, DataFrame], "WriteResult"] | None = None
    retried: list[DataFrame] = field(default_factory=list)

    def stats(self) -> DataFrame:
        """One row: documents and bytes sent, accepted, rejected and retried."""
        parts = [("sent", self.source), ("rejected", self.rejected)] + [("retried", r) for r in self.retried]
        rows = None
        for kind, frame in parts:
            body = [c for c in frame.columns if c not in REJECTION]
            one = frame.select(F.lit(kind).alias("kind"), F.octet_length(document(frame, body)).cast("bigint").alias("bytes"))
            rows = one if rows is None else rows.unionByName(one)

        def docs(kind):
            return F.count(F.when(F.col("kind") == kind, 1))

        def size(kind):
            return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("bytes"))), F.lit(0))

        return rows.agg(
            docs("sent").alias("docs_sent"),
            (docs("sent") - docs("rejected")).alias("docs_accepted"),
            docs("rejected").alias("docs_rejected"),
            docs("retried").alias("docs_retried"),
            size("sent").alias("bytes_sent"),
            (size("sent") - size("rejected")).alias("bytes_accepted"),
        )


# -- shared steps -----------------------------------------------------------------------------------


def reject(df: DataFrame, status: int, error: str, reason: str | Column) -> DataFrame:
    return df.withColumns(
        {
            "_status": F.lit(status),
            "_error_type": F.lit(error),
            "_error_reason": F.lit(reason) if isinstance(reason, str) else reason,
        }
    )


def _conflict(df: DataFrame, id: str) -> DataFrame:
    return reject(
        df, 409, "version_conflict", F.concat(F.col(quote(id)).cast("string"), F.lit(": document already exists"))
    )


def _missing(df: DataFrame, id: str) -> DataFrame:
    return reject(df, 404, "document_missing", F.concat(F.col(quote(id)).cast("string"), F.lit(": document missing")))


def _need_id(id: str | None, operation: str, *frames: DataFrame) -> None:
    if not id:
        raise ValueError(f"[{operation}] finds its documents by a column and so requires an id")
    for df in frames:
        if id not in df.columns:
            raise ValueError(f"operation [{operation}]: id column [{id}] not found in {df.columns}")


def split_unfit(t: T.StructType, s: DataFrame, id: str | None) -> tuple[DataFrame, DataFrame]:
    """Source rows cast to the types the target's fields already have, and the rows that cannot be: without an
    id, or with a value its field's type cannot hold."""
    problems = [(F.col(quote(id)).isNull(), "no id")] if id else []
    casts = {}
    for f in s.schema.fields:
        if f.name in t.fieldNames() and t[f.name].dataType != f.dataType:
            want, column = t[f.name].dataType, F.col(quote(f.name))
            simple = not isinstance(want, (T.StructType, T.ArrayType, T.MapType))
            if not simple:
                casts[f.name] = conform(column, f.dataType, settled_type(want, f.dataType), "try_cast")
                continue
            casts[f.name] = column.try_cast(want)
            problems.append((column.isNotNull() & column.try_cast(want).isNull(), f"failed to parse field [{f.name}]"))
    unfit = F.lit(None).cast("string")
    for test, reason in reversed(problems):
        unfit = F.when(test, reason).otherwise(unfit)
    marked = s.withColumn("__unfit", unfit)
    bad = reject(marked.where("__unfit IS NOT NULL"), 400, "mapper_parsing", F.col("__unfit")).drop("__unfit")
    good = marked.where("__unfit IS NULL").drop("__unfit")
    return (good.withColumns(casts) if casts else good), bad


def is_small(df: DataFrame) -> bool:
    """Whether Spark's own size estimate lets the frame be broadcast. Unknown counts as large."""
    try:
        limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return 0 <= int(str(size)) <= int(str(limit).rstrip("b"))
    except (AttributeError, ValueError, TypeError):
        return False


def present_ids(t: DataFrame, s: DataFrame, id: str) -> DataFrame:
    """Ids of ``s`` that the target has, one row each. Reads only the target's id column."""
    return t.select(id).join(s.select(id).distinct(), id, "left_semi")


def append_ids(t: DataFrame, s: DataFrame) -> DataFrame:
    return t.unionByName(s, allowMissingColumns=True)


def merge_value(old: Column, new: Column, kind: T.DataType, write_null: bool) -> Column:
    """Partial update of one field: structs merge field by field, arrays and scalars are replaced, a
    null changes nothing unless ``write_null``."""
    if isinstance(kind, T.StructType):
        parts = [
            merge_value(old.getField(f.name), new.getField(f.name), f.dataType, write_null).alias(f.name)
            for f in kind.fields
        ]
        merged = F.when(old.isNull(), new).otherwise(F.struct(*parts))
        return F.when(new.isNull(), F.lit(None) if write_null else old).otherwise(merged)
    return new if write_null else F.coalesce(new, old)


def _same(old: Column, new: Column, kind: T.DataType) -> Column:
    def has_map(k):
        if isinstance(k, T.StructType):
            return any(has_map(f.dataType) for f in k.fields)
        return has_map(k.elementType) if isinstance(k, T.ArrayType) else isinstance(k, (T.MapType, T.VariantType))

    return F.to_json(F.struct(old)).eqNullSafe(F.to_json(F.struct(new))) if has_map(kind) else old.eqNullSafe(new)


def _aligned(t: DataFrame, s: DataFrame) -> tuple[DataFrame, DataFrame, T.StructType]:
    """Both frames with the nested fields of either."""
    agreed = common_schema([t.schema, s.schema])
    t_want = T.StructType([agreed[f.name] for f in t.schema.fields])
    s_want = T.StructType([agreed[f.name] for f in s.schema.fields])
    return conform_frame(t, t_want), conform_frame(s, s_want), agreed


def _prefixed(s: DataFrame, id: str) -> DataFrame:
    return s.select(
        F.col(quote(id)).alias(id), *(F.col(quote(c)).alias(f"__s_{c}") for c in s.columns if c != id), F.lit(True).alias("__hit")
    )


def _merged_columns(t: DataFrame, s: DataFrame, agreed, id: str, write_null: bool, version: str | None) -> list[Column]:
    """Columns of target and source merged, over a join of the target with ``_prefixed(s)``."""
    out, changed = [], F.lit(False)
    hit = F.col("__hit").isNotNull()
    for f in agreed.fields:
        old = F.col(quote(f.name)) if f.name in t.columns else F.lit(None).cast(f.dataType)
        if f.name in (id, version) or f.name not in s.columns:
            if f.name != version:
                out.append(old.alias(f.name))
            continue
        new = merge_value(old, F.col(quote(f"__s_{f.name}")), f.dataType, write_null)
        out.append(F.when(hit, new).otherwise(old).alias(f.name))
        changed = changed | ~_same(old, new, f.dataType)
    if version:
        old = F.col(quote(version))
        bumped = F.when(hit & old.isNull(), 1).when(hit & changed, old + 1).otherwise(old)
        out.append(bumped.cast(t.schema[version].dataType).alias(version))
    return out


# -- operations -------------------------------------------------------------------------------------


def write_index(t: DataFrame, s: DataFrame, id: str | None = None, order=None, unique: bool = False) -> WriteResult:
    """Insert or replace whole documents. Without an id column the rows are appended under generated
    ids. Several rows of one id: the last by ``order`` wins. ``unique`` promises that ids do not repeat in
    the source, which saves looking."""
    if id is None:
        added = s.withColumn("_id", F.uuid()) if "_id" in t.columns and "_id" not in s.columns else s
        t2, added, _ = _aligned(t, conform_frame(added, settled_type(t.schema, added.schema)))
        return WriteResult(append_ids(t2, added), _none(s), s)
    _need_id(id, "index", t, s)
    good, bad = split_unfit(t.schema, s, id)
    t2, one, _ = _aligned(t, good if unique else latest(good, id, order))
    kept = t2.join(good.select(id).distinct(), id, "left_anti").select(*columns_of(t2))
    return WriteResult(append_ids(kept, one), bad, s, lambda t, s: write_index(t, s, id, order, unique))


def _none(s: DataFrame) -> DataFrame:
    return reject(s.where(F.lit(False)), 0, "", "")


def write_create(t: DataFrame, s: DataFrame, id: str, order=None) -> WriteResult:
    """Insert only. An id the collection has, or had from an earlier row of the batch, is rejected."""
    _need_id(id, "create", t, s)
    good, bad = split_unfit(t.schema, s, id)
    first, rest = latest(good, id, order, first=True), all_but_first(good, id, order)
    present = present_ids(t, good, id)
    t2, added, _ = _aligned(t, first.join(present, id, "left_anti").select(*columns_of(s)))
    taken = first.join(present, id, "left_semi").select(*columns_of(s))
    rejected = _conflict(taken.unionByName(rest), id).unionByName(bad)
    return WriteResult(append_ids(t2, added), rejected, s, lambda t, s: write_create(t, s, id, order))


def _one_per_id(good: DataFrame, id: str, order, write_null: bool, unique: bool) -> DataFrame:
    if unique:
        return good
    return latest(good, id) if order is None else fold(good, id, order, write_null)


def write_update(
    t: DataFrame, s: DataFrame, id: str, order=None, write_null: bool = False, version: str | None = None, unique: bool = False
) -> WriteResult:
    """Merge the given fields into existing documents; a missing id is rejected. Several rows of one id
    are applied in ``order``."""
    _need_id(id, "update", t, s)
    good, bad = split_unfit(t.schema, s, id)
    t2, one, agreed = _aligned(t, _one_per_id(good, id, order, write_null, unique))
    joined = t2.join(_prefixed(one, id), id, "left")
    target = joined.select(*_merged_columns(t2, one, agreed, id, write_null, version))
    gone = absent_rows(good, present_ids(t, good, id), id).select(*columns_of(s))
    rejected = _missing(gone, id).unionByName(bad)
    return WriteResult(target, rejected, s, lambda t, s: write_update(t, s, id, order, write_null, version, unique))


def write_upsert(
    t: DataFrame, s: DataFrame, id: str, order=None, write_null: bool = False, version: str | None = None, unique: bool = False
) -> WriteResult:
    """Merge into existing documents, insert the others. With a ``version`` column, a document that
    really changes counts one up; an upsert that changes nothing leaves it alone."""
    _need_id(id, "upsert", t, s)
    good, bad = split_unfit(t.schema, s, id)
    t2, one, agreed = _aligned(t, _one_per_id(good, id, order, write_null, unique))
    columns = _merged_columns(t2, one, agreed, id, write_null, version)
    if is_small(good):
        merged = t2.join(_prefixed(one, id), id, "left").select(*columns)
        added = one.join(present_ids(t, good, id), id, "left_anti")
        if version:
            added = added.withColumn(version, F.lit(1).cast(t.schema[version].dataType))
        target = append_ids(merged, added)
    else:
        target = t2.join(_prefixed(one, id), id, "full_outer").select(*columns)
    return WriteResult(target, bad, s, lambda t, s: write_upsert(t, s, id, order, write_null, version, unique))


def write_delete(t: DataFrame, s: DataFrame, id: str | None, include=(), exclude=(), json_input: bool = False) -> WriteResult:
    """Drop documents by id; ids that are not there are not an error."""
    _need_id(id, "delete", t, s)
    if json_input or include or exclude:
        raise ValueError("a delete takes ids only: JSON input and field include / exclude make no sense")
    keys = s.select(id).where(F.col(quote(id)).isNotNull()).distinct()
    return WriteResult(t.join(keys, id, "left_anti").select(*columns_of(t)), _none(s), s)


def delete_by_query(t: DataFrame, query, text=()) -> DataFrame:
    return t.where(negate(as_predicate(query).on(t, text)))


def write_script(
    t: DataFrame,
    s: DataFrame,
    id: str,
    set: dict[str, str | Column],
    params: dict[str, str | Column] | str | None = None,
    upsert: bool = False,
    scripted_upsert: bool = False,
    order=None,
) -> WriteResult:
    """Update documents by expressions. ``set`` maps a field to a SQL text or Column over ``t.<field>``
    (the stored document) and ``params.<name>``; ``params`` maps names to source fields or ``<constants>``
    (or is a text ``name:field, name:<constant>``).

    An absent document is rejected; with ``upsert`` the source row becomes the document; with
    ``scripted_upsert`` the expressions run over an empty document. Several rows of one id need an ``order``: each
    then runs over what the one before it left. That takes scripts given as SQL text."""
    _need_id(id, "update", t, s)
    if order is not None:
        return _scripts_in_order(t, s, id, set, params, upsert, scripted_upsert, order)
    good, bad = split_unfit(t.select(id).schema, s, id)
    one = latest(good, id)
    values = _params(one, params)
    source = [F.col(quote(c)).alias(c) for c in s.columns if c != id]
    side = one.select(
        F.col(quote(id)).alias("__id"),
        (F.struct(*(c.alias(n) for n, c in values.items())) if values else F.struct(F.lit(None).alias("none"))).alias("params"),
        (F.struct(*source) if source else F.struct(F.lit(None).alias("none"))).alias("__source"),
    )
    how = "full_outer" if upsert or scripted_upsert else "left"
    joined = t.withColumn("__stored", F.lit(True)).alias("t").join(side, F.col(f"t.{quote(id)}") == F.col("__id"), how)
    run = F.col("__id").isNotNull() & (F.lit(True) if scripted_upsert else F.col("__stored").isNotNull())
    absent = F.col("__stored").isNull()
    out = [F.coalesce(F.col(f"t.{quote(id)}"), F.col("__id")).alias(id)]
    for name in dict.fromkeys([*t.columns, *set, *(s.columns if upsert and not scripted_upsert else [])]):
        if name == id:
            continue
        old = F.col(f"t.{quote(name)}") if name in t.columns else F.lit(None)
        value = old
        if upsert and not scripted_upsert and name in s.columns:
            initial = F.col("__source").getField(name)
            value = F.when(absent, initial.cast(t.schema[name].dataType) if name in t.columns else initial).otherwise(old)
        if name in set:
            script = F.expr(set[name]) if isinstance(set[name], str) else set[name]
            script = script.cast(t.schema[name].dataType) if name in t.columns else script
            value = F.when(run, script).otherwise(value)
        out.append(value.alias(name))
    rejected = bad
    if how == "left":
        gone = one.join(present_ids(t, good, id), id, "left_anti").select(*columns_of(s))
        rejected = _missing(gone, id).unionByName(bad)
    again = lambda t, s: write_script(t, s, id, set, params, upsert, scripted_upsert)
    return WriteResult(joined.select(*out), rejected, s, again)


def _scripts_in_order(t, s, id: str, set, params, upsert: bool, scripted_upsert: bool, order) -> WriteResult:
    """All scripts of an id, one after the other. The rows of an id are taken in lots of ``SCRIPTS``: a lot is gathered
    per id, run through in one expression, and the documents written before the next lot. Most batches have one."""
    if any(not isinstance(v, str) for v in set.values()):
        raise ValueError("scripts that run in an order are given as SQL text")
    again = lambda t, s: _scripts_in_order(t, s, id, set, params, upsert, scripted_upsert, order)
    shape = write_script(t, s, id, set, params, upsert, scripted_upsert).target.schema
    body = [f for f in shape.fields if f.name != id]
    good, bad = split_unfit(t.select(id).schema, s, id)
    ranked = numbered_in_pieces(in_pieces(good, id, order), id).withColumn("__lot", F.floor(F.col("__rank") / SCRIPTS))
    values = _params(ranked, params)
    rows = ranked.select(
        F.col(quote(id)).alias("__id"), "__lot", "__rank",
        (F.struct(*(c.alias(n) for n, c in values.items())) if values else F.struct(F.lit(None).cast("string").alias("none"))).alias("params"),
        F.struct(*(_typed(F.col(quote(f.name)) if f.name in s.columns else F.lit(None), f) for f in body)).alias("source"),
    )
    lots = (rows.agg(F.max("__lot")).first()[0] or 0) + 1
    inserts = upsert and not scripted_upsert
    stored = t.select(F.col(quote(id)).alias("__key"), F.struct(*(_typed(F.col(quote(f.name)) if f.name in t.columns else F.lit(None), f) for f in body)).alias("__doc"))
    for lot in range(lots):
        element = F.struct("__rank", "params", "source")
        side = rows.where(F.col("__lot") == lot).groupBy("__id").agg(F.collect_list(element).alias("__rows"))
        if lots > 1:
            stored = _written(stored, "scripts")
        joined = stored.join(side, F.col("__key") == F.col("__id"), "full_outer" if upsert or scripted_upsert else "left")
        by_rank = F.array_sort("__rows", lambda a, b: (a["__rank"] - b["__rank"]).cast("int"))
        joined = joined.select(F.coalesce("__key", "__id").alias("__key"), "__doc", by_rank.alias("__rows"), F.col("__key").isNull().alias("__absent"))
        first = F.get("__rows", F.lit(0))["source"]
        empty = F.struct(*(F.lit(None).cast(f.dataType).alias(f.name) for f in body))
        start = F.when(F.col("__absent"), first if inserts else empty).otherwise(F.col("__doc"))
        steps = F.transform("__rows", lambda r: r["params"])
        steps = F.when(F.col("__absent") & F.lit(inserts), F.slice(steps, F.lit(2), F.size("__rows"))).otherwise(steps)
        joined = joined.select("__key", start.alias("__start"), steps.alias("__steps"))
        parts = ", ".join(f"'{_quoted(f.name)}', CAST({f'({set[f.name]})' if f.name in set else f't.{quote(f.name)}'} AS {f.dataType.simpleString()})" for f in body)
        ran = F.expr(f"aggregate(__steps, __start, (t, params) -> named_struct({parts}))")
        stored = joined.select("__key", F.when(F.col("__steps").isNull(), F.col("__start")).otherwise(ran).alias("__doc"))
    target = stored.select(*(F.col("__key" if f.name == id else f"__doc.{quote(f.name)}").alias(f.name) for f in shape.fields))
    rejected = bad
    if not (upsert or scripted_upsert):
        rejected = _missing(absent_rows(good, present_ids(t, good, id), id).select(*columns_of(s)), id).unionByName(bad)
    return WriteResult(target, rejected, s, again)


def _typed(c: Column, f: T.StructField) -> Column:
    return c.cast(f.dataType).alias(f.name)


def _quoted(name: str) -> str:
    return name.replace("\\", "\\\\").replace("'", "\\'")


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(literal(path))


def _params(df: DataFrame, params) -> dict[str, Column]:
    if isinstance(params, str):
        params = dict(p.strip().split(":", 1) for p in params.split(",") if p.strip())
    out = {}
    for name, source in (params or {}).items():
        value = source if isinstance(source, Column) else field_or_const(df, source.strip())
        if value is NOT_FOUND:
            raise ValueError(f"script parameter [{name}]: field [{source}] not found")
        out[name.strip()] = value
    return out


def write_versioned(
    t: DataFrame, s: DataFrame, id: str, version: str, mode: str = "external", order=None
) -> WriteResult:
    """Index guarded by a version column of the source.

    ``external`` / ``external_gt`` need a higher version than the stored one, ``external_gte`` at least
    that, ``internal`` exactly that (and then counts one up), ``force`` takes any.

    With an ``order`` the rows of an id come one after the other, and (external modes) each is judged by the highest
    version before it, stored or accepted: 3 then 5 are both accepted, 5 then 3 rejects one. Without an order,
    and for ``internal``, the highest version of an id is tried and its other rows are rejected."""
    if mode not in ("internal", "external", "external_gt", "external_gte", "force"):
        raise ValueError(f"unknown version type [{mode}]")
    _need_id(id, "index", t, s)
    _need_id(version, "index", t, s)
    good, bad = split_unfit(t.schema, s, id)
    if mode != "force":
        unversioned = good.where(F.col(quote(version)).isNull())
        bad = bad.unionByName(reject(unversioned, 400, "mapper_parsing", f"no version in [{version}]"))
        good = good.where(F.col(quote(version)).isNotNull())
    if order is not None and mode.startswith("external"):
        return _versions_in_order(t, s, good, bad, id, version, mode, order)
    if mode == "force":
        one, lost = latest(good, id, order), good.limit(0)
    else:
        names = [] if order is None else [order] if isinstance(order, str) else list(order)
        ranked = good.withColumn("__high", -F.col(quote(version)))
        one = latest(ranked, id, ["__high", *names], first=True).drop("__high")
        lost = all_but_first(ranked, id, ["__high", *names]).drop("__high")
    kept_type = t.schema[version].dataType
    t2, one, agreed = _aligned(t, one)
    target = _replace_winners(t2, one, agreed, id, version, mode, is_small(good))
    stored = t.select(F.col(quote(id)), F.col(quote(version)).alias("__stored"))
    checked = one.join(stored.join(good.select(id).distinct(), id, "left_semi"), id, "left")
    losers = checked.where(~_wins(F.col(quote(version)), F.col("__stored"), mode)).drop("__stored").select(*columns_of(s))
    conflict = F.concat(F.lit("version conflict, given version "), F.col(quote(version)).cast("string"))
    rejected = reject(losers.unionByName(lost), 409, "version_conflict", conflict).unionByName(bad)
    target = target.withColumn(version, F.col(quote(version)).cast(kept_type))
    return WriteResult(target, rejected, s, lambda t, s: write_versioned(t, s, id, version, mode, order))


def _versions_in_order(t, s, good, bad, id: str, version: str, mode: str, order) -> WriteResult:
    """Every row against the highest of the stored version and those of earlier rows: a rejected row's version is
    not above that, so it takes no part."""
    judged = highest_before(in_pieces(good, id, order), id, version)
    stored = t.select(F.col(quote(id)), F.col(quote(version)).alias("__stored")).join(good.select(id).distinct(), id, "left_semi")
    judged = judged.join(stored, id, "left").withColumn("__bar", F.greatest("__before", "__stored"))
    judged = judged.withColumn("__ok", _wins(F.col(quote(version)), F.col("__bar"), mode))
    losers = judged.where(~F.col("__ok")).select(*columns_of(s))
    accepted = judged.where("__ok").select(*columns_of(s), "__order")
    t2, one, agreed = _aligned(t, latest(accepted, id, [version, "__order"]).drop("__order"))
    target = _replace_winners(t2, one, agreed, id, version, mode, is_small(good))
    target = target.withColumn(version, F.col(quote(version)).cast(t.schema[version].dataType))
    conflict = F.concat(F.lit("version conflict, given version "), F.col(quote(version)).cast("string"))
    rejected = reject(losers, 409, "version_conflict", conflict).unionByName(bad)
    return WriteResult(target, rejected, s, lambda t, s: write_versioned(t, s, id, version, mode, order))


def _wins(new: Column, old: Column, mode: str) -> Column:
    rule = {
        "external": old.isNull() | (new > old),
        "external_gt": old.isNull() | (new > old),
        "external_gte": old.isNull() | (new >= old),
        "internal": old.isNotNull() & (new == old),
        "force": F.lit(True),
    }[mode]
    return F.coalesce(rule, F.lit(False))


def _replace_winners(t, one, agreed, id: str, version: str, mode: str, small: bool) -> DataFrame:
    """The target with the winning source rows in place of the stored ones, in one join."""
    new, old = F.col(quote(f"__s_{version}")), F.col(quote(version))
    win = F.col("__hit").isNotNull() & _wins(new, old, mode)
    columns = []
    for f in agreed.fields:
        have = F.col(quote(f.name)) if f.name in t.columns else F.lit(None).cast(f.dataType)
        given = F.col(quote(f"__s_{f.name}")) if f.name in one.columns and f.name != id else F.lit(None).cast(f.dataType)
        if f.name == version and mode == "internal":
            given = given + 1
        columns.append((have if f.name == id else F.when(win, given).otherwise(have)).alias(f.name))
    side = _prefixed(one, id)
    if not small:
        joined = t.withColumn("__stored", F.lit(True)).join(side, id, "full_outer")
        return joined.where(F.col("__stored").isNotNull() | win).select(*columns)
    replaced = t.join(side, id, "left").select(*columns)
    if mode == "internal":
        return replaced
    return append_ids(replaced, one.join(present_ids(t, one, id), id, "left_anti").select(*columns_of(one)))


def write_json_docs(
    t: DataFrame,
    s: DataFrame,
    json_col: str,
    id: str | None = None,
    mapping=None,
    order: str | None = None,
    include=(),
    exclude=(),
    target_id: str = "_id",
    **parse_options,
) -> WriteResult:
    """Index documents given as JSON text; ``id`` and ``order`` are dotted paths into the text."""
    from ..sources.json_docs import parse_docs

    if include or exclude:
        raise ValueError("field include / exclude does not apply to documents given as JSON")
    paths = [p for p in (id, order) if p]
    found = json_paths(F.col(quote(json_col)).cast("string"), paths)
    if order:  # numbers in the order of numbers (equal as doubles: exactly), other text after them as text
        text = found[-1]
        number = text.try_cast("double")
        found[-1] = F.struct(
            (number.isNull() & text.isNotNull()).alias("is_text"), number.alias("number"), text.try_cast("decimal(38,9)").alias("exact"), text.alias("text")
        )
    metadata = {n: c for n, c in zip([target_id, "__order"][: len(paths)] if id else ["__order"], found)}
    named = s.select(F.col(quote(json_col)).alias("__text"), *(c.alias(n) for n, c in metadata.items()))
    parsed = parse_docs(named, "__text", mapping, **parse_options)
    if id is None:
        return write_index(t, parsed.drop("__order"))
    result = write_index(t, parsed, target_id, "__order" if order else None)
    result.target = result.target.drop("__order")
    return result


# -- row metadata -----------------------------------------------------------------------------------


def with_write_meta(df: DataFrame, id=None, routing=None, parent=None, version=None) -> DataFrame:
    """Adds ``_id``, ``_routing``, ``_parent`` and ``_version``, each from a field path, a ``<constant>``, a
    Column or a callable on the frame."""
    given = {"_id": id, "_routing": routing, "_parent": parent, "_version": version}
    out = {}
    for name, source in given.items():
        if source is None:
            continue
        value = resolve(df, source)
        if value is NOT_FOUND:
            raise ValueError(f"{name}: [{source}] not found")
        out[name] = value if name == "_version" else value.cast("string")
    return df.withColumns(out)


def routing_of(df: DataFrame, routing=None, join: str | None = None) -> Column:
    """The routing of a row: the routing field (a row without one fails), else the parent of the join
    field (a row without one has no routing)."""
    if routing is not None:
        value = resolve(df, routing)
        if value is NOT_FOUND:
            raise ValueError(f"routing [{routing}] not found")
        fail = F.raise_error(F.lit(f"no routing found by [{routing}]")).cast("string")
        return F.coalesce(value.cast("string"), fail)
    parent = resolve(df, f"{join}.parent") if join else NOT_FOUND
    return F.lit(None).cast("string") if parent is NOT_FOUND else parent.cast("string")


def place_by_routing(df: DataFrame, buckets: int, id: str = "_id") -> DataFrame:
    """Rows with one routing value (else id) share a ``_bucket``; write with ``partitionBy("_bucket")``.
    The rebalance lets Spark split a hot bucket over several tasks and files."""
    from ..sources.collections import ROUTING_BUCKET, routing_bucket

    keys = [F.col(c).cast("string") for c in ("_routing", id) if c in df.columns]
    placed = df.withColumn(ROUTING_BUCKET, routing_bucket(F.coalesce(*keys), buckets))
    return placed.hint("rebalance", F.col(ROUTING_BUCKET))
