"""Shards of near equal size by a k-d tree over the metadata of documents.

All documents are one node first. A node that is to become k shards is cut in two, along the metadata dimension in which
its documents spread widest, at the weighted median: the place that has k // 2 of every k bytes before it. So
documents of like metadata come into one shard, and shards differ by little more than a document.

Every document has a place in every dimension, a whole number below 2**63. Its top 15 bits are the metadata value: numbers on a
logarithmic scale between the least and the greatest of the table, anything else by the hash of its value, null first.
Below them come hashes of the text (24 bits), of id and text (12) and of the row (12). So documents of one value can be
cut apart anywhere, however many there are, and copies of a text stay next to each other.

A median is found by counting, for all nodes of a level at once: bytes by the top 15 bits, then, within the one
value that holds the median, by the next 15 bits, until that value holds one row or next to nothing of a shard. Each
count is one aggregate with partial sums over a narrow table that is written once (no text in it); of a node
at most 32,768 sums exist at a time. The driver gets one row per node and dimension. Nothing moves the documents.

Slots number the documents of a shard without gaps, in the order of a hash of id and text. They are counted in
many pieces of each shard, so no task has a whole shard.

DataFrame functions only: no Python workers.

Defined results: null texts have no bytes and count as 16, like empty ones; their checksum is 0. Repeated rows are rows
like others, and may come apart at a cut. Null ids and null metadata are values of their own. With fewer documents than
shards some shards stay empty; an empty table gives an empty table. Only the named columns are read, whatever the others
are called.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import query, table, written

VALUE_BITS, TIE_BITS = 15, 48
#: A median is looked for by these leading bits of the places, one after the other.
SHIFTS = (48, 33, 18, 3)
#: Bytes that every document counts in addition to its text.
OVERHEAD = 16
#: A cut may be off by this share of a shard.
TOLERANCE = 0.001
#: Documents of one shard that one task numbers, about.
SLOT_ROWS = 50_000
#: Levels of the tree after which the documents' nodes are written down.
WRITE_EVERY = 8


def _values(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A small table of whole numbers."""
    listed = ", ".join("(" + ", ".join(f"{v}L" for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {listed} AS t({names})")


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _scaled(kind: T.DataType, c: Column) -> Column:
    """A number on a logarithmic scale, with its sign; null for NaN."""
    if isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif isinstance(kind, T.TimestampNTZType):
        c = c.cast("timestamp")
    x = c.cast("double")
    return F.when(~F.isnan(x), F.signum(x) * F.log1p(F.abs(x)))


def document_places(docs: DataFrame, dimensions: list[str], *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A written narrow table: ``key`` (of the row), ``id``, ``size``, ``text_crc32``, ``order`` (hash of id and text), ``tie``
    (the lower 48 bits of all places), ``shard`` (0) and the upper bits in each dimension, ``value0``, ``value1`` …"""
    kinds = [docs.schema[d].dataType for d in dimensions]
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    values = [
        _scaled(k, F.col(d)) if _is_number(k) else F.pmod(F.xxhash64(F.col(d).cast("string")), F.lit(2**VALUE_BITS - 2)) + 1
        for k, d in zip(kinds, dimensions)
    ]
    values = [v if _is_number(k) else F.when(F.col(d).isNotNull(), v) for v, k, d in zip(values, kinds, dimensions)]
    raw = docs.select(
        F.monotonically_increasing_id().alias("key"),
        F.col(id).alias("id"),
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(id), body).alias("order"),
        F.xxhash64(body).alias("text_hash"),
        *(v.alias(f"value{i}") for i, v in enumerate(values)),
    )
    tie = (
        F.shiftleft(F.shiftrightunsigned("text_hash", 40), 24)
        + F.shiftleft(F.shiftrightunsigned("order", 52), 12)
        + F.shiftrightunsigned(F.xxhash64("key"), 52)
    )
    rows = written(raw.select("*", tie.alias("tie"), F.lit(0).cast("long").alias("shard")).drop("text_hash"), "places")
    numbers = [f"value{i}" for i, k in enumerate(kinds) if _is_number(k)]
    if not numbers:
        return rows
    low, high = ([f(c).alias(f"{f.__name__}_{c}") for c in numbers] for f in (F.min, F.max))
    bounds = rows.agg(*low, *high).first()
    for c in numbers:
        lo, hi = bounds[f"min_{c}"], bounds[f"max_{c}"]
        if lo is None or hi <= lo:
            share = F.lit(0.0)
        else:
            share = (F.col(c) - F.lit(lo)) / F.lit(hi - lo)
        place = F.floor(F.least(share, F.lit(1.0)) * F.lit(2**VALUE_BITS - 3)) + 1
        rows = rows.withColumn(c, F.when(F.col(c).isNotNull(), place))
    return rows


def _place(n: int, dimension: Column) -> Column:
    """The whole place of a row in a dimension given by its number."""
    values = F.array(*(F.coalesce(F.col(f"value{i}"), F.lit(0)).cast("long") for i in range(n)))
    return F.shiftleft(F.get(values, dimension.cast("int")), TIE_BITS) + F.col("tie")


def _medians(rows: DataFrame, n: int, wanted: dict[int, int], small: float) -> dict[int, tuple[int, int, int]]:
    """For each node (named by its first shard) and the bytes wanted before its cut: dimension, cut, bytes before it."""
    spark, found = rows.sparkSession, {}
    nodes = _values(spark, list(wanted.items()), "node, want")
    held = rows.join(F.broadcast(nodes), rows.shard == nodes.node)
    each = F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("dim"), F.coalesce(f"value{i}", F.lit(0)).cast("long").alias("bin")) for i in range(n))))
    counted = held.select("node", "want", "size", each.alias("e")).select("node", "want", "size", "e.dim", "e.bin")
    crossing = _crossing(counted)
    best = {}
    for r in sorted(crossing, key=lambda r: (r.node, r.low - r.high, r.dim)):
        best.setdefault(r.node, r)  # the widest dimension; of equal ones the first
    state = {k: (r.dim, r.bin, r.before, r.bytes, r.n) for k, r in best.items()}
    for shift, finer in zip(SHIFTS, [*SHIFTS[1:], None]):
        for node in [k for k, (_, _, _, size, count) in state.items() if finer is None or count == 1 or size <= small]:
            dim, place, before, size, _ = state.pop(node)
            after = abs(before + size - wanted[node]) < abs(before - wanted[node])
            found[node] = (dim, (place + after) << shift, before + size * after)
        if not state:
            return found
        some = _values(spark, [(k, s[0], s[1], wanted[k] - s[2]) for k, s in state.items()], "node, dim, inside, want")
        held = rows.join(F.broadcast(some), rows.shard == some.node).withColumn("place", _place(n, F.col("dim")))
        held = held.where(F.shiftright("place", shift) == F.col("inside"))
        counted = held.select("node", "want", "size", "dim", F.shiftright("place", finer).alias("bin"))
        state = {r.node: (r.dim, r.bin, state[r.node][2] + r.before, r.bytes, r.n) for r in _crossing(counted)}
    return found


def _crossing(counted: DataFrame) -> list:
    """Per node and dimension, the bin in which the wanted number of bytes is reached."""
    bins = counted.groupBy("node", "want", "dim", "bin").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    of = Window.partitionBy("node", "want", "dim")
    upto = F.sum("bytes").over(of.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    bins = bins.select("*", upto.alias("upto"), F.min("bin").over(of).alias("low"), F.max("bin").over(of).alias("high"))
    reached = bins.where((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("bytes") < F.col("want")))
    return reached.withColumn("before", F.col("upto") - F.col("bytes")).collect()


def kd_shards(
    docs: DataFrame, dimensions: list[str], *, shards: int | None = None, target_bytes: int | None = None, id: str = "doc_id",
    text: str = "text", tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per document: ``id``, ``size``, ``text_crc32``, ``shard`` (from 0) and ``slot`` (from 0 in each shard).

    Give the number of shards, or the bytes a shard shall have. A cut is off by at most ``tolerance`` of a shard,
    besides the document it falls on."""
    if (shards is None) == (target_bytes is None) or not dimensions or min(shards or 0, target_bytes or 0) < 0 or 0 in (shards, target_bytes):
        raise ValueError("needs dimensions, and one of shards and target_bytes, 1 or more")
    rows = document_places(docs, dimensions, id=id, text=text)
    spark, n = docs.sparkSession, len(dimensions)
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    if shards is None:
        shards = max(1, math.ceil(total / target_bytes))
    small = tolerance * total / shards
    nodes, level = [(0, shards, total)], 0
    while nodes := [x for x in nodes if x[1] - x[0] > 1 and x[2]]:
        wanted = {lo: size * ((hi - lo) // 2) // (hi - lo) for lo, hi, size in nodes}
        cuts = _medians(rows, n, wanted, small)
        table_ = _values(spark, [(lo, cuts[lo][0], cuts[lo][1], lo + (hi - lo) // 2) for lo, hi, _ in nodes], "node, dim, cut, upper")
        moved = rows.join(F.broadcast(table_), rows.shard == table_.node, "left")
        shard = F.when(_place(n, F.col("dim")) >= F.col("cut"), F.col("upper")).otherwise(F.col("shard"))
        rows = moved.withColumn("shard", shard).drop("node", "dim", "cut", "upper")
        level += 1
        if level % WRITE_EVERY == 0:
            rows = written(rows, "nodes")
        halves = [(lo, lo + (hi - lo) // 2, hi, size, cuts[lo][2]) for lo, hi, size in nodes]
        nodes = [x for lo, mid, hi, size, left in halves for x in ((lo, mid, left), (mid, hi, size - left))]
    rows = written(rows.select("key", "id", "size", "text_crc32", "order", "shard"), "shards")
    return with_slots(rows, shards, count).select("id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "slot")


def with_slots(rows: DataFrame, shards: int, count: int) -> DataFrame:
    """Adds ``slot``, the number of a row in its shard by ``order``, then ``key``. A shard is numbered in pieces, ranges
    of ``order``: enough of them for bounded tasks, and for all partitions of a shuffle."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = min(1 << 20, max(math.ceil(count / shards / SLOT_ROWS), math.ceil(8 * partitions / shards)))
    # 31 bits times at most 2**20 stays below 2**63
    piece = F.shiftright((F.shiftright("order", 33) + F.lit(1 << 30)) * F.lit(pieces), 31)
    rows = rows.withColumn("piece", piece)
    sums = rows.groupBy("shard", "piece").agg(F.count("*").alias("held"))
    before = F.sum("held").over(Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("shard", "piece", F.coalesce(before, F.lit(0)).alias("start"))
    number = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("order", "key"))
    numbered = rows.withColumn("number", number)
    return numbered.join(starts, ["shard", "piece"]).withColumn("slot", F.col("start") + F.col("number") - 1)


@query()
def op11_kd_sharding(spark, sf_dir):
    """All documents in 40 shards of near equal bytes, split by language, source and length."""
    placed = kd_shards(table(spark, sf_dir, "documents"), ["lang", "source", "n_chars"], shards=40)
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
