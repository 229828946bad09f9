"""Similarity join of documents on word shingles, with a token-group matrix.

A token is a word shingle. Two documents link if ``100 * common >= percent * union`` of their token sets.

1. Blocks of documents ask hash buckets how many sets hold each of their tokens. A linked partner misses at most
   ``(100 - percent) * n / 100`` of a set's n tokens, so a set with more tokens of its own than that has no link and
   leaves: most texts go here, and nothing but hashes has moved.
2. Equal sets are one row from here on. A set's *prefix* is its rarest tokens, one more than it may miss: linked
   sets share a token of both prefixes.
3. Groups: of all holders of a prefix token, the one with the smallest share of tokens of its own is its head. Each
   set is compared with the head it shares most prefix tokens with. Sets so linked are a group, which is connected
   by construction, and takes in most of a family of near copies at a cost in proportion to its size.
4. Token-group matrix: the groups that hold a token in a prefix. A set queries the earlier groups that share a
   prefix token with it. Groups are stored in chunks of bounded size, each with the union of its members' tokens;
   a chunk whose union holds too few of the query's tokens is left shut, the others are opened and the query is
   compared with their members.
5. Components of all links, by contraction.

So pairs inside a group are never listed, and a copy costs one row. Tokens and sets are told apart by 64-bit hashes.

Defined results: null texts and texts without a word have the empty set, are linked with nothing and are
their own component; a text of fewer words than a shingle has the whole sequence as its one token; a null id comes after
all others. Rows of one id are documents of their own: their texts are linked or not like any others, and each row has
the smallest id of its own component. Other columns may be called anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import NULL_ID, counts_of, key_counts, pack_blocks, unpacked_block
from .common import lowered, mixed, passing_tables, prefix_sums, query, span_hashes, table, tidy, word_spans, written
from .components import components

TARGET_BYTES = 4 << 20
#: Tokens in a chunk of a group, and queries that are compared with it in one task.
CHUNK_TOKENS, CHUNK_QUERIES = 250_000, 500


def shingle_sets(payload: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a block's documents, the sorted distinct tokens of each, one after the other, and where they end."""
    ids, lengths, data = unpacked_block(payload)
    data = lowered(data)
    starts, ends, first = word_spans(data, np.concatenate([[0], np.cumsum(lengths)]))
    words = span_hashes(prefix_sums(data), starts, ends)
    n_words = np.diff(first)
    n = np.maximum(n_words - size + 1, (n_words > 0).astype(np.int64))
    row = np.repeat(np.arange(len(n)), n)
    begin = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    tokens = np.full(len(row), size, np.uint64)
    for k in range(size):
        here = k < n_words[row]  # texts with fewer words than a shingle
        at = np.minimum(begin + k, max(0, len(words) - 1))
        tokens = np.where(here, mixed(tokens * np.uint64(0x9E3779B97F4A7C15) + words[at]), tokens) if len(words) else tokens
    order = np.lexsort((tokens, row))
    tokens, row = tokens[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (tokens[1:] != tokens[:-1])
    return ids, tokens[new], np.cumsum(np.bincount(row[new], minlength=len(ids)))


def _digests(tokens: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set, which equal sets share."""
    out = []
    for salt in (0x0123456789ABCDEF, 0xFEDCBA9876543210):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(tokens ^ np.uint64(salt)), dtype=np.uint64)])
        out.append((sums[ends] - sums[np.concatenate([[0], ends[:-1]])]).view(np.int64))
    return out[0], out[1]


def _keys(tokens: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens of a block in the order they are asked for, with bucket and short key. Keys need not be
    unique: a clash only makes a token look more frequent than it is."""
    distinct = np.unique(tokens)
    bucket = (distinct % np.uint64(buckets)).astype(np.int64)
    key = (mixed(distinct) >> np.uint64(32)).astype("<u4")
    order = np.lexsort((key, bucket))
    return distinct[order], bucket[order], key[order]


def token_keys(payload: bytes, size: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, key, and number of a block's different sets, for each distinct token of the block."""
    _, tokens, ends = shingle_sets(payload, size)
    distinct, bucket, key = _keys(tokens, buckets)
    by_token = np.argsort(distinct)
    once = tokens[_first_of_equal(tokens, ends)]
    held = np.bincount(by_token[np.searchsorted(distinct[by_token], once)], minlength=len(distinct))
    return bucket, key, np.minimum(held, 255)


def _first_of_equal(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Marks the tokens of sets that are the first of their kind in the block."""
    pair = np.stack(_digests(tokens, ends), axis=1)
    _, first = np.unique(pair, axis=0, return_index=True)
    keep = np.zeros(len(ends), bool)
    keep[first] = True
    return np.repeat(keep, np.diff(ends, prepend=0))


def candidate_sets(blocks: DataFrame, counts: DataFrame, size: int, percent: int, buckets: int) -> DataFrame:
    """One row per document: id, set size and digests; with prefix and tokens if it can have links."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for payload, found in zip(batch.column("docs"), batch.column("counts")):
                ids, tokens, ends = shingle_sets(payload.as_py(), size)
                distinct, bucket, _ = _keys(tokens, buckets)
                held = counts_of(bucket, found.as_py())
                by_token = np.argsort(distinct)
                held = held[by_token[np.searchsorted(distinct[by_token], tokens)]]
                n = np.diff(ends, prepend=0)
                starts = ends - n
                own = np.concatenate([[0], np.cumsum(held == 1)])
                own = own[ends] - own[starts]
                misses = (100 - percent) * n // 100
                able = (n > 0) & (own <= misses)
                prefixes: list = [None] * len(n)
                sets: list = [None] * len(n)
                for k in np.flatnonzero(able):
                    t, h = tokens[starts[k] : ends[k]], held[starts[k] : ends[k]]
                    shared = np.flatnonzero(h > 1)
                    rarest = shared[np.lexsort((t[shared], h[shared]))[: misses[k] + 1 - own[k]]]
                    prefixes[k] = t[rarest].view(np.int64)
                    sets[k] = t.tobytes()
                one, two = _digests(tokens, ends)
                columns = [ids, n, own, one, two, pa.array(prefixes, pa.list_(pa.int64())), pa.array(sets, pa.binary())]
                columns = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns]
                for at in range(0, len(n), 500):
                    yield pa.RecordBatch.from_arrays([c.slice(at, 500) for c in columns], ["doc_id", "n", "own", "one", "two", "prefix", "tokens"])

    joined = blocks.join(counts, "block", "left").select("docs", "counts")
    return written(joined.mapInArrow(tidy(run), "doc_id long, n long, own long, one long, two long, prefix array<long>, tokens binary"), "token-sets")


def _linked(common: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (n + m - common)


def _may_link(percent: int, n: Column, most: Column, low: Column, high: Column, held: Column) -> Column:
    """Whether a set of n tokens, of which ``most`` occur elsewhere, can link with one of ``low`` to ``high`` tokens of
    which at most ``held`` do: linked sets have ``percent`` / (100 + ``percent``) of both their sizes in common."""
    least = percent * (n + low)
    return (
        (percent * n <= 100 * high) & (percent * low <= 100 * n)
        & ((100 + percent) * most >= least) & ((100 + percent) * held >= least)
    )


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets link."""
    one = sets.select(F.col("rep").alias("a"), F.col("tokens").alias("x"))
    two = sets.select(F.col("rep").alias("b"), F.col("tokens").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(_linked(common, len(x), len(y), percent)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long")


def opened(queries: DataFrame, groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between queries ``rep``, ``target`` and members of the target groups (``rep``, ``grp``)."""
    wanted = queries.select(F.col("target").alias("grp")).distinct()
    members = groups.join(wanted, "grp").join(sets.select("rep", "n", "tokens"), "rep")
    asked = queries.groupBy(F.col("target").alias("grp")).agg(F.count("*").alias("asked"))
    sizes = members.groupBy("grp").agg(F.sum("n").alias("held")).join(asked, "grp").select(
        "grp",
        F.ceil(F.col("held") / CHUNK_TOKENS).alias("chunks"),
        F.ceil(F.col("asked") / CHUNK_QUERIES).alias("lots"),
    )
    sizes = written(sizes, "group-sizes")
    salt = F.xxhash64("rep")
    right = members.join(sizes, "grp").select(
        "grp", F.pmod(salt, F.col("chunks")).alias("chunk"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1)).alias("lot"), "rep", "tokens"
    )
    left = (
        queries.select("rep", F.col("target").alias("grp")).join(sizes, "grp").join(sets.select("rep", "tokens"), "rep")
        .select("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.pmod(salt, F.col("lots")).alias("lot"), F.col("rep").alias("asker"), F.col("tokens").alias("mine"))
    )

    def compare(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(held):
            tokens = [np.frombuffer(t, "<u8") for t in held["tokens"]]
            lengths = np.array(list(map(len, tokens)))
            flat, first = np.concatenate(tokens), np.cumsum(lengths) - lengths
            union = np.unique(flat)
            members = held["rep"].to_numpy()
            for rep, mine in zip(asking["asker"], asking["mine"]):
                mine = np.frombuffer(mine, "<u8")
                place = np.minimum(np.searchsorted(union, mine), len(union) - 1)
                if 100 * int((union[place] == mine).sum()) < percent * len(mine):
                    continue  # the group's union holds too few of the query's tokens
                place = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
                common = np.add.reduceat((mine[place] == flat).astype(np.int64), first)
                hit = np.flatnonzero(_linked(common, len(mine), lengths, percent))
                if len(hit):  # one link joins the query to the group
                    found.append((rep, members[hit[0]]))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    keys = ["grp", "chunk", "lot"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "a long, b long")


def set_classes(docs: DataFrame, id: str, text: str, size: int, percent: int) -> DataFrame:
    """Per document ``doc_id`` (``NULL_ID`` for null), ``n`` (tokens) and ``class``: a number that documents have in common if and
    only if links join them; null without tokens. Sets are named by a hash of their tokens, so ids may repeat."""
    with passing_tables(docs.sparkSession):
        blocks = pack_blocks(docs, id, text)
        total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
        buckets = max(1, -(-total // TARGET_BYTES))
        counts = key_counts(blocks, buckets, lambda payload: token_keys(payload, size, buckets))
        rows = candidate_sets(blocks, counts, size, percent, buckets)
        stats = written(rows.select("doc_id", "n", "one", "two"), "set-names", keep=True)
        able = rows.where(F.col("tokens").isNotNull())
        held_by = stats.where("n > 0").groupBy("one", "two").agg(F.min("doc_id").alias("by"))
        able = able.join(held_by, ["one", "two"]).where("doc_id = by").dropDuplicates(["one", "two"])
        sets = written(able.select(F.col("one").alias("rep"), "n", "own", "prefix", "tokens"), "sets", keep=True)
    # ``most`` tokens of a set are held by others: no pair has more in common
    most = (F.col("n") - F.col("own")).alias("most")
    postings = written(sets.select("rep", "n", most, (F.col("own") / F.col("n")).alias("own"), F.explode("prefix").alias("token")), "postings")
    # among the holders of a token, the one with the fewest tokens of its own is the most similar to the others
    shared = postings.groupBy("token").agg(F.min(F.struct("own", "rep", "n", "most")).alias("first"), F.count("*").alias("k")).where("k > 1")
    near = (
        postings.join(shared, "token").where(F.col("rep") != F.col("first.rep"))
        .where(_may_link(percent, F.col("n"), F.col("most"), F.col("first.n"), F.col("first.n"), F.col("first.most")))
        .groupBy(F.col("rep").alias("a"), F.col("first.rep").alias("b"), F.col("first.own").alias("own")).count()
        .groupBy("a").agg(F.max_by("b", F.struct("count", -F.col("own"), -F.col("b"))).alias("b"))
    )
    links = written(verified(near, sets, percent), "links-near")
    grouped = components(links).select(F.col("v").alias("rep"), F.col("c").alias("grp"))
    groups = written(sets.select("rep").join(grouped, "rep", "left").select("rep", F.coalesce("grp", "rep").alias("grp")), "groups")
    held = postings.join(groups, "rep")
    members = held.groupBy("token", "grp").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("most").alias("held"))
    matrix = written(members, "token-groups")
    several = matrix.groupBy("token").agg(F.count("*").alias("k")).where("k > 1").select("token")
    matrix = matrix.join(several, "token")
    queries = (
        held.join(matrix.withColumnRenamed("grp", "target"), "token")
        .where((F.col("target") < F.col("grp")) & _may_link(percent, F.col("n"), F.col("most"), F.col("low"), F.col("high"), F.col("held")))
        .select("rep", "target").distinct()
    )
    links = links.unionByName(opened(written(queries, "group-queries"), groups, sets, percent))
    labels = components(links).select(F.col("v").alias("one"), "c")
    found = stats.join(labels, "one", "left")
    return found.select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("c", "one")).alias("class"))


def similar_documents(docs: DataFrame, *, id: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (the smallest id reachable by links) of every document."""
    with passing_tables(docs.sparkSession):
        found = written(set_classes(docs, id, text, size, percent), "classes", keep=True)
    several = found.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("least"), F.count("*").alias("k"))
    least = several.where("k > 1").select("class", "least")
    out = found.join(least, "class", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
    null = lambda c: F.when(F.col(c) != NULL_ID, F.col(c)).alias(c)
    return out.select(null("doc_id"), "n_shingles", null("component_id"))


def keep_one_of_each(docs: DataFrame, *, id: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90) -> DataFrame:
    """One document of every component, the one with the smallest id; a null id comes after all others. Of several
    rows of that id in one component one stays, whichever. Texts without words stay, all of them."""
    keyed = written(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("key")), "keyed", compression="zstd")
    with passing_tables(docs.sparkSession):
        found = set_classes(keyed.select("key", F.col("row")[text].alias("text")), "key", "text", size, percent).where(F.col("class").isNotNull())
        ids = keyed.select("key", F.col("row")[id].alias("id"))
        rows = written(found.join(ids, found.doc_id == ids.key).select("class", "key", "id"), "class-rows")
        first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key"))
        several = rows.groupBy("class").agg(F.count("*").alias("k"), first["key"].alias("kept")).where("k > 1")
        gone = written(rows.join(several.select("class", "kept"), "class").where("key <> kept").select("key"), "class-copies", keep=True)
    return keyed.join(gone, "key", "left_anti").select("row.*")


@query()
def op7_ngram_jaccard(spark, sf_dir):
    """Set size and component of every document."""
    return similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), size=3, percent=90)
