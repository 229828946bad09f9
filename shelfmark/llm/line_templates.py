"""Line dedup by log templates.

A fixed-depth tree sorts lines by their number of tokens and their leading tokens. Within a leaf, a token is a
constant of its position if ``min_docs`` documents have it there; other tokens, and all with a digit, are
variable fields. Lines with the same constants are one template. A template that recurs in at least ``min_docs``
different texts, and is constant in at least ``min_constant`` of its tokens, is dropped from every document.

The tree is built by aggregates instead of line by line, so its result depends on no order, and a line that
fills a third of the corpus is one row after the map-side combine. A first count by hash bucket (at most
``BUCKETS`` rows, so it can be broadcast) keeps the tokens of lines in rare leaves out of all shuffles.

With ``long_docs``, a line of ``long_tokens`` tokens or more that stands, the same in all its tokens, in that many
different texts is a passage repeated: it stays in one of them (the one with the smallest digest) and goes from the
others, if no template drops it from all. By default long lines are treated as all others.

A document of which more than half of all tokens would go may be a copy of others rather than a text with
boilerplate. By default it stays whole. With ``near_copies`` (options of ``similar_documents``) only those stay whole that
have a near copy, not equal to them, among such texts: a near-duplicate stage with the same options removes all but
one. Others lose their lines whatever the share.

Defined results: null and empty texts stay as they are; lines of fewer than ``min_tokens`` tokens stay; texts that
repeat count once and get equal results; a line that repeats within a text counts once. Extra columns pass
through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import passing_tables, query, table, written
from .doc_features import GAPS, let, words_of
from .ngram_jaccard import similar_documents

BUCKETS = 1 << 20
FIELD = "<*>"
LEADING = 2


def plain_spaces(text: Column) -> Column:
    """The text with its tokens apart by one space, and its lines as they are but for that."""
    spaced = F.translate(text, GAPS.replace(" ", "").replace("\n", ""), " " * (len(GAPS) - 2))
    return F.when(spaced.contains("  "), F.regexp_replace(spaced, " {2,}", " ")).otherwise(spaced)


def masked(spaced: Column) -> Column:
    """The text with a field for every token that has a digit."""
    return F.regexp_replace(spaced, "(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*", FIELD)


def dropped_lines(
    docs: DataFrame, *, text: str = "text", min_docs: int = 10, min_tokens: int = 3, min_constant: float = 0.7,
    long_docs: int | None = None, long_tokens: int = 20,
) -> DataFrame:
    """``digest`` of each text that has recurring lines, the ``numbers`` of those to drop, and ``n_tokens`` in all of
    them. Leaves and lines are told apart by 64-bit hashes."""
    rows = docs.where(F.col(text).isNotNull()).select(F.md5(text).alias("digest"), plain_spaces(F.col(text)).alias("text"))
    rows = rows.select("digest", F.split("text", "\n").alias("lines"), F.split(masked(F.col("text")), "\n").alias("masked"))
    # the outer form adds no filter that would split a text once more; no text is without lines
    if long_docs is None:
        lines = rows.select("digest", F.posexplode_outer("masked").alias("number", "line"))
    else:
        lines = rows.select("digest", F.posexplode_outer(F.arrays_zip("lines", "masked")).alias("number", "l"))
        lines = lines.select("digest", "number", F.xxhash64(F.trim("l.lines")).alias("whole"), F.col("l.masked").alias("line"))
    lines = lines.withColumn("line", F.trim("line"))
    # tokens are apart by one byte
    n = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    lines = lines.withColumn("n", F.when(F.col("line") == "", 0).otherwise(n))
    lines = lines.withColumn("leaf", F.xxhash64("n", F.substring_index("line", " ", LEADING)))
    lines = written(lines, "lines").where(F.col("n") >= min_tokens)
    bucket = F.pmod(F.col("leaf"), F.lit(BUCKETS)).alias("bucket")
    common = lines.groupBy(bucket).count().where(F.col("count") >= min_docs).select("bucket")
    likely = lines.join(F.broadcast(common), bucket == F.col("bucket"), "left_semi")
    key = F.xxhash64("line").alias("key")
    distinct = likely.groupBy("n", "leaf", "line").agg(F.count("*").alias("docs"))
    leaves = distinct.groupBy("leaf").agg(F.sum("docs").alias("held")).where(F.col("held") >= min_docs).select("leaf")
    tokens = F.split("line", " ")
    named = distinct.join(leaves, "leaf").select("n", "leaf", key, "docs", tokens.alias("tokens"))
    # of a line without room for a variable field, only its own copies make a template; the leading tokens of a
    # leaf are constants of it already
    room = F.col("n") - F.ceil(F.lit(min_constant) * F.col("n"))
    fields = F.size(F.filter("tokens", lambda t: t == FIELD))
    named = named.where(((F.col("docs") >= min_docs) | (room >= 1)) & (fields <= room))
    named = written(named, "line-tokens")
    rest = named.select("leaf", "key", "docs", F.posexplode(F.slice("tokens", LEADING + 1, F.size("tokens"))).alias("at", "token"))
    rest = rest.where(F.col("token") != FIELD)
    constants = rest.groupBy("leaf", "at", "token").agg(F.sum("docs").alias("seen")).where(F.col("seen") >= min_docs).drop("seen")
    found = rest.join(constants, ["leaf", "at", "token"]).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "token"))).alias("constants"))
    leading = F.size(F.filter(F.slice("tokens", 1, LEADING), lambda t: t != FIELD))
    templates = (
        named.join(found, "key", "left")
        .where(leading + F.coalesce(F.size("constants"), F.lit(0)) >= F.lit(min_constant) * F.col("n"))
        .select("key", F.xxhash64("leaf", "constants").alias("template"))
    )
    places = written(likely.select("digest", "number", "n", key).join(templates, "key").drop("key"), "lines-places")
    seen = places.select("template", "digest").distinct().groupBy("template").count()
    recurring = seen.where(F.col("count") >= min_docs).select("template")
    found = places.join(recurring, "template", "left_semi").select("digest", "number", "n").distinct()
    if long_docs is not None:
        long = lines.where(F.col("n") >= long_tokens).select("whole", "digest", "number", "n").distinct()
        held = long.select("whole", "digest").distinct().groupBy("whole").agg(F.count("*").alias("k"), F.min("digest").alias("holder"))
        repeated = long.join(held.where(F.col("k") >= long_docs), "whole").select("digest", "number", "n", (F.col("digest") != F.col("holder")).alias("goes"))
        found = (
            found.withColumn("goes", F.lit(True)).unionByName(repeated).groupBy("digest", "number", "n").agg(F.max("goes").alias("goes"))
            .select("digest", F.when(F.col("goes"), F.col("number")).alias("number"), "n")
        )
    return (
        found
        .groupBy("digest").agg(F.collect_list("number").alias("numbers"), F.sum("n").alias("n_tokens"))
    )


def _copied(over: DataFrame, near_copies: dict) -> DataFrame:
    """The ``digest`` of texts that have a near copy among the texts given."""
    over = written(over.withColumn("id", F.xxhash64("digest")), "lines-over")
    found = written(similar_documents(over, id="id", text="text", **near_copies).select("doc_id", "component_id"), "lines-near")
    several = found.groupBy("component_id").count().where("count > 1").select("component_id")
    return over.join(found.join(several, "component_id", "left_semi"), F.col("id") == F.col("doc_id")).select("digest")


def mark_lines(docs: DataFrame, *, text: str = "text", near_copies: dict | None = None, **options) -> DataFrame:
    """``row`` (all columns of the document), ``n_lines``, ``n_dropped`` and ``kept_text``."""
    rows = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"), F.md5(text).alias("digest"))
    few = 2 * F.col("n_tokens") <= F.size(words_of(F.col("text")))
    with passing_tables(docs.sparkSession):
        gone = dropped_lines(docs, text=text, **options)
        if near_copies is not None:
            gone = written(gone, "lines-gone")
            over = rows.join(gone, "digest").where(~few).select("digest", "text").dropDuplicates(["digest"])
            gone = gone.join(_copied(over, near_copies), "digest", "left_anti")
            few = F.lit(True)
        gone = written(gone, "lines-marks", keep=True)

    def kept(lines: Column) -> Column:
        return F.filter(lines, lambda line, i: ~F.array_contains("drop", i.cast("int")))

    # marks go to the documents by a map of hash buckets; documents in other buckets stay where they are
    bucket = F.pmod(F.xxhash64("digest"), F.lit(BUCKETS)).alias("bucket")
    held = F.broadcast(gone.select(bucket).distinct().withColumn("hit", F.lit(True)))
    rows = rows.join(held, bucket == F.col("bucket"), "left")
    hit = rows.where("hit").select("row", "text", "digest").join(gone, "digest", "left").withColumn("drop", F.when(few, F.col("numbers")))
    rest = rows.where("hit IS NULL").select("row", "text", F.lit(None).cast("array<int>").alias("drop"))
    marked = hit.select("row", "text", "drop").unionByName(rest)
    return marked.select(
        "row",
        F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(let(F.split("text", "\n"), kept), "\n")).alias("kept_text"),
    )


def drop_recurring_lines(docs: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents without their recurring lines."""
    marked = mark_lines(docs, text=text, **options)
    return marked.select(*(F.col("kept_text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))


@query(r"""
WITH doc AS (SELECT doc_id, text, md5(text) AS d, string_split(text, chr(10)) AS l FROM documents),
line AS (SELECT DISTINCT d, k, array_to_string(regexp_extract_all(l[k], '[^\x20\x09-\x0D]+'), ' ') AS m
  FROM (SELECT d, l, unnest(range(1, len(l) + 1)) AS k FROM doc)),
masked AS (SELECT d, k, m, string_split(m, ' ') AS w FROM
  (SELECT d, k, regexp_replace(m, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS m FROM line)),
leaf AS (SELECT d, k, m, w, len(w) AS n, w[1] || ' ' || w[2] AS lead FROM masked WHERE len(w) >= 3),
weighted AS (SELECT n, lead, m, w, count(*) AS docs FROM
  (SELECT doc.doc_id, n, lead, m, w FROM leaf JOIN doc USING (d)) GROUP BY ALL),
token AS (SELECT n, lead, m, docs, pos, w[pos] AS token FROM (SELECT *, unnest(range(1, n + 1)) AS pos FROM weighted)),
constant AS (SELECT n, lead, pos, token, true AS hit FROM token WHERE token <> '<*>' GROUP BY ALL HAVING sum(docs) >= 10),
template AS (SELECT n, m, string_agg(CASE WHEN c.hit IS NULL THEN '<*>' ELSE t.token END, ' ' ORDER BY t.pos) AS template
  FROM token t LEFT JOIN constant c USING (n, lead, pos, token) GROUP BY n, lead, m HAVING count(c.hit) >= 0.7 * n),
place AS (SELECT d, k, n, template FROM leaf JOIN template USING (n, m)),
recurring AS (SELECT template FROM place GROUP BY template HAVING count(DISTINCT d) >= 10),
gone AS (SELECT d, list(k) AS ks, sum(n) AS n_tokens FROM place SEMI JOIN recurring USING (template) GROUP BY d),
judged AS (SELECT doc_id, text, l, CASE WHEN 2 * n_tokens <= len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) THEN ks END AS ks
  FROM doc LEFT JOIN gone USING (d))
SELECT doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(ks), 0)::BIGINT AS n_dropped,
  sha256(CASE WHEN ks IS NULL THEN coalesce(text, '') ELSE
    array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda i: NOT list_contains(ks, i)), lambda i: l[i]), chr(10)) END) AS kept_sha256
FROM judged
""")
def op5_line_dedup(spark, sf_dir):
    """Lines, dropped lines, and hash of what is left of every document."""
    marked = mark_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256")
    return marked.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", kept)
