"""Weakly supervised quality rules.

Each rule votes good, bad, or abstains. Expectation-maximisation over the documents' votes estimates how often
good and bad documents get each vote, and a document stays if its posterior probability of being good is high
enough: no rule decides alone, and no labels are needed.

Everything is DataFrame expressions. Votes are counted by pattern first (at most 3 ** rules patterns, whatever
the number of documents), so an iteration is one small aggregate that gives one row of estimates.

Defined results: null and empty texts count as zero words; all rules abstain on what they cannot judge; an empty table
gives an empty result; equal texts get equal verdicts. Extra columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import query, table, written
from .doc_features import COUNTS, counts

#: Rule -> (votes good, votes bad), over the counts of a text; neither: abstains. Every defect is looked at from
#: two or three sides, so that agreement between rules tells which of them to trust.
RULES = {
    "symbols": ("50 * n_symbols <= word_chars", "12 * n_symbols > word_chars"),
    "symbol_words": ("n_words >= 5 AND 20 * n_symbols <= n_words", "4 * n_symbols > n_words"),
    "letters": ("100 * (n_symbols + n_digits) <= 4 * word_chars", "100 * n_symbols > 9 * word_chars OR 10 * n_digits > 4 * word_chars"),
    "capitals": ("word_chars >= 20 AND 10 * n_upper <= word_chars", "word_chars >= 20 AND 5 * n_upper > 2 * word_chars"),
    "shouting": ("n_words >= 20 AND n_stops BETWEEN n_words / 50.0 AND n_words / 2.0", "n_words >= 5 AND n_stops > n_words"),
    "dup_lines": ("n_lines >= 3 AND 20 * n_dup_lines <= n_lines", "n_lines >= 4 AND 10 * n_dup_lines > 4 * n_lines"),
    "repeats": ("n_words >= 20 AND 50 * n_repeat_words <= n_words", "100 * n_repeat_words > 18 * n_words"),
    "echo": ("n_words >= 20 AND 20 * n_echo <= n_words", "n_words >= 5 AND 5 * n_echo > n_words"),
    "variety": ("n_words BETWEEN 10 AND 500 AND 2 * n_distinct >= n_words", "n_words BETWEEN 8 AND 500 AND 100 * n_distinct < 45 * n_words"),
    "word_length": ("n_words >= 10 AND word_chars BETWEEN 3 * n_words AND 8 * n_words", "n_words >= 10 AND word_chars NOT BETWEEN 2 * n_words AND 12 * n_words"),
}
BASE_FAILED = "(n_words < 10 OR 100 * n_repeat_words > 20 * n_words)"
ITERATIONS = 15
KEEP_FROM = 0.5
#: Estimates before the first iteration: the share of good documents, and how often a good and a bad document
#: get the vote they deserve. Good documents rarely fail any rule; a bad one may have one defect of many.
START = {"prior": 0.8, "a": 0.97, "b": 0.4}


def votes_sql() -> list[str]:
    return [f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 1 END AS v_{r}" for r, (good, bad) in RULES.items()]


def log_odds_sql(of: str = "{}") -> str:
    """Log odds of good, from votes and estimates. ``of`` writes the name of an estimate."""
    terms = [
        f"CASE v_{r} WHEN 1 THEN ln({of.format('a_' + r)} / (1 - {of.format('b_' + r)})) "
        f"WHEN 0 THEN ln((1 - {of.format('a_' + r)}) / {of.format('b_' + r)}) ELSE 0 END"
        for r in RULES
    ]
    return f"ln({of.format('prior')} / (1 - {of.format('prior')})) + " + " + ".join(terms)


def estimates_sql() -> list[str]:
    """One iteration's estimates, from patterns with their number ``n`` and posterior ``p``. One is added to the
    right and the wrong votes, so no estimate reaches 0 or 1."""
    parts = ["(sum(n * p) + 1) / (sum(n) + 2) AS prior"]
    for r in RULES:
        for name, weight, right in (("a", "p", 1), ("b", "(1 - p)", 0)):
            parts.append(
                f"(coalesce(sum(CASE WHEN v_{r} = {right} THEN n * {weight} END), 0) + 1) / "
                f"(coalesce(sum(CASE WHEN v_{r} IS NOT NULL THEN n * {weight} END), 0) + 2) AS {name}_{r}"
            )
    return parts


def fit_votes(patterns: DataFrame, iterations: int = ITERATIONS) -> dict[str, float]:
    """Estimates by expectation-maximisation; ``patterns`` has the vote columns and ``n``."""
    names = ["prior", *(f"{k}_{r}" for r in RULES for k in "ab")]
    now = {n: START[n.split("_")[0]] for n in names}
    for _ in range(iterations):
        p = f"1 / (1 + exp(-({log_odds(now)}))) AS p"
        row = patterns.selectExpr("*", p).selectExpr(*estimates_sql()).first()
        if row is None or any(row[n] is None for n in names):  # no documents
            break
        now = {n: float(row[n]) for n in names}
    return now


def log_odds(estimates: dict[str, float]) -> str:
    sql = log_odds_sql("{{{}}}")
    return sql.format(**{n: f"{v!r}D" for n, v in estimates.items()})


def judge_quality(docs: DataFrame, *, text: str = "text", keep_text: bool = True, iterations: int = ITERATIONS) -> DataFrame:
    """``row`` (the document's columns), the counts, one ``v_`` column per rule, ``posterior``, ``base_failed``
    and ``kept``. Texts are read once: counts and votes are written out, patterns and verdicts come from there.
    ``keep_text=False`` leaves the text out of ``row``."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns if keep_text or c != text))
    counted = docs.select(row.alias("row"), counts(F.col(f"`{text}`")).alias("c")).select("row", *(F.col("c")[n].alias(n) for n in COUNTS))
    voted = written(counted.selectExpr("*", *votes_sql()), "quality-votes", compression="zstd")
    patterns = written(voted.groupBy(*(f"v_{r}" for r in RULES)).agg(F.count("*").alias("n")).coalesce(1), "quality-patterns")
    posterior = f"1 / (1 + exp(-({log_odds(fit_votes(patterns, iterations))})))"
    return (
        voted.selectExpr("*", f"{posterior} AS posterior", f"{BASE_FAILED} AS base_failed")
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= KEEP_FROM))
    )


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay."""
    judged = judge_quality(docs, **options)
    return judged.where("kept").select(*(F.col("row")[c].alias(c) for c in docs.columns))


def oracle() -> str:
    """The same verdicts in DuckDB: counts by windows and regular expressions, one CTE per iteration."""
    gap = r"[\x20\x09-\x0D]"
    word = r"[^\x20\x09-\x0D]"
    n_of = "(length(t) - length(translate(t, '{}', '')))::BIGINT"
    steps = [
        f"""doc AS (SELECT doc_id, t, regexp_extract_all(t, '{word}+') AS w,
          list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '{word}')) AS l
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))""",
        """gram AS (SELECT doc_id, p, list_slice(w, p, p + 4) AS g FROM (
          SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM doc WHERE len(w) >= 5))""",
        """twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM gram) WHERE n > 1)""",
        """rep AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q FROM twice) GROUP BY doc_id)""",
        f"""counted AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{gap}', '', 'g'))::BIGINT AS word_chars,
          {n_of.format('#*$%&|<>')} AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
          coalesce(n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines, len(list_distinct(w))::BIGINT AS n_distinct,
          len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1]))::BIGINT AS n_echo,
          {n_of.format('ABCDEFGHIJKLMNOPQRSTUVWXYZ')} AS n_upper, {n_of.format('0123456789')} AS n_digits,
          {n_of.format('.!?')} AS n_stops
        FROM doc LEFT JOIN rep USING (doc_id))""",
        f"voted AS (SELECT *, {', '.join(votes_sql())} FROM counted)",
        f"pattern AS MATERIALIZED (SELECT {', '.join(f'v_{r}' for r in RULES)}, count(*) AS n FROM voted GROUP BY ALL)",
        f"e0 AS (SELECT {START['prior']}::DOUBLE AS prior, " + ", ".join(f"{START[k]}::DOUBLE AS {k}_{r}" for r in RULES for k in "ab") + ")",
    ]
    for i in range(1, ITERATIONS + 1):
        steps.append(
            f"e{i} AS MATERIALIZED (SELECT {', '.join(estimates_sql())} FROM "
            f"(SELECT pattern.*, 1 / (1 + exp(-({log_odds_sql(f'e{i - 1}.{{}}')}))) AS p FROM pattern, e{i - 1}))"
        )
    verdict = f"1 / (1 + exp(-({log_odds_sql(f'e{ITERATIONS}.{{}}')}))) >= {KEEP_FROM}"
    return (
        "WITH " + ",\n".join(steps) + f""" SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        {BASE_FAILED} AS base_failed, NOT {BASE_FAILED} AND {verdict} AS kept FROM voted, e{ITERATIONS}"""
    )


@query(oracle())
def op3_quality_rules(spark, sf_dir):
    """Counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge_quality(docs, keep_text=False)
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    return judged.select(F.col("row.doc_id").alias("doc_id"), *names)
