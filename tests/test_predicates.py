import random

import pytest
from conftest import plan
from pyspark.sql import functions as F

import shelfmark as sm

TEXT = ["airport", "tag", "reason"]


@pytest.fixture(scope="module")
def trips(spark):
    return spark.createDataFrame(
        [
            ("business", None, "SFO", "jan", "2015-12-28T20:03:10Z"),
            (None, 5, "OTP", "feb", "2013-12-28T20:03:10Z"),
            (None, 3, "MUC OTP SFO JFK", "long", "2012-12-28T20:03:10Z"),
        ],
        "reason string, participants int, airport string, tag string, date string",
    ).withColumn("date", F.col("date").cast("timestamp"))


# (filter, strict, analyzed without recheck, analyzed with recheck)
MODES = {
    "equals": (sm.equals("airport", "OTP"), 0, 2, 1),
    "null safe": (sm.null_safe_eq("airport", "OTP"), 0, 2, 1),
    "gt": (sm.range("participants", gt=3), 1, 1, 1),
    "gte": (sm.range("participants", gte=3), 2, 2, 2),
    "lt": (sm.range("participants", lt=5), 1, 1, 1),
    "lte": (sm.range("participants", lte=5), 2, 2, 2),
    "is null": (sm.is_null("participants"), 1, 1, 1),
    "is not null": (sm.is_not_null("reason"), 1, 1, 1),
    "in": (sm.is_in("airport", ["OTP", "SFO", "MUC"]), 0, 2, 2),
    "in dates": (sm.is_in("date", ["2015-12-28", "2012-12-28"]), 0, 0, 0),
    "in numbers": (sm.is_in("participants", [1, 2, 3]), 1, 1, 1),
    "in mixed": (sm.is_in("participants", [2, "bar", 1, "foo"]), 0, 0, 0),
    "prefix": (sm.starts_with("airport", "O"), 0, 2, 1),
    "suffix": (sm.ends_with("airport", "O"), 0, 2, 1),
    "contains": (sm.contains("reason", "us"), 1, 1, 1),
    "and": (sm.is_not_null("reason") & sm.equals("tag", "jan"), 1, 1, 1),
    "not": (~sm.is_null("reason"), 1, 1, 1),
    "or": (sm.contains("reason", "us") | sm.equals("airport", "OTP"), 1, 3, 2),
}


@pytest.mark.parametrize("name", MODES)
def test_filter_modes(trips, name):
    query, strict, analyzed, rechecked = MODES[name]
    assert sm.search(trips, query, TEXT, strict=True).count() == strict
    assert sm.search(trips, query, TEXT, recheck=False).count() == analyzed
    assert sm.search(trips, query, TEXT).count() == rechecked


def test_pushdown_off_is_plain_spark(trips):
    assert sm.search(trips, sm.equals("airport", "OTP"), TEXT, pushdown=False).count() == 1


def test_must_not_keeps_missing(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    assert sm.search(df, sm.bool_(must_not=[sm.term("x", 1)])).count() == 1
    assert sm.search(df, ~sm.equals("x", 1), recheck=False).count() == 1
    assert sm.search(df, ~sm.equals("x", 1)).count() == 0  # Spark's own NOT drops nulls


def test_null_values_and_empty_sets(trips):
    assert sm.search(trips, sm.term("participants", None)).count() == 1
    assert sm.search(trips, sm.terms("participants", [None])).count() == 0
    assert sm.search(trips, sm.terms("participants", [])).count() == 0
    assert sm.search(trips, sm.term("no.such.field", 1)).count() == 0
    assert sm.search(trips, sm.missing("no.such.field")).count() == 3


def test_numbers_compare_in_the_fields_type(spark):
    df = spark.createDataFrame([(1, 0.1, 5), (100, 2.5, None)], "tiny byte, f float, n long")
    counts = {
        sm.range("tiny", lt=300): 2, sm.range("tiny", gt=300): 0, sm.range("tiny", gte=99.5): 1, sm.term("tiny", 1.0): 1,
        sm.term("f", 0.1): 1, sm.term("f", "2.5"): 1, sm.range("n", lt=2**70): 1, sm.term("n", 2**70): 0, sm.term("n", "five"): 0,
        sm.terms("n", ["5", True, 7]): 1,
    }
    for query, expected in counts.items():
        assert sm.search(df, query).count() == expected


def test_arrays_match_any_element(spark):
    df = spark.createDataFrame(
        [(1, ["a b", "c"], [(1, "x"), (2, "y")]), (2, [], []), (3, None, None), (4, [None], [(None, "z")])],
        "id int, tags array<string>, items array<struct<n:int,s:string>>",
    )

    def ids(q, text=()):
        return [r.id for r in sm.search(df, q, text).orderBy("id").collect()]

    assert ids(sm.term("tags", "c")) == [1]
    assert ids(sm.match("tags", "B"), ["tags"]) == [1]
    assert ids(sm.range("items.n", gte=2)) == [1]
    assert ids(sm.term("items.s", "z")) == [4]
    assert ids(sm.exists("tags")) == [1]
    assert ids(sm.missing("tags")) == [2, 3, 4]
    assert ids(sm.is_null("tags")) == [3]  # Spark sees the empty array again


def test_bool_should_rules(trips):
    should = [sm.term("tag", "jan"), sm.term("tag", "feb")]
    assert sm.search(trips, sm.bool_(should=should)).count() == 2
    assert sm.search(trips, sm.bool_(filter=[sm.exists("airport")], should=should)).count() == 3
    both = sm.bool_(filter=[sm.exists("airport")], should=should, minimum_should_match=1)
    assert sm.search(trips, both).count() == 2


def test_wildcards_escape_like_characters(spark):
    df = spark.createDataFrame([("50%_off",), ("50 xoff",), ("a\\b",), ("aXb",)], "s string")
    assert sm.search(df, sm.wildcard("s", "50%_*")).count() == 1
    assert sm.search(df, sm.wildcard("s", "a\\*")).count() == 1
    assert sm.search(df, sm.wildcard("s", "*o*f*")).count() == 2


WORDS = ["Alpha", "beta", "alphabet", "bet", "été", "x1", "a-b", "Beta,gamma", "aba", "ab"]


@pytest.mark.parametrize("pattern", ["a*", "*a", "*et*", "al*t", "aba*ba", "*", "b*", "*1", "a*b*a", "é*", "a-b", "ab"])
def test_word_patterns_against_word_lists(spark, pattern):
    import re

    rnd = random.Random(pattern)
    texts = [" ".join(rnd.choices(WORDS, k=rnd.randint(0, 4))) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    wanted = re.compile("^" + ".*".join(map(re.escape, pattern.split("*"))) + "$")
    expected = [i for i, t in enumerate(texts) if any(wanted.match(w) for w in re.findall(r"[^\W_]+", t.lower()))]
    got = [r.id for r in sm.search(df, sm.wildcard("t", pattern), ["t"]).orderBy("id").collect()]
    assert got == expected


def test_dsl_and_uri_forms(trips):
    def n(q):
        return sm.search(trips, q, TEXT).count()

    assert n('{"query": {"match_all": {}}}') == 3
    assert n({"bool": {"must": {"match": {"airport": "otp"}}, "must_not": [{"term": {"tag": "feb"}}]}}) == 1
    assert n({"match": {"airport": {"query": "muc jfk", "operator": "and"}}}) == 1
    assert n({"constant_score": {"filter": {"exists": {"field": "reason"}}}}) == 1
    assert n({"filtered": {"query": {"match_all": {}}, "filter": {"range": {"participants": {"gt": 3}}}}}) == 1
    assert n({"query_string": {"query": "sfo", "default_field": "airport"}}) == 2
    assert n("?q=m*") == 1
    assert n("?q=airport:m* tag:jan") == 2
    assert n("?q=airport:sfo tag:jan&default_operator=AND") == 1
    assert n("?q=otp OR sfo AND business") == 3
    assert n("?q=*") == 3
    assert n("?q=reason:*") == 1


@pytest.mark.parametrize(
    "query",
    [
        {"fuzzy": {"a": "b"}},
        {"match": {"a": {"query": "x", "boost": 2}}},
        {"bool": {"musst": []}},
        {"range": {"a": {"from": 1}}},
        {"term": {"a": 1}, "match_all": {}},
        "?q=a&nope=1",
        "?df=a",
        "?q=(a b)",
        "?q=a AND",
        "[]",
    ],
)
def test_unknown_query_forms_raise(query):
    with pytest.raises((ValueError, KeyError)):
        sm.functions.predicates.as_predicate(query)


def test_filters_reach_parquet(spark, tmp_path):
    spark.range(100).selectExpr("id", "cast(id AS string) AS s", "timestamp_ntz'2020-01-01' AS t").write.parquet(f"{tmp_path}/c")
    q = sm.bool_(filter=[sm.term("s", "7"), sm.range("id", gt="3"), sm.range("t", gte="2020-01-01")])
    text = plan(sm.read_collection(spark, "c", q, root=str(tmp_path), include=["id"]))
    assert "EqualTo(s,7)" in text and "GreaterThan(id,3)" in text and "GreaterThanOrEqual(t" in text


# -- random query trees against a plain Python evaluator ----------------------------------------------


def _random_query(rnd, depth):
    if depth and rnd.random() < 0.6:
        parts = {k: [_random_query(rnd, depth - 1) for _ in range(rnd.randint(0, 2))] for k in ("must", "filter", "should", "must_not")}
        return {"bool": parts}
    field = rnd.choice(["n", "s", "t"])
    if field == "n":
        kind = rnd.choice(["term", "terms", "range", "exists"])
        return {
            "term": {"term": {"n": rnd.randint(0, 5)}},
            "terms": {"terms": {"n": [rnd.randint(0, 5), None, 1]}},
            "range": {"range": {"n": {rnd.choice(["gt", "gte", "lt", "lte"]): rnd.randint(0, 5)}}},
            "exists": {"exists": {"field": "n"}},
        }[kind]
    value = rnd.choice(["red", "Blue", "red blue", "b"])
    return {rnd.choice(["term", "match", "prefix"]): {field: value}}


def _evaluate(q, row):
    ((name, body),) = q.items()
    if name == "bool":
        required = all(_evaluate(x, row) for x in body["must"] + body["filter"])
        optional = body["should"] and not (body["must"] or body["filter"])
        some = any(_evaluate(x, row) for x in body["should"]) if optional else True
        return required and some and not any(_evaluate(x, row) for x in body["must_not"])
    if name == "exists":
        return row[body["field"]] is not None
    ((field, value),) = body.items()
    have = row[field]
    if have is None:
        return False
    if name == "range":
        ((op, bound),) = value.items()
        return {"gt": have > bound, "gte": have >= bound, "lt": have < bound, "lte": have <= bound}[op]
    if name == "terms":
        return have in [v for v in value if v is not None]
    if field != "t":
        return have.startswith(value) if name == "prefix" else have == value
    words = have.lower().split()
    if name == "match":
        return any(w in words for w in value.lower().split())
    if name == "term":
        return value in words
    return any(w.startswith(value) for w in words)


def test_random_trees(spark):
    rnd = random.Random(7)
    data = [
        (i, rnd.choice([None, 0, 1, 2, 3, 4, 5]), rnd.choice([None, "red", "Blue", "blue", "red blue"]), rnd.choice([None, "Red", "red blue", "BLUE x", "b"]))
        for i in range(200)
    ]
    df = spark.createDataFrame(data, "id int, n int, s string, t string").cache()
    queries = [_random_query(rnd, 3) for _ in range(60)]
    flags = df.select("id", *(F.coalesce(sm.dsl(q).on(df, ["t"]), F.lit(False)).alias(f"q{i}") for i, q in enumerate(queries)))
    for row, source in zip(sorted(flags.collect()), data):
        values = dict(zip(("id", "n", "s", "t"), source))
        for i, q in enumerate(queries):
            assert row[f"q{i}"] == bool(_evaluate(q, values)), (q, values)


@pytest.mark.parametrize(
    "query",
    ["alpha NOT beta", "te?t", {"wildcard": {"t": "te?t"}}, {"range": {"ts": {"gte": "now-1d"}}}, {"query_string": {"query": "a*", "analyze_wildcard": True}}],
)
def test_forms_that_are_refused(query):
    with pytest.raises(ValueError, match="support"):
        sm.query_string(query) if isinstance(query, str) else sm.dsl(query)
