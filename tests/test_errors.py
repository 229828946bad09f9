import json

import pytest
from conftest import rows

import shelfmark as sm


@pytest.fixture()
def conflicts(spark):
    t = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, lang string")
    s = spark.createDataFrame([("1", "en"), ("2", "fr"), ("3", "de")], "id string, lang string")
    return sm.write_create(t, s, "id")


def test_fail_is_always_last(conflicts):
    with pytest.raises(sm.RejectedDocuments, match="version_conflict"):
        sm.handle(conflicts.rejected)
    with pytest.raises(sm.RejectedDocuments):
        sm.handle(conflicts.rejected, [lambda d: (d.where("lang = 'en'"), d.where("lang <> 'en'"))])
    assert sm.handle(conflicts.rejected.limit(0)).count() == 0


def test_chain(conflicts, caplog):
    order = []

    def passes(d):
        order.append("passes")
        return d.limit(0), d

    def takes(d):
        order.append("takes")
        return d.where("lang = 'en'"), d.where("lang <> 'en'")

    handled = sm.handle(conflicts.rejected, [passes, takes, "log"])
    assert order == ["passes", "takes"] and rows(handled.select("id")) == [("1",), ("2",)]
    assert "dropped 1 documents: version_conflict" in caplog.text
    with pytest.raises(ValueError):
        sm.handle(conflicts.rejected, ["nope"])


def test_error_events(spark, conflicts, tmp_path):
    sm.handle(conflicts.rejected, [sm.collect_to(f"{tmp_path}/dlq", labels={"job": "x"}, tags=["t"])])
    events = spark.read.parquet(f"{tmp_path}/dlq")
    assert events.count() == 2
    e = events.where("error.message LIKE '1:%'").first()
    assert e["@timestamp"][:2] == "20" and e.tags == ["t"] and e.labels.job == "x" and e.host.name
    assert (e.error.code, e.event.category, e.event.type, e.event.version) == ("version_conflict", "error", "bulk_failure", "0.992")
    assert json.loads(e.event.raw) == {"id": "1", "lang": "en"} and e.message == "Encountered Bulk Failure"
    assert "tags" not in sm.to_error_events(conflicts.rejected).columns


def test_malformed_documents_become_events(spark):
    docs = spark.createDataFrame([(1, '{"n":1}'), (2, "{bad")], "id int, json string").withColumnRenamed("json", "text")
    kept = sm.parse_docs(docs.selectExpr("id", "text", "text AS json"), "json", {"properties": {"n": {"type": "long"}}}, on_error="keep")
    good, bad = sm.malformed_as_rejected(kept)
    assert rows(good.select("id", "n")) == [(1, 1)]
    event = sm.to_error_events(bad, stage="read").first()
    assert event.event.type == "deserialization_failure" and "{bad" in event.event.raw


def test_retry(conflicts):
    fixed = sm.retry_rejected(conflicts, {"id": "concat(id, '-new')"})
    assert rows(fixed.target) == [("1", "a"), ("1-new", "en"), ("2", "b"), ("2-new", "fr"), ("3", "de")]
    assert fixed.rejected.count() == 0
    stats = fixed.stats().first()
    assert (stats.docs_sent, stats.docs_accepted, stats.docs_retried) == (3, 3, 2)
    still = sm.retry_rejected(conflicts, lambda d: d, rounds=2)
    assert still.rejected.count() == 2


def test_handlers_that_lose_rows_are_caught(spark):
    rejected = spark.createDataFrame([("en", 409, "t", "r"), (None, 409, "t", "r")], "lang string, _status int, _error_type string, _error_reason string")

    def loses_null(df):
        return df.where("lang = 'en'"), df.where("lang <> 'en'")

    with pytest.raises(ValueError, match="returned 1"):
        sm.handle(rejected, [loses_null, "log"])
