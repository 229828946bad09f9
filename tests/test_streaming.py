import pytest
from conftest import rows
from pyspark.sql import functions as F

import shelfmark as sm
from shelfmark.streaming.sink import is_committed, save_batch, writer_of

DDL = "id int, name string, n int"


def feed(spark, folder, *batches):
    """Each batch as one file, one file per trigger, in order."""
    import os
    import time

    for i, batch in enumerate(batches):
        path = f"{folder}/in"
        spark.createDataFrame(batch, DDL).coalesce(1).write.mode("append").json(path, ignoreNullFields=False)
        stamp = time.time() - 1000 + i
        for f in os.listdir(path):
            if f.endswith(".json") and os.path.getmtime(f"{path}/{f}") > time.time() - 500:
                os.utime(f"{path}/{f}", (stamp, stamp))
    return spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).json(f"{folder}/in")


def run(sdf, tmp_path, mode="append", **options):
    sm.stream_to_collection(sdf, f"{tmp_path}/out", f"{tmp_path}/cp", mode, **options).awaitTermination()
    return f"{tmp_path}/out"


ONE = [(1, "Spark", 1), (2, "Hadoop", 1), (3, "YARN", 1)]
TWO = [(1, None, 2), (2, "Hadoop2", None)]


def test_append(spark, tmp_path):
    out = run(feed(spark, tmp_path, ONE, TWO), tmp_path)
    assert rows(sm.read_stream_collection(spark, out)) == sorted(ONE + TWO, key=lambda r: tuple((v is None, str(v)) for v in r))
    history = sm.commit_history(spark, out)
    assert rows(history.groupBy("batch_id").agg(F.sum("records"))) == [(0, 3), (1, 2)]
    assert history.where("task IS NULL OR started IS NULL OR resource IS NULL").count() == 0


def test_update_merges_fields(spark, tmp_path):
    out = run(feed(spark, tmp_path, ONE, TWO), tmp_path, "update", id="id")
    expected = [(1, "Spark", 2), (2, "Hadoop2", 1), (3, "YARN", 1)]
    assert rows(sm.read_stream_collection(spark, out, "id", "upsert")) == expected
    writer = writer_of(f"{tmp_path}/cp")
    assert sm.compact_stream(spark, out, "id", "upsert") == {writer: 1}
    assert sm.compact_stream(spark, out, "id", "upsert") == {writer: 1}
    assert rows(sm.read_stream_collection(spark, out, "id", "upsert")) == expected
    save_batch(spark.createDataFrame([(3, None, 9), (4, "Hive", 0)], DDL), out, writer, 2)
    assert rows(sm.read_stream_collection(spark, out, "id", "upsert")) == [*expected[:2], (3, "YARN", 9), (4, "Hive", 0)]
    with_nulls = sm.read_stream_collection(spark, out, "id", "upsert", write_null=True)
    assert (3, None, 9) in rows(with_nulls)


def test_index_replaces_documents(spark, tmp_path):
    out = run(feed(spark, tmp_path, ONE, TWO), tmp_path, id="id")
    assert rows(sm.read_stream_collection(spark, out, "id")) == [(1, None, 2), (2, "Hadoop2", None), (3, "YARN", 1)]


def test_replay_does_not_duplicate(spark, tmp_path, monkeypatch):
    sdf = feed(spark, tmp_path, ONE, TWO)
    out = run(sdf, tmp_path)
    writer = writer_of(f"{tmp_path}/cp")
    assert is_committed(spark, out, writer, 1) and not is_committed(spark, out, writer, 2)
    # a checkpoint that lost its progress starts over under the same name
    monkeypatch.setattr("shelfmark.streaming.sink.writer_of", lambda checkpoint: writer)
    sm.stream_to_collection(sdf, out, f"{tmp_path}/again").awaitTermination()
    assert sm.read_stream_collection(spark, out).count() == 5


def test_two_queries_write_to_one_collection(spark, tmp_path):
    sdf = feed(spark, tmp_path, ONE, TWO)
    out = run(sdf, tmp_path, id="id")
    sm.compact_stream(spark, out, "id")
    more = spark.createDataFrame([(2, "late", 7), (9, "new", 7)], DDL)
    more.coalesce(1).write.json(f"{tmp_path}/in2", ignoreNullFields=False)
    second = spark.readStream.schema(DDL).json(f"{tmp_path}/in2")
    sm.stream_to_collection(second, out, f"{tmp_path}/second", id="id").awaitTermination()
    assert rows(sm.read_stream_collection(spark, out, "id")) == [(1, None, 2), (2, "late", 7), (3, "YARN", 1), (9, "new", 7)]
    assert len(sm.compact_stream(spark, out, "id")) == 2
    assert sm.commit_history(spark, out).select("writer").distinct().count() == 2


def test_uncommitted_batch_is_invisible(spark, tmp_path):
    out = run(feed(spark, tmp_path, ONE), tmp_path)
    writer = writer_of(f"{tmp_path}/cp")
    lost = f"{out}/docs/batch=9999999999999-{writer}-0000000001"  # the job was lost before its commit
    spark.createDataFrame(TWO, DDL).write.parquet(lost)
    assert sm.read_stream_collection(spark, out).count() == 3 and not is_committed(spark, out, writer, 1)
    save_batch(spark.createDataFrame(TWO, DDL), out, writer, 1)
    assert sm.read_stream_collection(spark, out).count() == 5 and is_committed(spark, out, writer, 1)


def test_without_commit_log(spark, tmp_path, caplog):
    sdf = feed(spark, tmp_path, ONE)
    out = run(sdf, tmp_path, commit_log=False)
    sm.stream_to_collection(sdf, out, f"{tmp_path}/cp2", commit_log=False).awaitTermination()
    assert sm.read_stream_collection(spark, out).count() == 6 and "commit log is off" in caplog.text


def test_options(spark, tmp_path):
    out = run(feed(spark, tmp_path, ONE), tmp_path, exclude=["n"], index_pattern="c-{id}")
    assert rows(sm.read_stream_collection(spark, out)) == [(1, "Spark", "c-1"), (2, "Hadoop", "c-2"), (3, "YARN", "c-3")]


def test_several_rows_of_one_id_in_a_batch(spark, tmp_path):
    batch = [(1, "a", 1), (1, None, 2), (1, "c", None), (2, "x", 1)]
    sdf = feed(spark, tmp_path, batch).withColumn("at", F.coalesce("n", F.lit(3)))
    out = run(sdf, tmp_path, "update", id="id", order="at")
    assert rows(sm.read_stream_collection(spark, out, "id", "upsert").drop("at")) == [(1, "c", 2), (2, "x", 1)]


def test_refusals(spark, tmp_path):
    sdf = feed(spark, tmp_path, ONE)

    def refuse(match, df=sdf, mode="append", **options):
        with pytest.raises(ValueError, match=match):
            sm.stream_to_collection(df, f"{tmp_path}/o", f"{tmp_path}/c", mode, **options)

    refuse("only supported output modes", mode="complete")
    refuse("partition columns", partition_columns=["id"])
    refuse("requires an id", mode="update")
    refuse("operation upsert", mode="update", id="id", operation="index")
    refuse("not a streaming frame", df=spark.range(1))
    assert sm.commit_history(spark, f"{tmp_path}/none").count() == 0


def test_expired_batches_live_on_in_the_base(spark, tmp_path):
    out = run(feed(spark, tmp_path, ONE, TWO), tmp_path, id="id")
    before = rows(sm.read_stream_collection(spark, out, "id"))
    sm.compact_stream(spark, out, "id")
    assert len(sm.expire_batches(spark, out)) == 2 and sm.expire_batches(spark, out) == []
    assert rows(sm.read_stream_collection(spark, out, "id")) == before


def test_a_writer_keeps_its_order_and_all_its_fields(spark, tmp_path, monkeypatch):
    from shelfmark.streaming import sink

    class Clock(sink.dt.datetime):
        hour = 9

        @classmethod
        def now(cls, tz=None):
            cls.hour -= 1  # a clock that runs backwards
            return cls(2024, 1, 1, cls.hour, tzinfo=tz)

    monkeypatch.setattr(sink.dt, "datetime", Clock)
    out = f"{tmp_path}/o"
    sink.save_batch(spark.createDataFrame([(1, "old", 5)], "id int, name string, n int"), out, "w", 0)
    sink.save_batch(spark.createDataFrame([(1, "new")], "id int, name string"), out, "w", 1)
    sink.save_batch(spark.createDataFrame([(2, "other", 1.5)], "id int, name string, z double"), out, "v", 0)
    assert rows(sm.read_stream_collection(spark, out, "id").select("id", "name", "n", "z")) == [(1, "new", None, None), (2, "other", None, 1.5)]
    sink.save_batch(spark.createDataFrame([(9, "plain")], "id int, name string"), out, None, 0)
    with pytest.raises(ValueError, match="without a commit log"):
        sm.compact_stream(spark, out, "id")


def test_rejected_rows_become_events_under_the_commit_of_their_batch(spark, tmp_path, monkeypatch):
    one = [(1, "ok", 1), (2, "UPPER", 1), (3, None, 1), (None, "ok", 4), (5, "twice", 5), (5, "twice", 6), (5, "other", 7)]
    two = [(1, "ok", 2), (7, "bad name", 8)]
    options = dict(id="id", index_pattern="c-{name}", on_error="reject", labels={"job": "t"}, tags=["x"])
    sdf = feed(spark, tmp_path, one, two)
    out = run(sdf, tmp_path, **options)
    assert rows(sm.read_stream_collection(spark, out, "id")) == [(1, "ok", 2, "c-ok"), (5, "other", 7, "c-other")]
    events = sm.read_stream_errors(spark, out)
    got = rows(events.select("batch_id", "error.code", F.get_json_object("event.raw", "$.n").alias("n"), "labels.job"))
    want = [(0, "invalid_index_name", "1", "t"), (0, "invalid_index_name", "1", "t"), (0, "mapper_parsing", "4", "t")]
    want += [(0, "version_conflict", "5", "t"), (0, "version_conflict", "6", "t"), (1, "invalid_index_name", "8", "t")]
    assert got == want
    # a replay under the same name repeats neither rows nor events
    writer = writer_of(f"{tmp_path}/cp")
    monkeypatch.setattr("shelfmark.streaming.sink.writer_of", lambda checkpoint: writer)
    sm.stream_to_collection(sdf, out, f"{tmp_path}/again", **options).awaitTermination()
    assert rows(sm.read_stream_errors(spark, out).groupBy("batch_id").count()) == [(0, 5), (1, 1)]
    assert sm.read_stream_collection(spark, out).count() == 3
    # a batch lost before its commit leaves no event that can be seen
    lost = f"batch=9999999999999-{writer}-0000000002"
    events.drop("writer", "batch_id").write.parquet(f"{out}/errors/{lost}")
    assert sm.read_stream_errors(spark, out).count() == 6


def test_values_that_do_not_fit_their_declared_field(spark, tmp_path):
    sdf = feed(spark, tmp_path, [(1, "7", 1), (2, "seven", 2), (3, None, 3)])
    out = run(sdf, tmp_path, on_error="reject", schema="name bigint, other string")
    assert rows(sm.read_stream_collection(spark, out)) == [(1, 7, 1), (3, None, 3)]
    assert [r.error.message for r in sm.read_stream_errors(spark, out).collect()] == ["failed to parse field [name]"]
    mapped = sm.stream_to_collection(sdf, f"{tmp_path}/m", f"{tmp_path}/mcp", on_error="reject", mapping={"properties": {"name": {"type": "long"}}})
    mapped.awaitTermination()
    assert sm.read_stream_collection(spark, f"{tmp_path}/m").schema["name"].dataType.simpleString() == "bigint"
    with pytest.raises(Exception, match="seven"):
        run(sdf, f"{tmp_path}/strict", schema="name bigint")
    with pytest.raises(ValueError, match="unknown on_error"):
        sm.stream_to_collection(sdf, out, f"{tmp_path}/x", on_error="skip")
    with pytest.raises(ValueError, match="commit log"):
        sm.stream_to_collection(sdf, out, f"{tmp_path}/x", on_error="reject", commit_log=False)


def test_a_collection_per_name(spark, tmp_path):
    one = [(1, "007", 1), (2, "a.b", 1), (1, "a.b", 5)]
    out = run(feed(spark, tmp_path, one, [(1, "007", 2), (3, "2024", 1)]), tmp_path, id="id", index_pattern="{name}")
    assert rows(sm.read_collection(spark, "007", root=out)) == [(1, "007", 2)]
    assert rows(sm.read_collection(spark, "a.b", root=out)) == [(1, "a.b", 5), (2, "a.b", 1)]
    both = sm.read_collections(spark, "0*,2*", root=out)
    assert rows(both.select("_index", "id", "n")) == [("007", 1, 2), ("2024", 3, 1)]
    # a lost batch shows in none of its collections
    writer = writer_of(f"{tmp_path}/cp")
    lost = spark.createDataFrame([(9, "007", 9), (9, "new", 9)], DDL).withColumn("_index", F.col("name"))
    lost.write.partitionBy("_index").parquet(f"{out}/docs/batch=9999999999999-{writer}-0000000002")
    assert sm.read_collection(spark, "007", root=out).count() == 1
    with pytest.raises(FileNotFoundError):
        sm.read_collection(spark, "new", root=out)
    # only the folders of the name are read
    scan = sm.read_collection(spark, "007", root=out)
    assert all("_index=007" in f for f in scan.inputFiles())
    before = {n: rows(sm.read_collection(spark, n, root=out)) for n in ("007", "a.b", "2024")}
    sm.compact_stream(spark, out, "id")
    sm.expire_batches(spark, out)
    assert {n: rows(sm.read_collection(spark, n, root=out)) for n in before} == before


def test_types_of_several_writers_and_of_one_over_time(spark, tmp_path):
    out = f"{tmp_path}/o"
    frame = lambda ddl, *r: spark.createDataFrame(list(r), ddl)
    save_batch(frame("id int, x bigint", (1, 5)), out, "w", 0)
    save_batch(frame("id int, x string, y int", (2, "five", 1)), out, "w", 1)
    save_batch(frame("id int, x string", (3, "six")), out, "w", 2)
    save_batch(frame("id int, x double", (4, 0.5)), out, "v", 0)
    got = sm.read_stream_collection(spark, out)
    assert rows(got.select("id", "x", "y")) == [(1, "5", None), (2, "five", 1), (3, "six", None), (4, "0.5", None)]


def test_commits_are_listed_once_a_query(spark, tmp_path, monkeypatch):
    from shelfmark.streaming import sink

    asked = []
    listed = sink.finished
    monkeypatch.setattr(sink, "finished", lambda spark, path, pattern: (asked.append(pattern), listed(spark, path, pattern))[1])
    run(feed(spark, tmp_path, ONE, TWO, ONE, TWO), tmp_path)
    assert len(asked) == 1
