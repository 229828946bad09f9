"""Errors as data: rejected rows pass through a chain of handlers, become error events, or are tried
again."""

from __future__ import annotations

import logging
import socket
from collections.abc import Callable, Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.documents import document
from ..sources.catalog import scratch
from .merge import REJECTION, WriteResult

log = logging.getLogger(__name__)

# Per stage, the event type and message of an error event, its category and version.
STAGES = {
    "write": ("bulk_failure", "Encountered Bulk Failure"),
    "serialize": ("serialization_failure", "Could not construct bulk entry from record"),
    "read": ("deserialization_failure", "Could not read record"),
}
EVENT_CATEGORY = "error"
EVENT_VERSION = "0.992"

Handler = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


class RejectedDocuments(RuntimeError):
    """The chain ended with rejected documents nobody handled."""


def log_and_drop(rejected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Handles everything: logs, in one job, how many rows of each error there are and one of them."""
    body = document(rejected, [c for c in rejected.columns if c not in REJECTION])
    summary = rejected.groupBy("_error_type").agg(F.count(F.lit(1)).alias("n"), F.min(body).alias("example"))
    for row in summary.toLocalIterator():
        log.warning("dropped %s documents: %s, for example %s", row["n"], row["_error_type"], row["example"])
    return rejected, rejected.limit(0)


def fail_on_any(rejected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ends the job when there is a rejected row."""
    first = rejected.take(1)
    if first:
        raise RejectedDocuments(f"{first[0]['_error_type']}: {first[0]['_error_reason']}")
    return rejected, rejected


def collect_to(path: str, stage: str = "write", labels: dict | None = None, tags: Iterable[str] = ()) -> Handler:
    """A handler that appends the rejected rows, as error events, to a Parquet collection."""

    def handler(rejected: DataFrame) -> tuple[DataFrame, DataFrame]:
        to_error_events(rejected, labels, tags, stage).write.mode("append").parquet(path)
        return rejected, rejected.limit(0)

    handler.takes_all = True
    return handler


def handle(rejected: DataFrame, handlers: Iterable[str | Handler] = ()) -> DataFrame:
    """Runs rejected rows through the handlers in order and returns the rows that were handled.

    A handler is ``"log"``, ``"fail"`` or a function from a frame to the frames it handled and passed on.
    It aborts by raising. ``fail`` always comes last, so rows nobody handled end the job."""
    named = {"log": log_and_drop, "fail": fail_on_any}
    chain = []
    for h in handlers:
        if isinstance(h, str) and h not in named:
            raise ValueError(f"unknown error handler [{h}]")
        chain.append(named.get(h, h) if isinstance(h, str) else h)
    done, rest = None, rejected
    for handler in chain:
        if handler in (log_and_drop, fail_on_any) or getattr(handler, "takes_all", False):
            handled, rest = handler(rest)
        else:
            handled, rest = _split_checked(handler, rest)
        done = handled if done is None else done.unionByName(handled)
        if handler in (log_and_drop, fail_on_any):
            return done
    handled, _ = fail_on_any(rest)
    return handled if done is None else done


def _split_checked(handler: Handler, rejected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a handler of the caller handled and passed on. It must return every row once: a condition and its opposite
    lose the rows where both are null. The rejected rows are written, and counted on the way, so that the plan
    they come from runs once however many handlers there are."""
    seen = Observation()
    kept = _stored(rejected.observe(seen, F.count(F.lit(1)).alias("n")))
    handled, rest = handler(kept)
    found = handled.select(F.lit(1)).unionAll(rest.select(F.lit(1))).count()
    if found != seen.get["n"]:
        raise ValueError(f"a handler got {seen.get['n']} rejected rows and returned {found}")
    return handled, rest


def to_error_events(
    rejected: DataFrame, labels: dict[str, str] | None = None, tags: Iterable[str] = (), stage: str = "write"
) -> DataFrame:
    """One error event per rejected row: when, tags, labels, message, host, error and the raw document."""
    kind, message = STAGES[stage]
    body = [c for c in rejected.columns if c not in REJECTION]
    columns = [F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("@timestamp")]
    tags = list(tags)
    if tags:
        columns.append(F.array(*(F.lit(t) for t in tags)).alias("tags"))
    if labels:
        columns.append(F.struct(*(F.lit(v).alias(k) for k, v in labels.items())).alias("labels"))
    columns += [
        F.lit(message).alias("message"),
        F.struct(F.lit(socket.gethostname()).alias("name")).alias("host"),
        F.struct(F.col("_error_type").alias("code"), F.col("_error_reason").alias("message")).alias("error"),
        F.struct(
            F.lit(EVENT_CATEGORY).alias("category"),
            F.lit(kind).alias("type"),
            document(rejected, body).alias("raw"),
            F.lit(EVENT_VERSION).alias("version"),
        ).alias("event"),
    ]
    return rejected.select(*columns)


def malformed_as_rejected(df: DataFrame, flag: str = "_malformed", json_col: str = "json") -> tuple[DataFrame, DataFrame]:
    """Splits the output of ``parse_docs(on_error="keep")`` into good rows and rejected rows."""
    good = df.where(~F.col(flag)).drop(flag)
    bad = df.where(F.col(flag)).drop(flag).withColumns(
        {"_status": F.lit(400), "_error_type": F.lit("mapper_parsing"), "_error_reason": F.lit("malformed document")}
    )
    return good, bad


def retry_rejected(
    result: WriteResult, fix: dict[str, Column | str] | Callable[[DataFrame], DataFrame], rounds: int = 1
) -> WriteResult:
    """Edits the rejected rows (by column expressions or a frame function) and writes them again, up to
    ``rounds`` times. What is still rejected stays rejected; already accepted rows are kept."""
    if result.retry is None:
        raise ValueError("this write cannot be retried")
    current, retried = result, list(result.retried)
    for n in range(rounds):
        if n:  # each round starts from written tables, or the plan would multiply with the rounds
            current = replace(current, target=_stored(current.target), rejected=_stored(current.rejected))
        source = current.rejected.drop(*REJECTION)
        if callable(fix):
            edited = fix(source)
        else:
            edited = source.withColumns({k: F.expr(v) if isinstance(v, str) else v for k, v in fix.items()})
        retried.append(edited)
        current = result.retry(current.target, edited)
    return WriteResult(current.target, current.rejected, result.source, result.retry, retried)


def _stored(df: DataFrame) -> DataFrame:
    path = scratch(df.sparkSession, "retry")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
