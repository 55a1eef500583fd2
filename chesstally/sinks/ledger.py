"""Ingestion ledger: which months were ingested, when, and how many games.

The ledger is an append-only table of events (:mod:`chesstally.sinks.appends`) instead of rows updated in
place: each append is a partition of its own, which suits files on a shared filesystem (no partial
update when a job dies, no rewriting of what is there) and makes the state a single aggregation:

* ``start`` (month, url, at): creates the month's row or, if it exists, replaces ``url``,
  ``started_at`` and sets status ``started``; ``games``, ``duration_ms`` and ``finished_at`` of an
  earlier finish are kept;
* ``finish`` (month, games, duration_ms, status, at): sets those four columns; a finish for a
  month that has no row yet (no earlier start) changes nothing.

State per month, from events ordered by ``seq``: months without a start are absent; ``url`` and
``started_at`` come from the latest start; ``games``/``duration_ms``/``finished_at`` from the
latest finish if that finish follows the first start (else 0, 0, NULL); ``status`` is the latest
finish's status if it follows the latest start, else ``started``.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chesstally.sinks import appends

EVENT_SCHEMA = (
    "month string, seq bigint, kind string, url string, event_at string, "
    "games bigint, duration_ms bigint, status string"
)
STATE_COLUMNS = ["month", "url", "started_at", "finished_at", "games", "duration_ms", "status"]
COMPACT_RUNS = 256  # appends that a job leaves before it compacts the ledger at its end
STATUSES = ("started", "success", "failed")


def utc_now_iso() -> str:
    """RFC 3339 UTC instant, the format of ``started_at`` / ``finished_at``."""
    return _dt.datetime.now(_dt.timezone.utc).isoformat()


def _next_seq() -> int:
    return time.time_ns()


def start_events(spark: SparkSession, items: Iterable[tuple[str, str]], at: str | None = None,
                 ) -> DataFrame:
    """Start events for planned ``(month, url)`` pairs (one row per planned file)."""
    return spark.createDataFrame(start_rows(items, at or utc_now_iso()), EVENT_SCHEMA)


def start_rows(items: Iterable[tuple[str, str]], at: str) -> list[tuple]:
    """Start events as rows in the order of ``EVENT_SCHEMA``."""
    seq = _next_seq()
    return [(m, seq + i, "start", u, at, None, None, "started") for i, (m, u) in enumerate(items)]


def finish_row(month: str, games: int, duration_ms: int, status: str = "success",
               at: str | None = None) -> tuple:
    """One finish event as a row in the order of ``EVENT_SCHEMA``."""
    if status not in STATUSES:
        raise ValueError(f"status must be one of {STATUSES}")
    return (month, _next_seq(), "finish", None, at or utc_now_iso(), games, duration_ms, status)


def finish_events_from(per_month: DataFrame, duration_ms: int, status: str = "success",
                       at: str | None = None) -> DataFrame:
    """Finish events from a DataFrame ``month, games`` computed by Spark (no collect)."""
    if status not in STATUSES:
        raise ValueError(f"status must be one of {STATUSES}")
    at = at or utc_now_iso()
    return per_month.select(
        F.col("month").cast("string"),
        # One finish per month and run: the run's timestamp orders it after this run's starts
        # and before any later run's events (no per-partition id offsets).
        F.lit(_next_seq()).cast("bigint").alias("seq"),
        F.lit("finish").alias("kind"),
        F.lit(None).cast("string").alias("url"),
        F.lit(at).alias("event_at"),
        F.col("games").cast("bigint"),
        F.lit(duration_ms).cast("bigint").alias("duration_ms"),
        F.lit(status).alias("status"),
    )


def append_events(events: DataFrame, ledger_path: str, run: str | None = None) -> None:
    """Add events as one run, of one file where they are few; a run repeated under its id replaces itself."""
    appends.append(events.select(*_event_cols()).hint("rebalance"), ledger_path, run)


def append_rows(spark: SparkSession, rows: list[tuple], ledger_path: str, run: str | None = None) -> None:
    """A few events of a running job, in the order of ``EVENT_SCHEMA``. Jobs may append at the same time."""
    append_events(spark.createDataFrame(rows, EVENT_SCHEMA), ledger_path, run)


def compact(spark: SparkSession, ledger_path: str, least: int = COMPACT_RUNS) -> None:
    """Rewrite the ledger as one partition if it has at least ``least``."""
    if len(appends.runs(spark, ledger_path)) >= least:
        appends.compact(spark, ledger_path, EVENT_SCHEMA)


def _event_cols() -> list[str]:
    return [part.split()[0] for part in EVENT_SCHEMA.split(", ")]


def read_events(spark: SparkSession, ledger_path: str) -> DataFrame:
    return appends.read(spark, ledger_path, EVENT_SCHEMA).select(*_event_cols())


def ledger_state(events: DataFrame) -> DataFrame:
    """Current ledger row per month (``STATE_COLUMNS``), in one aggregation over the events."""
    start = F.col("kind") == F.lit("start")
    finish = F.col("kind") == F.lit("finish")
    start_seq = F.when(start, F.col("seq"))
    finish_seq = F.when(finish, F.col("seq"))
    agg = events.groupBy("month").agg(
        F.min(start_seq).alias("first_start"),
        F.max(start_seq).alias("last_start"),
        F.max(finish_seq).alias("last_finish"),
        F.max_by("url", start_seq).alias("url"),
        F.max_by("event_at", start_seq).alias("started_at"),
        F.max_by("event_at", finish_seq).alias("f_at"),
        F.max_by("games", finish_seq).alias("f_games"),
        F.max_by("duration_ms", finish_seq).alias("f_duration"),
        F.max_by("status", finish_seq).alias("f_status"),
    )
    finished = F.col("last_finish").isNotNull() & (F.col("last_finish") > F.col("first_start"))
    return agg.where(F.col("first_start").isNotNull()).select(
        "month",
        "url",
        "started_at",
        F.when(finished, F.col("f_at")).alias("finished_at"),
        F.when(finished, F.coalesce(F.col("f_games"), F.lit(0))).otherwise(F.lit(0))
         .cast("bigint").alias("games"),
        F.when(finished, F.coalesce(F.col("f_duration"), F.lit(0))).otherwise(F.lit(0))
         .cast("bigint").alias("duration_ms"),
        F.when(F.col("last_finish") > F.col("last_start"), F.col("f_status"))
         .otherwise(F.lit("started")).alias("status"),
    )


def ingested_months(state: DataFrame) -> DataFrame:
    """Distinct months whose status is ``success`` (the months an ingest plan skips)."""
    return state.where(F.col("status") == F.lit("success")).select("month").distinct()


def current_state(spark: SparkSession, ledger_path: str) -> DataFrame:
    return ledger_state(read_events(spark, ledger_path))
