"""End-to-end jobs.

* :func:`aggregate_files`: PGN files -> aggregate table (optionally one CSV), one Spark job.
* :func:`run_files`: the given files -> per-source table, from which every output is derived.
* :func:`run_index` / :func:`ingest_plan`: planned dump files, month by month on one path
  (:func:`_ingest_months`). Each month commits by itself: ledger ``started``, scan and aggregate,
  CSV, store, database, then ``success`` with the month's games (0 included) and its own duration.
  A month that fails is recorded as ``failed``, named in the result's ``failed``, and the others go on;
  both ``started`` and ``failed`` months are planned again. Several months run at a time in one session,
  so small months do not leave executors idle; each has a scheduler pool of its own (fair, if the
  session's ``spark.scheduler.mode`` is ``FAIR``), so a large month does not hold up small ones, and a job
  tag, by which what is left of a failed month is cancelled. The store replaces sources, so a retry
  never double counts.
"""

from __future__ import annotations

import sys
import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chesstally import fs
from chesstally.operators.aggregate import aggregate_games, merge_aggregates, rebalance_games
from chesstally.plans.ingest import build_plan
from chesstally.session import scratch_path
from chesstally.sinks import jdbc
from chesstally.sinks import ledger as ledger_mod
from chesstally.sinks import rollup as rollup_mod
from chesstally.sinks.csv import write_csv, write_csv_per_source_month
from chesstally.sinks.store import aggregate_by_source, check_bucket_size, write_by_source
from chesstally.sources.pgn import read_games


def aggregate_files(spark: SparkSession, paths, bucket_size: int = 200,
                    csv_path: str | None = None, skip_missing: bool = True) -> DataFrame:
    """The aggregate of the given files: a lazy frame, or with ``csv_path`` (written as one CSV) a
    read of the written aggregate, so that later actions do not parse the games again."""
    games = read_games(spark, paths, skip_missing=skip_missing, with_source=False)
    agg = aggregate_games(games, bucket_size)
    if csv_path:
        path = scratch_path(spark, "runs", f"aggregate-{uuid.uuid4().hex[:12]}")
        agg.write.parquet(path)
        agg = spark.read.parquet(path)
        write_csv(agg, csv_path)
    return agg


def plan_from_index(spark: SparkSession, index_path: str, since: str | None = None,
                    until: str | None = None, ledger_path: str | None = None) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(index_path)
    done = None
    if ledger_path is not None:
        done = ledger_mod.ingested_months(ledger_mod.current_state(spark, ledger_path))
    return build_plan(lines, since, until, done)


def _by_source_table(spark: SparkSession, games: DataFrame, bucket_size: int) -> tuple[DataFrame, str]:
    """Aggregate per source file once and keep it as a written table (cuts the lineage: the
    outputs below read this small table instead of re-scanning the games); the table and its path,
    which the caller deletes."""
    path = scratch_path(spark, "runs", f"by-source-{uuid.uuid4().hex[:12]}")
    aggregate_by_source(games, bucket_size).write.parquet(path)
    return spark.read.parquet(path), path


def _outputs(spark: SparkSession, by_source: DataFrame, bucket_size: int, store: str | None,
             jdbc_url: str | None, db_batch_rows: int = 1000,
             files: list[str] | None = None, rollup: str | None = None) -> DataFrame:
    agg = merge_aggregates(by_source)
    if store:
        _into_store(by_source, store, bucket_size, files or [], rollup)
        if rollup:
            rollup_mod.refresh(spark, store, rollup)
    if jdbc_url:
        jdbc.upsert_aggregates(agg, jdbc_url, batch_rows=db_batch_rows)
    return agg


def _into_store(by_source: DataFrame, store: str, bucket_size: int, files: list[str],
                rollup: str | None) -> None:
    """Replace the files' counts in the store, having noted the roll-up's months that this changes."""
    if rollup:
        rollup_mod.note_ingest(by_source, files, store, rollup)
    write_by_source(by_source, store, bucket_size, files)


def _prepare_database(spark: SparkSession, jdbc_url: str | None) -> None:
    if jdbc_url:
        jdbc.create_tables(spark, jdbc_url)


def run_files(spark: SparkSession, paths, out: str | None = None, bucket_size: int = 200,
              store: str | None = None, jdbc_url: str | None = None,
              rebalance: int | None = None, recursive: bool = False,
              db_batch_rows: int = 1000, exact_tail: bool = True) -> int:
    """Local workflow: aggregate the given files (or folders); returns the number of games."""
    return run_files_counted(spark, paths, out, bucket_size, store, jdbc_url, rebalance,
                             recursive, db_batch_rows, exact_tail)


def run_files_counted(spark: SparkSession, paths, out: str | None = None, bucket_size: int = 200,
                      store: str | None = None, jdbc_url: str | None = None,
                      rebalance: int | None = None, recursive: bool = False,
                      db_batch_rows: int = 1000,
                      exact_tail: bool = True,
                      per_file: Callable[[str, int], None] | None = None, zst_frames: bool = False,
                      rollup: str | None = None) -> int:
    """:func:`run_files`; ``per_file(path, games)`` is called for each source file (qualified path) with
    games, read from the per-source table (one row per file and key; no second scan)."""
    _prepare_database(spark, jdbc_url)
    games = read_games(spark, paths, skip_missing=True, recursive=recursive, exact_tail=exact_tail,
                       zst_frames=zst_frames)
    files = fs.input_files(games)
    by_source, path = _by_source_table(spark, rebalance_games(games, rebalance), bucket_size)
    agg = _outputs(spark, by_source, bucket_size, store, jdbc_url, db_batch_rows, files, rollup)
    if out:
        write_csv(agg, out)
    if per_file:  # as many rows as files, a partition of them at a time
        for r in by_source.groupBy("source_file").agg(F.sum("games").alias("games")).toLocalIterator():
            per_file(r.source_file, int(r.games))
    total = by_source.agg(F.coalesce(F.sum("games"), F.lit(0)).alias("games")).first()["games"]
    fs.delete(spark, path)
    return int(total)


class MonthCounts(dict[str, int]):
    """Games of this run by month that succeeded; ``failed`` has the other months and why."""

    def __init__(self, games: dict[str, int] | None = None, failed: dict[str, str] | None = None) -> None:
        super().__init__(games or {})
        self.failed = failed or {}


@dataclass
class _Ledgers:
    """Start and finish of months in the file ledger, the database, or neither.

    Months run at the same time; each appends its own events (:func:`ledger.append_rows`)."""

    spark: SparkSession
    path: str | None = None
    jdbc_url: str | None = None
    lock: threading.Lock = field(default_factory=threading.Lock)

    def start(self, month: str, urls: list[str]) -> None:
        at = ledger_mod.utc_now_iso()
        if self.path:
            ledger_mod.append_rows(self.spark, ledger_mod.start_rows([(month, u) for u in urls], at), self.path)
        if self.jdbc_url:
            with self.lock:
                for u in urls:
                    jdbc.mark_ingestion_start(self.spark, self.jdbc_url, month, u, at)

    def finish(self, month: str, games: int, ms: int, status: str) -> None:
        if self.path:
            ledger_mod.append_rows(self.spark, [ledger_mod.finish_row(month, games, ms, status)], self.path)
        if self.jdbc_url:
            with self.lock:
                jdbc.mark_ingestion_finish(self.spark, self.jdbc_url, month, games, ms, status,
                                           ledger_mod.utc_now_iso())

    def close(self) -> None:
        if self.path:
            ledger_mod.compact(self.spark, self.path)


def _ingest_months(spark: SparkSession, items: list[tuple[str, str]], ledgers: _Ledgers,
                   out: str | None = None, bucket_size: int = 200, store: str | None = None,
                   jdbc_url: str | None = None, rebalance: int | None = None, db_batch_rows: int = 1000,
                   exact_tail: bool = True, months_at_once: int = 4, zst_frames: bool = False,
                   rollup: str | None = None) -> MonthCounts:
    """Ingest the planned ``(month, url)`` items. Games are those of the month's files of this run,
    whatever the store holds."""
    if not items:
        print("No files to process.")
        return MonthCounts()
    months: dict[str, list[str]] = {}
    for month, url in items:
        months.setdefault(month, []).append(url)
    database = threading.Lock()  # months are merged into it in turn
    if store:
        check_bucket_size(spark, store, bucket_size)

    failed: dict[str, str] = {}
    sc = spark.sparkContext

    def one(month: str) -> int | None:
        urls = list(dict.fromkeys(months[month]))  # a repeated index line is not read twice
        t0 = time.time()
        path = None
        tag = f"ingest-{month}-{uuid.uuid4().hex[:8]}"
        sc.setLocalProperty("spark.scheduler.pool", f"ingest-{month}")  # of this thread's jobs
        sc.addJobTag(tag)
        try:
            ledgers.start(month, months[month])
            games = read_games(spark, urls, exact_tail=exact_tail, zst_frames=zst_frames)
            files = fs.input_files(games)
            by_source, path = _by_source_table(spark, rebalance_games(games, rebalance), bucket_size)
            if out:
                per_month = merge_aggregates(by_source).withColumn("source_month", F.lit(month))
                write_csv_per_source_month(per_month, out)
            n = by_source.agg(F.coalesce(F.sum("games"), F.lit(0)).alias("games")).first()["games"]
            # Recorded duration: scan, aggregation and CSV output, not the store/database writes.
            ms = max(1, int((time.time() - t0) * 1000))
            if store:  # each month replaces its own sources' partitions
                _into_store(by_source, store, bucket_size, files, rollup)
            if jdbc_url:
                with database:
                    jdbc.upsert_aggregates(merge_aggregates(by_source), jdbc_url, batch_rows=db_batch_rows)
            ledgers.finish(month, int(n), ms, "success")
            return int(n)
        except Exception as exc:  # one month's failure must not lose the others
            failed[month] = str(exc).splitlines()[0] if str(exc) else type(exc).__name__
            print(f"{month} failed: {failed[month]}", file=sys.stderr)
            sc.cancelJobsWithTag(tag)  # what it has left running
            sc.removeJobTag(tag)
            try:
                ledgers.finish(month, 0, max(1, int((time.time() - t0) * 1000)), "failed")
            except Exception as also:  # the ledger itself: the month stays ``started`` and is planned again
                print(f"{month} not recorded as failed: {also}", file=sys.stderr)
            return None
        finally:
            sc.removeJobTag(tag)
            sc.setLocalProperty("spark.scheduler.pool", None)
            if path:
                fs.delete(spark, path)

    try:
        with ThreadPoolExecutor(max(1, months_at_once)) as pool:  # in plan order: oldest first
            done = dict(zip(months, pool.map(one, months)))
        if store and rollup:
            rollup_mod.refresh(spark, store, rollup)
    finally:
        ledgers.close()
    return MonthCounts({m: n for m, n in done.items() if n is not None}, failed)


def run_index(spark: SparkSession, index_path: str, since: str | None = None,
              until: str | None = None, out: str | None = None, bucket_size: int = 200,
              store: str | None = None, ledger_path: str | None = None,
              jdbc_url: str | None = None, rebalance: int | None = None,
              db_batch_rows: int = 1000, exact_tail: bool = True,
              months_at_once: int = 4, zst_frames: bool = False, rollup: str | None = None) -> MonthCounts:
    """Index workflow: plan dump files, then ingest month by month; returns ``{month: games}`` with
    ``failed``. With a store, ``rollup`` names the roll-up that is refreshed for what the months change."""
    _prepare_database(spark, jdbc_url)
    db_ledger = bool(jdbc_url) and not ledger_path  # ledger rows in the database
    if db_ledger:
        lines = spark.read.option("lineSep", "\n").text(index_path)
        plan = build_plan(lines, since, until, jdbc.read_ingested_months(spark, jdbc_url))
    else:
        plan = plan_from_index(spark, index_path, since, until, ledger_path)
    items = [(r.month, r.url) for r in plan.collect()]  # one row per dump file
    ledgers = _Ledgers(spark, ledger_path, jdbc_url if db_ledger else None)
    return _ingest_months(spark, items, ledgers, out, bucket_size, store, jdbc_url, rebalance,
                          db_batch_rows, exact_tail, months_at_once, zst_frames, rollup)


def ingest_plan(spark: SparkSession, plan: DataFrame, store: str, ledger_path: str | None = None,
                bucket_size: int = 200, months_at_once: int = 4, rollup: str | None = None) -> MonthCounts:
    """Ingest every planned file into the store; returns ``{month: games of this run}`` with ``failed``."""
    items = [(r.month, r.url) for r in plan.select("month", "url").collect()]
    return _ingest_months(spark, items, _Ledgers(spark, ledger_path), None, bucket_size, store,
                          months_at_once=months_at_once, rollup=rollup)
