"""Registered queries: ``(spark, sf_dir) -> DataFrame``, one per operator family.

Every query runs over the whole generated PGN (one game per ``lineitem`` row) or over index lines
and ledger events generated from the whole ``orders`` table; none uses a subset. Queries that
exercise sinks/streams write into fresh folders under the session's scratch location.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chesstally import fs
from chesstally.functions.eco import with_eco_group
from chesstally.functions.headers import with_tags
from chesstally.functions.keys import bucket_of, eco_code, elo_value, result_class
from chesstally.jobs import ingest_plan
from chesstally.operators import trends
from chesstally.operators.aggregate import (
    aggregate_games,
    game_keys,
    game_tags,
    merge_aggregates,
    rebalance_games,
    total_games,
    upsert_additive,
)
from chesstally.plans.ingest import build_plan, exclude_done, filter_months
from chesstally.session import scratch_path
from chesstally.sinks import appends, ledger, rollup, store
from chesstally.sinks.csv import (
    CSV_COLUMNS,
    read_aggregates_csv,
    write_csv,
    write_csv_per_source_month,
)
from chesstally.sources.pgn import read_games, read_games_positioned
from chesstally.sources.tables import register_tables
from chesstally.streaming.ingest import run_ingest
from chesstally.streaming.totals import start_running_totals
from chesstally.testing import fixtures
from chesstally.testing.oracle import SQL_INGESTION_STATUS, SQL_OPENING_RESULTS

PLAN_SINCE, PLAN_UNTIL = "1996-3", "2000/10"
MERGE_SPLIT_MONTH = "1998-06"
CUSTOM_BUCKETS = (0, 100, 400)
EMPTY_MONTH = "2030-01"  # beyond all generated months
ZST_SPLIT = 1 << 14
EVENT_SPLIT = 1 << 16


def _run_dir(spark: SparkSession, kind: str) -> str:
    return scratch_path(spark, "runs", f"{kind}-{uuid.uuid4().hex[:12]}")


def games(spark: SparkSession, sf_dir: str, with_source: bool = False, layout: str = "monthly") -> DataFrame:
    return read_games(spark, fixtures.pgn_dataset(spark, sf_dir, layout), with_source=with_source)


def agg_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate_games(games(spark, sf_dir))


def agg_total_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_games(games(spark, sf_dir))


def agg_merge_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = games(spark, sf_dir, with_source=True)
    first = g.where(F.col("source_month") <= F.lit(MERGE_SPLIT_MONTH))
    rest = g.where(F.col("source_month") > F.lit(MERGE_SPLIT_MONTH))
    return merge_aggregates(aggregate_games(first), aggregate_games(rest))


def upsert_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = agg_full(spark, sf_dir)
    return upsert_additive(a, a)


def header_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = game_tags(games(spark, sf_dir))
    names = {"UTCDate": "utc_date", "Date": "date", "ECO": "eco", "WhiteElo": "white_elo",
             "BlackElo": "black_elo", "Result": "result"}
    return (t.select(*[F.col(k).alias(v) for k, v in names.items()])
            .groupBy(*names.values()).agg(F.count(F.lit(1)).alias("games")))


def month_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = game_keys(games(spark, sf_dir))
    return k.groupBy("month").agg(F.count(F.lit(1)).alias("games"))


def result_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = game_keys(games(spark, sf_dir))
    return (k.groupBy(result_class("result").alias("result_class"))
            .agg(F.count(F.lit(1)).alias("games")))


def eco_group_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = game_tags(games(spark, sf_dir)).select(eco_code("ECO").alias("eco_code"))
    g = with_eco_group(t, code_col="eco_code")
    return g.groupBy("eco_code", "eco_group").agg(F.count(F.lit(1)).alias("games"))


def elo_bucket_200(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = game_keys(games(spark, sf_dir), bucket_size=200)
    return (k.groupBy("white_bucket", "black_bucket")
            .agg(F.count(F.lit(1)).alias("games")))


def elo_bucket_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = game_tags(games(spark, sf_dir)).select(
        elo_value("WhiteElo").alias("w"), elo_value("BlackElo").alias("b"))
    per_size = F.array(*[
        F.struct(F.lit(s).alias("bucket_size"),
                 bucket_of(F.col("w"), s).alias("white_bucket"),
                 bucket_of(F.col("b"), s).alias("black_bucket"))
        for s in CUSTOM_BUCKETS])
    return (t.select(F.inline(per_size))
            .groupBy("bucket_size", "white_bucket", "black_bucket")
            .agg(F.count(F.lit(1)).alias("games")))


def game_scan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = games(spark, sf_dir, with_source=True)
    return g.groupBy("source_month").agg(F.count(F.lit(1)).alias("games"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _run_dir(spark, "csv") + "/agg.csv"
    write_csv(agg_full(spark, sf_dir), path)
    return read_aggregates_csv(spark, path)


def csv_per_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _run_dir(spark, "csvm") + "/out/"
    fs.mkdirs(spark, base)
    agg = aggregate_games(games(spark, sf_dir, with_source=True), by=["source_month"])
    write_csv_per_source_month(agg, base)
    back = read_aggregates_csv(spark, base + "*.csv")
    month = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d{4}-\d{2})\.csv$", 1)
    return back.select(month.alias("source_month"), *CSV_COLUMNS)


def store_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _run_dir(spark, "store")
    g = games(spark, sf_dir, with_source=True)
    store.ingest_games(g, path)
    store.ingest_games(g, path)  # replay: overwrites the same source partitions
    return store.read_store(spark, path)


def stream_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = _run_dir(spark, "stream")
    run_ingest(spark, fixtures.pgn_dataset(spark, sf_dir), run + "/store", run + "/checkpoint",
               max_files_per_trigger=25)
    return store.read_store(spark, run + "/store")


def stream_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of files that end in a bare game, appended batch by batch; then the same files from a
    new folder's stream whose state knows them (the second run finds nothing new)."""
    run, dumps = _run_dir(spark, "running"), fixtures.pgn_dataset(spark, sf_dir, "tails")
    for _ in range(2):
        start_running_totals(spark, dumps, run + "/checkpoint", appends.totals_sink(run + "/totals"),
                             max_files_per_trigger=30).awaitTermination()
    return appends.read_totals(spark, run + "/totals")


def stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches bounded by bytes: files of very different lengths; beside the totals the number of
    batches that exceed the bound although they hold several files."""
    run, dumps = _run_dir(spark, "bounded"), fixtures.pgn_dataset(spark, sf_dir)
    bound = max(1, sum(fs.lengths(spark, fs.input_files(spark.read.text(dumps)))) // 7)
    sizes = run_ingest(spark, dumps, run + "/store", run + "/checkpoint", max_bytes_per_trigger=bound)
    over = sum(s.files > 1 and s.bytes > bound for s in sizes)
    return store.read_store(spark, run + "/store").withColumn("batches_over", F.lit(over)).withColumn(
        "batches_missing", F.lit(max(0, 7 - len(sizes))))


def upsert_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Additive upsert of the whole aggregate into a file table, twice (counts double), one of them
    repeated under its run id, with a compaction between."""
    base = _run_dir(spark, "deltas")
    delta = stored_aggregate(spark, sf_dir)
    appends.add_delta(delta, base, run="first")
    appends.add_delta(delta, base, run="second")
    appends.add_delta(delta, base, run="second")
    appends.compact_totals(spark, base)
    appends.add_delta(delta.where("1 = 0"), base)
    return appends.read_totals(spark, base)


def landed_agg_100(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _run_dir(spark, "landed")
    store.land_games(games(spark, sf_dir, with_source=True), path)
    return store.aggregate_landed(spark, path, bucket_size=100)


def landed_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of every month landed in two calls; then one call again (replaces its own files)."""
    path, base = _run_dir(spark, "landed2"), fixtures.pgn_dataset(spark, sf_dir, "halves")
    for run in (0, 1, 0):
        store.land_games(read_games(spark, f"{base}/run={run}"), path)
    return store.aggregate_landed(spark, path, bucket_size=100)


def scan_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate_games(read_games(spark, fixtures.pgn_dataset(spark, sf_dir, "tails"), with_source=False))


def scan_zst_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zstd dumps of many frames, a few frames to a task."""
    dumps = fixtures.pgn_dataset(spark, sf_dir, "zst")
    return aggregate_games(read_games(spark, dumps, with_source=False, zst_frames=True, split_bytes=ZST_SPLIT))


def event_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event and opening of every game, where Event lines hold quotes and headers."""
    games = read_games_positioned(spark, fixtures.pgn_dataset(spark, sf_dir, "events"), split_bytes=EVENT_SPLIT)
    tags = with_tags(games, "game", ("Event", "ECO")).select(F.col("Event").alias("event"), eco_code("ECO").alias("eco_code"))
    return tags.groupBy("event", "eco_code").agg(F.count(F.lit(1)).alias("games"))


def scan_compressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gzip dumps, dealt to more tasks for parsing, with a missing path in the list."""
    gz = fixtures.pgn_dataset(spark, sf_dir, "gzip")
    g = read_games(spark, [gz, gz + "-missing"], skip_missing=True)
    return aggregate_games(rebalance_games(g, 8))


def ingest_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plan of one dump per quarter (named by its first month, in one or more files), one of them empty: the
    dumps up to a bound, then all that the ledger leaves, then nothing any more. The ledger's month, status and
    games beside the store's games. (Spark reads zstd but does not write it: plain text.)"""
    run = _run_dir(spark, "resume")
    quarter = F.date_format(F.date_trunc("quarter", F.to_date("source_month", "yyyy-MM")), "yyyy-MM")
    rows = fixtures.game_rows(spark, sf_dir).withColumn("source_month", quarter)
    dumps = fixtures.write_dumps(spark, rows, run + "/dumps")
    dumps[EMPTY_MONTH] = [f"{run}/dumps/games_rated_{EMPTY_MONTH}.pgn"]
    fs.write_text_file(spark, dumps[EMPTY_MONTH][0], "")
    plan = spark.createDataFrame(sorted((m, url) for m, urls in dumps.items() for url in urls), "month string, url string")
    for until in (MERGE_SPLIT_MONTH, None, None):
        done = ledger.ingested_months(ledger.current_state(spark, run + "/ledger"))
        ingest_plan(spark, exclude_done(filter_months(plan, until=until), done), run + "/store",
                    run + "/ledger", months_at_once=8)
    state = ledger.current_state(spark, run + "/ledger").select("month", "status", "games")
    held = (store.read_store_by_source(spark, run + "/store").groupBy(F.col("source_month").alias("month"))
            .agg(F.sum("games").alias("stored")))
    return state.join(held, "month", "left").select(
        "month", "status", "games", F.coalesce("stored", F.lit(0)).alias("stored"))


def store_reingest_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month's files (gzip) ingested; then a third of the months have no games any more, a third has
    half of them, and all are ingested again."""
    run = _run_dir(spark, "changed")
    g = fixtures.game_rows(spark, sf_dir)
    dumps = fixtures.write_dumps(spark, g, run + "/dumps", packed=True)
    store.ingest_games(read_games(spark, run + "/dumps"), run + "/store")
    third = F.substring("source_month", 6, 2).cast("int") % 3
    fixtures.write_dumps(spark, g.where((third == 1) & (F.col("l_orderkey") % 2 == 0)), run + "/dumps", packed=True)
    for month, paths in dumps.items():
        if int(month[5:7]) % 3 == 0:
            for path in paths:
                fs.write_text_file(spark, path, "")
    store.ingest_games(read_games(spark, run + "/dumps"), run + "/store")
    return store.read_store(spark, run + "/store")


def store_month_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored counts of a range of source months, whose folders alone are read."""
    run = _run_dir(spark, "range")
    store.ingest_games(games(spark, sf_dir, with_source=True), run + "/store")
    return store.read_store(spark, run + "/store", PLAN_SINCE, PLAN_UNTIL)


def rollup_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-up after two ingests, the second of which refreshes its own months only."""
    run, base = _run_dir(spark, "rollup"), fixtures.pgn_dataset(spark, sf_dir)
    g = read_games(spark, base)
    rollup.ingest_games(g.where(F.col("source_month") <= MERGE_SPLIT_MONTH), run + "/store", run + "/rollup")
    rollup.ingest_games(g.where(F.col("source_month") >= MERGE_SPLIT_MONTH), run + "/store", run + "/rollup")
    return rollup.read_rollup(spark, run + "/rollup")


def csv_order_width_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written CSV at bucket width 1, where nearly every game is a key of its own (games of gzip files: these
    and the CSV are both as long as the table)."""
    path = _run_dir(spark, "csvw") + "/agg.csv"
    write_csv(aggregate_games(games(spark, sf_dir, layout="gzip"), bucket_size=1), path)
    return _numbered(spark, read_aggregates_csv(spark, path))


def csv_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the written CSV with their position in the file."""
    path = _run_dir(spark, "csvo") + "/agg.csv"
    write_csv(stored_aggregate(spark, sf_dir), path)
    return _numbered(spark, read_aggregates_csv(spark, path))


def _numbered(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Position of every row, from 1, in the order of the partitions: a row's number in its partition behind
    the rows of those before. The numbered rows are kept, because a sort computed again may deal them differently."""
    path = _run_dir(spark, "numbered")
    df.withColumn("__id", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("__part", F.shiftright("__id", 33))
    sizes = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = sizes.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    position = F.col("__start") + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)) + F.lit(1)
    return rows.join(F.broadcast(starts), "__part").select(*df.columns, position.cast("int").alias("position"))


def plan_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(spark, plan_range(spark, sf_dir))


def ledger_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to the ledger in three calls, out of order; its state afterwards."""
    path = _run_dir(spark, "appends")
    events = fixtures.generated_ledger_events(spark, sf_dir)
    for part in (2, 0, 1):
        ledger.append_events(events.where(F.col("seq") % 3 == part), path)
    return ledger.current_state(spark, path)


def plan_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_plan(fixtures.generated_index_lines(spark, sf_dir), PLAN_SINCE, PLAN_UNTIL)


def ledger_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.ledger_state(fixtures.generated_ledger_events(spark, sf_dir))


def plan_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = ledger.ingested_months(ledger_state(spark, sf_dir))
    return build_plan(fixtures.generated_index_lines(spark, sf_dir), PLAN_SINCE, PLAN_UNTIL, done)


def stored_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregate of the whole generated game set, materialised once (see
    :func:`chesstally.testing.fixtures.aggregate_table`)."""
    return spark.read.parquet(fixtures.aggregate_table(spark, sf_dir))


def opening_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.opening_popularity(stored_aggregate(spark, sf_dir))


def result_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.result_rates(stored_aggregate(spark, sf_dir))


def elo_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.elo_performance(stored_aggregate(spark, sf_dir))


def monthly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.monthly_trend(stored_aggregate(spark, sf_dir))


def top_openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.top_openings(stored_aggregate(spark, sf_dir), k=3)


def rollup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.rollup_counts(stored_aggregate(spark, sf_dir))


def elo_gap_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.elo_gap_performance(stored_aggregate(spark, sf_dir))


def opening_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.opening_trend(stored_aggregate(spark, sf_dir))


def sql_on_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_tables(spark, aggregates=stored_aggregate(spark, sf_dir))
    return spark.sql(SQL_OPENING_RESULTS)


def sql_on_ingestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_tables(spark, ingestions=ledger_state(spark, sf_dir))
    return spark.sql(SQL_INGESTION_STATUS)


def cube_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.cube_counts(stored_aggregate(spark, sf_dir), ("white_bucket", "black_bucket"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "agg_full": agg_full,
    "agg_total_games": agg_total_games,
    "agg_merge_batches": agg_merge_batches,
    "upsert_additive": upsert_twice,
    "header_tags": header_tags,
    "month_key": month_key_counts,
    "result_class": result_class_counts,
    "eco_group_lookup": eco_group_lookup,
    "elo_bucket_200": elo_bucket_200,
    "elo_bucket_custom": elo_bucket_custom,
    "game_scan_count": game_scan_count,
    "csv_roundtrip": csv_roundtrip,
    "csv_per_month": csv_per_month,
    "store_replay": store_replay,
    "stream_agg": stream_agg,
    "stream_running_totals": stream_running_totals,
    "stream_bounded": stream_bounded,
    "landed_agg_100": landed_agg_100,
    "plan_range": plan_range,
    "plan_pending": plan_pending,
    "ledger_state": ledger_state,
    "opening_popularity": opening_popularity,
    "result_rates": result_rates,
    "elo_performance": elo_performance,
    "monthly_trend": monthly_trend,
    "top_openings": top_openings,
    "rollup_counts": rollup_counts,
    "cube_buckets": cube_buckets,
    "elo_gap_performance": elo_gap_performance,
    "opening_trend": opening_trend,
    "upsert_versioned": upsert_versioned,
    "sql_on_aggregates": sql_on_aggregates,
    "sql_on_ingestions": sql_on_ingestions,
    "landed_two_runs": landed_two_runs,
    "scan_tail": scan_tail,
    "scan_compressed": scan_compressed,
    "scan_zst_frames": scan_zst_frames,
    "event_tag": event_tag,
    "ingest_resume": ingest_resume,
    "store_reingest_changed": store_reingest_changed,
    "csv_order": csv_order,
    "csv_order_width_1": csv_order_width_1,
    "store_month_range": store_month_range,
    "rollup_incremental": rollup_incremental,
    "plan_order": plan_order,
    "ledger_appends": ledger_appends,
}
