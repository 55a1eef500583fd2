"""Aggregate stores on a shared filesystem.

``by-source`` store (default): aggregates are written per source file, partitioned by the month in the
file's name and, below it, by a short hash of the file path, with dynamic partition overwrite.
Re-ingesting a file replaces its own partition instead of adding to the totals, so a retried job, a
replayed micro-batch or a file ingested twice never double counts. The public aggregate is the sum
over sources (:func:`read_store`), which Spark computes with a partial aggregation per task; bounds
on the source month prune folders at planning time. Stores whose sources are not below months
are refused until :func:`migrate_store` has moved them.

Landing: :func:`land_games` writes the per-game keys (raw Elo, not bucketed) as parquet
partitioned by source month and source. Compressed dumps are scanned once, one task per file, and every
later aggregation reads a compact, splittable, column-pruned table with any bucket size.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chesstally import fs
from chesstally.functions.eco import with_eco_group
from chesstally.functions.keys import (
    bucket_of,
    eco_code_from_match,
    eco_code_match,
    elo_digits,
    elo_from_digits,
    month_key,
    result_value,
    validate_bucket_size,
)
from chesstally.functions.months import require_month
from chesstally.session import scratch_path
from chesstally.sources.pgn import empty_files, month_of_path, source_month_from_path
from chesstally.operators.aggregate import (
    AGGREGATE_SCHEMA,
    KEY_COLUMNS,
    MEASURE_COLUMNS,
    aggregate_games,
    aggregate_keys,
    game_tags,
    merge_aggregates,
)

PROPS_FILE = "_chesstally.json"
SOURCE_COLUMNS = ["source_id", "source_file", "source_month"]
STORE_PARTITIONS = ["source_month", "source_id"]
STORE_SCHEMA = f"source_file string, {AGGREGATE_SCHEMA}, source_month string, source_id string"
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for a null


def source_id(path_col) -> F.Column:
    """Stable, short partition value for a source file path: ``s`` + 16 hex chars of SHA-256.

    The letter prefix keeps partition discovery from reading an id such as ``1234…`` or
    ``12e4…`` as a number."""
    return F.concat(F.lit("s"), F.substring(F.sha2(path_col, 256), 1, 16))


def id_of(path: str) -> str:
    """:func:`source_id` of a literal path."""
    return "s" + hashlib.sha256(path.encode()).hexdigest()[:16]


def check_bucket_size(spark: SparkSession, store: str, bucket_size: int) -> None:
    """Counts made with different bucket sizes must not be merged: record and check."""
    path = f"{store}/{PROPS_FILE}"
    text = fs.read_text_file(spark, path)
    if text is None:
        fs.mkdirs(spark, store)
        own = f"{store}/.{PROPS_FILE}.{uuid.uuid4().hex}"  # the record appears whole, by a rename
        fs.write_text_file(spark, own, json.dumps({"bucket_size": bucket_size}))
        if fs.rename_if_absent(spark, own, path):
            return
        fs.delete(spark, own)  # another writer was first
        text = fs.read_text_file(spark, path)
    stored = json.loads(text).get("bucket_size")
    if stored != bucket_size:
        raise ValueError(f"store {store} holds bucket_size={stored}, not {bucket_size}")


def aggregate_by_source(games: DataFrame, bucket_size: int = 200) -> DataFrame:
    """Aggregate per (source file, key); ``games`` needs ``source_file`` (as produced by
    :func:`chesstally.sources.pgn.read_games`).

    Only the path is part of the per-game key; its hash id and month are functions of the path,
    computed on the aggregated rows (bounded per file) instead of once per game.
    """
    agg = aggregate_games(games, bucket_size, by=["source_file"])
    return agg.select(
        source_id(F.col("source_file")).alias("source_id"),
        "source_file",
        source_month_from_path(F.col("source_file")).alias("source_month"),
        *KEY_COLUMNS, *MEASURE_COLUMNS)


STORE_ROWS_PER_FILE = 5_000_000


def write_by_source(agg_by_source: DataFrame, store: str, bucket_size: int = 200,
                    files: Sequence[str] | None = None) -> None:
    """Replace the partitions of the sources in ``agg_by_source``; others stay. Writers of different
    sources may run at the same time.

    ``files`` are the files that were read (:func:`chesstally.fs.input_files`): a partition that an earlier
    ingest left for one of them is removed if the file is empty now (and stays if the games were
    filtered, which leaves a file without rows just as well). The rebalance
    hint keeps a source's rows together but lets AQE split a large one.
    """
    spark = agg_by_source.sparkSession
    check_bucket_size(spark, store, bucket_size)
    top = [d.rstrip("/").rsplit("/", 1)[-1] for d in fs.list_dirs(spark, store)]
    _refuse_old_layout(store, top)
    held = {}
    if files:  # folder names only: which of the files have a partition, and of which parts
        folders = [partition_of(f) for f in files]
        months = {p.split("/")[0] for p in folders} & set(top)
        there = {f"{m}/{d.rstrip('/').rsplit('/', 1)[-1]}" for m in months for d in fs.list_dirs(spark, f"{store}/{m}")}
        held = {p: fs.list_files(spark, f"{store}/{p}") for p in folders if p in there}
    (agg_by_source.select("source_file", *KEY_COLUMNS, *MEASURE_COLUMNS, *STORE_PARTITIONS)
     .hint("rebalance", *STORE_PARTITIONS)
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", STORE_ROWS_PER_FILE)
     .partitionBy(*STORE_PARTITIONS)
     .parquet(store))
    stale = [p for p, parts in held.items() if fs.list_files(spark, f"{store}/{p}") == parts]
    if stale:  # not rewritten: their files have no games now, or the games were filtered
        by_folder = {partition_of(f): f for f in files}
        for f in empty_files(spark, [by_folder[p] for p in stale]):
            fs.delete(spark, f"{store}/{partition_of(f)}")


def partition_of(path: str) -> str:
    """The folder of a source file's partition, below the store."""
    return f"source_month={month_of_path(path) or _NO_MONTH}/source_id={id_of(path)}"


def _old_sources(top: list[str]) -> list[str]:
    return [d for d in top if d.rstrip("/").rsplit("/", 1)[-1].startswith("source_id=")]


def _refuse_old_layout(store: str, top: list[str]) -> None:
    if _old_sources(top):
        raise ValueError(f"store {store} has sources without a month level; run migrate_store once")


def migrate_store(spark: SparkSession, store: str) -> int:
    """Move sources that lie directly below the store under their months; returns their number. Repeating
    it after a crash is safe: sources replace themselves, and old folders go last."""
    old = _old_sources(fs.list_dirs(spark, store))
    if not old:
        return 0
    rows = spark.read.schema(f"source_file string, {AGGREGATE_SCHEMA}").parquet(*old)
    moved = scratch_path(spark, "runs", f"migrate-{uuid.uuid4().hex[:12]}")  # reads end before folders go
    rows.select(source_id(F.col("source_file")).alias("source_id"), "source_file",
                source_month_from_path("source_file").alias("source_month"), *KEY_COLUMNS, *MEASURE_COLUMNS
                ).write.parquet(moved)
    (spark.read.parquet(moved).hint("rebalance", *STORE_PARTITIONS)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", STORE_ROWS_PER_FILE).partitionBy(*STORE_PARTITIONS).parquet(store))
    for d in old:
        fs.delete(spark, d)
    fs.delete(spark, moved)
    return len(old)


def ingest_games(games: DataFrame, store: str, bucket_size: int = 200) -> None:
    """Aggregate per source file and replace those sources in the store; a file without games any
    more leaves it."""
    write_by_source(aggregate_by_source(games, bucket_size), store, bucket_size, fs.input_files(games))


def read_store(spark: SparkSession, store: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Public aggregate of a by-source store: measures summed over sources per key. ``since`` and ``until``
    (inclusive, as in ingest plans) keep the sources of those months only; files without a month in
    their name are then left out."""
    return merge_aggregates(read_store_by_source(spark, store, since, until))


def read_store_by_source(spark: SparkSession, store: str, since: str | None = None,
                         until: str | None = None) -> DataFrame:
    """Counts per source and key; bounds on the month prune folders when the scan is planned."""
    _refuse_old_layout(store, fs.list_dirs(spark, store))
    since, until = require_month(since, "since"), require_month(until, "until")
    df = spark.read.schema(STORE_SCHEMA).parquet(store)
    if since:
        df = df.where(F.col("source_month") >= since)
    if until:
        df = df.where(F.col("source_month") <= until)
    return df


LANDED_ROWS_PER_FILE = 5_000_000


def land_games(games: DataFrame, path: str, mode: str = "overwrite",
               rows_per_file: int = LANDED_ROWS_PER_FILE) -> None:
    """Write per-game keys as parquet partitioned by ``source_month`` and, below it, by source.

    Dynamic overwrite replaces the partitions of the files that are landed and no others, so files
    of one month may come in any number of calls, and landing a file again replaces its own games.
    Files without a month in their name share the default month directory, each in its own source
    directory. Reads prune on ``source_month`` as before.

    Columns: ``source_month, source_id, source_file, month, eco_group, white_elo, black_elo, result``;
    Elo values stay unbucketed so any bucket size can be applied later. No shuffle: each scan
    task writes its own games. ``rows_per_file`` caps file size, so a source holding a large
    share of all games (one unsplittable dump scanned by one task) still lands as many
    evenly sized files and later reads are balanced.
    """
    tags = game_tags(games, keep=["source_file", "source_month"])
    raw = tags.select(
        "source_file", "source_month",
        F.coalesce(F.col("UTCDate"), F.col("Date")).alias("__date"),
        eco_code_match("ECO").alias("__eco"),
        elo_digits("WhiteElo").alias("__white"),
        elo_digits("BlackElo").alias("__black"),
        result_value("Result").alias("result"),
    )
    keyed = raw.select(
        "source_file", "source_month",
        month_key("__date", F.lit(None).cast("string")).alias("month"),
        eco_code_from_match(F.col("__eco")).alias("eco_code"),
        elo_from_digits(F.col("__white")).alias("white_elo"),
        elo_from_digits(F.col("__black")).alias("black_elo"),
        "result",
    )
    landed = with_eco_group(keyed, code_col="eco_code").select(
        "source_month", source_id(F.col("source_file")).alias("source_id"), "source_file", "month",
        "eco_group", "white_elo", "black_elo", "result")
    (landed.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", rows_per_file)
     .partitionBy("source_month", "source_id").parquet(path))


def aggregate_landed(spark: SparkSession, path: str, bucket_size: int = 200,
                     source_months: list[str] | None = None) -> DataFrame:
    """Aggregate from landed keys; ``source_months`` prunes partitions at planning time."""
    validate_bucket_size(bucket_size)
    df = spark.read.parquet(path)
    if source_months is not None:
        df = df.where(F.col("source_month").isin(source_months))
    keys = df.select(
        "month", "eco_group",
        bucket_of(F.col("white_elo"), bucket_size).alias("white_bucket"),
        bucket_of(F.col("black_elo"), bucket_size).alias("black_bucket"),
        "result",
    )
    return aggregate_keys(keys)
