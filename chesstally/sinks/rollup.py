"""A materialised roll-up, refreshed for the months that an ingest touches.

Counts are additive and every level but the grand total lies within one month, so the table (partitioned by
month) holds the grouping sets below it: per month and opening group, and per month. An ingest of some files
changes the months that these files counted before and those they count now; only they are computed
anew, and the grand total is the sum of the months' rows when the table is read.

The months are noted beside the table before the store changes and the note goes when they have been
refreshed, so a job that dies in between leaves a note, which the next refresh takes in.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chesstally import fs
from chesstally.operators.aggregate import MEASURE_COLUMNS
from chesstally.session import scratch_path
from chesstally.sinks.store import (
    aggregate_by_source,
    check_bucket_size,
    id_of,
    read_store,
    read_store_by_source,
    write_by_source,
)

_MEASURES = ", ".join(f"{m} bigint" for m in MEASURE_COLUMNS)
ROLLUP_SCHEMA = f"eco_group string, {_MEASURES}, month string"


def _notes(spark: SparkSession, rollup: str) -> list[str]:
    return fs.list_files(spark, f"{rollup}/_pending", ".json")


def note_months(spark: SparkSession, rollup: str, months: Iterable[str]) -> str:
    """Note months that are about to change; returns the note's path."""
    path = f"{rollup}/_pending/{uuid.uuid4().hex}.json"
    fs.mkdirs(spark, f"{rollup}/_pending")
    fs.write_text_file(spark, path, json.dumps(sorted(set(months))))
    return path


def refresh(spark: SparkSession, store: str, rollup: str) -> list[str]:
    """Compute the noted months anew from the store; returns them. The other months' folders stay untouched."""
    notes = _notes(spark, rollup)
    months = sorted({m for n in notes for m in json.loads(fs.read_text_file(spark, n) or "[]")})
    if months:
        rows = read_store(spark, store).where(F.col("month").isin(months))
        levels = (rows.groupingSets([["month", "eco_group"], ["month"]], "month", "eco_group")
                  .agg(*(F.sum(m).alias(m) for m in MEASURE_COLUMNS)))
        before = {m: fs.list_files(spark, f"{rollup}/month={m}") for m in months}
        (levels.select("eco_group", *MEASURE_COLUMNS, "month").hint("rebalance", "month")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(rollup))
        for m, parts in before.items():  # months without games any more
            if parts and fs.list_files(spark, f"{rollup}/month={m}") == parts:
                fs.delete(spark, f"{rollup}/month={m}")
    for n in notes:
        fs.delete(spark, n)
    return months


def note_ingest(new: DataFrame, files: list[str], store: str, rollup: str) -> list[str]:
    """Note the months that replacing the files' counts in the store by ``new`` changes: those that the files
    count now and those they counted before. To be called before the store is written; returns them."""
    spark = new.sparkSession
    touched = new.select("month")
    if any("source_month=" in d for d in fs.list_dirs(spark, store)):
        ids = spark.createDataFrame([(id_of(f),) for f in files], "source_id string")
        touched = touched.unionByName(
            read_store_by_source(spark, store).join(ids, "source_id", "left_semi").select("month"))
    months = sorted(r.month for r in touched.distinct().toLocalIterator())
    if months:
        note_months(spark, rollup, months)
    return months


def ingest_games(games: DataFrame, store: str, rollup: str, bucket_size: int = 200) -> list[str]:
    """:func:`chesstally.sinks.store.ingest_games`, then the roll-up's touched months; returns them."""
    spark = games.sparkSession
    check_bucket_size(spark, store, bucket_size)
    files = fs.input_files(games)
    path = scratch_path(spark, "runs", f"by-source-{uuid.uuid4().hex[:12]}")
    aggregate_by_source(games, bucket_size).write.parquet(path)
    new = spark.read.parquet(path)
    note_ingest(new, files, store, rollup)
    write_by_source(new, store, bucket_size, files)
    fs.delete(spark, path)
    return refresh(spark, store, rollup)


def read_rollup(spark: SparkSession, rollup: str) -> DataFrame:
    """Subtotals per (month, eco_group), per month, and the grand total (NULL = all), as
    :func:`chesstally.operators.trends.rollup_counts` computes them."""
    levels = spark.read.schema(ROLLUP_SCHEMA).parquet(rollup).select("month", "eco_group", *MEASURE_COLUMNS)
    total = (levels.where("eco_group is null").agg(*(F.sum(m).alias(m) for m in MEASURE_COLUMNS))
             .select(F.lit(None).cast("string").alias("month"), F.lit(None).cast("string").alias("eco_group"),
                     *MEASURE_COLUMNS))
    return levels.unionByName(total)
