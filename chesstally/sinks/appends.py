"""Append-only parquet tables: every run adds one partition, state is an aggregation at read time.

``append`` writes a run's rows as the partition ``run=<id>``, by dynamic partition overwrite: it touches no
other partition, so its cost does not grow with the table, writers of different runs do not disturb each
other, readers see a run whole or not, and a run that is repeated under its id replaces itself.

``compact`` rewrites the partitions that there are as one. The new partition lists the runs it holds (in
a row of its own), and ``read`` leaves those out, so rows never count twice: not while the
old folders still exist, and not if the job dies before it has deleted them.

Used for ledger events (:mod:`chesstally.sinks.ledger`) and for deltas of the aggregate, whose sum is
the stored aggregate: the reference's additive upsert and the sink of the running-totals stream.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chesstally import fs
from chesstally.operators.aggregate import AGGREGATE_SCHEMA, merge_aggregates
from chesstally.sinks.store import check_bucket_size

RUN, HOLDS = "run", "held_runs"
_COMPACTED = "compacted-"


def new_run() -> str:
    """An id for a run that is not repeated (a letter first: partition values are not to look like numbers)."""
    return f"r{uuid.uuid4().hex[:16]}"


def append(df: DataFrame, table: str, run: str | None = None) -> str:
    """Add the rows of ``df`` as a run (replacing an earlier run of that id); returns the id."""
    spark = df.sparkSession
    run = run or new_run()
    if not run.replace("-", "").replace("_", "").isalnum() or not run[0].isalpha():
        raise ValueError(f"a run id is letters, digits, - and _, and begins with a letter: {run!r}")
    before = fs.list_files(spark, f"{table}/{RUN}={run}")
    (df.withColumn(HOLDS, F.lit(None).cast("array<string>")).withColumn(RUN, F.lit(run))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(table))
    if before and fs.list_files(spark, f"{table}/{RUN}={run}") == before:
        fs.delete(spark, f"{table}/{RUN}={run}")  # the repeated run has no rows any more
    return run


def runs(spark: SparkSession, table: str) -> list[str]:
    """Ids of the table's partitions, by folder names."""
    names = (d.rstrip("/").rsplit("/", 1)[-1] for d in fs.list_dirs(spark, table))
    return sorted(n.removeprefix(f"{RUN}=") for n in names if n.startswith(f"{RUN}="))


def read(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """All rows, with their ``run``; an absent table is empty."""
    there = runs(spark, table)
    full_schema = f"{schema}, {HOLDS} array<string>, {RUN} string"
    if not there:
        return spark.createDataFrame([], full_schema).drop(HOLDS)
    every = spark.read.schema(full_schema).parquet(table)
    rows = every.where(F.col(HOLDS).isNull())
    if any(r.startswith(_COMPACTED) for r in there):  # partition pruning: only compacted ones list runs
        held = (every.where(F.col(RUN).startswith(_COMPACTED) & F.col(HOLDS).isNotNull())
                .select(F.explode(HOLDS).alias(RUN)).distinct())
        rows = rows.join(held, RUN, "left_anti")
    return rows.select(*[c for c in every.columns if c not in (HOLDS, RUN)], RUN)


def compact(spark: SparkSession, table: str, schema: str,
            merge: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Rewrite the present runs as one partition (``merge`` may add their rows up), then delete their
    folders. Runs that are added meanwhile stay as they are. One compaction at a time."""
    there = runs(spark, table)
    if len(there) < 2:
        return
    rows = read(spark, table, schema)
    columns = [c for c in rows.columns if c != RUN]
    rows = rows.where(F.col(RUN).isin(there)).select(columns)
    kept = (merge(rows) if merge else rows).select(columns).withColumn(HOLDS, F.lit(None).cast("array<string>"))
    note = spark.createDataFrame([(there,)], f"{HOLDS} array<string>")
    run = f"{_COMPACTED}{uuid.uuid4().hex[:16]}"
    (kept.unionByName(note, allowMissingColumns=True).withColumn(RUN, F.lit(run))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(table))
    for r in there:
        fs.delete(spark, f"{table}/{RUN}={r}")


def add_delta(delta: DataFrame, table: str, bucket_size: int = 200, run: str | None = None) -> str:
    """Stored aggregate += ``delta``, like ``INSERT ... ON CONFLICT DO UPDATE SET games = games + ...``: the
    same delta under two runs counts twice, under one run once. The table records its Elo bucket size; a
    delta made with another size is refused."""
    check_bucket_size(delta.sparkSession, table, bucket_size)
    return append(delta.select(*_columns()), table, run)


def read_totals(spark: SparkSession, table: str) -> DataFrame:
    """The stored aggregate: deltas summed per key; keys whose games add up to none are gone."""
    return merge_aggregates(read(spark, table, AGGREGATE_SCHEMA)).where(F.col("games") != 0)


def compact_totals(spark: SparkSession, table: str) -> None:
    compact(spark, table, AGGREGATE_SCHEMA, merge_aggregates)


def totals_sink(table: str, bucket_size: int = 200, name: str = "stream") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that adds each micro-batch's delta; a replayed batch replaces itself.
    Streams with checkpoints of their own that share a table need different names."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        add_delta(batch, table, bucket_size, f"{name}-{batch_id}")

    return sink


def _columns() -> list[str]:
    return [part.split()[0] for part in AGGREGATE_SCHEMA.split(", ")]
