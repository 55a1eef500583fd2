"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chesstally.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the folder that driver and executors share."""
    return scratch_path(spark, "llm", f"{label}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so that a lost
    executor costs a reread and not a recomputation, and lets several consumers share it."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def text_of(col: str | Column) -> Column:
    """The text column; null counts as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def sample_by_hash(df: DataFrame, key: str, most: int, seed: int) -> DataFrame:
    """At most ``most`` rows, those with the least hashes of ``key``: the same rows in every run. Rows
    far above the expected bound are left out first, so tasks do not each send ``most`` rows."""
    order = F.xxhash64(F.lit(seed), F.col(key))
    n = df.count()
    if n > 4 * most:
        df = df.where(order < F.lit(int(2.0 ** 64 * min(1.0, 2 * most / n)) - 2 ** 63))
    return df.orderBy(order, key).limit(most)


def slices(batches: Iterator[pa.RecordBatch], max_rows: int = 512,
           max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to a bounded number of rows and (but for single rows) bytes, so that the
    Python objects made from a slice stay small however long the texts are."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        step = max(1, min(max_rows, int(n * max_bytes / max(1, batch.nbytes))))
        for at in range(0, n, step):
            yield batch.slice(at, step)
