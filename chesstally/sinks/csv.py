"""CSV outputs of the aggregate table.

Header ``month,eco_group,white_bucket,black_bucket,games,white_wins,black_wins,draws``, no
quoting, rows by ``games`` descending (ties by key, ascending, so the file is deterministic).
The sort is distributed by ranges of the order, so no task holds all rows even where the bucket width is
1 and there are nearly as many keys as games; sorted ranges are written as parts without a header,
and the file system joins a header and the parts, in their order, into the one file.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chesstally import fs
from chesstally.operators.aggregate import AGGREGATE_SCHEMA, KEY_COLUMNS, MEASURE_COLUMNS

CSV_COLUMNS = [*KEY_COLUMNS, *MEASURE_COLUMNS]


def csv_order(df: DataFrame) -> DataFrame:
    return df.select(*CSV_COLUMNS).orderBy(F.desc("games"), *[F.asc(c) for c in KEY_COLUMNS])


def _writer(df: DataFrame, header: bool = True):
    return (df.write.mode("overwrite").option("header", header)
            .option("quote", "").option("escape", "").option("quoteAll", False))


def _parts(spark: SparkSession, folder: str) -> list[str]:
    """Part files in the order of their tasks (numbers of any width)."""
    return sorted(fs.list_files(spark, folder, ".csv"), key=lambda f: int(f.rsplit("/", 1)[-1].split("-")[1]))


def _join(spark: SparkSession, parts: list[str], staging: str, path: str) -> None:
    header = f"{staging}/.header-{uuid.uuid4().hex}"
    fs.write_text_file(spark, header, ",".join(CSV_COLUMNS) + "\n")
    fs.join_files(spark, [header, *parts], path)


def write_csv(df: DataFrame, path: str) -> str:
    """Write one CSV file at ``path`` (truncating an existing file); returns ``path``."""
    spark = df.sparkSession
    staging = f"{path}.tmp-{uuid.uuid4().hex}"
    _writer(csv_order(df), header=False).csv(staging)
    _join(spark, _parts(spark, staging), staging, path)
    fs.delete(spark, staging)
    return path


def write_csv_dir(df: DataFrame, directory: str, by: str | None = None) -> None:
    """Multi-part CSV directory (optionally one sub-directory per ``by`` value)."""
    if by is None:
        _writer(csv_order(df)).csv(directory)
        return
    _writer(_by_month(df, by)).partitionBy(by).csv(directory)


def _by_month(df: DataFrame, by: str) -> DataFrame:
    """Rows in the order of ``by`` and the CSV order, dealt by ranges of both, so a month with most rows is
    sorted and written by several tasks. Leading with ``by`` is what the partitioned writer asks for; it
    then keeps the order."""
    order = [F.asc(by), F.desc("games"), *[F.asc(c) for c in KEY_COLUMNS]]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def monthly_output_path(base: str | None, month: str, base_is_dir: bool | None = None) -> str | None:
    """Output file for one source month.

    An existing directory -> ``dir/MONTH.csv``; otherwise ``parent/stem-MONTH.ext`` (``.csv``
    when the name has no extension); a name without a stem is returned unchanged.
    """
    if base is None:
        return None
    if base_is_dir is None:
        base_is_dir = os.path.isdir(base)
    if base_is_dir:
        return os.path.join(base, f"{month}.csv")
    parent, name = os.path.split(base.rstrip("/") or base)
    if not name or name in (".", ".."):
        return base
    if "." not in name or (name.startswith(".") and name.count(".") == 1):
        stem, ext = name, "csv"
    else:
        stem, ext = name.rsplit(".", 1)
    return os.path.join(parent, f"{stem}-{month}.{ext}")


def write_csv_per_source_month(agg_by_month: DataFrame, base: str) -> list[str]:
    """One CSV per ``source_month`` named by :func:`monthly_output_path` (rows keep the month
    of their games, so one file can hold several ``month`` values).

    Written as one partitioned job; then each month's parts are joined behind a header by the file
    system.
    """
    spark = agg_by_month.sparkSession
    staging = f"{base.rstrip('/')}.tmp-{uuid.uuid4().hex}"
    rows = _by_month(agg_by_month.select("source_month", *CSV_COLUMNS), "source_month")
    _writer(rows, header=False).partitionBy("source_month").csv(staging)
    base_is_dir = fs.is_dir(spark, base)
    written = []
    for d in fs.list_dirs(spark, staging):
        month = d.rstrip("/").rsplit("source_month=", 1)[-1]
        target = monthly_output_path(base, month, base_is_dir)
        _join(spark, _parts(spark, d), staging, target)
        written.append(target)
    fs.delete(spark, staging)
    return written


def read_aggregates_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(AGGREGATE_SCHEMA).csv(path)
