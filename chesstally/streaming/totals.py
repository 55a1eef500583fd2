"""Running totals with state per source file.

The state store holds, for every source file, what the file has contributed to the totals. A micro-batch
replaces the contributions of its files and hands on the differences, so a file that is delivered again
(under a new checkpoint of the source, or rewritten) never counts twice, and the bare last game
of a file that ends with the separator is part of its contribution (on filesystems that ``pyarrow.fs``
knows). The differences are additive:
:func:`chesstally.sinks.appends.totals_sink` appends them, and their sum is the aggregate.

Games become keys in the JVM; each task then adds its games up per file and key before they are dealt by
file, so a file with most of the games sends no more rows than it has keys, once per task. A file's
contribution is one binary value, as large as its keys (months x opening groups x bucket pairs).
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from chesstally.functions.keys import BLACK_WIN, DRAW, WHITE_WIN
from chesstally.operators.aggregate import AGGREGATE_SCHEMA, KEY_COLUMNS, MEASURE_COLUMNS, game_keys
from chesstally.sources.pgn import stream_games
from chesstally.sources.pgn_source import ends_with_separator, readable

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FLUSH = 200_000  # keys that a task holds before it hands its sums on
_LOCK = threading.Lock()

#: The key of a game without tags.
_BARE = ("unknown", "U00", 0, 0)


def _added(table: pa.Table, by: list[str]) -> pa.Table:
    out = table.group_by(by).aggregate([(m, "sum") for m in MEASURE_COLUMNS])
    return out.select([*by, *(f"{m}_sum" for m in MEASURE_COLUMNS)]).rename_columns([*by, *MEASURE_COLUMNS])


def partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows per file and key, added up within a task."""
    by = ["source_file", *KEY_COLUMNS]
    held: pa.Table | None = None
    for batch in batches:
        table = _added(pa.Table.from_batches([batch]), by)
        held = table if held is None else _added(pa.concat_tables([held, table]), by)
        if held.num_rows >= _FLUSH:
            yield from held.combine_chunks().to_batches()
            held = None
    if held is not None:
        yield from held.combine_chunks().to_batches()


def _packed(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return out.getvalue().to_pybytes()


class FileTotals(StatefulProcessor):
    """Key: a source file. Rows: its counts in this micro-batch. Output: what they change."""

    def __init__(self, exact_tail: bool = True) -> None:
        self.exact_tail = exact_tail

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("contribution", "data binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        columns = [*KEY_COLUMNS, *MEASURE_COLUMNS]
        parts = [pa.Table.from_pandas(r[columns], preserve_index=False) for r in rows]
        if self.exact_tail and readable(key[0]) and ends_with_separator(key[0]):
            parts.append(pa.table([pa.array([v], f.type) for v, f in zip((*_BARE, 1, 0, 0, 0), parts[0].schema)],
                                  names=columns))
        new = _added(pa.concat_tables(parts), KEY_COLUMNS)
        change = [new]
        if self.held.exists():
            old = pa.ipc.open_stream(self.held.get()[0]).read_all()
            for m in MEASURE_COLUMNS:
                old = old.set_column(old.column_names.index(m), m, pa.compute.negate(old[m]))
            change.append(old.cast(new.schema))
        self.held.update((_packed(new),))
        yield _added(pa.concat_tables(change), KEY_COLUMNS).to_pandas()

    def close(self) -> None:
        pass


def file_counts(games: DataFrame, bucket_size: int = 200) -> DataFrame:
    """``source_file`` with the aggregate's columns, added up per task only."""
    keys = game_keys(games, bucket_size, keep=["source_file"])
    measures = [F.lit(1).cast("long").alias("games")] + [
        F.when(F.col("result") == value, 1).otherwise(0).cast("long").alias(name)
        for name, value in zip(MEASURE_COLUMNS[1:], (WHITE_WIN, BLACK_WIN, DRAW))]
    return keys.select("source_file", *KEY_COLUMNS, *measures).mapInArrow(
        partial_sums, f"source_file string, {AGGREGATE_SCHEMA}")


def running_changes(games: DataFrame, bucket_size: int = 200, exact_tail: bool = True) -> DataFrame:
    """A stream of games -> a stream of changes to the aggregate."""
    return (file_counts(games, bucket_size).groupBy("source_file")
            .transformWithStateInPandas(FileTotals(exact_tail), outputStructType=AGGREGATE_SCHEMA,
                                        outputMode="Update", timeMode="None"))


def start_running_totals(
    spark: SparkSession,
    source_dir: str,
    checkpoint: str,
    sink: Callable[[DataFrame, int], None],
    bucket_size: int = 200,
    trigger: str | None = "availableNow",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | str | None = None,
    exact_tail: bool = True,
) -> StreamingQuery:
    """``sink(changes, batch_id)`` gets each micro-batch's changes to the totals, a row per key, e.g.
    :func:`chesstally.sinks.appends.totals_sink`. State is kept in RocksDB."""
    from chesstally.streaming.ingest import _trigger

    games = stream_games(spark, source_dir, max_files_per_trigger, max_bytes_per_trigger=max_bytes_per_trigger)
    changes = running_changes(games, bucket_size, exact_tail)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        sums = batch.groupBy(*KEY_COLUMNS).agg(*(F.sum(m).alias(m) for m in MEASURE_COLUMNS))
        some = F.greatest(*(F.abs(F.col(m)) for m in MEASURE_COLUMNS)) > 0
        sink(sums.where(some), batch_id)

    writer = changes.writeStream.outputMode("update").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    with _LOCK:  # the provider is read when the query starts
        before = spark.conf.get(PROVIDER, None)
        spark.conf.set(PROVIDER, ROCKSDB)
        try:
            return _trigger(writer, trigger).start()
        finally:
            if before is None:
                spark.conf.unset(PROVIDER)
            else:
                spark.conf.set(PROVIDER, before)
