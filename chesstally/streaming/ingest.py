"""Incremental ingestion with Structured Streaming.

New dump files in a directory are picked up by the file source (each file whole, in exactly one
micro-batch; the checkpoint remembers which files were processed, so a restart resumes). Every
micro-batch is aggregated per (source file, key) and written to the by-source store with dynamic
partition overwrite: a micro-batch replayed after a failure rewrites the same partitions, so the
totals never double count. No streaming state store is used; the store *is* the state.

``trigger='availableNow'`` processes everything present and stops (the batch-style incremental
run); a processing-time trigger keeps the query running.

:mod:`chesstally.streaming.totals` is the stateful alternative.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from chesstally import fs
from chesstally.operators.aggregate import (
    KEY_COLUMNS,
    MEASURE_COLUMNS,
    merge_aggregates,
    rebalance_games,
)
from chesstally.session import scratch_path
from chesstally.sinks.store import (
    SOURCE_COLUMNS,
    aggregate_by_source,
    id_of,
    read_store_by_source,
    write_by_source,
)
from chesstally.sources.pgn import bare_games, month_of_path, stream_games, truncated_files


@dataclass(frozen=True)
class BatchSize:
    """What a micro-batch admitted (files without any game are not counted)."""

    batch_id: int
    files: int
    bytes: int


class BatchTimes(StreamingQueryListener):
    """Records of every micro-batch that ends, of all queries of the session it is added to:
    ``(query id, batch id, rows, milliseconds)``."""

    def __init__(self) -> None:
        self.batches: list[tuple[str, int, int, int]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches.append((str(p.id), p.batchId, p.numInputRows, p.batchDuration))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def start_ingest(
    spark: SparkSession,
    source_dir: str,
    store: str,
    checkpoint: str,
    bucket_size: int = 200,
    trigger: str | None = "availableNow",
    max_files_per_trigger: int | None = None,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    rebalance: int | None = None,
    max_bytes_per_trigger: int | str | None = None,
    on_size: Callable[[BatchSize], None] | None = None,
) -> StreamingQuery:
    """Stream ``source_dir`` into the by-source ``store``; returns the running query. ``on_batch``
    gets each micro-batch's aggregate per source, read from the partitions just written.

    ``rebalance=N`` deals each micro-batch's games round-robin to N tasks before parsing (see
    :func:`chesstally.sources.pgn.read_games`), for unsplittable compressed dumps.

    ``max_bytes_per_trigger`` admits files to a micro-batch up to that many bytes (a larger file has one
    of its own); ``on_size`` gets each batch's files and bytes."""
    games = stream_games(spark, source_dir, max_files_per_trigger, max_bytes_per_trigger=max_bytes_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # The games are parsed once: the write also notes the batch's files.
        seen = Observation()
        agg = aggregate_by_source(rebalance_games(batch, rebalance), bucket_size)
        write_by_source(agg.observe(seen, F.collect_set("source_file").alias("files")), store, bucket_size)
        files = list(seen.get["files"] or ())
        if on_size is not None:
            on_size(BatchSize(batch_id, len(files), sum(fs.lengths(spark, files))))

        def written(paths: list[str]) -> DataFrame:
            months = {month_of_path(p) for p in paths}
            wanted = F.col("source_id").isin([id_of(p) for p in paths])
            if None not in months:
                wanted &= F.col("source_month").isin(*months)
            return (read_store_by_source(spark, store).where(wanted)
                    .select(*SOURCE_COLUMNS, *KEY_COLUMNS, *MEASURE_COLUMNS))

        bare = truncated_files(spark, files)
        if bare:  # their last games, which are no records; a replayed batch starts over
            path = scratch_path(spark, "runs", f"batch-{uuid.uuid4().hex[:12]}")
            more = aggregate_by_source(bare_games(spark, bare), bucket_size)
            merge_aggregates(written(bare), more, by=SOURCE_COLUMNS).write.parquet(path)
            write_by_source(spark.read.parquet(path), store, bucket_size)
            fs.delete(spark, path)
        if on_batch is not None:
            on_batch(written(files), batch_id)

    writer = games.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def run_ingest(spark: SparkSession, source_dir: str, store: str, checkpoint: str,
               bucket_size: int = 200, max_files_per_trigger: int | None = None,
               rebalance: int | None = None, max_bytes_per_trigger: int | str | None = None) -> list[BatchSize]:
    """Process all files present now (``availableNow``) and wait for the query to finish; returns the
    sizes of the micro-batches if they are bounded by bytes."""
    sizes: list[BatchSize] = []
    q = start_ingest(spark, source_dir, store, checkpoint, bucket_size, "availableNow",
                     max_files_per_trigger, rebalance=rebalance,
                     max_bytes_per_trigger=max_bytes_per_trigger,
                     on_size=sizes.append if max_bytes_per_trigger else None)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return sizes
