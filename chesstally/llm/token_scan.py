"""Token counts of documents by a separator scan over flat token files.

A flat token file is one long row of 16-bit ids, cut into blocks of fixed size without regard to
documents; only an end-of-document id tells where a document ends, and there is no index. Each
block is searched by one vectorised comparison, on its own and in any order. A document may run
over any number of blocks: the blocks' open ends are stitched by a prefix scan, a window over one
summary row per block.

Blocks are rows ``(file, block, data)``. ``write_documents`` makes them from a table, and
``read_files`` from raw binary files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chesstally.llm.common import scratch, slices
from chesstally.llm.tokens import END, encode
from chesstally.sources.pgn_source import open_file

BLOCK_IDS = 1 << 18
_TASK_BLOCKS = 256  # blocks of a raw file that are dealt together


def write_documents(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id",
                    text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Tokenize every row and write the flat files as a table of blocks at ``path``: one file per
    input partition. The list ``ends`` (the ids of the documents whose separator lies in the block)
    serves to name counts afterwards; the scan does not read it. A null or empty text is a separator
    alone; a text of any length runs over as many blocks as it needs; repeated rows are written
    each; an empty table writes no block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block = TaskContext.get().partitionId(), 0
        parts: list[np.ndarray] = []
        held, ends = 0, []

        def cut(flat: np.ndarray, ids: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([block], pa.int64()),
                 pa.array([flat.tobytes()], pa.binary()), pa.array([ids], pa.list_(pa.int64()))],
                ["file", "block", "data", "ends"])

        stop = np.array([END], "<u2")
        for part in slices(batches):
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                for piece in (encode(tokenizer, text), stop):
                    while held + len(piece) >= block_ids:
                        take = block_ids - held
                        if piece is stop:
                            ends.append(doc)
                        yield cut(np.concatenate([*parts, piece[:take]]), ends)
                        block += 1
                        parts, held, ends = [], 0, []
                        last, piece = piece, piece[take:]
                        if last is stop:
                            break
                    else:
                        if piece is stop:
                            ends.append(doc)
                        parts.append(piece)
                        held += len(piece)
        if held:
            yield cut(np.concatenate(parts), ends)

    (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
     .mapInArrow(run, "file int, block long, data binary, ends array<long>")
     .write.option("compression", "zstd").parquet(path))


def read_files(spark: SparkSession, paths: str | list[str], block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of raw little-endian 16-bit files of any length. Spark lists the files with their lengths
    (it reads no content); tasks then read byte ranges, a block each, by ``pyarrow.fs``."""
    step = 2 * block_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            for name, block in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                with open_file(name) as f:
                    data = f.read_at(step, block * step)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([block], pa.int64()), pa.array([data], pa.binary())],
                    ["file", "block", "data"])

    files = spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file"), "length")
    last = F.greatest(F.lit(0).cast("long"), F.expr(f"(length - 1) div {step}"))
    blocks = files.select("file", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    # Neighbouring blocks to one task, a long file's to many.
    dealt = blocks.repartition(F.xxhash64("file"), F.expr(f"block div {_TASK_BLOCKS}"))
    return dealt.mapInArrow(run, "file string, block long, data binary")


def scan(blocks: DataFrame, end: int = END) -> DataFrame:
    """``blocks(file, block, data)`` -> ``(file, ordinal, n_tokens)``: the number of ids of each
    document of each file, in file order, without the separator. Ids after the last separator are a
    document of their own; empty documents count 0; null or empty blocks hold nothing."""
    kind = blocks.schema["file"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 16):
            rows = []
            for data in part.column(2).to_pylist():
                flat = np.frombuffer(data or b"", "<u2")
                at = np.flatnonzero(flat == end)
                lens = np.diff(at, prepend=-1) - 1
                rows.append((lens.tolist(), len(flat) - (int(at[-1]) + 1 if len(at) else 0)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([r[0] for r in rows], pa.list_(pa.int64())),
                 pa.array([r[1] for r in rows], pa.int64())], ["file", "block", "lens", "open"])

    found = (blocks.select("file", F.col("block").cast("long").alias("block"), "data")
             .mapInArrow(run, f"file {kind}, block long, lens array<long>, open long"))
    # The prefix scan: what is open after a block is its own rest if it has a separator, else that
    # and all that was open before it.
    order = Window.partitionBy("file").orderBy("block")
    ends = F.size("lens")
    stretch = F.sum(F.when(ends > 0, 1).otherwise(0)).over(order)
    found = found.withColumn("stretch", stretch).withColumn("first", F.sum(ends).over(order) - ends)
    run_on = F.sum("open").over(Window.partitionBy("file", "stretch").orderBy("block"))
    found = found.withColumn("after", run_on)
    found = (found.withColumn("before", F.coalesce(F.lag("after").over(order), F.lit(0)))
             .withColumn("last", F.lead("block").over(order).isNull()))
    whole = F.transform("lens", lambda n, i: n + F.when(i == 0, F.col("before")).otherwise(0))
    lens = F.when(F.col("last") & (F.col("after") > 0), F.concat(whole, F.array("after"))).otherwise(whole)
    return (found.select("file", "first", F.posexplode(lens).alias("i", "n_tokens"))
            .select("file", (F.col("first") + F.col("i")).alias("ordinal"), "n_tokens"))


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 block_ids: int = BLOCK_IDS) -> DataFrame:
    """``doc_id, n_tokens`` of every row, by way of flat files and their scan.

    A null text is the empty text with no tokens; repeated rows and null ids keep their rows; other
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = scratch(spark, "flat-tokens")
    write_documents(docs, path, tokenizer, id_col, text_col, block_ids)
    flat = spark.read.schema("file int, block long, data binary, ends array<long>").parquet(path)
    counts = scan(flat.select("file", "block", "data"))
    order = Window.partitionBy("file").orderBy("block")
    names = (flat.select("file", "block", "ends")
             .withColumn("first", F.sum(F.size("ends")).over(order) - F.size("ends"))
             .select("file", "first", F.posexplode("ends").alias("i", "doc_id"))
             .select("file", (F.col("first") + F.col("i")).alias("ordinal"), "doc_id"))
    return names.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens")
