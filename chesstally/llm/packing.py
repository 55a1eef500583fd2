"""Token-id output: best-fit-decreasing packing of documents into rows of fixed length.

Each task tokenizes its documents into windows of bounded size and packs every window by itself:
segments are placed longest first, each into the row with the least room that still holds it, which
a segment tree over capacities finds in ``log(length)`` steps. Documents longer than a row are split
without loss into full rows and a rest. Windows never meet, so nothing is shuffled and memory is
bounded; each window wastes part of a few rows at most.

A packed row carries its ids, the cumulative lengths of its segments, and positions that restart at
every segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chesstally.llm.common import slices
from chesstally.llm.tokens import END, encode

LENGTH = 2048
WINDOW_IDS = 1 << 21


class Capacities:
    """Rows by their free room: a segment tree over rooms 0..length whose nodes count open rows."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.size
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove a row with the least room of at least ``need``: (room, row)."""
        at = need + self.size
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1  # no row in this subtree's right neighbour: go up
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at *= 2
                if not self.count[at]:
                    at += 1
        room = at - self.size
        row = self.rows[room].pop()
        while at:
            self.count[at] -= 1
            at >>= 1
        return room, row


def pack(lengths: list[int], length: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """Rows of segments ``(document index, start, size)``. Documents without ids get none."""
    segments = [(i, a, min(length, n - a)) for i, n in enumerate(lengths) for a in range(0, n, length)]
    segments.sort(key=lambda s: (-s[2], s[0], s[1]))
    rows: list[list[tuple[int, int, int]]] = []
    free = Capacities(length)
    for s in segments:
        found = free.take(s[2])
        if found:
            room, row = found
            rows[row].append(s)
        else:
            room, row = length, len(rows)
            rows.append([s])
        if room > s[2]:
            free.add(room - s[2], row)
    return rows


SCHEMA = ("shard int, window int, row int, n_used int, doc_ids array<long>, doc_starts array<int>, "
          "cu_seqlens array<int>, input_ids binary, position_ids binary")


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, window_ids: int = WINDOW_IDS, pad: int = END) -> DataFrame:
    """Packed rows of all documents.

    ``shard, window, row`` name a row; ``n_used`` is its number of ids before padding; ``doc_ids``
    and ``doc_starts`` (ids of the document before the segment) name its segments; ``cu_seqlens``
    are their cumulative lengths from 0; ``input_ids`` and ``position_ids`` are ``length`` 16-bit
    little-endian numbers (``matrix`` reads them), padded by ``pad`` and 0. ``length`` may be up to
    65,536.

    Null and empty texts have no ids and no segment; repeated rows are packed as they come; a null
    id stays null in ``doc_ids``; other columns are ignored; an empty table gives an empty result.
    """
    if not 0 < length <= 1 << 16:
        raise ValueError("length must be from 1 to 65536")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, window = TaskContext.get().partitionId(), 0
        held: list[tuple[int | None, np.ndarray, int]] = []  # id, ids, their place in the document
        size = 0
        fields = pa.schema([("shard", pa.int32()), ("window", pa.int32()), ("row", pa.int32()),
                            ("n_used", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                            ("doc_starts", pa.list_(pa.int32())), ("cu_seqlens", pa.list_(pa.int32())),
                            ("input_ids", pa.binary()), ("position_ids", pa.binary())])
        count = np.arange(length, dtype=np.int64)

        def flush():
            out = []
            for r, segments in enumerate(pack([len(ids) for _, ids, _ in held], length)):
                ids = np.concatenate([held[i][1][a:a + n] for i, a, n in segments])
                ends = np.cumsum([n for _, _, n in segments])
                used = int(ends[-1])
                pos = np.zeros(length, np.int64)
                pos[:used] = count[:used] - np.repeat(ends - [n for _, _, n in segments],
                                                      [n for _, _, n in segments])
                full = np.full(length, pad, "<u2")
                full[:used] = ids
                out.append({"shard": shard, "window": window, "row": r, "n_used": used,
                            "doc_ids": [held[i][0] for i, _, _ in segments],
                            "doc_starts": [held[i][2] + a for i, a, _ in segments],
                            "cu_seqlens": [0, *ends.tolist()], "input_ids": full.tobytes(),
                            "position_ids": pos.astype("<u2").tobytes()})
            for at in range(0, len(out), 256):
                yield pa.RecordBatch.from_pylist(out[at:at + 256], fields)

        # A window holds whole rows' worth of a document that is longer than the window itself.
        step = max(length, window_ids // length * length)
        for part in slices(batches):
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                ids = encode(tokenizer, text)
                for at in range(0, len(ids), step):
                    piece = ids[at:at + step]
                    if held and size + len(piece) > window_ids:
                        yield from flush()
                        held, size, window = [], 0, window + 1
                    held.append((doc, piece, at))
                    size += len(piece)
        if held:
            yield from flush()

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, SCHEMA))


def matrix(rows: list, column: str = "input_ids") -> np.ndarray:
    """Collected rows' ids or positions as a matrix."""
    return np.stack([np.frombuffer(r[column], "<u2") for r in rows]) if rows else np.empty((0, 0), "<u2")
