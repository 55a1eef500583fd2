"""``spark.read.format("pgn")``: games from byte ranges of plain and zstd files, with positions.

The text source reads a ``.zst`` file in one task and does not say which record is a file's first. This
Python data source cuts every file into ranges of ``splitBytes`` without reading it; each range is a
partition, read as Arrow batches. Where that would be more than ``MAX_RANGES`` tasks, the ranges grow with the
input, up to ``SPLIT_BYTES``: a task costs the same whether its range is long or short.

* **Plain files.** A game belongs to the range in which the separator before it begins.
* **Zstd files.** A file is a row of frames that can each be decoded alone. A range owns the frames that
  begin in it. Its first one is found by the frame magic, confirmed by walking the frame's header and block
  headers (three bytes per block, no decoding) to the next frame or the file's end. A file of one
  frame is read by its first range; the other ranges find no frame.

Either way a range leaves out what precedes its first separator, and reads on beyond its end until the
game that is still open ends, so a game that crosses ranges or frames is one row. A game that
covers whole ranges costs each of them a look and is still read once. Memory is one chunk and the
open game.

``first`` marks a file's first record, whose text is complete; all others lack the ``[Event `` that
separates them. A file that ends with the separator has one bare game more, also if compressed. Bytes that
are not UTF-8 become replacement characters. A zstd file that ends inside a frame raises.

Files are opened by ``pyarrow.fs`` (local and mounted paths, HDFS, S3, GCS).
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SEPARATOR = b"\n[Event "
SCHEMA = "value string, first boolean, file_path string"
SPLIT_BYTES = 64 << 20
MAX_RANGES = 512  # beyond which ranges of less than SPLIT_BYTES grow
COMPRESSED_SUFFIXES = (".gz", ".bz2", ".zst", ".zstd", ".lz4", ".snappy", ".deflate", ".xz", ".br")

# Fixed values of the zstd frame format (RFC 8878).
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
SKIPPABLE_MAGIC, SKIPPABLE_MASK = 0x184D2A50, 0xFFFFFFF0

_CHUNK = 4 << 20
_LOOK = 1 << 16  # read at a time beyond a range, where a game mostly ends soon
_BATCH_BYTES = 8 << 20


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path (``/x``, ``file:/x``, ``hdfs://h/x`` ...) and the path in it. A path with
    a scheme is a URI, as Spark names files: ``%20`` is a blank in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + unquote(path[5:]).lstrip("/")
    if path.startswith(("s3a://", "s3n://")):
        path = "s3" + path[3:]
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def readable(path: str) -> bool:
    """Whether the path's scheme is one that ``pyarrow.fs`` knows."""
    scheme = path.split(":", 1)[0] if ":" in path.split("/", 1)[0] else "file"
    return scheme in ("file", "hdfs", "s3", "s3a", "s3n", "gs")


def open_file(path: str) -> pa.NativeFile:
    fs, inner = filesystem(path)
    return fs.open_input_file(inner)


def ends_with_separator(path: str) -> bool:
    """Whether an uncompressed file's last bytes are the separator: it has one bare game more than
    the text source reads."""
    if path.lower().endswith(COMPRESSED_SUFFIXES):
        return False
    with open_file(path) as f:
        size = f.size()
        return size >= len(SEPARATOR) and f.read_at(len(SEPARATOR), size - len(SEPARATOR)) == SEPARATOR


def is_zstd(path: str) -> bool:
    return path.lower().endswith((".zst", ".zstd"))


def is_magic(head: bytes) -> bool:
    """Whether four bytes begin a frame (a skippable one included)."""
    return head == FRAME_MAGIC or (
        len(head) == 4 and struct.unpack("<I", head)[0] & SKIPPABLE_MASK == SKIPPABLE_MAGIC)


def frame_end(f: pa.NativeFile, at: int, size: int) -> int | None:
    """Where the frame that begins at ``at`` ends, from its headers alone; None if there is none."""
    head = f.read_at(18, at)
    if len(head) >= 8 and head[:4] != FRAME_MAGIC and is_magic(head[:4]):
        end = at + 8 + struct.unpack("<I", head[4:8])[0]
        return end if end <= size else None
    if head[:4] != FRAME_MAGIC or len(head) < 6 or head[4] & 0x08:  # a reserved bit
        return None
    flags = head[4]
    single = flags >> 5 & 1
    content = (single, 2, 4, 8)[flags >> 6]  # bytes of the content size
    at += 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + content
    while True:
        block = f.read_at(3, at)
        if len(block) < 3:
            return None
        word = int.from_bytes(block, "little")
        kind, length = word >> 1 & 3, word >> 3
        if kind == 3:
            return None
        at += 3 + (1 if kind == 1 else length)
        if at > size:
            return None
        if word & 1:
            at += 4 * (flags >> 2 & 1)  # checksum
            return at if at <= size else None


def frames(f: pa.NativeFile, size: int) -> list[tuple[int, int]]:
    """``(start, end)`` of every frame of a file, from headers alone."""
    out, at = [], 0
    while at < size:
        end = frame_end(f, at, size)
        if end is None:
            raise ValueError(f"no zstd frame at byte {at}")
        out.append((at, end))
        at = end
    return out


def first_frame(f: pa.NativeFile, start: int, end: int, size: int) -> int | None:
    """Where the first frame that begins in ``[start, end)`` begins. Compressed bytes may look like the
    magic by chance; a frame's headers lead to another frame or the file's end."""
    if start == 0:
        return 0 if size else None
    at = start
    while at < end:
        data = f.read_at(min(_CHUNK, end - at) + 3, at)
        here = data.find(FRAME_MAGIC)
        while here >= 0:
            stop = frame_end(f, at + here, size)
            if stop is not None and (stop == size or is_magic(f.read_at(4, stop))):
                return at + here
            here = data.find(FRAME_MAGIC, here + 1)
        at += max(1, len(data) - 3)
    return None


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int
    size: int


def _plain(f: pa.NativeFile, r: Range) -> Iterator[tuple[bytes, bool]]:
    at = r.start
    while at < r.size:
        n = min(_CHUNK, r.end - at) if at < r.end else _LOOK
        data = f.read_at(n, at)
        if not data:
            return
        yield data, at < r.end
        at += len(data)


def _decoded(f: pa.NativeFile, r: Range) -> Iterator[tuple[bytes, bool]]:
    import zstandard

    at = first_frame(f, r.start, r.end, r.size)
    if at is None:
        return
    read = at  # how far the compressed bytes have been read
    held = memoryview(b"")  # those read that are still to be decoded
    while at < r.size:  # a frame
        own = at < r.end
        decoder = zstandard.ZstdDecompressor().decompressobj()
        while not decoder.eof:
            if not held:
                held = memoryview(f.read_at(max(_LOOK, min(1 << 20, r.end - read)), read))
                read += len(held)
                if not held:
                    raise ValueError(f"{r.path} ends inside a zstd frame")
            piece = held[:_LOOK]  # what lies behind a frame's end is copied: little of it
            data = decoder.decompress(piece)
            held = held[len(piece) - (len(decoder.unused_data) if decoder.eof else 0):]
            if data:
                yield data, own
        at = read - len(held)


def records(chunks: Iterator[tuple[bytes, bool]], at_start: bool) -> Iterator[list[bytes]]:
    """Lists of complete records that belong to the owned chunks, which come before the others."""
    keep = len(SEPARATOR) - 1
    open_ = at_start  # else what precedes the first separator is another range's
    parts: list[bytes] = []  # of the open record, or the last bytes of what is left out
    edge, some, over = b"", False, 0  # over: bytes of ``parts`` and ``edge`` that are not owned
    for data, own in chunks:
        some = True
        window = edge + data
        if not own:
            # A separator that begins before the end is owned; the first one after it ends the last record.
            over += len(data)
            if SEPARATOR in window:
                text = b"".join(parts) + data
                limit, out, begin = len(text) - over, [], 0
                while (at := text.find(SEPARATOR, begin)) >= 0:
                    if open_:
                        out.append(text[begin:at])
                    if at >= limit:
                        yield out
                        return
                    open_, begin = True, at + len(SEPARATOR)
                if out:
                    yield out
                parts = [text[begin:]]
                over = min(over, len(parts[0]))
            elif open_:
                parts.append(data)
            else:
                parts = [window[-keep:]]
                if over >= keep:  # no separator begins before the end any more
                    return
        elif SEPARATOR in window:
            pieces = (b"".join(parts) + data).split(SEPARATOR)
            if pieces[0 if open_ else 1:-1]:
                yield pieces[0 if open_ else 1:-1]
            open_, parts = True, [pieces[-1]]
        elif open_:
            parts.append(data)
        else:
            parts = [window[-keep:]]
        edge = window[-keep:]
    if open_ and some:
        yield [b"".join(parts)]


class PgnReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        if "files" in options:
            self.files = [tuple(x) for x in json.loads(options["files"])]
        else:
            paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
            self.files = [x for p in paths for x in _listed(p)]

    def partitions(self) -> list[Range]:
        even = -(-sum(size for _, size in self.files) // MAX_RANGES)
        split = max(self.split, min(SPLIT_BYTES, even))
        return [Range(path, at, min(at + split, size), size)
                for path, size in self.files for at in range(0, size, split)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        first = partition.start == 0
        with open_file(partition.path) as f:
            chunks = (_decoded if is_zstd(partition.path) else _plain)(f, partition)
            held: list[bytes] = []
            size = 0
            for some in records(chunks, first):
                held += some
                size += sum(map(len, some))
                if size >= _BATCH_BYTES:
                    yield _batch(held, first, partition.path)
                    held, size, first = [], 0, False
            if held:
                yield _batch(held, first, partition.path)


def _batch(values: list[bytes], first: bool, path: str) -> pa.RecordBatch:
    try:
        text = pa.array(values, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        text = pa.array([v.decode("utf-8", "replace") for v in values], pa.string())
    flags = [False] * len(values)
    flags[0] = first
    return pa.RecordBatch.from_arrays(
        [text, pa.array(flags), pa.array([path] * len(values), pa.string())], ["value", "first", "file_path"])


def _listed(path: str) -> list[tuple[str, int]]:
    """Files (with lengths) at or below a path; hidden ones and markers are left out."""
    fs, inner = filesystem(path)
    uri = path.startswith("file:") or "://" in path
    prefix = "file:" if path.startswith("file:") else path[:len(path) - len(inner)]
    info = fs.get_file_info(inner)
    found = [info] if info.is_file else fs.get_file_info(pafs.FileSelector(inner, recursive=True))
    return sorted((prefix + (quote(i.path) if uri else i.path), i.size) for i in found
                  if i.is_file and not i.base_name.startswith(("_", ".")))


class PgnDataSource(DataSource):
    """Options: ``path``, or ``paths`` (JSON list), or ``files`` (JSON list of path and length);
    ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "pgn"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PgnReader:
        return PgnReader({k.lower(): v for k, v in self.options.items()})
