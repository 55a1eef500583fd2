"""PGN game scan: text files -> one row per game.

A game starts at every line that begins with ``[Event `` (untrimmed); text before the first such
line is a game of its own, an empty file has none. Spark's text source with the record separator
``"\\n[Event "`` yields exactly these records, and Hadoop's line reader keeps records whole
across split boundaries, so plain text files are read in parallel splits. Compressed files
(``.zst``, ``.gz``, ``.bz2``) are decoded by the Hadoop codecs; ``.bz2`` stays splittable,
``.zst``/``.gz`` are not (one task per file): ``read_games(..., zst_frames=True)`` reads the frames of
a ``.zst`` file in parallel, ``rebalance=N`` parses in N tasks, and
:func:`chesstally.sinks.store.land_games` keeps a parsed copy for later jobs.

The separator is consumed by the reader, so every record except a file's first begins with the
rest of the ``Event`` line (``"Rated game"]``). That line no longer looks like a header, which is
harmless: ``Event`` is not part of any key. It is not re-prefixed, because the text source does not
tell a file's first record from the others, and re-prefixing a preamble would corrupt its first
line; :func:`read_games_positioned` does know, for plain and zstd files.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chesstally import fs
from chesstally.sources.pgn_source import (
    COMPRESSED_SUFFIXES,
    SPLIT_BYTES,
    PgnDataSource,
    ends_with_separator,
    frame_end,
    is_zstd,
    open_file,
    readable,
)

GAME_SEPARATOR = "\n[Event "

# Fixed value: month in a dump file name, e.g. ``..._2013-07.pgn.zst``.
DUMP_MONTH_PATTERN = r"(\d{4}-\d{2})\.pgn"


def _as_list(paths: str | Iterable[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def split_existing(spark: SparkSession, paths: str | Iterable[str]) -> tuple[list[str], list[str]]:
    """(present, missing) paths; glob patterns are kept as given."""
    present, missing = [], []
    for p in _as_list(paths):
        if any(ch in p for ch in "*?[{") or fs.exists(spark, p):
            present.append(p)
        else:
            missing.append(p)
    return present, missing


def read_games(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    skip_missing: bool = False,
    with_source: bool = True,
    rebalance: int | None = None,
    recursive: bool = False,
    exact_tail: bool = True,
    zst_frames: bool = False,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """One row per game: ``game string`` (+ ``source_file``, ``source_month``).

    ``source_month`` is the ``YYYY-MM`` of the dump file name (or the ``source_month=`` partition
    directory when the files are laid out that way); NULL when neither exists. It describes the
    file, not the game: a monthly file may hold games of other months.

    ``rebalance=N`` deals the games to N partitions (more for large files) right after the scan.
    For unsplittable dumps (``.zst``, ``.gz``) one task per file decompresses and splits records,
    which is cheap, while parsing, the expensive part, then runs in N tasks or more: worth its shuffle of
    the game text when a few huge files dominate. Leave it off for splittable input.

    ``recursive=True`` reads every file below the given directories (e.g. ``dumps/2013/07/``);
    ``key=value`` partition directories are then not turned into columns.

    A file that ends exactly with the separator (a truncated ``[Event `` line) has one bare game
    more than the record reader emits. The last bytes of every uncompressed file are looked at
    before the scan, and such games are added as rows; ``exact_tail=False`` leaves them out.
    Compressed dumps would have to be decompressed to their end, so theirs are not added.

    ``zst_frames=True`` reads ``.zst`` files by :mod:`chesstally.sources.pgn_source`: a task per
    ``split_bytes`` of compressed input, each decoding the frames that begin there, bare last games
    included. Files of one frame gain nothing from that: without ``exact_tail`` they are left to the
    codec, with it one task decodes them whole. So are files on a filesystem that only Hadoop knows.
    """
    paths = _as_list(paths)
    empty_schema = "game string" + (", source_file string, source_month string"
                                    if with_source else "")
    if skip_missing:
        paths, missing = split_existing(spark, paths)
        if missing:
            print(f"PGN file(s) not found, skipped: {', '.join(missing)}")
        if not paths:
            return spark.createDataFrame([], empty_schema)
    reader = spark.read.option("lineSep", GAME_SEPARATOR)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        raw = reader.text(paths)
    except AnalysisException as exc:  # a glob that matches nothing
        if skip_missing and "PATH_NOT_FOUND" in str(exc):
            print(f"PGN file(s) not found, skipped: {', '.join(paths)}")
            return spark.createDataFrame([], empty_schema)
        raise
    framed: list[tuple[str, int]] = []
    if zst_frames:
        framed = [x for x in zst_files(spark, paths, recursive) if readable(x[0])]
        if not exact_tail:
            framed = several_frames(spark, framed)
    if framed:
        taken = {f for f, _ in framed}
        rest = [f for f in fs.input_files(raw) if f not in taken]
        raw = reader.text(rest) if rest else None
    games = read_pgn_source(spark, framed, split_bytes, with_source) if framed else None
    if raw is not None:
        plain = _shape(raw, with_source)
        games = plain if games is None else games.unionByName(plain)
        if exact_tail:
            bare = truncated_files(spark, fs.input_files(raw))
            if bare:
                games = games.unionByName(bare_games(spark, bare, with_source))
    return deal(games, rebalance)


DEAL_BYTES = 256 << 20  # of text, about, that a task parses
_TEXT_PER_BYTE = 8  # of a compressed file


def deal(games: DataFrame, tasks: int | None) -> DataFrame:
    """Deal games in turn to ``tasks`` tasks (None: as they are), or to as many more as files of that length
    need, so that no task's part grows with the input. Games are numbered as the scan delivers them and dealt by that
    number: dealing rows without a key would sort each task's games first."""
    if not tasks:
        return games
    spark = games.sparkSession
    files = fs.input_files(games)
    text = sum(n * (_TEXT_PER_BYTE if f.lower().endswith(COMPRESSED_SUFFIXES) else 1)
               for f, n in zip(files, fs.lengths(spark, files)))
    tasks = max(tasks, -(-text // DEAL_BYTES))
    return (games.withColumn("__n", F.monotonically_increasing_id()).repartition(tasks, "__n").drop("__n"))


def zst_files(spark: SparkSession, paths: list[str], recursive: bool = False) -> list[tuple[str, int]]:
    """Zstd files below ``paths`` and their lengths; nothing of their content is read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.{zst,zstd}")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    found = reader.load(paths).select(F.col("_metadata.file_path"), "length")
    return sorted((r[0], r[1]) for r in found.collect())  # one row per file


def several_frames(spark: SparkSession, files: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Those of the files that hold more than one frame: each task walks its files' first headers."""
    def walk(batches):
        for batch in batches:
            path, size = (c.to_pylist() for c in batch.columns)
            more = []
            for p, n in zip(path, size):
                with open_file(p) as f:
                    end = frame_end(f, 0, n)
                    more.append(end is not None and end < n)
            yield batch.filter(pa.array(more, pa.bool_()))

    if not files:
        return []
    schema = "file string, length long"
    dealt = spark.createDataFrame(files, schema).repartition(min(len(files), 1024), "file")
    return sorted(map(tuple, dealt.mapInArrow(walk, schema).collect()))


def read_pgn_source(spark: SparkSession, files: list[tuple[str, int]], split_bytes: int = SPLIT_BYTES,
                    with_source: bool = True, with_first: bool = False) -> DataFrame:
    """Games of the files (path and length) by the Python data source; ``with_first`` adds the flag of a
    file's first record."""
    spark.dataSource.register(PgnDataSource)
    raw = (spark.read.format("pgn").option("files", json.dumps(files))
           .option("splitBytes", str(split_bytes)).load())
    cols = [F.col("value").alias("game")]
    if with_source:
        cols += [F.col("file_path").alias("source_file"), source_month_from_path("file_path").alias("source_month")]
    return raw.select(*cols, *(["first"] if with_first else []))


def read_games_positioned(spark: SparkSession, paths: str | Sequence[str],
                          split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Games of plain and zstd files with their whole text: a record after a separator gets its ``[Event ``
    back, a file's first record is as it is. All tags, ``Event`` too, can then be read from it.
    ``game, source_file, source_month, first``."""
    found = (spark.read.format("binaryFile").load(_as_list(paths))
             .select(F.col("_metadata.file_path"), "length").collect())
    other = [r[0] for r in found if r[0].lower().endswith(COMPRESSED_SUFFIXES) and not is_zstd(r[0])]
    if other:
        raise ValueError(f"record positions are known for plain and zstd files only: {other[0]}")
    games = read_pgn_source(spark, sorted((r[0], r[1]) for r in found), split_bytes, with_first=True)
    return games.withColumn("game", F.when(F.col("first"), F.col("game")).otherwise(
        F.concat(F.lit(GAME_SEPARATOR[1:]), F.col("game"))))


#: So many files' last bytes are read by the driver, side by side; those of more files in tasks.
MANY_FILES = 4096


def truncated_files(spark: SparkSession, files: Iterable[str]) -> list[str]:
    """The uncompressed files among ``files`` whose bytes end with the separator."""
    sep = GAME_SEPARATOR.encode("utf-8")
    plain = [f for f in files if not f.lower().endswith(COMPRESSED_SUFFIXES)]
    if len(plain) > MANY_FILES and all(readable(f) for f in plain):
        def look(batches):
            for batch in batches:
                ends = [ends_with_separator(f) for f in batch.column(0).to_pylist()]
                yield batch.filter(pa.array(ends, pa.bool_()))

        dealt = spark.createDataFrame([(f,) for f in plain], "file string").repartition(
            max(8, len(plain) // MANY_FILES), "file")
        return sorted(r.file for r in dealt.mapInArrow(look, "file string").toLocalIterator())
    return [f for f, tail in zip(plain, fs.file_tails(spark, plain, len(sep))) if tail == sep]


def bare_games(spark: SparkSession, files: list[str], with_source: bool = True) -> DataFrame:
    """One bare ``[Event `` game per file (see :func:`truncated_files`)."""
    rows = spark.createDataFrame([(GAME_SEPARATOR.lstrip("\n"), f) for f in files],
                                 "game string, source_file string")
    if not with_source:
        return rows.select("game")
    return rows.withColumn("source_month", source_month_from_path(F.col("source_file")))


def stream_games(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None,
                 with_source: bool = True, max_bytes_per_trigger: int | str | None = None) -> DataFrame:
    """Streaming variant of :func:`read_games` over the files arriving in ``directory``; a micro-batch is
    bounded by files or by bytes (``"2g"``), not by both."""
    reader = spark.readStream.format("text").option("lineSep", GAME_SEPARATOR)
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("a micro-batch is bounded by files or by bytes")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return _shape(reader.load(directory), with_source)


def _shape(raw: DataFrame, with_source: bool) -> DataFrame:
    if not with_source:
        # Drop partition columns too, so nothing but the text is read.
        return raw.select(F.col("value").alias("game"))
    cols = [F.col("value").alias("game")]
    if with_source:
        path = F.col("_metadata.file_path")
        if "source_month" in raw.columns:
            # The partition column itself, untouched: filters on it prune directories at
            # planning time (PartitionFilters) and it costs nothing per row.
            month = F.col("source_month").cast("string")
        else:
            month = source_month_from_path(path)
        cols += [path.alias("source_file"), month.alias("source_month")]
    return raw.select(*cols)


def source_month_from_path(path: Column | str) -> Column:
    """``YYYY-MM`` of a dump file name, else of a ``source_month=`` directory, else NULL."""
    path = F.col(path) if isinstance(path, str) else path
    from_name = F.regexp_extract(path, r"(?U)" + DUMP_MONTH_PATTERN + r"[^/]*\z", 1)
    from_dir = F.regexp_extract(path, r"/source_month=(\d{4}-\d{2})/[^/]*\z", 1)
    return (F.when(from_name != F.lit(""), from_name)
            .when(from_dir != F.lit(""), from_dir))


def empty_files(spark: SparkSession, files: list[str]) -> list[str]:
    """The files that hold no game: those of no bytes, and compressed ones that decode to none."""
    sizes = dict(zip(files, fs.lengths(spark, files)))
    packed = [f for f, n in sizes.items() if n and f.lower().endswith(COMPRESSED_SUFFIXES)]
    some: set[str] = set()
    if packed:
        rows = spark.read.option("lineSep", GAME_SEPARATOR).text(packed)
        some = {r[0] for r in rows.select(F.col("_metadata.file_path")).distinct().collect()}  # a row per file
    return [f for f, n in sizes.items() if not n or (f in packed and f not in some)]


def month_of_path(path: str) -> str | None:
    """:func:`source_month_from_path` of a literal path."""
    found = (re.search(DUMP_MONTH_PATTERN + r"[^/]*\Z", path)
             or re.search(r"/source_month=([0-9]{4}-[0-9]{2})/[^/]*\Z", path))
    return found.group(1) if found else None
