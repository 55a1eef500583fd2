"""Test inputs derived from the driver's tables by Spark.

``/root/testdata`` holds no PGN, so games are *generated* from ``lineitem`` (one game per row)
with column expressions; the DuckDB oracle computes the expected keys straight from the same
columns, never looking at PGN text. The rules (FIXTURES.md section 3) put edge cases into every
run: absent/duplicate/malformed tags, lower case and padded ECO codes, indented header lines,
CRLF games, a ``+`` sign, long zero padding and 16-bit overflow in Elo values, uncounted results.

Index lines for ingest plans and ledger events are generated from ``orders`` the same way.
All of it scales with the input tables; nothing is a fixed small frame.
"""

from __future__ import annotations

import functools
import hashlib
import pathlib
import threading
import uuid

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chesstally import fs
from chesstally.operators.aggregate import aggregate_games
from chesstally.session import scratch_path
from chesstally.sources.pgn import GAME_SEPARATOR, read_games
from chesstally.sources.pgn_source import filesystem

GENERATOR_VERSION = "g5"
GAMES_PER_TASK = 500_000  # written by one task, in the order of its range
_LOCK = threading.RLock()  # re-entrant: aggregate_table builds on pgn_dataset


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def game_text(li: DataFrame) -> Column:
    """Generated PGN text of one game from the ``lineitem`` columns of its row."""
    ok, pk, sk, ln = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    ymd = F.replace(_s(F.col("l_shipdate").cast("date")), F.lit("-"), F.lit("."))

    utc = (F.when(ok % 7 == 0, F.lit(None).cast("string"))
           .when(ok % 11 == 0, F.lit('[UTCDate "????.??.??"]'))
           .when(ok % 23 == 1, F.lit('[UTCDate ""]'))
           .otherwise(F.concat(F.lit('[UTCDate "'), ymd, F.lit('"]'))))

    letter = F.lit("ABCDE").substr((ok % 5 + 1).cast("int"), F.lit(1))
    letter = F.when(ok % 3 == 0, F.lower(letter)).otherwise(letter)
    code = F.concat(letter, F.lpad(_s((pk * 7 + ln) % 100), 2, "0"))
    eco_val = (F.when(pk % 17 == 0, F.lit("?"))
               .when(ln == 3, F.concat(F.lit(" "), code, F.lit(" ")))
               .otherwise(code))
    eco = (F.when(ok % 13 == 0, F.lit(None).cast("string"))
           .when(ln == 4, F.concat(F.lit('  [ECO   "'), eco_val, F.lit('" x]\t')))
           .otherwise(F.concat(F.lit('[ECO "'), eco_val, F.lit('"]'))))

    white_n = _s(F.lit(1400) + F.floor(F.col("l_extendedprice")) % 600)
    white_val = (F.when(sk % 19 == 0, F.lit("?"))
                 .when(ln == 2, F.concat(F.lit("+"), white_n))
                 .when(ln == 6, F.lpad(white_n, 22, "0"))
                 .otherwise(white_n))
    black_val = (F.when(pk % 23 == 0, F.lit("70000"))
                 .when(sk % 29 == 0, F.lit(" 1500"))
                 .otherwise(_s(F.lit(1400) + (pk * 37) % 600)))

    r = (ok + ln) % 5
    result = (F.when(r == 0, F.lit("1-0"))
              .when(r == 1, F.lit("0-1"))
              .when(r == 2, F.lit("1/2-1/2"))
              .when(r == 3, F.when(ok % 2 == 0, F.lit(" 1-0")).otherwise(F.lit("*"))))
    result_line = F.when(result.isNotNull(), F.concat(F.lit('[Result "'), result, F.lit('"]')))

    lines = F.array(
        F.lit('[Event "Rated game"]'),
        F.concat(F.lit('[Site "https://example.org/g/'), _s(ok), F.lit("-"), _s(ln), F.lit('"]')),
        utc,
        F.concat(F.lit('[Date "'), ymd, F.lit('"]')),
        F.concat(F.lit('[White "p'), _s(sk), F.lit('"]')),
        F.concat(F.lit('[Black "q'), _s(pk), F.lit('"]')),
        F.concat(F.lit('[WhiteElo "'), white_val, F.lit('"]')),
        F.lit('[BlackElo "9"]'),
        F.concat(F.lit('[BlackElo "'), black_val, F.lit('"]')),
        eco,
        result_line,
        F.lit(""),
        F.concat(F.lit("1. e4 e5 2. Nf3 Nc6 3. Bb5 a6 { [%clk 0:01:00] } "),
                 F.coalesce(F.trim(result), F.lit("*"))),
        F.lit("[%clk 0:01:00]"),
    )
    # Absent tags are NULL and left out. (A function with a lambda keeps the text out of whole-stage
    # code, whose one method would be too long for the JVM to compile: that took four times as long.)
    text = F.concat_ws("\n", F.filter(lines, lambda line: line.isNotNull()))
    return F.when(ok % 4 == 1, F.replace(text, F.lit("\n"), F.lit("\r\n"))).otherwise(text)


def generated_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source_month string, game string``: one generated game per ``lineitem`` row."""
    return _monthly(game_rows(spark, sf_dir))


def game_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with the ``source_month`` of each row's game."""
    month = F.date_format(F.col("l_shipdate"), "yyyy-MM")
    return _table(spark, sf_dir, "lineitem").select(
        month.alias("source_month"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate")


def _in_ranges(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows dealt by ranges of ``by`` and sorted by it, as many to a task whatever the table's size: the
    columns of a row, about a third of its game's text, are what is dealt and sorted."""
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")), -(-rows.count() // GAMES_PER_TASK))
    return rows.repartitionByRange(n, *by).sortWithinPartitions(*by)


@functools.lru_cache(maxsize=1)
def _code_digest() -> str:
    """Hash of the package sources: cached inputs are rebuilt whenever the code changes."""
    root = pathlib.Path(__file__).resolve().parent.parent
    h = hashlib.sha1()
    for path in sorted(root.rglob("*.py")):
        h.update(path.relative_to(root).as_posix().encode())
        h.update(path.read_bytes())
    return h.hexdigest()[:10]


def _key(spark: SparkSession, sf_dir: str, layout: str, table: str = "lineitem") -> str:
    """Key of a cached input: code, layout, and the table's files with their lengths and times."""
    path = f"{str(sf_dir).rstrip('/')}/{table}.parquet"
    digest = hashlib.sha1(f"{layout}|{fs.signature(spark, path)}".encode()).hexdigest()[:12]
    return f"{GENERATOR_VERSION}-{_code_digest()}-{layout}-{digest}"


def pgn_dataset(spark: SparkSession, sf_dir: str, layout: str = "monthly") -> str:
    """Directory of generated PGN text files; written once, then reused.

    ``monthly``: ``source_month=YYYY-MM/part-*.txt`` like one dump per month (range partitioning
    on ``(source_month, l_orderkey)`` balances the write even when one month holds most games).
    """
    target = scratch_path(spark, "pgn", _key(spark, sf_dir, layout))
    with _LOCK:
        if fs.exists(spark, target + "/_SUCCESS"):
            return target
        rows = game_rows(spark, sf_dir)
        by = ["source_month", "l_orderkey"]
        staging = f"{target}.tmp-{uuid.uuid4().hex}"
        if layout == "monthly":
            _monthly(_in_ranges(rows, by)).write.partitionBy("source_month").text(staging)
        elif layout == "halves":  # run=0 and run=1 hold games of every month, in gzip files
            rows = _in_ranges(rows.withColumn("run", F.col("l_orderkey") % 2), ["run", *by])
            (rows.select("run", "source_month", game_text(rows))
             .write.option("compression", "gzip").partitionBy("run", "source_month").text(staging))
        elif layout == "gzip":
            (_monthly(_in_ranges(rows, by))
             .write.option("compression", "gzip").partitionBy("source_month").text(staging))
        elif layout == "tails":  # one file of every even month ends in a bare "[Event "
            rows = _with_tail(rows.where(_even_month().isNotNull()))
            _monthly(_in_ranges(rows.where(~F.col("tail")), by)).write.partitionBy("source_month").text(staging)
            ends = rows.where("tail").repartition("source_month")
            rest = F.substr(game_text(ends), F.lit(len("[Event ") + 1)).alias("game")
            (ends.select("source_month", rest)
             .write.mode("append").option("lineSep", GAME_SEPARATOR).partitionBy("source_month").text(staging))
        elif layout == "zst":  # like "tails", as zstd files of many frames
            _write_zst(_in_ranges(_with_tail(rows), by), staging)
        elif layout == "events":  # every seventh game's Event line holds a header
            tag = F.when(F.col("l_orderkey") % 7 == 3, '[Event [ECO "B45"]').when(
                F.col("l_orderkey") % 7 == 5, F.lit('[Event "Open, round "1""]')).otherwise('[Event "Rated game"]')
            rows = _in_ranges(rows, by)
            line = F.substr(game_text(rows), F.lit(len('[Event "Rated game"]') + 1))
            (rows.select("source_month", F.concat(tag, line).alias("game"))
             .write.partitionBy("source_month").text(staging))
        else:
            raise ValueError(f"unknown layout {layout!r}")
        fs.rename_if_absent(spark, staging, target)  # another writer may have won: keep theirs
        return target


def _monthly(rows: DataFrame) -> DataFrame:
    return rows.select("source_month", game_text(rows).alias("game"))


def _with_tail(rows: DataFrame) -> DataFrame:
    """``tail``: whether a row's game is of its month's last order, if that is an even month; one task alone
    writes these games, as the end of a file."""
    last = (rows.where(_even_month()).groupBy("source_month")
            .agg(F.max("l_orderkey").alias("last_key"), F.lit(True).alias("even")))  # a row per month
    tail = F.col("even") & F.col("l_orderkey").eqNullSafe(F.col("last_key"))
    return (rows.join(F.broadcast(last), "source_month", "left")
            .select(*rows.columns, F.coalesce(tail, F.lit(False)).alias("tail")))


_FRAME_BYTES = 20_000


def _write_zst(rows: DataFrame, path: str) -> None:
    """``source_month=YYYY-MM/games-N.pgn.zst`` below ``path``, a file per task and month: frames cut without
    regard to games, every third one preceded by a skippable frame; files whose last ``tail`` is true end in
    a bare ``[Event ``."""
    def write(batches):
        import zstandard

        part = TaskContext.get().partitionId()
        out, month, ends, held, count = None, None, b"", b"", 0

        def put(data: bytes) -> None:
            nonlocal count
            if count % 3 == 0:
                out.write(b"\x50\x2a\x4d\x18\x04\x00\x00\x00" + len(data).to_bytes(4, "little"))
            out.write(zstandard.ZstdCompressor(3, write_checksum=count % 2 == 0).compress(data))
            count += 1

        for batch in batches:
            for key, game, tail in zip(*(c.to_pylist() for c in batch.columns)):
                if key != month:
                    if out:
                        put(held + ends)
                        out.close()
                    month, held = key, b""
                    files, inner = filesystem(f"{path}/source_month={key}/games-{part:05d}.pgn.zst")
                    files.create_dir(inner.rsplit("/", 1)[0])
                    out = files.open_output_stream(inner, compression=None)
                held += game.encode() + b"\n"
                ends = b"[Event " if tail else b""
                while len(held) > _FRAME_BYTES:
                    put(held[:_FRAME_BYTES])
                    held = held[_FRAME_BYTES:]
        if out:
            put(held + ends)
            out.close()
        yield from ()

    (rows.select("source_month", game_text(rows).alias("game"), "tail").mapInArrow(write, "done int")
     .write.format("noop").mode("overwrite").save())
    fs.write_text_file(rows.sparkSession, f"{path}/_SUCCESS", "")


def _even_month() -> Column:
    return F.substring("source_month", 6, 2).cast("int") % 2 == 0


def write_dumps(spark: SparkSession, rows: DataFrame, root: str, packed: bool = False) -> dict[str, list[str]]:
    """The dump of every month of ``rows`` (:func:`game_rows`) at ``root``, named like published dumps, in as
    many files as tasks wrote it (``packed``: gzip files); it replaces the month's dump that is there (a file of
    that one that is no longer needed becomes empty). Returns ``{month: paths}``."""
    staging, end = f"{root}.tmp-{uuid.uuid4().hex}", ".gz" if packed else ""
    (_monthly(_in_ranges(rows, ["source_month", "l_orderkey"]))
     .write.option("compression", "gzip" if packed else "none").partitionBy("source_month").text(staging))
    fs.mkdirs(spark, root)
    there = set(fs.list_files(spark, root))
    out: dict[str, list[str]] = {}
    for d in fs.list_dirs(spark, staging):
        month = d.rstrip("/").rsplit("source_month=", 1)[-1]
        stem = f"{root}/games_rated_{month}.pgn"
        parts = [f for f in fs.list_files(spark, d) if "/part-" in f]
        out[month] = [stem + end, *(f"{stem}.{i}{end}" for i in range(1, len(parts)))]
        for part, path in zip(parts, out[month]):
            fs.move_file(spark, part, path)
        new = {p.rsplit("/", 1)[-1] for p in out[month]}
        for old in there:
            name = old.rsplit("/", 1)[-1]
            if name.startswith(stem.rsplit("/", 1)[-1]) and name not in new:
                fs.write_text_file(spark, old, "")
    fs.delete(spark, staging)
    return out


def aggregate_table(spark: SparkSession, sf_dir: str) -> str:
    """The aggregate of all generated games, written once as parquet and reused.

    Trend queries read this table, as they would read the store in production: key filters then
    push into a cheap parquet scan, and the games are parsed once for all queries.
    """
    target = scratch_path(spark, "agg", _key(spark, sf_dir, "aggregate"))
    pgn = pgn_dataset(spark, sf_dir)
    with _LOCK:
        if fs.exists(spark, target + "/_SUCCESS"):
            return target
        games = read_games(spark, pgn, with_source=False)
        staging = f"{target}.tmp-{uuid.uuid4().hex}"
        aggregate_games(games).write.parquet(staging)
        fs.rename_if_absent(spark, staging, target)  # another writer may have won: keep theirs
        return target


def generated_index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump-index lines (``value string``), one per ``orders`` row; some are malformed."""
    o = _table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    month = F.date_format(F.col("o_orderdate"), "yyyy-MM")
    base = F.concat(F.lit("https://example.org/standard/games_rated_"), month)
    v = ok % 10
    line = (F.when(v == 1, F.concat(F.lit("  "), base, F.lit(".pgn.zst \t")))
            .when(v == 2, F.concat(base, F.lit(".pgn.bz2")))
            .when(v == 3, F.concat(base, F.lit(".pgn.zst.torrent")))
            .when(v == 4, F.lit(""))
            .when(v == 5, F.concat(F.lit("https://mirror.example.net/"), month, F.lit(".pgn.zst")))
            .when(v == 6, F.lit("   "))
            .otherwise(F.concat(base, F.lit(".pgn.zst"))))
    return o.select(line.alias("value"))


def generated_ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingestion-ledger events, one per ``orders`` row, in the ledger event schema."""
    o = _table(spark, sf_dir, "orders")
    ok = F.col("o_orderkey")
    month = F.date_format(F.col("o_orderdate"), "yyyy-MM")
    at = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    kind = F.when(ok % 5 < 2, F.lit("start")).otherwise(F.lit("finish"))
    start = kind == F.lit("start")
    return o.select(
        month.alias("month"),
        ok.alias("seq"),
        kind.alias("kind"),
        F.when(start, F.concat(F.lit("https://example.org/standard/games_rated_"), month,
                                F.lit(".pgn.zst"))).alias("url"),
        at.alias("event_at"),
        F.when(~start, F.col("o_custkey") % 1000).alias("games"),
        F.when(~start, F.floor(F.col("o_totalprice")).cast("bigint")).alias("duration_ms"),
        F.when(start, F.lit("started"))
         .when(ok % 5 == 4, F.lit("failed"))
         .otherwise(F.lit("success")).alias("status"),
    )
