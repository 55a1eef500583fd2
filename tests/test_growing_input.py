"""What a task holds and how many tasks there are as the input grows."""

import glob
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from chesstally import fs
from chesstally.operators.aggregate import rebalance_games
from chesstally.sources import pgn, pgn_source
from chesstally.sources.pgn import read_games
from chesstally.testing import fixtures, queries
from tests.conftest import write


@pytest.fixture()
def tables(spark, tmp_dir):
    """Orders of four games over the months of 1995, in one folder."""
    rows = spark.range(2400).select(
        F.floor(F.col("id") / 4).alias("l_orderkey"), (F.col("id") % 101).alias("l_partkey"),
        (F.col("id") % 37).alias("l_suppkey"), (F.col("id") % 4 + 1).cast("int").alias("l_linenumber"),
        (F.col("id") * 1.5).alias("l_extendedprice"),
        F.make_date(F.lit(1995), (F.col("id") % 12 + 1).cast("int"), F.lit(3)).cast("timestamp_ntz").alias("l_shipdate"))
    rows.coalesce(1).write.parquet(f"{tmp_dir}/lineitem.parquet")
    return tmp_dir


def test_ranges_of_large_inputs_grow(tmp_dir):
    files = [["/a.pgn", 12_000_000_000], ["/b.pgn", 7]]
    ranges = pgn_source.PgnReader({"files": json.dumps(files), "splitbytes": "16384"}).partitions()
    assert len(ranges) <= pgn_source.MAX_RANGES + len(files)
    assert [r.start for r in ranges[1:-1]] == [r.end for r in ranges[:-2]]
    assert (ranges[-2].end, ranges[-1].end) == (12_000_000_000, 7)
    huge = pgn_source.PgnReader({"files": json.dumps([["/a.pgn", 10**12]]), "splitbytes": "16384"}).partitions()
    assert max(r.end - r.start for r in huge) == pgn_source.SPLIT_BYTES
    small = pgn_source.PgnReader({"files": json.dumps([["/a.pgn", 100_000]]), "splitbytes": "16384"}).partitions()
    assert len(small) == 7


def test_a_range_of_small_frames_reads_little_beyond_its_end(tmp_dir):
    import zstandard

    text = "".join(f'[Event "{i}"]\n\n1. e4\n' for i in range(20_000)).encode()
    frames = [zstandard.ZstdCompressor(1).compress(text[i:i + 300]) for i in range(0, len(text), 300)]
    path = write(f"{tmp_dir}/a.pgn.zst", b"".join(frames))
    size, read = os.path.getsize(path), []

    class File:
        def __init__(self, f):
            self.f = f

        def read_at(self, n, at):
            read.append(n)
            return self.f.read_at(n, at)

    with pgn_source.open_file(path) as f:
        list(pgn_source.records(pgn_source._decoded(File(f), pgn_source.Range(path, 0, 16384, size)), True))
    assert size > pgn_source._LOOK and max(read) <= pgn_source._LOOK


@pytest.mark.parametrize("layout", ["monthly", "halves", "gzip", "tails", "zst", "events"])
def test_generated_files_stay_small(spark, tables, layout, monkeypatch):
    monkeypatch.setattr(fixtures, "GAMES_PER_TASK", 60)
    monkeypatch.setattr(fixtures, "GENERATOR_VERSION", f"test-{os.path.basename(tables)}")
    root = fixtures.pgn_dataset(spark, tables, layout).removeprefix("file:")
    parts = [p for p in glob.glob(f"{root}/**/*", recursive=True) if os.path.isfile(p) and os.path.getsize(p)
             and not os.path.basename(p).startswith("_")]
    games = read_games(spark, root, recursive=True, zst_frames=True)
    counts = games.groupBy("source_file").count().collect()
    assert len(counts) == len(parts) and max(r["count"] for r in counts) <= 150
    bare = 6 if layout in ("tails", "zst") else 0  # one for every even month
    assert sum(r["count"] for r in counts) == 2400 + bare
    ends = games.where(F.trim("game") == "[Event" if layout != "zst" else F.col("game") == "")
    assert ends.count() == bare and ends.select("source_month").distinct().count() == bare


def test_dumps_in_several_files_are_replaced(spark, tables, monkeypatch):
    monkeypatch.setattr(fixtures, "GAMES_PER_TASK", 60)
    rows, root = fixtures.game_rows(spark, tables), f"{tables}/dumps"
    dumps = fixtures.write_dumps(spark, rows, root)
    assert len(dumps) == 12 and max(map(len, dumps.values())) > 1
    games = read_games(spark, root)
    assert {(r.source_month, r["count"]) for r in games.groupBy("source_month").count().collect()} == {
        (m, 200) for m in dumps}
    assert {p for paths in dumps.values() for p in paths} == {
        f"{root}/{os.path.basename(p)}" for p in glob.glob(f"{root}/*")}
    fixtures.write_dumps(spark, rows.where("l_orderkey < 6 and month(l_shipdate) = 4"), root)
    left = read_games(spark, root).where("source_month = '1995-04'")
    assert left.count() == 2 and read_games(spark, root).count() == 2200 + 2
    assert all(os.path.exists(p) for p in dumps["1995-04"])


def test_games_of_large_files_are_dealt_to_more_tasks(spark, tmp_dir, monkeypatch):
    text = "".join(f'[Event "{i}"]\n[Site "{i * 7919 % 10007}"]\n\n1. e4\n' for i in range(3000)).encode()
    path = write(f"{tmp_dir}/a.pgn.gz", gzip.compress(text))
    assert rebalance_games(read_games(spark, path), 3).rdd.getNumPartitions() == 3
    monkeypatch.setattr(pgn, "DEAL_BYTES", 10_000)
    dealt = rebalance_games(read_games(spark, path), 3)
    sizes = [n for n in dealt.rdd.glom().map(len).collect() if n]
    assert len(sizes) > 8 and max(sizes) < 1000
    assert sorted(r.game for r in dealt.collect()) == sorted(r.game for r in read_games(spark, path).collect())


def test_positions_need_no_task_with_all_rows(spark, tmp_dir):
    df = spark.range(1000).repartitionByRange(7, "id").where("id not between 100 and 400").selectExpr("id", "id % 3 as r")
    got = queries._numbered(spark, df.orderBy(F.desc("id")))
    assert got.columns == ["id", "r", "position"] and dict(got.dtypes)["position"] == "int"
    rows = sorted((r.position, r.id) for r in got.collect())
    want = [i for i in range(999, -1, -1) if not 100 <= i <= 400]
    assert rows == list(enumerate(want, 1))
    assert "row_number" not in got._jdf.queryExecution().executedPlan().toString()
    assert queries._numbered(spark, df.where("id < 0")).collect() == []


def _bytes_below(root):
    return sum(os.path.getsize(p) for p in glob.glob(f"{root.removeprefix('file:')}/**/*", recursive=True)
               if os.path.isfile(p) and not os.path.basename(p).startswith("_"))


def _text_bytes(spark, tables):
    return fixtures.generated_games(spark, tables).agg(F.sum(F.length("game") + 1)).first()[0]


def _kept_whole(spark, tables, monkeypatch, name):
    """Runs a query; its result, and the folders of generated games that it read."""
    roots, real = [], fixtures.pgn_dataset
    monkeypatch.setattr(fixtures, "GENERATOR_VERSION", f"test-{os.path.basename(tables)}")
    monkeypatch.setattr(fixtures, "pgn_dataset", lambda *a: (roots.append(real(*a)), roots[-1])[1])
    monkeypatch.setattr(queries, "_run_dir", lambda s, kind: f"{tables}/{kind}")
    return queries.QUERIES[name](spark, tables), roots


def test_landed_halves_take_less_disk_than_their_text(spark, tables, monkeypatch):
    got, (root,) = _kept_whole(spark, tables, monkeypatch, "landed_two_runs")
    assert got.agg(F.sum("games")).first()[0] == 2400
    assert 0 < _bytes_below(root) < _text_bytes(spark, tables) / 3


def test_changed_dumps_take_less_disk_than_their_text(spark, tables, monkeypatch):
    monkeypatch.setattr(fixtures, "GAMES_PER_TASK", 60)
    got, _ = _kept_whole(spark, tables, monkeypatch, "store_reingest_changed")
    # Months 3, 6 ... have no games any more, months 1, 4 ... those of even orders.
    left = fixtures.game_rows(spark, tables).where(
        "month(l_shipdate) % 3 = 2 or month(l_shipdate) % 3 = 1 and l_orderkey % 2 = 0").count()
    assert got.agg(F.sum("games")).first()[0] == left and 0 < left < 1600
    held = _bytes_below(f"{tables}/changed/dumps")
    assert 0 < held < read_games(spark, f"{tables}/changed/dumps").agg(F.sum(F.length("game"))).first()[0] / 3
    assert sum(not os.path.getsize(p) for p in glob.glob(f"{tables}/changed/dumps/*")) >= 4


def test_csv_at_width_1_takes_less_disk_than_the_text(spark, tables, monkeypatch):
    got, (root,) = _kept_whole(spark, tables, monkeypatch, "csv_order_width_1")
    rows = got.collect()
    assert sum(r.games for r in rows) == 2400 and sorted(r.position for r in rows) == list(range(1, len(rows) + 1))
    assert 0 < _bytes_below(root) < _text_bytes(spark, tables) / 3


def test_joined_parts_go_as_they_are_copied(spark, tmp_dir):
    parts = [write(f"{tmp_dir}/p/{i}", f"{i}\n" * 3) for i in range(4)]
    fs.join_files(spark, parts, f"{tmp_dir}/all")
    assert open(f"{tmp_dir}/all").read() == "".join(f"{i}\n" * 3 for i in range(4))
    assert os.listdir(f"{tmp_dir}/p") == []
    late = write(f"{tmp_dir}/p/late", "x\n")
    with pytest.raises(Exception, match="absent"):  # a part that was not reached stays, and so does the file
        fs.join_files(spark, [f"{tmp_dir}/absent", late], f"{tmp_dir}/all")
    assert os.listdir(f"{tmp_dir}/p") == ["late"] and os.path.getsize(f"{tmp_dir}/all") == 24
