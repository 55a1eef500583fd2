"""Game segmentation of PGN text files (the reference's line loop), incl. splits and zstd."""

import os

import pytest
import zstandard
from pyspark.sql import functions as F

from chesstally.operators.aggregate import aggregate_games, total_games
from chesstally.sources.pgn import read_games, source_month_from_path
from tests.conftest import write

GAME = '[Event "Rated"]\n[UTCDate "2013.07.01"]\n[ECO "B45"]\n[Result "1-0"]\n\n1. e4 1-0\n'


def reference_game_count(text: str) -> int:
    """The reference's segmentation loop, as a brute-force oracle for small inputs."""
    games, current = 0, []
    for line in text.split("\n")[:-1] + ([text.split("\n")[-1]] if text.split("\n")[-1] else []):
        if line.endswith("\r"):
            line = line[:-1]
        if line.startswith("[Event ") and current:
            games += 1
            current = []
        current.append(line)
    return games + (1 if current else 0)


CASES = {
    "plain": GAME * 3,
    "leading_blank": "\n" + GAME * 3,
    "crlf": (GAME * 3).replace("\n", "\r\n"),
    "no_final_newline": (GAME * 3).rstrip("\n"),
    "event_date": GAME + '[EventDate "2013.07.01"]\n' + GAME,
    "indented_event": GAME + '  [Event "x"]\n' + GAME,
    "no_event": "1. e4 e5\n[ECO \"B45\"]\n",
    "preamble": "some text\nmore\n" + GAME * 2,
    "empty": "",
    "only_newline": "\n",
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_game_count_matches_reference_loop(spark, tmp_dir, name):
    text = CASES[name]
    path = write(os.path.join(tmp_dir, f"{name}.pgn"), text)
    got = total_games(read_games(spark, path)).collect()[0].games
    assert got == reference_game_count(text)


def test_small_splits_keep_games_whole(spark, tmp_dir):
    games = "".join(GAME.replace("B45", f"B{i % 100:02d}") for i in range(400))
    path = write(os.path.join(tmp_dir, "big.pgn"), games)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = read_games(spark, path)
        assert df.rdd.getNumPartitions() > 10
        agg = aggregate_games(df).agg(F.sum("games"), F.sum("white_wins")).collect()[0]
        assert tuple(agg) == (400, 400)
        assert df.where(~F.col("game").contains("1. e4")).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_zstd_multi_frame_and_source_month(spark, tmp_dir):
    raw = (GAME * 5).encode()
    data = zstandard.ZstdCompressor().compress(raw[:37]) + zstandard.ZstdCompressor().compress(raw[37:])
    path = write(os.path.join(tmp_dir, "dumps", "games_rated_2013-07.pgn.zst"), data)
    df = read_games(spark, os.path.dirname(path))
    rows = df.groupBy("source_month").count().collect()
    assert [(r.source_month, r["count"]) for r in rows] == [("2013-07", 5)]
    spread = read_games(spark, os.path.dirname(path), rebalance=3)
    assert spread.rdd.getNumPartitions() == 3
    assert sorted(tuple(r) for r in aggregate_games(spread).collect()) == \
        sorted(tuple(r) for r in aggregate_games(df).collect())


def test_multiple_files_and_missing_paths(spark, tmp_dir, capsys):
    a = write(os.path.join(tmp_dir, "a.pgn"), GAME * 2)
    b = write(os.path.join(tmp_dir, "b.pgn"), GAME * 3)
    df = read_games(spark, [a, os.path.join(tmp_dir, "missing.pgn"), b], skip_missing=True)
    assert df.count() == 5
    assert "missing.pgn" in capsys.readouterr().out


def test_source_month_from_path(spark):
    df = spark.createDataFrame(
        [("s3://b/x/games_rated_2014-02.pgn.zst",), ("/d/source_month=1999-01/part-1.txt",),
         ("/d/2014-02/x.txt",), ("/d/source_month=1999-01/sub/x.txt",)], "p string")
    assert [r[0] for r in df.select(source_month_from_path("p")).collect()] == \
        ["2014-02", "1999-01", None, None]


def test_bzip2_splits_keep_games_whole(spark, tmp_dir):
    """bzip2 is splittable: a compressed dump read in many splits gives every game once."""
    import bz2
    import random

    rng = random.Random(3)
    text = "".join(
        f'[Event "R"]\n[Site "{rng.getrandbits(160):040x}"]\n[ECO "B{rng.randint(0, 99):02d}"]\n'
        f'[Result "{rng.choice(["1-0", "0-1", "1/2-1/2", "*"])}"]\n\n1. e4\n' for _ in range(20000))
    plain = write(os.path.join(tmp_dir, "plain", "g.pgn"), text)
    path = os.path.join(tmp_dir, "bz", "games_2013-07.pgn.bz2")
    os.makedirs(os.path.dirname(path))
    with bz2.open(path, "wt") as f:
        f.write(text)
    expected = sorted(tuple(r) for r in aggregate_games(read_games(spark, plain)).collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_games(spark, path)
        assert df.rdd.getNumPartitions() > 10
        assert df.count() == 20000
        assert sorted(tuple(r) for r in aggregate_games(df).collect()) == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_all_paths_missing(spark, tmp_dir):
    missing = os.path.join(tmp_dir, "none.pgn")
    assert read_games(spark, missing, skip_missing=True).columns == \
        ["game", "source_file", "source_month"]
    assert read_games(spark, missing, skip_missing=True, with_source=False).columns == ["game"]
    assert total_games(read_games(spark, missing, skip_missing=True)).collect()[0].games == 0


def test_recursive_directories(spark, tmp_dir):
    write(os.path.join(tmp_dir, "nested", "2013", "07", "games_rated_2013-07.pgn"), GAME * 2)
    write(os.path.join(tmp_dir, "nested", "2013", "08", "games_rated_2013-08.pgn"), GAME * 3)
    df = read_games(spark, os.path.join(tmp_dir, "nested"), recursive=True)
    got = sorted((r.source_month, r["count"]) for r in df.groupBy("source_month").count().collect())
    assert got == [("2013-07", 2), ("2013-08", 3)]


def test_glob_matching_nothing_is_skipped(spark, tmp_dir):
    g = os.path.join(tmp_dir, "nothing", "*.pgn.zst")
    assert read_games(spark, g, skip_missing=True).count() == 0
    with pytest.raises(Exception):
        read_games(spark, g).count()


def test_gzip_dump(spark, tmp_dir):
    import gzip

    path = os.path.join(tmp_dir, "gz", "games_rated_2013-09.pgn.gz")
    os.makedirs(os.path.dirname(path))
    with gzip.open(path, "wt") as f:
        f.write("\n" + GAME * 4)  # leading blank line: one extra (empty) game
    df = read_games(spark, os.path.dirname(path))
    assert df.count() == 5
    assert df.where(F.col("source_month") == "2013-09").count() == 5
    agg = aggregate_games(df).where(F.col("eco_group") == "B20-B99").collect()
    assert [(r.month, r.games, r.white_wins) for r in agg] == [("2013-07", 4, 4)]


def test_tails_of_very_many_files_are_read_in_tasks(spark, tmp_dir, monkeypatch):
    from chesstally.sources import pgn

    for i in range(30):
        write(os.path.join(tmp_dir, "many", f"f {i:02d}%20x.pgn"), '[Event "a"]\n' + ("\n[Event " if i % 3 else "\n"))
    few = read_games(spark, os.path.join(tmp_dir, "many")).count()
    monkeypatch.setattr(pgn, "MANY_FILES", 5)
    calls = []
    monkeypatch.setattr(pgn.fs, "file_tails", lambda *a: calls.append(a) or [])
    assert read_games(spark, os.path.join(tmp_dir, "many")).count() == few == 30 + 20 and not calls
