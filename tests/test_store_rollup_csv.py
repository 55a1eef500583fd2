"""Month level of the store, materialised roll-up, ordered CSV by several tasks."""

import os
import random

import pytest
from pyspark.sql import functions as F

from chesstally import aggregate_games
from chesstally.operators import trends
from chesstally.operators.aggregate import KEY_COLUMNS, MEASURE_COLUMNS
from chesstally.sinks import rollup, store
from chesstally.sinks.csv import CSV_COLUMNS, write_csv, write_csv_per_source_month
from chesstally.sources.pgn import month_of_path, read_games, source_month_from_path
from tests.conftest import write
from tests.test_sinks_streaming import _tuples, dump, game


def test_month_of_path_is_the_column_rule(spark):
    paths = ["file:/d/games_rated_2013-07.pgn.zst", "/d/x_2013-07.pgn", "/d/source_month=2014-01/part-1.txt",
             "/2012-01.pgn/other.txt", "/d/source_month=2014-01/y_2015-02.pgn", "/d/x.pgn", "/d/2013-07",
             "/d/a2013-07.pgn_2014-08.pgn"]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select("p", source_month_from_path("p").alias("m")).collect()
    assert {r.p: r.m for r in got} == {p: month_of_path(p) for p in paths}


def test_bounds_prune_folders(spark, tmp_dir):
    for m in range(1, 7):
        dump(tmp_dir, f"2013-{m:02d}", m)
    write(os.path.join(tmp_dir, "dumps", "undated.pgn"), game("2013-03", "B45", "1-0"))
    st = os.path.join(tmp_dir, "st")
    store.ingest_games(read_games(spark, os.path.join(tmp_dir, "dumps")), st)
    assert sorted(d for d in os.listdir(st) if d.startswith("source_month")) == [
        *(f"source_month=2013-{m:02d}" for m in range(1, 7)), "source_month=__HIVE_DEFAULT_PARTITION__"]
    part = store.read_store(spark, st, since="2013-3", until="2013-05")
    assert part.agg(F.sum("games")).first()[0] == 3 + 4 + 5
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "source_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    for m in ("01", "02", "06"):  # files of other months are not opened
        for d, _, files in os.walk(os.path.join(st, f"source_month=2013-{m}")):
            for f in files:
                write(os.path.join(d, f), b"broken")
    assert store.read_store(spark, st, since="2013-3", until="2013-05").agg(F.sum("games")).first()[0] == 12
    store.ingest_games(read_games(spark, os.path.join(tmp_dir, "dumps")), st)
    assert store.read_store(spark, st).agg(F.sum("games")).first()[0] == 22
    with pytest.raises(ValueError, match="since"):
        store.read_store(spark, st, since="2013-13")


def test_migration_of_a_store_without_months(spark, tmp_dir, monkeypatch):
    dump(tmp_dir, "2013-01", 3)
    dump(tmp_dir, "2013-02", 5)
    games = read_games(spark, os.path.join(tmp_dir, "dumps"))
    st = os.path.join(tmp_dir, "old")
    store.check_bucket_size(spark, st, 200)
    (store.aggregate_by_source(games).select(*store.SOURCE_COLUMNS, *KEY_COLUMNS, *MEASURE_COLUMNS)
     .write.mode("append").partitionBy("source_id").parquet(st))
    for use in (lambda: store.read_store(spark, st), lambda: store.ingest_games(games, st)):
        with pytest.raises(ValueError, match="migrate_store"):
            use()

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(store.fs, "delete", crash)
        with pytest.raises(OSError):
            store.migrate_store(spark, st)
    assert store.migrate_store(spark, st) == 2
    assert _tuples(store.read_store(spark, st)) == _tuples(aggregate_games(games))
    store.ingest_games(games, st)
    assert _tuples(store.read_store(spark, st)) == _tuples(aggregate_games(games))
    assert store.migrate_store(spark, st) == 0


def test_filtered_games_do_not_empty_other_sources(spark, tmp_dir):
    dump(tmp_dir, "2013-01", 3)
    dump(tmp_dir, "2013-02", 5)
    st = os.path.join(tmp_dir, "st")
    games = read_games(spark, os.path.join(tmp_dir, "dumps"))
    store.ingest_games(games, st)
    store.ingest_games(games.where(F.col("source_month") == "2013-02"), st)
    assert store.read_store(spark, st).agg(F.sum("games")).first()[0] == 8


def test_rollup_refreshes_touched_months_only(spark, tmp_dir, monkeypatch):
    st, ru = os.path.join(tmp_dir, "st"), os.path.join(tmp_dir, "ru")
    dumps = os.path.join(tmp_dir, "dumps")

    def mtimes():
        return {d: max(os.stat(os.path.join(ru, d, f)).st_mtime_ns for f in os.listdir(os.path.join(ru, d)))
                for d in os.listdir(ru) if d.startswith("month=")}

    def same():
        want = trends.rollup_counts(store.read_store(spark, st))
        assert sorted(map(str, rollup.read_rollup(spark, ru).collect())) == sorted(map(str, want.collect()))

    for m in ("01", "02", "03"):
        dump(tmp_dir, f"2013-{m}", 8)
    assert rollup.ingest_games(read_games(spark, dumps), st, ru) == ["2013-01", "2013-02", "2013-03"]
    same()
    before = mtimes()
    path = dump(tmp_dir, "2013-04", 6)  # holds games of another month, too
    write(path, open(path).read() + game("2013-02", "E99", "1-0"))
    assert rollup.ingest_games(read_games(spark, path), st, ru) == ["2013-02", "2013-04"]
    same()
    after = mtimes()
    assert {d for d in after if after[d] != before.get(d)} == {"month=2013-02", "month=2013-04"}
    write(path, game("2013-03", "A00", "0-1"))  # now other months: the old ones change, too
    assert rollup.ingest_games(read_games(spark, path), st, ru) == ["2013-02", "2013-03", "2013-04"]
    same()
    assert "month=2013-04" not in mtimes()

    def crash(*_):
        raise OSError("lost")

    write(path, game("2013-05", "A00", "0-1"))
    with monkeypatch.context() as m:
        m.setattr(rollup, "refresh", crash)
        with pytest.raises(OSError):
            rollup.ingest_games(read_games(spark, path), st, ru)
    assert rollup.refresh(spark, st, ru) == ["2013-03", "2013-05"]  # from the note
    same()
    assert rollup.refresh(spark, st, ru) == []


def test_jobs_refresh_the_rollup(spark, tmp_dir):
    from chesstally.cli import parse_args
    from chesstally.jobs import run_files_counted, run_index

    st, ru = os.path.join(tmp_dir, "st"), os.path.join(tmp_dir, "ru")
    paths = [dump(tmp_dir, f"2013-{m:02d}", m + 2) for m in range(1, 5)]
    os.rename(paths[3], paths[3] + "x")
    names = [p.replace(".pgn", ".pgn.zst") for p in paths[:3]]
    import zstandard
    for p, n in zip(paths, names):
        write(n, zstandard.ZstdCompressor().compress(open(p, "rb").read()))
    index = write(os.path.join(tmp_dir, "index.txt"), "".join(f"{n}\n" for n in names))
    assert sorted(run_index(spark, index, store=st, rollup=ru, zst_frames=True)) == ["2013-01", "2013-02", "2013-03"]
    os.rename(paths[3] + "x", paths[3])
    assert run_files_counted(spark, [paths[3]], store=st, rollup=ru) == 6
    got = rollup.read_rollup(spark, ru)
    assert sorted(map(str, got.collect())) == sorted(map(str, trends.rollup_counts(store.read_store(spark, st)).collect()))
    assert got.where("month is null").first().games == 3 + 4 + 5 + 6
    with pytest.raises(SystemExit):
        parse_args(["x.pgn", "--rollup", ru])


def wide(spark, n):
    rng = random.Random(2)
    rows = [(f"2013-{rng.randint(1, 2):02d}", "B20-B99", i, 0, rng.randint(1, 4), 0, 0, 0) for i in range(n)]
    return spark.createDataFrame(rows, "month string, eco_group string, white_bucket int, black_bucket int, games long, "
                                       "white_wins long, black_wins long, draws long")


def test_one_ordered_csv_from_several_sort_tasks(spark, tmp_dir, monkeypatch):
    from chesstally.sinks import csv

    joined = []
    real = csv.fs.join_files
    monkeypatch.setattr(csv.fs, "join_files", lambda s, parts, dst: (joined.append(len(parts)), real(s, parts, dst)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = wide(spark, 3000)
        out = os.path.join(tmp_dir, "o", "agg.csv")
        write(out, "old\n")
        write_csv(df, out)
        by_month = df.withColumn("source_month", F.when(F.col("white_bucket") < 2800, "2013-01").otherwise("2013-02"))
        os.makedirs(os.path.join(tmp_dir, "m"))
        paths = write_csv_per_source_month(by_month, os.path.join(tmp_dir, "m"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert joined[0] > 4 and max(joined[1:]) > 4  # a header and several parts, of one hot month too

    def rows(path):
        lines = open(path).read().splitlines()
        assert lines[0] == ",".join(CSV_COLUMNS) and not any(x == lines[0] for x in lines[1:])
        return [tuple(int(v) if v.isdigit() else v for v in x.split(",")) for x in lines[1:]]

    def order(r):
        return (-r[4], *r[:4])

    want = sorted((tuple(r) for r in df.collect()), key=order)
    assert rows(out) == want
    got = {os.path.basename(p): rows(p) for p in paths}
    assert got["2013-01.csv"] == [r for r in want if r[2] < 2800]
    assert got["2013-02.csv"] == [r for r in want if r[2] >= 2800]
    left = [f for d, _, fs in os.walk(tmp_dir) for f in fs if "joining" in f or ".tmp-" in f or "header" in f]
    assert left == []
