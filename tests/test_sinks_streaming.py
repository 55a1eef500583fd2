"""CSV outputs, the by-source store, JDBC statement text, jobs and streaming ingest."""

import os

import pytest
import zstandard
from pyspark.sql import functions as F

from chesstally.jobs import aggregate_files, ingest_plan, plan_from_index
from chesstally.operators.aggregate import KEY_COLUMNS, aggregate_games
from chesstally.sinks import jdbc, ledger, store
from chesstally.sinks.csv import (
    monthly_output_path,
    read_aggregates_csv,
    write_csv,
    write_csv_per_source_month,
)
from chesstally.sources.pgn import read_games
from chesstally.streaming.ingest import run_ingest
from tests.conftest import write


def game(month, eco, result):
    return (f'[Event "R"]\n[UTCDate "{month.replace("-", ".")}.01"]\n[ECO "{eco}"]\n'
            f'[WhiteElo "1650"]\n[BlackElo "1420"]\n[Result "{result}"]\n\n1. e4 {result}\n')


def dump(tmp_dir, month, n, sub="dumps"):
    text = "".join(game(month, ["B45", "C00", "A56"][i % 3], ["1-0", "0-1", "1/2-1/2", "*"][i % 4])
                   for i in range(n))
    return write(os.path.join(tmp_dir, sub, f"games_rated_{month}.pgn"), text)


def _tuples(df):
    return sorted(tuple(r) for r in df.select(*KEY_COLUMNS, "games", "white_wins", "black_wins",
                                              "draws").collect())


def test_single_csv(spark, tmp_dir):
    dump(tmp_dir, "2013-07", 40)
    out = os.path.join(tmp_dir, "out", "agg.csv")
    agg = aggregate_files(spark, os.path.join(tmp_dir, "dumps"), csv_path=out)
    with open(out) as f:
        lines = f.read().splitlines()
    assert lines[0] == "month,eco_group,white_bucket,black_bucket,games,white_wins,black_wins,draws"
    games = [int(x.split(",")[4]) for x in lines[1:]]
    assert games == sorted(games, reverse=True) and sum(games) == 40
    assert _tuples(read_aggregates_csv(spark, out)) == _tuples(agg)
    write_csv(agg.limit(1), out)  # truncates
    with open(out) as f:
        assert len(f.read().splitlines()) == 2


@pytest.mark.parametrize("base, is_dir, expected", [
    ("out", True, "out/2013-07.csv"),
    ("out/agg.csv", False, "out/agg-2013-07.csv"),
    ("out/agg.tsv", False, "out/agg-2013-07.tsv"),
    ("out/agg", False, "out/agg-2013-07.csv"),
    ("agg.csv", False, "agg-2013-07.csv"),
    ("out/.hidden", False, "out/.hidden-2013-07.csv"),
    ("out/a.b.csv", False, "out/a.b-2013-07.csv"),
    ("..", False, ".."),
])
def test_monthly_output_path(base, is_dir, expected):
    assert monthly_output_path(base, "2013-07", is_dir) == expected


def test_csv_per_source_month(spark, tmp_dir):
    dump(tmp_dir, "2013-07", 10)
    dump(tmp_dir, "2013-08", 6)
    games = read_games(spark, os.path.join(tmp_dir, "dumps"))
    out_dir = os.path.join(tmp_dir, "monthly")
    os.makedirs(out_dir)
    written = write_csv_per_source_month(aggregate_games(games, by=["source_month"]), out_dir)
    assert sorted(os.path.basename(p) for p in written) == ["2013-07.csv", "2013-08.csv"]
    for p in written:
        with open(p) as f:
            rows = [line.split(",") for line in f.read().splitlines()[1:]]
        keyed = [(-int(r[4]), r[0], r[1], int(r[2]), int(r[3])) for r in rows]
        assert keyed == sorted(keyed)
    base = os.path.join(tmp_dir, "named", "agg.csv")
    written = write_csv_per_source_month(aggregate_games(games, by=["source_month"]), base)
    assert sorted(os.path.basename(p) for p in written) == ["agg-2013-07.csv", "agg-2013-08.csv"]


def test_store_is_idempotent_per_source(spark, tmp_dir):
    dump(tmp_dir, "2013-07", 12)
    path = os.path.join(tmp_dir, "store")
    games = read_games(spark, os.path.join(tmp_dir, "dumps"))
    store.ingest_games(games, path)
    once = _tuples(store.read_store(spark, path))
    store.ingest_games(games, path)
    assert _tuples(store.read_store(spark, path)) == once
    dump(tmp_dir, "2013-08", 5)
    store.ingest_games(read_games(spark, os.path.join(tmp_dir, "dumps")), path)
    assert store.read_store(spark, path).agg(F.sum("games")).collect()[0][0] == 17
    with pytest.raises(ValueError):
        store.ingest_games(games, path, bucket_size=100)


def test_landed_games_any_bucket(spark, tmp_dir):
    dump(tmp_dir, "2013-07", 12)
    games = read_games(spark, os.path.join(tmp_dir, "dumps"))
    path = os.path.join(tmp_dir, "landed")
    store.land_games(games, path)
    for size in (0, 100, 200):
        assert _tuples(store.aggregate_landed(spark, path, size)) == \
            _tuples(aggregate_games(games, size))


def test_landing_a_month_in_several_calls(spark, tmp_dir):
    a, b = dump(tmp_dir, "2013-07", 3, sub="one"), dump(tmp_dir, "2013-07", 2, sub="two")
    path = os.path.join(tmp_dir, "landed")
    for p in (a, b, a):  # landing a file again replaces its own games
        store.land_games(read_games(spark, p), path)
    assert store.aggregate_landed(spark, path).agg(F.sum("games")).first()[0] == 5
    nameless = [write(os.path.join(tmp_dir, "n", f"{i}.txt"), '[Event "x"]\n' * n) for i, n in enumerate((3, 2))]
    path = os.path.join(tmp_dir, "landed2")
    for p in nameless:
        store.land_games(read_games(spark, p), path)
    assert store.aggregate_landed(spark, path).agg(F.sum("games")).first()[0] == 5


def test_emptied_file_leaves_the_store(spark, tmp_dir):
    p, q = dump(tmp_dir, "2013-07", 3), dump(tmp_dir, "2013-08", 2)
    st = os.path.join(tmp_dir, "store")
    store.ingest_games(read_games(spark, [p, q]), st)
    write(p, "")
    store.ingest_games(read_games(spark, [p, q]), st)
    assert store.read_store(spark, st).agg(F.sum("games")).first()[0] == 2


def test_corrupt_and_empty_dumps(spark, tmp_dir):
    """One corrupt dump: its month is failed and planned again; the others are committed, the empty
    one with no games."""
    good = dump(tmp_dir, "2013-01", 4, sub="plain")
    with open(good, "rb") as f:
        data = zstandard.ZstdCompressor().compress(f.read())
    urls = ["file://" + write(os.path.join(tmp_dir, "z", f"games_rated_{m}.pgn.zst"), d) for m, d in (
        ("2013-01", data), ("2013-02", b"not zstd at all"), ("2013-03", b""))]
    index = write(os.path.join(tmp_dir, "list.txt"), "\n".join(urls))
    st, led = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "ledger")
    plan = plan_from_index(spark, index, ledger_path=led)
    assert ingest_plan(spark, plan, st, led) == {"2013-01": 4, "2013-03": 0}
    rows = {r.month: (r.status, r.games) for r in ledger.current_state(spark, led).collect()}
    assert rows == {"2013-01": ("success", 4), "2013-02": ("failed", 0), "2013-03": ("success", 0)}
    assert [r.month for r in plan_from_index(spark, index, ledger_path=led).collect()] == ["2013-02"]
    assert store.read_store(spark, st).agg(F.sum("games")).first()[0] == 4


def test_stream_counts_bare_last_games_and_reads_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    write(os.path.join(src, "a.pgn"), '[Event "a"]\n[Event ')
    write(os.path.join(src, "b.pgn"), '[Event "b"]\n')
    seen = []
    from chesstally.streaming.ingest import start_ingest
    q = start_ingest(spark, src, os.path.join(tmp_dir, "st"), os.path.join(tmp_dir, "ck"),
                     on_batch=lambda agg, i: seen.append(agg.agg(F.sum("games")).first()[0]))
    q.awaitTermination()
    assert sum(seen) == 3
    assert store.read_store(spark, os.path.join(tmp_dir, "st")).agg(F.sum("games")).first()[0] == 3


def test_jdbc_backend_and_sql():
    assert jdbc.detect_backend("POSTGRES://u@h/db") == "postgres"
    assert jdbc.detect_backend("postgresql://h/db") == "postgres"
    assert jdbc.detect_backend("sqlite:data/x.db") == "sqlite"
    assert jdbc.detect_backend("mysql://h/db") == "mysql"
    for bad in ("", None, "oracle://h"):
        with pytest.raises(ValueError):
            jdbc.detect_backend(bad)
    assert jdbc.jdbc_url("postgres://h:5432/db") == "jdbc:postgresql://h:5432/db"
    assert jdbc.jdbc_url("sqlite:data/x.db") == "jdbc:sqlite:data/x.db"
    opts = jdbc.jdbc_options("postgresql://al%40x:p%3Aw@db.example:5432/games?sslmode=require")
    assert opts["url"] == "jdbc:postgresql://db.example:5432/games?sslmode=require"
    assert (opts["user"], opts["password"]) == ("al@x", "p:w")
    assert opts["driver"] == "org.postgresql.Driver"
    assert jdbc.jdbc_options("mysql://u@h/db")["url"] == "jdbc:mysql://h/db"
    pg = jdbc.upsert_sql("postgres", "aggregates", "stage")
    assert "ON CONFLICT (month, eco_group, white_bucket, black_bucket)" in pg
    assert "games = aggregates.games + excluded.games" in pg
    assert "ON DUPLICATE KEY UPDATE" in jdbc.upsert_sql("mysql")
    assert "WHERE true ON CONFLICT" in jdbc.upsert_sql("sqlite")
    start = jdbc.ledger_start_sql("postgres")
    assert start.startswith("INSERT INTO ingestions (month, url, started_at, status)")
    assert "ON CONFLICT (month) DO UPDATE" in start and "games" not in start
    assert "ON DUPLICATE KEY UPDATE" in jdbc.ledger_start_sql("mysql")
    assert jdbc.ledger_finish_sql().endswith("WHERE month = ?")
    assert "PRIMARY KEY (month, eco_group, white_bucket, black_bucket)" in jdbc.AGGREGATES_DDL
    assert "month       VARCHAR(7)  PRIMARY KEY" in jdbc.INGESTIONS_DDL


def test_jdbc_registers_the_backend_class(spark):
    """Without the driver's jar the class is named, before any connection is tried."""
    from py4j.protocol import Py4JJavaError

    for url in ("sqlite:///x.db", "postgres://u:p@h/db", "mysql://u:p@h/db"):
        with pytest.raises(Py4JJavaError, match=jdbc.DRIVERS[jdbc.detect_backend(url)]):
            jdbc._connect(spark, url, {})


def test_ingest_plan_with_ledger(spark, tmp_dir):
    urls = []
    for m, n in (("2013-01", 4), ("2013-02", 6), ("2013-03", 3)):
        with open(dump(tmp_dir, m, n, sub="plain"), "rb") as f:
            data = zstandard.ZstdCompressor().compress(f.read())
        zst = write(os.path.join(tmp_dir, "zst", f"games_rated_{m}.pgn.zst"), data)
        urls.append("file://" + zst)
    index = write(os.path.join(tmp_dir, "list.txt"), "\n".join(reversed(urls)) + "\n")
    st, led = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "ledger")
    plan = plan_from_index(spark, index, since="2013-02", ledger_path=led)
    assert ingest_plan(spark, plan, st, led) == {"2013-02": 6, "2013-03": 3}
    state = {r.month: r.status for r in ledger.current_state(spark, led).collect()}
    assert state == {"2013-02": "success", "2013-03": "success"}
    again = plan_from_index(spark, index, ledger_path=led)
    assert [r.month for r in again.collect()] == ["2013-01"]
    ingest_plan(spark, again, st, led)
    assert store.read_store(spark, st).agg(F.sum("games")).collect()[0][0] == 13


def test_streaming_ingest_resumes_and_adds(spark, tmp_dir):
    src = os.path.join(tmp_dir, "incoming")
    dump(tmp_dir, "2013-07", 8, sub="incoming")
    st, ck = os.path.join(tmp_dir, "store"), os.path.join(tmp_dir, "ck")
    run_ingest(spark, src, st, ck)
    assert store.read_store(spark, st).agg(F.sum("games")).collect()[0][0] == 8
    run_ingest(spark, src, st, ck)  # nothing new: unchanged
    assert store.read_store(spark, st).agg(F.sum("games")).collect()[0][0] == 8
    dump(tmp_dir, "2013-08", 5, sub="incoming")
    run_ingest(spark, src, st, ck, rebalance=3)
    total = store.read_store(spark, st)
    assert total.agg(F.sum("games")).collect()[0][0] == 13
    batch = aggregate_games(read_games(spark, src))
    assert _tuples(total) == _tuples(batch)


def test_run_files_and_run_index(spark, tmp_dir):
    from chesstally.cli import parse_args
    from chesstally.jobs import run_files, run_index

    paths = [dump(tmp_dir, m, n, sub="plain") for m, n in (("2013-01", 4), ("2013-02", 6))]
    out = os.path.join(tmp_dir, "o", "agg.csv")
    st = os.path.join(tmp_dir, "store1")
    assert run_files(spark, paths + [os.path.join(tmp_dir, "nope.pgn")], out=out, store=st,
                     rebalance=2) == 10
    assert read_aggregates_csv(spark, out).agg(F.sum("games")).collect()[0][0] == 10
    assert store.read_store(spark, st).agg(F.sum("games")).collect()[0][0] == 10

    index = write(os.path.join(tmp_dir, "list.txt"),
                  "".join(f"file://{p}.zst\n" for p in paths + paths[1:]))  # one line twice
    for p in paths:
        with open(p, "rb") as f:
            write(p + ".zst", zstandard.ZstdCompressor().compress(f.read()))
    outdir = os.path.join(tmp_dir, "monthly")
    os.makedirs(outdir)
    led, st2 = os.path.join(tmp_dir, "ledger"), os.path.join(tmp_dir, "store2")
    got = run_index(spark, index, since="2013-02", out=outdir, store=st2, ledger_path=led)
    assert got == {"2013-02": 6}
    assert sorted(os.listdir(outdir)) == ["2013-02.csv"]
    assert run_index(spark, index, since="2013-02", ledger_path=led) == {}  # already ingested
    assert run_index(spark, index, ledger_path=led) == {"2013-01": 4}

    a = parse_args(["--index", "l.txt", "--since", "2013-01", "-o", "out/"])
    assert (a.index, a.since, a.out, a.bucket_size) == ("l.txt", "2013-01", "out/", 200)
    assert a.exact_tail and not parse_args(["f.pgn", "--no-exact-tail"]).exact_tail
    truncated = write(os.path.join(tmp_dir, "trunc.pgn"), '[Event "a"]\n[Result "1-0"]\n[Event ')
    assert run_files(spark, [truncated]) == 2
    assert run_files(spark, [truncated], exact_tail=False) == 1
    with pytest.raises(SystemExit):
        parse_args([])
    cfg = write(os.path.join(tmp_dir, "config.toml"),
                'bucket_size = 100\nlist_url = "idx.txt"\nbatch_size = 1000\n'
                'db_batch_rows = 250\n')
    a = parse_args(["--config", cfg])
    assert (a.bucket_size, a.index, a.db_batch_rows) == (100, "idx.txt", 250)
    assert parse_args(["--config", cfg, "--bucket-size", "400", "f.pgn"]).bucket_size == 400
    os.environ.pop("DATABASE_URL", None)
    with pytest.raises(SystemExit):
        parse_args(["--save", "f.pgn"])
    os.environ["DATABASE_URL"] = "sqlite:data/x.db"
    try:
        assert parse_args(["--save", "f.pgn"]).jdbc_url == "sqlite:data/x.db"
    finally:
        del os.environ["DATABASE_URL"]
    bad = write(os.path.join(tmp_dir, "bad.toml"), "bucket_sise = 3\n")
    with pytest.raises(ValueError):
        parse_args(["--config", bad, "f.pgn"])


def test_land_games_caps_file_size(spark, tmp_dir):
    dump(tmp_dir, "2013-07", 50)
    games = read_games(spark, os.path.join(tmp_dir, "dumps")).coalesce(1)
    path = os.path.join(tmp_dir, "landed_small")
    store.land_games(games, path, rows_per_file=7)
    files = [f for _, _, names in os.walk(os.path.join(path, "source_month=2013-07")) for f in names
             if f.endswith(".parquet")]
    assert len(files) == 8  # ceil(50 / 7) files from one task
    assert _tuples(store.aggregate_landed(spark, path)) == _tuples(aggregate_games(games))


def test_scratch_root_without_checkpoint_dir(tmp_dir):
    """In a fresh local session with no checkpoint dir configured, a temp root is created once
    and reused (run in a subprocess without spark-defaults)."""
    import subprocess
    import sys

    code = ("import sys; sys.path.insert(0, %r)\n"
            "from pyspark.sql import SparkSession\n"
            "from chesstally.session import scratch_root\n"
            "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled','false')"
            ".getOrCreate()\n"
            "a = scratch_root(s); b = scratch_root(s)\n"
            "print('ROOT', a == b, a.startswith('/') or a.startswith('file:'))\n"
            % os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = dict(os.environ, SPARK_CONF_DIR=tmp_dir)
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True,
                         timeout=180)
    assert "ROOT True True" in out.stdout, out.stderr[-2000:]


def test_source_id_is_a_string_partition(spark, tmp_dir):
    dump(tmp_dir, "2013-07", 3)
    path = os.path.join(tmp_dir, "store_ids")
    store.ingest_games(read_games(spark, os.path.join(tmp_dir, "dumps")), path)
    df = store.read_store_by_source(spark, path)
    assert dict(df.dtypes)["source_id"] == "string"
    assert all(r.source_id.startswith("s") and len(r.source_id) == 17
               for r in df.select("source_id").distinct().collect())


def test_store_write_survives_failed_task_attempts(tmp_dir):
    """A task that fails on its first attempt (as on a lost executor) is retried; the store's
    contents equal a run without failures (Spark's commit protocol, local[4,3] allows retries)."""
    import subprocess
    import sys

    for m, n in (("2013-07", 40), ("2013-08", 25)):
        dump(tmp_dir, m, n)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F, types as T
from pyspark import TaskContext
from chesstally.sinks import store
from chesstally.sources.pgn import read_games
spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())

@F.udf(T.StringType())
def flaky(game):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
        raise RuntimeError("simulated executor loss")
    return game

games = read_games(spark, {tmp_dir + '/dumps'!r})
store.ingest_games(games.withColumn("game", flaky("game")), {tmp_dir + '/faulty'!r})
store.ingest_games(games, {tmp_dir + '/clean'!r})
a = sorted(map(tuple, store.read_store(spark, {tmp_dir + '/faulty'!r}).collect()))
b = sorted(map(tuple, store.read_store(spark, {tmp_dir + '/clean'!r}).collect()))
print("EQUAL", a == b, sum(r[4] for r in a))
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "EQUAL True 65" in out.stdout, out.stderr[-3000:]
    assert "simulated executor loss" in out.stderr  # the first attempt really failed


def test_stream_replay_after_failure_does_not_double_count(spark, tmp_dir):
    from chesstally.streaming.ingest import start_ingest

    src = os.path.join(tmp_dir, "in")
    dump(tmp_dir, "2013-07", 9, sub="in")
    dump(tmp_dir, "2013-08", 4, sub="in")
    st, ck = os.path.join(tmp_dir, "st"), os.path.join(tmp_dir, "ck")

    def fail_after_write(agg, batch_id):
        raise RuntimeError("driver lost after the store write, before the batch commit")

    q = start_ingest(spark, src, st, ck, on_batch=fail_after_write)
    with pytest.raises(Exception):
        q.awaitTermination()
    assert store.read_store(spark, st).agg(F.sum("games")).collect()[0][0] == 13  # written
    run_ingest(spark, src, st, ck)  # restart: the uncommitted batch is replayed
    assert store.read_store(spark, st).agg(F.sum("games")).collect()[0][0] == 13  # not 26
    assert _tuples(store.read_store(spark, st)) == _tuples(aggregate_games(read_games(spark, src)))


def test_empty_input_writes_header_only_csv(spark, tmp_dir):
    from chesstally.jobs import run_files

    empty = write(os.path.join(tmp_dir, "empty.pgn"), "")
    out = os.path.join(tmp_dir, "o", "agg.csv")
    assert run_files(spark, [empty], out=out) == 0
    with open(out) as f:
        assert f.read() == ("month,eco_group,white_bucket,black_bucket,games,white_wins,"
                            "black_wins,draws\n")


def test_register_tables_for_sql(spark, tmp_dir):
    from chesstally.sources.tables import register_tables

    dump(tmp_dir, "2013-07", 6)
    st, led = os.path.join(tmp_dir, "st_sql"), os.path.join(tmp_dir, "led_sql")
    store.ingest_games(read_games(spark, os.path.join(tmp_dir, "dumps")), st)
    ledger.append_events(ledger.start_events(spark, [("2013-07", "u")]), led)
    assert register_tables(spark, store=st, ledger=led) == ["aggregates", "ingestions"]
    assert spark.sql("SELECT sum(games) AS g FROM aggregates").collect()[0].g == 6
    assert dict(spark.table("aggregates").dtypes)["games"] == "bigint"
    row = spark.sql("SELECT month, status, games FROM ingestions").collect()[0]
    assert (row.month, row.status, row.games) == ("2013-07", "started", 0)


def test_cli_module_entry_point(tmp_dir):
    import subprocess
    import sys

    path = dump(tmp_dir, "2013-07", 7)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tmp_dir, "cli", "agg.csv")
    env = dict(os.environ, PYTHONPATH=root)
    res = subprocess.run([sys.executable, "-m", "chesstally", path, "--out", out,
                          "--bucket-size", "100"], capture_output=True, text=True, env=env,
                         cwd=tmp_dir, timeout=300)
    assert res.returncode == 0, res.stderr[-2000:]
    assert res.stdout.strip().splitlines()[-1] == "7"
    with open(out) as f:
        rows = f.read().splitlines()
    assert rows[0].startswith("month,eco_group") and sum(int(r.split(",")[4]) for r in rows[1:]) == 7
    assert {r.split(",")[2] for r in rows[1:]} == {"1600"}  # 1650 with 100-point buckets


def test_cli_prints_one_count_per_file(tmp_dir):
    import subprocess
    import sys

    a = dump(tmp_dir, "2013-07", 3)
    b = dump(tmp_dir, "2013-08", 5)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, PYTHONPATH=root)
    res = subprocess.run([sys.executable, "-m", "chesstally", a, b, os.path.join(tmp_dir, "no.pgn")],
                         capture_output=True, text=True, env=env, cwd=tmp_dir, timeout=300)
    assert res.returncode == 0, res.stderr[-2000:]
    lines = res.stdout.strip().splitlines()
    assert lines[-2:] == ["3", "5"] and "no.pgn" in res.stdout


def test_write_csv_dir_sorted(spark, tmp_dir):
    from chesstally.sinks.csv import write_csv_dir

    dump(tmp_dir, "2013-07", 30)
    agg = aggregate_games(read_games(spark, os.path.join(tmp_dir, "dumps")))
    out = os.path.join(tmp_dir, "csvdir")
    write_csv_dir(agg, out)
    back = read_aggregates_csv(spark, out)
    assert _tuples(back) == _tuples(agg)


def test_rename_if_absent(spark, tmp_dir):
    from chesstally import fs

    for name in ("a", "b"):
        write(os.path.join(tmp_dir, "ren", name, "f.txt"), name)
    target = os.path.join(tmp_dir, "ren", "target")
    assert fs.rename_if_absent(spark, os.path.join(tmp_dir, "ren", "a"), target)
    assert not fs.rename_if_absent(spark, os.path.join(tmp_dir, "ren", "b"), target)
    assert sorted(os.listdir(target)) == ["f.txt"] or "b" not in os.listdir(target)
    with open(os.path.join(target, "f.txt")) as f:
        assert f.read() == "a"
