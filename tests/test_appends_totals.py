"""Append-only deltas, running totals with state per file, byte-bounded micro-batches, failing months."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from chesstally import aggregate_games
from chesstally.jobs import ingest_plan, run_index
from chesstally.operators.aggregate import KEY_COLUMNS, MEASURE_COLUMNS, merge_aggregates
from chesstally.sinks import appends, ledger, store
from chesstally.sources.pgn import read_games
from chesstally.streaming.ingest import BatchTimes, run_ingest
from chesstally.streaming.totals import PROVIDER, ROCKSDB, running_changes, start_running_totals
from tests.conftest import write
from tests.test_sinks_streaming import _tuples, dump, game


def small(spark, n=1):
    rows = [("2013-07", "B20-B99", 1600, 1400, 3 * n, n, n, 0), ("unknown", "U00", 0, 0, n, 0, 0, n)]
    return spark.createDataFrame(rows, ", ".join(
        f"{c} {t}" for c, t in zip([*KEY_COLUMNS, *MEASURE_COLUMNS], ["string", "string", "int", "int"] + ["bigint"] * 4)))


def test_deltas_add_up_and_replays_do_not(spark, tmp_dir):
    table = os.path.join(tmp_dir, "deltas")
    assert appends.read_totals(spark, table).count() == 0
    appends.add_delta(small(spark), table, run="a")
    appends.add_delta(small(spark), table, run="a")
    assert _tuples(appends.read_totals(spark, table)) == _tuples(small(spark))
    appends.add_delta(small(spark, 2), table)
    assert _tuples(appends.read_totals(spark, table)) == _tuples(small(spark, 3))
    with pytest.raises(ValueError, match="bucket_size"):
        appends.add_delta(small(spark), table, bucket_size=100)
    with pytest.raises(ValueError, match="run id"):
        appends.add_delta(small(spark), table, run="../x")
    appends.add_delta(small(spark).where("1 = 0"), table, run="a")  # the run has no rows any more
    assert _tuples(appends.read_totals(spark, table)) == _tuples(small(spark, 2))
    minus = small(spark, 2).select(*KEY_COLUMNS, *(-F.col(m) for m in MEASURE_COLUMNS)).toDF(*small(spark).columns)
    appends.add_delta(minus, table)
    assert appends.read_totals(spark, table).count() == 0


def test_compaction_survives_a_crash_before_it_deletes(spark, tmp_dir, monkeypatch):
    table = os.path.join(tmp_dir, "deltas")
    for n in (1, 2, 3):
        appends.add_delta(small(spark, n), table, run=f"r{n}")
    want = _tuples(small(spark, 6))

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(appends.fs, "delete", crash)
        with pytest.raises(OSError):
            appends.compact_totals(spark, table)
    assert len(appends.runs(spark, table)) == 4  # both the old runs and what holds them
    assert _tuples(appends.read_totals(spark, table)) == want
    appends.add_delta(small(spark, 4), table, run="r4")
    appends.compact_totals(spark, table)  # again, over the leftovers
    assert len(appends.runs(spark, table)) == 1
    assert _tuples(appends.read_totals(spark, table)) == _tuples(small(spark, 10))
    parts = appends.read(spark, table, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in small(spark).schema))
    assert parts.count() == 2  # summed


def test_appends_at_the_same_time(spark, tmp_dir):
    table = os.path.join(tmp_dir, "deltas")
    failed, start = [], threading.Barrier(8)

    def add(n):
        try:
            start.wait()  # all find a table without its record
            appends.add_delta(small(spark, n), table, run=f"r{n}")
        except Exception as exc:
            failed.append(exc)

    threads = [threading.Thread(target=add, args=(n,)) for n in range(1, 9)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed and _tuples(appends.read_totals(spark, table)) == _tuples(small(spark, 36))
    assert not [f for f in os.listdir(table) if f.startswith("._chesstally") and not f.endswith(".crc")]


def test_running_totals_equal_the_batch_count(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "rt"), os.path.join(tmp_dir, "totals")
    dump(tmp_dir, "2013-07", 9, sub="rt")
    dump(tmp_dir, "2013-08", 4, sub="rt")
    write(os.path.join(src, "name with blank %41_2013-09.pgn"), game("2013-09", "B45", "1-0") + "\n[Event ")
    write(os.path.join(src, "empty_2013-10.pgn"), "")
    before = spark.conf.get(PROVIDER, None)
    listener = BatchTimes()
    spark.streams.addListener(listener)
    try:
        for _ in range(2):
            start_running_totals(spark, src, os.path.join(tmp_dir, "ck"), appends.totals_sink(out),
                                 max_files_per_trigger=1).awaitTermination()
            assert spark.conf.get(PROVIDER, None) == before
            assert _tuples(appends.read_totals(spark, out)) == _tuples(aggregate_games(read_games(spark, src)))
            dump(tmp_dir, "2013-11", 5, sub="rt")  # for the second run
        deadline = time.time() + 20
        while sum(rows for _, _, rows, _ in listener.batches) < 19 and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert sum(rows for _, _, rows, _ in listener.batches) == 9 + 4 + 1 + 5
    spark.range(0)
    start_running_totals(spark, src, os.path.join(tmp_dir, "ck2"), appends.totals_sink(out + "2"),
                         exact_tail=False).awaitTermination()
    lost = {r.month: r.games for r in appends.read_totals(spark, out + "2").groupBy("month").agg(
        F.sum("games").alias("games")).collect()}
    assert "unknown" not in lost


def test_a_file_delivered_again_replaces_its_contribution(spark, tmp_dir):
    """The second delivery has other games; a third, equal one changes nothing."""
    path = write(os.path.join(tmp_dir, "f.pgn"), "x\n")
    rows = os.path.join(tmp_dir, "rows")
    changes: list[list] = []

    def deliver(games: list[tuple[str, str, str]], n: int) -> None:
        df = spark.createDataFrame([(game(*g), f"file:{path}") for g in games], "game string, source_file string")
        df.coalesce(1).write.mode("append").json(rows)
        spark.conf.set(PROVIDER, ROCKSDB)
        try:
            stream = spark.readStream.schema("game string, source_file string").json(rows)
            q = (running_changes(stream).writeStream.outputMode("update")
                 .foreachBatch(lambda b, i: changes.append([tuple(r) for r in merge_aggregates(b).collect()]))
                 .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
            q.awaitTermination()
        finally:
            spark.conf.unset(PROVIDER)

    deliver([("2013-07", "B45", "1-0"), ("2013-07", "B45", "0-1"), ("2013-08", "C00", "1-0")], 1)
    deliver([("2013-07", "B45", "1-0"), ("2013-09", "C00", "1/2-1/2")], 2)
    deliver([("2013-07", "B45", "1-0"), ("2013-09", "C00", "1/2-1/2")], 3)
    first, second, third = ({r[0]: r[4:] for r in c if any(r[4:])} for c in changes)
    assert first == {"2013-07": (2, 1, 1, 0), "2013-08": (1, 1, 0, 0)}
    assert second == {"2013-07": (-1, 0, -1, 0), "2013-08": (-1, -1, 0, 0), "2013-09": (1, 0, 0, 1)}
    assert third == {}


def test_batches_bounded_by_bytes(spark, tmp_dir):
    sizes = []
    for i, n in enumerate((3, 3, 3, 60, 3, 3)):
        sizes.append(os.path.getsize(dump(tmp_dir, f"2013-{i + 1:02d}", n)))
    bound = 3 * sizes[0]
    got = run_ingest(spark, os.path.join(tmp_dir, "dumps"), os.path.join(tmp_dir, "st"), os.path.join(tmp_dir, "ck"),
                     max_bytes_per_trigger=bound)
    assert sum(b.files for b in got) == 6 and sum(b.bytes for b in got) == sum(sizes)
    assert all(b.bytes <= bound or b.files == 1 for b in got) and len(got) >= 3
    assert _tuples(store.read_store(spark, os.path.join(tmp_dir, "st"))) == _tuples(
        aggregate_games(read_games(spark, os.path.join(tmp_dir, "dumps"))))
    with pytest.raises(ValueError, match="files or by bytes"):
        run_ingest(spark, tmp_dir, tmp_dir + "/s", tmp_dir + "/c", max_files_per_trigger=1, max_bytes_per_trigger=5)


def test_failed_months_reach_the_caller(spark, tmp_dir, capsys):
    good = dump(tmp_dir, "2013-01", 4)
    bad = write(os.path.join(tmp_dir, "dumps", "games_rated_2013-02.pgn.gz"), b"\x1f\x8b not gzip at all")
    index = write(os.path.join(tmp_dir, "index.txt"), f"{good}\n")
    plan = spark.createDataFrame([("2013-01", good), ("2013-02", bad), ("2013-03", tmp_dir + "/absent.pgn")],
                                 "month string, url string")
    led = os.path.join(tmp_dir, "led")
    got = ingest_plan(spark, plan, os.path.join(tmp_dir, "st"), led)
    assert got == {"2013-01": 4} and sorted(got.failed) == ["2013-02", "2013-03"]
    state = {r.month: r for r in ledger.current_state(spark, led).collect()}
    assert {m: r.status for m, r in state.items()} == {"2013-01": "success", "2013-02": "failed", "2013-03": "failed"}
    assert all(r.duration_ms > 0 for r in state.values())
    assert run_index(spark, index, ledger_path=led) == {}


def test_a_ledger_that_cannot_be_written_fails_its_month_only(spark, tmp_dir, monkeypatch):
    good = dump(tmp_dir, "2013-01", 4)
    plan = spark.createDataFrame([("2013-01", good), ("2013-02", good)], "month string, url string")
    real, closed = ledger.append_rows, []

    def rows(spark, events, path, run=None):
        if events[0][0] == "2013-02" and events[0][2] == "start":
            raise OSError("no space")
        real(spark, events, path, run)

    monkeypatch.setattr(ledger, "append_rows", rows)
    monkeypatch.setattr(ledger, "compact", lambda *a: closed.append(a))
    got = ingest_plan(spark, plan, os.path.join(tmp_dir, "st"), os.path.join(tmp_dir, "led"))
    assert got == {"2013-01": 4} and got.failed == {"2013-02": "no space"} and len(closed) == 1


def test_cli_exit_code_and_dry_run(tmp_dir):
    import subprocess
    import sys

    good = dump(tmp_dir, "2013-01", 3)
    bad = write(os.path.join(tmp_dir, "dumps", "games_rated_2013-02.pgn.zst"), b"not zstd")
    index = write(os.path.join(tmp_dir, "index.txt"), f"file:{good}.zst\nfile:{bad}\n")
    os.rename(good, good + ".zst")
    import zstandard
    with open(good + ".zst", "rb") as f:
        data = f.read()
    write(good + ".zst", zstandard.ZstdCompressor().compress(data))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    work = os.path.join(tmp_dir, "work")
    os.makedirs(work)
    env = dict(os.environ, PYTHONPATH=root, TMPDIR=tmp_dir)

    def run(*args):
        return subprocess.run([sys.executable, "-m", "chesstally", *args], capture_output=True, text=True, env=env,
                              cwd=work, timeout=300)

    there = sorted(os.listdir(os.path.join(tmp_dir, "dumps")))
    res = run("--index", index, "--zst-frames")
    assert res.returncode == 1 and "2013-01 | games=3" in res.stdout and "Failed: 2013-02" in res.stderr
    res = run(good + ".zst")  # a dry run
    assert res.returncode == 0 and res.stdout.strip().endswith("3"), res.stderr[-2000:]
    assert os.listdir(work) == [] and sorted(os.listdir(os.path.join(tmp_dir, "dumps"))) == there


def test_small_months_are_not_held_up(spark, tmp_dir, monkeypatch):
    """One slow and one corrupt month beside small ones: each month's jobs run in a pool and under a tag of
    their own, and small months end before the slow one."""
    from chesstally import jobs

    urls = {f"2013-{m:02d}": dump(tmp_dir, f"2013-{m:02d}", 3) for m in range(1, 7)}
    write(urls["2013-02"] + ".gz", b"\x1f\x8bnot gzip")
    plan = spark.createDataFrame([(m, u + ".gz" * (m == "2013-02")) for m, u in urls.items()], "month string, url string")
    ended, pools, cancelled = [], {}, []
    real = jobs._by_source_table

    def slow(spark, games, bucket_size):
        sc = spark.sparkContext
        pool = sc.getLocalProperty("spark.scheduler.pool")
        pools[pool] = set(sc.getJobTags())
        if pool == "ingest-2013-01":
            spark.range(8).repartition(8).mapInPandas(lambda it: (time.sleep(3) or f for f in it), "id long").count()
        out = real(spark, games, bucket_size)
        ended.append(pool)
        return out

    monkeypatch.setattr(jobs, "_by_source_table", slow)
    cancel = spark.sparkContext.cancelJobsWithTag
    monkeypatch.setattr(spark.sparkContext, "cancelJobsWithTag", lambda t: (cancelled.append(t), cancel(t)))
    got = ingest_plan(spark, plan, os.path.join(tmp_dir, "st"), months_at_once=6)
    assert sorted(got) == ["2013-01", "2013-03", "2013-04", "2013-05", "2013-06"] and list(got.failed) == ["2013-02"]
    assert ended[-1] == "ingest-2013-01" and len(pools) == 6
    assert all(len(t) == 1 and next(iter(t)).startswith(p + "-") for p, t in pools.items())
    assert [t.rsplit("-", 1)[0] for t in cancelled] == ["ingest-2013-02"]
