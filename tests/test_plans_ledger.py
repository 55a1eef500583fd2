"""Ingest plans (index parsing, bounds, anti join) and ledger state from event sequences."""

import pytest

from chesstally.plans.ingest import build_plan, filter_months, parse_index
from chesstally.sinks import ledger


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_parse_index(spark):
    lines = [
        "https://h/x_2013-07.pgn.zst", "  https://h/x_2013-01.pgn.zst \t", "",
        "https://h/x_2013-02.pgn.bz2", "https://h/x_2013-03.pgn.zst.torrent",
        "https://h/x_2013-99.pgn.zst", "https://h/x_2013-07.pgn.zst", "   ",
        "https://h/x_٢٠١٣-٠٥.pgn.zst",
    ]
    got = [tuple(r) for r in build_plan(_lines(spark, lines)).collect()]
    assert got == [
        ("2013-01", "https://h/x_2013-01.pgn.zst"),
        ("2013-07", "https://h/x_2013-07.pgn.zst"),
        ("2013-07", "https://h/x_2013-07.pgn.zst"),
        ("2013-99", "https://h/x_2013-99.pgn.zst"),
        ("٢٠١٣-٠٥", "https://h/x_٢٠١٣-٠٥.pgn.zst"),
    ]


def test_plan_order_is_stable_within_a_month(spark):
    lines = ["h/b_2013-02.pgn.zst", "h/z_2013-01.pgn.zst", "h/a_2013-01.pgn.zst",
             "h/m_2013-01.pgn.zst"]
    df = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    got = [r.url for r in build_plan(df).collect()]
    assert got == ["h/z_2013-01.pgn.zst", "h/a_2013-01.pgn.zst", "h/m_2013-01.pgn.zst",
                   "h/b_2013-02.pgn.zst"]


def test_bounds_and_invalid_bound(spark):
    plan = parse_index(_lines(spark, [f"h/x_2013-{m:02d}.pgn.zst" for m in range(1, 13)]))
    got = [r.month for r in filter_months(plan, "2013-3", "2013/05").orderBy("month").collect()]
    assert got == ["2013-03", "2013-04", "2013-05"]
    with pytest.raises(ValueError):
        filter_months(plan, since="2013-13")


def test_exclude_done(spark):
    lines = _lines(spark, [f"h/x_2013-{m:02d}.pgn.zst" for m in range(1, 5)])
    done = spark.createDataFrame([("2013-02",), ("2013-03",), ("2013-03",)], "month string")
    assert [r.month for r in build_plan(lines, done_months=done).collect()] == ["2013-01", "2013-04"]


def _state(spark, events):
    rows = [(m, seq, kind, url, at, games, dur, status)
            for seq, (m, kind, url, at, games, dur, status) in enumerate(events, start=1)]
    df = spark.createDataFrame(rows, ledger.EVENT_SCHEMA)
    return {r.month: r.asDict() for r in ledger.ledger_state(df).collect()}


def test_ledger_start_finish_start(spark):
    s = _state(spark, [
        ("2013-07", "start", "u1", "t1", None, None, "started"),
        ("2013-07", "finish", None, "t2", 10, 5, "success"),
        ("2013-07", "start", "u2", "t3", None, None, "started"),
    ])["2013-07"]
    assert (s["status"], s["url"], s["started_at"]) == ("started", "u2", "t3")
    assert (s["games"], s["duration_ms"], s["finished_at"]) == (10, 5, "t2")


def test_ledger_finish_without_row_is_ignored(spark):
    s = _state(spark, [
        ("2013-08", "finish", None, "t0", 99, 9, "success"),
        ("2013-07", "finish", None, "t1", 99, 9, "success"),
        ("2013-07", "start", "u", "t2", None, None, "started"),
    ])
    assert "2013-08" not in s
    assert (s["2013-07"]["status"], s["2013-07"]["games"], s["2013-07"]["finished_at"]) == \
        ("started", 0, None)


def test_ledger_success_months(spark):
    events = [
        ("2013-01", "start", "u", "t", None, None, "started"),
        ("2013-01", "finish", None, "t", 3, 1, "success"),
        ("2013-02", "start", "u", "t", None, None, "started"),
        ("2013-02", "finish", None, "t", 3, 1, "failed"),
        ("2013-03", "start", "u", "t", None, None, "started"),
    ]
    rows = [(m, i, k, u, a, g, d, st) for i, (m, k, u, a, g, d, st) in enumerate(events)]
    state = ledger.ledger_state(spark.createDataFrame(rows, ledger.EVENT_SCHEMA))
    assert [r.month for r in ledger.ingested_months(state).collect()] == ["2013-01"]


def test_ledger_append_and_read(spark, tmp_dir):
    path = tmp_dir + "/ledger"
    ledger.append_events(ledger.start_events(spark, [("2013-01", "u1"), ("2013-02", "u2")]), path)
    per_month = spark.createDataFrame([("2013-01", 7)], "month string, games bigint")
    ledger.append_events(ledger.finish_events_from(per_month, 123, "success"), path)
    state = {r.month: r for r in ledger.current_state(spark, path).collect()}
    assert state["2013-01"].status == "success" and state["2013-01"].games == 7
    assert state["2013-02"].status == "started" and state["2013-02"].games == 0


def test_ledger_rerun_right_after_finish(spark, tmp_dir):
    """A restart immediately after a run must order its start after the previous finish."""
    path = tmp_dir + "/ledger_rerun"
    months = [(f"2013-{m:02d}", f"u{m}") for m in range(1, 13)]
    ledger.append_events(ledger.start_events(spark, months), path)
    done = spark.createDataFrame([(m, 5) for m, _ in months], "month string, games bigint")
    ledger.append_events(ledger.finish_events_from(done.repartition(6), 10), path)
    ledger.append_events(ledger.start_events(spark, months[:3]), path)  # immediate re-run
    state = {r.month: r.status for r in ledger.current_state(spark, path).collect()}
    assert [state[m] for m, _ in months[:3]] == ["started"] * 3
    assert all(state[m] == "success" for m, _ in months[3:])


def test_an_append_does_not_rewrite_the_ledger(spark, tmp_dir):
    import os

    path = tmp_dir + "/ledger_appends"

    def written() -> dict[str, float]:
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
                for d, _, files in os.walk(path) for f in files if f.endswith(".parquet")}

    new = []
    for run in range(12):
        before = written()
        ledger.append_events(ledger.start_events(spark, [(f"2013-{run + 1:02d}", "u")] * (run + 1)), path)
        after = written()
        assert {f: after[f] for f in before} == before  # nothing there was touched
        new.append(sum(os.path.getsize(f) for f in after if f not in before))
        assert len(after) == len(before) + 1
    assert max(new) < 1.2 * min(new)
    assert ledger.read_events(spark, path).count() == sum(range(13))
    state = sorted(ledger.current_state(spark, path).collect())
    ledger.compact(spark, path, least=20)
    assert len(written()) == 12
    ledger.compact(spark, path, least=2)
    assert len([d for d in os.listdir(path) if d.startswith("run=")]) == 1
    assert sorted(ledger.current_state(spark, path).collect()) == state
    ledger.append_rows(spark, [ledger.finish_row("2013-01", 5, 7)], path, run="once")
    ledger.append_rows(spark, [ledger.finish_row("2013-01", 6, 7)], path, run="once")  # replaces itself
    assert ledger.read_events(spark, path).where("kind = 'finish'").count() == 1
    assert {r.month: r.games for r in ledger.current_state(spark, path).collect()}["2013-01"] == 6
