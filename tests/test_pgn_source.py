"""The positioned source: ranges of plain files, frames of zstd files."""

import json
import os
import random

import pytest
import zstandard
from pyspark.errors import PySparkException

from chesstally import aggregate_games
from chesstally.functions.headers import with_tags
from chesstally.sources import pgn_source as src
from chesstally.sources.pgn import read_games, read_games_positioned, several_frames, zst_files
from tests.conftest import write

PIECES = [b"[Event ", b"\n[Event ", b"\n", b"\n[Ev", b"ent ", b'"A"]\r\n[ECO "B45"]', b"\xff\xfe", b"\n[Event y"]


def expected(data: bytes) -> list[str]:
    return [r.decode("utf-8", "replace") for r in data.split(src.SEPARATOR)] if data else []


def zst(data: bytes, rng: random.Random, most: int = 40) -> bytes:
    out, at = b"", 0
    while at < len(data):
        n = rng.randint(1, most)
        c = zstandard.ZstdCompressor(3, write_checksum=rng.random() < .5, write_content_size=rng.random() < .5)
        if rng.random() < .3:
            out += b"\x5f\x2a\x4d\x18\x03\0\0\0abc"  # a skippable frame
        out += c.compress(data[at:at + n]) if rng.random() < .5 else (lambda o: o.compress(data[at:at + n]) + o.flush())(c.compressobj())
        at += n
    return out


def read_all(path: str, split: int) -> list[tuple[str, bool]]:
    reader = src.PgnReader({"files": json.dumps([[path, os.path.getsize(path)]]), "splitbytes": str(split)})
    return [(v, f) for p in reader.partitions() for b in reader.read(p)
            for v, f in zip(b.column("value").to_pylist(), b.column("first").to_pylist())]


@pytest.mark.parametrize("look, chunk", [(1, 1), (3, 5), (8, 9), (1 << 16, 4 << 20)])
def test_every_record_once_for_any_ranges(tmp_dir, monkeypatch, look, chunk):
    monkeypatch.setattr(src, "_LOOK", look)
    monkeypatch.setattr(src, "_CHUNK", chunk)
    rng = random.Random(chunk)
    for _ in range(120):
        data = b"".join(rng.choice([*PIECES, b"abc" * rng.randint(0, 30)]) for _ in range(rng.randint(0, 12)))
        want = expected(data)
        for path, raw in ((f"{tmp_dir}/a.pgn", data), (f"{tmp_dir}/a.pgn.zst", zst(data, rng))):
            write(path, raw)
            got = read_all(path, rng.choice([1, 2, 7, 20, 64, 1000]))
            assert [v for v, _ in got] == want, data
            assert [f for _, f in got] == [True, *[False] * (len(want) - 1)][:len(want)]


def test_frames_from_headers(tmp_dir):
    rng = random.Random(3)
    for big in (b"", b"x" * 300_000, bytes(rng.randrange(256) for _ in range(300_000))):  # RLE and raw blocks
        data = zst(b"abc" * 50, rng) + zstandard.ZstdCompressor(1).compress(big) + zst(b"tail" * 20, rng)
        path = write(f"{tmp_dir}/f.zst", data)
        with src.open_file(path) as f:
            found = src.frames(f, len(data))
            assert found[0][0] == 0 and found[-1][1] == len(data)
            assert all(a[1] == b[0] for a, b in zip(found, found[1:]))
            assert all(src.is_magic(data[a:a + 4]) for a, _ in found)
            for a, _ in found:
                if data[a:a + 4] == src.FRAME_MAGIC:
                    assert src.first_frame(f, a, a + 1, len(data)) == a
    # bytes that look like a frame but are none
    noise = b"ab" + src.FRAME_MAGIC + b"\x00\x00garbage" * 10
    data = zstandard.ZstdCompressor(1).compress(os.urandom(1000) + noise) + zstandard.ZstdCompressor(1).compress(b"z")
    path = write(f"{tmp_dir}/n.zst", data)
    at = data.index(src.FRAME_MAGIC, 1)
    with src.open_file(path) as f:
        assert src.first_frame(f, 1, len(data), len(data)) == data.rindex(src.FRAME_MAGIC) != at


def games_of(n: int) -> bytes:
    return b"".join(b'[Event "e"]\n[ECO "B%02d"]\n[Result "1-0"]\n[UTCDate "2013.%02d.01"]\n\n1. e4 e5 %s\n\n'
                    % (i % 100, i % 12 + 1, b"x" * (i % 50)) for i in range(n))


def test_frame_scan_equals_codec_scan_and_adds_the_bare_game(spark, tmp_dir):
    rng = random.Random(5)
    write(f"{tmp_dir}/d/a_2013-01.pgn.zst", zst(games_of(900), rng, 4000))
    write(f"{tmp_dir}/d/b_2013-02.pgn.zst", zstandard.ZstdCompressor(3).compress(games_of(300)))
    write(f"{tmp_dir}/d/c_2013-03.pgn.zst", zst(games_of(200) + b"\n[Event ", rng, 3000))
    write(f"{tmp_dir}/d/d_2013-04.pgn", games_of(100) + b"\n[Event ")
    codec = read_games(spark, f"{tmp_dir}/d")
    framed = read_games(spark, f"{tmp_dir}/d", zst_frames=True, split_bytes=2000)
    count = {r.source_month: r["count"] for r in framed.groupBy("source_month").count().collect()}
    assert count == {"2013-01": 900, "2013-02": 300, "2013-03": 201, "2013-04": 101}
    assert framed.rdd.getNumPartitions() > 8
    full = sorted(aggregate_games(framed).collect())
    keep = sorted(aggregate_games(codec).collect())
    unknown = [r for r in full if r.month == "unknown"]
    assert [r for r in full if r.month != "unknown"] == [r for r in keep if r.month != "unknown"]
    assert [r.games for r in unknown] == [2] and [r.games for r in keep if r.month == "unknown"] == [1]
    # without the exact tail a single frame is the codec's
    files = zst_files(spark, [f"{tmp_dir}/d"])
    assert [f.rsplit("/")[-1][0] for f, _ in several_frames(spark, files)] == ["a", "c"]
    plain = read_games(spark, f"{tmp_dir}/d", zst_frames=True, split_bytes=2000, exact_tail=False)
    assert {r.source_month: r["count"] for r in plain.groupBy("source_month").count().collect()}["2013-02"] == 300
    sources = {r.source_file for r in framed.select("source_file").distinct().collect()}
    assert sources == {r.source_file for r in codec.select("source_file").distinct().collect()}


def test_a_truncated_frame_raises(spark, tmp_dir):
    data = zst(games_of(200), random.Random(1), 3000)
    write(f"{tmp_dir}/t.pgn.zst", data[:-5])
    with pytest.raises(PySparkException, match="zstd frame"):
        read_games(spark, f"{tmp_dir}/t.pgn.zst", zst_frames=True).count()


def test_event_of_every_game(spark, tmp_dir):
    text = ('[Event "first"]\n[ECO "A00"]\n\n1. e4\n\n[Event [ECO "B45"]\n[Result "1-0"]\n\n[Event "last "one""]\n')
    write(f"{tmp_dir}/e/a.pgn", text)
    write(f"{tmp_dir}/e/b.pgn", 'preamble\n[Site "s"]\n' + text)
    write(f"{tmp_dir}/e/c.pgn", "")
    for split in (3, 40, 1 << 20):
        games = read_games_positioned(spark, f"{tmp_dir}/e", split)
        rows = with_tags(games, "game", ("Event", "ECO", "Site"), keep=("source_file", "first")).collect()
        got = {}
        for r in rows:
            got.setdefault(r.source_file[-5], []).append((r.first, r.Event, r.ECO, r.Site))
        three = [("first", "A00", None), ("B45", None, None), ('last "one"', None, None)]
        assert sorted(got["a"], key=str) == sorted([(i == 0, *t) for i, t in enumerate(three)], key=str)
        assert sorted(got["b"], key=str) == sorted([(True, None, None, "s"), *[(False, *t) for t in three]], key=str)
        assert "c" not in got
    write(f"{tmp_dir}/e/x.pgn.gz", b"x")
    with pytest.raises(ValueError, match="plain and zstd"):
        read_games_positioned(spark, f"{tmp_dir}/e")


def test_source_by_format_name(spark, tmp_dir):
    write(f"{tmp_dir}/s/x/a.pgn", games_of(20))
    write(f"{tmp_dir}/s/_SUCCESS", "")
    spark.dataSource.register(src.PgnDataSource)
    assert spark.read.format("pgn").load(f"{tmp_dir}/s").count() == 20
    assert spark.read.format("pgn").option("splitBytes", "100").load(f"file:{tmp_dir}/s").where("first").count() == 1


def test_paths_and_schemes(tmp_dir):
    path = write(f"{tmp_dir}/a b%20c.pgn", games_of(2))
    quoted = "file:" + path.replace("%", "%25").replace(" ", "%20")
    for p in (path, quoted, "file://" + quoted[5:]):
        with src.open_file(p) as f:
            assert f.size() == os.path.getsize(path)
        assert src.readable(p) and not src.ends_with_separator(p)
    assert src.readable("s3a://bucket/x.pgn") and src.readable("hdfs://h/x") and not src.readable("viewfs://store/x")
    write(f"{tmp_dir}/t.pgn", games_of(1) + src.SEPARATOR)
    write(f"{tmp_dir}/t.pgn.gz", src.SEPARATOR)
    assert src.ends_with_separator(f"{tmp_dir}/t.pgn") and not src.ends_with_separator(f"{tmp_dir}/t.pgn.gz")
    found = src._listed(f"file:{tmp_dir}")
    assert quoted in [p for p, _ in found]
