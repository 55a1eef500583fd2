"""Seeded random texts: the column-expression parser against a brute-force statement of the
header, month, ECO and Elo rules (one Spark job over a few thousand adversarial games)."""

import random

from pyspark.sql import functions as F

from chesstally.functions.eco import eco_ranges, with_eco_group
from chesstally.functions.headers import with_tags
from chesstally.functions.keys import elo_bucket, month_key

# Unicode White_Space (the trimming set).
WHITE_SPACE = set("\t\n\x0b\x0c\r \x85\xa0     　") | {
    chr(c) for c in range(0x2000, 0x200B)}
TAGS = ["ECO", "Result", "UTCDate", "Date", "WhiteElo", "BlackElo", "Site"]


def trim(s: str) -> str:
    i, j = 0, len(s)
    while i < j and s[i] in WHITE_SPACE:
        i += 1
    while j > i and s[j - 1] in WHITE_SPACE:
        j -= 1
    return s[i:j]


def brute_headers(text: str) -> dict:
    """Tag -> value by the stated rules; lines split on '\\n' only."""
    found = {}
    for raw in text.split("\n"):
        line = trim(raw)
        if not (line.startswith("[") and line.endswith("]")):
            continue
        space = line.find(" ")
        if space < 0:
            continue
        first_quote = line.find('"', space)
        last_quote = line.rfind('"')
        if first_quote < 0 or last_quote <= first_quote:
            continue
        found[line[1:space]] = line[first_quote + 1:last_quote]
    return found


def brute_month(h: dict) -> str:
    d = h.get("UTCDate", h.get("Date"))
    if d is not None and len(d) >= 8 and d[4] == "." and d[7] == ".":
        y, m = d[0:4], d[5:7]
        if all(c in "0123456789" for c in y + m):
            return f"{y}-{m}"
    return "unknown"


def brute_elo_bucket(v, size=200) -> int:
    if v is None or size == 0:
        return 0
    body = v[1:] if v.startswith("+") else v
    if not body or any(c not in "0123456789" for c in body) or int(body) > 65535:
        return 0
    return int(body) // size * size


def brute_group(v) -> str:
    if v is None:
        return "U00"
    s = trim(v)
    if len(s) != 3 or s[0].upper() not in "ABCDE" or any(c not in "0123456789" for c in s[1:]):
        return "U00"
    n = ("ABCDE".index(s[0].upper())) * 100 + int(s[1:])
    return next(label for lo, hi, label in eco_ranges() if lo <= n <= hi)


PIECES = ['[', ']', '"', ' ', '  ', '\t', '\r', '　', '\xa0', '\x1c', 'x', '1', '0', '-',
          '/', '.', '+', '2013', '07', '..', 'B4', '5', 'e', '?', '*', '1-0', ' ', '0-1']


def random_value(rng):
    kind = rng.random()
    if kind < 0.25:
        return f"{rng.randint(1990, 2030)}.{rng.randint(0, 13):02d}.{rng.randint(1, 31):02d}"
    if kind < 0.45:
        return rng.choice(["", "+", "0"]) + str(rng.randint(0, 70000))
    if kind < 0.6:
        return rng.choice(" \t　") * rng.randint(0, 1) + rng.choice("ABCDEFabcdef") + \
            str(rng.randint(0, 120)) + rng.choice(["", " ", "　"])
    return "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 6)))


def random_line(rng):
    if rng.random() < 0.7:
        tag = rng.choice(TAGS)
        lead = "".join(rng.choice(["", " ", "\t", "　"]) for _ in range(rng.randint(0, 1)))
        sep = rng.choice([" ", " ", "  ", "\t", ""])
        inner = rng.choice(['"{v}"', '"{v}"', '"{v}', '{v}', '"{v}" x', 'q"{v}"'])
        tail = rng.choice(["]", "]", "] ", "]\r", "]\t　", "", "]x"])
        return lead + "[" + tag + sep + inner.format(v=random_value(rng)) + tail
    return "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 8)))


def test_random_games_match_brute_force(spark):
    rng = random.Random(20261203)
    games = ["\n".join(random_line(rng) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(games)], "id int, game string")
    tags = with_tags(df, "game", TAGS, keep=["id"])
    out = with_eco_group(tags.select(
        "id", *TAGS,
        month_key("UTCDate", "Date").alias("month"),
        elo_bucket("WhiteElo", 200).alias("wb"),
        elo_bucket("BlackElo", 100).alias("bb"),
    ), eco_col="ECO").orderBy("id").collect()
    assert len(out) == len(games)
    for row in out:
        h = brute_headers(games[row.id])
        for t in TAGS:
            assert row[t] == h.get(t), (games[row.id], t)
        assert row.month == brute_month(h), games[row.id]
        assert row.wb == brute_elo_bucket(h.get("WhiteElo"), 200), games[row.id]
        assert row.bb == brute_elo_bucket(h.get("BlackElo"), 100), games[row.id]
        assert row.eco_group == brute_group(h.get("ECO")), games[row.id]


def test_random_game_counts_in_files(spark, tmp_dir):
    """Random streams split into games by the text source equal the line loop's count."""
    from tests.conftest import write
    from tests.test_scan import reference_game_count
    from chesstally.sources.pgn import read_games

    rng = random.Random(7)
    expected = 0
    for i in range(40):
        lines = [rng.choice(['[Event "x"]', '[Event "y"]\r', ' [Event "z"]', '[EventDate "d"]',
                             '', 'text', '[ECO "A00"]', '[Event ', '[Event']) for _ in range(
            rng.randint(0, 30))]
        text = "\n".join(lines) + rng.choice(["", "\n", "\r\n"])
        write(f"{tmp_dir}/r/{i}.pgn", text)
        expected += reference_game_count(text)
    got = read_games(spark, f"{tmp_dir}/r").count()
    assert got == expected


def test_random_files_end_to_end_against_brute_force(spark, tmp_dir):
    """Random PGN files (CRLF, BOM, non-ASCII, pseudo game starts) -> aggregate, compared with
    the line loop + stated rules applied in Python."""
    import os

    from chesstally.operators.aggregate import aggregate_games
    from chesstally.sources.pgn import read_games
    from tests.conftest import write

    rng = random.Random(99)
    lines = ['[Event "x"]', '[Event "é"]\r', '﻿[Event "b"]', ' [Event "z"]', '[EventDate "d"]',
             '', 'text ünï', '[ECO "B45"]', '[ECO " c00 "]\r', '[Result "1-0"]', '[Result "0-1"]',
             '[Result "1/2-1/2"]', '[UTCDate "2013.07.01"]', '[Date "2014.02.03"]',
             '[WhiteElo "1612"]', '[BlackElo "+1500"]', '[Event', '1. e4 { [%clk 0:01:00] } *']
    expected: dict = {}
    for i in range(60):
        text = "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 40)))
        text += rng.choice(["", "\n", "\r\n"])
        if text.endswith("\n[Event "):  # the documented truncated-line deviation
            text += "\n"
        write(os.path.join(tmp_dir, "pgn", f"f{i}.pgn"), text)
        games, current = [], []
        parts = text.split("\n")
        if parts and parts[-1] == "":
            parts.pop()
        for line in parts:
            line = line[:-1] if line.endswith("\r") else line
            if line.startswith("[Event ") and current:
                games.append(current)
                current = []
            current.append(line)
        if current:
            games.append(current)
        for game in games:
            h = brute_headers("\n".join(game))
            key = (brute_month(h), brute_group(h.get("ECO")),
                   brute_elo_bucket(h.get("WhiteElo")), brute_elo_bucket(h.get("BlackElo")))
            r = h.get("Result", "*")
            c = expected.setdefault(key, [0, 0, 0, 0])
            c[0] += 1
            c[1] += r == "1-0"
            c[2] += r == "0-1"
            c[3] += r == "1/2-1/2"
    got = {tuple(r[:4]): list(r[4:]) for r in aggregate_games(
        read_games(spark, os.path.join(tmp_dir, "pgn"), with_source=False)).collect()}
    assert got == expected


def test_generated_pgn_files_against_brute_force(spark):
    """The sf0.001 PGN text files, segmented and parsed in plain Python by the stated rules,
    give the same aggregate as the Spark scan + parse (independent of the DuckDB oracle)."""
    import glob
    import os

    from chesstally.operators.aggregate import aggregate_games
    from chesstally.sources.pgn import read_games
    from chesstally.testing import fixtures
    from tests.conftest import SF_SMALL

    root = fixtures.pgn_dataset(spark, SF_SMALL)
    expected: dict = {}
    for path in glob.glob(os.path.join(root.replace("file:", ""), "*", "*.txt")):
        with open(path, encoding="utf-8", newline="") as f:
            text = f.read()
        games, current = [], []
        parts = text.split("\n")
        if parts and parts[-1] == "":
            parts.pop()
        for line in parts:
            line = line[:-1] if line.endswith("\r") else line
            if line.startswith("[Event ") and current:
                games.append(current)
                current = []
            current.append(line)
        if current:
            games.append(current)
        for game in games:
            h = brute_headers("\n".join(game))
            key = (brute_month(h), brute_group(h.get("ECO")),
                   brute_elo_bucket(h.get("WhiteElo")), brute_elo_bucket(h.get("BlackElo")))
            r = h.get("Result", "*")
            c = expected.setdefault(key, [0, 0, 0, 0])
            c[0] += 1
            c[1] += r == "1-0"
            c[2] += r == "0-1"
            c[3] += r == "1/2-1/2"
    got = {tuple(r[:4]): list(r[4:]) for r in
           aggregate_games(read_games(spark, root, with_source=False)).collect()}
    assert sum(v[0] for v in expected.values()) == spark.read.parquet(
        f"{SF_SMALL}/lineitem.parquet").count()
    assert got == expected


def test_exact_tail_matches_the_line_loop_exactly(spark, tmp_dir):
    """With exact_tail, counts equal the line loop for every file, truncated ones included."""
    import gzip
    import os

    from chesstally.sources.pgn import read_games
    from tests.conftest import write
    from tests.test_scan import reference_game_count

    rng = random.Random(11)
    expected, truncated = 0, 0
    for i in range(40):
        lines = [rng.choice(['[Event "x"]', '[Event "y"]\r', ' [Event "z"]', '[EventDate "d"]',
                             '', 'text é', '[ECO "A00"]', '[Event ', '[Event']) for _ in range(
            rng.randint(0, 30))]
        text = "\n".join(lines) + rng.choice(["", "\n", "\r\n", "\n[Event "])
        truncated += text.endswith("\n[Event ")
        write(os.path.join(tmp_dir, "t", f"{i}.pgn"), text)
        expected += reference_game_count(text)
    assert truncated > 0
    games = read_games(spark, os.path.join(tmp_dir, "t"), exact_tail=True)
    assert games.count() == expected
    assert games.where(F.col("game") == "[Event ").count() >= truncated
    # compressed files: file size is not the text size, so nothing is added
    gz = os.path.join(tmp_dir, "gz", "a.pgn.gz")
    os.makedirs(os.path.dirname(gz))
    with gzip.open(gz, "wt") as f:
        f.write('[Event "a"]\n[Event ')
    assert read_games(spark, os.path.dirname(gz), exact_tail=True).count() == 1
