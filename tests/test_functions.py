"""Scalar edge cases for header parsing and key derivation (FIXTURES.md section 4)."""

import pytest
from pyspark.sql import functions as F

from chesstally.functions.eco import eco_group_of, with_eco_group
from chesstally.functions.headers import header_entries, tag_value, with_tags
from chesstally.functions.keys import elo_bucket, elo_value, month_key, result_class, result_value
from chesstally.functions.months import norm_month, norm_month_col


def _one(spark, text, tags):
    df = spark.createDataFrame([(text,)], "game string")
    return with_tags(df, "game", tags).collect()[0].asDict()


@pytest.mark.parametrize("text, tag, expected", [
    ('[ECO "B45"]', "ECO", "B45"),
    ("[ECO B45]", "ECO", None),                       # no quotes
    ('[ECO "B45]', "ECO", None),                      # one quote
    ('[ECO "B45"]\n[ECO "C00"]', "ECO", "C00"),       # duplicate: last wins
    ('  [ECO   "C42" x]\t', "ECO", "C42"),            # indented, spaces, trailing text/tab
    ('[White "a "b" c"]', "White", 'a "b" c'),        # first/last quote, no unescaping
    ('[Y ""]', "Y", ""),                              # empty value is present
    ('[ECO "B45"] tail', "ECO", None),                # must end with ]
    ('x [ECO "B45"]', "ECO", None),                   # must start with [
    ('[ECO\t"B45"]', "ECO", None),                    # tag ends at the first space only
    ('　[Date "2013.07.01"] ', "Date", "2013.07.01"),  # Unicode whitespace trimmed
    ('[ECO "B45"]\r\n[Result "1-0"]\r\n', "Result", "1-0"),      # CRLF
    ('1. e4 e5\n[ECO "A56"]', "ECO", "A56"),          # header-shaped movetext line counts
    ('[%clk 0:01:00]', "%clk", None),
    ('[ECO "B45"] [Result "1-0"]', "ECO", 'B45"] [Result "1-0'),
])
def test_header_lines(spark, text, tag, expected):
    assert _one(spark, text, [tag])[tag] == expected


def test_header_entries_all_tags(spark):
    text = '"Rated"]\n[Site "x"]\n[ECO "B45"]\n\n1. e4\n[ECO "C00"]'
    df = spark.createDataFrame([(text,)], "game string").select(header_entries("game").alias("h"))
    row = df.select("h", tag_value(F.col("h"), "ECO").alias("eco")).collect()[0]
    assert [(e.tag, e.value) for e in row.h] == [("Site", "x"), ("ECO", "B45"), ("ECO", "C00")]
    assert row.eco == "C00"


@pytest.mark.parametrize("utc, date, expected", [
    ("2013.07.01", None, "2013-07"),
    (None, "2013.07.01", "2013-07"),
    ("????.??.??", "2013.07.01", "unknown"),
    ("", "2013.07.01", "unknown"),
    ("2013.13.99", None, "2013-13"),
    ("2013.07", None, "unknown"),
    ("2013.07.", None, "2013-07"),
    ("2013-07-01", None, "unknown"),
    ("2013.7.01", None, "unknown"),
    (None, None, "unknown"),
])
def test_month_key(spark, utc, date, expected):
    df = spark.createDataFrame([(utc, date)], "u string, d string")
    assert df.select(month_key("u", "d")).collect()[0][0] == expected


@pytest.mark.parametrize("eco, expected", [
    ("B45", "B20-B99"), (" b45 ", "B20-B99"), ("A56", "A56"), ("A00", "A00"), ("E99", "E60-E99"),
    ("C42", "C42-C43"), ("D16", "D16"), ("F00", "U00"), ("B4", "U00"), ("B455", "U00"),
    ("?", "U00"), (None, "U00"), ("\tc00　", "C00-C19"), ("B4５", "U00"),
])
def test_eco_group(spark, eco, expected):
    df = spark.createDataFrame([(eco,)], "ECO string")
    assert with_eco_group(df).collect()[0].eco_group == expected
    assert df.select(eco_group_of("ECO")).collect()[0][0] == expected


@pytest.mark.parametrize("elo, size, expected", [
    ("1612", 200, 1600), ("+1500", 200, 1400), (" 1500", 200, 0), ("1500?", 200, 0),
    ("", 200, 0), ("-5", 200, 0), ("65536", 200, 0), ("65535", 200, 65400), ("199", 200, 0),
    ("200", 200, 200), ("0000000000000000000000001500", 200, 1400), ("1500", 0, 0),
    (None, 200, 0), ("+", 200, 0), ("1500\n", 200, 0), ("1500\r", 200, 0),
    ("1550", 100, 1500), ("1550", 400, 1200), ("١٥٠٠", 200, 0),
])
def test_elo_bucket(spark, elo, size, expected):
    df = spark.createDataFrame([(elo,)], "e string")
    assert df.select(elo_bucket("e", size)).collect()[0][0] == expected


def test_elo_value_and_bucket_size_validation(spark):
    df = spark.createDataFrame([("00065535",), ("99999",)], "e string")
    assert [r[0] for r in df.select(elo_value("e")).collect()] == [65535, None]
    with pytest.raises(ValueError):
        elo_bucket("e", 70000)
    with pytest.raises(ValueError):
        elo_bucket("e", -1)


@pytest.mark.parametrize("result, value, cls", [
    ("1-0", "1-0", "white"), ("0-1", "0-1", "black"), ("1/2-1/2", "1/2-1/2", "draw"),
    ("*", "*", "other"), (" 1-0", " 1-0", "other"), ("1-0 ", "1-0 ", "other"),
    (None, "*", "other"),
])
def test_result(spark, result, value, cls):
    df = spark.createDataFrame([(result,)], "r string")
    got = df.select(result_value("r").alias("v")).select("v", result_class("v")).collect()[0]
    assert tuple(got) == (value, cls)


@pytest.mark.parametrize("text, expected", [
    ("2013-7", "2013-07"), ("2013/07", "2013-07"), ("2013.07", "2013-07"),
    ("2013-07-15", "2013-07"), (" 2013-07 ", "2013-07"), ("2013-13", None), ("13-07", None),
    ("2013", None), ("2013-", None), ("2013-00", None), ("2013-0012", "2013-12"),
])
def test_norm_month(spark, text, expected):
    assert norm_month(text) == expected
    df = spark.createDataFrame([(text,)], "m string")
    assert df.select(norm_month_col("m")).collect()[0][0] == expected


def test_norm_month_column_agrees_with_python_on_random_strings(spark):
    import random

    rng = random.Random(5)
    alphabet = "0123456789-/. x\t"
    samples = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    samples += [f"{rng.randint(0, 99999)}{rng.choice('-/.')}{rng.randint(0, 130)}"
                f"{rng.choice(['', '-15', '/x', '.', ' '])}" for _ in range(3000)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, m string")
    got = {r.i: r.n for r in df.select("i", norm_month_col("m").alias("n")).collect()}
    for i, s in enumerate(samples):
        assert got[i] == norm_month(s), s


def test_tag_columns_equal_with_tags(spark):
    from chesstally.functions.headers import tag_columns

    games = ['[ECO "B45"]\n[ECO " c00 "]\n[Result "1-0"]', '[Result ""]', "no headers"]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(games)], "i int, game string")
    a = df.select("i", *tag_columns("game", ["ECO", "Result"])).orderBy("i").collect()
    b = with_tags(df, "game", ["ECO", "Result"], keep=["i"]).orderBy("i").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b] == [
        (0, " c00 ", "1-0"), (1, None, ""), (2, None, None)]
