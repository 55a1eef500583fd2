"""Algebraic properties of the aggregate and the ECO dimension."""

from pyspark.sql import functions as F

from chesstally.functions.eco import ECO_GROUP_LABELS, eco_dimension, eco_ranges
from chesstally.operators.aggregate import (
    KEY_COLUMNS,
    aggregate_games,
    merge_aggregates,
    total_games,
    upsert_additive,
)
from chesstally.testing import fixtures
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(r) for r in df.select(*KEY_COLUMNS, "games", "white_wins", "black_wins",
                                              "draws").collect())


def _games(spark):
    return fixtures.generated_games(spark, SF_SMALL)


def test_eco_dimension_covers_codes_once(spark):
    dim = eco_dimension(spark)
    assert dim.count() == 500
    assert dim.select("code").distinct().count() == 500
    assert dim.select("eco_group").distinct().count() == len(ECO_GROUP_LABELS) == 66
    assert eco_ranges()[0] == (0, 0, "A00") and eco_ranges()[-1] == (460, 499, "E60-E99")


def test_equi_join_equals_range_join(spark):
    """The 500-row equi-join dimension agrees with a direct BETWEEN join over the ranges."""
    ranges = spark.createDataFrame(list(eco_ranges()), "lo int, hi int, label string")
    dim = eco_dimension(spark)
    between = dim.join(ranges, (dim.eco_index >= ranges.lo) & (dim.eco_index <= ranges.hi))
    assert between.where(F.col("label") != F.col("eco_group")).count() == 0
    assert between.count() == 500


def test_counts_and_invariants(spark):
    g = _games(spark)
    agg = aggregate_games(g)
    n = total_games(g).collect()[0].games
    s = agg.agg(F.sum("games"), F.max(F.col("white_wins") + F.col("black_wins") + F.col("draws")
                                      - F.col("games"))).collect()[0]
    assert s[0] == n == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert s[1] <= 0
    assert agg.where(F.col("month").isNull() | F.col("eco_group").isNull()).count() == 0


def test_merge_of_parts_equals_whole(spark):
    g = _games(spark)
    whole = _rows(aggregate_games(g))
    a, b, c = g.randomSplit([0.3, 0.3, 0.4], seed=7)
    parts = [aggregate_games(x) for x in (a, b, c)]
    assert _rows(merge_aggregates(*parts)) == whole
    assert _rows(merge_aggregates(parts[2], parts[0], parts[1])) == whole       # commutative
    assert _rows(merge_aggregates(merge_aggregates(parts[0], parts[1]), parts[2])) == whole


def test_partition_count_invariance(spark):
    g = _games(spark)
    assert _rows(aggregate_games(g.repartition(1))) == _rows(aggregate_games(g.repartition(13)))


def test_join_and_case_lookups_agree(spark):
    g = _games(spark)
    assert _rows(aggregate_games(g, eco_lookup="join")) == _rows(aggregate_games(g, eco_lookup="case"))


def test_upsert_additive_doubles(spark):
    a = aggregate_games(_games(spark))
    doubled = {r[:4]: r[4:] for r in _rows(upsert_additive(a, a))}
    for r in _rows(a):
        assert doubled[r[:4]] == tuple(2 * x for x in r[4:])


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_key_filters_stay_above_the_parse_and_source_filters_prune(spark):
    from chesstally.sources.pgn import read_games

    g = read_games(spark, fixtures.pgn_dataset(spark, SF_SMALL))
    rated = aggregate_games(g).where((F.col("white_bucket") > 0) & (F.col("black_bucket") > 0))
    plan = _plan(rated)
    assert plan.count("regexp_extract_all") == 2  # the two header passes, not repeated in a filter
    by_month = aggregate_games(g, by=["source_month"]).where(F.col("source_month") == "1996-03")
    assert "PartitionFilters: [isnotnull(source_month" in _plan(by_month) or \
        "source_month#" in _plan(by_month).split("PartitionFilters: [")[1].split("]")[0]
