"""Trend queries over the aggregate table.

The aggregate's size is bounded by months x opening groups x bucket pairs, not by the number of
games, so these queries are cheap whatever the input volume. Windows are partitioned by month
where the question allows it; the month-over-month trend runs over one row per month.

Run them on a stored aggregate (:func:`chesstally.sinks.store.read_store` or a written table);
chained directly onto a text parse, every query parses the games again. Key filters (rated buckets,
known months) stay above the parse, which is fenced by a generator (``functions.headers``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chesstally.functions.keys import UNKNOWN_MONTH
from chesstally.operators.aggregate import KEY_COLUMNS, MEASURE_COLUMNS


def _sums(*names: str):
    return [F.sum(n).alias(n) for n in names]


def opening_popularity(agg: DataFrame) -> DataFrame:
    """Games per (month, eco_group) and its share of the month's games."""
    per = agg.groupBy("month", "eco_group").agg(*_sums("games"))
    month_total = F.sum("games").over(Window.partitionBy("month"))
    return per.select("month", "eco_group", "games", (F.col("games") / month_total).alias("share"))


def result_rates(agg: DataFrame, by: tuple[str, ...] = ("eco_group",)) -> DataFrame:
    """Result counts and rates per group. Rates use all games as denominator (unfinished and
    unknown results included); ``decisive_rate`` is decided games over all games."""
    s = agg.groupBy(*by).agg(*_sums(*MEASURE_COLUMNS))
    g = F.col("games")
    return s.select(
        *by, *MEASURE_COLUMNS,
        F.try_divide(F.col("white_wins"), g).alias("white_rate"),
        F.try_divide(F.col("black_wins"), g).alias("black_rate"),
        F.try_divide(F.col("draws"), g).alias("draw_rate"),
        F.try_divide(F.col("white_wins") + F.col("black_wins"), g).alias("decisive_rate"),
    )


def elo_performance(agg: DataFrame, exclude_unrated: bool = False) -> DataFrame:
    """Per (white_bucket, black_bucket): games, rating gap, White's score over finished games
    (win 1, draw 1/2) and draw rate. ``exclude_unrated`` drops bucket 0: missing Elo, but also Elo
    below the bucket width, and everything at width 0."""
    if exclude_unrated:
        agg = agg.where((F.col("white_bucket") > 0) & (F.col("black_bucket") > 0))
    s = agg.groupBy("white_bucket", "black_bucket").agg(*_sums(*MEASURE_COLUMNS))
    finished = F.col("white_wins") + F.col("black_wins") + F.col("draws")
    return s.select(
        "white_bucket", "black_bucket",
        (F.col("white_bucket") - F.col("black_bucket")).alias("gap"),
        *MEASURE_COLUMNS,
        F.try_divide(F.col("white_wins") * 2 + F.col("draws"), finished * 2).alias("white_score"),
        F.try_divide(F.col("draws"), F.col("games")).alias("draw_rate"),
    )


def monthly_trend(agg: DataFrame) -> DataFrame:
    """Games per month (``unknown`` excluded) with previous month, change and running total."""
    per = agg.where(F.col("month") != F.lit(UNKNOWN_MONTH)).groupBy("month").agg(*_sums("games"))
    # One row per month: a global window over this input is small by construction.
    w = Window.orderBy("month")
    prev = F.lag("games").over(w)
    return per.select(
        "month", "games",
        prev.alias("prev_games"),
        (F.col("games") - prev).alias("games_delta"),
        F.sum("games").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running_games"),
    )


def top_openings(agg: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most played opening groups per month (ties by label)."""
    per = agg.groupBy("month", "eco_group").agg(*_sums("games"))
    w = Window.partitionBy("month").orderBy(F.desc("games"), F.asc("eco_group"))
    return (per.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k)
            .select("month", "rank", "eco_group", "games"))


def rollup_counts(agg: DataFrame) -> DataFrame:
    """Subtotals per (month, eco_group), per month, and the grand total (NULL = all)."""
    return agg.rollup("month", "eco_group").agg(*_sums(*MEASURE_COLUMNS))


def cube_counts(agg: DataFrame, dims: tuple[str, ...] = tuple(KEY_COLUMNS)) -> DataFrame:
    """All subtotals over any subset of ``dims`` (counts are additive, so every one is exact)."""
    return agg.cube(*dims).agg(*_sums(*MEASURE_COLUMNS))


def elo_gap_performance(agg: DataFrame, exclude_unrated: bool = False) -> DataFrame:
    """White's score and draw rate by rating gap ``white_bucket - black_bucket``."""
    if exclude_unrated:
        agg = agg.where((F.col("white_bucket") > 0) & (F.col("black_bucket") > 0))
    gap = (F.col("white_bucket") - F.col("black_bucket")).alias("gap")
    s = agg.groupBy(gap).agg(*_sums(*MEASURE_COLUMNS))
    finished = F.col("white_wins") + F.col("black_wins") + F.col("draws")
    return s.select(
        "gap", *MEASURE_COLUMNS,
        F.try_divide(F.col("white_wins") * 2 + F.col("draws"), finished * 2).alias("white_score"),
        F.try_divide(F.col("draws"), F.col("games")).alias("draw_rate"),
    )


def opening_trend(agg: DataFrame) -> DataFrame:
    """Per opening group and month (``unknown`` excluded): share of the month's games, and the
    change of games and share against the group's previous month with games."""
    pop = opening_popularity(agg.where(F.col("month") != F.lit(UNKNOWN_MONTH)))
    w = Window.partitionBy("eco_group").orderBy("month")  # one partition per group: ≤ months rows
    return pop.select(
        "eco_group", "month", "games", "share",
        (F.col("games") - F.lag("games").over(w)).alias("games_change"),
        (F.col("share") - F.lag("share").over(w)).alias("share_change"),
    )
