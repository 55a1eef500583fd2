"""Game keys and the additive aggregate.

The aggregate has key ``(month, eco_group, white_bucket, black_bucket)`` and measures
``games, white_wins, black_wins, draws``. Counts are additive, so partial aggregates of any split
of the games merge by summing (:func:`merge_aggregates`); Spark's partial/final hash aggregation
does exactly that across tasks, which also makes a hot key harmless: each map task ships at most
one row per key to the reducer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chesstally.functions.eco import eco_group_of_code, with_eco_group
from chesstally.functions.headers import KEY_TAGS, with_tags
from chesstally.functions.keys import (
    BLACK_WIN,
    DRAW,
    WHITE_WIN,
    bucket_of,
    eco_code_from_match,
    eco_code_match,
    elo_digits,
    elo_from_digits,
    month_key,
    result_value,
    validate_bucket_size,
)

KEY_COLUMNS = ["month", "eco_group", "white_bucket", "black_bucket"]
MEASURE_COLUMNS = ["games", "white_wins", "black_wins", "draws"]
AGGREGATE_SCHEMA = (
    "month string, eco_group string, white_bucket int, black_bucket int, "
    "games bigint, white_wins bigint, black_wins bigint, draws bigint"
)


def game_tags(games: DataFrame, game_col: str = "game", keep: Sequence[str] = ()) -> DataFrame:
    """The six key tags of every game as raw strings (NULL when absent)."""
    return with_tags(games, game_col, KEY_TAGS, keep)


def game_keys(
    games: DataFrame,
    bucket_size: int = 200,
    game_col: str = "game",
    keep: Sequence[str] = (),
    eco_lookup: str = "join",
) -> DataFrame:
    """Per-game ``month, eco_group, white_bucket, black_bucket, result`` (+ ``keep`` columns).

    ``eco_lookup='join'`` maps ECO codes through a broadcast join with the 500-row dimension;
    ``'case'`` uses an equivalent CASE expression (no join at all).
    """
    validate_bucket_size(bucket_size)
    tags = game_tags(games, game_col, keep)
    # Each stage is its own projection so a regex referenced twice below runs once per game.
    raw = tags.select(
        *keep,
        F.coalesce(F.col("UTCDate"), F.col("Date")).alias("__date"),
        eco_code_match("ECO").alias("__eco"),
        elo_digits("WhiteElo").alias("__white"),
        elo_digits("BlackElo").alias("__black"),
        result_value("Result").alias("result"),
    )
    keyed = raw.select(
        *keep,
        month_key("__date", F.lit(None).cast("string")).alias("month"),
        eco_code_from_match(F.col("__eco")).alias("eco_code"),
        bucket_of(elo_from_digits(F.col("__white")), bucket_size).alias("white_bucket"),
        bucket_of(elo_from_digits(F.col("__black")), bucket_size).alias("black_bucket"),
        F.col("result"),
    )
    if eco_lookup == "join":
        keyed = with_eco_group(keyed, code_col="eco_code")
    elif eco_lookup == "case":
        keyed = keyed.withColumn("eco_group", eco_group_of_code("eco_code"))
    else:
        raise ValueError(f"eco_lookup must be 'join' or 'case', got {eco_lookup!r}")
    return keyed.select(*keep, *KEY_COLUMNS, "result")


def rebalance_games(games: DataFrame, tasks: int | None) -> DataFrame:
    """Deal games in turn to ``tasks`` tasks, more for large files, for parsing (None: as they are). For
    unsplittable dumps, of which one task reads each; that task then only cuts records."""
    from chesstally.sources.pgn import deal  # which needs this package's columns

    return deal(games, tasks)


def aggregate_keys(keys: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Count games and results per key (and per the extra ``by`` columns, e.g. a source)."""
    result = F.col("result")
    return keys.groupBy(*by, *KEY_COLUMNS).agg(
        F.count(F.lit(1)).alias("games"),
        F.count_if(result == F.lit(WHITE_WIN)).alias("white_wins"),
        F.count_if(result == F.lit(BLACK_WIN)).alias("black_wins"),
        F.count_if(result == F.lit(DRAW)).alias("draws"),
    )


def aggregate_games(
    games: DataFrame,
    bucket_size: int = 200,
    game_col: str = "game",
    by: Sequence[str] = (),
    eco_lookup: str = "join",
) -> DataFrame:
    """Games (one per row) -> aggregate table; ``by`` adds grouping columns kept from input."""
    return aggregate_keys(game_keys(games, bucket_size, game_col, by, eco_lookup), by)


def merge_aggregates(*tables: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Additive merge: union of aggregate tables, measures summed per key."""
    if not tables:
        raise ValueError("merge_aggregates needs at least one table")
    cols = [*by, *KEY_COLUMNS, *MEASURE_COLUMNS]
    union = reduce(DataFrame.unionByName, [t.select(*cols) for t in tables])
    return union.groupBy(*by, *KEY_COLUMNS).agg(*(F.sum(m).alias(m) for m in MEASURE_COLUMNS))


def upsert_additive(existing: DataFrame, delta: DataFrame) -> DataFrame:
    """Stored table after an additive upsert of ``delta`` (a key present in both adds up).

    Replaying the same delta doubles its counts; see :mod:`chesstally.sinks.store` for the
    idempotent per-source store.
    """
    return merge_aggregates(existing, delta)


def total_games(games: DataFrame) -> DataFrame:
    """One row ``games bigint``: number of games scanned, independent of any key."""
    return games.agg(F.count(F.lit(1)).alias("games"))
