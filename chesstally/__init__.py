"""chesstally: chess-game trend aggregation on Apache Spark.

PGN text (plain or compressed) is scanned one game per row, header tags are parsed with
JVM-side column expressions, and games are counted per (month, opening group, White rating
bucket, Black rating bucket). The counts are additive, so they merge across files, batches and
streams, and feed the trend queries in :mod:`chesstally.operators.trends`.
"""

from chesstally.operators.aggregate import (
    KEY_COLUMNS,
    MEASURE_COLUMNS,
    aggregate_games,
    aggregate_keys,
    game_keys,
    merge_aggregates,
    total_games,
)
from chesstally.sources.pgn import read_games

__all__ = [
    "KEY_COLUMNS",
    "MEASURE_COLUMNS",
    "aggregate_games",
    "aggregate_keys",
    "game_keys",
    "merge_aggregates",
    "read_games",
    "total_games",
]
