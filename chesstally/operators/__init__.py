"""Operators on games and aggregate tables: keys, aggregation, merges, trend queries."""

from chesstally.operators import trends
from chesstally.operators.aggregate import (
    aggregate_games,
    aggregate_keys,
    game_keys,
    game_tags,
    merge_aggregates,
    total_games,
    upsert_additive,
)

__all__ = ["aggregate_games", "aggregate_keys", "game_keys", "game_tags", "merge_aggregates",
           "total_games", "trends", "upsert_additive"]
