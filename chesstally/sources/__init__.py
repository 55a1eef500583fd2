"""Sources: PGN game scans (batch and streaming); SQL views of the stored tables."""

from chesstally.sources.pgn import GAME_SEPARATOR, read_games, source_month_from_path, stream_games
from chesstally.sources.tables import register_tables

__all__ = ["GAME_SEPARATOR", "read_games", "register_tables", "source_month_from_path",
           "stream_games"]
