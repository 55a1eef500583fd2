"""Column-expression building blocks: header tags, keys, opening groups, month bounds."""

from chesstally.functions.eco import (
    ECO_GROUP_LABELS,
    UNKNOWN_GROUP,
    eco_dimension,
    eco_group_of,
    eco_ranges,
    with_eco_group,
)
from chesstally.functions.headers import KEY_TAGS, header_entries, tag_columns, tag_value
from chesstally.functions.keys import (
    elo_bucket,
    elo_value,
    eco_code,
    month_key,
    result_class,
    result_value,
)
from chesstally.functions.months import norm_month, norm_month_col

__all__ = [
    "ECO_GROUP_LABELS",
    "KEY_TAGS",
    "UNKNOWN_GROUP",
    "eco_code",
    "eco_dimension",
    "eco_group_of",
    "eco_ranges",
    "elo_bucket",
    "elo_value",
    "header_entries",
    "month_key",
    "norm_month",
    "norm_month_col",
    "result_class",
    "result_value",
    "tag_columns",
    "tag_value",
    "with_eco_group",
]
