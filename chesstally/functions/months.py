"""Month bounds for ingest plans: ``YYYY-MM`` normalisation (driver-side literal and column)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# YYYY, a separator (- / .), the month digits, then nothing or a separator and anything.
# Unicode White_Space, as the column form trims (str.strip would also take U+001C-U+001F).
_WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    chr(c) for c in range(0x2000, 0x200B))
_BOUND = re.compile(r"([0-9]{4})[-/.]([0-9]+)(?:[-/.].*)?", re.DOTALL)


def norm_month(value: str | None) -> str | None:
    """Normalise a month bound to ``YYYY-MM``.

    Accepts ``YYYY-M``, ``YYYY-MM``, ``YYYY/MM``, ``YYYY.MM`` (and ignores parts after the month,
    e.g. ``YYYY-MM-DD``); the year must be 4 ASCII digits, the month 1..12. Returns None otherwise.
    Same rule as :func:`norm_month_col`, for literal bounds on the driver.
    """
    if value is None:
        return None
    m = _BOUND.fullmatch(value.strip(_WHITE_SPACE))
    if m is None or not 1 <= int(m.group(2)) <= 12:
        return None
    return f"{m.group(1)}-{int(m.group(2)):02d}"


def require_month(value: str | None, name: str) -> str | None:
    """:func:`norm_month` for a user-given bound; an invalid bound raises instead of being ignored."""
    if value is None:
        return None
    out = norm_month(value)
    if out is None:
        raise ValueError(f"invalid {name} month {value!r}; expected YYYY-MM")
    return out


def norm_month_col(value: Column | str) -> Column:
    """Column version of :func:`norm_month` (NULL when invalid)."""
    v = F.col(value) if isinstance(value, str) else value
    trimmed = F.regexp_replace(v, r"(?U)^\s+|\s+\z", "")
    pattern = r"^([0-9]{4})[-/.]([0-9]+)(?:[-/.]|\z)"
    parts = F.regexp_extract(trimmed, pattern, 0)
    year = F.regexp_extract(trimmed, pattern, 1)
    month = F.regexp_extract(trimmed, pattern, 2)
    m = month.try_cast("int")
    return F.when(
        (parts != F.lit("")) & m.between(1, 12),
        F.concat(year, F.lit("-"), F.lpad(m.cast("string"), 2, "0")),
    )
