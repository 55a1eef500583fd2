"""Per-game key derivation: month, ECO code, Elo, Elo bucket, result.

All functions return built-in column expressions; inputs are the raw tag strings (NULL when the
tag is absent).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_MONTH = "unknown"
NO_RESULT = "*"
# Counted results; any other Result value only raises the game count.
WHITE_WIN, BLACK_WIN, DRAW = "1-0", "0-1", "1/2-1/2"
MAX_ELO = 65535  # Elo values are unsigned 16-bit numbers


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_key(utc_date: Column | str, date: Column | str) -> Column:
    """``YYYY-MM`` from ``UTCDate`` when that tag is present, else from ``Date``.

    Valid when characters 5 and 8 are dots and 1-4, 6-7 are ASCII digits; anything else,
    including an empty or malformed ``UTCDate`` next to a valid ``Date``, gives ``unknown``.
    """
    d = F.coalesce(_c(utc_date), _c(date))
    return F.when(
        d.rlike(r"^[0-9]{4}\.[0-9]{2}\."),
        F.concat(F.substring(d, 1, 4), F.lit("-"), F.substring(d, 6, 2)),
    ).otherwise(F.lit(UNKNOWN_MONTH))


def eco_code(eco: Column | str) -> Column:
    """Normalised ECO code ``A00``..``E99`` (trimmed, upper-cased) or NULL when not a code."""
    return eco_code_from_match(eco_code_match(eco))


def eco_code_match(eco: Column | str) -> Column:
    """First stage of :func:`eco_code`: the trimmed code as written, '' when not a code."""
    return F.regexp_extract(_c(eco), r"(?U)^\s*([A-Ea-e][0-9]{2})\s*\z", 1)


def eco_code_from_match(match: Column) -> Column:
    return F.when(match != F.lit(""), F.upper(match))


def eco_index(code: Column | str) -> Column:
    """Code ``A00``..``E99`` to its position 0..499 (letter * 100 + number)."""
    code = _c(code)
    return (F.ascii(code) - F.lit(65)) * F.lit(100) + F.substring(code, 2, 2).cast("int")


def elo_value(elo: Column | str) -> Column:
    """Unsigned 16-bit parse: optional ``+``, ASCII digits only, 0..65535; else NULL.

    Leading zeros are stripped before the range check, so arbitrarily long zero-padded numbers
    parse like the short form.
    """
    return elo_from_digits(elo_digits(elo))


def elo_digits(elo: Column | str) -> Column:
    """First stage of :func:`elo_value`: the number without sign and leading zeros, as int
    (at most 5 digits, so at most 99999), NULL when the text is not a number."""
    return F.regexp_extract(_c(elo), r"^\+?0*([0-9]{1,5})\z", 1).try_cast("int")


def elo_from_digits(digits: Column) -> Column:
    return F.when(digits <= F.lit(MAX_ELO), digits)


def elo_bucket(elo: Column | str, bucket_size: int = 200) -> Column:
    """Lower bound of the Elo bucket; 0 for a missing/invalid Elo or a bucket size of 0."""
    return bucket_of(elo_value(elo), bucket_size)


def bucket_of(value: Column, bucket_size: int = 200) -> Column:
    """Bucket of an already parsed Elo (int or NULL)."""
    bucket_size = validate_bucket_size(bucket_size)
    if bucket_size == 0:
        return F.lit(0)
    return F.coalesce(value - value % F.lit(bucket_size), F.lit(0))


def validate_bucket_size(bucket_size: int) -> int:
    if not isinstance(bucket_size, int) or not 0 <= bucket_size <= MAX_ELO:
        raise ValueError(f"bucket_size must be an integer in 0..{MAX_ELO}, got {bucket_size!r}")
    return bucket_size


def result_value(result: Column | str) -> Column:
    """The ``Result`` tag, ``*`` when absent."""
    return F.coalesce(_c(result), F.lit(NO_RESULT))


def result_class(result: Column | str) -> Column:
    """``white`` / ``black`` / ``draw`` for the three counted results, else ``other``."""
    r = _c(result)
    return (
        F.when(r == F.lit(WHITE_WIN), F.lit("white"))
        .when(r == F.lit(BLACK_WIN), F.lit("black"))
        .when(r == F.lit(DRAW), F.lit("draw"))
        .otherwise(F.lit("other"))
    )
