"""Ingest plans: which dump files to process.

A dump index is a text list of URLs/paths, one per line. Lines are trimmed; blank lines and
lines without a ``YYYY-MM.pgn.zst`` ending are dropped; duplicates are kept. The plan is ordered
oldest first, optionally limited by inclusive month bounds, and can exclude months the ingestion
ledger already records as ``success`` (anti join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chesstally.functions.months import require_month

# Fixed value: a planned line must end in ``<YYYY-MM>.pgn.zst``; the capture is the month.
INDEX_LINE_PATTERN = r"(\d{4}-\d{2})\.pgn\.zst$"


def _unicode_trim(c):
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def parse_index(lines: DataFrame, col: str = "value") -> DataFrame:
    """Index lines -> ``month string, url string, line_no bigint`` (see :func:`order_plan`).

    The pattern is anchored at the end of the *trimmed* line, which equals trailing whitespace
    then end of the raw line, so the month comes from the raw line with one regex and the trim
    runs only for kept lines. ``(?U)``: ``\\d``/``\\s`` are Unicode classes; ``\\z``: end of
    input only (``$`` would also match before a final line terminator).
    """
    month = F.regexp_extract(F.col(col), "(?U)" + INDEX_LINE_PATTERN.replace("$", r"\s*\z"), 1)
    # line_no follows the input order (file order for a text read): the stable tie-break.
    parsed = lines.select(F.col(col).alias("__line"), month.alias("month"),
                          F.monotonically_increasing_id().alias("line_no"))
    return (parsed.where(F.col("month") != F.lit(""))
            .select("month", _unicode_trim(F.col("__line")).alias("url"), "line_no"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Read an index file (lines split on ``\\n`` only; a trailing ``\\r`` is trimmed)."""
    return parse_index(spark.read.option("lineSep", "\n").text(path))


def filter_months(plan: DataFrame, since: str | None = None, until: str | None = None,
                  col: str = "month") -> DataFrame:
    """Inclusive month bounds (``YYYY-MM``, ``YYYY-M``, ``YYYY/MM``, ``YYYY.MM``...).

    An invalid bound raises ``ValueError`` rather than being ignored.
    """
    lo = require_month(since, "since")
    hi = require_month(until, "until")
    if lo is not None:
        plan = plan.where(F.col(col) >= F.lit(lo))
    if hi is not None:
        plan = plan.where(F.col(col) <= F.lit(hi))
    return plan


def exclude_done(plan: DataFrame, done_months: DataFrame) -> DataFrame:
    """Drop planned months present in ``done_months`` (column ``month``): left anti join.

    The done set has one row per month at most (months of a ledger), so it is small and bounded
    by calendar months; Spark broadcasts it when its statistics say so.
    """
    return plan.join(done_months.select("month").distinct(), on="month", how="left_anti")


def order_plan(plan: DataFrame) -> DataFrame:
    """Oldest month first; lines of one month keep their index order (a stable sort)."""
    if "line_no" in plan.columns:
        return plan.orderBy("month", "line_no").drop("line_no")
    return plan.orderBy("month", "url")


def build_plan(
    index: DataFrame,
    since: str | None = None,
    until: str | None = None,
    done_months: DataFrame | None = None,
    col: str = "value",
) -> DataFrame:
    """Index lines -> ordered plan ``month, url`` after bounds and the ledger's done months."""
    plan = filter_months(parse_index(index, col), since, until)
    if done_months is not None:
        plan = exclude_done(plan, done_months)
    return order_plan(plan)

