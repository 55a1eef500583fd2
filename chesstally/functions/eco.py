"""Opening groups: ECO code -> group label.

Every label names an inclusive range of ECO codes ("A02-A03") or a single code ("A47"); the
ranges are disjoint and cover A00..E99 exactly once. Lookups go through a 500-row dimension
(one row per code) joined by equality, so Spark plans a broadcast hash join instead of a
nested-loop range join. The dimension has a fixed size, independent of the data.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chesstally.functions.keys import eco_code, eco_index

UNKNOWN_GROUP = "U00"

# Opening-group labels, in code order (must match the reference's grouping).
ECO_GROUP_LABELS = (
    "A00", "A01", "A02-A03", "A04-A09", "A10-A39", "A40-A41", "A42", "A43-A44", "A45-A46",
    "A47", "A48-A49", "A50", "A51-A52", "A53-A55", "A56", "A57-A59", "A60-A79", "A80-A99",
    "B00", "B01", "B02-B05", "B06", "B07-B09", "B10-B19", "B20-B99",
    "C00-C19", "C20", "C21-C22", "C23-C24", "C25-C29", "C30-C39", "C40", "C41", "C42-C43",
    "C44", "C45", "C46", "C47-C49", "C50", "C51-C52", "C53-C54", "C55-C59", "C60-C99",
    "D00", "D01", "D02", "D03", "D04-D05", "D06", "D07-D09", "D10-D15", "D16", "D17-D19",
    "D20-D29", "D30-D42", "D43-D49", "D50-D69", "D70-D79", "D80-D99",
    "E00", "E01-E09", "E10", "E11", "E12-E19", "E20-E59", "E60-E99",
)


def _index(code: str) -> int:
    return (ord(code[0]) - ord("A")) * 100 + int(code[1:])


@lru_cache(maxsize=1)
def eco_ranges() -> tuple[tuple[int, int, str], ...]:
    """(first index, last index, label) per group, derived from the labels themselves."""
    out = []
    for label in ECO_GROUP_LABELS:
        first, _, last = label.partition("-")
        out.append((_index(first), _index(last or first), label))
    covered = [i for lo, hi, _ in out for i in range(lo, hi + 1)]
    if covered != list(range(500)):
        raise AssertionError("ECO groups must cover A00..E99 exactly once, in order")
    return tuple(out)


def code_of(index: int) -> str:
    return "ABCDE"[index // 100] + f"{index % 100:02d}"


@lru_cache(maxsize=1)
def _dimension_sql() -> str:
    rows = ", ".join(f"('{code_of(i)}', {i}, '{label}')"
                     for lo, hi, label in eco_ranges() for i in range(lo, hi + 1))
    return f"SELECT * FROM VALUES {rows} AS eco_dimension(code, eco_index, eco_group)"


def eco_dimension(spark: SparkSession) -> DataFrame:
    """500 rows ``(code string, eco_index int, eco_group string)``.

    An inline ``VALUES`` table: a JVM-local relation, so broadcasting it needs no Spark job
    and no Python worker (a DataFrame made from a Python list would be scanned through one).
    """
    return spark.sql(_dimension_sql())


def eco_group_expr(index: Column | str) -> Column:
    """Label for an index 0..499 as a CASE over range upper bounds (join-free alternative)."""
    index = F.col(index) if isinstance(index, str) else index
    expr = None
    for _, hi, label in eco_ranges():
        expr = (F.when(index <= hi, F.lit(label)) if expr is None
                else expr.when(index <= hi, F.lit(label)))
    return F.when(index.between(0, 499), expr.otherwise(F.lit(UNKNOWN_GROUP))).otherwise(
        F.lit(UNKNOWN_GROUP))


def with_eco_group(df: DataFrame, eco_col: str | None = "ECO", out_col: str = "eco_group",
                   code_col: str | None = None) -> DataFrame:
    """Add the opening group of the raw ``ECO`` tag (``U00`` when missing or not a code).

    Pass ``code_col`` instead when the normalised code (:func:`eco_code`) is already a column.
    Broadcast hash join against the fixed 500-row dimension: no shuffle of ``df``.
    """
    dim = eco_dimension(df.sparkSession).select(
        F.col("code").alias("__eco_code"), F.col("eco_group").alias("__eco_group"))
    if code_col is None:
        keyed = df.withColumn("__eco_code", eco_code(F.col(eco_col)))
    else:
        keyed = df.withColumn("__eco_code", F.col(code_col))
    joined = keyed.join(F.broadcast(dim), on="__eco_code", how="left")
    return joined.withColumn(
        out_col, F.coalesce(F.col("__eco_group"), F.lit(UNKNOWN_GROUP))
    ).drop("__eco_code", "__eco_group")


def eco_group_of_code(code: Column | str) -> Column:
    """Join-free label of a normalised code column (NULL code -> ``U00``)."""
    code = F.col(code) if isinstance(code, str) else code
    return F.when(code.isNull(), F.lit(UNKNOWN_GROUP)).otherwise(eco_group_expr(eco_index(code)))


def eco_group_of(eco: Column | str) -> Column:
    """Join-free label of a raw ``ECO`` value (same result as :func:`with_eco_group`)."""
    return eco_group_of_code(eco_code(eco))
