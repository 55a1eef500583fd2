"""SQL access: the original database tables as Spark temp views.

``aggregates`` and ``ingestions`` get the column names and types of the original tool's tables,
so SQL written against that database runs unchanged through ``spark.sql``:

    register_tables(spark, store="/shared/agg-store", ledger="/shared/ledger")
    spark.sql("SELECT eco_group, sum(games) FROM aggregates GROUP BY eco_group").show()
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chesstally.operators.aggregate import KEY_COLUMNS, MEASURE_COLUMNS
from chesstally.sinks import ledger as ledger_mod
from chesstally.sinks.store import read_store


def register_tables(spark: SparkSession, store: str | None = None, ledger: str | None = None,
                    aggregates: DataFrame | None = None,
                    ingestions: DataFrame | None = None) -> list[str]:
    """Create/replace the temp views ``aggregates`` (from a by-source store or a given aggregate
    DataFrame) and ``ingestions`` (current state of a ledger path, or a given state DataFrame);
    returns the registered names."""
    names = []
    if aggregates is None and store is not None:
        aggregates = read_store(spark, store)
    if aggregates is not None:
        aggregates.select(
            *[F.col(c) for c in KEY_COLUMNS],
            *[F.col(m).cast("bigint") for m in MEASURE_COLUMNS],
        ).createOrReplaceTempView("aggregates")
        names.append("aggregates")
    if ingestions is None and ledger is not None:
        ingestions = ledger_mod.current_state(spark, ledger)
    if ingestions is not None:
        ingestions.select(*ledger_mod.STATE_COLUMNS).createOrReplaceTempView("ingestions")
        names.append("ingestions")
    return names
