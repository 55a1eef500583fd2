"""Print the executed (final, adaptive) physical plans of the main operators.

    python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from chesstally.operators import trends  # noqa: E402
from chesstally.operators.aggregate import aggregate_games  # noqa: E402
from chesstally.session import build_session, scratch_path  # noqa: E402
from chesstally.sinks import store  # noqa: E402
from chesstally.sources.pgn import read_games  # noqa: E402
from chesstally.testing import fixtures  # noqa: E402
from chesstally.testing import queries as Q  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra_conf={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    pgn = fixtures.pgn_dataset(spark, sf_dir)
    landed = scratch_path(spark, "plans", uuid.uuid4().hex[:8])
    store.land_games(read_games(spark, pgn), landed)
    cases = {
        "flagship aggregate": aggregate_games(read_games(spark, pgn, with_source=False)),
        "rated buckets filter on the parse": aggregate_games(
            read_games(spark, pgn, with_source=False)).where(F.col("white_bucket") > 0),
        "source-month filter (partition pruning)": aggregate_games(
            read_games(spark, pgn), by=["source_month"]).where(F.col("source_month") == "1996-03"),
        "landed keys, bucket 100": store.aggregate_landed(spark, landed, 100, ["1996-03"]),
        "top openings on the stored aggregate": trends.top_openings(
            Q.stored_aggregate(spark, sf_dir), 3),
        "plan minus ingested months": Q.plan_pending(spark, sf_dir),
    }
    for title, df in cases.items():
        df.collect()  # run it, so the adaptive plan is final
        print(f"===== {title}")
        print(df._jdf.queryExecution().executedPlan().toString())
    spark.stop()


if __name__ == "__main__":
    main()
