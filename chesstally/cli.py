"""Command line: the two workflows of the original tool on Spark.

    python -m chesstally games_2013-07.pgn.zst more.pgn --out out/agg.csv
    python -m chesstally --index list.txt --since 2013-01 --until 2013-06 --out out/ \\
        --store /shared/agg-store --ledger /shared/ledger

Default is a dry run: nothing is written unless ``--out``, ``--store`` or ``--jdbc-url`` is
given. The exit code is 1 if a month failed. Index lines are file paths/URLs on a Hadoop filesystem (mirror dumps there first).
"""

from __future__ import annotations

import argparse
import os
import sys
import time
import tomllib

from chesstally import fs
from chesstally.jobs import run_files_counted, run_index
from chesstally.session import build_session


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="chesstally", description=__doc__.split("\n\n")[0])
    p.add_argument("files", nargs="*", help="PGN files (plain or compressed)")
    p.add_argument("--index", "--list", dest="index", help="dump index: one path/URL per line")
    p.add_argument("--since", "--from", dest="since", help="first month (inclusive), YYYY-MM")
    p.add_argument("--until", help="last month (inclusive), YYYY-MM")
    p.add_argument("--out", "-o", help="CSV file (files mode) or directory/base name (index mode)")
    p.add_argument("--bucket-size", type=int, default=None,
                   help="Elo bucket width (default: config file, else 200)")
    p.add_argument("--config", help="TOML settings (bucket_size, list_url, db_batch_rows); "
                                    "default ./config.toml "
                                    "when present")
    p.add_argument("--store", help="idempotent by-source aggregate store (parquet directory)")
    p.add_argument("--rollup", help="roll-up of the store (parquet directory), refreshed for the months that change")
    p.add_argument("--ledger", help="ingestion ledger directory (index mode)")
    p.add_argument("--jdbc-url", help="database URL for an additive upsert (postgres/mysql/sqlite)")
    p.add_argument("--save", action="store_true",
                   help="write to the database named by the DATABASE_URL environment variable")
    p.add_argument("--rebalance", type=int, default=None,
                   help="parse in N tasks after scanning unsplittable dumps (.zst/.gz)")
    p.add_argument("--recursive", action="store_true",
                   help="read every file below the given folders (files mode)")
    p.add_argument("--no-exact-tail", dest="exact_tail", action="store_false",
                   help="leave out the bare last game of uncompressed files ending in '[Event '")
    p.add_argument("--zst-frames", action="store_true",
                   help="read the frames of .zst dumps in parallel (and their bare last games)")
    p.add_argument("--master", help="Spark master (default: from the environment)")
    p.add_argument("--verbose", "-v", action="store_true", help="print phase timings to stderr")
    args = p.parse_args(argv)
    settings = load_config(args.config)
    args.db_batch_rows = int(settings.get("db_batch_rows", 1000))
    if args.bucket_size is None:
        args.bucket_size = int(settings.get("bucket_size", 200))
    if args.index is None and not args.files and settings.get("list_url"):
        args.index = settings["list_url"]
    if args.save and not args.jdbc_url:
        args.jdbc_url = os.environ.get("DATABASE_URL")
        if not args.jdbc_url:
            p.error("--save needs DATABASE_URL (or --jdbc-url)")
    if args.rollup and not args.store:
        p.error("--rollup needs --store")
    if args.index and args.files:
        p.error("give either files or --index, not both")
    if not args.index and not args.files:
        p.error("give PGN files or --index")
    return args


# The setting names of the original tool's config.toml (accepted as-is).
CONFIG_KEYS = {"bucket_size", "list_url", "db_batch_rows", "batch_size", "rayon_threads"}


def load_config(path: str | None) -> dict:
    """Settings from a TOML file: ``bucket_size``, ``list_url`` and ``db_batch_rows`` (JDBC batch
    size) are used; ``batch_size`` and ``rayon_threads`` are accepted and ignored (Spark sizes
    its own tasks).
    An explicit file that is missing or invalid raises instead of falling back to defaults."""
    if path is None:
        if not os.path.exists("config.toml"):
            return {}
        path = "config.toml"
    with open(path, "rb") as f:
        data = tomllib.load(f)
    unknown = set(data) - CONFIG_KEYS
    if unknown:
        raise ValueError(f"unknown settings in {path}: {sorted(unknown)}")
    return data


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    t0 = time.perf_counter()
    spark = build_session(args.master, extra_conf={"spark.ui.showConsoleProgress": "false"})
    if args.verbose:
        print(f"session ready in {time.perf_counter() - t0:.3f}s", file=sys.stderr)
    t1 = time.perf_counter()
    if args.index:
        per_month = run_index(spark, args.index, args.since, args.until, args.out,
                              args.bucket_size, args.store, args.ledger, args.jdbc_url,
                              args.rebalance, args.db_batch_rows, args.exact_tail,
                              zst_frames=args.zst_frames, rollup=args.rollup)
        seconds = time.perf_counter() - t1
        for month in sorted(per_month):
            print(f"{month} | games={per_month[month]}")
        print(f"Processed {len(per_month)} month(s) in {seconds:.3f}s.", file=sys.stderr)
        if per_month.failed:
            print(f"Failed: {', '.join(sorted(per_month.failed))}", file=sys.stderr)
            return 1
    else:
        single_files = len(args.files) > 1 and not any(
            any(ch in f for ch in "*?[{") or fs.is_dir(spark, f) for f in args.files)
        per_file: dict[str, int] = {}  # of the files named on the command line
        total = run_files_counted(
            spark, args.files, args.out, args.bucket_size, args.store, args.jdbc_url, args.rebalance,
            args.recursive, args.db_batch_rows, args.exact_tail,
            per_file=per_file.__setitem__ if single_files else None, zst_frames=args.zst_frames,
            rollup=args.rollup)
        if single_files:
            for f in args.files:  # one count per existing input file, as separate runs print
                if fs.is_file(spark, f):
                    print(per_file.get(fs.qualify(spark, f), 0))
        else:
            print(total)
        if args.verbose:
            print(f"aggregated in {time.perf_counter() - t1:.3f}s", file=sys.stderr)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
