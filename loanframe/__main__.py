"""Command-line jobs: ``spark-submit loanframe/__main__.py JOB ...`` or
``python -m loanframe JOB ...``.

    python -m loanframe batch   --raw RAW.csv[.gz] --release DIR
    python -m loanframe quality --release DIR --baseline DIR --report DIR
    python -m loanframe batch   --raw RAW.csv[.gz] --checkpoint DIR --ratio DIR --curve DIR
                                [--stats DIR]
    python -m loanframe quality (--raw RAW.csv[.gz] | --stats DIR) --checkpoint DIR
                                --ratio DIR --curve DIR --baseline DIR --report DIR
    python -m loanframe profile --raw RAW.csv[.gz] --out DIR
    python -m loanframe peek    --raw RAW.csv[.gz] [--out DIR]

The session comes from ``SparkSession.builder.getOrCreate()``, so master, memory,
shuffle partitions and ``spark.checkpoint.dir`` are whatever the submitter sets.
Every result is written; nothing is printed row by row.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    # Run as a file (``spark-submit loanframe/__main__.py ...``): make the package
    # importable from the folder above it.
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from loanframe import rules  # noqa: E402
from loanframe.operators.checks import require_non_empty  # noqa: E402
from loanframe.operators.profile import dataset_profile, sample_rows  # noqa: E402
from loanframe.plans import (  # noqa: E402
    publish_batch,
    read_release,
    run_batch,
    run_profiling,
    run_quality,
)
from loanframe.sources import (  # noqa: E402
    load_baseline,
    load_json_baseline,
    read_checkpoint,
    read_raw_csv,
    save_baseline,
    write_table,
)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loanframe")
    sub = p.add_subparsers(dest="job", required=True)

    def common(q, raw_required=True):
        q.add_argument("--raw", required=raw_required, nargs="+", help="raw loan CSV file(s)")
        q.add_argument(
            "--partitions",
            type=int,
            default=None,
            help="repartition the raw rows (default: only compressed files that cannot be split)",
        )

    b = sub.add_parser("batch", help="clean, validate, label, checkpoint, aggregate")
    common(b)
    b.add_argument(
        "--release",
        default=None,
        help="publish checkpoint, rejected rows and outputs as one release under this folder, "
        "from one pass over the raw rows (instead of --checkpoint, --ratio and --curve)",
    )
    b.add_argument("--checkpoint", default=None)
    b.add_argument("--ratio", default=None)
    b.add_argument("--curve", default=None)
    b.add_argument("--format", default="parquet")
    b.add_argument("--as-tables", action="store_true", help="--ratio/--curve are table names")
    b.add_argument("--partition-by", nargs="*", default=None)
    b.add_argument("--stage-raw", default=None, help="write the raw text as Parquet first")
    b.add_argument("--stats", default=None, help="save the raw row counts and checks here")

    q = sub.add_parser("quality", help="counts, null rates, snapshot, drift, report rows")
    common(q, raw_required=False)
    q.add_argument("--stats", default=None, help="the batch job's stats (instead of --raw)")
    q.add_argument("--release", default=None, help="check the newest release in this folder")
    q.add_argument("--checkpoint", default=None)
    q.add_argument("--ratio", default=None)
    q.add_argument("--curve", default=None)
    q.add_argument("--format", default="parquet")
    q.add_argument("--as-tables", action="store_true", help="--ratio/--curve are table names")
    q.add_argument("--baseline", required=True)
    q.add_argument(
        "--baseline-json",
        default=None,
        help="a baseline kept as a JSON object {column: {value: pct}}; converted into "
        "--baseline when that does not exist yet",
    )
    q.add_argument(
        "--refresh-baseline",
        action="store_true",
        help="compare with the stored baseline, then replace it by this run's shares",
    )
    q.add_argument("--report", required=True)
    q.add_argument("--report-format", default="parquet", help="e.g. json for readable lines")
    q.add_argument("--threshold", type=float, default=None)

    k = sub.add_parser("peek", help="columns, types, row and non-null counts, sample rows")
    common(k)
    k.add_argument("--out", default=None, help="also write the column profile here")
    k.add_argument("--sample", type=int, default=5)

    f = sub.add_parser("profile", help="values of purpose and state with their counts")
    common(f)
    f.add_argument("--out", required=True)
    f.add_argument("--columns", nargs="+", default=["purpose", "addr_state"])
    f.add_argument("--top", type=int, default=None, help="only so many values per column")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"loanframe-{args.job}").getOrCreate()
    if args.job in ("batch", "quality"):
        targets = (args.checkpoint, args.ratio, args.curve)
        if (any(targets) if args.release else not all(targets)):
            raise SystemExit(f"{args.job}: pass either --release or --checkpoint, --ratio and --curve")
    released = args.job == "batch" and args.release
    raw = None
    if args.raw:
        files = {"file_column": rules.FILE_COLUMN} if released else {}
        raw = read_raw_csv(spark, args.raw, partitions=args.partitions, **files)
    if released:
        publish_batch(spark, raw, args.release, checkpoint_partition_by=args.partition_by)
    elif args.job == "batch":
        res = run_batch(
            spark,
            raw,
            args.checkpoint,
            args.ratio,
            args.curve,
            output_format=args.format,
            as_tables=args.as_tables,
            checkpoint_partition_by=args.partition_by,
            stage_raw=args.stage_raw,
            stats_path=args.stats,
        )
        require_non_empty(
            spark, {"npl_ratio": res.npl_ratio, "vintage_curve": res.default_rate_curve}
        )
    elif args.job == "quality":
        newest = read_release(spark, args.release) if args.release else None
        if args.release and newest is None:
            raise SystemExit(f"quality: no release under {args.release}")
        if not args.stats and raw is None and newest is None:
            raise SystemExit("quality: pass --raw, --stats or --release")

        def output(target):
            if args.as_tables:
                return target  # a catalog table name, counted by output_row_counts
            return spark.read.format(args.format).load(target)

        if newest is not None:
            checkpoint = newest.checkpoint
            outputs = {"npl_ratio": newest.npl_ratio, "vintage_curve": newest.default_rate_curve}
        else:
            checkpoint = read_checkpoint(spark, args.checkpoint)
            outputs = {"npl_ratio": output(args.ratio), "vintage_curve": output(args.curve)}
        if args.baseline_json and load_baseline(spark, args.baseline) is None:
            legacy = load_json_baseline(spark, args.baseline_json)
            if legacy is not None:
                save_baseline(legacy, args.baseline)
        kwargs = {} if args.threshold is None else {"threshold_pct": args.threshold}
        kwargs["refresh_baseline"] = args.refresh_baseline
        if args.stats:
            kwargs["batch_stats"] = spark.read.parquet(args.stats)
        elif newest is not None and raw is None:
            kwargs["batch_stats"] = newest.stats
        res = run_quality(
            spark,
            raw,
            checkpoint,
            outputs,
            args.baseline,
            **kwargs,
        )
        write_table(res.report, args.report, args.report_format)
    elif args.job == "peek":
        raw = raw.drop(rules.CORRUPT_COLUMN)
        profile = dataset_profile(raw)
        if args.out:
            write_table(profile, args.out)
            profile = spark.read.parquet(args.out)
        # Display only: one row per column, and a few sample rows.
        profile.orderBy("ordinal").show(len(raw.columns), truncate=False)
        sample_rows(raw, args.sample).show(args.sample, truncate=50, vertical=True)
    else:
        kwargs = {} if args.top is None else {"k": args.top}
        write_table(run_profiling(raw, args.columns, **kwargs), args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
