"""Command line for the jobs, for ``spark-submit`` or ``python -m``:

    spark-submit tidewater/submit.py engine-profile --input /data/readings/ \\
        --table profile_by_engine --output /data/profile/

Each sub-command builds (or joins) a session and runs one job.  Jobs that
read or write tables use the lasting catalog (the Hive metastore that the
session is configured for), so a later process finds the tables an earlier
one made; ``--catalog in-memory`` gives one that ends with the process.
``--location`` puts a new table's files in a folder of the shared store.
Topic credentials are read from a ``key=value`` file given with
``--options-file``, never from the command line or the code.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):  # run as a script by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.session import session  # noqa: E402


def _options_file(path: str | None) -> dict[str, str]:
    opts: dict[str, str] = {}
    if not path:
        return opts
    with open(path, encoding="utf-8") as fh:
        for line in fh:
            line = line.strip()
            if line and not line.startswith("#") and "=" in line:
                key, value = line.split("=", 1)
                opts[key.strip()] = value.strip()
    return opts


def _topic(args: argparse.Namespace, subscribe: bool = True) -> dict[str, str]:
    from tidewater.sources.topic import topic_options

    cap = getattr(args, "max_offsets_per_batch", None)
    return topic_options(args.servers, args.topic, security=_options_file(args.options_file), subscribe=subscribe, max_offsets_per_batch=cap)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewater", description="Run one tidewater job.")
    sub = p.add_subparsers(dest="job", required=True)

    j = sub.add_parser("daily-extremes", help="M3: readings CSV -> daily extremes appended to a table")
    j.add_argument("--csv", required=True)
    j.add_argument("--table", required=True)
    j.add_argument("--location", help="folder for the table's files")
    j.add_argument("--rejects", help="table for rows that cannot be read; without it they stop the job")

    j = sub.add_parser("temperature-load", help="M5: full load on the first run, last n days after")
    j.add_argument("--csv", required=True)
    j.add_argument("--full-table", required=True)
    j.add_argument("--incremental-table", required=True)
    j.add_argument("--days", type=int, default=3)
    j.add_argument("--key", nargs="+", help="key columns that make the incremental append idempotent")
    j.add_argument("--location", help="folder for the tables' files (a sub-folder each)")
    j.add_argument("--rejects", help="table for rows that cannot be read; without it they stop the job")

    j = sub.add_parser("engine-profile", help="M12: engine readings -> external profile table")
    j.add_argument("--input", required=True)
    j.add_argument("--table", required=True)
    j.add_argument("--output", required=True)

    j = sub.add_parser("passengers", help="M11: passenger CSV -> adults as Parquet")
    j.add_argument("--csv", required=True)
    j.add_argument("--output", required=True)

    for name, help_text in (("pets-table", "M1: JSON column -> pet rows"), ("foods-table", "M2: XML column -> food rows")):
        j = sub.add_parser(name, help=help_text)
        j.add_argument("--source-table", required=True)
        j.add_argument("--target-table", required=True)
        j.add_argument("--location", help="folder for the target's files")

    j = sub.add_parser("replicate", help="M18: five JSON collections -> tables and marts")
    j.add_argument("--folder", required=True)
    j.add_argument("--database")
    j.add_argument("--location")
    j.add_argument("--rejects", help="table for lines that cannot be read; without it they stop the job")

    j = sub.add_parser("rebuild-marts", help="M9, M10: both marts from the loaded orders")
    j.add_argument("--database")
    j.add_argument("--location")

    j = sub.add_parser("check-keys", help="K18: key and reference checks over the loaded tables")
    j.add_argument("--database")

    j = sub.add_parser("preview-marts", help="M17: first rows of each mart")
    j.add_argument("--tables", nargs="+", required=True)
    j.add_argument("-n", type=int, default=10)

    for name, help_text in (
        ("topic-to-csv", "M14: bounded topic read -> flat CSV"),
        ("stream-to-csv", "M15: topic stream drained once -> flat CSV"),
        ("stream-to-text", "M16: topic stream drained once -> text lines"),
    ):
        j = sub.add_parser(name, help=help_text)
        j.add_argument("--servers", required=True)
        j.add_argument("--topic", required=True)
        j.add_argument("--options-file")
        j.add_argument("--output", required=True)
        if name != "topic-to-csv":
            j.add_argument("--drained", required=True)
            j.add_argument("--checkpoint", required=True)
            j.add_argument("--max-offsets-per-batch", type=int, help="cap on offsets per micro-batch of the drain")

    for name, help_text in (("send-rows", "M13: table rows as JSON messages to a topic"), ("send-nested", "M19: table rows as nested JSON messages to a topic")):
        j = sub.add_parser(name, help=help_text)
        j.add_argument("--source-table", required=True)
        j.add_argument("--servers", required=True)
        j.add_argument("--topic", required=True)
        j.add_argument("--options-file")
        if name == "send-nested":
            j.add_argument("--layout", required=True, help="JSON file: field -> column name, or field -> object of such fields")
    for name in TABLE_JOBS:
        sub.choices[name].add_argument("--catalog", choices=("hive", "in-memory"), default="hive")
    return p


# Jobs that read or write catalog tables.
TABLE_JOBS = (
    "daily-extremes", "temperature-load", "engine-profile", "pets-table", "foods-table", "replicate", "rebuild-marts",
    "check-keys", "preview-marts", "send-rows", "send-nested",
)


def _prefix(args: argparse.Namespace) -> str:
    return f"{args.database}." if args.database else ""


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    hive = getattr(args, "catalog", None) == "hive"
    spark = session(f"tidewater-{args.job}", hive=hive, legacy_parquet=args.job == "engine-profile")
    result: object = None
    if args.job == "daily-extremes":
        from tidewater.plans.weather import run_daily_extremes

        run_daily_extremes(spark, args.csv, args.table, args.location, rejects=args.rejects)
        result = args.table
    elif args.job == "temperature-load":
        from tidewater.plans.weather import run_full_or_incremental

        at = {f"{k}_path": f"{args.location.rstrip('/')}/{t}" for k, t in (("full", args.full_table), ("incremental", args.incremental_table))} if args.location else {}
        result = run_full_or_incremental(spark, args.csv, args.full_table, args.incremental_table, days=args.days, keys=args.key, rejects=args.rejects, **at)
    elif args.job == "engine-profile":
        from tidewater.plans.engines import run_engine_profile

        run_engine_profile(spark, args.input, args.table, args.output)
        result = args.table
    elif args.job == "passengers":
        from tidewater.plans.passengers import run_passengers

        run_passengers(spark, args.csv, args.output)
        result = args.output
    elif args.job == "pets-table":
        from tidewater.plans.documents import run_pets_table

        result = run_pets_table(spark, args.source_table, args.target_table, path=args.location)
    elif args.job == "foods-table":
        from tidewater.plans.documents import run_foods_table

        result = run_foods_table(spark, args.source_table, args.target_table, path=args.location)
    elif args.job == "replicate":
        from tidewater.plans.delivery import run_replication

        counts = run_replication(spark, args.folder, database=args.database, location=args.location, rejects=args.rejects)
        result = {r["table_name"]: r["row_count"] for r in counts.collect()}
    elif args.job == "rebuild-marts":
        from tidewater.plans.delivery import rebuild_marts

        p = _prefix(args)
        marts = (f"{p}mart_customer_activity", f"{p}mart_restaurant_performance")
        rebuild_marts(spark, f"{p}orders", marts, args.location)
        result = list(marts)
    elif args.job == "check-keys":
        from tidewater.plans.delivery import key_report

        result = {r["check_name"]: r["bad_rows"] for r in key_report(spark, _prefix(args)).collect()}
    elif args.job == "preview-marts":
        from tidewater.plans.delivery import preview_marts

        for name, df in preview_marts(spark, args.tables, n=args.n).items():
            print(f"== {name}")
            if isinstance(df, Exception):
                print(f"failed: {df}")
            else:
                df.show(args.n, truncate=False)
    elif args.job == "topic-to-csv":
        from tidewater.plans.messages import run_messages_to_csv
        from tidewater.sources.topic import read_topic

        run_messages_to_csv(spark, read_topic(spark, _topic(args)), args.output)
        result = args.output
    elif args.job in ("stream-to-csv", "stream-to-text"):
        from tidewater.plans.messages import run_stream_to_csv, run_stream_to_text
        from tidewater.sources.topic import stream_topic

        sdf = stream_topic(spark, _topic(args))
        if args.job == "stream-to-csv":
            run_stream_to_csv(spark, sdf, args.output, args.drained, args.checkpoint)
        else:
            run_stream_to_text(sdf, args.output, args.drained, args.checkpoint)
        result = args.output
    elif args.job == "send-rows":
        from tidewater.plans.messages import send_rows

        send_rows(spark.table(args.source_table), _topic(args, subscribe=False))
        result = args.topic
    elif args.job == "send-nested":
        from tidewater.plans.messages import send_nested

        with open(args.layout, encoding="utf-8") as fh:
            layout = json.load(fh)
        send_nested(spark.table(args.source_table), layout, _topic(args, subscribe=False))
        result = args.topic
    if result is not None:
        print(json.dumps({"job": args.job, "result": result}, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
