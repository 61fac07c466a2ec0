"""Command line: run the digest job over landed messages.

    python -m mailsift run --messages <folder of .eml | message table.parquet> \\
        --out <shared folder> [--recent 10] [--senders a@x.org,b@y.org] \\
        [--today-only --run-date 2025-11-19 --tz Europe/Paris] \\
        [--keywords "lithium, solid electrolyte"] [--backend echo]

Settings follow the source tool's configuration: comma-separated keyword
and sender lists (normalised like its environment lists), ``--recent 0``
meaning every message. The Spark session comes from ``spark-submit`` (or a
local one when run directly); outputs are partitioned by report date.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from mailsift.functions.params import DEFAULT_TERMS, normalise_term_list
from mailsift.operators.extract import (
    DEFAULT_LINK_CONTAINS, DEFAULT_LINK_PREFIXES, DEFAULT_MIN_TITLE_LEN,
)
from mailsift.plans.digest import DigestParams
from mailsift.plans.run import run_digest
from mailsift.sources import read_messages


def build_parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="mailsift")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="build digests from landed messages")
    run.add_argument("--messages", required=True, help="folder of .eml files or a parquet table")
    run.add_argument("--out", required=True, help="output folder (shared file system)")
    run.add_argument("--recent", type=int, default=10, help="latest N messages, 0 = all")
    run.add_argument("--senders", default="", help="comma-separated allow-list (empty = all)")
    run.add_argument("--today-only", action="store_true")
    run.add_argument("--run-date", default=None, help="report date, default today")
    run.add_argument("--tz", default="UTC", help="local time zone for --today-only")
    run.add_argument("--keywords", default=DEFAULT_TERMS,
                     help="comma-separated terms; '' passes every item")
    run.add_argument("--backend", default="echo")
    run.add_argument("--temperature", type=float, default=0.2)
    run.add_argument("--max-output-tokens", type=int, default=10_000)
    run.add_argument("--min-title-len", type=int, default=DEFAULT_MIN_TITLE_LEN)
    run.add_argument("--link-prefixes", default=",".join(DEFAULT_LINK_PREFIXES))
    run.add_argument("--link-contains", default=",".join(DEFAULT_LINK_CONTAINS))
    run.add_argument("--extractor", choices=("parser", "native"), default="parser",
                     help="parser: enclosing-block abstracts; native: JVM regex, no abstracts")
    return ap


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    run_date = args.run_date or dt.date.today().isoformat()
    spark = SparkSession.getActiveSession() or SparkSession.builder.appName("mailsift").getOrCreate()
    msgs = read_messages(spark, args.messages).withColumn("report_date",
                                                          F.to_date(F.lit(run_date)))
    senders = [s.strip().lower() for s in args.senders.split(",") if s.strip()] or None
    params = DigestParams(
        recent=args.recent, senders=senders, today_only=args.today_only, run_date=run_date,
        tz=args.tz, terms=normalise_term_list(args.keywords), min_len=args.min_title_len,
        prefixes=tuple(p for p in args.link_prefixes.split(",") if p),
        contains=tuple(c for c in args.link_contains.split(",") if c),
        extractor=args.extractor)
    stamp = dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    paths = run_digest(msgs, params, args.out, stamp, backend=args.backend,
                       options={"temperature": args.temperature,
                                "max_output_tokens": args.max_output_tokens})
    print(json.dumps(paths))
    return 0


if __name__ == "__main__":
    sys.exit(main())
