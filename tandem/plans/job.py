"""The daily reporting job: build the eight marts in dependency order, each
written whole (replacing the previous day's table) and read back by the marts
that depend on it.

Order (the reference's real read edges, not its declared ones):
  reorder info, delivery staging, refund detail, utilisation
  -> ticket info (reads staging), refunds summary and order counts (read refund detail)
  -> pooling summary (reads reorder info, staging and ticket info)

Reading a written mart back cuts the lineage, so an executor lost in a later
mart never recomputes an earlier one.  The three marts that the summary joins on the
delivery id are stored in buckets of that id, so those joins read them without an
exchange.  A mart whose columns or types would change is refused unless
``--allow-schema-change`` is given.

Usage: python -m tandem.plans.job --inputs <paths.json> --out <folder> [--as-of 2024-05-01]
       python -m tandem.plans.job --sf-dir /root/testdata/sf0.1 --out <folder> [--as-of 2001-08-02]

``paths.json`` maps every input name of :mod:`tandem.sources.catalog` to a
Parquet path or glob; the run date is then today unless given.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import os
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ..sources.catalog import INPUTS, Catalog, parquet_catalog
from ..sources.sink import Commit, current, overwrite_mart, read_commit
from . import refunds, reorders, staging, summary, tickets, utilisation
from .params import FIXTURE_PARAMS, ReportParams

# Output table (folder) name of each mart.
MART_NAMES = {
    "reorder_info": "reorder_info",
    "delivery_staging": "delivery_staging",
    "ticket_info": "ticket_info",
    "pooling_summary": "pooling_summary",
    "refund_detail": "refund_detail",
    "refunds_summary": "refunds_summary",
    "order_counts": "order_counts",
    "utilisation": "utilisation",
}


# How the per-delivery marts are laid out: by order date for readers that filter on
# it, or by delivery id for the summary's joins.
DATE_PARTITIONED = {"refund_detail": ["order_date"]}
BY_DELIVERY = {"reorder_info", "delivery_staging", "ticket_info"}


def build_all(spark: SparkSession, cat: Catalog, p: ReportParams, out_root: str, log=print,
              buckets: int = 0, allow_schema_change: bool = False, tolerant: bool = False) -> dict[str, Commit]:
    """Builds and writes every mart under ``out_root``; returns name -> commit.

    ``buckets`` (default: the number of shuffle partitions) is the number of files of
    a bucketed mart, about its size over 256 MB at scale.  With ``tolerant`` tickets
    whose order number is no number are written to ``ticket_info_rejected`` instead of
    ending the job."""
    commits: dict[str, Commit] = {}

    def write(key: str, df: DataFrame) -> DataFrame:
        t0 = time.perf_counter()
        name = MART_NAMES.get(key, key)
        before = None if allow_schema_change else current(spark, out_root, name)
        commit = overwrite_mart(df, out_root, name, schema=before and before.schema,
                                partition_by=DATE_PARTITIONED.get(key, ()),
                                bucket_by=["sys_delivery_id"] if key in BY_DELIVERY else (), buckets=buckets)
        commits[key] = commit
        log(f"{key}: written in {time.perf_counter() - t0:.1f}s")
        return read_commit(spark, commit)  # this job's own rows, whatever is committed meanwhile

    m1 = write("reorder_info", reorders.build(cat, p))
    m2 = write("delivery_staging", staging.build(cat, p))
    m5 = write("refund_detail", refunds.refund_detail(cat, p))
    write("utilisation", utilisation.build(cat, p))
    m3 = write("ticket_info", tickets.build(cat, p, m2, tolerant=tolerant))
    if tolerant:
        write("ticket_info_rejected", tickets.rejected_tickets(cat))
    write("refunds_summary", refunds.refunds_summary(m5, p))
    write("order_counts", refunds.order_counts(m5, p))
    write("pooling_summary", summary.build(cat, spark, m2, m1, m3))
    return commits


def read_paths(file: str) -> dict[str, str]:
    """Input name -> path from a JSON file; every input must be named."""
    with open(file, encoding="utf-8") as f:
        paths = json.load(f)
    missing = [n for n in INPUTS if n not in paths]
    if missing:
        raise ValueError(f"{file} names no path for {', '.join(missing)}")
    return paths


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    source = ap.add_mutually_exclusive_group(required=True)
    source.add_argument("--inputs", help="JSON file: input name -> Parquet path or glob")
    source.add_argument("--sf-dir", help="driver tables to derive the inputs from")
    ap.add_argument("--out", required=True, help="folder the marts are written to")
    ap.add_argument("--as-of", type=_dt.date.fromisoformat,
                    help="run date (default: today; with --sf-dir the fixture's run date)")
    ap.add_argument("--buckets", type=int, default=0, help="files of a mart stored by delivery id (default: shuffle partitions)")
    ap.add_argument("--allow-schema-change", action="store_true", help="accept marts whose columns or types have changed")
    ap.add_argument("--tolerant", action="store_true", help="set tickets aside whose order number is no number")
    args = ap.parse_args(argv)
    from ..session import local_session
    spark = SparkSession.getActiveSession() or local_session()
    if args.inputs:
        cat, p = parquet_catalog(spark, read_paths(args.inputs)), ReportParams(as_of=args.as_of or _dt.date.today())
    else:
        from ..sources.adapter import driver_catalog
        cat = driver_catalog(spark, args.sf_dir)
        p = replace(FIXTURE_PARAMS, as_of=args.as_of or FIXTURE_PARAMS.as_of)
    out = args.out if "://" in args.out else os.path.abspath(args.out)
    build_all(spark, cat, p, out, buckets=args.buckets, allow_schema_change=args.allow_schema_change, tolerant=args.tolerant)


if __name__ == "__main__":
    main()
