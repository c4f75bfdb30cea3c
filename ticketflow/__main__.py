"""``python -m ticketflow RAW_CSV OUT_DIR [--database DB]`` (or via spark-submit).

Runs the whole batch pipeline over raw request CSV(s); outputs go under
OUT_DIR. Uses the active/configured session (``getOrCreate``), so cluster
settings come from spark-submit; ``--local N`` starts a local session.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="ticketflow")
    ap.add_argument("raw", help="raw request CSV file or directory")
    ap.add_argument("out", help="output directory (shared filesystem on a cluster)")
    ap.add_argument("--database", default=None, help="register catalog tables in this database")
    ap.add_argument("--multiline", action="store_true",
                    help="quoted fields hold line breaks (each file is then read by one task)")
    ap.add_argument("--local", default=None, help="run on local[N] instead of the configured master")
    args = ap.parse_args(argv)

    from ticketflow.plans import flow
    from ticketflow.session import ensure_checkpoint_dir, local_session

    spark = local_session(args.local) if args.local else SparkSession.builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    st = flow.run_pipeline(spark, args.raw, args.out, database=args.database,
                           multiline=args.multiline)
    print(json.dumps({"rows_per_stage": st.counts}))


if __name__ == "__main__":
    main()
