"""Run one stage, or all of them, on stored tables.

    spark-submit <this file> all --base hdfs:///lake --raw hdfs:///landing
"""

from __future__ import annotations

import argparse
import sys

from siltstone.config import Layout, RunConfig
from siltstone.operators.checks import QualityGateError
from siltstone.operators.metrics import preview
from siltstone.plans.gold import CATEGORY, DAILY, LOCATION, MONTHLY
from siltstone.plans.run import run_pipeline, run_report
from siltstone.plans.stages import aggregate, clean, ingest, validate
from siltstone.presets import taxi
from siltstone.session import session, size_shuffles
from siltstone.sources.paths import folder_bytes
from siltstone.sources.tables import read_table


def written_tables(cfg: RunConfig, stage: str) -> list[str]:
    """Paths of the tables that a stage writes rows of data to."""
    out = cfg.layout
    by_stage = {
        "ingest": [out.bronze],
        "clean": [out.silver, out.rejects],
        "validate": [],
        "aggregate": [out.gold_table(t) for t in (DAILY, LOCATION, MONTHLY, CATEGORY)],
    }
    return by_stage[stage] if stage in by_stage else sum(by_stage.values(), [])


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="siltstone")
    parser.add_argument("stage", choices=("ingest", "clean", "validate", "aggregate", "all"))
    parser.add_argument("--base", required=True, help="folder of the tables")
    parser.add_argument("--raw", help="folder of the raw files (default: <base>/raw)")
    parser.add_argument("--fmt", default="parquet", help="table format")
    parser.add_argument("--batch-id", help="id of the ingested batch (default: the time)")
    parser.add_argument("--as-of", help="latest event time accepted (default: now)")
    parser.add_argument("--min-rows", type=int, default=1_000_000)
    parser.add_argument("--evolve", action="store_true", help="let files bring new columns")
    parser.add_argument("--preview", type=int, default=0, help="show rows of each table")
    args = parser.parse_args(argv)

    spark = session(f"siltstone-{args.stage}")
    layout = Layout.under(args.base, args.raw)
    cfg = RunConfig(taxi(args.min_rows), layout, args.fmt, evolve=args.evolve)
    # What cleaning shuffles is about what bronze holds, compressed as it is there; what
    # is about to be ingested comes on top.
    size_shuffles(spark, sum(folder_bytes(spark, p) for p in (layout.bronze, layout.raw)))
    stages = {
        "ingest": lambda: ingest(spark, cfg, args.batch_id),
        "clean": lambda: clean(spark, cfg, args.as_of),
        "validate": lambda: validate(spark, cfg),
        "aggregate": lambda: aggregate(spark, cfg),
        "all": lambda: run_pipeline(spark, cfg, args.batch_id, args.as_of),
    }
    try:
        rows = stages[args.stage]()
    except QualityGateError as e:
        print(e, file=sys.stderr)
        return 1
    run_report(spark, rows).show(truncate=False)
    if args.preview:
        for path in written_tables(cfg, args.stage):
            print(path)
            preview(read_table(spark, path, cfg.fmt, cfg.evolve), args.preview).show()
    return 0


if __name__ == "__main__":
    sys.exit(main())
