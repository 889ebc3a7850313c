"""Command line: build, explain or run a report from a nested vars file.

    spark-submit --py-files spendlens.zip report_cli.py run --vars vars.yaml --service S --model M --kind platform
    python -m spendlens explain --vars vars.json --service S --model M --kind campaign

The vars file is JSON, or YAML when PyYAML is installed. ``--run-ts`` pins the run time
(ISO format) used for ``current_datetime()``-style freshness values.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime

from pyspark.sql import SparkSession

from .config import spec_from_vars
from .plans import build, run_report
from .plans.reports import BUILDERS
from .session import apply_defaults, cluster_settings
from .spec import STITCH_MODES


def load_vars(path: str) -> dict:
    text = open(path, encoding="utf-8").read()
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:  # pragma: no cover - optional dependency
            raise SystemExit("PyYAML is not installed; give the vars as JSON") from e
        return yaml.safe_load(text) or {}
    return json.loads(text)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="spendlens",
                                 description="Build, explain or run a report from a vars file.")
    ap.add_argument("command", choices=["run", "explain", "schema"],
                    help="run: write (and republish) the report; explain: print the physical "
                         "plan; schema: print the declared output schema")
    ap.add_argument("--vars", required=True, help="nested vars file (JSON, or YAML)")
    ap.add_argument("--service", required=True, help="top-level key of the service")
    ap.add_argument("--model", required=True, help="key under <service>.models")
    ap.add_argument("--kind", required=True, choices=sorted(BUILDERS), help="report builder")
    ap.add_argument("--run-ts", default=None,
                    help="run time for current_datetime()-style freshness (ISO format)")
    ap.add_argument("--stitch", default=None, choices=STITCH_MODES,
                    help="how the multi-fact report joins its facts (default: as the source)")
    ap.add_argument("--history-order", default=None,
                    help="keep the newest version per id by this column (multi-fact report)")
    ap.add_argument("--history-tiebreak", default=None,
                    help="comma-separated columns that break ties between versions")
    ap.add_argument("--largest-shuffle-gb", type=float, default=None,
                    help="size the session for a shuffle of so many GB (cluster_settings)")
    args = ap.parse_args(argv)
    chosen = {"stitch": args.stitch, "history_order": args.history_order,
              "history_tiebreak": tuple(args.history_tiebreak.split(",")) if args.history_tiebreak else None}
    run_ts = datetime.fromisoformat(args.run_ts) if args.run_ts else None
    spec = spec_from_vars(load_vars(args.vars), args.service, args.model, args.kind, run_ts,
                          **{k: v for k, v in chosen.items() if v is not None})
    if args.command == "schema":
        print(spec.schema().simpleString())
        return 0
    spark = apply_defaults(SparkSession.builder.appName(f"spendlens-{args.model}").getOrCreate())
    if args.largest_shuffle_gb:
        for k, v in cluster_settings(int(args.largest_shuffle_gb * (1 << 30))).items():
            spark.conf.set(k, v)
    if args.command == "explain":
        build(spark, args.kind, spec).explain("formatted")
        return 0
    print(json.dumps(run_report(spark, args.kind, spec)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
