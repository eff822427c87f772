"""Command line: ``spark-submit`` or ``python -m daybook run --run-date 2026-08-03 ...``"""

from __future__ import annotations

import argparse
import os

from daybook.functions.dates import parse_run_date, resolve_run_date
from daybook.plans import pipeline
from daybook.sources.readers import PORTFOLIO_FORMS
from daybook.sources.session import create_session
from daybook.streaming.jobs import DailyJob, run_on_arrival


def parse_args(args: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="daybook", description=__doc__)
    parser.add_argument("job", choices=["run", "load", "models", "stream", "contracts", "freshness", "views"])
    parser.add_argument("--run-date", type=parse_run_date, nargs="+", default=[],
                        help="one or more dates, YYYY-MM-DD; without it the logical date")
    parser.add_argument("--logical-date", type=parse_run_date, help="the scheduler's date of this run")
    parser.add_argument("--in-root", help="folder or bucket of the feeds")
    parser.add_argument("--out-root", help="folder or bucket of the outputs")
    parser.add_argument("--warehouse", help="folder or bucket of the warehouse tables")
    parser.add_argument("--run-id", default="manual")
    parser.add_argument("--checkpoint", help="folder that remembers the files a stream has seen")
    parser.add_argument("--portfolio-form", choices=list(PORTFOLIO_FORMS), default="documents")
    parser.add_argument("--quarantine", action="store_true",
                        help="set rows aside that break a table's contract, do not fail the load")
    parser.add_argument("--s3-endpoint", default=os.getenv("S3_ENDPOINT"))
    parser.add_argument("--s3-region", default=os.getenv("S3_REGION", "us-east-1"))
    parser.add_argument("--s3-access-key", default=os.getenv("S3_ACCESS_KEY"))
    parser.add_argument("--s3-secret-key", default=os.getenv("S3_SECRET_KEY"))
    options = parser.parse_args(args)
    if not options.run_date and options.logical_date:
        options.run_date = [resolve_run_date(None, options.logical_date)]
    required = {
        "run": ["run_date", "in_root", "out_root"],
        "load": ["run_date", "out_root", "warehouse"],
        "models": ["warehouse"],
        "stream": ["in_root", "out_root", "warehouse", "checkpoint"],
        "contracts": ["warehouse"],
        "freshness": ["warehouse"],
        "views": ["warehouse"],
    }
    absent = [name for name in required[options.job] if not getattr(options, name)]
    if absent:
        parser.error("missing: " + ", ".join("--" + name.replace("_", "-") for name in absent))
    return options


def object_store(options: argparse.Namespace) -> dict[str, str] | None:
    """The s3a settings, where an endpoint is given."""
    if not options.s3_endpoint:
        return None
    if not options.s3_access_key or not options.s3_secret_key:
        raise ValueError("An object store endpoint needs an access key and a secret key.")
    return {
        "endpoint": options.s3_endpoint,
        "endpoint.region": options.s3_region,
        "access.key": options.s3_access_key,
        "secret.key": options.s3_secret_key,
    }


def main(args: list[str] | None = None) -> None:
    options = parse_args(args)
    spark = create_session(f"daybook-{options.job}", object_store(options))
    if options.job == "run":
        metrics = pipeline.run_pipeline(
            spark, options.in_root, options.out_root, options.run_date, portfolio_form=options.portfolio_form
        )
        metrics.show(truncate=False, vertical=True)
    elif options.job == "load":
        pipeline.load_warehouse(
            spark, options.out_root, options.warehouse, options.run_date, options.run_id,
            quarantine=options.quarantine,
        )
    elif options.job == "stream":
        job = DailyJob(
            options.in_root, options.out_root, options.warehouse, options.run_id,
            portfolio_form=options.portfolio_form,
        )
        run_on_arrival(spark, job, options.checkpoint)
    elif options.job == "views":
        for name, view in pipeline.monitoring_views(spark, options.warehouse, maintained=True).items():
            print(name)
            view.show(truncate=False)
    else:
        checks = {
            "models": pipeline.build_models,
            "contracts": pipeline.contract_report,
            "freshness": pipeline.freshness_report,
        }[options.job](spark, options.warehouse)
        # A stale table warns before it is an error.
        failed = checks.where("status not in ('pass', 'warn')").collect()
        if failed:
            raise SystemExit(f"Checks of {options.job} failed:\n" + "\n".join(str(row) for row in failed))


if __name__ == "__main__":
    main()
