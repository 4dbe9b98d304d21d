"""Command line: one job, or all jobs of a day.

    python -m saleslane ingestion --input-path RAW --output-path OUT --date DAY
    python -m saleslane day --base FOLDER --date DAY
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from saleslane.functions.columns import MONEY_SCALE
from saleslane.plans.daily import STAGES, run_day
from saleslane.plans.ingestion import run_ingestion
from saleslane.plans.quality import run_quality
from saleslane.plans.stage import metrics_table
from saleslane.plans.transformation import run_transformation
from saleslane.session import create_spark_session

WRITERS = {"ingestion": run_ingestion, "transformation": run_transformation}


def add_options(job: argparse.ArgumentParser, name: str) -> None:
    """The options of a job; a day has those of all its jobs."""
    day = name == "day"
    job.add_argument("--date", required=True)
    job.add_argument("--schema", type=StructType.fromDDL, help="columns of the raw sales, as DDL")
    if day or name == "ingestion":
        job.add_argument("--by-position", action="store_true", help="do not compare headers")
    if day or name == "transformation":
        job.add_argument("--money-scale", type=int, default=MONEY_SCALE)
    if day or name == "quality":
        job.add_argument("--as-of", help="time that dates must not be after")
        job.add_argument("--allow-unreadable", action="store_true")


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="saleslane")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in STAGES:
        job = jobs.add_parser(name)
        job.add_argument("--input-path", required=True)
        add_options(job, name)
        if name in WRITERS:
            job.add_argument("--output-path", required=True)
        if name == "ingestion":
            job.add_argument("--rejected-path", help="where to keep the lines that are not usable")
    day = jobs.add_parser("day", help="all stages on <base>/<layer>/<date>")
    day.add_argument("--base", required=True)
    add_options(day, "day")
    day.add_argument("--stages", nargs="+", choices=STAGES, default=STAGES)
    day.add_argument("--allow-empty", action="store_true")
    day.add_argument("--min-completeness", type=float)
    day.add_argument("--keep-rejected", action="store_true")
    day.add_argument("--lifetime", action="store_true", help="totals count earlier days")
    day.add_argument("--no-resume", dest="resume", action="store_false")
    day.add_argument("--retries", type=int, default=0)
    day.add_argument("--retry-wait", type=float, default=0.0, help="seconds")
    return parser.parse_args(argv)


JOBS = {"day": run_day, "quality": run_quality, **WRITERS}


def main(argv: Sequence[str] | None = None) -> None:
    options = vars(arguments(argv))
    job = options.pop("job")
    shared = SparkSession.getActiveSession() is not None
    spark = create_spark_session(f"saleslane-{job}")
    try:
        done = JOBS[job](spark, **options)
        if job in WRITERS:
            done = metrics_table(spark, done)
        done.show(truncate=False)
    finally:
        if not shared:
            spark.stop()


if __name__ == "__main__":
    main()
