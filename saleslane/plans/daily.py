"""The daily run: the three jobs in order on the folders of one date."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from saleslane.functions.columns import MONEY_SCALE
from saleslane.jvm import Files
from saleslane.operators.precheck import (
    InputRejected,
    require_completeness,
    require_headers,
    require_rows,
)
from saleslane.plans.ingestion import run_ingestion
from saleslane.plans.ledger import Ledger
from saleslane.plans.quality import DATASETS, CriticalFailure, QualityFailure, run_quality
from saleslane.plans.stage import StageMetrics, metrics_table
from saleslane.plans.transformation import run_transformation
from saleslane.sources.sinks import write_report
from saleslane.sources.tables import layer_path, read_sales_csv

log = logging.getLogger(__name__)
T = TypeVar("T")

# Folder of the totals over days.
TOTALS = "customer_totals"
STAGES = ("ingestion", "transformation", "quality")


def validate_input(
    spark: SparkSession,
    path: str,
    min_completeness: float | None = None,
    schema: StructType | None = None,
    by_position: bool = False,
    allow_empty: bool = False,
) -> None:
    """Refuse raw input whose files have other columns or another order, or that has no rows.

    Both need only the first lines of the files. ``min_completeness`` also checks the key columns,
    which takes a pass over the whole input.
    """
    if not by_position:
        require_headers(spark, path, schema and schema.fieldNames())
    raw = read_sales_csv(spark, path, schema)
    if not allow_empty:
        require_rows(raw, path)
    if min_completeness is not None:
        require_completeness(raw, min_completeness, table_name=path)


def save_metrics(
    spark: SparkSession, metrics: Sequence[StageMetrics], base: str, date: str
) -> Sequence[StageMetrics]:
    """Keep the counts of one stage in ``run_metrics/<date>/<stage>``."""
    folder = f"{layer_path(base, 'run_metrics', date)}/{metrics[0].stage}"
    write_report(metrics_table(spark, metrics), folder)
    return metrics


@dataclass
class Step:
    """One stage of a day: what its outcome depends on, what it writes, and how to run it."""

    name: str
    inputs: Sequence[str]
    options: Mapping[str, object]
    outputs: Sequence[str]
    run: Callable[[], Sequence[StageMetrics]]
    repeatable: bool = True


# A run that fails so fails again; other errors may pass.
FINAL = (InputRejected, QualityFailure, ValueError)


def retried(name: str, run: Callable[[], T], retries: int, wait: float) -> T:
    """The result of ``run``, which is tried again after errors that may pass."""
    for left in reversed(range(retries + 1)):
        try:
            return run()
        except FINAL:
            raise
        except Exception as error:
            if not left:
                raise
            log.warning("%s failed, trying again, %d tries left: %s", name, left, error)
            time.sleep(wait)
    raise ValueError("retries must not be negative")


def run_step(step: Step, ledger: Ledger, resume: bool, retries: int, wait: float) -> Sequence[StageMetrics]:
    """Run a step, or take its counts from the ledger if it has finished with the same input and options."""
    key = ledger.key(step.name, step.inputs, step.options)
    done = ledger.finished(step.name, key, step.outputs) if resume and step.repeatable else None
    if done is not None:
        log.info("%s has finished before", step.name)
        if done.stopped is not None:
            raise CriticalFailure(done.stopped)
        return done.metrics
    try:
        metrics = retried(step.name, step.run, retries, wait)
    except CriticalFailure as failure:
        ledger.record(step.name, key, step.outputs, stopped=str(failure))
        raise
    ledger.record(step.name, key, step.outputs, metrics)
    return metrics


def earlier_totals(spark: SparkSession, base: str, date: str) -> str | None:
    """The totals of the last date before this one that has any."""
    folder = f"{base.rstrip('/')}/{TOTALS}"
    files = Files.of(spark, folder)
    before = [d for d in (files.names(folder) if files else []) if not d.startswith(".") and d < date]
    return f"{folder}/{before[-1]}" if before else None


def run_day(
    spark: SparkSession,
    base: str,
    date: str,
    stages: Sequence[str] = STAGES,
    as_of=None,
    min_completeness: float | None = None,
    schema: StructType | None = None,
    money_scale: int | None = MONEY_SCALE,
    by_position: bool = False,
    allow_empty: bool = False,
    allow_unreadable: bool = False,
    keep_rejected: bool = False,
    lifetime: bool = False,
    resume: bool = True,
    retries: int = 0,
    retry_wait: float = 0.0,
) -> DataFrame:
    """Run the chosen stages of one date in order; the first failure stops the run.

    A day in which no row is usable gives empty tables; ``allow_empty`` lets a day without any row
    pass too. ``keep_rejected`` writes the lines that are not usable to the ``rejected`` folder of the
    date. ``lifetime`` lets totals and tiers count earlier days that ran with it. The other options
    are those of the jobs.

    A stage that has finished with the same input and options is not run again (``resume``), so a
    run after a failure goes on with the stage that failed; quality is one of those only with an
    ``as_of``, as its rules follow the clock. A stage that fails is tried again up to ``retries``
    times, ``retry_wait`` seconds later, unless its input or its checks are the reason.

    Returns the row counts of the written outputs, which are also saved per stage in the
    ``run_metrics`` folder of the date. The session is left running.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {', '.join(sorted(unknown))}")
    raw, processed, transformed, rejected, totals = (
        layer_path(base, layer, date) for layer in ("raw", "processed", "transformed", "rejected", TOTALS)
    )
    before = earlier_totals(spark, base, date) if lifetime else None
    tables = [f"{transformed}/{name}" for name in DATASETS]
    shape = {"schema": schema and schema.json()}

    def ingestion() -> Sequence[StageMetrics]:
        validate_input(spark, raw, min_completeness, schema, by_position, allow_empty)
        # the headers have been checked
        done = run_ingestion(
            spark, raw, processed, date, schema=schema, by_position=True,
            rejected_path=rejected if keep_rejected else None,
        )
        return save_metrics(spark, done, base, date)

    def transformation() -> Sequence[StageMetrics]:
        done = run_transformation(
            spark, processed, transformed, date, schema=schema, money_scale=money_scale,
            earlier_totals=before, totals_path=totals if lifetime else None,
        )
        return save_metrics(spark, done, base, date)

    def quality() -> Sequence[StageMetrics]:
        run_quality(spark, transformed, date, as_of, allow_unreadable, schema)
        return []

    checks = {"by_position": by_position, "allow_empty": allow_empty, "min_completeness": min_completeness}
    steps = [
        Step(
            "ingestion", [raw], {**shape, **checks, "keep_rejected": keep_rejected},
            [processed, rejected] if keep_rejected else [processed], ingestion,
        ),
        Step(
            "transformation", [processed, before] if before else [processed],
            {**shape, "money_scale": money_scale, "lifetime": lifetime},
            [*tables, totals] if lifetime else tables, transformation,
        ),
        Step(
            "quality", tables, {**shape, "as_of": as_of, "allow_unreadable": allow_unreadable},
            [f"{transformed}/quality_results", f"{transformed}/data_profiles"], quality,
            repeatable=as_of is not None,
        ),
    ]
    ledger = Ledger(spark, base, date)
    metrics: list[StageMetrics] = []
    for step in steps:
        if step.name in stages:
            metrics += run_step(step, ledger, resume, retries, retry_wait)
    return metrics_table(spark, metrics)
