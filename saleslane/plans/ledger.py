"""What the stages of a day have finished, so that the next run goes on where the last one stopped.

An entry holds a key made of everything that the stage's outcome depends on: the versions or files of
its input, and its options. A stage is done if its entry has the same key, and its outputs are still
the versions that it wrote.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from saleslane.jvm import Files
from saleslane.plans.stage import StageMetrics
from saleslane.sources.publish import current
from saleslane.sources.tables import layer_path

# Goes up when a stage gives other results for the same input and options.
FORMAT = 1


def fingerprint(spark: SparkSession, path: str) -> str | None:
    """The version of a published folder, or a hash of the names, sizes and times of its files.

    The files are listed by Spark and not opened. None if there is no such folder.
    """
    version = current(spark, path).version
    if version is not None:
        return version
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    mark = F.xxhash64("path", "length", "modificationTime")
    # the order of the files does not matter
    row = files.agg(
        F.count(F.lit(1)), F.sum("length"), F.bit_xor(mark), F.sum(F.shiftrightunsigned(mark, 20))
    ).first()
    return "-".join(map(str, row))


@dataclass(frozen=True)
class Finished:
    """The counts of a finished stage, and why it stopped the run if it did."""

    metrics: list[StageMetrics]
    stopped: str | None


class Ledger:
    """The entries of one date, one small file for each stage. Without handles of the JVM it is empty."""

    def __init__(self, spark: SparkSession, base: str, date: str):
        self.spark, self.date = spark, date
        self.folder = layer_path(base, "run_ledger", date)
        self.files = Files.of(spark, base)

    def key(self, stage: str, inputs: Sequence[str], options: Mapping[str, object]) -> str:
        found = {path: fingerprint(self.spark, path) for path in inputs}
        about = [FORMAT, stage, self.date, found, {k: str(v) for k, v in options.items()}]
        return hashlib.sha256(json.dumps(about, sort_keys=True).encode()).hexdigest()

    def _versions(self, outputs: Sequence[str]) -> list[str | None]:
        return [current(self.spark, path).version for path in outputs]

    def finished(self, stage: str, key: str, outputs: Sequence[str]) -> Finished | None:
        """What a run with the same key has recorded, if its outputs are there."""
        text = self.files and self.files.read(f"{self.folder}/{stage}.json")
        entry = json.loads(text) if text else {}
        if entry.get("key") != key or None in entry["outputs"]:
            return None
        if entry["outputs"] != self._versions(outputs):
            return None
        return Finished([StageMetrics(**m) for m in entry["metrics"]], entry["stopped"])

    def record(
        self,
        stage: str,
        key: str,
        outputs: Sequence[str],
        metrics: Sequence[StageMetrics] = (),
        stopped: str | None = None,
    ) -> None:
        if self.files is None:
            return
        entry = {
            "key": key,
            "outputs": self._versions(outputs),
            "metrics": [asdict(m) for m in metrics],
            "stopped": stopped,
        }
        self.files.write(f"{self.folder}/{stage}.json", json.dumps(entry))
