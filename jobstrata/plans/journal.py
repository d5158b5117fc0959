"""A journal of finished steps, so that a run goes on behind its last good layer.

An entry says what a step read and wrote: a hash of its inputs and settings, and the version of
its output. Versions are hashes of the listed files, by name, length and time of writing. A
step is left out when its newest entry was made from the same inputs and settings and what it
wrote is still there as it was. Entries are appended, one small file each; a run that is cut off
while it writes one has merely not finished that step.
"""

from __future__ import annotations

import hashlib
import json
import time
from dataclasses import asdict, dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from jobstrata.operators.fingerprint import Fingerprint

_SCHEMA = "step string, inputs string, output string, finished double, report string"


def folder_version(spark: SparkSession, path: str) -> str:
    """A version of the files below ``path``, which are listed, not opened; empty without any."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(path)
            .select(F.substring_index("path", "/", -1).alias("name"), "modificationTime", "length")
            .where("NOT startswith(name, '_') AND NOT startswith(name, '.')")
        )
    except AnalysisException:
        return ""
    row = files.agg(
        F.bit_xor(F.xxhash64("name", "length", "modificationTime")).alias("hash"),
        F.count(F.lit(1)).alias("files"),
    ).first()
    return f"{row['files']}-{row['hash']}" if row["files"] else ""


def inputs_hash(**parts) -> str:
    """A hash of whatever decides a step's result."""
    text = json.dumps(parts, sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()


@dataclass(frozen=True)
class Journal:
    spark: SparkSession
    path: str

    def _entry(self, step: str):
        try:
            entries = self.spark.read.schema(_SCHEMA).json(self.path)
        except AnalysisException:
            return None
        return entries.where(F.col("step") == step).orderBy(F.desc("finished")).first()

    def finished(self, step: str, inputs: str, output_path: str) -> dict | None:
        """The report of ``step``, if it need not run again."""
        entry = self._entry(step)
        if entry is None or entry["inputs"] != inputs or not entry["output"]:
            return None
        if folder_version(self.spark, output_path) != entry["output"]:
            return None
        return json.loads(entry["report"])

    def record(self, step: str, inputs: str, output_path: str, report) -> None:
        output = folder_version(self.spark, output_path)
        row = (step, inputs, output, time.time(), json.dumps(asdict(report)))
        entry = self.spark.createDataFrame([row], _SCHEMA)
        entry.coalesce(1).write.mode("append").json(self.path)


def as_report(kind, told: dict):
    """A report as ``record`` was given it."""
    report = kind(**told)
    both = {
        name: Fingerprint(*told[name])
        for name in ("content", "content_read_back")
        if told.get(name) is not None
    }
    return replace(report, **both)
