"""What a stage of a run was made from, so that a later run knows whether it may take it over.

A stage's manifest names its settings and what it was made from: digests of input files and the fingerprints of earlier stages. Its own
fingerprint covers both, so a change of an input or a setting reaches every stage after it. It is taken away before a stage is written
and put there after it, so a run that ended in the middle leaves no stage that looks whole.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STALE = ("refuse", "redo")


class StaleStage(RuntimeError):
    """A stage that should be taken over was made from something else, or never finished."""


def digest(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()


def files_digest(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files below a path; contents are not read, and one row comes back."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    row = files.agg(F.count("*"), F.sum("length"), F.sum(mark).cast("string")).first()
    return digest(list(row))


def table_digest(df: DataFrame) -> str:
    """Number of rows, and a sum of row hashes in any order."""
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    return digest([df.columns, *df.agg(F.count("*"), F.sum(mark).cast("string")).first()])


@dataclass
class Stages:
    """The manifests below a results folder.

    ``resume`` takes over every stage that would come out the same. A stage the caller wants taken over anyway (``skip``) keeps its own
    settings, but has to come from the same inputs and earlier stages; if it does not, it is refused, or made again with ``stale="redo"``.
    """

    spark: SparkSession
    folder: str
    resume: bool = False
    stale: str = "refuse"
    actions: list[tuple[str, str]] = field(default_factory=list)

    def __post_init__(self):
        if self.stale not in STALE:
            raise ValueError(f"unknown treatment '{self.stale}' of stale stages, expected one of {', '.join(STALE)}")

    def _path(self, stage: str) -> str:
        return f"{self.folder}/manifests/{stage}"

    def read(self, stage: str) -> dict | None:
        """The manifest of a finished stage."""
        try:
            rows = self.spark.read.text(self._path(stage)).take(1)
        except AnalysisException:
            return None
        return json.loads(rows[0][0]) if rows and rows[0][0] else None

    def _write(self, stage: str, text: str) -> None:
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(self._path(stage))

    def reuse(self, stage: str, made_from: dict, settings: dict, skip: bool = False) -> str | None:
        """The fingerprint of the stored stage if it is to be taken over; otherwise the stage counts as unfinished from now on."""
        held = self.read(stage)
        same = held is not None and held["made_from"] == made_from
        if same and (skip or (self.resume and held["settings"] == digest(settings))):
            self.actions.append((stage, "taken over"))
            return held["fingerprint"]
        if skip and self.stale == "refuse":
            if held is None:
                why = "was never finished"
            else:
                both = sorted(set(held["made_from"]) | set(made_from))
                why = "was made from another " + ", ".join(k for k in both if held["made_from"].get(k) != made_from.get(k))
            raise StaleStage(f"stage {stage} in {self.folder} {why}")
        self._write(stage, "")
        self.actions.append((stage, "made"))
        return None

    def commit(self, stage: str, made_from: dict, settings: dict) -> str:
        """Marks a stage as finished; its fingerprint."""
        mark = digest([made_from, settings])
        self._write(stage, json.dumps({"made_from": made_from, "settings": digest(settings), "fingerprint": mark}))
        return mark
