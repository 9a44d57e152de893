"""Resumable runs: every stage's artifact is written once, and found again by a later attempt.

A run is known by a fingerprint of its parameters and of its input files (path, size, time of last
change). Each stage leaves its artifact and, after that, a mark: one row with the fingerprint, the
seconds the stage took and what else it tells. A later attempt of the same run reads the artifacts
of marked stages and starts with the first one that is not; another input or parameter starts afresh. The
mark of a stage is cleared before its artifact is overwritten, so a run that breaks in the middle of a
write never counts as done. Stage tables that a run needs on the way go when it ends, also if it fails.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyrec.sources.tables import read_artifact, write_artifact

MARK = "stage string, fingerprint string, seconds double, facts string"


def files_of(table: DataFrame) -> DataFrame:
    """(file, size, changed) of the files a table is read from."""
    return table.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("changed"),
    ).distinct()


def fingerprint(tables: Sequence[DataFrame], *settings: object) -> str:
    """A digest of settings and input files; one row per table reaches the driver."""
    seen = []
    for table in tables:
        row = F.xxhash64("file", "size", "changed").cast("decimal(38,0)")
        found = files_of(table).agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("sum")).first()
        seen.append((found["n"], str(found["sum"]), table.schema.simpleString()))
    return hashlib.sha256(repr((seen, settings)).encode()).hexdigest()


class Run:
    """Stages of one run below ``out``; ``name`` tells runs that share a folder apart."""

    def __init__(
        self, spark: SparkSession, out: str, name: str, inputs: Sequence[DataFrame], *settings: object
    ) -> None:
        self.spark = spark
        self.out = out
        self.name = name
        self.key = fingerprint(inputs, *settings)
        self.written: list[str] = []

    def _mark(self, stage: str) -> str:
        return f"marks/{self.name}/{stage}"

    def _known(self, stage: str) -> dict | None:
        """The mark of a stage if it belongs to this run and its artifact is there."""
        try:
            rows = read_artifact(self.spark, self.out, self._mark(stage)).collect()  # one row
        except AnalysisException:
            return None
        if len(rows) != 1 or rows[0]["fingerprint"] != self.key:
            return None
        return rows[0].asDict()

    def _set_mark(self, stage: str, key: str, seconds: float, facts: dict) -> None:
        row = [(stage, key, seconds, json.dumps(facts, sort_keys=True))]
        write_artifact(self.spark.createDataFrame(row, MARK).coalesce(1), self.out, self._mark(stage))

    def stage(
        self,
        stage: str,
        build: Callable[[], DataFrame | tuple[DataFrame, dict]],
        partition_by: Sequence[str] = (),
    ) -> DataFrame:
        """The artifact ``stage``: read if this run has written it before, else built and written.

        ``build`` may return facts about the stage with its rows.
        """
        if self._known(stage) is None:
            self._set_mark(stage, "", 0.0, {})
            start = time.monotonic()
            built = build()
            rows, facts = built if isinstance(built, tuple) else (built, {})
            write_artifact(rows, self.out, stage, partition_by)
            self._set_mark(stage, self.key, time.monotonic() - start, facts)
            self.written.append(stage)
        return read_artifact(self.spark, self.out, stage)

    def facts(self, stage: str) -> dict:
        """What a finished stage has told, with its ``seconds``."""
        mark = self._known(stage) or {"facts": "{}", "seconds": None}
        return json.loads(mark["facts"]) | {"seconds": mark["seconds"]}
