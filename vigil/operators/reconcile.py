"""Counts of what each step of a job saw, taken while the job runs.

A job that filters, skips and quarantines should account for every row it read. The counts
are observed metrics (``DataFrame.observe``): aggregates that ride along with the
job's own pass, so nothing is read a second time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "step string, metric string, n long"


class Counts:
    """Observed counts of the steps of one job; filled once the job has run."""

    def __init__(self):
        self._steps: list[tuple[str, Observation]] = []

    def on(self, df: DataFrame, step: str, **metrics: Column) -> DataFrame:
        """``df`` with aggregates to observe under ``step``."""
        seen = Observation(f"{step}-{uuid.uuid4().hex}")
        self._steps.append((step, seen))
        return df.observe(seen, *[c.alias(k) for k, c in metrics.items()])

    def of(self, step: str) -> dict[str, int]:
        return {k: int(v or 0) for name, seen in self._steps if name == step for k, v in seen.get.items()}

    def frame(self, spark: SparkSession) -> DataFrame:
        """(step, metric, n): a handful of rows, however large the job was."""
        return spark.createDataFrame([(s, k, n) for s, _ in self._steps for k, n in self.of(s).items()], SCHEMA)


def rows() -> Column:
    return F.count(F.lit(1))


def unaccounted(counts: Counts, step: str, whole: str, parts: list[tuple[str, str]]) -> int:
    """What ``whole`` of ``step`` has more than the ``parts`` (step, metric) together; 0 if every row is accounted for."""
    return counts.of(step)[whole] - sum(counts.of(s)[k] for s, k in parts)
