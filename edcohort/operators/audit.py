"""Row and column counts of each step of a build.

The counts come from tables that the build makes anyway: rows per code (for the frequent codes), the rows that each first
result stands for, and checkpointed tables; the results are not scanned again, and counts are exact also when
tasks ran twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class StepAudit:
    """Steps in the order in which they were recorded."""

    def __init__(self):
        self.steps: list[tuple[str, int, int]] = []

    def step(self, name: str, n_rows: int, df: DataFrame) -> None:
        self.steps.append((name, int(n_rows or 0), len(df.columns)))

    def table(self, spark: SparkSession) -> DataFrame:
        """(position, step, n_rows, n_columns)."""
        return spark.createDataFrame([(k, *s) for k, s in enumerate(self.steps)], "position int, step string, n_rows long, n_columns int")
