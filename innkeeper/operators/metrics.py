"""Rows in and out of every cleaning step, observed while the step's result is written.

A filter or lookup is observed in front and behind.  A dedup's input is gone behind it, so its kept rows carry how many rows
they stand for (``copies``), whose sum is the input; no step is read a second time to be counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "step string, rows_in bigint, rows_out bigint, dropped bigint"
COPIES = "_copies"


class StepMetrics:
    """Collects the steps of one load; ``rows`` waits for the jobs that observe them."""

    def __init__(self) -> None:
        self._steps: dict[str, dict[str, tuple[Observation, str] | int]] = {}

    def _observe(self, df: DataFrame, step: str, **sums) -> DataFrame:
        watch = Observation(f"{step}:{'+'.join(sums)}")
        for name in sums:
            self._steps.setdefault(step, {})[name] = (watch, name)
        return df.observe(watch, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in sums.items()])

    def before(self, df: DataFrame, step: str) -> DataFrame:
        return self._observe(df, step, rows_in=F.count(F.lit(1)))

    def after(self, df: DataFrame, step: str, kept: F.Column | None = None) -> DataFrame:
        """``kept``: of which rows the step counts as its output (default: all)."""
        return self._observe(df, step, rows_out=F.count(F.lit(1)) if kept is None else F.count_if(kept))

    def deduplicated(self, df: DataFrame, step: str) -> DataFrame:
        """``df`` has a ``COPIES`` column, which goes."""
        return self._observe(df, step, rows_in=F.sum(COPIES), rows_out=F.count(F.lit(1))).drop(COPIES)

    def known(self, step: str, **rows: int) -> None:
        self._steps.setdefault(step, {}).update(rows)

    def rows(self) -> list[dict]:
        out = []
        for step, found in self._steps.items():
            n = {k: v if isinstance(v, int) else int(v[0].get[v[1]]) for k, v in found.items()}
            out.append({"step": step, "rows_in": n["rows_in"], "rows_out": n["rows_out"], "dropped": n["rows_in"] - n["rows_out"]})
        return out


def metrics_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """``(step, rows_in, rows_out, dropped)``, a row per step."""
    return spark.createDataFrame([(r["step"], r["rows_in"], r["rows_out"], r["dropped"]) for r in rows], SCHEMA)
