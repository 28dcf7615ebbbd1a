"""Counts of the records that a job drops, and why.

A job that passes over records with unparsable fields says how many it read, kept and
dropped for each reason. The counts are taken as the rows stream by (``Dataset.observe``):
no further pass, no shuffle; they are there as soon as the job's first action has ended.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

READ, KEPT = "read", "kept"


class DropCounts:
    """Filled by the jobs that take it as ``counts``; one entry for each source of a job."""

    def __init__(self) -> None:
        self._seen: dict[str, tuple[Observation, list[str]]] = {}

    def keep(self, rows: DataFrame, checks: Mapping[str, Column], source: str = "records") -> DataFrame:
        """The rows that pass all ``checks``; a dropped row counts for the first check that it fails."""
        return _kept(rows, checks, self._observe(source, [READ, KEPT, *checks]))

    def note(self, rows: DataFrame, sums: Mapping[str, Column], source: str = "records") -> DataFrame:
        """All rows; how many there are, and the sum of each number over them."""
        observation = self._observe(source, [READ, *sums])
        return rows.observe(observation, F.count(F.lit(1)).alias("m0"), *[F.coalesce(F.sum(c), F.lit(0)).alias(f"m{i}") for i, c in enumerate(sums.values(), 1)])

    def _observe(self, source: str, names: list[str]) -> Observation:
        observation = Observation()
        self._seen[source] = (observation, names)
        return observation

    def get(self) -> dict[str, dict[str, int]]:
        """By source: records read and kept, and dropped for each reason (waits for the first action)."""
        return {source: {name: int(seen.get[f"m{i}"]) for i, name in enumerate(names)} for source, (seen, names) in self._seen.items()}


def _kept(rows: DataFrame, checks: Mapping[str, Column], observation: Observation) -> DataFrame:
    before, counts = F.lit(True), []
    for check in checks.values():
        passed = F.coalesce(check, F.lit(False))
        counts.append(F.count_if(before & ~passed))
        before = before & passed
    metrics = [F.count(F.lit(1)), F.count_if(before), *counts]
    return rows.observe(observation, *[m.alias(f"m{i}") for i, m in enumerate(metrics)]).where(before)


def kept_rows(rows: DataFrame, checks: Mapping[str, Column], counts: DropCounts | None, source: str = "records") -> DataFrame:
    """The rows that pass all ``checks``, counted if ``counts`` is given."""
    if counts is not None:
        return counts.keep(rows, checks, source)
    passed = F.lit(True)
    for check in checks.values():
        passed = passed & F.coalesce(check, F.lit(False))
    return rows.where(passed)
