"""Numbers that a job's own run counts, by observed metrics: no second pass over the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class Counters:
    """Row counts of the places of a plan that were watched; known after the plan's action.

    A place should run once: below a shuffle, or above a sort, whose ranges Spark samples by running what
    lies below it. Tasks that are run again after a lost executor may count their rows again.
    """

    def __init__(self) -> None:
        self._watched: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, its rows counted as ``name``; places of one name are added up."""
        seen = Observation()
        self._watched.append((name, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def values(self) -> dict[str, int]:
        """Counts by name. Call it after the action."""
        found: dict[str, int] = {}
        for name, seen in self._watched:
            found[name] = found.get(name, 0) + seen.get["rows"]
        return found
