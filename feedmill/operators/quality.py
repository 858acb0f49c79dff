"""Gates and counters around the steps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


REPEATED = "more than one row"


class TooFewRows(ValueError):
    """A step gave less than the next one needs."""


def require_rows(df: DataFrame, n: int = 1) -> DataFrame:
    """``df`` itself, or an error when it has fewer than ``n`` rows."""
    found = df.limit(n).count()
    if found < n:
        raise TooFewRows(f"{found} rows where {n} are needed")
    return df


def one_row_per(df: DataFrame, key: str) -> DataFrame:
    """``df`` itself, which fails while it runs if a key occurs twice.

    The count needs the rows by key, as a join on the key does, so ahead of
    such a join it adds no shuffle and no extra job.
    """
    rows = F.count(F.lit(1)).over(Window.partitionBy(key))
    message = F.concat(F.lit(f"{REPEATED}: {key} "), F.col(key).cast("string"))
    once = F.when(F.col("_rows") == 1, F.col(key)).otherwise(F.raise_error(message))
    return df.withColumn("_rows", rows).where(once.isNotNull() | F.col(key).isNull()).drop("_rows")


def counted(df: DataFrame, observation: Observation, conditions: Mapping[str, Column]) -> DataFrame:
    """Count rows by condition while ``df`` runs; read them from ``observation.get``."""
    return df.observe(observation, *[F.count_if(c).alias(n) for n, c in conditions.items()])


class RunCounters:
    """Named observations of one run, several of which may sit in one plan; read when the sinks have ended."""

    def __init__(self) -> None:
        self._held: dict[str, Observation] = {}

    def watch(self, name: str) -> Observation:
        """A new observation; its counts come from the pass that its plan runs anyway."""
        if name in self._held:
            raise ValueError(f"{name} is observed already")
        self._held[name] = Observation(name)
        return self._held[name]

    def counts(self) -> dict[str, dict[str, int]]:
        """Counts by name and condition.  It waits for plans that have not run, so ask after the last sink."""
        return {name: dict(seen.get) for name, seen in self._held.items()}


KEPT = "kept"


def first_failure(guards: Mapping[str, Column]) -> Column:
    """Name of the first guard that does not hold, ``kept`` when all of them do."""
    cause = F.lit(KEPT)
    for name, holds in reversed(guards.items()):
        cause = F.when(holds, cause).otherwise(name)
    return cause
