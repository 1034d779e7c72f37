"""Figures of a write, counted while it writes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation


def written_counts(rows: DataFrame, *counts: Column, write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Write the rows and return aggregates of them, without reading anything back.

    The figures come from the tasks that write.  Spark takes one result per task of a job's last stage, so a retried or
    speculative task does not count twice.  Aggregates are named by their aliases; counts of no rows are 0.
    The rows should belong to a session in which no models are fitted: see ``sibling_session``.
    """
    seen = Observation()
    write(rows.observe(seen, *counts))
    return {name: 0 if n is None else n for name, n in seen.get.items()}
