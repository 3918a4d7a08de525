"""Totals that Spark takes while a plan runs, so that a check needs no pass of its own."""

from __future__ import annotations

import time
from typing import Any

from pyspark.sql import Observation


def observed(seen: Observation, seconds: float = 10.0) -> dict[str, Any] | None:
    """What an observation saw in an action that has ended, or None if Spark dropped its place from the plan.

    The values arrive shortly after the action. An adaptive plan may lose the place, as where one side turns out empty;
    the caller then counts by itself.
    """
    done = seen._jo.future()
    until = time.monotonic() + seconds
    while not done.isCompleted():
        if time.monotonic() > until:
            return None
        time.sleep(0.01)
    return seen.get if seen._jo.getRow().size() else None
