"""A least gap between calls of a whole cluster, not of a process.

Time is cut into slots; slot k belongs to lane k mod lanes, and a lane is one
partition, so that no two calls ever share a slot and nothing has to be asked or
locked. A call begins within `slack` after its slot's begin, or waits for the
lane's next slot: two calls are never closer than the gap. It holds as far as the
machines' clocks agree (add their difference to `slack`); a retried partition goes
on in its lane. Speculative execution runs a lane twice and must be off."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Pace:
    """gap_seconds between any two calls; so many lanes call at a time at most."""

    gap_seconds: float
    lanes: int = 8
    slack: float = 0.05
    clock: Callable[[], float] = time.time
    sleep: Callable[[float], None] = time.sleep

    def slot(self, lane: int, now: float) -> float:
        """When the lane may call next: the begin of its first slot after now. One that has begun may have been used."""
        width = self.gap_seconds + self.slack
        turn = width * self.lanes
        begin = lane % self.lanes * width
        return begin + ((now - begin) // turn + 1) * turn

    def wait(self, lane: int | None = None) -> None:
        """Sleep until a slot of this lane; by default that of the running partition."""
        if self.gap_seconds <= 0:
            return
        if lane is None:
            context = TaskContext.get()
            lane = context.partitionId() if context else 0
        while True:
            now = self.clock()
            at = self.slot(lane, now)
            self.sleep(at - now)
            if 0 <= self.clock() - at <= self.slack:
                return


def lanes(rows: DataFrame, pace: Pace) -> DataFrame:
    """rows dealt to the lanes of pace: one partition each, evenly. What calls must follow without another shuffle."""
    if pace.gap_seconds <= 0:
        return rows
    if rows.sparkSession.conf.get("spark.speculation", "false") == "true":
        raise ValueError("a least gap between calls needs spark.speculation=false")
    return rows.repartition(pace.lanes)


def paced(function: Callable, pace: Pace) -> Callable:
    """function that waits for a slot before each call, tries again included."""

    def run(*args):
        pace.wait()
        return function(*args)

    return run
