"""Circuit breaker and supervised restarts, for the driver's calls out of Spark."""

from __future__ import annotations

import random
import time
from collections.abc import Callable

from tidemark.functions.timing import jittered


class Open(RuntimeError):
    """The breaker refuses calls."""


class CircuitBreaker:
    """Opens at a share of failures over some calls, refuses for a while, then lets one call try."""

    def __init__(self, least: int = 3, share: float = 0.6, cool_seconds: float = 10.0, clock: Callable[[], float] = time.monotonic):
        self.least, self.share, self.cool, self.clock = least, share, cool_seconds, clock
        self.state, self.calls, self.failures, self.opened = "closed", 0, 0, 0.0

    def call(self, run: Callable):
        if self.state == "open":
            if self.clock() - self.opened < self.cool:
                raise Open("circuit open")
            self.state = "half-open"
        try:
            out = run()
        except Exception:
            self.calls, self.failures = self.calls + 1, self.failures + 1
            if self.state == "half-open" or (self.calls >= self.least and self.failures >= self.share * self.calls):
                self.state, self.opened, self.calls, self.failures = "open", self.clock(), 0, 0
            raise
        if self.state == "half-open":
            self.state, self.calls, self.failures = "closed", 0, 0
        else:
            self.calls += 1
        return out


def supervise(run: Callable[[], None], stop: Callable[[], bool], base: float = 1.0, cap: float = 60.0, steady: float = 10.0, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic, draw: Callable[[], float] = random.random) -> int:
    """Runs again after failures with growing waits; a run that lasted `steady` seconds starts the count anew. Returns restarts."""
    failures = restarts = 0
    while not stop():
        began = clock()
        try:
            run()
            return restarts
        except Exception:
            failures = 1 if clock() - began >= steady else failures + 1
            restarts += 1
            sleep(min(cap, jittered(min(cap, base * 2 ** (failures - 1)) * 1000, draw(), 0.1) / 1000))
    return restarts
