"""Requests to a store from inside a task: one after the other while it answers at once, by threads when it does not."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Any

from .store import THREADS

#: A request that takes longer (seconds) is slow, and threads take over after so many slow ones in a row. Quicker ones are
#: mostly Python's own work, in which threads only wait for each other: 16 of them write local objects at half the pace of one.
SLOW, IN_A_ROW = 0.004, 4


class Requests:
    """Used as a context; the threads end with it."""

    def __init__(self, threads: int = THREADS):
        self.threads, self.slow, self.pool = threads, 0, None

    def __enter__(self):
        return self

    def __exit__(self, *_) -> None:
        if self.pool:
            self.pool.shutdown()

    def at_once(self, call: Callable[[Any], Any], values: list) -> list:
        """Answers to the first values: all of them, unless the store turns out to be slow."""
        answers = []
        for value in values:
            if self.slow >= IN_A_ROW:
                break
            start = time.perf_counter()
            answers.append(call(value))
            self.slow = self.slow + 1 if time.perf_counter() - start > SLOW else 0
        return answers

    def map(self, call: Callable[[Any], Any], values: list) -> list:
        """Answers to all values, in their order."""
        from concurrent.futures import ThreadPoolExecutor

        answers = self.at_once(call, values)
        if len(answers) < len(values):
            self.pool = self.pool or ThreadPoolExecutor(self.threads)
            answers += self.pool.map(call, values[len(answers):])
        return answers
