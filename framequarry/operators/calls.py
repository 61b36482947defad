"""Calls to slow services from inside a task: a sliding window of them, with the answers in row order."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from typing import Any

#: Batches whose rows may wait for the slowest call among them; then no new call is made until the first is answered.
OPEN_BATCHES = 4


def windowed(batches: Iterator, column: str | None, call: Callable[[Any], Any], in_flight: int) -> Iterator[tuple[Any, list]]:
    """Each Arrow batch with the answers of `call` to its rows (a column's values, or whole rows), in order.

    The next row is taken up when any call ends, so one slow call holds up no other, also across batches; at most
    `in_flight` calls run at a time, and no more rows than that are being read. `call` must not raise. Should the
    rows' source fail, the calls under way are waited for before the error goes on.
    """
    from concurrent.futures import ThreadPoolExecutor
    from queue import SimpleQueue

    running: dict = {}
    ended: SimpleQueue = SimpleQueue()
    held: deque = deque()  # [batch, answers, how many are missing], in order

    def collect() -> None:
        future = ended.get()
        entry, row = running.pop(future)
        entry[1][row] = future.result()
        entry[2] -= 1

    def ready() -> Iterator[tuple[Any, list]]:
        while held and not held[0][2]:
            batch, answers, _ = held.popleft()
            yield batch, answers

    with ThreadPoolExecutor(in_flight) as pool:
        for batch in batches:
            if not batch.num_rows:
                continue
            while len(held) >= OPEN_BATCHES:
                collect()
                yield from ready()
            entry = [batch, [None] * batch.num_rows, batch.num_rows]
            held.append(entry)
            for row, value in enumerate(batch.column(column).to_pylist() if column else batch.to_pylist()):
                if len(running) >= in_flight:
                    collect()
                    yield from ready()
                future = pool.submit(call, value)
                running[future] = entry, row
                future.add_done_callback(ended.put)
        while held:
            if held[0][2]:
                collect()
            yield from ready()
