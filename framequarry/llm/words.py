"""Words of whole texts as arrays: positions and 64-bit hashes, computed on the UTF-8 bytes of an Arrow column.

All delimiters used here are ASCII, so bytes can be classified one by one and a word never ends inside a character.
A word's hash is a polynomial over random byte weights modulo 2**64, then mixed; equal words have equal hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is a chunk of its own.
CHUNK = 2 << 20
_BLOCK = 1 << 18

_random = np.random.default_rng(20240229)
_WEIGHT = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C13
_BACK = pow(_STEP, -1, 2**64)
_ROLL = np.uint64(0xD1342543DE82EF95)


def _powers(base: int, n: int) -> np.ndarray:
    found = np.full(n, base, np.uint64)
    found[0] = 1
    return np.multiply.accumulate(found)


_tables: dict[str, np.ndarray] = {}  # made where they are used: functions travel to executors with what stands here


def _step_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse, for more than `size` bytes."""
    if len(_tables.get("up", ())) <= size:
        _tables["up"], _tables["down"] = (_powers(base, max(2 * size, _BLOCK) + 1) for base in (_STEP, _BACK))
    return _tables["up"], _tables["down"]


class Rule(NamedTuple):
    """What belongs to a word, by byte, and the byte that stands for it."""

    inside: np.ndarray
    folded: np.ndarray


def rule(inside: Callable[[int], bool], lower: bool = False) -> Rule:
    return Rule(
        np.array([inside(b) for b in range(256)]),
        np.array([b + 32 if lower and 65 <= b <= 90 else b for b in range(256)], np.uint8),
    )


def _not_blank(b: int) -> bool:
    return b != 0x20 and not 0x09 <= b <= 0x0D


#: `[^\x20\x09-\x0D]+`, as written or with A-Z in lower case.
PLAIN = rule(_not_blank)
LOWERED = rule(_not_blank, lower=True)
#: ASCII letters and digits and everything beyond ASCII, A-Z in lower case.
ALNUM = rule(lambda b: b >= 0x80 or chr(b).isalnum(), lower=True)


class Texts(NamedTuple):
    """Some consecutive texts: their bytes, where each begins and ends, and the rows they stand in."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    """One entry per word: its hash, the text it is in, and its bytes in `Texts.data`."""

    hash: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray  # words of text i are bounds[i]:bounds[i + 1]


def texts(column: pa.Array) -> Iterator[Texts]:
    """Chunks of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, where, held = column.buffers()
    offsets = np.frombuffer(where, np.int64, len(column) + 1 + column.offset)[column.offset :]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.empty(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CHUNK, "right")) - 1)
        yield Texts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], lo)
        lo = hi


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans_hash(folded: np.ndarray, start: np.ndarray, end: np.ndarray, heads: tuple[int, ...] = ()) -> np.ndarray:
    """Hash of each byte span (sorted, not overlapping), block by block so that memory stays bounded.

    With `heads`, one row per number of bytes: the hashes of the spans' first so many bytes, then a row of the whole spans.
    """
    found = np.empty((len(heads) + 1, len(start)), np.uint64)
    i = 0
    while i < len(start):
        base = int(start[i])
        j = max(i + 1, int(np.searchsorted(end, base + _BLOCK, "right")))
        size = int(end[j - 1]) - base
        up, down = _step_tables(size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_WEIGHT[folded[base : base + size]] * up[:size], out=sums[1:])
        a, b = start[i:j] - base, end[i:j] - base
        for row, head in enumerate((*heads, size)):
            stop = np.minimum(a + head, b)
            found[row, i:j] = (sums[stop] - sums[a]) * down[a] + (stop - a).astype(np.uint64)
        i = j
    return mixed(found) if heads else mixed(found[0])


def words(chunk: Texts, how: Rule) -> Words:
    inside = how.inside[chunk.data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = chunk.offsets[1:-1]
    here = edges[(edges > 0) & (edges < len(inside))]
    opens[here] = inside[here]
    closes[here - 1] = inside[here - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    bounds = np.searchsorted(start, chunk.offsets)
    text = np.repeat(np.arange(chunk.n), np.diff(bounds))
    return Words(spans_hash(how.folded[chunk.data], start, end), text, start, end, bounds)


def windows(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of `k` words within one text."""
    n = len(found.hash) - k + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = total * _ROLL + found.hash[i : i + n]
    whole = found.text[:n] == found.text[k - 1 :]
    return np.flatnonzero(whole), mixed(total[whole] + np.uint64(k))


def sequence_hash(hashes: np.ndarray) -> int:
    """The hash `windows` gives to a run of these words."""
    total = 0
    for h in hashes.tolist():
        total = (total * int(_ROLL) + h) % 2**64
    return int(mixed(np.array([(total + len(hashes)) % 2**64], np.uint64))[0])
