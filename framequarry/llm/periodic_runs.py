"""Op 13: find stretches of words that repeat with a period, and collapse each to its first period.

A qualifying run holds each of its words three times at least, so a word that occurs more rarely in a segment is in none of
the segment's runs and splits it. Its pieces are counted anew until no word splits any more. What survives is scanned for
lags: for each doubling of a window's size, the distance from a window to its next copy is the period of any run around it
whose period is at most that size and more than half of it, so every smallest period is found, and no multiple of one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .registry import batch, let, map_batches, query, read, renamed
from .words import PLAIN, mixed, texts, words

#: A run has at least so many words, and so many times its period.
LEAST_WORDS, LEAST_REPEATS = 24, 3
_ROLL = np.uint64(0xD1342543DE82EF95)


def surviving_segments(hashes: np.ndarray, bounds: np.ndarray, least_words: int, least_repeats: int) -> list[tuple[int, int]]:
    """(lo, hi) of the stretches of words that may hold runs, of texts that begin and end at `bounds`; each is within a text.

    All segments of all texts are counted at once; a segment that a round leaves whole is done.
    """
    at = np.arange(len(hashes))
    segment = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    done: list[tuple[int, int]] = []
    while len(at):
        _, word, counts = np.unique(mixed(hashes[at] ^ mixed(segment.astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)
        often = counts[word] >= least_repeats
        # A segment is whole when none of its words was rare.
        starts = np.flatnonzero(np.diff(segment, prepend=-1))
        sizes = np.diff(np.append(starts, len(at)))
        whole = np.add.reduceat(often, starts) == sizes
        done += [(int(at[s]), int(at[s]) + int(n)) for s, n in zip(starts[whole], sizes[whole]) if n >= least_words]
        keep = often & ~np.repeat(whole, sizes)
        at, old = at[keep], segment[keep]
        segment = np.cumsum((np.diff(at, prepend=-2) != 1) | (np.diff(old, prepend=-1) != 0)) - 1
        long = np.bincount(segment)[segment] >= least_words if len(at) else keep[:0]
        at, segment = at[long], segment[long]
    return sorted(done)


def _reach(same, limit: int) -> int:
    """How many of the places 0, 1, ... up to `limit` are alike without a gap; `same(lo, hi)` compares some of them."""
    lo, step = 0, 64
    while lo < limit:
        hi = min(limit, lo + step)
        alike = same(lo, hi)
        if not alike.all():
            return lo + int(np.argmin(alike))
        lo, step = hi, 2 * step
    return limit


def segment_runs(h: np.ndarray, least_words: int, least_repeats: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs of the words `h`, by start, then period."""
    n, k, grams, runs = len(h), 1, h, []
    while least_repeats * (k // 2 + 1) <= n:
        order = np.argsort(grams, kind="stable")
        lag = np.diff(order)
        ok = (grams[order[1:]] == grams[order[:-1]]) & (lag > k // 2) & (lag <= k)
        first, lag = order[:-1][ok], lag[ok]
        by = np.lexsort((first, lag))
        first, lag = first[by], lag[by]
        heads = (np.diff(lag, prepend=0) != 0) | (np.diff(first, prepend=-2) != 1)
        last_lag, end = 0, 0
        for i, q in zip(first[heads].tolist(), lag[heads].tolist()):
            if q == last_lag and i + q < end:
                continue
            left = _reach(lambda lo, hi: (h[i - hi : i - lo] == h[i - hi + q : i - lo + q])[::-1], i)
            right = _reach(lambda lo, hi: h[i + lo : i + hi] == h[i + q + lo : i + q + hi], n - q - i)
            last_lag, end = q, i + right + q
            if left + right + q >= max(least_words, least_repeats * q):
                runs.append((i - left, left + right + q, q))
        if 2 * k > n:
            break
        grams = mixed(grams[: n - 2 * k + 1] * _ROLL + grams[k:])
        k *= 2
    return sorted(runs, key=lambda r: (r[0], r[2]))


def most_repeated(runs: list[tuple[int, int, int]]) -> int | None:
    """Number of the run with the greatest length / period; the earliest, then the shortest period, among equals."""
    best = None
    for i, (_, length, period) in enumerate(runs):
        if best is None or length * runs[best][2] > runs[best][1] * period:
            best = i
    return best


def collapse_runs(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_words: int = LEAST_WORDS, least_repeats: int = LEAST_REPEATS,
) -> DataFrame:
    """One row per row of `df`: doc_id, runs (start, length, period; by start, then period), best, text.

    Words are what stands between blanks, numbered from 0. A run is a stretch of at least `least_words` words and
    `least_repeats` (3 or more) times its smallest period that no neighbouring word extends; runs of different periods
    may overlap. `best` is the place in `runs` of the one with the greatest length / period, null without runs. `text`
    holds the words, joined by one blank, without those that stand in a run after its first period. Null, empty and
    blank texts have no runs and an empty text. Each row is judged alone, so repeated rows, null ids and an empty table
    are nothing special. Words are compared by 64-bit hashes. Extra columns are not read.
    """
    own = renamed(df, doc_id=id_column, text=text_column)
    kind = dict(own.dtypes)["doc_id"].replace("bigint", "long")
    schema = f"doc_id {kind}, starts array<long>, lengths array<long>, periods array<long>, best int, text string"

    def judge(part):
        for chunk in texts(part.column("text")):
            found = words(chunk, PLAIN)
            runs: list[list[tuple[int, int, int]]] = [[] for _ in range(chunk.n)]
            for lo, hi in surviving_segments(found.hash, found.bounds, least_words, least_repeats):
                i = int(found.text[lo])
                runs[i] += [(lo - int(found.bounds[i]) + start, length, q) for start, length, q in segment_runs(found.hash[lo:hi], least_words, least_repeats)]
            shown = []
            for i, text_runs in enumerate(runs):
                kept = chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]].tobytes().split()
                if text_runs:
                    covered = np.zeros(len(kept) + 1, np.int64)
                    np.add.at(covered, [start + q for start, _, q in text_runs], 1)
                    np.add.at(covered, [start + length for start, length, _ in text_runs], -1)
                    kept = [kept[j] for j in np.flatnonzero(np.cumsum(covered[:-1]) == 0)]
                shown.append(b" ".join(kept).decode())
            yield batch(
                schema, part.column("doc_id").slice(chunk.first, chunk.n), *[[[r[c] for r in x] for x in runs] for c in range(3)],
                [most_repeated(x) for x in runs], pa.array(shown, pa.string()),
            )

    found = map_batches(own, judge, schema)
    runs = F.transform(F.arrays_zip("starts", "lengths", "periods"), lambda r: F.struct(*[r[f"{c}s"].alias(c) for c in ("start", "length", "period")]))
    return found.select("doc_id", runs.alias("runs"), "best", "text")


def with_planted_runs(doc_id: Column, text: Column) -> Column:
    """The text with a repeated tail where the checksum of its id is divisible by 10; a null id plants nothing.

    From word `a` on, the words repeat those of the first `p` from there; `a` and `p` follow from the checksum and the number of words.
    """
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def planted(own: Column) -> Column:
        n = F.size(own)
        a = F.pmod(g, n)
        places = F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).alias("p"))
        return F.when(n > 0, let(places, lambda at: F.array_join(
            F.transform(own, lambda w, i: F.when(i < at["a"], w).otherwise(F.get(own, (at["a"] + F.pmod(i - at["a"], at["p"])).cast("int")))), " ",
        ))).otherwise(text)

    words_of = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when(F.pmod(h, F.lit(10)) == 0, let(words_of, planted)).otherwise(text)


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    found = collapse_runs(docs.select("doc_id", with_planted_runs(F.col("doc_id"), F.col("text")).alias("text")))
    best = F.get("runs", F.col("best"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.call_function("div", 1000 * best["length"], best["period"]).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )
