"""Periodic runs against brute force: every stretch, lag by lag, on random texts of few words and on the query's tables."""

import hashlib
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from framequarry.llm import periodic_runs, queries
from framequarry.llm.words import mixed

FOLDER = "/root/testdata/sf0.001"


def brute_runs(w, least=24, times=3):
    """All maximal stretches of every lag, without those that have a smaller period."""
    found = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.append((i, j - i + q, q))
            i = max(j, i) + 1
    whole = set()
    for s, n, q in found:
        part = w[s : s + n]
        if not any(part[p:] == part[:-p] for p in range(1, q)):
            whole.add((s, n, q))
    return sorted(whole, key=lambda r: (r[0], r[2]))


def brute(doc_id, text, plant=True):
    own = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    h, n = zlib.crc32(str(doc_id).encode()), len(own)
    g = h // 10
    if plant and doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        own = [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(own)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    start, length, q = best or (None, None, None)
    return (
        doc_id, len(runs), start, length, q, 1000 * length // q if best else None,
        hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(x for i, x in enumerate(own) if i not in gone).encode()).hexdigest(),
    )


@pytest.mark.parametrize("seed", range(60))
def test_runs_of_random_words(seed):
    rng = np.random.default_rng(seed)
    parts = []
    for _ in range(rng.integers(1, 5)):
        period = rng.integers(0, rng.integers(1, 5), rng.integers(1, 30))
        parts += [np.tile(period, rng.integers(1, 30)), rng.integers(0, 40, rng.integers(0, 30)), rng.integers(0, 2, rng.integers(0, 40))]
    w = np.concatenate(parts)[:700]
    h = mixed(w.astype(np.uint64) + np.uint64(7))
    want = brute_runs(w.tolist())
    assert periodic_runs.segment_runs(h, 24, 3) == want
    bounds = np.array([0, len(h) // 3, len(h)])
    kept = periodic_runs.surviving_segments(h, bounds, 24, 3)
    for lo, hi in zip(bounds, bounds[1:]):
        for s, n, _ in brute_runs(w[lo:hi].tolist()):
            assert any(a <= lo + s and lo + s + n <= b for a, b in kept)


def test_odd_rows(spark):
    texts = [None, "", " \t\n\x0b", "a " * 23, "a " * 24, "é ü\x0bß " * 9, "a b " * 30, ("x y z " * 8 + "q ") * 3, " ".join(map(str, range(5000)))]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[4], "again"), (None, texts[4], "no id"), (None, None, "nothing")]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(3)
    got = periodic_runs.collapse_runs(df).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "runs", "best", "text"}
    by_id = {r.doc_id: r for r in got if r.doc_id not in (None, 3)}
    for i, t in enumerate(texts):
        if i == 3:
            continue
        own = [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
        runs = brute_runs(own)
        gone = {j for s, length, q in runs for j in range(s + q, s + length)}
        assert [tuple(r) for r in by_id[i].runs] == runs
        assert by_id[i].text == " ".join(x for j, x in enumerate(own) if j not in gone)
    assert periodic_runs.collapse_runs(df.limit(0)).count() == 0


def test_very_long_text_in_reasonable_time():
    rng = np.random.default_rng(1)
    period = mixed(rng.integers(0, 1000, 40_000).astype(np.uint64))
    h = np.concatenate([np.tile(period, 4), mixed(rng.integers(0, 30, 300_000).astype(np.uint64)), np.tile(period[:3], 100_000)])
    kept = periodic_runs.surviving_segments(h, np.array([0, len(h)]), 24, 3)
    runs = [(lo + s, n, q) for lo, hi in kept for s, n, q in periodic_runs.segment_runs(h[lo:hi], 24, 3)]
    assert (0, 40_000) in {(s, q) for s, _, q in runs} and max(n for _, n, q in runs if q == 3) >= 300_000


def test_query(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    got = queries.QUERIES["op13_periodic_runs"](spark, FOLDER).collect()
    assert sorted(map(tuple, got)) == sorted(brute(*row) for row in docs)
