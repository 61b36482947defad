"""Conversation repair against brute force: cheapest edits by searching all of them, ties broken on whole strings."""

import hashlib
import heapq
import re
import zlib

import duckdb
import numpy as np
import pytest
from framequarry.llm import conversations, queries

FOLDER = "/root/testdata/sf0.001"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        shown = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        found.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(rows):
    """(cost, audit, repaired rows): Dijkstra over (rows used, last initial) in the order of cost, then of the audit."""
    marks = faults(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, out = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, list(out)
        name = {"u": "user", "a": "assistant"}
        new = NEXT[last]
        heapq.heappush(heap, (cost + 2, audit + "I", i, new, (*out, (name[new], ""))))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, out))
            if marks[i] not in ("blank", "duplicate"):
                more = marks[i] == "truncated"
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, new, (*out, (name[new], text))))
                if role[:1] == new or role[:1] == "s" and last == "":
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*out, rows[i])))


def brute(rows):
    """(turn, role, text) in order, after damage."""
    turns = [t for t, _, _ in rows if t is not None]
    plain = [r[1:] for r in rows]
    marks = faults(plain)
    cost, audit, repaired = cheapest(plain)
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256("\n".join(f"{a}:{b}" for a, b in repaired).encode()).hexdigest()
    return gaps, *(marks.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest


def damage(rows):
    """(conv_id, turn, role, text) to the damaged (turn, role, text), for rows in order."""
    for conv, turn, role, text in rows:
        fault = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            yield from [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)


def test_query(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{FOLDER}/conversations.parquet'").fetchall()
    by = {}
    for row in sorted(rows, key=lambda r: r[:2]):
        by.setdefault(row[0], []).append(row)
    want = sorted((conv, *brute(list(damage(own)))) for conv, own in by.items())
    assert sorted(map(tuple, queries.QUERIES["op11_conversation_repair"](spark, FOLDER).collect())) == want


def repaired(spark, rows, kinds="conv_id long, turn long, role string, text string, position string"):
    found = conversations.repair_conversations(spark.createDataFrame(rows, kinds).repartition(3))
    digests = {r.conv_id: r.digest for r in found.digests.collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (*tuple(r)[1:], digests.get(r.conv_id, nothing)) for r in found.audits.collect()}, found


def test_random_conversations(spark):
    rng = np.random.default_rng(3)
    rows = []
    for conv in range(400):
        for turn in sorted(rng.choice(30, rng.integers(1, 9), replace=False).tolist()):
            role = str(rng.choice(["user", "assistant", "system", "tool", "", "User", " "], p=[0.3, 0.3, 0.15, 0.1, 0.05, 0.05, 0.05]))
            text = str(rng.choice(["Hello.", "ok", "why?", "", " \t", "no! ", "Long text", "x" * 50 + "."]))
            rows.append((conv, turn, role, text, "x"))
    got, found = repaired(spark, rows)
    by = {}
    for conv, *row, _ in rows:
        by.setdefault(conv, []).append(tuple(row))
    assert got == {conv: brute(own) for conv, own in by.items()}
    shown = {}
    for r in found.rows.orderBy("conv_id", "position").collect():
        shown.setdefault(r.conv_id, []).append((r.role, r.text))
    assert all(shown.get(conv, []) == cheapest([r[1:] for r in own])[2] for conv, own in by.items())


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "First.", ""), (1, 5, "assistant", "Then.", ""), (None, 0, "user", "No id.", ""), (None, None, None, None, ""),
        (2, 0, "user", "same.", ""), (2, 0, "user", "same.", ""), (2, 3, "user", "same.", ""), (3, None, None, None, ""), (4, 2**60, "user", None, ""),
    ]
    got, _ = repaired(spark, rows)
    assert got[1] == brute([(None, "user", "First."), (5, "assistant", "Then.")])
    assert got[None] == brute([(None, " ", " "), (0, "user", "No id.")])
    assert got[2] == brute([(0, "user", "same."), (0, "user", "same."), (3, "user", "same.")])
    assert got[3] == brute([(None, " ", " ")]) and got[4] == brute([(2**60, "user", " ")])
    none = conversations.repair_conversations(spark.createDataFrame([], "conv_id string, turn int, role string, text string"))
    assert none.audits.count() == none.rows.count() == none.digests.count() == 0


def test_rows_of_one_turn_in_any_order(spark):
    rows = [(1, 0, "user", f"text {i}.", "") for i in range(6)] + [(1, 1, "assistant", "end.", "")]
    assert repaired(spark, rows)[0] == repaired(spark, rows[::-1])[0]


@pytest.mark.parametrize("held", [64, 1 << 20])
def test_choices_in_a_file(held, monkeypatch):
    monkeypatch.setattr(conversations, "HELD_BYTES", held)
    rng = np.random.default_rng(5)
    rows = [(t, str(rng.choice(["user", "assistant", "system"])), f"text {t}{rng.choice(['.', ''])}") for t in range(900)]
    conv = conversations._Open("x", {})
    for (turn, role, text) in reversed(rows):
        conv.add(True, turn, role[0], False, not text.endswith("."), False, 1)
    done = conv.close()
    assert done[1:] == brute(rows)[:-1] and (conv.file is not None) == (held == 64)
