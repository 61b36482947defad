"""Op 11: repair the structure of conversations at the lowest cost, by secondary-sorted streaming.

A repaired conversation's roles read `(s?(ua)+)?`: a system turn at most, then user and assistant in turns. Rows are kept,
given another role or deleted, and empty turns inserted. Going from a conversation's last row to its first, four costs
(one per state of that pattern) are carried across batches, and for each row two bytes say what is best from each state;
a conversation with many rows spills them to a file of its task. Read backwards they give the edits in order, the
ASCII-least among equally cheap ones. A second stream, sorted from the first row to the last, carries the edits out, so a
text is shuffled once and none is held in memory. Earlier rows with the same role and text are found by aggregates, so
no task remembers a conversation's texts.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .registry import column, query, read

DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 3, 2, 2, 1
_BLANKS = " \t\n\x0b\x0c\r"
#: States: nothing yet, after system, after user, after assistant. What may be added in each, and the state after it.
_ADDS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_NEXT = (2, 2, 3, 2)
_ROLE = (None, None, "user", "assistant")
_LAWFUL = {"su", "ua", "au"}
_FAR = 1 << 60
#: Letters of the edits in ASCII order; a choice in a state is four bits, the letter and whether a system turn is kept.
_LETTERS = "DIKR"
#: Bytes of choices held in memory per conversation; more go to a file, which ends with the conversation.
HELD_BYTES = 1 << 20


class Row(NamedTuple):
    """What the costs of a row depend on: its role's initial, whether it has to go, and whether it is truncated."""

    initial: str
    must_go: bool
    truncated: bool


def _cheapest(after: tuple[int, ...], row: Row | None) -> tuple[tuple[int, ...], int]:
    """The cost from each state on with `row` first and `after` behind it, and the least letter that reaches it, per state."""
    if row is None:  # the end: only insertions are left
        found = [0, _FAR, _FAR, 0]
        options = [{} for _ in found]
    else:
        options = [{"D": DELETE_COST + cost} for cost in after]
        if not row.must_go:
            for s, mine in enumerate(options):
                if row.initial in _ADDS[s]:
                    mine["K"] = TRUNCATED_COST * row.truncated + after[_ADDS[s][row.initial]]
                mine["R"] = REROLE_COST + TRUNCATED_COST * row.truncated + after[_NEXT[s]]
        found = [min(mine.values()) for mine in options]
    for _ in range(3):
        found = [min(cost, INSERT_COST + found[_NEXT[s]]) for s, cost in enumerate(found)]
    choice = 0
    for s, cost in enumerate(found):
        options[s]["I"] = INSERT_COST + found[_NEXT[s]]
        letter = next((x for x in _LETTERS if options[s].get(x) == cost), "D")
        choice |= (_LETTERS.index(letter) | (4 if letter == "K" and row and row.initial == "s" else 0)) << 4 * s
    return tuple(found), choice


class _Open:
    """A conversation whose rows are being read from the last to the first."""

    def __init__(self, conv: str | None, memo: dict):
        self.conv, self.memo = conv, memo
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.last = self.first = self.later = None
        self.costs, end = _cheapest((), None)
        self.base, self.held, self.file = 0, bytearray(end.to_bytes(2, "little")), None

    def _step(self, row: Row) -> None:
        key = (self.costs, row)
        if key not in self.memo:
            costs, choice = _cheapest(self.costs, row)
            low = min(costs)
            self.memo[key] = tuple(c - low for c in costs), low, choice.to_bytes(2, "little")
        self.costs, low, choice = self.memo[key]
        self.base += low
        self.held += choice
        if len(self.held) >= HELD_BYTES:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.held)
            self.held.clear()

    def add(self, has_turn: bool, turn: int, initial: str, blank: bool, truncated: bool, seen: bool, copies: int) -> None:
        """The next place before those added: `copies` rows alike in turn, role and text, `seen` if an earlier turn has them too."""
        if has_turn:
            self.turns += turn != self.first
            self.last, self.first = turn if self.last is None else self.last, turn
        if self.later is not None:
            self.illegal += initial + self.later not in _LAWFUL
        self.later = initial
        self.illegal += copies - 1
        again = copies if seen else copies - 1
        if blank:
            self.blank += copies
        else:
            self.duplicate += again
            self.truncated += truncated and not seen
        for _ in range(again):
            self._step(Row(initial, True, False))
        if not seen:
            self._step(Row(initial, blank, truncated and not blank))

    def _choices(self) -> Iterator[int]:
        """What was chosen for each row, from the conversation's first row on, then at its end."""
        blocks = [(None, len(self.held))]
        if self.file:
            size = self.file.tell()
            blocks += [(at, min(HELD_BYTES, size - at)) for at in range((size - 1) // HELD_BYTES * HELD_BYTES, -1, -HELD_BYTES)]
        for at, size in blocks:
            if at is not None:
                self.file.seek(at)
            block = self.held if at is None else self.file.read(size)
            for i in range(size - 2, -1, -2):
                yield block[i] | block[i + 1] << 8

    def close(self) -> tuple:
        state, edits = 0, bytearray()
        for choice in self._choices():
            while (what := choice >> 4 * state & 15) == 1:  # insert, before the row
                edits += b"I"
                state = _NEXT[state]
            edits += _LETTERS[what & 3].encode()
            state = state if what == 0 else 1 if what & 4 else _NEXT[state]
        if self.file:
            self.file.close()
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        # The end adds no letter of its own: the last choice is the end's, where nothing is left to delete.
        return self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.base + self.costs[0], edits[:-1].decode()


_AUDIT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audited(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of places sorted by conversation and from the last to the first: one row per conversation."""
    names, current, memo = [x.split()[0] for x in _AUDIT.split(", ")], None, {}
    for frame in frames:
        done = []
        places = zip(*(frame[c].tolist() for c in ("has_turn", "turn", "initial", "blank", "truncated", "seen", "copies")))
        for conv, place in zip(frame["conv"].tolist(), places):
            if current is None or conv != current.conv:
                if current is not None:
                    done.append(current.close())
                current = _Open(conv, memo)
            if place[-1]:
                current.add(*place)
        if done:
            yield pd.DataFrame(done, columns=names)
    if current is not None:
        yield pd.DataFrame([current.close()], columns=names)


_ROWS = "conv string, position long, role string, text string, edit string"


def _carried_out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by conversation, its edits first, then its rows in order: the rows of the repaired conversation."""
    names = [x.split()[0] for x in _ROWS.split(", ")]
    conv, edits, at, state, position = None, "", 0, 0, 0
    done: list[tuple] = []

    def insert() -> None:
        nonlocal at, state, position
        while at < len(edits) and edits[at] == "I":
            state = _NEXT[state]
            done.append((conv, position, _ROLE[state], "", "I"))
            at, position = at + 1, position + 1

    for frame in frames:
        for this, leads, role, text in zip(frame["conv"].tolist(), frame["leads"].tolist(), frame["role"].tolist(), frame["text"].tolist()):
            if leads:
                insert()
                conv, edits, at, state, position = this, text, 0, 0, 0
                continue
            insert()
            edit = edits[at]
            at += 1
            if edit == "D":
                continue
            state = _ADDS[state][role[0]] if edit == "K" else _NEXT[state]
            done.append((conv, position, role if edit == "K" else _ROLE[state], text, edit))
            position += 1
        if done:
            yield pd.DataFrame(done, columns=names)
            done = []
    insert()
    if done:
        yield pd.DataFrame(done, columns=names)


def _digested(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of repaired rows in order: the hash of each conversation's `role:text`, joined by newlines."""
    conv, digest, started = None, None, False
    for frame in frames:
        done = []
        for this, at, role, text in zip(*(frame[c].tolist() for c in ("conv", "position", "role", "text"))):
            if at == 0:
                if started:
                    done.append((conv, digest.hexdigest()))
                conv, digest, started = this, hashlib.sha256(), True
            digest.update(f"{'' if at == 0 else chr(10)}{role}:{text}".encode())
        if done:
            yield pd.DataFrame(done, columns=["conv", "digest"])
    if started:
        yield pd.DataFrame([(conv, digest.hexdigest())], columns=["conv", "digest"])


class Repair(NamedTuple):
    """`audits`: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, one row per conversation.

    `rows`: conv_id, position, role, text, edit (I, K or R) of the repaired conversations. `digests`: conv_id, digest
    (SHA-256 of a conversation's `role:text` lines), of those that have rows.
    """

    audits: DataFrame
    rows: DataFrame
    digests: DataFrame


def repair_conversations(df: DataFrame, every: DataFrame | None = None) -> Repair:
    """Repair the conversations of `df` (conv_id, turn, role, text); `every` (conv_id) names ones that may have no rows.

    Rows are taken by turn, nulls first; rows of one turn by a hash of their role and text. A null role or text is one
    blank, a null conv_id a conversation of its own. A row is blank, or else a duplicate (role and text stand in an
    earlier row), or else truncated (its last character that is no blank is none of `.!?`). Keeping a row costs 0,
    another role 2, deletion 3, an inserted empty turn 2, and a truncated row that stays 1 more; blank rows and
    duplicates have to go. A role counts by its first letter; rows of roles other than s, u and a cannot be kept as they
    are. `gaps` counts the missing turns between the least and the greatest. Roles and texts are compared by 128-bit
    hashes. Extra columns are not read; an empty table gives empty results.
    """
    kind = dict(df.dtypes)["conv_id"]
    turn, role, text = (column(df, c) for c in ("turn", "role", "text"))
    own = df.select(
        column(df, "conv_id").cast("string").alias("conv"), turn.cast("long").alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"),
        F.coalesce(text, F.lit(" ")).alias("text"),
    ).withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(11), "text", "role")})
    shown = F.rtrim(F.col("text"), F.lit(_BLANKS))
    facts = own.select(
        "conv", "turn", "h1", "h2", F.substring("role", 1, 1).alias("initial"), (shown == "").alias("blank"),
        (~F.substring(shown, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    # Rows alike are counted per turn, so that a text which a conversation repeats for ever is few rows, and its first
    # turn is an aggregate of the same; only what several turns say is joined back.
    places = facts.groupBy("conv", "turn", "h1", "h2").agg(F.first("initial").alias("initial"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"), F.count("*").alias("copies"))
    again = (
        facts.groupBy("conv", "h1", "h2").agg(F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("last")).where("not first <=> last")
        .select(F.col("conv").alias("conv_"), F.col("h1").alias("h1_"), F.col("h2").alias("h2_"), "first")
    )
    placed = places.join(again, (F.col("h1") == F.col("h1_")) & (F.col("h2") == F.col("h2_")) & F.col("conv").eqNullSafe(F.col("conv_")), "left")
    stream = placed.select(
        "conv", F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn"), "initial", "blank", "truncated",
        (F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))).alias("seen"), "copies", "h1", "h2",
    )
    if every is not None:
        ids = every.select(column(every, "conv_id").cast("string").alias("conv")).distinct()
        empty = {"has_turn": "false", "turn": "0L", "initial": "''", "blank": "false", "truncated": "false", "seen": "false", "copies": "0L", "h1": "0L", "h2": "0L"}
        stream = stream.unionByName(ids.withColumns({name: F.expr(value) for name, value in empty.items()}))
    backwards = stream.repartition("conv").sortWithinPartitions("conv", *[F.desc(c) for c in ("has_turn", "turn", "h1", "h2")]).drop("h1", "h2")
    audits = stage(backwards.mapInPandas(_audited, _AUDIT), "audits")

    leads = audits.select("conv", F.lit(True).alias("leads"), F.lit(None).cast("long").alias("turn"), F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"), F.lit("").alias("role"), F.col("audit").alias("text"))
    lines = own.select("conv", F.lit(False).alias("leads"), "turn", "h1", "h2", "role", "text")
    forwards = lines.unionByName(leads).repartition("conv").sortWithinPartitions("conv", F.desc("leads"), "turn", "h1", "h2").select("conv", "leads", "role", "text")
    rows = forwards.mapInPandas(_carried_out, _ROWS)
    digests = rows.mapInPandas(_digested, "conv string, digest string")

    def named(found: DataFrame) -> DataFrame:
        return found.select(F.col("conv").cast(kind).alias("conv_id"), *found.columns[1:])

    return Repair(named(audits), named(rows), named(digests))


def damaged(df: DataFrame) -> DataFrame:
    """`df` (conv_id, turn, role, text) with faults planted by the checksum of `conv_id:turn`, nulls as one blank.

    Of twenty remainders 0 drops the row, 1 empties its text, 2 removes `.`, `!` and `?` from it, 3 repeats it, and 4 makes it the user's.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(key) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.where(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), F.explode(copies).alias("copy"),
    ).drop("copy")


def _edit_sql(state: str, cost: str, letter: str, line: str = "") -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {state}.r{line and ' || ' + line}}}"


def _least_sql(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _kept_sql(state: str, initial: str) -> str:
    """Keep the row if it may stay and its role has this initial."""
    return f"CASE WHEN must_go OR initial <> '{initial}' THEN NULL ELSE {_edit_sql(state, 'more', 'K', 'line')} END"


def _reroled_sql(state: str, role: str) -> str:
    line = f"chr(10) || '{role}:' || text"
    return f"CASE WHEN must_go THEN NULL ELSE {_edit_sql(state, f'{REROLE_COST} + more', 'R', line)} END"


def _options_sql(*options: str) -> str:
    return f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))[1]"


_FIRST = "{{'c': {}, 'a': '{}', 'r': {}}}"
_USER, _ASSISTANT = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
#: The checksum byte by byte, the damage, the faults, and then a step per row: of each state the cheapest edits so far, the
#: ASCII-least among equals, with the lines they leave; `g` after a row, `s` after insertions behind it.
REPAIRS_SQL = f"""
WITH RECURSIVE bits AS (SELECT i, i AS v, 0 AS k FROM range(256) t(i) UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), told AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(k, ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fault FROM keyed, crc
), damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE fault WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM told WHERE fault <> 0
), placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n, regexp_extract(text, '(?s)^(.*?)[\x20\x09-\x0D]*$', 1) AS shown FROM damaged
), judged AS (
  SELECT *, left(role, 1) AS initial, shown = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again, right(shown, 1) NOT IN ('.', '!', '?') AS cut,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM placed
), marked AS (SELECT *, blank OR again AS must_go, CAST(CASE WHEN cut AND NOT blank AND NOT again THEN {TRUNCATED_COST} ELSE 0 END AS BIGINT) AS more, chr(10) || role || ':' || text AS line FROM judged
), walk AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS n, {_FIRST.format("CAST(0 AS BIGINT)", "", "''")} AS s0, {_FIRST.format(f"CAST({1 << 40} AS BIGINT)", "", "''")} AS s1,
    {_FIRST.format(f"CAST({INSERT_COST} AS BIGINT)", "I", _USER)} AS s2, {_FIRST.format(f"CAST({2 * INSERT_COST} AS BIGINT)", "II", _USER + " || " + _ASSISTANT)} AS s3 FROM conversations
  UNION ALL
  SELECT conv_id, n, g0, g1, i2, {_least_sql("g3", _edit_sql("i2", str(INSERT_COST), "I", _ASSISTANT))} FROM (
    SELECT *, {_least_sql("g2", *[_edit_sql(g, str(INSERT_COST), "I", _USER) for g in ("g0", "g1", "g3")])} AS i2 FROM (
      SELECT w.conv_id, m.n, {_edit_sql("s0", str(DELETE_COST), "D")} AS g0,
        {_options_sql(_edit_sql("s1", str(DELETE_COST), "D"), _kept_sql("s0", "s"))} AS g1,
        {_options_sql(_edit_sql("s2", str(DELETE_COST), "D"), *[f(s, x) for s in ("s0", "s1", "s3") for f, x in ((_kept_sql, "u"), (_reroled_sql, "user"))])} AS g2,
        {_options_sql(_edit_sql("s3", str(DELETE_COST), "D"), _kept_sql("s2", "a"), _reroled_sql("s2", "assistant"))} AS g3
      FROM walk w JOIN marked m ON w.conv_id IS NOT DISTINCT FROM m.conv_id AND m.n = w.n + 1))
), done AS (SELECT conv_id, {_least_sql("s0", "s3")} AS best FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1
), counted AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again AND NOT blank) AS duplicate,
    count(*) FILTER (WHERE cut AND NOT blank AND NOT again) AS truncated, count(*) FILTER (WHERE before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id)
SELECT d.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  best.c AS cost, best.a AS audit, sha256(substr(best.r, 2)) AS repaired_sha256
FROM done d LEFT JOIN counted c ON d.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@query("op11_conversation_repair", REPAIRS_SQL)
def op11_conversation_repair(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    found = repair_conversations(damaged(rows), every=rows.select("conv_id"))
    digests = found.digests.withColumnRenamed("conv_id", "conv")
    return found.audits.join(digests, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        *found.audits.columns, F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
