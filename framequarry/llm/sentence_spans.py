"""Op 3: remove sentences that an earlier text, or an earlier place of the same text, already has in a run of sentences.

A run is a span of consecutive sentences, the shortest from a sentence on (and the shortest up to a sentence) that has
several sentences and enough words, or very many words. All runs of all texts are hashed and counted; of the places
of a repeated run, ordered by (doc_id, text, word), the first stays and the sentences of the others go.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .registry import batch, column, map_batches, query, read, text_key
from .slots import in_table, slot_table
from .words import PLAIN, Texts, Words, _powers, mixed, texts, words

#: A run has this many sentences and words, or at least LONG_RUN words in fewer sentences.
SENTENCES, RUN_WORDS, LONG_RUN = 3, 20, 40
_STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MARKS, _CLOSING = [ord(c) for c in ".!?"], [ord(c) for c in "\"')]}"]


def sentence_starts(chunk: Texts, found: Words) -> np.ndarray:
    """Words that begin a sentence: the first of a text or line, and those after a word that ends in `.`, `!` or `?`.

    Closing quotes and brackets after the mark belong to the word.
    """
    if not len(found.start):
        return np.empty(0, np.int64)
    last, at = chunk.data[found.end - 1], found.end - 1
    for _ in range(2):
        at = np.maximum(at - np.isin(last, _CLOSING), found.start)
        last = chunk.data[at]
    ends = np.isin(last, _MARKS)
    lines = np.concatenate([[0], np.cumsum(chunk.data == 10)])
    broken = lines[found.start[1:]] > lines[found.end[:-1]]
    new = np.ones(len(found.start), bool)
    new[1:] = ends[:-1] | broken | (found.text[1:] != found.text[:-1])
    return np.flatnonzero(new)


def runs(found: Words, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and word after the last of every run, in order and without repetition."""
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    edge = np.append(starts, len(found.text))
    n = len(starts)
    here = np.arange(n)
    stop = np.searchsorted(starts, found.bounds[found.text[starts] + 1])  # sentence after the text's last
    first = np.searchsorted(starts, found.bounds[found.text[starts]])

    ahead = np.minimum(np.maximum(here + SENTENCES, np.searchsorted(edge, starts + RUN_WORDS)), np.searchsorted(edge, starts + LONG_RUN))
    ok = ahead <= stop
    after = edge[1:]
    back = np.maximum(
        np.minimum(here + 1 - SENTENCES, np.searchsorted(edge, after - RUN_WORDS, "right") - 1), np.searchsorted(edge, after - LONG_RUN, "right") - 1,
    )
    fits = back >= first
    lo = np.concatenate([starts[ok], edge[back[fits]]])
    hi = np.concatenate([edge[ahead[ok]], after[fits]])
    both = np.unique(np.stack([lo, hi], axis=1), axis=0)
    return both[:, 0], both[:, 1]


def run_hashes(found: Words, lo: np.ndarray, hi: np.ndarray, step: int) -> np.ndarray:
    """Hash of the words of each run; equal word sequences have equal hashes wherever they stand."""
    n = len(found.hash)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(found.hash * _powers(step, n + 1)[:n])])
    return mixed((sums[hi] - sums[lo]) * _powers(pow(step, -1, 2**64), n + 1)[lo] + (hi - lo).astype(np.uint64))


def _without(chunk: Texts, found: Words, i: int, cuts: list[tuple[int, int]]) -> tuple[bytes, int]:
    """Text i without the words of some ranges, and how many words went; what separates the words before it goes with a range."""
    lo, hi = int(found.bounds[i]), int(found.bounds[i + 1])
    gone = np.zeros(hi - lo + 1, np.int64)
    for a, b in cuts:
        gone[a] += 1
        gone[b] -= 1
    gone = np.cumsum(gone[:-1]) > 0
    begin, end = int(chunk.offsets[i]), int(chunk.offsets[i + 1])
    kept, at = [], begin
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(int)))
    for a, b in zip(edges[::2], edges[1::2]):
        stop = int(found.end[lo + a - 1]) if a else begin
        kept.append(chunk.data[at:stop].tobytes())
        at = int(found.end[lo + b - 1]) if a or b == hi - lo else int(found.start[lo + b])
    kept.append(chunk.data[at:end].tobytes())
    return b"".join(kept) if not gone.all() else b"", int(gone.sum())


def drop_repeated_spans(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `df`: doc_id, text without the sentences that go, n_sentences, n_words_removed.

    Sentences end at line ends and at `.`, `!` or `?` before white space; words are compared as written, white space
    between them is not. Texts too short for a run, null and empty texts stay as they are. A text whose every sentence
    goes is empty; its row stays. Rows with one id and one text are one document and get the same result; a null id
    comes first in the order. Extra columns are not read; an empty table gives no rows.
    """
    docs = df.select(column(df, id_column).alias("doc_id"), column(df, text_column).alias("text")).withColumn("which", text_key(F.col("text")))
    kind = dict(docs.dtypes)["doc_id"].replace("bigint", "long")

    def hashed(part):
        for chunk in texts(part.column("text")):
            found = words(chunk, PLAIN)
            lo, hi = runs(found, sentence_starts(chunk, found))
            yield chunk, found, lo, hi, run_hashes(found, lo, hi, _STEPS[0])

    def count(part):
        for _, _, _, _, h in hashed(part):
            yield batch("h long", pa.array(h.view(np.int64)))

    repeated = stage(
        map_batches(docs.select("text"), count, "h long").groupBy("h").count().where("count > 1").select("h"), "repeated",
    )
    table = slot_table(repeated, F.col("h"))

    def place(part):
        ids, which = part.column("doc_id"), part.column("which").to_numpy()
        for chunk, found, lo, hi, h in hashed(part):
            ok = in_table(table, h)
            lo, hi, h = lo[ok], hi[ok], h[ok]
            text = found.text[lo] if len(lo) else np.empty(0, np.int64)
            first = found.bounds[text]
            yield batch(
                f"h long, g long, doc_id {kind}, which long, lo long, hi long", h.view(np.int64), run_hashes(found, lo, hi, _STEPS[1]).view(np.int64),
                ids.take(pa.array(text + chunk.first)), which[text + chunk.first], lo - first, hi - first,
            )

    placed = stage(
        map_batches(docs.select("text", "doc_id", "which"), place, f"h long, g long, doc_id {kind}, which long, lo long, hi long").join(repeated, "h", "left_semi"),
        "placed",
    )
    at = F.struct("doc_id", "which", "lo")
    # A table of its own: then a run that very many texts hold is split by the join instead of meeting in one task.
    first = stage(placed.groupBy("h", "g").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1").select("h", "g", "first"), "first")
    later = placed.join(first, ["h", "g"]).where(at > F.col("first")).select("doc_id", "which", "lo", "hi").distinct()
    cuts = later.groupBy("doc_id", "which").agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi"))
    joined = docs.alias("d").join(
        cuts.alias("c"), F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.which") == F.col("c.which")), "left",
    ).select("d.doc_id", "d.text", "c.lo", "c.hi")
    schema = f"doc_id {kind}, text string, n_sentences long, n_words_removed long"

    def cut(part):
        lows, highs = part.column("lo").to_pylist(), part.column("hi").to_pylist()
        given = part.column("text").to_pylist()
        n_sentences, removed = [], []
        for chunk in texts(part.column("text")):
            found = words(chunk, PLAIN)
            starts = sentence_starts(chunk, found)
            n_sentences.extend(np.diff(np.searchsorted(starts, found.bounds)).tolist())
            for i in range(chunk.n):
                row = chunk.first + i
                if lows[row]:
                    text, gone = _without(chunk, found, i, list(zip(lows[row], highs[row])))
                    given[row] = text.decode()
                    removed.append(gone)
                else:
                    removed.append(0)
        yield batch(schema, part.column("doc_id"), given, n_sentences, removed)

    return map_batches(joined, cut, schema)


@query("op3_substring_dedup")
def op3_substring_dedup(spark, sf_dir):
    return drop_repeated_spans(read(spark, sf_dir, "documents"))
