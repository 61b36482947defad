"""Op 6: counts of rule-based quality, and a log-likelihood ratio of hashed n-grams between trusted and all texts.

Words and pairs of neighbouring words fall into buckets by hash. Two multinomials over the buckets, one of the trusted
texts and one of all texts, give each n-gram a log ratio; a text's score is the mean over its n-grams, and a text below a
fixed threshold goes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .registry import batch, column, map_batches, query, read, renamed
from .slots import in_table, slot_table
from .words import PLAIN, Texts, Words, mixed, spans_hash, texts, windows, words

#: Buckets of the two multinomials; what is gathered from the corpus is two counts per bucket and task.
BUCKETS = 1 << 16
#: Texts with a lower mean log ratio (natural logarithm) are dropped.
THRESHOLD = -0.32
MIN_WORDS, REPEAT_RUN, MAX_REPEAT_PERCENT = 20, 8, 30
_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])


def _per_text(found: np.ndarray, where: np.ndarray, n: int) -> np.ndarray:
    """Sum of a value per text, given each entry's text."""
    return np.bincount(where, weights=found, minlength=n).astype(np.int64)


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated_words(found: Words, run: int, n: int) -> np.ndarray:
    """Words of each text that lie in a run of words which the text holds twice or more."""
    first, hashes = windows(found, run)
    if not len(first):
        return np.zeros(n, np.int64)
    text = found.text[first]
    key = mixed(hashes + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(found.hash) + 1, np.int64)
    np.add.at(cover, first[twice], 1)
    np.add.at(cover, first[twice] + run, -1)
    return _per_text((np.cumsum(cover[:-1]) > 0).astype(np.int64), found.text, n)


def duplicate_lines(chunk: Texts, found: Words) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier line of the text."""
    breaks = chunk.data == 10
    starts = np.union1d(chunk.offsets[:-1], np.flatnonzero(breaks) + 1)
    starts = starts[starts < len(chunk.data)]
    if not len(starts):
        return np.zeros(chunk.n, np.int64)
    ends = np.minimum(np.append(starts[1:], len(chunk.data)), chunk.offsets[np.searchsorted(chunk.offsets, starts, "right")])
    ends = np.where(breaks[ends - 1], ends - 1, ends)
    holds = np.searchsorted(found.start, ends) > np.searchsorted(found.start, starts)
    starts, ends = starts[holds], ends[holds]
    text = np.searchsorted(chunk.offsets, starts, "right") - 1
    hashes = spans_hash(chunk.data, starts, ends)
    order = np.lexsort((hashes, text))
    same = (hashes[order][1:] == hashes[order][:-1]) & (text[order][1:] == text[order][:-1])
    return _per_text(same.astype(np.int64), text[order][1:], chunk.n)


def ngram_buckets(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text of every word and every pair of neighbouring words."""
    first, pairs = windows(found, 2)
    hashes = np.concatenate([found.hash, pairs])
    return (hashes >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1), np.concatenate([found.text, found.text[first]])


def _mean_log_ratio(found: Words, ratio: np.ndarray, n: int) -> np.ndarray:
    buckets, text = ngram_buckets(found)
    total = np.bincount(text, weights=ratio[buckets], minlength=n)
    count = np.bincount(text, minlength=n)
    return np.where(count > 0, total / np.maximum(count, 1), 0.0)


def bucket_counts(texts_only: DataFrame) -> DataFrame:
    """(bucket, n) over all rows of `texts_only` (text); one row per bucket and task is shuffled."""

    def count(batches):
        counts = np.zeros(BUCKETS, np.int64)
        for part in batches:
            for chunk in texts(part.column("text")):
                counts += np.bincount(ngram_buckets(words(chunk, PLAIN))[0], minlength=BUCKETS)
        used = np.flatnonzero(counts)
        yield batch("bucket long, n long", used, counts[used])

    return texts_only.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def trusted_texts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The texts of `docs` (doc_id, text) whose id is in `trusted` (known).

    A bit table keeps back most other texts before the join, which is a shuffle at every size, so that its cost follows
    the trusted texts.
    """
    ids = stage(trusted.where("known is not null").distinct(), "trusted")
    table = slot_table(ids, F.xxhash64("known"))
    kind = dict(docs.dtypes)["doc_id"].replace("bigint", "long")

    def pick(part):
        ok = pa.array(in_table(table, part.column("slot").to_numpy()))
        yield batch(f"doc_id {kind}, text string", part.column("doc_id").filter(ok), part.column("text").filter(ok))

    few = map_batches(docs.select("doc_id", "text", F.xxhash64("doc_id").alias("slot")), pick, f"doc_id {kind}, text string")
    return few.join(ids.hint("merge"), few["doc_id"] == ids["known"], "left_semi").select("text")


def log_ratios(target: DataFrame, raw: DataFrame) -> np.ndarray:
    """Log ratio of each bucket under add-one smoothing, from at most BUCKETS rows each."""
    found = np.zeros((2, BUCKETS))
    for k, counts in enumerate((target, raw)):
        rows = counts.toPandas()
        found[k, rows["bucket"].to_numpy(np.int64)] = rows["n"]
    shares = (found + 1) / (found.sum(axis=1, keepdims=True) + BUCKETS)
    return np.log(shares[0]) - np.log(shares[1])


def judge_quality(
    df: DataFrame, trusted: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of `df`: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept.

    `trusted` (doc_id) names the trusted texts; without any, every score is that of a uniform target. A null text has no
    words; a text without words scores 0 and fails the base rules. A null id is never trusted, and rows that share a
    trusted id are all trusted. Repeated rows stay, and count as often as they stand. Extra columns are not read. An
    empty table gives no rows.
    """
    docs = renamed(df, doc_id=id_column, text=text_column)
    ids = trusted.select(column(trusted, trusted.columns[0]).alias("known"))
    ratio = log_ratios(bucket_counts(trusted_texts(docs, ids)), bucket_counts(docs.select("text")))

    def judge(part):
        columns = [[] for _ in range(8)]
        for chunk in texts(part.column("text")):
            found = words(chunk, PLAIN)
            n_words = np.diff(found.bounds)
            repeats = repeated_words(found, REPEAT_RUN, chunk.n)
            failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
            score = _mean_log_ratio(found, ratio, chunk.n)
            letters = PLAIN.inside[chunk.data] & ((chunk.data & 0xC0) != 0x80)
            values = (
                n_words, _sums(letters, chunk.offsets), _sums(_SYMBOL[chunk.data], chunk.offsets), duplicate_lines(chunk, found), repeats,
                failed, score, ~failed & (score >= threshold),
            )
            for have, new in zip(columns, values):
                have.append(new)
        yield batch(schema, part.column("doc_id"), *[pa.array(np.concatenate(c)) for c in columns])

    kind = dict(docs.dtypes)["doc_id"].replace("bigint", "long")
    schema = (
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"
    )
    return map_batches(docs, judge, schema)


@query("op6_quality_rules")
def op6_quality_rules(spark, sf_dir):
    labels = read(spark, sf_dir, "labels")
    trusted = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")).where("quality = 1 and toxic = 0")
    return judge_quality(read(spark, sf_dir, "documents"), trusted.select("doc_id"))
