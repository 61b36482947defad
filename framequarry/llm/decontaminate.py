"""Op 9: which words of a text lie in a window of a benchmark item, by winnowed fingerprints.

Of every run of `window - GRAM + 1` consecutive k-grams the smallest hash is kept, in texts and items alike, so any span
of `window` words that both hold has a fingerprint in common. A common fingerprint is extended to both sides word by
word, and only spans that reach a whole window count. Items shorter than a window are one window each: all runs of
their length are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .registry import batch, map_batches, query, read, renamed
from .slots import in_table, slot_table
from .words import ALNUM, Words, texts, windows, words

#: Words in a fingerprinted k-gram.
GRAM = 7


def _smallest(hashes: np.ndarray, text: np.ndarray, span: int) -> np.ndarray:
    """Positions of the last smallest hash of every run of `span` hashes within a text."""
    n = len(hashes) - span + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, where = hashes[:n].copy(), np.arange(n)
    for i in range(1, span):
        less = hashes[i : i + n] <= best
        best[less], where[less] = hashes[i : i + n][less], np.flatnonzero(less) + i
    return np.unique(where[text[:n] == text[span - 1 :]])


def winnowed(found: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and hashes of the kept k-grams."""
    k = min(GRAM, window)
    first, hashes = windows(found, k)
    if not len(first):
        return first, hashes
    picked = _smallest(hashes, found.text[first], window - k + 1)
    return first[picked], hashes[picked]


def _context(found: Words, at: int, length: int, window: int) -> tuple[int, bytes]:
    """The words around a k-gram that a window with it can reach: how many before it, and their hashes."""
    text = found.text[at]
    lo = max(int(found.bounds[text]), at + length - window)
    hi = min(int(found.bounds[text + 1]), at + window)
    return at - lo, found.hash[lo:hi].tobytes()


def _fingerprints(found: Words, window: int, lengths: list[int], wanted: np.ndarray | None):
    """(word, length, hash) of the fingerprints of all texts; with a table, only those whose bit is set."""
    for length in [window, *lengths]:
        first, hashes = winnowed(found, window) if length == window else windows(found, length)
        if wanted is not None and len(first):
            ok = in_table(wanted, hashes)
            first, hashes = first[ok], hashes[ok]
        yield length, first, hashes


def _spans(part: pa.RecordBatch, window: int):
    """Rows of matching fingerprints -> the words of the text they prove to be in a window of the item."""
    row, item, low, high = [], [], [], []
    columns = (part.column(c).to_pylist() for c in ("row", "item", "length", "at", "before", "context", "item_before", "item_context"))
    for r, name, length, at, before, context, item_before, item_context in zip(*columns):
        mine, theirs = np.frombuffer(context, np.uint64), np.frombuffer(item_context, np.uint64)
        left = min(before, item_before)
        mine, theirs = mine[before - left :], theirs[item_before - left :]
        size = min(len(mine), len(theirs))
        same = mine[:size] == theirs[:size]
        need = min(length, window)
        k = min(GRAM, window) if length == window else length
        if not same[left : left + k].all():
            continue
        lo, hi = left, left + k
        while length == window and lo > 0 and same[lo - 1]:
            lo -= 1
        while length == window and hi < size and same[hi]:
            hi += 1
        if hi - lo >= need:
            row.append(r)
            item.append(name)
            low.append(at - left + lo)
            high.append(at - left + hi)
    yield batch("row long, item string, low long, high long", row, item, low, high)


def contamination(
    df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
    item_text_column: str = "text", window: int = 13, one_in: int = 20,
) -> DataFrame:
    """One row per row of `df`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit when it lies in an occurrence of `window` consecutive words of an item; an item of fewer words is one
    window, an item without words none. n_items counts the items with an occurring window, and items_sha256 is the
    SHA-256 of their ids, sorted as strings and joined by commas (of the empty string if there are none). A text is
    contaminated when it has a hit and at least one word in `one_in` is hit. A null text has no words. An item with a
    null id hits words but is not listed; items that repeat an id count once. Repeated rows stay, each with its own
    values. Extra columns are not read; empty tables give no rows, or no hits.
    """
    docs = renamed(df, doc_id=id_column, text=text_column)
    items = renamed(benchmark, item=item_column, text=item_text_column).select(F.col("item").cast("string").alias("item"), "text")

    def item_prints(part):
        names = part.column("item").to_pylist()
        out = []
        for chunk in texts(part.column("text")):
            found = words(chunk, ALNUM)
            sizes = np.diff(found.bounds)
            short = sorted({int(s) for s in sizes if 0 < s < window})
            for length, first, hashes in _fingerprints(found, window, short, None):
                for at, h in zip(first.tolist(), hashes.view(np.int64).tolist()):
                    i = int(found.text[at])
                    if length == window or sizes[i] == length:
                        out.append((names[chunk.first + i], h, length, *_context(found, at, min(GRAM, window) if length == window else length, window)))
        yield batch("item string, hash long, length int, item_before int, item_context binary", *[list(x) for x in zip(*out)] or [[]] * 5)

    prints = stage(map_batches(items, item_prints, "item string, hash long, length int, item_before int, item_context binary").distinct(), "items")
    wanted = slot_table(prints, F.col("hash"))
    lengths = sorted(r[0] for r in prints.where(F.col("length") < window).select("length").distinct().collect())  # below `window` values

    def doc_prints(part):
        ids = part.column("doc_id")
        n_words, hashes, sizes, ats, befores, contexts = [], [], [], [], [], []
        for chunk in texts(part.column("text")):
            found = words(chunk, ALNUM)
            n_words.extend(np.diff(found.bounds).tolist())
            lists = [([], [], [], [], []) for _ in range(chunk.n)]
            for length, first, picked in _fingerprints(found, window, lengths, wanted):
                k = min(GRAM, window) if length == window else length
                for at, h in zip(first.tolist(), picked.view(np.int64).tolist()):
                    i = int(found.text[at])
                    before, context = _context(found, at, k, window)
                    for column, value in zip(lists[i], (h, length, at - int(found.bounds[i]), before, context)):
                        column.append(value)
            for column, values in zip((hashes, sizes, ats, befores, contexts), zip(*lists)):
                column.extend(values)
        yield batch(schema, ids, n_words, hashes, sizes, ats, befores, contexts)

    kind = dict(docs.dtypes)["doc_id"].replace("bigint", "long")
    schema = f"doc_id {kind}, n_words long, hash array<long>, length array<int>, at array<long>, before array<int>, context array<binary>"
    base = stage(map_batches(docs, doc_prints, schema).withColumn("row", F.monotonically_increasing_id()), "prints")
    marks = base.where(F.size("hash") > 0).select("row", F.explode(F.arrays_zip("hash", "length", "at", "before", "context")).alias("p")).select("row", "p.*")
    # A fingerprint that stands in many items meets each of them once per text: it is an occurrence of each.
    matched = marks.join(prints, ["hash", "length"]).select("row", "item", "length", "at", "before", "context", "item_before", "item_context")
    spans = stage(map_batches(matched, lambda part: _spans(part, window), "row long, item string, low long, high long").distinct(), "spans")
    n_hit = (
        spans.select("row", "low", "high").distinct().select("row", F.explode(F.sequence(F.col("low"), F.col("high") - 1)).alias("word"))
        .distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    )
    named = spans.where("item is not null").select("row", "item").distinct().groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = base.select("row", "doc_id", "n_words").join(n_hit, "row", "left").join(named, "row", "left")
    hit = F.coalesce("n_hit", F.lit(0))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        ((hit > 0) & (one_in * hit >= F.col("n_words"))).alias("contaminated"),
    )


#: Every window of every text and item, joined; a word's hits are the positions the common windows cover.
CONTAMINATION_SQL = """
WITH dw AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {documents}
), iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), wins AS (
  SELECT item, least(len(w), 13) AS n, unnest(list_transform(range(1, greatest(len(w) - 11, 2)), lambda i: array_to_string(w[i:i + 12], ' '))) AS t
  FROM iw WHERE len(w) > 0
), lens AS (SELECT DISTINCT n FROM wins
), pos AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens
), hits AS (SELECT pos.r, pos.i, pos.n, wins.item FROM pos JOIN wins ON wins.n = pos.n AND array_to_string(pos.w[pos.i:pos.i + pos.n - 1], ' ') = wins.t
), covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), names AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN covered USING (r) LEFT JOIN names USING (r)
"""


@query("op9_benchmark_decontamination", CONTAMINATION_SQL.format(documents="documents"))
def op9_benchmark_decontamination(spark, sf_dir):
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
