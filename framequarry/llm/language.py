"""Op 2: language identification by partial matching.

Each language has a tree of byte contexts, up to ORDER bytes deep, with frozen counts. A byte's code length is that in
the longest context in which the language has seen it, plus the cost of the escapes from the longer ones (method C:
`distinct / (total + distinct)`), and 8 bits below the empty context. The language with the shortest code for the whole
text is predicted.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .registry import batch, map_batches, query, read, renamed
from .words import Texts, texts

#: Bytes of context; the counted n-grams are one byte longer.
ORDER = 3
HELD_OUT_FOLD = 1
#: Labelled texts a language is learned from, about, where it has more.
LEARNED_TEXTS = 50_000

_FOLDED = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])


class Tree(NamedTuple):
    """One language's code lengths in bits, by sorted n-grams that it has seen, and the escape costs of its contexts."""

    pairs: np.ndarray  # of every pair of bytes, escapes included
    escape2: np.ndarray  # of every context of two bytes
    keys3: np.ndarray
    cost3: np.ndarray
    contexts3: np.ndarray
    escape3: np.ndarray
    keys4: np.ndarray
    cost4: np.ndarray


class Trees(NamedTuple):
    """A tree per language; each holds its own n-grams only, so that many languages cost the sum of their sizes."""

    names: list[str]
    trees: list[Tree]


def grams(chunk: Texts) -> np.ndarray:
    """The last ORDER + 1 bytes at every byte, as one number; blanks stand before a text's beginning."""
    data = _FOLDED[chunk.data].astype(np.uint32)
    found = data.copy()
    n = len(data)
    for back in range(1, ORDER + 1):
        before = np.full(n, 32, np.uint32)
        before[back:] = data[:-back] if back < n else data[:0]
        for offset in range(back):
            at = chunk.offsets[:-1] + offset
            ok = (at < chunk.offsets[1:]) & (at < n)
            before[at[ok]] = 32
        found |= before << np.uint32(8 * back)
    return found


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all texts of `docs` (text, lang)."""

    def count(batches):
        totals: dict[str, list] = {}

        def merged(parts):
            keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return keys, np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)

        for part in batches:
            lang = np.array(part.column("lang").to_pylist(), dtype=object)
            for chunk in texts(part.column("text")):
                found = grams(chunk)
                sizes = np.diff(chunk.offsets)
                names = lang[chunk.first : chunk.first + chunk.n]
                for name in set(names):
                    parts = totals.setdefault(name, [])
                    parts.append(np.unique(found[np.repeat(names == name, sizes)], return_counts=True))
                    if len(parts) == 16:
                        totals[name] = [merged(parts)]
        for name, parts in totals.items():
            keys, n = merged(parts)
            yield batch("lang string, gram long, n long", pa.array([name] * len(keys)), keys, n)

    return docs.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _below(keys: np.ndarray, counts: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the n-grams one byte shorter: sums over what ends alike. Contexts that end none are there with zeros."""
    ends = keys & np.uint32((1 << shift) - 1)
    found = np.union1d(ends, keys >> np.uint32(8))
    sums = np.zeros((len(found), counts.shape[1]))
    np.add.at(sums, np.searchsorted(found, ends), counts)
    return found, sums


def _contexts(keys: np.ndarray, counts: np.ndarray):
    """For each n-gram its context's number, and total and distinct followers of each context."""
    context, at = np.unique(keys >> np.uint32(8), return_inverse=True)
    total, distinct = np.zeros((len(context), counts.shape[1])), np.zeros((len(context), counts.shape[1]))
    np.add.at(total, at, counts)
    np.add.at(distinct, at, counts > 0)
    return context, at, total, distinct


def _level(keys, counts, lower):
    """Code lengths of the n-grams and escape costs of their contexts; `lower` are the code lengths one order down."""
    context, at, total, distinct = _contexts(keys, counts)
    escape = np.where(total > 0, -np.log2(np.maximum(distinct, 1) / np.maximum(total + distinct, 1)), 0.0)
    own = -np.log2(np.maximum(counts, 1) / np.maximum((total + distinct)[at], 1))
    return np.where(counts > 0, own, escape[at] + lower), context, escape


def _tree(gram: np.ndarray, n: np.ndarray) -> Tree:
    """A language's tree from the counts of its n-grams of four bytes."""
    order = np.argsort(gram, kind="stable")
    keys4, counts4 = gram[order].astype(np.uint32), n[order].astype(float)[:, None]
    keys3, counts3 = _below(keys4, counts4, 24)
    keys2, counts2 = _below(keys3, counts3, 16)
    keys1, counts1 = _below(keys2, counts2, 8)
    all1, all2 = np.zeros((256, 1)), np.zeros((65536, 1))
    all1[keys1], all2[keys2] = counts1, counts2
    cost1, _, _ = _level(np.arange(256, dtype=np.uint32), all1, 8.0)
    pairs = np.arange(65536, dtype=np.uint32)
    cost2, _, _ = _level(pairs, all2, cost1[pairs & 255])
    cost3, context2, esc2 = _level(keys3, counts3, cost2[keys3 & np.uint32(0xFFFF)])
    escape2 = np.zeros(65536, np.float32)
    escape2[context2] = esc2[:, 0]
    cost4, context3, esc3 = _level(keys4, counts4, cost3[np.searchsorted(keys3, keys4 & np.uint32(0xFFFFFF))])
    return Tree(*(x.reshape(-1).astype(x.dtype if x.dtype == np.uint32 else np.float32) for x in (cost2, escape2, keys3, cost3, context3, esc3, keys4, cost4)))


def build_trees(names: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Trees:
    """The trees of all languages from counts of n-grams of four bytes; `lang` numbers the names."""
    order = np.argsort(lang, kind="stable")
    cuts = np.searchsorted(lang[order], np.arange(len(names) + 1))
    return Trees(names, [_tree(gram[order[lo:hi]], n[order[lo:hi]]) for lo, hi in zip(cuts, cuts[1:])])


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise: np.ndarray | float) -> np.ndarray:
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, values[place], otherwise)


def _costs(tree: Tree, found: np.ndarray) -> np.ndarray:
    """Bits of the last byte of each n-gram."""
    lowest = tree.escape2[(found >> np.uint32(8)) & np.uint32(0xFFFF)] + tree.pairs[found & np.uint32(0xFFFF)]
    lower = _found(tree.keys3, tree.cost3, found & np.uint32(0xFFFFFF), lowest)
    return _found(tree.keys4, tree.cost4, found, _found(tree.contexts3, tree.escape3, found >> np.uint32(8), 0.0) + lower)


def code_lengths(chunk: Texts, trees: Trees) -> np.ndarray:
    """Bits of each text under each language; every distinct n-gram of the chunk is looked up once per language."""
    distinct, at = np.unique(grams(chunk), return_inverse=True)
    sums = np.zeros((chunk.n, len(trees.names)))
    filled = np.flatnonzero(np.diff(chunk.offsets) > 0)
    if len(filled):
        for k, tree in enumerate(trees.trees):
            sums[filled, k] = np.add.reduceat(_costs(tree, distinct)[at], chunk.offsets[filled], dtype=np.float64)
    return sums


def has_letter(chunk: Texts) -> np.ndarray:
    """Whether each text holds a letter of any script."""
    total = np.concatenate([[0], np.cumsum(_LETTER[chunk.data])])
    found = total[chunk.offsets[1:]] > total[chunk.offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(chunk.offsets) > 0)):
        found[i] = any(c.isalpha() for c in chunk.data[chunk.offsets[i] : chunk.offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def fit_trees(docs: DataFrame, learned_texts: int = LEARNED_TEXTS) -> Trees | None:
    """Trees of all languages in `docs` (text, lang), each from about `learned_texts` of its texts at most.

    The texts whose hash is low are taken, so a language with fewer is learned from all of them, and the result does not
    depend on the order of rows. A row per language and distinct n-gram of those texts comes to the driver.
    """
    known = docs.where("text is not null and lang is not null")
    sizes = known.groupBy("lang").agg(F.count("*").alias("size")).withColumn("bound", F.lit(float(2**31)) * F.least(F.lit(1.0), learned_texts / F.col("size")))
    # One row per language.
    bounds = {r["lang"]: r["bound"] for r in sizes.collect()}
    if not bounds:
        return None
    low = F.element_at(F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair]), F.col("lang"))
    found = gram_counts(known.where(F.pmod(F.xxhash64("text"), F.lit(2**31)) < low)).toPandas()
    if not len(found):
        return None
    names, lang = np.unique(found["lang"].to_numpy(str), return_inverse=True)
    return build_trees([str(x) for x in names], lang, found["gram"].to_numpy(), found["n"].to_numpy())


def identify_language(df: DataFrame, trees: Trees | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `df`: doc_id, lang_pred, score.

    The score is the posterior probability of the predicted language, with equal priors, given the code lengths of the
    whole text. A text that is null or has no letter of any script is `und` with score 0, as is every text where no
    language was learned; of languages with one code length the first by name is taken. Repeated rows stay; extra
    columns are not read; an empty table gives no rows.
    """
    docs = renamed(df, doc_id=id_column, text=text_column)
    kind = dict(docs.dtypes)["doc_id"].replace("bigint", "long")
    schema = f"doc_id {kind}, lang_pred string, score double"
    # Plain arrays: a worker needs no class to read them.
    held = docs.sparkSession.sparkContext.broadcast(trees and (trees.names, [tuple(t) for t in trees.trees]))

    def predict(part):
        learned = held.value and Trees(held.value[0], [Tree(*t) for t in held.value[1]])
        names, scores = [], []
        for chunk in texts(part.column("text")):
            letters = has_letter(chunk)
            if learned is None:
                names.extend(["und"] * chunk.n)
                scores.extend([0.0] * chunk.n)
                continue
            bits = code_lengths(chunk, learned)
            best = bits.argmin(axis=1)
            odds = np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
            names.extend(learned.names[b] if ok else "und" for b, ok in zip(best, letters))
            scores.extend(np.where(letters, 1 / odds, 0.0).tolist())
        yield batch(schema, part.column("doc_id"), names, scores)

    return map_batches(docs, predict, schema)


@query("op2_language_id")
def op2_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    trees = fit_trees(docs.where(fold != HELD_OUT_FOLD).select("text", "lang"))
    held_out = F.coalesce(fold == HELD_OUT_FOLD, F.lit(False))
    return identify_language(docs, trees).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
