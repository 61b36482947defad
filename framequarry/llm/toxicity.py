"""Op 10: a classifier chain for categories of unwanted text.

Each category has a linear (logistic) model over hashed words and word beginnings; each but the first also gets the
probabilities of the categories before it. For training those are out-of-fold: predicted by models that did not see the
text, so a model learns how far the earlier ones can be trusted on new texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .registry import batch, column, map_batches, query, read, renamed
from .slots import SLOTS, in_table
from .words import ALNUM, Texts, spans_hash, texts, words

#: Labelled texts the models are fitted on at most; those whose id hashes lowest are taken.
TRAINING_TEXTS = 8000
#: Features a model keeps: those whose presence tells most about its category.
FEATURES = 4096
FOLDS = 3
#: Without labels a category is taken to be as rare as one text in so many.
PRIOR_TEXTS = 20
#: First bytes of a word that are features of their own, beside the word.
HEADS = (4, 5, 6)
#: The chain of the query, in order: whether a label row has the category. The last one is the verdict.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}
THRESHOLD = 0.35


def features(chunk: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of all words, and the text of each."""
    found = words(chunk, ALNUM)
    hashes = spans_hash(ALNUM.folded[chunk.data], found.start, found.end, HEADS)
    longer = [np.ones(len(found.start), bool) if h is None else found.end - found.start > h for h in (*HEADS, None)]
    return np.concatenate([row[ok] for row, ok in zip(hashes, longer)]), np.concatenate([found.text[ok] for ok in longer])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _informative(text: np.ndarray, feature: np.ndarray, label: np.ndarray, n_features: int) -> np.ndarray:
    """The features with the highest chi-square statistic for the label among those in three texts at least."""
    n, positive = len(label), label.sum()
    df = np.bincount(feature, minlength=n_features).astype(float)
    hits = np.bincount(feature, weights=label[text], minlength=n_features)
    expected = df * positive / max(n, 1)
    spread = df * (1 - df / max(n, 1)) * (positive / max(n, 1)) * (1 - positive / max(n, 1))
    score = np.where(df >= 3, (hits - expected) ** 2 / np.maximum(spread, 1e-9), 0)
    best = np.argsort(-score, kind="stable")[:FEATURES]
    return best[score[best] > 6]


def fit_logistic(text: np.ndarray, feature: np.ndarray, dense: np.ndarray, label: np.ndarray, n_features: int, rounds: int = 300, decay: float = 1e-3):
    """Weights of the chosen features, of the dense columns, and the intercept; full-batch Adam, so it is deterministic."""
    n = len(label)
    chosen = _informative(text, feature, label, n_features)
    place = np.full(n_features, -1)
    place[chosen] = np.arange(len(chosen))
    at = place[feature]
    text, at = text[at >= 0], at[at >= 0]
    size = len(chosen) + dense.shape[1] + 1
    weights, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    rate = (label.sum() + 1) / (n + PRIOR_TEXTS)
    weights[-1] = np.log(rate / (1 - rate))
    if len(np.unique(label)) < 2:
        return chosen, weights
    for step in range(1, rounds + 1):
        z = np.bincount(text, weights=weights[at], minlength=n) + dense @ weights[len(chosen) : -1] + weights[-1]
        off = (_sigmoid(z) - label) / n
        slope = np.concatenate([np.bincount(at, weights=off[text], minlength=len(chosen)), dense.T @ off, [off.sum()]])
        slope[:-1] += decay * weights[:-1] / 10
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        weights -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return chosen, weights


def _score(text: np.ndarray, feature: np.ndarray, dense: np.ndarray, model, n: int, n_features: int) -> np.ndarray:
    chosen, weights = model
    value = np.zeros(n_features)
    value[chosen] = weights[: len(chosen)]
    return _sigmoid(np.bincount(text, weights=value[feature], minlength=n) + dense @ weights[len(chosen) : -1] + weights[-1])


def fit_chain(hashes: list[np.ndarray], labels: np.ndarray, fold: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """One (feature hashes, weights) per category, from distinct feature hashes and labels (NaN: unknown) of each text."""
    text = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
    names, feature = np.unique(np.concatenate(hashes) if hashes else np.empty(0, np.uint64), return_inverse=True)
    n, dense, models = len(hashes), np.zeros((len(hashes), 0)), []

    def fitted(rows: np.ndarray, label: np.ndarray):
        number = np.cumsum(rows) - 1
        ok = rows[text]
        return fit_logistic(number[text[ok]], feature[ok], dense[rows], label[rows], len(names))

    for label in labels.T:
        known = ~np.isnan(label)
        out = np.zeros(n)
        for k in range(FOLDS):
            mine = fold == k
            ok = mine[text]
            number = np.cumsum(mine) - 1
            out[mine] = _score(number[text[ok]], feature[ok], dense[mine], fitted(known & ~mine, label), int(mine.sum()), len(names))
        chosen, weights = fitted(known, label)
        models.append((names[chosen], weights))
        dense = np.column_stack([dense, out])
    return models


def train_chain(docs: DataFrame, labels: DataFrame, names: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Fit on at most TRAINING_TEXTS texts of `docs` (doc_id, text), one per id with a row in `labels` (doc_id, one double per name)."""
    picked = labels.where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINING_TEXTS)

    def collect(part):
        hashes = []
        for chunk in texts(part.column("text")):
            found, text = features(chunk)
            order = np.argsort(text, kind="stable")
            cuts = np.searchsorted(text[order], np.arange(chunk.n + 1))
            hashes.extend(np.unique(found[order][lo:hi]).tobytes() for lo, hi in zip(cuts, cuts[1:]))
        yield batch(f"fold long, hashes binary{kinds}", part.column("fold"), hashes, *(part.column(n) for n in names))

    def fit(batches):
        parts = [p for p in batches if p.num_rows]
        hashes = [np.frombuffer(x, np.uint64) for p in parts for x in p.column("hashes").to_pylist()]
        columns = [np.concatenate([p.column(n).to_numpy(zero_copy_only=False) for p in parts]) if parts else np.empty(0) for n in names]
        fold = np.concatenate([p.column("fold").to_numpy() for p in parts]) if parts else np.empty(0, np.int64)
        for k, (found, weights) in enumerate(fit_chain(hashes, np.column_stack(columns).astype(float), fold)):
            yield batch("category long, hashes binary, weights array<double>", [k], [found.tobytes()], [weights.tolist()])

    kinds = "".join(f", {n} double" for n in names)
    # At most TRAINING_TEXTS label rows are broadcast, and as many texts' features meet in the one task that fits: rows
    # that share an id give one text, the one with the smallest hash.
    text = F.coalesce("text", F.lit(""))
    once = docs.join(F.broadcast(picked.select("doc_id")), "doc_id").groupBy("doc_id").agg(F.min_by(text, F.struct(F.xxhash64(text), text)).alias("text"))
    sample = once.join(F.broadcast(picked), "doc_id").select("text", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).alias("fold"), *names)
    rows = (
        map_batches(sample, collect, f"fold long, hashes binary{kinds}").repartition(1).sortWithinPartitions("hashes", "fold", *names)
        .mapInArrow(fit, "category long, hashes binary, weights array<double>").collect()
    )
    if not rows:
        return fit_chain([], np.empty((0, len(names))), np.empty(0, np.int64))
    return [(np.frombuffer(r["hashes"], np.uint64), np.array(r["weights"])) for r in sorted(rows, key=lambda r: r["category"])]


def classify(
    df: DataFrame, labels: DataFrame, categories: dict[str, str] = CATEGORIES, id_column: str = "doc_id", text_column: str = "text",
    threshold: float = THRESHOLD, trained_on: DataFrame | None = None,
) -> DataFrame:
    """One row per row of `df`: doc_id, p_<category> for each category of the chain, and rejected by the last one.

    `labels` (doc_id and what the categories' conditions read) covers some texts of `trained_on` (`df` if not given); a
    condition that is null says nothing about its category. Several labels of one id count as the category if any does.
    Without labels, or with one class only, the probabilities are the smoothed shares of the labels. A null or empty
    text has no features. Rows with a null id are judged, but not trained on; of rows that share an id one is trained on.
    Repeated rows stay. Extra columns are not
    read. An empty table gives no rows.
    """
    names = list(categories)
    own = renamed(df, doc_id=id_column, text=text_column)
    known = labels.select(column(labels, "doc_id").alias("doc_id"), *[F.expr(rule).cast("double").alias(name) for name, rule in categories.items()])
    known = known.groupBy("doc_id").agg(*[F.max(n).alias(n) for n in names])
    models = train_chain(renamed(trained_on, doc_id=id_column, text=text_column) if trained_on is not None else own, known, names)

    hashes = np.unique(np.concatenate([h for h, _ in models])) if models else np.empty(0, np.uint64)
    weights = np.zeros((len(models), len(hashes)))
    for k, (found, values) in enumerate(models):
        weights[k, np.searchsorted(hashes, found)] = values[: len(found)]
    tails = [values[len(found) :] for found, values in models]
    table = np.zeros(SLOTS // 8, np.uint8)
    slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
    np.bitwise_or.at(table, slot >> 3, np.left_shift(1, slot & 7).astype(np.uint8))

    def judge(part):
        columns = [[] for _ in names]
        for chunk in texts(part.column("text")):
            found, text = features(chunk)
            ok = in_table(table, found)
            found, text = found[ok], text[ok]
            at = np.searchsorted(hashes, found)
            ok = hashes[np.minimum(at, len(hashes) - 1)] == found if len(hashes) else np.zeros(0, bool)
            pair = np.unique(text[ok] * np.int64(max(len(hashes), 1)) + at[ok])
            text, at = pair // max(len(hashes), 1), pair % max(len(hashes), 1)
            earlier = np.zeros((chunk.n, 0))
            for k, tail in enumerate(tails):
                z = np.bincount(text, weights=weights[k][at], minlength=chunk.n) + earlier @ tail[:-1] + tail[-1]
                earlier = np.column_stack([earlier, _sigmoid(z)])
                columns[k].append(earlier[:, k])
        yield batch(schema, part.column("doc_id"), *[pa.array(np.concatenate(c)) for c in columns], pa.array(np.concatenate(columns[-1]) >= threshold))

    kind = dict(own.dtypes)["doc_id"].replace("bigint", "long")
    schema = f"doc_id {kind}, {', '.join(f'p_{n} double' for n in names)}, rejected boolean"
    return map_batches(own, judge, schema)


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
