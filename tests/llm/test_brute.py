"""Operators without SQL against plain loops: repeated spans and the scores of a classifier chain."""

import math
import re

import numpy as np
import pytest
from framequarry.llm import line_dedup, sentence_spans, toxicity
from framequarry.llm.words import ALNUM, spans_hash
from pyspark.sql import functions as F


def sentences(text):
    """Word ranges of the sentences of a text."""
    own = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    starts = [i for i, (a, _) in enumerate(own) if i == 0 or "\n" in text[own[i - 1][1] : a] or re.search(r"[.!?][\"')\]}]{0,2}$", text[slice(*own[i - 1])])]
    return [text[a:b] for a, b in own], [*starts, len(own)]


def spans(edge, least=20, most=40, several=3):
    """The shortest run from each sentence on, and up to each."""
    found, n = set(), len(edge) - 1
    for i in range(n):
        for j in range(i + 1, n + 1):
            size = edge[j] - edge[i]
            if size >= most or j - i >= several and size >= least:
                found.add((edge[i], edge[j]))
                break
    for j in range(1, n + 1):
        for i in range(j - 1, -1, -1):
            size = edge[j] - edge[i]
            if size >= most or j - i >= several and size >= least:
                found.add((edge[i], edge[j]))
                break
    return sorted(found)


@pytest.mark.parametrize("seed", range(4))
def test_repeated_spans(spark, seed):
    rng = np.random.default_rng(seed)
    pool = [" ".join(f"w{rng.integers(0, 50)}" for _ in range(rng.choice([3, 8, 15, 45]))) + str(rng.choice([".", "!", '."', "?)", "."])) for _ in range(25)]
    docs = []
    for i in range(60):
        picked = [pool[k] for k in (rng.integers(0, 25) + np.arange(rng.integers(0, 9))) % 25] if rng.random() < 0.6 else [pool[k] for k in rng.integers(0, 25, rng.integers(0, 9))]
        docs.append((i, "".join(s + str(rng.choice([" ", "\n", "  "])) for s in picked)))
    places = {}
    for i, text in docs:
        own, edge = sentences(text)
        for lo, hi in spans(edge):
            places.setdefault(tuple(own[lo:hi]), []).append((i, lo, hi))
    gone = {i: set() for i, _ in docs}
    for found in places.values():
        for i, lo, hi in sorted(found)[1:]:
            gone[i].update(range(lo, hi))
    got = {r.doc_id: r for r in sentence_spans.drop_repeated_spans(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert sum(map(len, gone.values())) > 0
    for i, text in docs:
        own, edge = sentences(text)
        assert got[i].n_sentences == len(edge) - 1 and got[i].n_words_removed == len(gone[i])
        assert sentences(got[i].text)[0] == [w for k, w in enumerate(own) if k not in gone[i]]


def features(text):
    found = set()
    for word in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text):
        data = re.sub("[A-Z]", lambda m: m[0].lower(), word).encode()
        raw = np.frombuffer(data, np.uint8)
        for size in [h for h in toxicity.HEADS if len(data) > h] + [len(data)]:
            found.add(int(spans_hash(ALNUM.folded[raw], np.array([0]), np.array([size]))[0]))
    return found


def test_scores_of_the_chain(spark):
    rng = np.random.default_rng(8)
    docs = [(i, " ".join(f"{'bad' if i % 3 == 0 and rng.random() < 0.3 else 'fine'}word{rng.integers(0, 30)}" for _ in range(20))) for i in range(150)] + [(500, None), (501, ""), (502, "ünïcode badword1 X")]
    labels = [(i, 0 if i % 5 == 0 else 1, int(i % 3 == 0)) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    known = told.select("doc_id", *[F.expr(rule).cast("double").alias(n) for n, rule in toxicity.CATEGORIES.items()])
    models = toxicity.train_chain(df, known, list(toxicity.CATEGORIES))
    got = {r.doc_id: r for r in toxicity.classify(df, told).collect()}
    for i, text in docs:
        own, earlier = features(text or ""), []
        for (hashes, weights), name in zip(models, toxicity.CATEGORIES):
            n = len(hashes)
            z = sum(w for h, w in zip(hashes.tolist(), weights) if h in own) + sum(p * w for p, w in zip(earlier, weights[n:])) + weights[-1]
            earlier.append(1 / (1 + math.exp(-min(max(z, -30), 30))))
            assert abs(got[i][f"p_{name}"] - earlier[-1]) < 1e-9
        assert got[i].rejected == (earlier[-1] >= toxicity.THRESHOLD)


def test_rows_of_one_id_are_trained_on_once(spark):
    docs = [(1, f"some text {i}") for i in range(3000)] + [(i, f"other words {i}") for i in range(2, 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1.0 * (i % 2)) for i in range(1, 40)], "doc_id long, bad double")
    models = toxicity.train_chain(df, labels, ["bad"])
    # The same models come from one text of that id only: the one whose hash is the smallest.
    least = df.where("doc_id = 1").orderBy(F.xxhash64("text")).limit(1)
    single = toxicity.train_chain(least.unionByName(df.where("doc_id > 1")), labels, ["bad"])
    assert all(np.array_equal(a, b) for x, y in zip(models, single) for a, b in zip(x, y))


def test_line_dedup_replaces_its_own_column(spark):
    text = "one line\ntwo lines\nthree lines\nfour"
    df = spark.createDataFrame([(1, text, 7, "a"), (2, text, 8, "b")], "doc_id long, text string, n_lines_removed int, cut string")
    got = line_dedup.drop_repeated_lines(df)
    assert got.columns == ["doc_id", "text", "cut", "n_lines_removed"]
    assert sorted(map(tuple, got.collect())) == [(1, text, "a", 0), (2, "", "b", 4)]
