import zlib

import numpy as np
import pytest

from revmart.llm import toxicity as op

from .helpers import awkward_texts, docs_table, prose

BAD = ["gruxle", "vombat", "snidor", "plefix", "quorgs"]


def corpus(n):
    rows, labels = [], []
    for k in range(n):
        words = prose(k, 60).split()
        toxic = k % 6 == 0
        if toxic:
            for j in range(1 + k % 3):
                words.insert((7 * k + j) % len(words), BAD[(k + j) % 5] + ("er" if k % 4 else ""))
        rows.append((k, " ".join(words)))
        if k % 2 == 0 or toxic:
            labels.append((k, 0, int(toxic)))
    return rows, labels


def labels_table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, quality int, toxic int, text string")


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    rows, labels = corpus(600)
    model, facts = op.fit(docs_table(spark, rows), labels_table(spark, labels + [(None, 0, 1), (3, 0, None), (4, 0, 0)]))
    got = {r["doc_id"]: r["score"] for r in op.scores(model, facts).collect()}
    assert len(got) == 600 and all(0 <= s <= 1 for s in got.values())
    wrong = [i for i, s in got.items() if held(i) and (s >= op.THRESHOLD) != (i % 6 == 0)]
    assert len(wrong) <= 2
    # Scoring a text column gives the same scores.
    df = docs_table(spark, rows)
    again = {r["doc_id"]: r["s"] for r in df.withColumn("s", op.score_column(model, df["text"])).collect()}
    assert again == pytest.approx(got)


def test_held_out_labels_are_never_learnt(spark):
    rows, labels = corpus(200)
    flipped = [(i, q, 1 - t if held(i) else t) for i, q, t in labels]
    a, _ = op.fit(docs_table(spark, rows), labels_table(spark, labels))
    b, _ = op.fit(docs_table(spark, rows), labels_table(spark, flipped))
    assert a.entries == b.entries and np.allclose(a.weights, b.weights)


def test_other_labels_are_no_labels(spark):
    """Labels other than 0 and 1 are as if they were not there."""
    rows, labels = corpus(200)
    a, _ = op.fit(docs_table(spark, rows), labels_table(spark, labels))
    b, _ = op.fit(docs_table(spark, rows + [(900, "x y z"), (901, "more words here")]), labels_table(spark, labels + [(900, 0, 2), (901, 0, -1)]))
    assert a.entries == b.entries


def test_awkward_rows_and_no_labels(spark):
    model, facts = op.fit(docs_table(spark), labels_table(spark, []))
    assert op.scores(model, facts).count() == len(awkward_texts())
    model, facts = op.fit(docs_table(spark, []), labels_table(spark, [(1, 0, 1)]))
    assert op.scores(model, facts).count() == 0


def test_label_model_finds_accuracies_and_dependence():
    rng = np.random.default_rng(2)
    n = 40_000
    y = rng.random(n) < 0.2
    fire = lambda p1, p0: np.where(y, rng.random(n) < p1, rng.random(n) < p0)
    a, b, d = fire(0.8, 0.05), fire(0.7, 0.02), fire(0.6, 0.1)
    c = np.where(rng.random(n) < 0.9, a, fire(0.5, 0.5))  # nearly a copy of the first
    votes, counts = np.unique(np.stack([a, b, c, d], 1).astype(int), axis=0, return_counts=True)
    known = rng.random(n) < 0.05  # labelled rows
    pattern = (np.stack([a, b, c, d], 1) @ np.array([8, 4, 2, 1])).astype(int)
    rows = votes @ np.array([8, 4, 2, 1])
    of = lambda which: np.bincount(pattern[which], minlength=16)[rows].astype(float)
    model = op.LabelModel().fit(votes, counts.astype(float), of(known & y), of(known & ~y), rounds=200)
    pairs = {frozenset((j, p)) for j, p in enumerate(model.parent) if p >= 0}
    assert frozenset((0, 2)) in pairs
    assert model.accuracy[1] == pytest.approx([0.02, 0.7], abs=0.12)
    assert model.prior == pytest.approx(0.2, abs=0.06)
