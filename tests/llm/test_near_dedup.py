import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from revmart.llm import near_dedup as op
from revmart.llm.common import connected_components

from .helpers import awkward_texts, docs_table, prose, rows_of


def weights(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter({(): 1})


def similarity(a, b):
    total = 0.0
    for i in a.keys() & b.keys():
        total += 1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys())
    return total


def brute(rows):
    bags = [weights(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if find(a) != find(b) and similarity(bags[a], bags[b]) >= 0.8:
                group[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        same = [j for j in range(len(rows)) if find(j) == find(k)]
        known = [rows[j][0] for j in same if rows[j][0] is not None]
        out.append((i, min(known) if known else None, len(same)))
    return sorted(out, key=repr)


def test_awkward_rows(spark):
    rows = [r for r in awkward_texts() if r[0] not in (7, 8)]
    out = op.near_duplicates(docs_table(spark, rows))
    assert rows_of(out, "doc_id", "class_id", "class_size") == brute(rows)
    classes = len({tuple(sorted(op_key)) for op_key in [(str(r[1]), str(r[2])) for r in brute(rows)]})
    assert out.where("kept").count() >= classes
    kept = op.keep_one(docs_table(spark, rows))
    assert kept.columns == docs_table(spark, []).columns
    assert kept.count() == out.where("kept").count()


def test_planted_classes(spark):
    r = random.Random(5)
    rows = []
    for g in range(12):
        base = prose(g, 200).split()
        for _ in range(6):
            copy = list(base)
            for _ in range(r.choice((0, 1, 2, 3, 6))):
                copy[r.randrange(len(copy))] = "edit" + str(r.random())
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + k, prose(100 + k, 150)) for k in range(20)]
    got = op.near_duplicates(docs_table(spark, rows))
    assert rows_of(got, "doc_id", "class_id", "class_size") == brute(rows)


def test_shared_passage_is_no_duplicate(spark):
    common = prose(7, 60)
    rows = [(k, prose(10 + k, 70) + " " + common) for k in range(60)]
    got = op.near_duplicates(docs_table(spark, rows))
    assert got.where("class_size > 1").count() == 0


def test_empty_table(spark):
    assert op.near_duplicates(docs_table(spark, [])).count() == 0
    assert op.keep_one(docs_table(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_exact_similarity(seed):
    r = random.Random(seed)
    a = Counter({k: r.randint(1, 4) for k in r.sample(range(60), 40)})
    b = Counter({k: r.randint(1, 4) for k in r.sample(range(60), 40)})
    arrays = [(np.array(sorted(x), "uint64"), np.array([x[k] for k in sorted(x)], "float64")) for x in (a, b)]
    assert op.probability_jaccard(*arrays[0], *arrays[1]) == pytest.approx(similarity(a, b))
    assert op.probability_jaccard(arrays[0][0], None, arrays[1][0], None) == pytest.approx(len(a.keys() & b.keys()) / len(a.keys() | b.keys()))


def test_signatures_estimate_similarity():
    a, b = Counter(), Counter()
    for k in range(300):
        a[k], b[k] = 1 + k % 3, 1 + k % 2
    for k in range(300, 400):
        (a if k % 2 else b)[k] = 2
    doc, element, weight = [], [], []
    for d, bag in enumerate((a, b)):
        for k, w in bag.items():
            doc.append(d), element.append(int(op.mix(np.array([k + 1], "uint64"))[0])), weight.append(w)
    got = op.prob_min_hash(np.array(doc), np.array(element, "uint64"), np.array(weight, "float64"), 2, places=4000)
    assert (got[0] == got[1]).mean() == pytest.approx(similarity(a, b), abs=0.04)


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 200), (202, 201), (7, 7)]
    got = dict((r["node"], r["component"]) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 201: 200, 202: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long").where(F.lit(False))).count() == 0


def test_workers_hold_a_bounded_stretch_of_texts(spark):
    """Batches for the workers are limited, and of a batch a worker takes a
    million characters at once (a longer text alone)."""
    assert list(op._groups(["x" * 400_000] * 5 + ["y" * 2_000_000])) == [(0, 2), (2, 4), (4, 5), (5, 6)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g")], "doc_id long, text string")
    assert op.near_duplicates(docs).where("kept").count() == 1
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2_000


def test_workers_give_memory_back_after_a_batch():
    """What a batch needed on the way does not stay with the worker."""
    import re

    import pandas as pd
    from revmart.llm.common import freeing

    def held():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read())[1]) / 1024

    def work(texts: pd.Series) -> pd.Series:
        kept = [np.ones(10_000) for _ in range(2_000)]   # 160 MB in pieces below the size that is mapped on its own
        top.append(kept.pop())                           # lies above them, so they can't be cut off the end
        return texts.str.len()
    top, before = [], held()
    assert freeing(work)(pd.Series(["a", "bc"])).tolist() == [1, 2]
    assert held() - before < 60
    assert freeing(work).__annotations__ == work.__annotations__
