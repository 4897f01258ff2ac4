import random

from revmart.llm import decontaminate as op

from .helpers import awkward_texts, docs_table, prose, words


def item(k):
    return prose(1000 + k, 30) + ". " + prose(2000 + k, 8) + "."


def items(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "item_id long, text string, doc_id string, score string")


BENCH = [(k, item(k)) for k in range(30)] + [(100, None), (101, ""), (102, "..."), (103, "tiny one"), (None, "item without an id but with words enough")]


def test_planted_items_are_found(spark):
    rows = [(k, prose(k, 300) + " " + item(k).replace(" ", "\n\t ") + "\n" + prose(k + 50, 200)) for k in range(20)]
    rows += [(100 + k, prose(500 + k, 400)) for k in range(20)] + [(None if i is None else i + 300, t) for i, t in awkward_texts()]
    rows += [(200, item(3) + item(4)), (201, item(5).rsplit(". ", 1)[0] + " " + prose(77, 30))]
    got = {(r["doc_id"], r["item_id"]) for r in op.contaminated(docs_table(spark, rows), items(spark, BENCH)).collect()}
    assert got == {(k, k) for k in range(20)} | {(200, 3), (200, 4)}
    kept = op.clean(docs_table(spark, rows), items(spark, BENCH))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows} - set(range(20)) - {200}
    assert kept.columns == docs_table(spark, []).columns


def test_text_ids_of_items(spark):
    df = spark.createDataFrame([("q-1", item(1)), ("q-2", item(2)), (None, None)], "item_id string, text string")
    rows = [(1, prose(1, 200) + " " + item(2) + " " + prose(2, 100)), (2, prose(3, 100))]
    assert [(r["doc_id"], r["item_id"]) for r in op.contaminated(docs_table(spark, rows), df).collect()] == [(1, "q-2")]
    assert [r["doc_id"] for r in op.clean(docs_table(spark, rows), df).collect()] == [2]


def test_copies_of_long_items_are_found(spark):
    """Exact copies of items of 65 to 2,000 words, at several offsets to the windows."""
    long = [(n, prose(5000 + n, n - 9) + ". " + prose(6000 + n, 9) + ".") for n in (65, 129, 300, 400, 600, 1000, 2000)]
    rows = [(n * 100 + at, prose(7000 + n + at, 100 + at) + " " + t + " " + prose(8000 + n + at, 150)) for n, t in long for at in range(0, 64, 9)]
    rows += [(n * 100 + 99, prose(9000 + n, 3 * n)) for n, _ in long] + [(n * 100 + 98, " ".join(t.split()[:n // 3])) for n, t in long]
    got = op.contaminated(docs_table(spark, rows), items(spark, long + BENCH)).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == sorted((i, i // 100) for i, _ in rows if i % 100 < 90)
    assert all(r["question_overlap"] == r["answer_overlap"] == 1 and r["score"] > 0.999 for r in got)


def test_passes_of_items_agree(spark):
    rows = [(k, prose(k, 100) + " " + item(k)) for k in range(20)]
    one = op.contaminated(docs_table(spark, rows), items(spark, BENCH))
    many = op.contaminated(docs_table(spark, rows), items(spark, BENCH), per_pass=7)
    pairs = lambda df: sorted((r["doc_id"], r["item_id"]) for r in df.collect())
    assert pairs(one) == pairs(many) == [(k, k) for k in range(20)]


def test_blocks_of_items_are_bounded_and_share_their_statistics(spark):
    """Blocks are cut by words as well, and scores don't depend on the cut."""
    rows = [(k, prose(k, 100) + " " + " ".join(w for j, w in enumerate(item(k).split(" ")) if j not in (4, 5))) for k in range(20)] + [(None, None), (99, "")]
    docs, bench = docs_table(spark, rows), items(spark, BENCH)
    pairs = lambda df: sorted((r["doc_id"], r["item_id"], round(r["score"], 9)) for r in df.collect())
    one, many = pairs(op.contaminated(docs, bench)), pairs(op.contaminated(docs, bench, per_pass=7))
    assert one == many and [x[:2] for x in one] == [(k, k) for k in range(20)] and any(x[2] < 1 for x in one)
    kept = op.clean(docs, bench, per_pass=7)
    assert kept.columns == docs.columns and sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == ["99", "None"]
    n, indexes = op.item_indexes(items(spark, [(k, prose(k, 20_000)) for k in range(8)]))
    sizes = [sum(len(q) + len(a) for q, a in x.parts) for x in indexes]
    assert n == len(sizes) > 1 and max(sizes) <= op.WORDS_PER_PASS and sum(sizes) == sum(len(op.words_of(prose(k, 20_000))) for k in range(8))


def test_wand_equals_full_scoring():
    index = op.ItemIndex([(k, item(k)) for k in range(50)])
    rng = random.Random(3)
    vocab = list(index.vocab.values())
    for trial in range(200):
        terms = rng.sample(vocab, rng.randint(1, 60))
        if trial % 2:
            terms = list({index.vocab[w] for w in op.words_of(item(trial % 50))[:rng.randint(5, 38)]} | set(terms[:10]))
        scores = {}
        for t in terms:
            for i, w in index.postings[t]:
                scores[i] = scores.get(i, 0) + w
        for threshold in (0.1, 0.3, 0.5, 0.9):
            want = {i for i, s in scores.items() if s >= threshold}
            assert {i for i, _ in index.search(terms, threshold)} == want


def test_no_window_that_could_match_is_left_out():
    import numpy as np
    index = op.ItemIndex([(k, item(k)) for k in range(40)])
    docs = [words(k, 700) for k in range(6)] + [words(9, 90) + op.words_of(item(7)) + words(8, 20)]
    terms = [np.array([index.vocab.get(w, -1) for w in op.words_of(" ".join(d))]) for d in docs]
    reached = {(d, w) for d, w, _, _ in op.candidate_windows(index, terms, 0.4)}
    for d, t in enumerate(terms):
        for w in range(max(1, -(-(len(t) - op.WINDOW + op.STRIDE) // op.STRIDE))):
            got = {x for x in t[w * op.STRIDE:w * op.STRIDE + op.WINDOW].tolist() if x >= 0}
            best = max((sum(p for x in got for i, p in index.postings[x] if i == k) for k in range(40)), default=0)
            assert best < 0.4 or (d, w) in reached


def test_empty_tables(spark):
    assert op.contaminated(docs_table(spark, []), items(spark, BENCH)).count() == 0
    assert op.contaminated(docs_table(spark), items(spark, [])).count() == 0
    assert op.clean(docs_table(spark), items(spark, [])).count() == len(awkward_texts())
