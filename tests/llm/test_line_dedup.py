import pytest

from revmart.llm import line_dedup as op

from .helpers import awkward_texts, docs_table, rows_of

SPACE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, min_chars=10):
    rank = lambda i: -2**63 if i is None else i
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(key_of(line), set()).add(rank(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(k := key_of(x)) < min_chars or len(holders[k]) < 2 or min(holders[k]) == rank(i)]
        out.append((i, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=repr)


COLS = ("doc_id", "kept_text", "n_lines", "n_dropped")


@pytest.mark.parametrize("log2_words", [None, 13, 19])
def test_awkward_rows(spark, log2_words):
    out = op.line_dedup(docs_table(spark), keep=("doc_id",), log2_words=log2_words)
    assert rows_of(out, *COLS) == brute(awkward_texts())


def test_crowded_filter_stays_exact(spark):
    rows = [(k, "\n".join(f"line number {(k * j) % 97} of the set" for j in range(60))) for k in range(40)]
    df = docs_table(spark, rows).repartition(7)
    assert rows_of(op.line_dedup(df, keep=("doc_id",), log2_words=13), *COLS) == brute(rows)


def test_empty_table(spark):
    assert op.line_dedup(docs_table(spark, []), keep=("doc_id",)).count() == 0


def test_filters_grow_with_their_keys_up_to_a_bound():
    sizes = [op.log2_for(n, op.LOG2_MOST) for n in (0, 1, 8 << 13, (8 << 13) + 1, 3_000_000, 8 << 22, 10**12)]
    assert sizes == [13, 13, 13, 14, 19, 22, 22]


def test_hot_line(spark):
    """A line with a third of all rows takes the way of the sent keys, rare
    ones that of the shuffle."""
    rows = [(k, "\n".join(["the line that stands everywhere"] * (1 + k % 3) + [f"a line that only two hold {(k * 2 + j) % 1500}" for j in range(4)]))
            for k in range(750)]
    assert rows_of(op.line_dedup(docs_table(spark, rows).repartition(4), keep=("doc_id",)), *COLS) == brute(rows)


def test_texts_without_dropped_lines_stay_where_they_are(spark):
    """The texts that meet their dropped lines are behind the third filter;
    the others come out of a branch without an exchange."""
    rows = [(k, f"a line of text number {k} alone\n" + ("one line that many hold" if k % 10 == 0 else "short")) for k in range(300)]
    out = op.line_dedup(docs_table(spark, rows).repartition(3), keep=("doc_id",))
    assert rows_of(out, *COLS) == brute(rows)
    plan = out._jdf.queryExecution().optimizedPlan()
    joins = [plan.children().apply(k).toString().count("Join ") for k in (0, 1)]
    assert plan.nodeName() == "Union" and joins == [1, 2]       # the filter alone; the filter, then the dropped lines


def test_merge_misses_no_repeat():
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(0)
    n_words = op.SEGMENT_WORDS
    tasks = [pd.DataFrame({"word": rng.integers(0, n_words, 4000), "bits": rng.integers(1, 2**62, 4000) & 0x111}) for _ in range(3)]
    merged = pd.concat(op._merge_filters(list(b for t in tasks for b in op._task_filters(n_words)([t]))))
    twice = {s * n_words + k: b for s, bits in zip(merged["segment"], merged["bits"]) for k, b in enumerate(bits)}
    seen = set()
    for t in tasks:
        for w, b in zip(t["word"], t["bits"]):
            if (w, b) in seen:
                assert twice.get(w, 0) & b == b
            seen.add((w, b))
