import hashlib
import re

from pyspark.sql import functions as F

from revmart.llm import exact_dedup as op

from .helpers import awkward_texts, docs_table, rows_of


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out, used = [], set()
    for (i, _), n in zip(rows, norm):
        ids = [j for (j, _), m in zip(rows, norm) if m == n]
        known = [j for j in ids if j is not None]
        keep = min(known) if known else None
        kept = i == keep and n not in used
        used |= {n} if kept else set()
        out.append((i, keep, len(ids), kept, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(df, **kw):
    return op.exact_dedup(df, carry={"text_sha256": F.sha2(F.col("norm"), 256)}, **kw)


COLS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_awkward_rows(spark):
    assert rows_of(run(docs_table(spark)), *COLS) == brute(awkward_texts())


def test_full_filter_stays_exact(spark):
    rows = awkward_texts() + [(k, f"text {k % 7} of many") for k in range(100, 160)]
    assert rows_of(run(docs_table(spark, rows), prefix_chars=4, log2_words=1), *COLS) == brute(rows)


def test_equal_length_and_prefix_differ_later(spark):
    rows = [(1, "p" * 200 + "a"), (2, "p" * 200 + "b"), (3, "p" * 200 + "a")]
    assert rows_of(run(docs_table(spark, rows)), *COLS) == brute(rows)


def test_empty_table(spark):
    assert run(docs_table(spark, [])).count() == 0


def test_no_python_on_the_path(spark):
    plan = run(docs_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
