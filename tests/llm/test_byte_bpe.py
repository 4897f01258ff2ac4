import numpy as np
import public_tokenizers
import pytest

from revmart.llm import byte_bpe as op

from .helpers import awkward_texts, docs_table, prose, rows_of


def brute(rows):
    enc = op.load_encoding(public_tokenizers.path(op.RANKS))
    return sorted(((i, np.array(enc.encode_ordinary(t or ""), "<u4").tobytes()) for i, t in rows), key=repr)


def ids(df):
    return sorted(((r["doc_id"], bytes(r["ids"])) for r in df.collect()), key=repr)


def test_awkward_rows(spark):
    assert ids(op.encode_documents(docs_table(spark))) == brute(awkward_texts())


@pytest.mark.parametrize("chunk,overlap", [(64, 24), (97, 16), (1000, 100)])
def test_chunks_stitch_to_the_whole(spark, chunk, overlap):
    rows = awkward_texts() + [(100, prose(5, 400) + "   \n\n  it's we'll 'ru  " + "漢字" * 300 + "!?" * 90 + " 12345" * 50), (101, "  \n" * 200 + "a" * 500 + "\t" * 77)]
    assert ids(op.encode_documents(docs_table(spark, rows), chunk=chunk, overlap=overlap)) == brute(rows)


def test_round_trip(spark):
    import hashlib
    want = sorted(((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in awkward_texts()), key=repr)
    assert rows_of(op.round_trip(docs_table(spark)), "doc_id", "decoded_sha256") == want


def test_empty_table(spark):
    assert op.round_trip(docs_table(spark, [])).count() == 0
