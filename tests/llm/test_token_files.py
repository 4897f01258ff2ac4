import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from revmart.llm import token_files as op
from revmart.llm.common import scratch_path

from .helpers import awkward_texts, docs_table, prose

SPECIAL = [(50, "it's THE end, isn't it?  a\x85b\xa0c d\x1ce\x1f f"), (51, "é ́x  ﬀ ǅ İI 12345 ¼"), (52, "<|startoftext|> a<|endoftext|>b "), (54, "<|ENDOFTEXT|> <|endoftext| x<|endoftext|><|startoftext|>É<|endoftext|>\u0301"), (53, "co-op,and;or...(yes)[no]!?")]


OWN = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def whole(text):
    return OWN.encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("shard_tokens,partition_bytes", [(500, 60_000), (1 << 20, 24_000_000)])
def test_read_back(spark, shard_tokens, partition_bytes):
    rows = awkward_texts() + SPECIAL + [(100 + k, prose(k, 50)) for k in range(30)]
    path = scratch_path(spark, "tokens")
    op.write_tokens(docs_table(spark, rows), path, shard_tokens=shard_tokens, partition_bytes=partition_bytes)
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in op.read_tokens(spark, path).collect()), key=lambda r: r[0])
    at = 0
    for start, _, n, ids in got:
        assert start == at and n == len(ids) // 4
        at += n
    order = [d for _, d, _, _ in got]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    want = sorted(((i, np.array(whole(t), "<u4").tobytes()) for i, t in rows), key=repr)
    assert sorted(((d, ids) for _, d, _, ids in got), key=repr) == want


def test_empty_table(spark):
    path = scratch_path(spark, "tokens")
    op.write_tokens(docs_table(spark, []), path)
    assert op.read_tokens(spark, path).count() == 0


@pytest.mark.parametrize("n,high,planes", [(0, 1, 4), (1, 2, 1), (5000, 7, 3), (20_000, 49_408, 16)])
def test_wavelet_matrix(n, high, planes):
    rng = np.random.default_rng(n)
    values = (rng.integers(0, high, n) * rng.integers(0, 2, n)).astype("uint16")
    data = op.write_shard(3, 17, [None, 5], [n, 0], values, planes)
    shard = op.Shard(data)
    assert (shard.partition, shard.before, shard.ids, shard.lengths.tolist()) == (3, 17, [None, 5], [n, 0])
    m = shard.tokens
    assert (m.decode() == values).all()
    if not n:
        return
    at = rng.integers(0, n, 300)
    assert (m.access(at) == values[at]).all()
    for v in {0, int(values[-1]), int(values[n // 2])}:
        lo, hi = sorted(rng.integers(0, n + 1, 2).tolist())
        assert m.count(v, lo, hi) == int((values[lo:hi] == v).sum())
        places = np.flatnonzero(values == v)
        for k in {0, len(places) // 2, len(places) - 1}:
            assert m.select(v, k) == places[k]
    assert m.count(high if high < 1 << planes else 0) == int((values == (high if high < 1 << planes else 0)).sum())
    few = int(values.max())
    if (values == few).sum() < 50:
        assert m.occurrences(few) == np.flatnonzero(values == few).tolist()
    with pytest.raises(IndexError):
        m.select(few, int((values == few).sum()))


def test_a_point_is_read_without_the_whole_file():
    values = np.random.default_rng(1).integers(0, 49_408, 3_000_000).astype("uint16")
    shard = op.Shard(op.write_shard(0, 0, [1], [len(values)], values))
    opened = []
    inner = shard.tokens._plane
    shard.tokens._plane = lambda k, lo, hi: opened.append(hi - lo) or inner(k, lo, hi)
    assert shard.tokens.access([2_500_000])[0] == values[2_500_000]
    assert sum(opened) <= 16 * 2 * op.SUPER


ALPHABET = [*"abAZzé ÉÀÞßÿ×÷ªº²µ¼'’“–12 .,!?-<|>&\t\n\r\x0b\x0c\x1c\x85\xa0\u3000\u0301\u0345İıǅﬀ\u212a漢字あ한가😀\x00\x7f", "'s", "'re", "'LL",
            "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "\u200d", "the", " ", " "]


@pytest.mark.parametrize("together,segment", [(1, 1), (500, 37), (20_000, 1_000), (12_000_000, 1_000_000)])
def test_any_cut_gives_the_ids_of_the_library(together, segment):
    rng = random.Random(segment)
    texts = ["", " ", *("".join(rng.choices(ALPHABET, k=rng.randrange(60))) for _ in range(2_000)), "\n\n", ""]
    got = list(op.tokenise(texts, public_tokenizers.path(op.TOKENIZER), together, segment))
    assert got == [np.array(whole(t)[:-1], "<u2").tobytes() for t in texts]


def test_nothing_to_tokenise():
    path = public_tokenizers.path(op.TOKENIZER)
    assert list(op.tokenise([], path)) == []
    assert list(op.tokenise(["", " \n", ""], path)) == [b"", b"", b""]


def test_unlike_words_of_known_pieces_are_not_learned_anew():
    path = public_tokenizers.path(op.TOKENIZER)
    learned = lambda: sum(len(v) for v in op.worker_cache().values() if isinstance(v, dict))
    before = learned()
    text = " ".join(f"{k}-{7 * k}é,Word{k}" for k in range(5_000))
    assert list(op.tokenise([text], path)) == [np.array(whole(text)[:-1], "<u2").tobytes()]
    assert learned() - before <= 30
    list(op.tokenise(["漢" * 1_000], path))     # long pieces aren't kept
    assert learned() - before <= 30
