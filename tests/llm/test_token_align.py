import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from revmart.llm import token_align as op
from revmart.llm.common import table

from .helpers import awkward_texts, docs_table, prose

SPECIAL = [(50, "a  b   c"), (51, " lead"), (52, "trail "), (53, "a▁b"), (54, "<|endoftext|> <s>x</s> <0x41> <unk>"), (55, "\n a\t b\x00\x1c c"),
           (56, "é́ 🙂🙂 漢字かな ﬀ"), (57, "don't we'll I'm"), (58, "1234567 89"), (59, "a　b​ c\x85d\xa0e"), (60, "� x"), (61, " ")]


def spelled():
    """Bytes of every id, from the libraries' own files and nothing else."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in shown}
    chars.update({chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)})
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    of_a = {i: bytes(chars[c] for c in t) for t, i in a.get_vocab().items() if i != 50256}
    of_b = {}
    for i in range(b.get_piece_size()):
        t = b.id_to_piece(i)
        of_b[i] = bytes([int(t[3:5], 16)]) if re.fullmatch("<0x..>", t) else t.replace("▁", " ").encode()
    return a, b, of_a, of_b


def brute(rows):
    a, b, of_a, of_b = spelled()
    found = []
    for i, text in rows:
        text = text or ""
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        want = (" " + text).encode()
        if not text or b"".join(map(of_a.get, ids_a)) != want or b"".join(map(of_b.get, ids_b)) != want:
            found.append((i, [], [], [], []))
            continue
        spans = []
        for ids, of in ((ids_a, of_a), (ids_b, of_b)):
            at, some = 0, []
            for k in ids:
                some.append((at, at + len(of[k]), k))
                at += len(of[k])
            spans.append(some)
        both = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = [tuple([k for s, e, k in some if lo <= s and e <= hi] for some in spans) for lo, hi in zip([0, *both], both)] if len(want) < 3000 else local(spans, both)
        linked = [(x, y) for lo, hi in zip([0, *both], both) for x, y in pairs(spans, lo, hi)] if len(want) < 3000 else overlap(spans)
        found.append((i, ids_a, ids_b, groups, linked))
    count = Counter(p for *_, linked in found for p in linked)
    top = {}
    for (_, y), c in count.items():
        top[y] = max(top.get(y, 0), c)
    out = []
    for i, ids_a, ids_b, groups, linked in found:
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(ids_a), len(ids_b), len(groups), len(linked), sum(count[p] == top[p[1]] for p in linked), sum(count[p] for p in linked),
                    hashlib.sha256(line.encode()).hexdigest() if line else ""))
    return sorted(out, key=repr)


def pairs(spans, lo, hi):
    return [(x, y) for s, e, x in spans[0] if lo <= s and e <= hi for t, f, y in spans[1] if lo <= t and f <= hi and s < f and t < e]


def local(spans, both):
    """The same groups for long texts: tokens dealt by the end they lie before."""
    out, at = [([], []) for _ in both], {e: k for k, e in enumerate(both)}
    for side, some in enumerate(spans):
        k = 0
        for _, e, token in some:
            out[k][side].append(token)
            k = at[e] + 1 if e in at else k
    return out


def overlap(spans):
    out, j = [], 0
    for s, e, x in spans[0]:
        while spans[1][j][1] <= s:
            j += 1
        k = j
        while k < len(spans[1]) and spans[1][k][0] < e:
            out.append((x, spans[1][k][2]))
            k += 1
    return out


COLS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=repr)


@pytest.mark.parametrize("block_links", [50, 2_000_000])
def test_awkward_rows(spark, block_links):
    rows = awkward_texts() + SPECIAL + [(100 + k, prose(k, 60)) for k in range(20)]
    assert rows_of(op.token_alignment(docs_table(spark, rows), block_links=block_links)) == brute(rows)


def test_given_rows(spark):
    df = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    assert rows_of(op.token_alignment(df)) == brute(rows)


def test_text_ids(spark):
    df = spark.createDataFrame([("x", "some text"), (None, "")], "doc_id string, text string")
    assert [(r["doc_id"], r["n_a"]) for r in op.token_alignment(df).orderBy("n_a").collect()] == [(None, 0), ("x", 2)]


def test_empty_table(spark):
    assert op.token_alignment(docs_table(spark, [])).collect() == []
    assert rows_of(op.token_alignment(docs_table(spark, [(1, None)]))) == [(1, 0, 0, 0, 0, 0, 0, "")]


ends = st.integers(1, 400).flatmap(lambda top: st.tuples(*[st.sets(st.integers(1, top), max_size=top).map(lambda s: sorted(s | {top}))] * 2))


@settings(max_examples=400, deadline=None)
@given(ends)
def test_cuts_are_the_common_ends(both):
    a, b = both
    cuts_a, cuts_b = op.align(a, b)
    common = sorted(set(a) & set(b))
    assert [a[k - 1] for k in cuts_a] == common and [b[k - 1] for k in cuts_b] == common


def test_long_one_to_one_stretch_is_probed_in_few_steps():
    class Counted(list):
        looks = 0

        def __getitem__(self, key):
            Counted.looks += 1
            return super().__getitem__(key)

    a = Counted(range(1, 100_001))
    op.align(a, list(range(1, 100_001)))
    assert Counted.looks < 40


def test_vocabulary_out_of_merge_order(spark, tmp_path):
    """Such a file is run by its own library, with the same rows."""
    import json
    spec = json.load(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8"))
    v = spec["model"]["vocab"]
    x, y = (k for k, i in v.items() if i in (50_000, 50_001))
    v[x], v[y] = v[y], v[x]
    path = tmp_path / "own.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    df = docs_table(spark, SPECIAL)
    assert rows_of(op.token_alignment(df, path_a=str(path))) == rows_of(op.token_alignment(df))


def test_links_are_the_overlaps():
    @settings(max_examples=300, deadline=None)
    @given(ends)
    def check(both):
        a, b = map(np.array, both)
        within = tuple(np.array(x, "int64") for x in op.inner(a, b))
        found = op.links(a, b, *op.align(a, b), *within)
        start_a, start_b = np.append(0, a[:-1]), np.append(0, b[:-1])
        assert sorted(zip(*map(np.ndarray.tolist, found))) == [(i, j) for i in range(len(a)) for j in range(len(b)) if start_a[i] < b[j] and start_b[j] < a[i]]
    check()


PIECES = public_tokenizers.path("piece_bpe_32k.model")
# Characters of the vocabulary and others that begin with the same bytes, digits, marks, controls.
letters = st.one_of(st.sampled_from("aetho sn ' -12.\n\t\x00éßжя漢字々㐀🙂🙃𐍈▁�́　 "), st.characters(exclude_categories=["Cs"]))


@pytest.fixture(scope="module")
def pieces():
    return op.Pieces(PIECES), SentencePieceProcessor(model_file=PIECES)


def test_pieces_by_ranks_are_the_librarys(pieces):
    own, library = pieces

    @settings(max_examples=1500, deadline=None)
    @given(st.lists(st.one_of(st.text(letters, max_size=12), st.sampled_from(["unbelievable", "http://a.b/c", "<0x41>", "</s>", "<|never|>", "a" * 500])), max_size=12))
    def check(words):
        texts = [" ".join(words), "".join(words)]
        assert [ids.tolist() for ids in own.encode(texts)] == library.encode(texts)
    check()
    every = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["x".join(every[k:k + 64]) for k in range(0, len(every), 64)]
    assert [ids.tolist() for ids in own.encode(texts)] == library.encode(texts)


def test_usual_texts_do_not_need_the_library(pieces, monkeypatch):
    own, library = pieces
    sent = []
    monkeypatch.setattr(own, "_library", lambda texts: sent.extend(texts) or [np.array(ids, "int64") for ids in library.encode(texts)])
    usual = [prose(k, 300) for k in range(5)] + ["Zoë's 漢字 🙂, twice.\nand a line ", "x" * 300]
    special = ["", " lead", "two  spaces", "a▁b", "x" * 500]
    assert [ids.tolist() for ids in own.encode(usual + special)] == library.encode(usual + special)
    assert sent == special


@pytest.mark.parametrize("change", ["score", "kind", "trim"])
def test_pieces_of_other_files_are_left_to_the_library(tmp_path, change):
    from sentencepiece import sentencepiece_model_pb2
    spec = sentencepiece_model_pb2.ModelProto.FromString(open(PIECES, "rb").read())
    if change == "score":                   # two kinds of merges that tie
        spec.pieces[1000].score = spec.pieces[1001].score
    elif change == "kind":                  # a piece that is taken wherever it occurs
        spec.pieces[1000].type = spec.SentencePiece.USER_DEFINED
    else:
        spec.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "own.model"
    path.write_bytes(spec.SerializeToString())
    texts = [prose(k, 60) for k in range(3)] + [t for _, t in SPECIAL]
    own, library = op.Pieces(str(path)), SentencePieceProcessor(model_file=str(path))
    assert own._ranked is None
    assert [ids.tolist() for ids in own.encode(texts)] == library.encode(texts)


def test_stand_in_for_a_special_token_is_plain_text(spark):
    rows = [(1, "a <|never|> b<|never|>"), (2, "<|never|>"), (3, "a  <|never|>")]
    assert rows_of(op.token_alignment(docs_table(spark, rows))) == brute(rows)
