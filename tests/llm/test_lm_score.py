import math
import zlib
from collections import Counter, defaultdict

import pytest

from revmart.llm import lm_score as op

from .helpers import awkward_texts, docs_table, prose

K = op.ORDER


def brute(rows):
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    bodies = [(t or "").encode().lower() for _, t in rows]
    words, nodes = Counter(), defaultdict(Counter)
    strings = [b"\xfe" * K + b + b"\xff" for b in bodies]
    for s, b, h in zip(strings, bodies, held):
        if not h:
            words.update(b.split() + [b"\n"])
            for p in range(K, len(s)):
                for k in range(K + 1):
                    nodes[s[p - k:p]][s[p]] += 1
    n, v = sum(words.values()), len(words)

    def log_p(context, symbol):
        gone, out = set(), 0.0
        for k in range(K, -1, -1):
            left = {x: c for x, c in nodes.get(context[K - k:], {}).items() if x not in gone}
            if not left:
                continue
            total = sum(left.values()) + len(left)
            if symbol in left:
                return out + math.log10(left[symbol] / total)
            out += math.log10(len(left) / total)
            gone |= set(left)
        return out - math.log10(255 - len(gone))
    result = []
    for (i, _), s, b, h in zip(rows, strings, bodies, held):
        tokens = b.split() + [b"\n"]
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in tokens)
        score = sum(log_p(s[p - K:p], s[p]) for p in range(K, len(s)))
        result.append((i, h, len(tokens), sum(words[w] > 0 for w in tokens), n, base, score))
    return sorted(result, key=lambda r: repr(r[:5]))


def got(df):
    cols = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: repr(r[:5]))


@pytest.mark.parametrize("block_bytes", [3_000, 24_000_000])
def test_awkward_rows(spark, block_bytes):
    rows = awkward_texts() + [(100 + k, prose(k, 60)) for k in range(40)]
    want, have = brute(rows), got(op.score_documents(docs_table(spark, rows), block_bytes=block_bytes))
    assert [r[:5] for r in have] == [r[:5] for r in want]
    for a, b in zip(sorted(have, key=repr), sorted(want, key=repr)):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_a_gram_of_very_many_blocks_takes_several_rows(spark, monkeypatch):
    monkeypatch.setattr(op, "LIST_BLOCKS", 2)
    monkeypatch.setattr(op, "SUMMED_ROWS", 37)
    rows = [(k, prose(k, 30)) for k in range(60)]
    want, have = brute(rows), got(op.score_documents(docs_table(spark, rows), block_bytes=900))
    assert [r[:5] for r in have] == [r[:5] for r in want]
    assert [r[6] for r in have] == pytest.approx([r[6] for r in want], rel=1e-9)


def test_probabilities_add_up_to_at_most_one():
    import numpy as np
    import pandas as pd
    bodies = [prose(k, 40).encode() for k in range(5)]
    gram, _ = op.grams_of(bodies)
    n = Counter(gram.tolist())
    context = int(gram[50]) >> 8
    keys = sorted(set(n) | {context << 8 | s for s in range(256) if s != op.PAD})
    order1 = np.zeros((256, 256))
    for k, c in n.items():
        order1[k >> 8 & 255, k & 255] += c
    group = [k for k in keys if k >> 8 & 0xFFFF == context & 0xFFFF]
    out = op.estimator(order1)(pd.DataFrame({"key": group, "n": [n[k] for k in group]}))
    total = sum(10 ** v for k, v in zip(out["key"], out["value"]) if k >> 8 == context)
    assert total == pytest.approx(1.0, abs=1e-9)


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows = [(held, "abc"), (held, None)]
    have = got(op.score_documents(docs_table(spark, rows)))
    assert [r[6] for r in have] == pytest.approx([-math.log10(255), -4 * math.log10(255)]) or [r[6] for r in have] == pytest.approx([-4 * math.log10(255), -math.log10(255)])
    assert op.score_documents(docs_table(spark, [])).count() == 0
