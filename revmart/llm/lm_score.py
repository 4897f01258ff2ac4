"""Language-model scores: prediction by partial matching over bytes.

The model is a trie of byte contexts up to order ``ORDER``, pretrained on the
training documents. A byte is coded in the longest context that has seen it;
escape probabilities are estimated by method C, and symbols a longer context
already offered are excluded from the shorter ones. The code length of a text,
its end included, is the sum over its bytes.

Counting, estimation and scoring are three Spark steps. Documents fall into
blocks by hash. A block writes out its distinct grams (context and symbol) and
words with their training counts; these are summed over blocks. A gram's
probability needs only grams that end in the same two context bytes, a group
bounded by the alphabet, and the order-1 table of 65,536 counts; so the trie
is estimated group by group. Each block then gets the values of its own grams
and words back and scores its documents. No model of the whole corpus is ever
held in one place, and nothing is pruned.

Beside the score stands a unigram base: words between ASCII white space, A-Z
lower-cased, and one end token, with add-one smoothing. Words are known by a
64-bit hash.

Defined cases: a null text is empty and costs its end symbol; a null id is
crc32 of the empty text and never held out or always, like any id; repeated
rows each give a row and each count; without training rows every symbol is
equally likely; other columns are ignored; an empty table gives an empty
result;
very long texts are read whole.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_bucket, limit_batches, scratch_path, table, text_of

QUERY_NAME = "op8_lm_score"
ORDER = 5
PAD, END = 0xFE, 0xFF   # bytes that UTF-8 never uses
SYMBOLS = 255           # every byte but PAD
BLOCK_BYTES = 16_000_000
CHUNK_BYTES = 1_000_000
KEY_BYTES = 32_000_000  # text whose grams and words one partition by key sums up
LIST_BLOCKS = 1024      # blocks that one row names
SUMMED_ROWS = 50_000
END_WORD = b"\n"        # never a word
FOLDS, HELD_OUT = 7, 2
GRAM, WORD = 0, 1


def _chunks(texts):
    """Lists of neighbouring positions of about CHUNK_BYTES together."""
    part, size = [], 0
    for k, t in enumerate(texts):
        part.append(k)
        size += len(t)
        if size >= CHUNK_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def grams_of(bodies: list[bytes]):
    """(gram of each symbol, document of each symbol). A gram is the symbol
    and the ORDER bytes before it as one number, oldest byte first."""
    pad, end = bytes([PAD]) * ORDER, bytes([END])
    raw = np.frombuffer(b"".join(x for b in bodies for x in (pad, b, end)), "uint8")
    gram = np.zeros(len(raw) - ORDER, "int64")
    for k in range(ORDER + 1):
        gram |= raw[k:len(raw) - ORDER + k].astype("int64") << (8 * (ORDER - k))
    real = raw[ORDER:] != PAD
    lengths = np.array([len(b) + 1 for b in bodies])
    return gram[real], np.repeat(np.arange(len(bodies)), lengths)


def words_of(bodies: list[bytes]):
    """(hash of each distinct word, word number of each token, document of
    each token); every document ends with the end token."""
    lists = [b.split() + [END_WORD] for b in bodies]
    codes, uniques = pd.factorize(np.array([w for ws in lists for w in ws], dtype=object))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(u) - 2**63 for u in uniques), "int64", len(uniques))
    return hashes, codes, np.repeat(np.arange(len(lists)), [len(x) for x in lists])


def _runs(block: np.ndarray):
    """(block, begin, end) of each run of equal values."""
    cuts = np.flatnonzero(np.diff(block)) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
        if hi > lo:
            yield int(block[lo]), lo, hi


def _pieces(texts: pa.Array):
    """(begin, lower-cased bodies) of about CHUNK_BYTES each; a batch is never
    turned into Python objects as a whole."""
    step = max(1, len(texts) * CHUNK_BYTES // max(1, texts.nbytes))
    for lo in range(0, len(texts), step):
        part = texts.slice(lo, step).to_pylist()
        inner = 0
        for k in _chunks(part):
            yield lo + inner, [part[j].encode().lower() for j in k]
            inner += len(k)


def _gather(batches):
    """Per block: its distinct grams and words with their training counts."""
    block, keys, counts, kinds = None, [], [], []

    def merged():
        nonlocal keys, counts, kinds
        done = []
        for kind in (GRAM, WORD):
            of = [k for k, x in enumerate(kinds) if x == kind]
            codes, uniques = pd.factorize(np.concatenate([keys[k] for k in of]))
            done.append((kind, uniques, np.bincount(codes, np.concatenate([counts[k] for k in of]), len(uniques)).astype("int64")))
        keys, counts, kinds = [d[1] for d in done], [d[2] for d in done], [d[0] for d in done]

    def flush():
        if not keys:
            return
        merged()
        for kind, key, n in zip(kinds, keys, counts):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), block, "int32")), pa.array(np.full(len(key), kind, "int32")), pa.array(key), pa.array(n)],
                                             names=["block", "kind", "key", "n"])

    for batch in batches:
        held = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        for b, lo, hi in _runs(batch.column("block").to_numpy()):
            if b != block:
                yield from flush()
                block, keys, counts, kinds = b, [], [], []
            for at, bodies in _pieces(batch.column("text").slice(lo, hi - lo)):
                learn = ~held[lo + at:lo + at + len(bodies)]
                for kind, (key, codes, doc) in ((GRAM, _distinct(*grams_of(bodies))), (WORD, words_of(bodies))):
                    kinds.append(kind)
                    keys.append(key)
                    counts.append(np.bincount(codes[learn[doc]], minlength=len(key)))
                if len(keys) > 12:
                    merged()
    yield from flush()


def _distinct(gram: np.ndarray, doc: np.ndarray):
    codes, keys = pd.factorize(gram)
    return keys, codes, doc


def _summed(batches):
    """Of one partition by key: the training count of each key over all blocks
    and the blocks that hold it, by one sort and one pass over its runs. A long
    list of blocks goes on in further rows, which are not ``first``."""
    rows = [[b.column(c).to_numpy() for c in ("block", "kind", "key", "n")] for b in batches]
    if not rows:
        return
    block, kind, key, n = (np.concatenate(c) for c in zip(*rows))
    del rows
    for which in (GRAM, WORD):
        at = np.flatnonzero(kind == which)
        if not len(at):
            continue
        at = at[np.argsort(key[at], kind="stable")]
        keys, blocks = key[at], block[at]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
        lengths = np.diff(np.append(starts, len(keys)))
        totals = np.add.reduceat(n[at], starts)
        parts = -(-lengths // LIST_BLOCKS)
        run = np.repeat(np.arange(len(starts)), parts)
        inner = np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
        cuts = starts[run] + inner * LIST_BLOCKS
        ends = np.append(cuts[1:], len(keys))
        for lo in range(0, len(run), SUMMED_ROWS):
            hi = min(lo + SUMMED_ROWS, len(run))
            offsets = pa.array(np.append(cuts[lo:hi], ends[hi - 1]) - cuts[lo], pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(blocks[cuts[lo]:ends[hi - 1]], pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(hi - lo, which, "int32")), pa.array(keys[cuts[lo:hi]]), pa.array(totals[run[lo:hi]]),
                                              pa.array(inner[lo:hi] == 0), lists], names=["kind", "key", "n", "first", "blocks"])


def estimator(order1: np.ndarray):
    """log10 probability of each gram of one group: all grams that share the
    last two context bytes. ``order1[c, s]``: count of symbol s after byte c."""
    order0 = order1.sum(axis=0)

    def estimate(pdf: pd.DataFrame) -> pd.DataFrame:
        gram, n = pdf["key"].to_numpy("int64"), pdf["n"].to_numpy("float64")
        symbol = gram & 0xFF
        last = int(gram[0] >> 8) & 0xFF
        score, done = np.zeros(len(gram)), np.zeros(len(gram), bool)

        def level(count, total, kinds):
            """One order: count of the symbol, and what is not excluded."""
            nonlocal score, done
            whole = total + kinds
            here = ~done & (count > 0)
            score[here] += np.log10(count[here] / whole[here])
            done |= here
            escape = ~done & (kinds > 0)
            score[escape] += np.log10(kinds[escape] / whole[escape])

        # Orders ORDER..2 from the grams; context numbers per order, longest first.
        below = None  # of the next longer order: context of each node, nodes with a seen symbol
        for k in range(ORDER, 1, -1):
            node = gram & ((1 << (8 * (k + 1))) - 1)
            nodes, first, at = np.unique(node, return_index=True, return_inverse=True)
            count = np.bincount(at, n, len(nodes))
            contexts, ctx = np.unique(nodes >> 8, return_inverse=True)
            total = np.bincount(ctx, count, len(contexts))
            kinds = np.bincount(ctx, (count > 0).astype(float), len(contexts))
            t, q = total[ctx][at], kinds[ctx][at]
            if below is not None:
                # Exclude, per longer context, what it offered: its symbols' counts here.
                long_ctx, long_seen_nodes = below
                node_of_long = first_at[long_seen_nodes]
                gone = np.bincount(long_ctx[long_seen_nodes], count[at[node_of_long]], n_long)
                gone_kinds = np.bincount(long_ctx[long_seen_nodes], minlength=n_long).astype(float)
                t, q = t - gone[long_ctx][long_at], q - gone_kinds[long_ctx][long_at]
            level(count[at], t, q)
            below = (ctx, np.flatnonzero(count > 0))
            first_at, long_at, n_long = first, at, len(contexts)
            seen_symbols = np.unique(symbol[first[count > 0]]) if k == 2 else None
        # Order 1 without what order 2 offered, order 0 without order 1, then uniform.
        row = order1[last]
        t = np.full(len(gram), row.sum() - row[seen_symbols].sum())
        q = np.full(len(gram), float((row > 0).sum() - len(seen_symbols)))
        level(row[symbol], t, q)
        t = np.full(len(gram), order0.sum() - order0[row > 0].sum())
        q = np.full(len(gram), float((order0 > 0).sum() - (row > 0).sum()))
        level(order0[symbol], t, q)
        score[~done] -= math.log10(max(1, SYMBOLS - int((order0 > 0).sum())))
        return pd.DataFrame({"key": gram, "value": score})
    return estimate


SCORES = "in_id string, held_out boolean, n_tokens long, n_known long, log_counts double, score double"


def _score(docs: pa.Table, values: pa.Table) -> pa.Table:
    """Scores of the documents of one block, from the values of its grams and
    words."""
    kinds, keys, found = (values.column(c).to_numpy() for c in ("kind", "key", "value"))
    grams, log_p = pd.Index(keys[kinds == GRAM]), found[kinds == GRAM]
    words, counts = pd.Index(keys[kinds == WORD]), found[kinds == WORD]
    out = []
    for batch in docs.to_batches():
        for at, bodies in _pieces(batch.column("text")):
            n = len(bodies)
            gram, doc = grams_of(bodies)
            score = np.bincount(doc, log_p[grams.get_indexer(gram)], n)
            hashes, codes, doc = words_of(bodies)
            c = counts[words.get_indexer(hashes)][codes]
            out.append(pa.RecordBatch.from_arrays([
                batch.column("in_id").slice(at, n), batch.column("held_out").slice(at, n), pa.array(np.bincount(doc, minlength=n)),
                pa.array(np.bincount(doc, c > 0, n).astype("int64")), pa.array(np.bincount(doc, np.log10(c + 1), n)), pa.array(score)],
                names=["in_id", "held_out", "n_tokens", "n_known", "log_counts", "score"]))
    return pa.Table.from_batches(out)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out=None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score`` per row. ``held_out``: boolean column of rows not learnt from."""
    spark = docs.sparkSession
    limit_batches(spark)
    held = crc_bucket(docs[id_col], FOLDS) == HELD_OUT if held_out is None else F.coalesce(held_out, F.lit(False))
    base = docs.select(docs[id_col].cast("string").alias("in_id"), held.alias("held_out"), text_of(docs[text_col]).alias("text"))
    size = base.agg(F.sum(F.octet_length("text") + 64).alias("b")).first()["b"] or 0
    n_blocks = max(1, math.ceil(size / block_bytes))
    base = base.withColumn("block", F.pmod(F.xxhash64("in_id", "text"), F.lit(n_blocks)).cast("int"))

    gathered = base.select("block", "held_out", "text").repartition(n_blocks, "block").sortWithinPartitions("block") \
        .mapInArrow(_gather, "block int, kind int, key long, n long")
    summed = "kind int, key long, n long, first boolean, blocks array<int>"
    counts = gathered.repartition(max(1, math.ceil(size / KEY_BYTES)), "kind", "key").mapInArrow(_summed, summed)
    counts.write.parquet(path := scratch_path(spark, "counts"))
    counts = spark.read.schema(summed).parquet(path)

    words = counts.where(F.col("kind") == WORD)
    total = words.where("first").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    grams = counts.where(F.col("kind") == GRAM)
    order1 = np.zeros((256, 256))
    pair = F.col("key").bitwiseAND(0xFFFF)
    for r in grams.where("first").groupBy(pair.alias("p")).agg(F.sum("n").alias("n")).collect():  # at most 65,536 rows
        order1[r["p"] >> 8, r["p"] & 0xFF] = r["n"]
    estimated = grams.where("first").select("key", "n").groupBy(F.shiftright("key", 8).bitwiseAND(0xFFFF).alias("suffix")) \
        .applyInPandas(estimator(order1), "key long, value double")
    slices = grams.join(estimated, "key").select(F.explode("blocks").alias("block"), "kind", "key", "value") \
        .union(words.select(F.explode("blocks").alias("block"), "kind", "key", F.col("n").cast("double").alias("value")))
    out = base.select("block", "in_id", "held_out", "text").groupBy("block").cogroup(slices.groupBy("block")).applyInArrow(_score, SCORES)
    n, v = total["n"], total["v"]
    return out.select(F.col("in_id").cast(docs.schema[id_col].dataType).alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                      (F.col("log_counts") - F.col("n_tokens") * F.lit(math.log10(n + v + 1))).alias("base_score"), "score")


def query(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


ORACLE_SQL = None
