"""Benchmark decontamination with a BM25 index and block-max WAND.

The test items are cut into even segments, none longer than the overlap of
two passages, so every copied segment stands whole in some passage however
long its item is; most items are one segment. The segments form an inverted
index: per term a posting list ordered by segment, cut into blocks that carry
their largest impact. Impacts are BM25 weights divided by the segment's score
against itself, so one threshold means the same share of every segment. Every
passage of every document (overlapping windows of words) is a query. Passages
whose block maxima can't add up to the threshold in any block fall out in bulk
(one grouped sum over the term by block matrix); the rest run block-max WAND,
which returns every segment at or above the threshold, and the segment's item
is a candidate. A candidate counts when the passage, widened by the length of
the whole item on both sides, also holds enough of the item's question and of
its answer (its last sentence) as word n-grams.

The items are cut into written blocks of at most ``ITEMS_PER_PASS`` items,
``WORDS_PER_PASS`` words and ``CHARS_PER_PASS`` characters (a longer item is a
block of its own), and the term by block matrix has about ``CELLS`` cells at
most. How many segments hold a term and how long they are on average is summed
up over all blocks, so scores don't depend on the cut. The driver holds one
block at a time; with several blocks each is a job of its own that scans the
documents once and writes what it found. ``contaminated`` never shuffles
documents; ``clean`` with several blocks joins them with the hashes of the
texts that matched, which Spark broadcasts while they are few.

Defined cases: null and empty texts have no passages and never match; an item
without words matches nothing; an item of one sentence is all question; ties
and repeated rows each give their own row; other columns are ignored; an empty
table on either side gives an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import groupby, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_path, table, text_of, vectorised

QUERY_NAME = "op5_decontaminate"
WINDOW, STRIDE = 128, 64
SEGMENT = WINDOW - STRIDE  # words; a run of so many lies whole in some window
THRESHOLD = 0.5
ITEMS_PER_PASS, WORDS_PER_PASS, CHARS_PER_PASS = 1024, 1 << 16, 1 << 22
CELLS = 1 << 24
BLOCK = 4             # segments a block
K1, B = 1.2, 0.75
NGRAM = 3
QUESTION_SHARE, ANSWER_SHARE = 0.6, 0.5
WORD = re.compile(r"[^\W_]+")
MATCH = "array<struct<item_id:string,score:double,question_overlap:double,answer_overlap:double,word_at:long>>"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The last sentence is the answer; a single sentence is all question."""
    sentences = [w for w in map(words_of, re.split(r"(?<=[.!?])\s+|\n+", text)) if w]
    if len(sentences) < 2:
        return (sentences[0] if sentences else []), []
    return [w for s in sentences[:-1] for w in s], sentences[-1]


def _grams(words, n):
    n = min(n, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def segments(words: list[str]) -> list[list[str]]:
    """The words in runs of nearly the same length, at most ``SEGMENT``."""
    n = max(1, -(-len(words) // SEGMENT))
    return [words[k * len(words) // n:(k + 1) * len(words) // n] for k in range(n)]


class ItemIndex:
    """Inverted index of the segments of some items, with block maxima;
    ``owner`` is the item of each segment. ``df``, ``n`` and ``mean`` (segments
    that hold a term, segments, their mean length) are those of ``items``
    unless given."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int] | None = None, n: int | None = None, mean: float | None = None):
        self.ids = [i for i, _ in items]
        self.parts = [question_and_answer(t) for _, t in items]
        cut = [(i, Counter(s)) for i, (q, a) in enumerate(self.parts) for s in segments(q + a)]
        self.owner, bags = [i for i, _ in cut], [bag for _, bag in cut]
        own = Counter(t for bag in bags for t in bag)
        self.vocab = {t: k for k, t in enumerate(sorted(own))}
        df, n = df or own, n or len(bags)
        mean = mean or sum(sum(b.values()) for b in bags) / max(1, len(bags)) or 1
        idf = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) for t in own}
        self.block = max(BLOCK, -(-len(bags) * len(own) // CELLS))
        self.postings: list[list[tuple[int, float]]] = [[] for _ in own]
        for i, bag in enumerate(bags):
            norm = K1 * (1 - B + B * sum(bag.values()) / mean)
            impact = {t: idf[t] * c * (K1 + 1) / (c + norm) for t, c in bag.items()}
            total = sum(impact.values())
            for t, w in impact.items():
                self.postings[self.vocab[t]].append((i, w / total))
        self.block_max = np.zeros((len(own), -(-len(bags) // self.block)), "float32")
        for t, posting in enumerate(self.postings):
            for i, w in posting:
                self.block_max[t, i // self.block] = max(self.block_max[t, i // self.block], w * (1 + 1e-6))
        self.term_max = self.block_max.max(axis=1, initial=0) if bags else np.zeros(0)

    def search(self, terms, threshold: float, blocks=None) -> list[tuple[int, float]]:
        """Block-max WAND: all segments whose score for the distinct ``terms`` is
        at least ``threshold``; with ``blocks``, only those of these blocks."""
        if blocks is None:
            return self._walk(terms, threshold, 0, len(self.owner))
        return [x for b in blocks for x in self._walk(terms, threshold, b * self.block, (b + 1) * self.block)]

    def _walk(self, terms, threshold: float, begin: int, end: int) -> list[tuple[int, float]]:
        cursors = []
        for t in terms:
            at = bisect_left(self.postings[t], (begin,))
            if at < len(self.postings[t]) and self.postings[t][at][0] < end:
                cursors.append([self.postings[t][at][0], at, t])
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for k, c in enumerate(cursors):
                bound += self.term_max[c[2]]
                if bound >= threshold:
                    pivot = k
                    break
            if pivot is None:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block = item // self.block
            if sum(self.block_max[c[2], block] for c in cursors[:pivot + 1]) < threshold:
                # No segment of this block before the next cursor can reach it.
                to = (block + 1) * self.block
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1][0])
                to = max(to, item + 1)
            elif cursors[0][0] == item:
                score = sum(self.postings[c[2]][c[1]][1] for c in cursors[:pivot + 1])
                if score >= threshold:
                    found.append((item, score))
                to = item + 1
            else:
                to = item
            for c in cursors[:pivot + 1]:
                posting, at = self.postings[c[2]], c[1]
                while at < len(posting) and posting[at][0] < to:
                    at += 1
                c[1] = at
                c[0] = posting[at][0] if at < len(posting) and posting[at][0] < end else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def verify(self, item: int, passage: list[str]) -> tuple[float, float]:
        """Shares of the question's and the answer's n-grams in a passage; an
        item without an answer gets the question's share twice."""
        shares = []
        for part in self.parts[item]:
            want = _grams(part, NGRAM)
            n = min(NGRAM, len(part))
            have = {tuple(passage[i:i + n]) for i in range(len(passage) - n + 1)} if want else set()
            shares.append(len(want & have) / len(want) if want else None)
        return shares[0] or 0.0, shares[0] or 0.0 if shares[1] is None else shares[1]


def candidate_windows(index: ItemIndex, terms: list[np.ndarray], threshold: float):
    """(document, window, its distinct terms, blocks) of every window of the
    documents (term numbers by word, -1 for foreign words) and the blocks
    whose maxima reach the threshold there."""
    n_terms = len(index.vocab)
    lengths = np.array([len(t) for t in terms], "int64")
    n_windows = np.maximum(1, -(-(lengths - (WINDOW - STRIDE)) // STRIDE))
    base = np.concatenate([[0], np.cumsum(n_windows)])
    flat = np.concatenate(terms) if terms else np.zeros(0, "int64")
    starts = np.concatenate([[0], np.cumsum(lengths)])
    doc = np.repeat(np.arange(len(terms)), lengths)
    slot = (np.arange(len(flat)) - starts[doc]) // STRIDE
    known = flat >= 0
    flat, doc, slot = flat[known], doc[known], slot[known]
    inside = slot < n_windows[doc]
    before = slot > 0
    key = np.concatenate([(base[doc] + slot)[inside] * n_terms + flat[inside], (base[doc] + slot - 1)[before] * n_terms + flat[before]])
    key = np.sort(key)
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    window, term = key // n_terms, key % n_terms
    cuts = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]])) if len(key) else np.zeros(0, "int64")
    # A window needs the term maxima to reach the threshold before its blocks are looked at.
    cheap = np.add.reduceat(index.term_max[term], cuts) >= threshold if len(cuts) else np.zeros(0, bool)
    ends = np.append(cuts[1:], len(key))
    step = 2048
    picked = np.flatnonzero(cheap)
    for lo in range(0, len(picked), step):
        part = picked[lo:lo + step]
        sizes = ends[part] - cuts[part]
        offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        at = np.arange(sizes.sum()) - np.repeat(offsets, sizes) + np.repeat(cuts[part], sizes)
        bound = np.add.reduceat(index.block_max[term[at]], offsets, axis=0)
        reached = bound >= threshold
        for j in np.flatnonzero(reached.any(axis=1)):
            k = part[j]
            w = window[cuts[k]]
            d = int(np.searchsorted(base, w, side="right") - 1)
            yield d, int(w - base[d]), term[cuts[k]:ends[k]], np.flatnonzero(reached[j]).tolist()


def matcher(index: ItemIndex, threshold: float, question_share: float, answer_share: float):
    """Column function: text -> array of verified matches, one per item."""
    @vectorised(MATCH, frees=True)
    def match(texts: pd.Series) -> pd.Series:
        out: list[dict] = [{} for _ in range(len(texts))]
        values = texts.to_list()
        lo = 0
        while lo < len(values):
            hi, size = lo, 0
            while hi < len(values) and (hi == lo or size + len(values[hi]) <= 4_000_000):
                size += len(values[hi])
                hi += 1
            get = index.vocab.get
            terms = []
            for t in values[lo:hi]:
                w = words_of(t)
                terms.append(np.fromiter(map(get, w, repeat(-1)), "int64", len(w)))
            for d, of_doc in groupby(candidate_windows(index, terms, threshold), key=lambda c: c[0]):
                scores: dict[int, dict[int, float]] = {}  # by item and window, of its best segment
                for _, window, distinct, blocks in of_doc:
                    for segment, score in index.search(distinct.tolist(), threshold, blocks):
                        at = scores.setdefault(index.owner[segment], {})
                        at[window] = max(score, at.get(window, 0.0))
                words = words_of(values[lo + d]) if scores else []
                for item, at in scores.items():
                    reach = sum(map(len, index.parts[item]))
                    for window in sorted(at, key=lambda w: (-at[w], w)):  # the best window that holds counts
                        begin = max(0, window * STRIDE - reach)
                        q, a = index.verify(item, words[begin:window * STRIDE + WINDOW + reach])
                        if q >= question_share and a >= answer_share:
                            out[lo + d][item] = {"item_id": index.ids[item], "score": float(at[window]), "question_overlap": q, "answer_overlap": a, "word_at": window * STRIDE}
                            break
            lo = hi
        return pd.Series([list(x.values()) for x in out], dtype=object)
    return match


def item_blocks(items: DataFrame, id_col: str, text_col: str, per_pass: int) -> DataFrame:
    """(block, ids, texts, segments, words, terms, counts), written: bounded
    blocks of items and how many segments of the block hold each term."""
    spark = items.sparkSession
    rows = items.select(items[id_col].cast("string").alias("i"), text_of(items[text_col]).alias("t"))
    total, chars = rows.agg(F.count("*"), F.coalesce(F.sum(F.char_length("t")), F.lit(0))).first()
    parts = max(1, -(-total // per_pass), -(-chars // CHARS_PER_PASS))

    def frame(block):
        cut = [x for _, w, _ in block for x in segments(w)]
        df = Counter(t for x in cut for t in set(x))
        return pd.DataFrame({"ids": [[i for i, _, _ in block]], "texts": [[t for _, _, t in block]], "segments": [len(cut)],
                             "words": [sum(map(len, cut))], "terms": [list(df)], "counts": [list(df.values())]})

    def cut(batches):
        block, n_words, n_chars = [], 0, 0
        for batch in batches:
            for i, t in zip(batch["i"], batch["t"]):
                w = words_of(t)
                if not w:
                    continue
                if block and (len(block) >= per_pass or n_words + len(w) > WORDS_PER_PASS or n_chars + len(t) > CHARS_PER_PASS):
                    yield frame(block)
                    block, n_words, n_chars = [], 0, 0
                block.append((i, w, t))
                n_words, n_chars = n_words + len(w), n_chars + len(t)
        if block:
            yield frame(block)

    blocks = rows.repartition(parts).sortWithinPartitions("i", "t").mapInPandas(
        cut, "ids array<string>, texts array<string>, segments long, words long, terms array<string>, counts array<long>")
    blocks = blocks.select(F.monotonically_increasing_id().alias("block"), "*")
    blocks.write.parquet(path := scratch_path(spark, "benchmark-blocks"))
    return spark.read.schema(blocks.schema).parquet(path)


def item_indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text", per_pass: int = ITEMS_PER_PASS):
    """How many blocks of items there are, and an iterator over their indexes
    that holds one at a time."""
    blocks = item_blocks(items, id_col, text_col, per_pass)
    keys = sorted(r["block"] for r in blocks.select("block").collect())
    if not keys:
        return 0, iter(())
    n, total = blocks.agg(F.sum("segments"), F.sum("words")).first()
    df = blocks
    if len(keys) > 1:
        of_block = blocks.select("block", F.explode(F.arrays_zip("terms", "counts")).alias("x")).select("block", "x.terms", "x.counts")
        df = of_block.groupBy("terms").agg(F.sum("counts").alias("counts"))
        df = of_block.drop("counts").join(df, "terms").groupBy("block").agg(F.collect_list(F.struct("terms", "counts")).alias("x")).select("block", "x.terms", "x.counts")
        df.write.parquet(path := scratch_path(items.sparkSession, "benchmark-terms"))
        df = items.sparkSession.read.schema(df.schema).parquet(path)

    def index(key):
        b, d = (x.where(F.col("block") == key).first() for x in (blocks, df))
        return ItemIndex(list(zip(b["ids"], b["texts"])), dict(zip(d["terms"], d["counts"])), n, total / n)

    return len(keys), map(index, keys)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                 question_share: float = QUESTION_SHARE, answer_share: float = ANSWER_SHARE, **options) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap, word_at``
    for every document and item that match."""
    base = docs.select(docs[id_col].alias("doc_id"), text_of(docs[text_col]).alias("text"))
    n, indexes = item_indexes(items, **options)
    kind = items.schema[options.get("id_col", "item_id")].dataType

    def rows(matches):
        return base.select("doc_id", F.explode(matches).alias("m")).select("doc_id", "m.*").withColumn("item_id", F.col("item_id").cast(kind))
    found = (rows(matcher(x, threshold, question_share, answer_share)("text")) for x in indexes)
    if n == 0:
        return rows(F.lit(None).cast(MATCH))
    if n == 1:
        return next(found)
    path = scratch_path(docs.sparkSession, "decontaminate")
    for one in found:
        one.write.mode("append").parquet(path)
    return docs.sparkSession.read.schema(one.schema).parquet(path)


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", threshold: float = THRESHOLD,
          question_share: float = QUESTION_SHARE, answer_share: float = ANSWER_SHARE, **options) -> DataFrame:
    """The rows of ``docs`` that match no item, all columns as they were."""
    text = text_of(docs[text_col])
    n, indexes = item_indexes(items, **options)
    hits = (F.size(matcher(x, threshold, question_share, answer_share)(text)) for x in indexes)
    if n < 2:
        return docs.where(next(hits) == 0) if n else docs
    path = scratch_path(docs.sparkSession, "leaks")
    for hit in hits:
        docs.where(hit > 0).select(F.sha2(text, 256).alias("leak")).distinct().write.mode("append").parquet(path)
    leaks = docs.sparkSession.read.schema("leak string").parquet(path).distinct()
    return docs.join(leaks, F.sha2(text, 256) == leaks["leak"], "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = None
