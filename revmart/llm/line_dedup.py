"""Line dedup with two Bloom filters.

One pass hashes every line key and builds, per task, a filter of keys seen
once and one of keys seen again; filters of two tasks meet as
``twice = twice1 | twice2 | (once1 & once2)``, which never misses a key that
both hold. Only lines that the second filter suspects are shuffled: there the
exact key decides (SHA-256 of the key) and the smallest document id holding it
stays. Which texts lose a line comes back as a third filter; only texts that it
lets through move to meet their dropped lines, all others stay where they are
read. Filters are sized from counts, up to a bound on what is broadcast; a
filter too full for its data only makes more lines suspects, or moves more texts.

Defined cases: a null or empty text is one empty line; a null id counts as one
document that sorts before every other; rows that share an id are one document
for counting and each loses its own lines; an extra column never disturbs,
whatever its name; an empty table gives an empty result;
very long texts are read whole.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    SPACE_CHARS, ascii_lower, build_filter, checkpointed, filter_mask, filter_word, maybe_in, table, text_of, vectorised,
)

QUERY_NAME = "op6_line_dedup"
MIN_CHARS = 10
LOG2_MOST = 22        # words of 64 bits in the filter of lines: 32 MB are sent to an executor at most
LOG2_MOST_TEXTS = 20  # words in the filter of texts, sent as rows of 16 bytes
KEYS_A_WORD = 8       # at three bits a key some 3 % of the others pass
SEGMENT_WORDS = 8192
HOT_SHARE = 1024      # keys with more than so small a part of the suspects are fewer than this: sent, not shuffled to
NULL_ID = -2**63


def line_key(line):
    return ascii_lower(F.btrim(line, F.lit(SPACE_CHARS)))


def log2_for(keys: int, most: int) -> int:
    """Words, as a power of two, of a filter for so many keys."""
    return min(max(math.ceil(math.log2(max(1, keys) / KEYS_A_WORD)), 13), most)


def _line_count(text):
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, text_hash, line_no, key, h) of every line long enough to count."""
    return (docs.select("id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
            .select("id", "text_hash", "line_no", line_key(F.col("line")).alias("key"))
            .where(F.char_length("key") >= min_chars)
            .withColumn("h", F.xxhash64("key")))


def _task_filters(n_words: int):
    def build(batches):
        once, twice = np.zeros(n_words, "uint64"), np.zeros(n_words, "uint64")
        for pdf in batches:
            word, bits = pdf["word"].to_numpy("int64"), pdf["bits"].to_numpy("int64").view("uint64")
            order = np.lexsort((bits, word))
            word, bits = word[order], bits[order]
            same = np.zeros(len(word), bool)
            same[1:] = (word[1:] == word[:-1]) & (bits[1:] == bits[:-1])
            again = same | ((once[word] & bits) == bits)
            np.bitwise_or.at(twice, word[again], bits[again])
            np.bitwise_or.at(once, word, bits)
        for s in range(0, n_words, SEGMENT_WORDS):
            a, b = once[s:s + SEGMENT_WORDS], twice[s:s + SEGMENT_WORDS]
            if a.any():
                yield pd.DataFrame({"segment": [s], "once": [zlib.compress(a.tobytes(), 1)], "twice": [zlib.compress(b.tobytes(), 1)]})
    return build


def _merge_filters(batches):
    state: dict[int, list[np.ndarray]] = {}
    for pdf in batches:
        for s, a, b in zip(pdf["segment"], pdf["once"], pdf["twice"]):
            a, b = (np.frombuffer(zlib.decompress(x), "uint64") for x in (a, b))
            if s in state:
                once, twice = state[s]
                state[s] = [once | a, twice | b | (once & a)]
            else:
                state[s] = [a, b]
    for s, (_, twice) in state.items():
        if twice.any():
            yield pd.DataFrame({"segment": [s // SEGMENT_WORDS], "bits": [twice.view("int64")]})


def seen_twice(lines: DataFrame, log2_words: int) -> DataFrame:
    """(segment, bits) of the filter of keys seen at least twice: the words of
    each segment as an array."""
    n_words = 1 << log2_words
    parts = lines.select(filter_word(F.col("h"), log2_words).alias("word"), filter_mask(F.col("h")).alias("bits")) \
        .mapInPandas(_task_filters(n_words), "segment long, once binary, twice binary")
    return parts.repartition(max(1, n_words // SEGMENT_WORDS), "segment").mapInPandas(_merge_filters, "segment long, bits array<long>")


def suspected(lines: DataFrame, twice: DataFrame, log2_words: int) -> DataFrame:
    """The lines that the filter does not rule out."""
    word, mask = filter_word(F.col("h"), log2_words), filter_mask(F.col("h"))
    side = F.broadcast(twice.select(F.col("segment").alias("__segment"), F.col("bits").alias("__bits")))
    met = lines.join(side, F.floor(word / SEGMENT_WORDS) == F.col("__segment"))
    return met.where(F.get("__bits", (word % SEGMENT_WORDS).cast("int")).bitwiseAND(mask) == mask).drop("__segment", "__bits")


@vectorised("string")
def _without(text: pd.Series, gone: pd.Series) -> pd.Series:
    def cut(t, g):
        if g is None:
            return t
        g = set(g)
        return "\n".join(x for i, x in enumerate(t.split("\n")) if i not in g)
    return pd.Series([cut(t, g) for t, g in zip(text, gone)], dtype=object)


def _later_lines(suspects: DataFrame) -> DataFrame:
    """The suspects whose key an earlier document holds. A key with a large
    part of all rows is combined where they are and sent back to them; only
    the rows of other keys are shuffled."""
    first = suspects.groupBy("key").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count("*").alias("n"))
    first = checkpointed(first.where("first_id < last_id").select("key", "first_id", "n"))
    hot = F.col("n") * HOT_SHARE > suspects.count()
    sent = F.broadcast(first.where(hot).select(F.col("key").alias("hot_key"), F.col("first_id").alias("hot_first")))
    met = suspects.join(sent, F.col("key") == F.col("hot_key"), "left")
    rest = met.where("hot_key IS NULL").join(first.where(~hot).select("key", "first_id"), "key").where("id > first_id")
    columns = ("id", "text_hash", "line_no")
    return met.where("id > hot_first").select(*columns).union(rest.select(*columns))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
               min_chars: int = MIN_CHARS, log2_words: int | None = None) -> DataFrame:
    """Per row: ``keep`` columns of the input, then ``kept_text`` (the lines
    that stay, joined by newline), ``n_lines`` and ``n_dropped``. The filter of
    lines has ``2**log2_words`` words, by default as many as the lines need."""
    key = F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID))
    base = docs.select(key.alias("id"), text_of(docs[text_col]).alias("text"))
    if log2_words is None:
        log2_words = log2_for(base.agg(F.sum(_line_count("text"))).first()[0] or 0, LOG2_MOST)
    lines = _lines(base, min_chars)
    twice = checkpointed(seen_twice(lines, log2_words))
    suspects = suspected(lines, twice, log2_words)
    suspects = checkpointed(suspects.select("id", "text_hash", "line_no", F.unhex(F.sha2("key", 256)).alias("key")))
    gone = checkpointed(_later_lines(suspects).groupBy(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"))
                        .agg(F.collect_set("line_no").alias("__gone")))
    log2_texts = log2_for(gone.count(), LOG2_MOST_TEXTS)
    losing = build_filter(gone.select(F.xxhash64("__id", "__hash").alias("h")), "h", log2_texts)

    rows = docs.select(*[docs[c].alias(f"in_{i}") for i, c in enumerate(keep)], key.alias("__key"), text_of(docs[text_col]).alias("__text"))
    rows = maybe_in(rows.withColumn("__of", F.xxhash64("__text")), F.xxhash64("__key", "__of"), losing, log2_texts, "__loses")
    moved = rows.where("__loses").join(gone, (F.col("__key") == F.col("__id")) & (F.col("__of") == F.col("__hash")), "left")

    def result(df, text, dropped):
        return df.select(*[F.col(f"in_{i}").alias(c) for i, c in enumerate(keep)], text.alias("kept_text"),
                         _line_count("__text").alias("n_lines"), dropped.cast("long").alias("n_dropped"))
    return result(rows.where("not __loses"), F.col("__text"), F.lit(0)).union(
        result(moved, _without("__text", "__gone"), F.coalesce(F.size("__gone"), F.lit(0))))


def query(spark, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM documents
), k AS (
  SELECT doc_id, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), r AS (
  SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1
), d AS (
  SELECT k.doc_id, k.i, k.line, r.first_id IS NOT NULL AND k.doc_id <> r.first_id AS gone
  FROM k LEFT JOIN r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""
