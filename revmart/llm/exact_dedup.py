"""Exact dedup by progressive refinement, with built-in functions only.

Level 1 groups by the length of the normalised text, level 2 groups what is
left by a hash of its first characters, level 3 hashes the full content only
where level 2 still has company. What the first two levels leave is sent back
to the scan as a bit filter of fixed size, so no text is shuffled: the full
hash is taken where the row is read, and only (id, length, prefix hash, full
hash) moves. A filter too full for its data only lets more rows through to
level 3; the result stays exact.

Defined cases: a null text counts as empty, all empty texts are equal; a null
id loses against any id, ``keep_id`` is null only where a whole group has null
ids; of repeated rows with the smallest id exactly one is kept; other columns
of the input are ignored, whatever their names; an empty table gives an empty
result;
very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import build_filter, checkpointed, maybe_in, squash, table

QUERY_NAME = "op2_exact_dedup"
PREFIX_CHARS = 128
LOG2_WORDS = 18  # 2**18 words of 64 bits: 2 MB, whatever the input


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                normalise=squash, carry: dict[str, Column] | None = None,
                prefix_chars: int = PREFIX_CHARS, log2_words: int = LOG2_WORDS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept`` and the
    ``carry`` columns, expressions over ``norm`` (the normalised text)."""
    carry = carry or {}
    texts = docs.select(docs[id_col].alias("id"), normalise(docs[text_col]).alias("norm"))
    head = F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("head")
    length = F.char_length("norm").cast("long").alias("len")

    prints = checkpointed(texts.select(length, head))
    by_len = prints.groupBy("len").agg(F.count("*").alias("n")).where("n > 1")
    by_head = (prints.join(by_len.select("len"), "len", "left_semi")
               .groupBy("len", "head").agg(F.count("*").alias("n")).where("n > 1"))
    words = build_filter(by_head.select(F.xxhash64("len", "head").alias("h")), "h", log2_words)

    probed = maybe_in(texts.select("id", "norm", length, head), F.xxhash64("len", "head"), words, log2_words, "again")
    full = F.when(F.col("again"), F.unhex(F.sha2(F.col("norm"), 256))).otherwise(F.lit(b"")).alias("full")
    rows = probed.select("id", "len", "head", full, *[c.alias(n) for n, c in carry.items()])

    key = ["len", "head", "full"]
    counted = rows.groupBy(*key, "id").agg(F.count("*").alias("n"), *[F.max(n).alias(n) for n in carry])
    groups = counted.groupBy(*key).agg(F.min("id").alias("keep_id"), F.sum("n").alias("group_size"))
    out = counted.join(groups, key).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", *carry,
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
    return out.select("doc_id", "keep_id", "group_size",
                      (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), *carry)


def query(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), carry={"text_sha256": F.sha2(F.col("norm"), 256)})


ORACLE_SQL = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256
)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, n.text_sha256
FROM n JOIN g USING (text_sha256)
"""
