"""Training-corpus pipeline: five stages over the ``documents`` table.

Every stage works on all rows that its predecessor kept, read from Parquet.
All but the last return the columns they were given: toxic documents, all but
one of a group of near duplicates and documents that hold a benchmark item go,
repeated lines are cut out of the text (``n_chars`` follows), and the last
stage returns the token ids of what is left.

Rows with a null id go through the stages like any others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.llm import byte_bpe, decontaminate, line_dedup, near_dedup, toxicity
from revmart.llm.common import scratch_path, table


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows that score below the threshold."""
    model, _ = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_column(model, docs["text"]) < toxicity.THRESHOLD)


def drop_repeated_lines(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps every row; a line that an earlier document holds is cut."""
    out = line_dedup.line_dedup(docs, keep=tuple(docs.columns))
    new = {"text": F.when(F.col("n_dropped__") > 0, F.col("kept_text__")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_dropped__") > 0, F.char_length("kept_text__")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    out = out.toDF(*docs.columns, "kept_text__", "n_lines__", "n_dropped__")
    return out.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of near duplicates."""
    return near_dedup.keep_one(docs)


def drop_benchmark_leaks(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and that they decode to its text."""
    return byte_bpe.round_trip(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("byte_bpe", encode),
]

# The label model, ProbMinHash and BPE are not SQL.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again as the next one's
    documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        docs.write.parquet(path := scratch_path(spark, f"pipeline-{name}"))
        docs = spark.read.schema(docs.schema).parquet(path)
    return docs
