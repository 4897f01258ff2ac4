"""Helpers shared by the operators: text normalisation, the shared scratch
folder, bounded bit filters for broadcast, and connected components."""

from __future__ import annotations

import ctypes
import functools
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The ASCII white space that normalisation works on.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(c: Column) -> Column:
    """Null counts as the empty text."""
    return F.coalesce(c.cast("string"), F.lit(""))


def squash(c: Column) -> Column:
    """Every run of ASCII white space becomes one space; null becomes empty."""
    return F.regexp_replace(text_of(c), SPACE_CLASS + "+", " ")


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only; other letters stay as they are."""
    return F.translate(c, UPPER, LOWER)


def crc_bucket(id_col: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null id: as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    On a cluster it must be set. Only a local session without it gets a
    temporary folder, since there driver and executors are one process.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        return conf
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = tempfile.mkdtemp(prefix="revmart-checkpoints-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from it: lineage ends here,
    and a lost executor costs no more than the tasks it was running."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- bit filters -----------------------------------------------------------
# A filter of 2**log2_words 64-bit words is a table (word, bits) with at most
# one row per word, so its size has a bound that does not depend on the data.

def filter_word(h: Column, log2_words: int) -> Column:
    """Index of the 64-bit word that hash ``h`` falls into (its top bits)."""
    return F.shiftrightunsigned(h, 64 - log2_words)


def filter_mask(h: Column, bits_per_key: int = 3) -> Column:
    """The bits of that word that belong to ``h``: ``bits_per_key`` positions
    of six bits each, from the low end of the hash."""
    mask = None
    for k in range(bits_per_key):
        one = F.expr("1L")
        at = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bit = F.call_function("shiftleft", one, at)
        mask = bit if mask is None else mask.bitwiseOR(bit)
    return mask


def build_filter(hashes: DataFrame, col: str, log2_words: int) -> DataFrame:
    """(word, bits) filter of a column of 64-bit hashes; built-ins only."""
    h = F.col(col)
    return (hashes.select(filter_word(h, log2_words).alias("word"), filter_mask(h).alias("bits"))
            .groupBy("word").agg(F.bit_or("bits").alias("bits")))


def maybe_in(df: DataFrame, h: Column, words: DataFrame, log2_words: int, name: str) -> DataFrame:
    """``df`` with boolean ``name``: false only where ``h`` is surely not in
    the filter. ``words`` has at most 2**log2_words rows of 16 bytes, so the
    broadcast has a fixed bound."""
    w, b = f"__{name}_word", f"__{name}_bits"
    side = F.broadcast(words.select(F.col("word").alias(w), F.col("bits").alias(b)))
    mask = filter_mask(h)
    out = df.join(side, filter_word(h, log2_words) == F.col(w), "left")
    return out.withColumn(name, F.coalesce(F.col(b).bitwiseAND(mask) == mask, F.lit(False))).drop(w, b)


# --- connected components ----------------------------------------------------

BROADCAST_NODES = 250_000  # labels of so many nodes are sent to all executors: at most some 20 MB


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (a, b);
    the component is its smallest node.

    Every round a node takes the smallest label among its neighbours' and its
    own, and then the label of its label, so long chains halve. The rounds are
    joins written to the shared folder; labels are broadcast where they are
    counted to be few and shuffled otherwise. Only counts come to the driver.
    """
    ends = edges.where("a <> b")
    ends = ends.select("a", "b").union(ends.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = checkpointed(ends.union(ends.select("a", F.col("a").alias("b"))).distinct())
    labels = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")))
    sent = F.broadcast if labels.count() <= BROADCAST_NODES else lambda df: df
    while True:  # every round settles at least one more node, long chains halve
        old = labels.select(F.col("node").alias("b"), "component")
        near = checkpointed(both.join(sent(old), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("low")))
        ahead = near.select(F.col("node").alias("low"), F.col("low").alias("component"))
        before = labels.select("node", F.col("component").alias("old"))
        new = checkpointed(near.join(sent(ahead), "low").join(sent(before), "node").select("node", "old", "component"))
        labels = new.select("node", "component")
        if new.where("old <> component").isEmpty():
            return labels


# --- Python workers ----------------------------------------------------------

def vectorised(return_type: str, frees: bool = False):
    """Pandas UDF of a function, made when it is first applied: modules can be
    imported before there is a session. With ``frees`` the worker gives memory
    back after every batch: workers outlive their tasks, and what one has needed
    once would else stay with it through all later stages."""
    def wrap(f):
        def on_columns(*columns):
            return F.pandas_udf(freeing(f) if frees else f, return_type)(*columns)
        return on_columns
    return wrap


def freeing(f):
    """``f``, and then ``give_back``."""
    @functools.wraps(f)
    def run(*columns):
        try:
            return f(*columns)
        finally:
            give_back()
    return run


def give_back() -> None:
    """Memory that is free but still held by Arrow's pool and the C library
    goes back to the system (where the library can)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def limit_batches(spark: SparkSession, rows: int = 2_000, size: int = 8 << 20) -> None:
    """Lowers the session's limits on what one Arrow batch to a Python worker
    holds (they are never raised): batches of long texts are held several
    times over, on both sides."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = re.fullmatch(r"(\d+)b?", spark.conf.get(key))
        if not now or not 0 < int(now[1]) <= most:
            spark.conf.set(key, str(most))


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker (functions travel
    by value, so their module's globals don't)."""
    import sys
    import types
    return sys.modules.setdefault("_revmart_worker", types.ModuleType("_revmart_worker")).__dict__
