"""Byte-level BPE encoding and decoding.

Long texts are cut into chunks that overlap; each chunk is pre-tokenised on
its own, in parallel. A chunk's first boundaries may be wrong, but once they
meet a boundary that the chunk before it also found they stay right, so two
neighbours are stitched at the first boundary both have in their overlap. The
pieces between such points are encoded in parallel and their ids joined in
order. Neighbours without a common boundary (a run longer than the overlap)
are kept together as one piece, so the ids are always those of the whole text.
Decoding concatenates the raw bytes of the ids.

Texts of at most ``CHUNK`` characters are one piece and never leave their
row; only longer ones are shuffled, by chunk.

Defined cases: null and empty texts have no ids; every row gives one row,
repeated ids included; other columns are ignored unless named in ``keep``; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table, text_of, vectorised, worker_cache

QUERY_NAME = "op3_byte_bpe"
RANKS = "byte_bpe_50k.tiktoken"
CHUNK = 32_768
OVERLAP = 512
MARGIN = 4  # boundaries this near to a chunk's end may depend on what follows


def load_encoding(rank_file: str) -> tiktoken.Encoding:
    """The encoding of a rank file, once per Python worker."""
    cache = worker_cache()
    if rank_file not in cache:
        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        cache[rank_file] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return cache[rank_file]


def encoder(rank_file: str):
    @vectorised("binary", frees=True)
    def encode(texts: pd.Series) -> pd.Series:
        enc = load_encoding(rank_file)
        return pd.Series([enc.encode_to_numpy(t, disallowed_special=()).astype("<u4").tobytes() for t in texts], dtype=object)
    return encode


def decoder(rank_file: str):
    """Raw bytes of little-endian unsigned 32-bit ids."""
    @vectorised("binary", frees=True)
    def decode(ids: pd.Series) -> pd.Series:
        cache = worker_cache()
        if ("bytes", rank_file) not in cache:
            enc = load_encoding(rank_file)
            cache["bytes", rank_file] = [enc.decode_single_token_bytes(i) for i in range(enc.n_vocab)]
        of = cache["bytes", rank_file].__getitem__
        return pd.Series([b"".join(map(of, np.frombuffer(x, "<u4").tolist())) for x in ids], dtype=object)
    return decode


def boundaries(text: str, lo: int, hi: int) -> list[int]:
    """Pre-token ends in [lo, hi) that follow a visible character. Cutting
    there changes neither side: what ends in white space could match more at
    the end of a text."""
    out = []
    for m in regex.finditer(public_tokenizers.PATTERN, text):
        end = m.end()
        if end >= hi:
            break
        if end >= lo and not text[end - 1].isspace():
            out.append(end)
    return out


def chunker(chunk: int, overlap: int):
    """Overlapping chunks of a text, each with the boundaries it found in the
    overlap at its head and at its tail (both counted from the later chunk)."""
    @vectorised("array<struct<chunk:int,last:boolean,text:string,head:array<int>,tail:array<int>>>")
    def cut(texts: pd.Series) -> pd.Series:
        def parts(text):
            out = []
            for k in range(-(-len(text) // chunk)):
                part = text[k * chunk:(k + 1) * chunk + overlap]
                last = (k + 1) * chunk >= len(text)
                ends = boundaries(part, 1, len(part) - MARGIN)
                out.append({"chunk": k, "last": last, "text": part, "head": [e for e in ends if e < overlap] if k else [],
                            "tail": [] if last else [e - chunk for e in ends if e > chunk]})
            return out
        return pd.Series([parts(t) for t in texts], dtype=object)
    return cut


@vectorised("binary")
def _joined(parts: pd.Series) -> pd.Series:
    return pd.Series([b"".join(p["ids"] for p in x) for x in parts], dtype=object)


def stitched_pieces(long_docs: DataFrame, names: list[str], chunk: int, overlap: int) -> DataFrame:
    """(row, names, piece, text) of (row, names, text): pieces whose encodings
    concatenate to the encoding of the whole text."""
    rows = long_docs.select("row", *names, F.explode(chunker(chunk, overlap)("text")).alias("c")).select("row", *names, "c.*")
    w = Window.partitionBy("row").orderBy("chunk")
    rows = rows.withColumn("start", F.array_min(F.array_intersect("head", F.lag("tail").over(w))))
    rows = rows.withColumn("end", F.lead("start").over(w))
    rows = rows.withColumn("piece", F.sum(F.when(F.col("start").isNotNull(), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.coalesce("start", F.lit(0))
    until = F.when(F.col("last"), F.char_length("text")).otherwise(F.lit(chunk) + F.coalesce("end", F.lit(0)))
    own = F.substring(F.col("text"), first + 1, F.greatest(until - first, F.lit(0)))
    return (rows.select("row", *names, "piece", "chunk", own.alias("text"))
            .groupBy("row", "piece").agg(*[F.first(n).alias(n) for n in names], F.array_sort(F.collect_list(F.struct("chunk", "text"))).alias("parts"))
            .select("row", *names, "piece", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text")))


def encode_documents(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                     rank_file: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``keep`` columns and ``ids`` (little-endian unsigned 32-bit) per row."""
    encode = encoder(rank_file or public_tokenizers.path(RANKS))
    names = [f"in_{i}" for i in range(len(keep))]
    base = docs.select(*[docs[c].alias(n) for c, n in zip(keep, names)], text_of(docs[text_col]).alias("text"))
    short = base.where(F.char_length("text") <= chunk).select(*names, encode("text").alias("ids"))
    numbered = base.where(F.char_length("text") > chunk).withColumn("row", F.monotonically_increasing_id())
    pieces = stitched_pieces(numbered, names, chunk, overlap).select("row", *names, "piece", encode("text").alias("ids"))
    long = pieces.groupBy("row").agg(*[F.first(n).alias(n) for n in names], F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("parts"))
    out = short.union(long.select(*names, _joined("parts").alias("ids")))
    return out.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], "ids")


def round_trip(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), rank_file: str | None = None, **kw) -> DataFrame:
    """Digest columns of encoding and decoding again."""
    rank_file = rank_file or public_tokenizers.path(RANKS)
    out = encode_documents(docs, keep=keep, rank_file=rank_file, **kw)
    out = out.select(*keep, "ids", decoder(rank_file)("ids").alias("__raw"))
    return out.select(*keep, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("__raw", 256).alias("decoded_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


ORACLE_SQL = None
