"""Token files: one wavelet matrix per shard.

Documents are put in ascending id order by a range partitioning, tokenised
where they arrive and cut into shards. A shard file holds its tokens as one
bit-plane per bit, highest first, each plane stably sorted by the plane above
it. Rank directories over the planes give access to any position, counts of a
token in any range and the places where it occurs, in one step a plane and
without decoding the shard; the planes are compressed in blocks that are read
one by one. A whole shard decodes bottom up in two copies a plane.

Files are written and read by Spark (one row, one file), so any file system
that Spark reaches will do. A shard closes once it has ``SHARD_TOKENS`` tokens;
a document is never split over two files.

Defined cases: null and empty texts are the end id alone; rows with a null id
come first; rows with equal ids stand in order of a hash of their text;
the tokenizer's special strings inside a text are special tokens, as its own
library has them; very long texts are taken whole; repeated rows each have their tokens; other columns are ignored; an empty
table writes no file and reads back empty.
"""

from __future__ import annotations

import math
import os
import re
import struct
import sys
from array import array

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CHARS, give_back, scratch_path, table, text_of, worker_cache

QUERY_NAME = "op9_token_files"
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SHARD_TOKENS = 1 << 20
PARTITION_BYTES = 24_000_000
MAGIC = b"WVM1"
HEAD = ">4sqqqIBI"       # magic, partition, tokens before, tokens, documents, planes, blocks a plane
BLOCK = 1 << 16                         # bytes of a plane that are compressed together
SUPER = 64                              # bytes between two entries of a rank directory
CACHE_PIECES = 700_000                  # pieces that a worker remembers, and the longest of them
CACHE_BYTES = 256
TOGETHER = 8_000_000                    # bytes of texts whose pieces are looked up together
SEGMENT = 1_000_000                     # bytes of text that are cut together


class WaveletMatrix:
    """Sequence of unsigned integers as bit-planes with rank and select."""

    def __init__(self, n: int, zeros: list[int], ranks: list[np.ndarray], plane):
        self.n, self.zeros, self.ranks, self._plane = n, zeros, ranks, plane

    @classmethod
    def build(cls, values: np.ndarray, planes: int) -> tuple["WaveletMatrix", list[np.ndarray]]:
        zeros, ranks, bits_of = [], [], []
        spare = [np.empty_like(values), np.empty_like(values)]
        for k in range(planes):
            bits = (values >> (planes - 1 - k)) & 1 != 0
            packed = np.packbits(bits, bitorder="little")
            packed = np.append(packed, np.zeros(-len(packed) % SUPER + SUPER, "uint8"))
            counts = np.bitwise_count(packed.reshape(-1, SUPER // 8, 8).view("uint64")).sum(axis=(1, 2), dtype="int64")
            zeros.append(int(len(bits) - counts.sum()))
            ranks.append(np.concatenate([[0], np.cumsum(counts)]).astype("uint32"))
            bits_of.append(packed)
            after = spare[k % 2]
            values.take(np.flatnonzero(~bits), out=after[:zeros[k]], mode="clip")
            values.take(np.flatnonzero(bits), out=after[zeros[k]:], mode="clip")
            values = after
        return cls(len(values), zeros, ranks, lambda k, lo, hi: bits_of[k][lo:hi]), bits_of

    def _bits(self, k: int, at: np.ndarray) -> np.ndarray:
        rows = self._rows(k, at // (8 * SUPER))
        inside = at % (8 * SUPER)
        return (rows[np.arange(len(at)), inside >> 3] >> (inside & 7)) & 1

    def _rows(self, k: int, row: np.ndarray) -> np.ndarray:
        uniq, back = np.unique(row, return_inverse=True)
        return np.stack([self._plane(k, r * SUPER, (r + 1) * SUPER) for r in uniq.tolist()])[back] if len(uniq) else np.zeros((0, SUPER), "uint8")

    def rank1(self, k: int, at) -> np.ndarray:
        """Ones of plane ``k`` before each position."""
        at = np.atleast_1d(np.asarray(at, "int64"))
        row, inside = at // (8 * SUPER), at % (8 * SUPER)
        take = np.clip(inside[:, None] - 8 * np.arange(SUPER)[None, :], 0, 8)
        mask = ((1 << take) - 1).astype("uint8")
        return self.ranks[k][row].astype("int64") + np.bitwise_count(self._rows(k, row) & mask).sum(axis=1, dtype="int64")

    def access(self, at) -> np.ndarray:
        """Values at the given positions."""
        at = np.atleast_1d(np.asarray(at, "int64"))
        value = np.zeros(len(at), "int64")
        for k in range(len(self.zeros)):
            bit, ones = self._bits(k, at), self.rank1(k, at)
            value = value << 1 | bit
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
        return value

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        for k in range(len(self.zeros)):
            ones = self.rank1(k, [lo, hi])
            if value >> (len(self.zeros) - 1 - k) & 1:
                lo, hi = (int(self.zeros[k] + x) for x in ones)
            else:
                lo, hi = int(lo - ones[0]), int(hi - ones[1])
        return lo, hi

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of ``value`` in positions [lo, hi)."""
        a, b = self._range(value, lo, self.n if hi is None else hi)
        return b - a

    def select(self, value: int, nth: int) -> int:
        """Position of the ``nth`` occurrence (from 0)."""
        a, b = self._range(value, 0, self.n)
        if not 0 <= nth < b - a:
            raise IndexError(nth)
        at = a + nth
        for k in range(len(self.zeros) - 1, -1, -1):
            one = value >> (len(self.zeros) - 1 - k) & 1
            want = at - self.zeros[k] if one else at
            lo, hi = 0, self.n
            while lo < hi:  # first prefix with more than ``want`` of this bit
                mid = (lo + hi) // 2
                ones = int(self.rank1(k, mid + 1)[0])
                if (ones if one else mid + 1 - ones) > want:
                    hi = mid
                else:
                    lo = mid + 1
            at = lo
        return at

    def occurrences(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]

    def decode(self) -> np.ndarray:
        """All values, bottom up."""
        planes = len(self.zeros)
        kind = np.uint16 if planes <= 16 else np.uint32
        low, here = np.zeros(self.n, kind), np.empty(self.n, kind)
        for k in range(planes - 1, -1, -1):
            ones = np.unpackbits(self._plane(k, 0, -(-self.n // 8)), count=self.n, bitorder="little").view(bool)
            here[np.flatnonzero(~ones)] = low[:self.zeros[k]]
            here[np.flatnonzero(ones)] = low[self.zeros[k]:] | kind(1 << (planes - 1 - k))
            low, here = here, low
        return low


def write_shard(partition: int, before: int, ids: list, lengths: list[int], tokens: np.ndarray, planes: int = 16) -> bytes:
    """The bytes of one shard file."""
    z = zstandard.ZstdCompressor(level=1)
    matrix, bits = WaveletMatrix.build(tokens, planes)
    blocks = -(-len(bits[0]) // BLOCK) if bits else 0
    known = np.array([i is not None for i in ids], bool)
    parts = [z.compress(np.array([i or 0 for i in ids], "<i8").tobytes() + known.tobytes() + np.array(lengths, "<u4").tobytes()
                        + np.array(matrix.zeros, "<u4").tobytes() + b"".join(r.astype("<u4").tobytes() for r in matrix.ranks))]
    parts += [z.compress(b[k * BLOCK:(k + 1) * BLOCK].tobytes()) for b in bits for k in range(blocks)]
    head = struct.pack(HEAD, MAGIC, partition, before, len(tokens), len(ids), planes, blocks)
    sizes = np.array([len(p) for p in parts], "<u4").tobytes()
    return head + sizes + b"".join(parts)


class Shard:
    """A shard file, opened; planes are decompressed as they are needed."""

    def __init__(self, data: bytes):
        magic, self.partition, self.before, n, docs, planes, blocks = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        sizes = np.frombuffer(data, "<u4", 1 + planes * blocks, struct.calcsize(HEAD)).astype("int64")
        at = struct.calcsize(HEAD) + 4 * len(sizes) + np.concatenate([[0], np.cumsum(sizes)])
        z = zstandard.ZstdDecompressor()
        raw = z.decompress(data[at[0]:at[1]])
        ids, known = np.frombuffer(raw, "<i8", docs), np.frombuffer(raw, bool, docs, 8 * docs)
        self.ids = [i if k else None for i, k in zip(ids.tolist(), known.tolist())]
        self.lengths = np.frombuffer(raw, "<u4", docs, 9 * docs).astype("int64")
        zeros = np.frombuffer(raw, "<u4", planes, 13 * docs).tolist()
        rank_size = (len(raw) - 13 * docs - 4 * planes) // 4 // max(1, planes)
        ranks = np.frombuffer(raw, "<u4", rank_size * planes, 13 * docs + 4 * planes).reshape(planes, rank_size)
        cache: dict[int, np.ndarray] = {}

        def block(k):
            if k not in cache:
                cache[k] = np.frombuffer(z.decompress(data[at[1 + k]:at[2 + k]]), "uint8")
            return cache[k]

        def plane(k, lo, hi):
            got = [block(k * blocks + b)[max(0, lo - b * BLOCK):hi - b * BLOCK] for b in range(lo // BLOCK, -(-hi // BLOCK))]
            return got[0] if len(got) == 1 else np.concatenate(got) if got else np.zeros(0, "uint8")
        self.tokens = WaveletMatrix(n, zeros, list(ranks), plane)


# --- tokenising ---------------------------------------------------------------

# What one byte of a text is. Words with an odd byte are encoded whole: the
# apostrophe may begin a contraction, the bar be part of a special token, and
# beyond ASCII only the letters up to U+00FF (C3 and a second byte) are known.
SPACE, LETTER, MARK, DIGIT, ODD = range(5)
KIND = bytes(SPACE if chr(b) in SPACE_CHARS else LETTER if chr(b).isalpha() else DIGIT if chr(b).isdigit()
             else MARK if chr(b).isprintable() and chr(b) not in "'|" else ODD for b in range(128)) + bytes([ODD]) * 128
LOWERED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LATIN, TIMES, DIVIDED = b"\xc3\x97\xb7"       # first byte of such letters; second bytes of signs among them
BREAK = re.compile(rb"[\x20\x09-\x0D]")
PLAIN = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{}~]+")


def byte_letters() -> dict[int, str]:
    """How the byte-level step spells letters beyond ASCII: each UTF-8 byte as
    itself where it is a printable Latin-1 character, otherwise as one of the
    characters from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    spelled = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}
    return {c: "".join(spelled[b] for b in chr(c).encode()) for c in range(128, 256)}


def load_tokenizer(path: str):
    cache = worker_cache()
    if path not in cache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        cache[path] = Tokenizer.from_file(path)
    return cache[path]


class PieceIds(dict):
    """Ids of pieces (UTF-8), worked out when first asked for, as little-endian
    unsigned 16-bit integers. The model is asked directly for plain pieces,
    the whole tokenizer for all others."""

    def __init__(self, tokenizer):
        self.tokenizer, self.model, self.letters = tokenizer, tokenizer.model.tokenize, byte_letters()

    def __missing__(self, piece: bytes) -> bytes:
        text = piece.decode()
        if PLAIN.fullmatch(text):
            ids = [t.id for t in self.model(text if text.isascii() else text.translate(self.letters))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        out = array("H", ids)
        if sys.byteorder == "big":
            out.byteswap()
        got = out.tobytes()
        if len(piece) <= CACHE_BYTES:
            self[piece] = got
        return got

    def trim(self) -> None:
        if len(self) > CACHE_PIECES:
            self.clear()


def cut(raw: bytes) -> tuple[np.ndarray, pa.Array]:
    """Pieces of a text and where they begin: runs of letters (in lower case),
    single digits, runs of marks; words that have other bytes are one piece."""
    data = np.frombuffer(raw, "uint8")
    kind, text = (np.frombuffer(bytearray(raw.translate(t)), "uint8") for t in (KIND, LOWERED))
    first = np.flatnonzero(data[:-1] == LATIN)
    if len(first):
        second = data[first + 1]
        kind[first] = LETTER
        kind[first + 1] = np.where((second == TIMES) | (second == DIVIDED), ODD, LETTER)
        text[first[(second <= 0x9E) & (second != TIMES)] + 1] += 0x20
    word = kind != SPACE
    odd = np.flatnonzero(kind == ODD)
    if len(odd):
        edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
        starts, stops = edges[::2], edges[1::2]
        those = np.unique(np.searchsorted(starts, odd, "right") - 1)
        step = np.zeros(len(data) + 1, "int8")
        step[starts[those]] = 1
        step[stops[those]] = -1
        inside = np.cumsum(step[:-1], dtype="int8").view(bool)
        kind[inside] = ODD
        text = np.where(inside, data, text)
    begins = word.copy()
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    at = np.flatnonzero(begins)
    kept = text[word]
    ends = np.append(np.cumsum(word, dtype="int32")[at] - 1, len(kept)).astype("int32")
    return at, pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(kept)])


def tokenise(texts: list[str], path: str, together: int = TOGETHER, segment: int = SEGMENT):
    """Ids of each text in turn, as little-endian unsigned 16-bit integers.
    The tokenizer splits at white space and never looks across it, and it
    splits plain words further, so pieces are encoded once and remembered for
    a while. Some ``together`` bytes of texts are looked up at once; they are
    cut ``segment`` bytes at a time, always at white space."""
    cache = worker_cache()
    if ("pieces", path) not in cache:
        cache["pieces", path] = PieceIds(load_tokenizer(path))
    group, size = [], 0
    for t in texts:
        group.append(t.encode())
        size += len(group[-1])
        if size >= together:
            yield from _ids_of(group, cache["pieces", path], segment)
            group, size = [], 0
            give_back()
    yield from _ids_of(group, cache["pieces", path], segment)
    give_back()


def _ids_of(texts: list[bytes], pieces: PieceIds, segment: int) -> list[bytes]:
    data, stops = b"\n".join(texts), np.cumsum([len(t) + 1 for t in texts])
    found, upto, lo = [], np.zeros(len(texts), "int64"), 0
    while lo < len(data):                       # pieces, and how many there are up to the end of each text
        end = BREAK.search(data, lo + segment)
        hi = end.end() if end else len(data)
        at, some = cut(data[lo:hi])
        found.append(some)
        upto += np.searchsorted(at, np.clip(stops - lo, 0, hi - lo))
        lo = hi
    if not upto[-1:].any():
        return [b""] * len(texts)
    found = pa.chunked_array(found).dictionary_encode()
    pieces.trim()
    ids = list(map(pieces.__getitem__, found.chunk(0).dictionary.to_numpy(zero_copy_only=False).tolist()))
    length = np.fromiter(map(len, ids), "int64", len(ids)) // 2
    begin, ids = np.cumsum(length) - length, np.frombuffer(b"".join(ids), "<u2")
    tokens, ends, total = [], [np.zeros(1, "int64")], 0
    for chunk in found.chunks:
        which = chunk.indices.to_numpy()
        n = length[which]
        end = np.cumsum(n)
        tokens.append(ids[np.repeat(begin[which] - end + n, n) + np.arange(n.sum())])
        ends.append(end + total)
        total += len(tokens[-1])
    tokens, stops = np.concatenate(tokens), np.concatenate(ends)[upto].tolist()
    return [tokens[a:b].tobytes() for a, b in zip([0, *stops], stops)]


def _shards(path: str, shard_tokens: int):
    def build(batches):
        partition, before = TaskContext.get().partitionId(), 0
        ids, lengths, parts, size = [], [], [], 0
        end = np.array([END_ID], "<u2").tobytes()

        def close():
            tokens = np.frombuffer(b"".join(parts), "<u2")
            return pd.DataFrame({"file": [write_shard(partition, before, ids, lengths, tokens)]})

        for pdf in batches:
            keys = [None if k is None else int(k) for k in pdf["key"]]
            texts = pdf["text"].to_list()
            for key, got in zip(keys, tokenise(texts, path)):
                ids.append(key)
                parts += [got, end]
                lengths.append(len(got) // 2 + 1)
                size += lengths[-1]
                if size >= shard_tokens:
                    yield close()
                    before += size
                    ids, lengths, parts, size = [], [], [], 0
        if ids:
            yield close()
    return build


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
                 shard_tokens: int = SHARD_TOKENS, partition_bytes: int = PARTITION_BYTES) -> None:
    """Writes the shard files of ``docs`` below ``path``."""
    base = docs.select(docs[id_col].cast("long").alias("id"), text_of(docs[text_col]).alias("text"))
    size = base.agg(F.sum(F.octet_length("text") + 64).alias("b")).first()["b"] or 0
    order = ["id", "hash"]
    ranged = base.withColumn("hash", F.xxhash64("text")).repartitionByRange(max(1, math.ceil(size / partition_bytes)), *order).sortWithinPartitions(*order)
    files = ranged.select(F.col("id").cast("string").alias("key"), "text") \
        .mapInPandas(_shards(tokenizer or public_tokenizers.path(TOKENIZER), shard_tokens), "file binary")
    # The text writer puts the bytes of a row and a line feed, as they are.
    files.select(F.col("file").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def _documents(batches):
    for pdf in batches:
        for data in pdf["content"]:
            s = Shard(bytes(data))
            raw = s.tokens.decode().astype("<u4").tobytes()
            stops = np.cumsum(s.lengths)
            starts = stops - s.lengths
            yield pd.DataFrame({"partition": s.partition, "inside": s.before + starts, "key": [None if i is None else str(i) for i in s.ids],
                                "n_tokens": s.lengths, "ids": [raw[4 * a:4 * b] for a, b in zip(starts.tolist(), stops.tolist())]})


def read_tokens(spark, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files below
    ``path``; ``ids`` as little-endian unsigned 32-bit integers."""
    files = spark.read.format("binaryFile").load(path)
    number = lambda at: F.conv(F.hex(F.substring("content", at, 8)), 16, 10).cast("long")
    sums = files.select(number(5).alias("partition"), (number(13) + number(21)).alias("upto")).groupBy("partition").agg(F.max("upto").alias("n"))
    # One row per range partition that was written, so small enough to send.
    ahead = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("partition", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    rows = files.select("content").mapInPandas(_documents, "partition long, inside long, key string, n_tokens long, ids binary")
    return rows.join(F.broadcast(bases), "partition").select(F.col("key").cast("long").alias("doc_id"), (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids")


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


ORACLE_SQL = None
