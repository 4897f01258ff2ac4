"""Cross-tokenizer alignment by diagonal run skipping.

Both tokenizers cut the same bytes, so each is an array of token ends. The
walk keeps the index shift between the two arrays: while ends at that shift
agree, exponential probing (16, 32, 64, ... ends compared at once, the first
that differs read off the lowest bit) jumps the one-to-one stretch; where they
stop agreeing, the irregular group is resolved token by token up to the next
common end, and the shift is updated by it.

Texts are encoded whole and the walk runs over the whole text. The byte-level
file is run by the ranks of its merges where its ids are in the order of the
merges (checked when it is loaded), else by its own library. The piece file is
run by the ranks of its scores where that gives the same ids (also checked);
texts with neighbouring spaces, a very long word or a U+2581, and files that
fail the check, go to its own library.

How often an id pair is linked is counted over the corpus. Documents are gone
through in blocks; a block sends its distinct pairs (key and count) to be
summed by pair, gets the sums back, and meets the narrow rows of its documents
(pair numbers and multiplicities) in one group, bounded by the block. So the
text is read once and nothing grows with the number of links in a group.

Defined cases: null and empty texts, and texts whose tokens of either kind do
not spell the space and the text (such as a text with U+2581), have no tokens,
hence zeros and '' as digest; very long texts are blocks of their own; repeated
rows and null ids each count and come out; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, table, text_of, worker_cache

QUERY_NAME = "op12_token_align"
TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE_MARK = "▁"
BLOCK_LINKS = 2_000_000                 # links after which a block is closed
TEXTS = 200                             # texts that are encoded in one call
LONG_WORD = 400                         # bytes of the longest word that is merged by ranks (the work may grow faster than the word)
PROBE = 16                              # ends that a first probe compares
ROW = "block bigint, kind int, row bigint, doc_id {id}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pair bigint, count bigint, links binary"
NAMES = ("block", "kind", "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "count", "links")
DOCUMENT, PAIR = 0, 1


# --- tokenizers ----------------------------------------------------------------

def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable character: itself
    where it is printable in Latin-1, else the next one from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


NEVER = "<|never|>"                     # stands for a special token where a library wants one; plain text if it occurs


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), "object")
    out[:] = values
    return out


class ByteLevel:
    """Tokenizer file of the tokenizers library with a byte-level vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        byte = byte_of_char()
        special = {t["content"] for t in spec["added_tokens"]}
        spelled = {i: entry.encode() if entry in special else bytes(byte[c] for c in entry) for entry, i in vocabulary.items()}
        self.size = max(spelled) + 1
        self.spelled = _objects([spelled.get(i, b"") for i in range(self.size)])
        ranks = {v: i for i, v in spelled.items() if i < 256 + len(merges)}
        in_order = len(ranks) == 256 + len(merges) and all(
            vocabulary.get("".join(m if isinstance(m, list) else m.split(" "))) == 256 + k for k, m in enumerate(merges))
        if in_order:
            import tiktoken
            # Not one special token is ever allowed; without any, the library looks for '' at every place.
            model = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={NEVER: self.size})
            self.encode = lambda texts: [model.encode_to_numpy(t, disallowed_special=()).astype("int64") for t in texts]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            model = Tokenizer.from_file(path)
            model.encode_special_tokens = True
            self.encode = lambda texts: [np.array(e.ids, "int64") for e in model.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """Model file of the sentencepiece library; it adds the first space itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        entries = [model.id_to_piece(i) for i in range(self.size)]
        self.spelled = _objects([bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(entries)])
        self._library = lambda texts: [np.array(ids, "int64") for ids in model.encode(texts, num_threads=1)]
        self._ranked = self._by_ranks(model, entries)

    def _by_ranks(self, model, entries: list[str]):
        """Function of a spaced text, or None where the file's merges are not
        those of its ranks. Merging goes by falling score, the leftmost first,
        which is merging by ranks where scores differ. Words can be taken one by
        one as no piece goes on behind a space; a character's bytes are put
        together before all else."""
        normal = {p: i for i, p in enumerate(entries) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
        of_byte = {int(p[3:5], 16): i for i, p in enumerate(entries) if model.is_byte(i)}
        merged = sorted((p for p in normal if len(p) > 1 and not p.startswith(2 * SPACE_MARK)), key=lambda p: -model.get_score(normal[p]))
        scores = [model.get_score(normal[p]) for p in merged]
        if not (_plain_model(model) and len(of_byte) == 256 and SPACE_MARK in normal and all(c in normal for p in normal for c in p)
                and not any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in normal) and all(x > y for x, y in zip(scores, scores[1:]))
                and model.encode([p[1:] for p in merged if p[0] == SPACE_MARK]) == [[normal[p]] for p in merged if p[0] == SPACE_MARK]):
            return None
        ranks = {bytes([b]): b for b in range(256)}
        ids = [[normal.get(SPACE_MARK if b == 32 else chr(b), of_byte[b]) if b < 128 else of_byte[b]] for b in range(256)]
        chars = {p.encode(): i for p, i in normal.items() if len(p) == 1 and p != SPACE_MARK and not p.isascii()}
        heads = {c[:k] for c in chars for k in range(2, len(c) + 1)}
        for spelled in sorted(heads, key=lambda h: (len(h), h)):
            ranks[spelled] = len(ids)
            ids.append([chars[spelled]] if spelled in chars else [of_byte[b] for b in spelled])
        for p in merged:
            ranks[p.replace(SPACE_MARK, " ").encode()] = len(ids)
            ids.append([normal[p]])
        import tiktoken
        ranked = tiktoken.Encoding("pieces", pat_str=" ?[^ ]+| ", mergeable_ranks=ranks, special_tokens={NEVER: len(ids)})
        first, many = np.array([i[0] for i in ids]), np.array([len(i) for i in ids])
        rest = np.array([i + [0] * (4 - len(i)) for i in ids])

        def encode(spaced: str) -> np.ndarray:
            at = ranked.encode_to_numpy(spaced, disallowed_special=())
            times = many[at]
            return first[at] if times.max() == 1 else rest[at][np.arange(4) < times[:, None]]
        return encode

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = [self._ranked(" " + t) if self._ranked and _single_spaces(t) else None for t in texts]
        left = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(left, self._library([texts[k] for k in left]) if left else ()):
            out[k] = ids
        return out


def _plain_model(model) -> bool:
    """Whether texts are merged as they are, with a space put ahead, and bytes
    stand for unknown characters."""
    try:
        from sentencepiece import sentencepiece_model_pb2
    except ImportError:
        return False
    spec = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
    how, kinds = spec.normalizer_spec, spec.SentencePiece
    return (spec.trainer_spec.model_type == spec.trainer_spec.BPE and spec.trainer_spec.byte_fallback and not spec.trainer_spec.treat_whitespace_as_suffix
            and how.add_dummy_prefix and how.escape_whitespaces and not how.remove_extra_whitespaces and not how.precompiled_charsmap
            and {p.type for p in spec.pieces} <= {kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE})


def _single_spaces(text: str) -> bool:
    """Whether a text has no neighbouring spaces (counting the one that is put
    ahead), no space mark and no very long word."""
    spaces = np.flatnonzero(np.frombuffer(f" {text} ".encode(), "uint8") == 32)
    between = spaces[1:] - spaces[:-1]
    # A space at the end is fine.
    return text != "" and SPACE_MARK not in text and between.max() <= LONG_WORD and (between[:-1] > 1).all()


class Encoder:
    """Both tokenizers' ids of whole texts."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.lengths = [np.array(list(map(len, t.spelled)), "int64") for t in (self.a, self.b)]
        self.marked = [marked(t.size, *marks) for t, marks in ((self.a, ",|"), (self.b, ",;"))]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """(ids of A, ids of B) a text; None where it has no tokens."""
        spaced = [" " + t for t in texts]
        out = []
        for t, a, b in zip(spaced, self.a.encode(spaced), self.b.encode(texts)):
            want = t.encode()
            spells = len(want) > 1 and all(b"".join(k.spelled[ids].tolist()) == want for k, ids in ((self.a, a), (self.b, b)))
            out.append((a, b) if spells else None)
        return out


# --- alignment ------------------------------------------------------------------

def inner(ends_a, ends_b) -> tuple[list[int], list[int]]:
    """Tokens of two arrays of increasing ends with the same last one whose end
    the other array hasn't."""
    inner_a, inner_b = [], []
    raw_a, raw_b = (np.asarray(ends).astype("<u4").tobytes() for ends in (ends_a, ends_b))
    ends_a, ends_b = (memoryview(np.ascontiguousarray(ends, "int64")) for ends in (ends_a, ends_b))
    number = int.from_bytes
    i = j = 0
    n = len(ends_a)
    while True:
        step = PROBE
        while i < n:
            differs = number(raw_a[4 * i:4 * (i + step)], "little") ^ number(raw_b[4 * j:4 * (j + step)], "little")
            if differs:
                agree = (differs & -differs).bit_length() - 1 >> 5
                i += agree
                j += agree
                break
            i += step
            j += step
            step *= 2
        if i >= n:
            return inner_a, inner_b
        a, b = ends_a[i], ends_b[j]            # irregular: up to the next common end
        while a != b:
            if a < b:
                inner_a.append(i)
                i += 1
                a = ends_a[i]
            else:
                inner_b.append(j)
                j += 1
                b = ends_b[j]
        i += 1
        j += 1


def cuts_of(n: int, within: list[int]) -> np.ndarray:
    """How many of ``n`` tokens each group and the groups before it hold, of
    the tokens that end ``within`` a group."""
    last = np.ones(n, bool)
    last[within] = False
    return np.flatnonzero(last) + 1


def align(ends_a, ends_b) -> tuple[np.ndarray, np.ndarray]:
    """Cuts of two arrays of increasing ends with the same last one: per group,
    how many tokens of either array it and the groups before it hold."""
    inner_a, inner_b = inner(ends_a, ends_b)
    return cuts_of(len(ends_a), inner_a), cuts_of(len(ends_b), inner_b)


def links(ends_a: np.ndarray, ends_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray, inner_a: np.ndarray, inner_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all pairs of tokens that share a byte: every stretch between
    two neighbouring ends of either kind lies in one token of each, and ends
    with both, or within the other's."""
    return (np.concatenate([cuts_a - 1, inner_a, np.searchsorted(ends_a, ends_b[inner_b])]),
            np.concatenate([cuts_b - 1, np.searchsorted(ends_b, ends_a[inner_a]), inner_b]))


def marked(size: int, inside: str, last: str) -> np.ndarray:
    """Every id as text with the sign that follows within a group, and then
    with the one that follows a group's last; padded with zero bytes."""
    texts = [f"{i}{mark}".encode() for mark in (inside, last) for i in range(size)]
    return np.array(texts, f"S{-(-max(map(len, texts)) // 8) * 8}")


def digest(cuts_a: np.ndarray, cuts_b: np.ndarray, a: np.ndarray, b: np.ndarray, texts) -> str:
    """sha256 of ``a1,a2|b1;a3|b2,b3``, all groups in order. ``texts`` holds
    the ids of either kind as ``marked``."""
    out = np.empty(len(a) + len(b), f"S{max(t.itemsize for t in texts)}")
    sizes_a, sizes_b = np.diff(cuts_a, prepend=0), np.diff(cuts_b, prepend=0)
    for ids, cuts, before, text in ((a, cuts_a, np.repeat(cuts_b - sizes_b, sizes_a), texts[0]), (b, cuts_b, np.repeat(cuts_a, sizes_b), texts[1])):
        row = ids.copy()
        row[cuts - 1] += len(text) // 2
        out[np.arange(len(ids)) + before] = text[row]
    return hashlib.sha256(out.tobytes().translate(None, b"\0")[:-1]).hexdigest()


class Block:
    """Rows of consecutive documents, and the pairs they link."""

    def __init__(self):
        self.rows, self.pairs, self.counts, self.links = [], [], [], 0

    def add(self, doc_id, found, encoder: Encoder) -> None:
        if found is None:
            self.rows.append((doc_id, 0, 0, 0, 0, ""))
            self.pairs.append(np.zeros(0, "int64"))
            self.counts.append(np.zeros(0, "int64"))
            return
        a, b = found
        ends_a, ends_b = encoder.lengths[0][a].cumsum(), encoder.lengths[1][b].cumsum()
        inner_a, inner_b = (np.array(x, "int64") for x in inner(ends_a, ends_b))
        cuts_a, cuts_b = cuts_of(len(a), inner_a), cuts_of(len(b), inner_b)
        sha = digest(cuts_a, cuts_b, a, b, encoder.marked)
        at_a, at_b = links(ends_a, ends_b, cuts_a, cuts_b, inner_a, inner_b)
        pairs, counts = np.unique(a[at_a] * encoder.b.size + b[at_b], return_counts=True)
        self.rows.append((doc_id, len(a), len(b), len(cuts_a), len(at_a), sha))
        self.pairs.append(pairs)
        self.counts.append(counts)
        self.links += len(at_a)

    def records(self, block: int, id_type: pa.DataType):
        """Arrow batch of the block's pairs and documents. A document's links
        are the numbers of its pairs in the sorted pairs of the block, and
        their multiplicities."""
        keys, number = np.unique(np.concatenate(self.pairs), return_inverse=True)
        sums = np.bincount(number, np.concatenate(self.counts), len(keys)).astype("int64")
        cuts = np.cumsum([len(p) for p in self.pairs])[:-1]
        packed = [at.astype("<u4").tobytes() + c.astype("<u4").tobytes() for at, c in zip(np.split(number, cuts), self.counts)]
        n, m = len(self.rows), len(keys)
        doc_id, *measures, sha = zip(*self.rows)
        none = [None] * m
        columns = [pa.array(np.full(n + m, block), pa.int64()), pa.array(np.repeat([DOCUMENT, PAIR], [n, m]), pa.int32()), pa.array([*range(n), *none], pa.int64()),
                   pa.array([*doc_id, *none], id_type), *[pa.array([*c, *none], pa.int64()) for c in measures], pa.array([*sha, *none], pa.string()),
                   pa.array(np.concatenate([np.zeros(n, "int64"), keys])), pa.array(np.concatenate([np.zeros(n, "int64"), sums])), pa.array([*packed, *none], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=list(NAMES))


def _blocks(path_a: str, path_b: str, block_links: int):
    def run(batches):
        encoder = worker_cache().get(("align", path_a, path_b)) or worker_cache().setdefault(("align", path_a, path_b), Encoder(path_a, path_b))
        part, made, block, kind = TaskContext.get().partitionId(), 0, Block(), None
        for batch in batches:
            kind = batch.column(0).type
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(ids), TEXTS):
                some = texts.slice(at, TEXTS).to_pylist()
                for doc_id, found in zip(ids[at:at + TEXTS], encoder.encode(some)):
                    block.add(doc_id, found, encoder)
                    if block.links >= block_links:
                        yield block.records(part << 32 | made, kind)
                        made, block = made + 1, Block()
        if block.rows:
            yield block.records(part << 32 | made, kind)
    return run


def _placed(pairs: pa.Table, docs: pa.Table) -> pa.Table:
    """Cogroup of a block's pairs (corpus-wide count, whether it is the B id's
    highest) and its documents."""
    order = np.argsort(pairs.column("pair").to_numpy())
    count = pairs.column("count").to_numpy()[order]
    best = pairs.column("best").to_numpy()[order]
    n_best, count_sum = [], []
    for packed in docs.column("links").to_pylist():
        at, times = np.frombuffer(packed, "<u4").reshape(2, -1)
        n_best.append(int(times[best[at] == 1].sum()))
        count_sum.append(int((count[at] * times).sum()))
    kept = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64())).append_column(
        "groups_sha256", docs.column("groups_sha256"))


def pair_counts(parts: DataFrame, size_b: int) -> DataFrame:
    """(pair, count, best): links of every id pair over the corpus, and whether
    no pair of its B id has more."""
    counts = parts.where(F.col("kind") == PAIR).groupBy("pair").agg(F.sum("count").alias("count"))
    b = F.pmod("pair", F.lit(size_b))
    top = counts.groupBy(b.alias("b")).agg(F.max("count").alias("top"))
    return counts.join(top, b == F.col("b")).select("pair", "count", (F.col("count") == F.col("top")).cast("int").alias("best"))


def token_alignment(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None,
                    block_links: int = BLOCK_LINKS) -> DataFrame:
    """One row per input row: token, group and link counts, the links whose
    pair is its B id's most frequent, the sum of their counts and the digest of
    the groups."""
    path_a, path_b = path_a or public_tokenizers.path(TOKENIZER_A), path_b or public_tokenizers.path(TOKENIZER_B)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs[text_col]).alias("text"))
    parts = checkpointed(rows.mapInArrow(_blocks(path_a, path_b, block_links), ROW.format(id=id_type)))
    pairs, documents = parts.where(F.col("kind") == PAIR), parts.where(F.col("kind") == DOCUMENT)
    size_b = Pieces(path_b).size
    values = pairs.select("block", "pair").join(pair_counts(parts, size_b), "pair").select("block", "pair", "count", "best")
    narrow = documents.select(F.col("block").alias("of_block"), "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    return values.groupBy("block").cogroup(narrow.groupBy("of_block")).applyInArrow(
        _placed, f"doc_id {id_type}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    return token_alignment(table(spark, sf_dir, "documents"))


# Tokenizers are not SQL.
ORACLE_SQL = None
