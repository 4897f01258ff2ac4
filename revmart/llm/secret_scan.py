"""Secret scans with corpus-wide ownership frequency.

A scan finds candidates in every whole text: three base kinds, which are always
reported, and further kinds (private key blocks, vendor tokens, web tokens,
passwords in addresses, opaque strings of high entropy). Only spans and hashes
leave the scan. Candidate hashes are then counted by distinct repositories and
distinct owners over the whole corpus: a value that many owners hold is a
widely copied example; one that belongs to few owners and looks live (enough
entropy, no placeholder word) is taken for a credential, and its span is added
to the base ones.

The counts are three nested groupings with partial sums before each shuffle, so
an example in a third of all documents is combined inside every task. On the
way back, hashes with more than 1 in 1,024 of all candidates (at most 1,024 by
that) are broadcast and the rest is joined by hash; so no task meets a hot
hash. Rows without candidates are not shuffled at all.

Defined cases: null and empty texts have no spans; very long texts are scanned
whole; a null repository is one of its own, and so is a null owner; repeated
rows and null ids each come out, and count once as repository and owner; spans
that overlap a base span, or an added one of an earlier kind, are not added;
other columns are ignored, whatever their names; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort
from collections import Counter
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, table, text_of

QUERY_NAME = "op11_secret_scan"
# The base kinds, and public formats of credentials.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEY_BLOCK = re.compile(r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----([A-Za-z0-9+/=\s]{32,})")
VENDOR = re.compile(r"(?<![A-Za-z0-9])(?:gh[pousr]_|github_pat_|glpat-|[sr]k_live_|xox[abprs]-|AIza|npm_|SG\.)[A-Za-z0-9_.-]{16,}")
WEB_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
ADDRESS = re.compile(r"://[^\s/:@]+:([^\s/@]{6,})@")
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}")
KINDS = ("assign", "access", "hex", "key_block", "vendor", "web_token", "address", "opaque")
BASE = 3                                # the first kinds are the base ones
PLACEHOLDERS = ("example", "sample", "dummy", "placeholder", "changeme", "password", "secret", "your", "xxxx", "test", "fake", "1234", "abcd")
LEAST_WORD = 20                         # no kind within one word is shorter
LEAST_ENTROPY, OPAQUE_ENTROPY = 3.0, 3.8
WIDE_OWNERS = 3                         # owners from which on a value is a copied example
HOT = 1024
FOUND = "array<struct<kind:int,start:bigint,end:bigint,hash:binary,live:boolean>>"


def entropy(value: str) -> float:
    """Bits a character."""
    n = len(value)
    return sum(c / n * log2(n / c) for c in Counter(value).values()) if n else 0.0


def looks_live(value: str) -> bool:
    low = value.lower()
    return entropy(value) >= min(LEAST_ENTROPY, 0.75 * log2(max(len(value), 2))) and not any(p in low for p in PLACEHOLDERS)


def _mixed(value: str) -> bool:
    return (any(c.isdigit() for c in value) and any("a" <= c <= "z" for c in value) and any("A" <= c <= "Z" for c in value)
            and entropy(value) >= OPAQUE_ENTROPY)


def _long_words(text: str):
    """(start, word) of the words that are long enough for a kind without
    white space. The next place a long word is found at is its own: whatever
    holds it before that would be a long word, too."""
    at = 0
    for w in text.split():
        if len(w) >= LEAST_WORD:
            at = text.index(w, at)
            yield at, w
            at += len(w)


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of one text: all base spans, and those of
    further kinds that overlap nothing found before them."""
    low = text.lower()
    found = []
    if "passw" in low or "secret" in low or "token" in low or "key" in low:
        found += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    words = list(_long_words(text))
    for kind, pattern, least in ((1, ACCESS, 20), (2, HEX, 24)):
        found += [(kind, at + m.start(), at + m.end(), m[0]) for at, w in words for m in pattern.finditer(w) if len(m[0]) >= least]
    more = []
    if "-----BEGIN" in text:
        more += [(3, m.start(), m.end(), "".join(m[1].split())) for m in KEY_BLOCK.finditer(text)]
    for kind, pattern in ((4, VENDOR), (5, WEB_TOKEN)):
        more += [(kind, at + m.start(), at + m.end(), m[0]) for at, w in words for m in pattern.finditer(w)]
    if "://" in text:
        more += [(6, m.start(1), m.end(1), m[1]) for m in ADDRESS.finditer(text)]
    more += [(7, at + m.start(), at + m.end(), m[0]) for at, w in words for m in OPAQUE.finditer(w) if _mixed(m[0])]
    if more:
        taken = _Taken((s, e) for _, s, e, _ in found)
        found += [c for c in more if taken.add(c[1], c[2])]
    return found


class _Taken:
    """Spans of a text that are in use, merged and in order."""

    def __init__(self, spans):
        self.at: list[list[int]] = []
        for s, e in sorted(spans):
            if self.at and s < self.at[-1][1]:
                self.at[-1][1] = max(self.at[-1][1], e)
            else:
                self.at.append([s, e])

    def add(self, s: int, e: int) -> bool:
        k = bisect_left(self.at, [s, s])
        if k and self.at[k - 1][1] > s or k < len(self.at) and self.at[k][0] < e:
            return False
        insort(self.at, [s, e])
        return True


def span_text(found: list[tuple]) -> str:
    """kind:start:end, by start and then by kind."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted((s, k, e) for k, s, e, _ in found))


def _scan(batches):
    kinds = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.binary()), ("live", pa.bool_())])
    for batch in batches:
        counts, shas, spans, founds = [[], [], []], [], [], []
        for text in batch.column("text"):
            found = candidates(text.as_py())
            base = [c for c in found if c[0] < BASE]
            line = span_text(base)
            for k in range(BASE):
                counts[k].append(sum(c[0] == k for c in base))
            shas.append(hashlib.sha256(line.encode()).hexdigest())
            spans.append(line)
            founds.append([{"kind": k, "start": s, "end": e, "hash": hashlib.sha256(v.encode()).digest()[:16], "live": looks_live(v)} for k, s, e, v in found])
        keep = [batch.column(c) for c in ("row", "doc_id", "repo", "owner")]
        yield pa.RecordBatch.from_arrays([*keep, *[pa.array(c, pa.int64()) for c in counts], pa.array(shas, pa.string()), pa.array(spans, pa.string()),
                                          pa.array(founds, pa.list_(kinds))],
                                         names=["row", "doc_id", "repo", "owner", "n_assign", "n_access", "n_hex", "base_sha256", "base_spans", "found"])


def owner_of(repo: Column) -> Column:
    """``owner/name`` belongs to ``owner``; any other name is its own owner."""
    return F.substring_index(repo, "/", 1)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", owner=owner_of) -> DataFrame:
    """One narrow checkpointed row per input row: base digest and candidates."""
    repo = docs[repo_col].cast("string")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("doc_id"), repo.alias("repo"), owner(repo).alias("owner"),
                       text_of(docs[text_col]).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return checkpointed(rows.mapInArrow(_scan, f"row bigint, doc_id {kind}, repo string, owner string, n_assign bigint, n_access bigint, n_hex bigint, "
                                               f"base_sha256 string, base_spans string, found {FOUND}"))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_rows, n_repos, n_owners) of all candidates: exact distinct
    counts by nested grouping."""
    by_repo = found.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
    by_owner = by_repo.groupBy("hash", "owner").agg(F.count("*").alias("repos"), F.sum("n").alias("n"))
    return by_owner.groupBy("hash").agg(F.sum("n").alias("n_rows"), F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))


def judged(parts: DataFrame, wide_owners: int = WIDE_OWNERS) -> DataFrame:
    """One row per candidate: where it stands, in how many rows, repositories
    and owners its value occurs, and ``verdict``: copied (many owners), live
    (few owners, looks live) or dull."""
    found = parts.where(F.size("found") > 0).select("row", "doc_id", "repo", "owner", F.explode("found").alias("f")).select("row", "doc_id", "repo", "owner", "f.*")
    counts = checkpointed(ownership(found))
    total = found.count()
    hot = F.broadcast(counts.where(F.col("n_rows") * HOT > total))          # at most HOT rows
    rest = found.join(hot.select("hash"), "hash", "left_anti").join(counts.where(F.col("n_rows") * HOT <= total), "hash")
    verdict = F.when(F.col("n_owners") >= wide_owners, "copied").when(F.col("live"), "live").otherwise("dull")
    return found.join(hot, "hash").unionByName(rest).withColumn("verdict", verdict)


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", owner=owner_of,
                wide_owners: int = WIDE_OWNERS) -> DataFrame:
    """One row per input row: counts and digest of the base spans, all spans,
    and how many candidates are added, live-looking and copied."""
    parts = scan(docs, id_col, text_col, repo_col, owner)
    kept = (F.col("kind") < BASE) | (F.col("verdict") == "live")
    by_row = judged(parts, wide_owners).groupBy("row").agg(
        F.sort_array(F.collect_list(F.when(kept, F.struct("start", "kind", "end")))).alias("all"),
        F.count(F.when(kept & (F.col("kind") >= BASE), 1)).alias("n_added"),
        F.count(F.when(F.col("verdict") == "live", 1)).alias("n_live"), F.count(F.when(F.col("verdict") == "copied", 1)).alias("n_copied"))

    def text(x):
        name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), x["kind"] + 1)
        return F.concat_ws(":", name, x["start"].cast("string"), x["end"].cast("string"))

    spans = F.array_join(F.transform("all", text), ",")
    base = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
    counts = ["n_added", "n_live", "n_copied"]
    some = parts.where(F.size("found") > 0).join(by_row, "row").select(*base, spans.alias("spans"), *counts)
    none = parts.where(F.size("found") == 0).select(*base, F.col("base_spans").alias("spans"), *[F.lit(0).cast("bigint").alias(c) for c in counts])
    return none.unionByName(some)


def query(spark, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


# Positions of matches are not SQL.
ORACLE_SQL = None
