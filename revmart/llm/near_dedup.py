"""Near-duplicate classes by ProbMinHash, banding and exact verification.

A document is its five-word shingles weighted by their counts. Each shingle
starts a Poisson process whose rate is its weight; an arrival at time ``h``
claims one random signature place if it is earlier than what is there, and a
process ends as soon as its next arrival is later than every place. Two
signatures agree in a place with the probability Jaccard similarity. Equal
texts share one digest and go on as one; signatures are cut into bands, and
documents that share a band are candidates.

Candidates are linked without listing all pairs of a band: first every member
with CENTERS members of its band, verified on the full shingle weights (pairs
whose signatures hardly agree are left for later); then connected components;
then members of one band that are still in different components are compared
in blocks, where an inverted index of their shingles gives all similarities of
two blocks at once and only links come out. So every pair that shares a band
is either in one class already or was compared.

``similarity`` is the exact probability Jaccard similarity (the plain Jaccard
similarity where no shingle repeats). Words are what white space separates, in
lower case.

Defined cases: a text of fewer than five words is one shingle; null, empty and
blank texts are equal to each other and to nothing else; rows with a null id
are members, a class without any id has a null ``class_id``; repeated rows
each give a row; other columns are ignored; an empty table gives an empty
result;
very long texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import build_filter, checkpointed, connected_components, limit_batches, maybe_in, table, text_of, vectorised

QUERY_NAME = "op7_near_dedup"
SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 6
PLACES = BANDS * ROWS
CENTERS = 3
LIKELY = 0.62        # signature agreement from which a center is tried
BLOCK_MEMBERS, BLOCK_SHINGLES = 1000, 1_000_000
LOG2_WORDS = 18
CHUNK_CHARS = 1_000_000
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def weighted_shingles(word_lists: list[list[str]], size: int = SHINGLE):
    """(document, shingle hash, weight), ordered by document and hash."""
    lengths = np.array([len(w) for w in word_lists], "int64")
    flat = [w for ws in word_lists for w in ws]
    if not flat:
        return np.zeros(0, "int64"), np.zeros(0, "uint64"), np.zeros(0)
    codes, uniques = pd.factorize(np.array(flat, dtype=object))
    words = pd.util.hash_array(np.asarray(uniques, dtype=object), categorize=False)[codes]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    n = np.where(lengths == 0, 0, np.maximum(1, lengths - size + 1))
    doc = np.repeat(np.arange(len(lengths)), n)
    first = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + starts[doc]
    end = (starts + lengths)[doc]
    shingle = np.zeros(len(first), "uint64")
    with np.errstate(over="ignore"):
        for k in range(size):
            at = first + k
            word = np.where(at < end, words[np.minimum(at, len(words) - 1)], U(0))
            shingle = mix(shingle * U(0x9E3779B97F4A7C15) + word + U(k + 1))
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])])
    at = np.flatnonzero(new)
    return doc[at], shingle[at], np.diff(np.append(at, len(doc))).astype("float64")


def prob_min_hash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, places: int = PLACES) -> np.ndarray:
    """Signatures (n_docs x places) of weighted sets; places of an empty set
    stay 0."""
    best = np.full(n_docs * places, np.inf)
    owner = np.zeros(n_docs * places, "uint64")
    slowest = np.full(n_docs, np.inf)
    when, step = np.zeros(len(doc)), 0
    with np.errstate(over="ignore"):
        while len(doc):
            step += 1
            r = mix(element + U(step) * U(0x9E3779B97F4A7C15))
            when = when - np.log(((r >> U(11)).astype("float64") + 1.0) * 2.0**-53) / weight
            live = when < slowest[doc]
            doc, element, weight, when, r = doc[live], element[live], weight[live], when[live], r[live]
            place = (mix(r + U(0xD1B54A32D192ED03)) % U(places)).astype("int64") + doc * places
            np.minimum.at(best, place, when)
            won = best[place] == when
            owner[place[won]] = element[won]
            touched = np.unique(doc)
            slowest[touched] = best.reshape(n_docs, places)[touched].max(axis=1)
    return owner.reshape(n_docs, places)


def probability_jaccard(a, wa, b, wb) -> float:
    """Exact probability Jaccard similarity of two weighted sets (ids sorted)."""
    common, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    if wa is None and wb is None:
        return len(common) / (len(a) + len(b) - len(common))
    wa = np.ones(len(a)) if wa is None else np.asarray(wa, "float64")
    wb = np.ones(len(b)) if wb is None else np.asarray(wb, "float64")
    x, y = wa[i], wb[j]
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    x_from = np.append(np.cumsum(x[::-1])[::-1], 0.0)
    y_until = np.concatenate([[0.0], np.cumsum(y)])
    at = np.searchsorted(ratio, ratio, side="left")
    total = (wa.sum() - x.sum() + x_from[at]) / x + (wb.sum() - y.sum() + y_until[at]) / y
    return float((1.0 / total).sum())


def _groups(texts: list[str]):
    """Slices of the batch of about CHUNK_CHARS characters."""
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= CHUNK_CHARS):
            size += len(texts[hi])
            hi += 1
        yield lo, hi
        lo = hi


@vectorised("struct<digest:binary,bands:array<long>,places:array<tinyint>>", frees=True)
def _sign(texts: pd.Series) -> pd.DataFrame:
    values, digests, bands, places = texts.to_list(), [], [], []
    for lo, hi in _groups(values):
        words = [t.lower().split() for t in values[lo:hi]]
        digests += [xxhash.xxh3_128_digest(" ".join(w)) for w in words]
        owner = prob_min_hash(*weighted_shingles(words), len(words))
        key = np.zeros((len(words), BANDS), "uint64")
        with np.errstate(over="ignore"):
            for k in range(ROWS):
                key = mix(key * U(0x9E3779B97F4A7C15) + owner[:, k::ROWS] + np.arange(1, BANDS + 1, dtype="uint64"))
        key, short = key.view("int64"), (owner >> U(56)).astype("uint8").view("int8")
        bands += [row if w else row[:0] for row, w in zip(key, words)]
        places += [row if w else row[:0] for row, w in zip(short, words)]
    return pd.DataFrame({"digest": digests, "bands": bands, "places": places})


@vectorised("struct<shingles:array<long>,weights:array<int>>", frees=True)
def _shingle(texts: pd.Series) -> pd.DataFrame:
    values, out, weights = texts.to_list(), [], []
    for lo, hi in _groups(values):
        doc, element, weight = weighted_shingles([t.lower().split() for t in values[lo:hi]])
        cuts = np.searchsorted(doc, np.arange(hi - lo + 1))
        for k in range(hi - lo):
            out.append(element[cuts[k]:cuts[k + 1]].view("int64"))
            w = weight[cuts[k]:cuts[k + 1]]
            weights.append(None if (w == 1).all() else w.astype("int32"))
    return pd.DataFrame({"shingles": out, "weights": weights})


@vectorised("double")
def _similarity(a: pd.Series, wa: pd.Series, b: pd.Series, wb: pd.Series) -> pd.Series:
    return pd.Series([probability_jaccard(np.asarray(p, "int64").view("uint64"), u, np.asarray(q, "int64").view("uint64"), v)
                      for p, u, q, v in zip(a, wa, b, wb)], dtype="float64")


def _compare(similarity: float):
    """Links between the members of one group that are in different classes;
    of links that join the same classes again, none."""
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("digest").reset_index(drop=True)
        digests, sets = pdf["digest"].tolist(), [np.asarray(x, "int64") for x in pdf["shingles"]]
        weights = [None if w is None else np.asarray(w) for w in pdf["weights"]]
        label = pd.factorize(pdf["c"])[0]
        size = np.array([len(x) for x in sets])
        codes, _ = pd.factorize(np.concatenate(sets))
        owner = np.repeat(np.arange(len(sets)), size)
        order = np.argsort(codes, kind="stable")
        postings, starts = owner[order], np.concatenate([[0], np.cumsum(np.bincount(codes))])
        own = np.concatenate([[0], np.cumsum(size)])
        links = []
        plain = np.array([w is None for w in weights])
        # Members of the largest class need no turn of their own.
        for x in np.flatnonzero(label != np.bincount(label).argmax()):
            mine = codes[own[x]:own[x + 1]]
            common = np.bincount(np.concatenate([postings[starts[k]:starts[k + 1]] for k in mine]), minlength=len(sets))
            alike = common / (size[x] + size - common)
            maybe = (label != label[x]) & (common > 0) & ((alike >= similarity) | ~plain | (not plain[x]))
            for y in np.flatnonzero(maybe):
                if label[y] == label[x]:
                    continue
                if plain[x] and plain[y]:
                    near = alike[y]
                else:
                    near = probability_jaccard(sets[x].view("uint64"), weights[x], sets[y].view("uint64"), weights[y])
                if near >= similarity:
                    links.append((min(digests[x], digests[y]), max(digests[x], digests[y])))
                    label[label == label[y]] = label[x]
        return pd.DataFrame(links, columns=["a", "b"])
    return compare


def _agreement(a, b):
    """Share of equal places; of each place one byte is kept, so unlike places
    seem equal once in 256."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(PLACES))


class _Corpus:
    """The distinct texts of a table and how to compare them."""

    def __init__(self, docs: DataFrame, log2_words: int):
        self.base = docs.withColumn("text_hash", F.xxhash64("text"))
        signed = self.base.select("id", "text_hash", _sign("text").alias("s"))
        self.signed = checkpointed(signed.select("id", "text_hash", "s.digest", "s.bands", "s.places"))
        one = F.min(F.struct("text_hash", "id")).alias("one")
        self.texts = self.signed.groupBy("digest").agg(one, F.first("bands").alias("bands"), F.first("places").alias("places"))
        self.log2_words = log2_words

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose signatures agree enough to try them first."""
        of = self.texts.select("digest", "places")
        x = of.select(F.col("digest").alias("a"), F.col("places").alias("pa"))
        y = of.select(F.col("digest").alias("b"), F.col("places").alias("pb"))
        return pairs.join(y, "b").join(x, "a").where(_agreement("pa", "pb") >= LIKELY).select("a", "b")

    def sets(self, members: DataFrame) -> DataFrame:
        """(digest, shingles, weights) of the given digests, from their texts:
        a bit filter keeps all other texts from being shuffled."""
        wanted = checkpointed(members.join(self.texts.select("digest", "one"), "digest").select("digest", "one.*"))
        words = build_filter(wanted, "text_hash", self.log2_words)
        rows = maybe_in(self.base, F.col("text_hash"), words, self.log2_words, "wanted").where("wanted")
        same = wanted["text_hash"].eqNullSafe(rows["text_hash"]) & wanted["id"].eqNullSafe(rows["id"])
        texts = rows.join(wanted, same).select("digest", "text").dropDuplicates(["digest"])
        return checkpointed(texts.select("digest", _shingle("text").alias("s")).select("digest", "s.*"))

    @staticmethod
    def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
        """The pairs that are at least so similar."""
        left = sets.select(F.col("digest").alias("l"), F.col("shingles").alias("sl"), F.col("weights").alias("wl"))
        right = sets.select(F.col("digest").alias("r"), F.col("shingles").alias("sr"), F.col("weights").alias("wr"))
        both = pairs.select(F.col("a").alias("l"), F.col("b").alias("r")).join(right, "r").join(left, "l")
        scored = both.select(F.col("l").alias("a"), F.col("r").alias("b"), _similarity("sl", "wl", "sr", "wr").alias("similarity"))
        return checkpointed(scored.where(F.col("similarity") >= similarity).select("a", "b"))

    def classes(self, similarity: float) -> DataFrame:
        """(digest, class) of every text that is linked to another one."""
        rows = self.texts.select("digest", F.explode("bands").alias("band"))
        picks = F.array(*[F.min_by("digest", F.xxhash64("digest", F.lit(k))) for k in range(CENTERS)])
        bands = rows.groupBy("band").agg(F.count("*").alias("n"), F.array_distinct(picks).alias("centers")).where("n > 1")
        members = checkpointed(rows.join(bands.select("band", "centers"), "band"))
        stars = members.select("digest", F.explode("centers").alias("center")).where("digest <> center") \
            .select(F.least("digest", "center").alias("a"), F.greatest("digest", "center").alias("b")).distinct()
        stars = checkpointed(self.likely(stars))
        ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct()
        sets = self.sets(ends(stars))
        links = self.verified(stars, sets, similarity)
        found = connected_components(links)
        # What one band still holds in different classes is compared in blocks.
        placed = members.select("band", "digest").join(found.withColumnRenamed("node", "digest"), "digest", "left") \
            .select("band", "digest", F.coalesce("component", "digest").alias("c"))
        split = placed.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("band")
        open_ = checkpointed(placed.join(split, "band"))
        new = open_.select("digest").distinct().join(sets.select("digest"), "digest", "left_anti")
        sets = sets.union(self.sets(new))
        sized = open_.join(sets.select("digest", F.size("shingles").alias("n")), "digest").groupBy("band") \
            .agg(F.greatest(F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
        spread = open_.join(sized, "band").withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
        spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        spread = spread.select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "digest", "c").join(sets, "digest")
        more = checkpointed(spread.groupBy("band", "i", "j").applyInPandas(_compare(similarity), "a binary, b binary").distinct())
        if not more.isEmpty():
            # Components of components: the links join what was found before.
            lift = lambda c: F.coalesce(F.col(f"at_{c}.component"), F.col(c)).alias(c)
            upper = more.join(found.alias("at_a"), F.col("a") == F.col("at_a.node"), "left") \
                .join(found.alias("at_b"), F.col("b") == F.col("at_b.node"), "left").select(lift("a"), lift("b"))
            joined = connected_components(upper).select(F.col("node").alias("component"), F.col("component").alias("top"))
            nodes = found.union(ends(more).select(F.col("digest").alias("node"), F.col("digest").alias("component"))
                                .join(found.select("node"), "node", "left_anti"))
            found = nodes.join(joined, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
        return found.withColumnRenamed("node", "digest").withColumnRenamed("component", "class")


def _classes(docs: DataFrame, id_col: str, text_col: str, similarity: float, log2_words: int):
    """The rows (id, text_hash, n, digest, class) of a table, equal ones
    counted, and the sums of each class."""
    limit_batches(docs.sparkSession)
    base = docs.select(docs[id_col].alias("id"), text_of(docs[text_col]).alias("text"))
    corpus = _Corpus(base, log2_words)
    classes = checkpointed(corpus.classes(similarity))
    counted = corpus.signed.groupBy("digest", "id", "text_hash").agg(F.count("*").alias("n"))
    counted = counted.join(classes, "digest", "left").select("id", "text_hash", "n", F.coalesce("class", "digest").alias("class"))
    sums = counted.groupBy("class").agg(F.min("id").alias("class_id"), F.sum("n").alias("class_size"),
                                        F.min(F.struct(F.col("id").isNull(), "id", "text_hash")).alias("first"))
    return counted, sums


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY, log2_words: int = LOG2_WORDS) -> DataFrame:
    """One row per input row: ``doc_id, class_id`` (smallest id of its class),
    ``class_size`` and ``kept`` (true for one row of each class)."""
    counted, sums = _classes(docs, id_col, text_col, similarity, log2_words)
    first = F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.text_hash") == F.col("text_hash")) & (F.col("copy") == 1)
    return counted.join(sums, "class").select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")) \
        .select(F.col("id").alias("doc_id"), "class_id", "class_size", first.alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             similarity: float = SIMILARITY, log2_words: int = LOG2_WORDS) -> DataFrame:
    """The rows of ``docs``, all columns as they were, one of each class: the
    one with the smallest id."""
    _, sums = _classes(docs, id_col, text_col, similarity, log2_words)
    key = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    chosen = sums.select(key(F.col("first.id")).alias("__chosen_id"), F.col("first.text_hash").alias("__chosen_hash"))
    marked = docs.withColumns({"__row_id": key(docs[id_col]), "__row_hash": F.xxhash64(text_of(docs[text_col]))})
    kept = marked.join(chosen, (F.col("__row_id") == F.col("__chosen_id")) & (F.col("__row_hash") == F.col("__chosen_hash")))
    # A row that stands in the table several times is kept once.
    copy = F.row_number().over(Window.partitionBy("__row_id", "__row_hash").orderBy("__row_hash"))
    return kept.withColumn("__copy", copy).where("__copy = 1").select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE_SQL = None
