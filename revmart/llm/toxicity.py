"""Toxicity by weak supervision.

Voters are lexicons and patterns. The lexicons are mined from a bounded sample
of labelled training rows: words and word beginnings that toxic rows hold and
clean rows hardly do, dealt into folds so that each fold is a voter; further
voters look at how many entries a text hits, how dense they are, at shouting
and at piled-up punctuation. What the voters say about every training
document, labelled or not, is counted by vote pattern (at most 2**VOTERS
rows). A generative label model estimates from these counts, by expectation
maximisation, each voter's accuracy in either class and its correlation with
one other voter (a spanning tree of the strongest dependencies given the
class); labelled rows hold the two classes in place. A linear classifier is
then trained on the posterior labels of a bounded sample.

Only text is ever scored: labels, language, source and id are no inputs.

Defined cases: null and empty texts hit nothing and get the score of such a
text; very long texts are read whole; a label row with a null id or a label
other than 0 and 1 is ignored, of several labels of one
id the larger one counts; without usable labels the lexicons are empty and
every score is the same; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, crc_bucket, table, text_of, vectorised

QUERY_NAME = "op1_toxicity"
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
LABELLED_ROWS = 20_000    # labelled rows that lexicons are mined from
FIT_ROWS = 40_000         # rows the classifier is fitted on
LEXICON = 1024            # entries
MIN_PRECISION = 0.85
MIN_EVIDENCE = 3.6        # -log10 of the chance that clean rows alone would look so
PREFIX = (3, 4, 5, 6, 7, 8)  # lengths of word beginnings
HEAD = 3
WORD_FOLDS, PREFIX_FOLDS = 4, 4
VOTERS = WORD_FOLDS + PREFIX_FOLDS + 4
FACTS = "struct<hits:array<int>,words:int,shout:boolean,marks:int>"
WORD = re.compile(r"[^\W\d_]+")
MARKS = re.compile(r"[!?]{2,}")


def entries_of(word: str):
    """The lexicon entries a word could be: itself and its beginnings."""
    yield "=" + word
    for n in PREFIX:
        if len(word) > n:
            yield "^" + word[:n]


def mine(batches):
    """(entry, toxic rows, clean rows) of a batch of labelled texts."""
    for pdf in batches:
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(pdf["text"], pdf["toxic"]):
            found = {e for w in set(WORD.findall(text.lower())) if len(w) >= HEAD for e in entries_of(w)}
            for e in found:
                counts.setdefault(e, [0, 0])[toxic] += 1
        yield pd.DataFrame({"entry": list(counts), "toxic": [c[1] for c in counts.values()], "clean": [c[0] for c in counts.values()]})


@dataclass
class LabelModel:
    """Two classes, binary voters, each depending on the class and on at most
    one other voter."""

    prior: float = 0.5
    parent: list = field(default_factory=list)
    # table[j, class, parent's vote]: probability that voter j fires
    table: np.ndarray = field(default_factory=lambda: np.zeros((0, 2, 2)))
    accuracy: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        log = np.tile(np.log([1 - self.prior, self.prior]), (len(votes), 1))
        for j, p in enumerate(self.parent):
            other = votes[:, p] if p >= 0 else np.zeros(len(votes), int)
            for y in (0, 1):
                fire = self.table[j, y, other]
                log[:, y] += np.log(np.where(votes[:, j] == 1, fire, 1 - fire))
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))

    def fit(self, votes: np.ndarray, counts: np.ndarray, toxic: np.ndarray, clean: np.ndarray, rounds: int = 60) -> "LabelModel":
        """``counts`` rows show each vote pattern; ``toxic`` and ``clean`` of
        them are labelled so."""
        m = votes.shape[1]
        free = np.maximum(counts - toxic - clean, 0)
        self.prior = float((toxic.sum() + 1) / (toxic.sum() + clean.sum() + 2))
        q = 1 / (1 + np.exp(2 - 2.0 * votes.sum(axis=1)))
        self.parent = [-1] * m
        for step in range(rounds):
            weight = np.stack([free * (1 - q) + clean, free * q + toxic])
            if step == 10:
                self.parent = self._tree(votes, weight)
            total = weight.sum(axis=1)
            self.accuracy = np.stack([(weight @ votes + 0.5)[y] / (total[y] + 1) for y in (0, 1)], axis=1)
            self.table = np.empty((m, 2, 2))
            for j, p in enumerate(self.parent):
                for y in (0, 1):
                    for v in (0, 1):
                        of = weight[y] * (votes[:, p] == v) if p >= 0 else weight[y]
                        base = self.accuracy[j, y]
                        self.table[j, y, v] = ((of * votes[:, j]).sum() + 2 * base) / (of.sum() + 2)
            self.table = np.clip(self.table, 1e-6, 1 - 1e-6)
            self.prior = float((weight[1].sum() + 1) / (weight.sum() + 2))
            q = self.posterior(votes)
        return self

    @staticmethod
    def _tree(votes: np.ndarray, weight: np.ndarray) -> list[int]:
        """Parents in a maximum spanning tree of the voters' mutual
        information given the class."""
        m, total = votes.shape[1], weight.sum()
        gain = np.zeros((m, m))
        for y in (0, 1):
            n = weight[y].sum() + 4
            one = (weight[y] @ votes + 2) / n
            both = ((votes * weight[y][:, None]).T @ votes + 1) / n
            for a in (0, 1):
                for b in (0, 1):
                    pa, pb = (one if a else 1 - one), (one if b else 1 - one)
                    joint = both if a and b else one[:, None] - both if a else one[None, :] - both if b else 1 - one[:, None] - one[None, :] + both
                    joint = np.clip(joint, 1e-12, 1)
                    gain += n / total * joint * np.log(joint / np.clip(pa[:, None] * pb[None, :], 1e-12, 1))
        parent, inside = [-1] * m, {0}
        while len(inside) < m:
            _, p, j = max((gain[p, j], p, j) for p in inside for j in range(m) if j not in inside)
            parent[j] = p
            inside.add(j)
        return parent


@dataclass
class Model:
    entries: list = field(default_factory=list)
    label_model: LabelModel = field(default_factory=LabelModel)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def reader(self):
        """Function: texts -> facts (hit entries, words, shouting, marks)."""
        number = {e: k for k, e in enumerate(self.entries)}
        heads = {e[1:1 + HEAD] for e in self.entries}

        def read(texts):
            rows = []
            for t in texts:
                words = WORD.findall(t.lower())
                hits = {number[e] for w in set(words) if w[:HEAD] in heads for e in entries_of(w) if e in number}
                rows.append((sorted(hits), len(words), t.isupper(), len(MARKS.findall(t))))
            return pd.DataFrame(rows, columns=["hits", "words", "shout", "marks"])
        return read

    def voter_of(self) -> np.ndarray:
        return np.array([zlib.crc32(e.encode()) % WORD_FOLDS if e[0] == "=" else WORD_FOLDS + zlib.crc32(e.encode()) % PREFIX_FOLDS
                         for e in self.entries], int)

    def voter(self):
        """Function: facts -> vote pattern, one bit a voter."""
        fold, plain = self.voter_of(), np.array([e[0] == "=" for e in self.entries], bool)

        def vote(facts):
            out = []
            for hits, words, shout, marks in zip(facts["hits"], facts["words"], facts["shout"], facts["marks"]):
                mask = 0
                for h in hits:
                    mask |= 1 << int(fold[h])
                n = sum(bool(plain[h]) for h in hits)
                for k, fires in enumerate((n >= 2, n > 0 and 100 * n >= words, shout, marks >= 3)):
                    mask |= int(fires) << (WORD_FOLDS + PREFIX_FOLDS + k)
                out.append(mask)
            return pd.Series(out, dtype="int32")
        return vote

    def n_features(self) -> int:
        return len(self.entries) + 6

    def sparse(self, facts):
        """(row, feature, value) of the classifier's inputs."""
        n = len(self.entries)
        row, col, val = [], [], []
        for k, (hits, words, shout, marks) in enumerate(zip(facts["hits"], facts["words"], facts["shout"], facts["marks"])):
            more = [1.0, float(len(hits) > 0), math.log1p(len(hits)), len(hits) / (words + 10.0), float(shout), min(1.0, marks / 10)]
            col += [int(h) for h in hits] + list(range(n, n + 6))
            val += [1.0] * len(hits) + more
            row += [k] * (len(hits) + 6)
        return np.array(row, int), np.array(col, int), np.array(val)

    def scorer(self):
        def score(facts):
            row, col, val = self.sparse(facts)
            z = np.bincount(row, self.weights[col] * val, len(facts)) if len(row) else np.zeros(len(facts))
            return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return score

    def fit_classifier(self, facts: pd.DataFrame, target: np.ndarray, penalty: float = 0.02, rounds: int = 400) -> None:
        """Logistic regression on soft labels: gradient steps scaled by
        feature, momentum, a ridge penalty on all but the bias."""
        self.weights = np.zeros(self.n_features())
        if not len(facts):
            return
        row, col, val = self.sparse(facts)
        n, bias = len(facts), len(self.entries)
        scale = np.bincount(col, val * val, len(self.weights)) / 4 + penalty + 1e-3
        ridge = np.full(len(self.weights), penalty)
        ridge[bias] = 0.0
        per_row = max(1.0, np.bincount(row, minlength=n).mean())
        speed = np.zeros(len(self.weights))
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(np.bincount(row, self.weights[col] * val, n), -30, 30)))
            grad = np.bincount(col, (p - target)[row] * val, len(self.weights)) + ridge * self.weights
            speed = 0.9 * speed - grad / scale / per_row
            self.weights = self.weights + speed


def facts_column(model: Model):
    read = model.reader()

    @vectorised(FACTS, frees=True)
    def facts(texts: pd.Series) -> pd.DataFrame:
        return read(texts)
    return facts


def mine_lexicon(labelled: DataFrame) -> list[str]:
    """At most LEXICON entries from (text, toxic) rows: precise ones that toxic
    rows hold more often than chance would have it."""
    share = labelled.agg(F.avg("toxic").alias("p")).first()["p"]
    if not share or share >= 1:
        return []
    counts = labelled.select("text", "toxic").mapInPandas(mine, "entry string, toxic long, clean long") \
        .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    sure = (F.col("toxic") * -math.log10(share) >= MIN_EVIDENCE) & (F.col("toxic") >= MIN_PRECISION * (F.col("toxic") + F.col("clean")))
    best = counts.where(sure).orderBy(F.col("toxic").desc(), F.col("clean"), "entry").limit(LEXICON)
    return sorted(r["entry"] for r in best.collect())


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> tuple[Model, DataFrame]:
    """The model, and (doc_id, held_out, facts) of all rows. Rows whose id's
    crc32 is HELD_OUT modulo FOLDS are held out: nothing is learnt from them."""
    base = docs.select(docs[id_col].alias("doc_id"), (crc_bucket(docs[id_col], FOLDS) == HELD_OUT).alias("held_out"), text_of(docs[text_col]).alias("text"))
    marks = labels.select(labels[id_col].alias("id"), labels[label_col].try_cast("int").alias("toxic")).where("id is not null and toxic in (0, 1)") \
        .groupBy("id").agg(F.max("toxic").alias("toxic")).where(crc_bucket(F.col("id"), FOLDS) != HELD_OUT)
    marks = checkpointed(marks)
    # A bounded sample: the rows whose hashed ids come first.
    some = F.broadcast(marks.orderBy(F.xxhash64("id"), "id").limit(LABELLED_ROWS))
    model = Model(mine_lexicon(base.join(some, base["doc_id"] == some["id"]).select("text", "toxic")))

    facts = checkpointed(base.select("doc_id", "held_out", facts_column(model)("text").alias("f")).select("doc_id", "held_out", "f.*"))
    vote = model.voter()

    @vectorised("int")
    def votes(hits: pd.Series, words: pd.Series, shout: pd.Series, marks: pd.Series) -> pd.Series:
        return vote({"hits": hits, "words": words, "shout": shout, "marks": marks})
    training = facts.where(~F.col("held_out")).withColumn("votes", votes("hits", "words", "shout", "marks"))
    known = training.select("doc_id", "votes").join(marks, F.col("doc_id") == F.col("id"), "left")
    seen = known.groupBy("votes").agg(F.count("*").alias("n"), F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean")) \
        .orderBy("votes").toPandas()  # at most 2**VOTERS rows
    bits = lambda v: (np.asarray(v, "int64")[:, None] >> np.arange(VOTERS)) & 1
    if len(seen):
        model.label_model.fit(bits(seen["votes"]), *(seen[c].to_numpy("float64") for c in ("n", "toxic", "clean")))
    sample = training.select("hits", "words", "shout", "marks", "votes").orderBy(F.xxhash64("doc_id"), F.xxhash64("hits", "words")).limit(FIT_ROWS).toPandas()
    model.fit_classifier(sample, model.label_model.posterior(bits(sample["votes"])) if len(sample) else np.zeros(0))
    return model, facts


def scores(model: Model, facts: DataFrame) -> DataFrame:
    score = model.scorer()

    @vectorised("double")
    def of_facts(hits: pd.Series, words: pd.Series, shout: pd.Series, marks: pd.Series) -> pd.Series:
        return score(pd.DataFrame({"hits": hits, "words": words, "shout": shout, "marks": marks}))
    return facts.select("doc_id", "held_out", of_facts("hits", "words", "shout", "marks").alias("score"))


def score_column(model: Model, text):
    """Score of a text column, in place."""
    read, score = model.reader(), model.scorer()

    @vectorised("double", frees=True)
    def of_text(texts: pd.Series) -> pd.Series:
        return score(read(texts))
    return of_text(text_of(text))


def query(spark, sf_dir: str) -> DataFrame:
    model, facts = fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores(model, facts).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


ORACLE_SQL = None
