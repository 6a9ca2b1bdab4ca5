"""Toxicity by weak supervision.

Voters: lexicons of words and of word beginnings (4 to 6 letters), mined
from all labelled training rows and dealt to several voters each, and
patterns of how the hits lie in the text.  A voter says toxic, clean or
nothing.  A lexicon too large to be sent to every task is joined instead.  A generative label model is fitted to the votes on all
training documents (their distinct vote vectors with counts): it estimates
each voter's accuracy without labels, and the correlations of the voters
given the label, by which the votes of correlated voters are scaled down.
Its posterior labels train a linear classifier (logistic regression) on the
voters' hit counts; that classifier gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm.common import fold, saved, texts
from shopflow.llm.gather import slices

FOLDS, HELD_OUT = 5, 0
# Labelled training rows that the classifier is fitted on, at most: those
# with the smallest hash of the id.
SAMPLE = 20_000
# Labels, and lexicons with so many bytes an entry besides the term, that are
# smaller (measured) are broadcast; larger ones are joined by shuffle.
BROADCAST_BYTES = 48 << 20
ENTRY_BYTES = 150
HELD = 300_000       # counts a task holds before it hands them on
LEAST = 3            # toxic texts an entry must occur in
ODDS = 3.0           # log odds an entry must have
DEALT = 4            # voters per lexicon
KINDS = ("word", 4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def _terms(words: list[str]):
    """Per kind, the terms of a text in order."""
    yield words
    for n in KINDS[1:]:
        yield [w[:n] for w in words if len(w) > n]


@dataclass
class Voters:
    """Lexicons (term to voter) per kind; ``look`` gives a text's features."""

    lexicons: list[dict[str, int]] = field(default_factory=list)

    @property
    def count(self) -> int:
        return DEALT * len(KINDS) + 3

    def look(self, text: str, given: list[tuple[int, int, int]] | None = None) -> tuple[list[float], list[int]]:
        """Features (hits per voter, dampened; totals) and votes.  ``given``:
        the hits (kind, place, voter), where the lexicons were joined."""
        words = _WORD.findall(text.lower())
        if given is None:
            given = [(k, i, lex[t]) for k, (lex, terms) in enumerate(zip(self.lexicons, _terms(words), strict=True))
                     for i, t in enumerate(terms) if t in lex]
        hits = [0] * (DEALT * len(KINDS))
        places: set[int] = set()
        for k, i, v in given:
            hits[DEALT * k + v] += 1
            if k == 0:
                places.add(i)
        total, n = sum(hits), max(len(words), 1)
        near = sorted(places)
        close = any(b - a <= 20 for a, b in zip(near, near[1:]))
        votes = [1 if h else 0 for h in hits] + [
            1 if total >= 2 else -1,                      # hits at all
            1 if close else 0,                            # two hits close by
            -1 if total == 0 else (1 if 200 * total >= n else 0)]  # hits for the length
        feats = [math.log1p(min(h, 20)) for h in hits] + [
            math.log1p(min(total, 50)), math.log1p(100 * total / n), float(total == 0), float(total == 1),
            float(close), float(sum(h > 0 for h in hits))]
        return feats, votes

    def look_all(self, batch: pa.RecordBatch) -> list[tuple[list[float], list[int]]]:
        column = batch.column("text").to_pylist()
        if "hits" not in batch.schema.names:
            return [self.look(t) for t in column]
        given = batch.column("hits").to_pylist()
        return [self.look(t, [(h["kind"], h["place"], h["voter"]) for h in g or ()])
                for t, g in zip(column, given, strict=True)]


def train_ids(labels: DataFrame) -> DataFrame:
    """``doc_id``, ``toxic`` of the labelled training rows."""
    return (labels.where("toxic is not null and doc_id is not null")
            .where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))


def labelled(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``text``, ``toxic`` and, where there, ``hits`` of the rows with ``ids``."""
    small = 16 * ids.count() <= BROADCAST_BYTES
    return docs.join(F.broadcast(ids) if small else ids, "doc_id").drop("doc_id")


def mine(rows: DataFrame) -> tuple[Voters, DataFrame | None]:
    """Lexicons of terms that are far likelier in toxic texts, counted in all
    ``rows``; those too large to broadcast as a table ``kind``, ``term``,
    ``voter``."""
    def run(batches):
        held: Counter = Counter()

        def flush():
            got = list(held.items())
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0][0] for r in got], pa.int32()), pa.array([r[0][1] for r in got], pa.string()),
                 pa.array([r[1] if r[0][2] else 0 for r in got], pa.int64()),
                 pa.array([0 if r[0][2] else r[1] for r in got], pa.int64())], names=["kind", "term", "bad", "good"])
        for b in slices(batches):
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                words = _WORD.findall(text.lower())
                for k, terms in enumerate(_terms(words)):
                    held.update((k, t, toxic == 1) for t in set(terms))
                held[-1, "", toxic == 1] += 1
            if len(held) > HELD:
                yield flush()
        if held:
            yield flush()
    counts = (rows.select("text", "toxic").mapInArrow(run, "kind int, term string, bad long, good long")
              .groupBy("kind", "term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")))
    counts = saved(counts.where(f"kind = -1 or bad >= {LEAST}"), "toxic-terms")  # the texts are gone through once
    total = counts.where("kind = -1").collect()
    bad, good = (total[0]["bad"], total[0]["good"]) if total else (0, 0)
    odds = (F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0)))
    found = counts.where("kind >= 0").withColumn("odds", odds).where(F.col("odds") >= ODDS)
    sizes = {r["kind"]: r for r in found.groupBy("kind").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("term") + ENTRY_BYTES).alias("size")).collect()}
    ranked = found.orderBy("kind", F.desc("odds"), "term").select("kind", "term")
    if sum(r["size"] for r in sizes.values()) <= BROADCAST_BYTES:
        out: list[dict[str, int]] = [{} for _ in KINDS]
        for r in ranked.collect():
            out[r["kind"]][r["term"]] = len(out[r["kind"]]) % DEALT
        return Voters(out), None
    before = [sum(r["n"] for k, r in sizes.items() if k < kind) for kind in range(len(KINDS))]
    dealt = ranked.rdd.zipWithIndex().map(lambda x: (x[0]["kind"], x[0]["term"], (x[1] - before[x[0]["kind"]]) % DEALT))
    table = rows.sparkSession.createDataFrame(dealt, "kind int, term string, voter int")
    return Voters([{} for _ in KINDS]), saved(table, "toxic-lexicon")


def with_hits(docs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``hits`` (kind, place, voter): equal texts are
    looked up once."""
    def run(batches):
        for b in slices(batches):
            cols: list[list] = [[], [], [], []]
            for key, text in zip(b.column("sha").to_pylist(), b.column("text").to_pylist(), strict=True):
                for k, terms in enumerate(_terms(_WORD.findall(text.lower()))):
                    places: dict[str, list[int]] = {}
                    for i, t in enumerate(terms):
                        places.setdefault(t, []).append(i)
                    cols[0] += [key] * len(places)
                    cols[1] += [k] * len(places)
                    cols[2] += places
                    cols[3] += places.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.list_(pa.int32()))], names=["sha", "kind", "term", "places"])
    keyed = docs.withColumn("sha", F.sha2("text", 256))
    terms = keyed.dropDuplicates(["sha"]).select("sha", "text").mapInArrow(
        run, "sha string, kind int, term string, places array<int>")
    hits = (terms.join(lexicon, ["kind", "term"]).select("sha", "kind", F.explode("places").alias("place"), "voter")
            .groupBy("sha").agg(F.collect_list(F.struct("kind", "place", "voter")).alias("hits")))
    return saved(keyed.join(hits, "sha", "left").drop("sha"), "toxic-hits")


def vote_counts(docs: DataFrame, voters: Voters) -> tuple[np.ndarray, np.ndarray]:
    """Distinct vote vectors over all rows of ``docs``, with their counts.
    The vectors, not the documents, are what reaches the driver."""
    def run(batches):
        for b in slices(batches):
            held = Counter("".join("-0+"[v + 1] for v in votes) for _, votes in voters.look_all(b))
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                             names=["votes", "n"])
    rows = docs.mapInArrow(run, "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    rows = sorted(rows, key=lambda r: r["votes"])
    votes = np.array([["-0+".index(c) - 1 for c in r["votes"]] for r in rows], np.int64).reshape(len(rows), voters.count)
    return votes, np.array([r["n"] for r in rows], float)


@dataclass
class LabelModel:
    """Votes are independent given the label but for a scaling by their
    correlations; ``table[j, y, v + 1]`` is p(vote v of voter j | label y)."""

    table: np.ndarray
    prior: float
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        if not len(votes):
            return np.zeros(0)
        j = np.arange(votes.shape[1])
        ratio = np.log(self.table[j, 1, votes + 1]) - np.log(self.table[j, 0, votes + 1])
        z = math.log(self.prior / (1 - self.prior)) + ratio @ self.weight
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_label_model(votes: np.ndarray, n: np.ndarray, prior: float, rounds: int = 30) -> LabelModel:
    """Expectation maximisation from the majority of the votes cast."""
    m = votes.shape[1]
    cast = votes.sum(axis=1)
    p = np.where(cast > 0, 0.9, 0.02).astype(float)
    model = LabelModel(np.full((m, 2, 3), 1 / 3), prior, np.full(m, 1.0 / m))
    for _ in range(rounds if len(votes) else 0):
        mass = np.stack([n * (1 - p), n * p])
        for v in (-1, 0, 1):
            model.table[:, :, v + 1] = (mass @ (votes == v)).T + 0.5
        model.table /= model.table.sum(axis=2, keepdims=True)
        # correlations of the voters given the label
        corr = np.zeros((m, m))
        for y in (0, 1):
            w = mass[y] / max(mass[y].sum(), 1e-9)
            c = (votes - w @ votes) * np.sqrt(w)[:, None]
            cov = c.T @ c
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
            corr += 0.5 * np.abs(cov / np.outer(sd, sd))
        np.fill_diagonal(corr, 0.0)
        model.weight = 1 / (1 + corr.sum(axis=1))
        p = model.posterior(votes)
    return model


def fit_classifier(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; last entry: bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every row: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Null or empty texts have no hits and get the score of such texts; rows
    with a null doc_id are scored and never learned from; a label given
    twice counts as toxic if either is; without labels or rows the lexicons
    are empty and all scores are equal and below one half.  Repeated rows are
    scored each and alike.  Very long texts are read whole.  Ties do not
    arise: a score of exactly one half counts as toxic.  Other columns,
    whatever their names, are not read.
    """
    ids = train_ids(labels)
    rows = texts(docs)
    voters, lexicon = mine(labelled(rows, ids))
    if lexicon is not None:
        rows = with_hits(rows, lexicon)
    sample = labelled(rows, ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE))
    train = rows.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    votes, n = vote_counts(train, voters)
    rate = labels.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT).agg(F.avg("toxic")).first()[0]
    model = fit_label_model(votes, n, min(max(rate or 0.05, 0.01), 0.5))

    def features(batches):
        for b in slices(batches):
            got = voters.look_all(b)
            y = model.posterior(np.array([g[1] for g in got], np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.list_(pa.float64())), pa.array(y)],
                                             names=["x", "y"])
    fitted = sorted(sample.mapInArrow(features, "x array<double>, y double").collect(), key=lambda r: (r["x"], r["y"]))
    w = fit_classifier(np.array([r["x"] for r in fitted]), np.array([r["y"] for r in fitted])) if fitted else None

    def score(batches):
        for b in slices(batches):
            feats = np.array([x for x, _ in voters.look_all(b)])
            z = feats @ w[:-1] + w[-1] if w is not None else np.full(len(feats), -3.0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))],
                                             names=["doc_id", "score"])
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return rows.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
