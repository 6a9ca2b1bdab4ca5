"""Language identification by rank-order profiles.

A profile is the ``PROFILE`` most frequent letter n-grams (one to three
characters, a word's edges as a blank), most frequent first, ties by the
characters' numbers.  A document gets the language whose profile is nearest
by out-of-place distance: the sum of rank differences, ``PROFILE`` for an
n-gram that the language's profile lacks.

Training counts cover all training texts: tasks add up their n-grams by
language before the shuffle.  Only the profiles, a few hundred n-grams a
language, reach the driver and the tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopflow.llm.common import fold, texts
from shopflow.llm.gather import slices

PROFILE = 300
LONGEST = 3
BLANK = 1    # no letter, and not 0: " a" and "a" are two n-grams
FOLDS, HELD_OUT = 5, 0
_HELD = 400_000  # n-grams a task holds before it hands on partial counts


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str) -> np.ndarray:
    """All n-grams of a text, as numbers (21 bits a character)."""
    cp = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    cp[~_letters()[cp]] = BLANK
    cp = cp[np.concatenate(([True], (cp[1:] != BLANK) | (cp[:-1] != BLANK)))]
    out, key = [cp[cp != BLANK]], cp
    for n in range(2, LONGEST + 1):
        key = (key[:-1] << 21) | cp[n - 1:]
        out.append(key)
    return np.concatenate(out)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def flush():
        rows = list(held.items())
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.int64()),
             pa.array([n for _, n in rows], pa.int64())], names=["lang", "gram", "n"])
    for b in slices(batches):
        by: dict[str, list] = {}
        for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
            by.setdefault(lang, []).append(grams(text))
        for lang, parts in by.items():
            key, n = np.unique(np.concatenate(parts), return_counts=True)
            for k, c in zip(key.tolist(), n.tolist(), strict=True):
                held[lang, k] += c
        if len(held) > _HELD:
            yield flush()
    if held:
        yield flush()


def profiles(docs: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """The n-grams of each language's profile, by rank."""
    train = texts(docs.where(F.col("lang").isNotNull()), "lang")
    counts = train.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size).collect()
    out: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


def predict(docs: DataFrame, known: dict[str, list[int]], size: int = PROFILE) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (1 - distance / largest possible
    distance).  ``und`` with score 0 where there is no letter."""
    langs = sorted(known)
    every = np.array(sorted({g for p in known.values() for g in p}), np.int64)
    rank = np.full((len(every) + 1, len(langs)), -1, np.int64)  # the last row: in no profile
    for k, lang in enumerate(langs):
        rank[np.searchsorted(every, np.array(known[lang], np.int64)), k] = np.arange(len(known[lang]))

    def one(text: str) -> tuple[str, float]:
        key, n = np.unique(grams(text), return_counts=True)
        key = key[np.argsort(-n, kind="stable")[:size]]
        if not len(key) or not langs:
            return "und", 0.0
        at = np.minimum(np.searchsorted(every, key), len(every) - 1)
        r = rank[np.where(every[at] == key, at, len(every))]
        far = np.where(r < 0, size, np.abs(r - np.arange(len(key))[:, None])).sum(axis=0)
        k = int(np.argmin(far))  # of equals the first by name
        return langs[k], 1.0 - float(far[k]) / (size * len(key))

    def run(batches):
        for b in slices(batches):
            got = [one(t) if any(map(str.isalpha, t)) else ("und", 0.0) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=["doc_id", "lang_pred", "score"])
    return texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_id(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Learn from the rows outside the held-out fold, predict every row.

    A null or letterless text is ``und``; rows without a language are not
    learned from; a null doc_id belongs to no fold, so it is neither learned
    from nor held out; repeated rows count and are predicted each; without
    any training row all are ``und``.  Very long texts are read whole.  Ties:
    n-grams of one frequency rank by their code points, and of languages at
    one distance the first by name is taken.  Other columns, whatever their
    names, are not read.  An empty table gives an empty result.
    """
    learn = docs.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    out = predict(docs, profiles(learn))
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")
