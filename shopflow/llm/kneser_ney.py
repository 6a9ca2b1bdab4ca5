"""Interpolated modified Kneser-Ney bigram model.

Counting runs in Spark: tasks hash words, add up their bigrams and hand the
sums, packed by left word, to one bucket each; a bucket adds them, writes
its sorted arrays (bigram hashes with counts, contexts with their totals)
and hands the right words' totals to a second set of buckets, which write
the sorted word arrays.  The arrays lie in the shared checkpoint folder and
scoring tasks memory-map them, so a worker holds no copy of the model.

The checkpoint folder must be one that every machine mounts (a ``file:``
location): memory-mapping works on nothing else.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm.common import fold, saved, shuffle_parts, texts
from shopflow.llm.gather import cut, pack, slices, unpack
from shopflow.session import work_dir

FOLDS, HELD_OUT = 7, 2
START, END = np.uint64(1), np.uint64(2)  # no word has these hashes
COUNT_TOKENS = 3_000_000  # tokens a task adds up at a time
_MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out() -> Column:
    return F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))


def tokens(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, the end after each, and the number
    of tokens per text.  As bytes, a text is cut at the six ASCII white-space
    characters and only A-Z change case."""
    words = [t.encode().lower().split() for t in batch]
    n = np.fromiter(map(len, words), np.int64, len(words))
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, int(n.sum()))
    return np.insert(np.maximum(h, 3), np.cumsum(n), END), n + 1


def contexts(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The token before each token; the start before a text's first."""
    left = np.roll(h, 1)
    left[np.cumsum(n) - n] = START
    return left


def bigram_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The top bits are the left word's, so keys sort by bucket."""
    x = (left ^ (right + (right << np.uint64(31)))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return (left & np.uint64(0xFFFFFF0000000000)) | (x & np.uint64(0x000000FFFFFFFFFF))


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _sum_by(keys: tuple[np.ndarray, ...], *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct key tuples in ascending order, and their values' sums."""
    order = np.lexsort(keys[::-1])
    keys = tuple(k[order] for k in keys)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    at = np.flatnonzero(new)
    return (*(k[at] for k in keys), *(np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values))


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            left, right = (np.concatenate(x) for x in zip(*held, strict=True))
            left, right, n = _sum_by((left, right), np.ones(len(left), np.uint32))
            rows = []
            for b, s in cut(bucket_of(left, buckets), buckets):
                lw, per = np.unique(left[s], return_counts=True)
                rows.append((b, pack(lw, per.astype(np.uint32), right[s], n[s].astype(np.uint32))))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                               pa.array([r[1] for r in rows], pa.binary())], names=["bucket", "blob"])
        for b in slices(batches):
            h, n = tokens(b.column("text").to_pylist())
            held.append((contexts(h, n), h))
            size += len(h)
            if size > COUNT_TOKENS:
                yield flush()
                size = 0
        if held:
            yield flush()
    return run


def _write(folder: str, name: str, a: np.ndarray) -> None:
    """A retried task replaces the file by an equal one."""
    part = f"{folder}/.{name}-{os.getpid()}-{os.urandom(4).hex()}"
    with open(part, "wb") as f:
        np.save(f, a)
    os.replace(part, f"{folder}/{name}.npy")


def _tally(n: np.ndarray) -> list[int]:
    return [int((n == k).sum()) for k in (1, 2, 3, 4)]


def _bigrams(folder: str, buckets: int):
    """Adds a bucket's bigrams, writes its arrays; the right words' totals."""
    def run(t: pa.Table) -> pa.Table:
        os.makedirs(folder, exist_ok=True)
        bucket, parts = t.column("bucket")[0].as_py(), []
        for blob in t.column("blob"):
            lw, per, right, n = unpack(blob.as_py(), np.uint64, np.uint32, np.uint64, np.uint32)
            parts.append((np.repeat(lw, per), right, n))
        left, right, n = _sum_by(tuple(np.concatenate(x) for x in zip(*(p[:2] for p in parts), strict=True)),
                                 np.concatenate([p[2] for p in parts]).astype(np.int64))
        key, count = _sum_by((bigram_key(left, right),), n)
        _write(folder, f"bigram-{bucket}", key)
        _write(folder, f"bigram-n-{bucket}", count.astype(np.uint32))
        word, *totals = _sum_by((left,), n, (n == 1).astype(np.int64), (n == 2).astype(np.int64), (n > 2).astype(np.int64))
        _write(folder, f"context-{bucket}", word)
        _write(folder, f"context-n-{bucket}", np.stack(totals, axis=1))
        word, n, types = _sum_by((right,), n, np.ones(len(n), np.int64))
        rows = [(b, pack(word[s], n[s], types[s])) for b, s in cut(bucket_of(word, buckets), buckets)]
        t4 = _tally(count)
        return pa.table({"bucket": pa.array([b for b, _ in rows], pa.int32()),
                         "blob": pa.array([x for _, x in rows], pa.binary()),
                         "tally": pa.array([t4 if k == 0 else [0] * 4 for k in range(len(rows))], pa.list_(pa.int64()))})
    return run


def _unigrams(folder: str):
    """Adds a bucket's words, writes its arrays; its totals."""
    def run(t: pa.Table) -> pa.Table:
        bucket = t.column("bucket")[0].as_py()
        parts = [unpack(x.as_py(), np.uint64, np.int64, np.int64) for x in t.column("blob")]
        word, n, types = _sum_by((np.concatenate([p[0] for p in parts]),),
                                 np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]))
        _write(folder, f"word-{bucket}", word)
        _write(folder, f"word-n-{bucket}", np.stack([n, types], axis=1))
        return pa.table({"bucket": pa.array([bucket], pa.int32()), "n": pa.array([int(n.sum())]),
                         "v": pa.array([len(word)]), "types": pa.array([int(types.sum())]),
                         "tally": pa.array([_tally(types)], pa.list_(pa.int64()))})
    return run


def discounts(tally: list[int]) -> list[float]:
    """D1, D2, D3+ from the numbers of entries counted once to four times;
    0.5, 1, 1.5 where these are too few to tell."""
    n1, n2, n3, n4 = tally
    if min(n1, n2, n3, n4) == 0:
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(x, 0.05), k + 0.95) for k, x in enumerate(d)]


@dataclass
class Model:
    folder: str
    buckets: int
    n: int                 # training tokens
    v: int                 # distinct ones
    types: int             # distinct bigrams
    word_tally: list[int]
    upper: list[float]     # discounts of bigram counts
    lower: list[float]     # discounts of continuation counts


def local_folder(spark: SparkSession) -> str:
    path = urlparse(work_dir(spark, "kneser-ney"))
    if path.scheme not in ("", "file"):
        raise ValueError(f"spark.checkpoint.dir is {path.scheme}: ...; the model's arrays are memory-mapped and "
                         "need a folder that every machine mounts")
    return path.path


def train(spark: SparkSession, docs: DataFrame) -> Model:
    """Count every text of ``docs`` (null: empty, the end alone).  An empty
    table gives a model that knows nothing; its texts then all score by the
    even share of the one unknown token."""
    folder, buckets = local_folder(spark), shuffle_parts(spark)
    os.makedirs(folder, exist_ok=True)
    packed = texts(docs).mapInArrow(_count(buckets), "bucket int, blob binary")
    words = saved(packed.groupBy("bucket").applyInArrow(
        _bigrams(folder, buckets), "bucket int, blob binary, tally array<long>"), "kneser-ney-words")
    four = [F.sum(F.get("tally", F.lit(k))).alias(f"t{k}") for k in range(4)]
    up = words.agg(*four).first()
    low = words.select("bucket", "blob").groupBy("bucket").applyInArrow(
        _unigrams(folder), "bucket int, n long, v long, types long, tally array<long>").agg(
            F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum("types").alias("types"), *four).first()
    tally = [low[f"t{k}"] or 0 for k in range(4)]
    return Model(folder, buckets, low["n"] or 0, low["v"] or 0, low["types"] or 0, tally,
                 discounts([up[f"t{k}"] or 0 for k in range(4)]), discounts(tally))


class Arrays:
    """Sorted arrays of one kind, memory-mapped bucket by bucket."""

    def __init__(self, folder: str, kind: str, buckets: int):
        self.buckets, self.maps = buckets, {}
        for b in range(buckets):
            if os.path.exists(f"{folder}/{kind}-{b}.npy"):
                self.maps[b] = (np.load(f"{folder}/{kind}-{b}.npy", mmap_mode="r"),
                                np.load(f"{folder}/{kind}-n-{b}.npy", mmap_mode="r"))

    def find(self, key: np.ndarray, width: int = 0) -> np.ndarray:
        """The values of the keys; zeros for those that are missing."""
        ask, back = np.unique(key, return_inverse=True)
        out = np.zeros((len(ask), width) if width else len(ask), np.int64)
        for b, s in cut(bucket_of(ask, self.buckets), self.buckets):
            if b in self.maps:
                keys, values = self.maps[b]
                at = np.minimum(np.searchsorted(keys, ask[s]), len(keys) - 1)
                hit = keys[at] == ask[s]
                got = np.asarray(values[at], np.int64)
                got[~hit] = 0
                out[s] = got
        return out[back]


_open: dict[str, tuple[Arrays, Arrays, Arrays]] = {}


def _arrays(m: Model) -> tuple[Arrays, Arrays, Arrays]:
    """Opened once per worker process."""
    if m.folder not in _open:
        _open.clear()
        _open[m.folder] = tuple(Arrays(m.folder, k, m.buckets) for k in ("word", "context", "bigram"))
    return _open[m.folder]


def _less(count: np.ndarray, d: list[float]) -> np.ndarray:
    return np.maximum(count - np.array([0.0, *d])[np.minimum(count, 3)], 0.0)


def log_probs(m: Model, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per token: its count in training, and its natural log probability
    after the token before it."""
    words, context, bigrams = _arrays(m)
    left = contexts(h, n)
    word = words.find(h, 2)
    d = m.lower
    n1, n2 = m.word_tally[0], m.word_tally[1]
    kept_back = d[0] * n1 + d[1] * n2 + d[2] * (m.v - n1 - n2)
    types = max(m.types, 1)
    uniform = (kept_back / types if m.types else 1.0) / (m.v + 1)
    low = _less(word[:, 1], d) / types + uniform
    ctx = context.find(left, 4)
    total = np.maximum(ctx[:, 0], 1)
    back = (ctx[:, 1:] @ np.array(m.upper)) / total
    p = np.where(ctx[:, 0] > 0, _less(bigrams.find(bigram_key(left, h)), m.upper) / total + back * low, low)
    return word[:, 0], np.log(p)


def score(docs: DataFrame, m: Model) -> DataFrame:
    """Every row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score``, ``perplexity``.

    A null or empty text is the end token alone; a null doc_id is never held
    out; repeated rows count and score each.  Very long texts are read
    whole.  Every token has one count, so there are no ties to break.  Other
    columns, whatever their names, are not read.  An empty table gives none.
    """
    def run(batches):
        for b in slices(batches):
            h, n = tokens(b.column("text").to_pylist())
            c, lp = log_probs(m, h, n)
            at = np.cumsum(n) - n
            base = np.log10((c + 1) / (m.n + (m.v + 1)))
            logs = np.add.reduceat(lp, at) / math.log(10)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n), pa.array(np.add.reduceat((c > 0).astype(np.int64), at)),
                 pa.array(np.full(len(n), m.n)), pa.array(np.add.reduceat(base, at)), pa.array(logs),
                 pa.array(10 ** np.minimum(-logs / n, 300))],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])
    out = texts(docs).mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, "
                                      "base_score double, score double, perplexity double")
    return out.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score", "perplexity")
