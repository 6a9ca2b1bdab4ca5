"""Phrase collocation mining: mergeable Misra-Gries summaries, exact recount.

Per language, phrases of up to ``LONGEST`` words inside a piece that occur at
least ``least`` times are found in rounds (single words, pairs, then all
longer ones).  In a round every text is read once, a task counts the keys of
its n-grams slice by slice, and the counts go to hash partitions of the keys.
A partition keeps one Misra-Gries summary of ``ROOM`` times mass / ``least``
counters (its mass, the sum of all counts sent to it, arrives first): all its
decrements together stay below ``least`` / ``ROOM``, so every frequent n-gram
survives whatever else there is, in memory that does not depend on the number
of distinct n-grams.  Survivors whose count plus all decrements reaches
``least`` set a bit in a map of ``FILTER_BITS`` bits (its size is fixed;
a fuller map lets more through and loses nothing).  An n-gram of a
later round is counted only if its parts have their bits.

The second pass reads the texts again and counts exactly, by their words,
the n-grams whose bits are set.  What follows (cuts, scores, containment,
the first of each language) is joins and windows over the frequent phrases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopflow.llm.common import saved, shuffle_parts
from shopflow.llm.gather import cut, pack, slices, unpack

LEAST = 100
LONGEST = 5
FIRST = 2000
SCALE = 1000
ROUNDS = ((1,), (2,), (3, 4, 5))
KEY_BITS = 48            # two n-grams with one key only let more through
FILTER_BITS = 26
ROOM = 8                 # times the counters that the guarantee needs
SLICE_BYTES = 2 << 20    # of text, cut at a time (a longer text comes alone)
FLUSH = 1 << 21          # n-grams counted together in a task
HELD = 200_000           # phrases held by a task of the second pass
MERGE = 1 << 16          # counters added to a summary at a time, at least
SALTS = 64               # groups of a language whose first rows are found apart
BROADCAST_LANGS = 10_000
UNKNOWN = "und"

_KIND = np.zeros(256, np.uint8)          # 0: letter, 1: blank, 2: end of a piece
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all of them."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x9FB21C651E98DF25)
    x = x ^ (x >> _U(28))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _salt(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")


class Cut:
    """The words of a slice of texts, as positions and hashes."""

    def __init__(self, batch: pa.RecordBatch):
        texts = batch.column("text").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        body = texts.buffers()[2]
        raw = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]] if body else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        self.bytes, kind = _LOWER[raw], _KIND[raw]
        full = np.diff(offsets) > 0
        word = kind == 0
        begin, end = word.copy(), word.copy()
        begin[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        for mark, at in ((begin, offsets[:-1][full]), (end, offsets[1:][full] - 1)):
            mark[at] = word[at]          # no word crosses the end of a text
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.word = word
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        breaks = np.cumsum(kind == 2, dtype=np.int32)[self.start]
        # the next word stands in the same piece
        self.joined = np.zeros(len(self.start), bool)
        self.joined[:-1] = (breaks[1:] == breaks[:-1]) & (self.doc[1:] == self.doc[:-1])
        names = batch.column("lang").dictionary_encode()
        self.langs = names.dictionary.to_pylist()
        self.lang = names.indices.to_numpy(zero_copy_only=False)[self.doc]

    def hashes(self, seed: int) -> np.ndarray:
        """64 bits of each word: a polynomial in its bytes, mixed."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        rng = np.random.default_rng(seed)
        letters = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        lens = self.end - self.start
        first = np.cumsum(lens) - lens
        power = np.full(int(lens.max()), rng.integers(1, 1 << 63, dtype=np.uint64) | _U(1))
        power[0] = 1
        power = np.cumprod(power)
        at = np.arange(int(lens.sum())) - np.repeat(first, lens)
        return _mixed(np.add.reduceat(letters[self.bytes[self.word]] * power[at], first) + lens.astype(np.uint64))

    def keys(self, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per length: the key of the n-gram at each word, and whether there
        is one (enough words follow in the piece)."""
        h = self.hashes(seed)
        salts = np.array([_salt(x) for x in self.langs], np.uint64)
        key, there = _mixed(h ^ salts[self.lang]), np.ones(len(h), bool)
        short = _U(64 - KEY_BITS)
        yield 1, key >> short, there
        for n in range(2, LONGEST + 1):
            m = max(0, len(h) - n + 1)
            key, there = key.copy(), there & self.joined
            key[:m] = _mixed(key[:m] * _U(0xA0761D6478BD642F) + h[n - 1:])
            if n > 2:            # and the n - 1 words from the next one on
                there[:-1] &= before[1:]
            before = there
            yield n, key >> short, there

    def text(self, i: int, n: int) -> str:
        return b" ".join(self.bytes[self.start[j]:self.end[j]].tobytes() for j in range(i, i + n)).decode("utf-8", "replace")


class Bits:
    """A fixed map of bits, addressed by the top bits of a key."""

    def __init__(self, words: np.ndarray | None = None):
        self.words = np.zeros(1 << (FILTER_BITS - 6), np.uint64) if words is None else words

    def has(self, keys: np.ndarray) -> np.ndarray:
        slot = keys >> _U(KEY_BITS - FILTER_BITS)
        return (self.words[slot >> _U(6)] >> (slot & _U(63))) & _U(1) != 0


def wanted(c: Cut, seed: int, maps: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The n-grams of each length that may be frequent by the rounds so far,
    up to those of the next round: n, keys, and where they start."""
    keys, shorter = c.keys(seed), None
    for k, lengths in enumerate(ROUNDS[:len(maps) + 1]):
        for _ in lengths:
            n, key, there = next(keys)
            if shorter is not None:      # both parts, one word shorter, may be frequent
                there = there & shorter
                there[:-1] &= shorter[1:]
            if k < len(maps):
                there = there & Bits(maps[k]).has(key)
            yield n, key, there
            shorter = there


def squeezed(key: np.ndarray, count: np.ndarray) -> bytes:
    """Ascending keys as steps and counts as bytes, with the few that do not
    fit beside them."""
    step = np.diff(key, prepend=_U(0))
    far, many = np.flatnonzero(step >> _U(32)), np.flatnonzero(count > 255)
    return pack(step.astype(np.uint32), far, step[far] >> _U(32), np.minimum(count, 255).astype(np.uint8), many, count[many])


def unsqueezed(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    low, far, high, few, many, more = unpack(blob, np.uint32, np.int64, np.uint64, np.uint8, np.int64, np.int64)
    step, count = low.astype(np.uint64), few.astype(np.int64)
    step[far] += high << _U(32)
    count[many] = more
    return np.cumsum(step, dtype=np.uint64), count


def _tally(maps, parts: int):
    """The counts of the keys of one round, packed per hash partition, and
    the mass of each partition."""
    lengths = ROUNDS[len(maps.value)]

    def packed(keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        key, part = key // _U(parts), (key % _U(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        key, n, part = key[order], n[order], part[order]
        rows = [(p, int(n[s].sum()), squeezed(key[s], n[s])) for p, s in cut(part, parts)]
        k = len(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows] * 2, pa.int32()), pa.array([0] * k + [1] * k, pa.int32()),
             pa.array([r[1] for r in rows] * 2, pa.int64()),
             pa.array([None] * k + [r[2] for r in rows], pa.binary())], names=["part", "kind", "mass", "counts"])

    def run(batches):
        held, size = [], 0
        for b in slices(batches, chars=SLICE_BYTES):
            for n, key, there in wanted(Cut(b), 1, maps.value):
                if n in lengths:
                    held.append(key[there])
                    size += len(held[-1])
            if size >= FLUSH:
                yield from packed(held)
                held, size = [], 0
        if size:
            yield from packed(held)
    return run


class Summary:
    """A Misra-Gries summary of weighted items, merged block by block."""

    def __init__(self, capacity: int):
        self.capacity, self.removed = capacity, 0
        self.key, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, key: np.ndarray, count: np.ndarray) -> None:
        self.waiting.append((key, count))
        self.size += len(key)
        if self.size >= max(MERGE, self.capacity):
            self.merge()

    def merge(self) -> None:
        key = np.concatenate([self.key, *[k for k, _ in self.waiting]])
        count = np.concatenate([self.count, *[c for _, c in self.waiting]])
        self.waiting, self.size = [], 0
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        key, count = key[first], np.add.reduceat(count, first) if len(first) else count
        if len(key) > self.capacity:     # the largest that does not fit goes off every counter
            cutoff = int(np.partition(count, len(count) - self.capacity - 1)[len(count) - self.capacity - 1])
            self.removed += cutoff
            count = count - cutoff
            key, count = key[count > 0], count[count > 0]
        self.key, self.count = key, count

    def survivors(self, least: int) -> np.ndarray:
        self.merge()
        return self.key[self.count + self.removed >= least]


def _summarise(least: int, parts: int):
    """One summary a hash partition; its mass rows come before its counts."""
    def run(batches):
        mass: dict[int, int] = {}
        summaries: dict[int, Summary] = {}
        for b in batches:
            for part, kind, m, blob in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if kind == 0:
                    mass[part] = mass.get(part, 0) + m
                    continue
                if part not in summaries:
                    summaries[part] = Summary(ROOM * mass[part] // least + 1)
                summaries[part].add(*unsqueezed(blob))
        for part, s in summaries.items():
            key = s.survivors(least) * _U(parts) + _U(part)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64))], names=["key"])
    return run


def survivors(spark: SparkSession, rows: DataFrame, maps: list[np.ndarray], least: int) -> np.ndarray:
    """The bit map of the n-grams of the next round that may be frequent; at
    most 2 ** (FILTER_BITS - 6) numbers reach the driver."""
    parts = shuffle_parts(spark)
    shared = spark.sparkContext.broadcast(list(maps))      # fixed size, one map a round
    counts = rows.mapInArrow(_tally(shared, parts), "part int, kind int, mass long, counts binary")
    keys = (counts.repartition(parts, "part").sortWithinPartitions("kind", "part")
            .mapInArrow(_summarise(least, parts), "key long"))
    slot = F.shiftrightunsigned("key", KEY_BITS - FILTER_BITS)
    words = (keys.groupBy(F.shiftright(slot, 6).alias("word"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {KEY_BITS - FILTER_BITS}) & 63 as int))")).alias("bits"))
             .toArrow())
    out = Bits().words
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


class Phrases:
    """The phrases that a task has met: two hashes name each, so that its
    words are cut out once; counts by position."""

    def __init__(self):
        self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)       # of each key, in order of arrival
        self.count, self.lang, self.n, self.text = np.zeros(0, np.int64), [], [], []

    def __len__(self) -> int:
        return len(self.text)

    def add(self, c: Cut, n: int, key: np.ndarray, check: np.ndarray, at: np.ndarray) -> None:
        order = np.lexsort((check, key))
        key, check, at = key[order], check[order], at[order]
        first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (check[1:] != check[:-1]))))
        times = np.diff(np.concatenate((first, [len(at)])))
        key, check, at = key[first], check[first], at[first]
        i = np.minimum(np.searchsorted(self.key, key), max(0, len(self.key) - 1))
        known = (self.key[i] == key) & (self.check[i] == check) if len(self.key) else np.zeros(len(key), bool)
        np.add.at(self.count, self.place[i[known]] if len(self.key) else i[known], times[known])
        new = np.flatnonzero(~known)
        if not len(new):
            return
        self.lang += [c.langs[k] for k in c.lang[at[new]].tolist()]
        self.n += [n] * len(new)
        self.text += [c.text(k, n) for k in at[new].tolist()]
        place = np.concatenate([self.place, len(self.count) + np.arange(len(new))])
        self.count = np.concatenate([self.count, times[new]])
        keys, checks = np.concatenate([self.key, key[new]]), np.concatenate([self.check, check[new]])
        order = np.lexsort((checks, keys))
        self.key, self.check, self.place = keys[order], checks[order], place[order]

    def packed(self, parts: int) -> Iterator[tuple[int, bytes]]:
        """Per hash partition: the names, counts, languages and texts."""
        part = (self.key % _U(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        for p, s in cut(part[order], parts):
            rows = order[s]
            at = self.place[rows].tolist()
            words = [x for k in at for x in (self.lang[k].encode(), self.text[k].encode())]
            yield p, pack(self.key[rows], self.check[rows], self.count[at], np.array([self.n[k] for k in at], np.uint8),
                          np.array([len(w) for w in words], np.int64), np.frombuffer(b"".join(words), np.uint8))


def _recount(maps, parts: int):
    """Exact counts, within the task, of the n-grams whose bits are set; and
    the words of each language, as a phrase of length 0."""
    def out(held: Phrases) -> Iterator[pa.RecordBatch]:
        rows = list(held.packed(parts))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), pa.array([b for _, b in rows], pa.binary())],
                                         names=["part", "counts"])

    def run(batches):
        held = Phrases()
        for b in slices(batches, chars=SLICE_BYTES):
            c = Cut(b)
            if not len(c.start):
                continue
            salts = np.array([_salt(x) for x in c.langs], np.uint64)[c.lang]
            held.add(c, 0, salts, ~salts, np.arange(len(salts)))
            second = c.keys(2)           # two independent hashes name a phrase
            for n, key, there in wanted(c, 1, maps.value):
                _, check, _ = next(second)
                at = np.flatnonzero(there)
                if len(at):
                    held.add(c, n, key[at], check[at], at)
            if len(held) >= HELD:
                yield from out(held)
                held = Phrases()
        if len(held):
            yield from out(held)
    return run


def _added(least: int):
    """The counts of a hash partition's phrases from all tasks, added up."""
    def run(batches):
        held: dict = {}
        for b in batches:
            for blob in b.column("counts").to_pylist():
                key, check, count, n, size, words = unpack(blob, np.uint64, np.uint64, np.int64, np.uint8, np.int64, np.uint8)
                ends, text = np.cumsum(size), words.tobytes()
                first, mid, last = (ends - size)[::2], ends[::2], ends[1::2]     # a language and a phrase each
                for name, f, m, lo, at, hi in zip(zip(key.tolist(), check.tolist(), strict=True), count.tolist(), n.tolist(),
                                                  first.tolist(), mid.tolist(), last.tolist(), strict=True):
                    got = held.get(name)
                    if got is None:
                        held[name] = [f, m, text[lo:at], text[at:hi]]
                    else:
                        got[0] += f
        rows = [(lang.decode(), m, phrase.decode(), f) for f, m, lang, phrase in held.values() if f >= least or m == 0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4,
                                            (pa.string(), pa.int32(), pa.string(), pa.int64()), strict=True)],
            names=["lang", "m", "phrase", "f"])
    return run


def frequent(spark: SparkSession, docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang``, ``m``, ``phrase``, ``f``: every phrase of up to ``LONGEST``
    words with its exact count, where that is at least ``least``; and one row
    a language with m = 0 and the number of its words."""
    rows = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")).where("text <> ''")
    maps: list[np.ndarray] = []
    for _ in ROUNDS:
        maps.append(survivors(spark, rows, maps, least))
    parts = shuffle_parts(spark)
    counted = (rows.mapInArrow(_recount(spark.sparkContext.broadcast(maps), parts), "part int, counts binary")
               .repartition(parts, "part").mapInArrow(_added(least), "lang string, m int, phrase string, f long"))
    return saved(counted, "frequent-phrases")


def collocations(spark: SparkSession, docs: DataFrame, least: int = LEAST, first: int = FIRST) -> DataFrame:
    """The first phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Nulls: a null text is empty, a null lang is ``und`` (one language with
    rows that say so); doc_id is not read.  Empty texts give nothing; very
    long texts are read whole, alone in a slice.  Ties: equal scores by count,
    then by the phrase's bytes; equal cuts go to the shortest first part.
    Repeated rows each count.  An empty table gives an empty result.  Other
    columns, whatever their names, are not read."""
    phrases = frequent(spark, docs, least)
    totals = phrases.where("m = 0").select("lang", F.col("f").alias("n"))
    if totals.count() <= BROADCAST_LANGS:
        totals = F.broadcast(totals)
    found = phrases.where("m >= 2").select("lang", "phrase", F.col("f").alias("a"), "m").withColumn("w", F.split("phrase", " ", -1))
    part = lambda at, n: F.array_join(F.slice("w", at, n), " ")
    # counts only fall as phrases grow, so one more word on either side tells
    longer = (found.where("m >= 3").select("lang", "a", F.explode(F.array(
        part(1, F.col("m") - 1), part(2, F.col("m") - 1))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("a").alias("inside")))
    left = found.join(longer, ["lang", "phrase"], "left").where("inside is null or inside < a").drop("inside")
    cuts = left.select("lang", "phrase", "a", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.col("m") - 1),
        lambda k: F.struct(part(1, k).alias("head"), part(k + 1, F.col("m") - k).alias("tail")))).alias("k", "c"))
    side = lambda name, f: phrases.where("m >= 1").select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cuts = (cuts.select("lang", "phrase", "a", "k", "c.*").join(side("head", "l"), ["lang", "head"])
            .join(side("tail", "r"), ["lang", "tail"]).join(totals, "lang"))
    wide = lambda c: f"cast({c} as decimal(19,0))"
    score = F.expr(f"cast({SCALE} as decimal(4,0)) * {wide('a')} * {wide('n')} div ({wide('l')} * {wide('r')})")
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
            .select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    best = best.withColumn("_place", F.row_number().over(some)).where(F.col("_place") <= first)
    return (best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
