"""Hard-negative mining: angular triangle filtering, integer scoring.

Every vector, its components whole numbers, is stored with its norm and its
angles to ``REFERENCES`` reference directions (some of the vectors, chosen by
a hash of their ids).  For an anchor and a row at angles s and t to a
reference, the angle between the two lies between |s - t| and
min(s + t, 2 pi - s - t); the narrowest such interval over all references is
an interval of the cosine and, times both norms and with room for rounding,
of the score.  A pair is scored, in whole numbers, only if that interval
meets a window that can still take a result: for positives, scores that reach
the anchor's first ones so far; for negatives, the window of one of its
positives above the last of its first ones so far.  Rows are stored by
nearest reference and angle, so the same test on the extremes of a block of
rows passes over whole blocks.

Anchors are read chunk by chunk, of bounded size; each chunk meets all rows
in two passes (positives, then negatives) in which a task keeps the first
rows of each window and nothing else.  The chunk itself, being rows of the
table, first gives each window a floor, so that what tasks hand on for the
final choice does not grow with their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopflow.llm.common import saved, shuffle_parts
from shopflow.session import work_dir

REFERENCES = 16
SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH, WHOLE = 30, 90, 100   # the window: LOW / WHOLE to HIGH / WHOLE of a positive's score
CHUNK_ANCHORS = 4096
CHUNK_BYTES = 16 << 20           # of anchors at a time, at most
BLOCK = 256                      # rows tested together
SLACK = 1e-4                     # radians that a stored angle may be off, with room
NONE = np.iinfo(np.int64).min    # below every score
LAST = np.iinfo(np.int64).max    # an id after all others


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``label``, ``q``: rows with an id, a label and only finite
    components, as whole numbers and of one length (shorter vectors end in
    zeros); one row per vec_id, the first by label and vector."""
    fine = F.forall("embedding", lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    rows = (vectors.select("vec_id", "label", "embedding")
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                    F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double"))).alias("q")))
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r")).select("vec_id", "r.*")
    rows = saved(rows, "whole-vectors")
    length = rows.agg(F.max(F.size("q"))).first()[0] or 0
    return rows.withColumn("q", F.concat("q", F.array_repeat(F.lit(0).cast("long"), F.lit(length) - F.size("q"))))


def _matrix(column: pa.ListArray, kind=np.int64) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def _angles(references: np.ndarray):
    """Adds norm, angles to the references, the nearest of them, its angle."""
    unit = references / np.maximum(np.linalg.norm(references, axis=1, keepdims=True), 1e-300)

    def run(batches):
        for b in batches:
            q = _matrix(b.column("q")).astype(np.float64)
            norm = np.linalg.norm(q, axis=1)
            cos = q @ unit.T / np.maximum(norm, 1e-300)[:, None] if len(unit) else np.ones((len(q), 1))
            angle = np.arccos(np.clip(cos, -1, 1)).astype(np.float32)
            near = angle.argmin(axis=1) if len(q) else np.zeros(0, np.int64)
            wide = angle.shape[1]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), b.column("q"), pa.array(norm),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, wide * len(q) + 1, wide, dtype=np.int32)), pa.array(angle.ravel())),
                 pa.array(near.astype(np.int32)), pa.array(angle[np.arange(len(q)), near])],
                names=["vec_id", "label", "q", "norm", "angles", "near", "angle"])
    return run


def angled(spark: SparkSession, rows: DataFrame, references: int = REFERENCES) -> DataFrame:
    """The rows with their stored angles, dealt and sorted by nearest
    reference and angle (and id, so that equal vectors spread)."""
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(references).select("q").collect()
    table = np.array([r["q"] for r in chosen], np.float64).reshape(len(chosen), len(chosen[0]["q"]) if chosen else 0)
    schema = ("vec_id long, label long, q array<long>, norm double, angles array<float>, near int, angle float")
    order = ["near", "angle", "vec_id"]
    return saved(rows.mapInArrow(_angles(table), schema).repartitionByRange(shuffle_parts(spark), *order)
                 .sortWithinPartitions(*order), "angles")


class Vectors:
    """Some rows as arrays."""

    def __init__(self, t: pa.RecordBatch | pa.Table):
        if isinstance(t, pa.Table):
            t = t.combine_chunks()
        col = lambda n: t.column(n).combine_chunks() if isinstance(t, pa.Table) else t.column(n)
        self.id = col("vec_id").to_numpy(zero_copy_only=False).astype(np.int64)
        self.label = col("label").to_numpy(zero_copy_only=False).astype(np.int64)
        self.norm = col("norm").to_numpy(zero_copy_only=False).astype(np.float64)
        self.q, self.angles = _matrix(col("q")), _matrix(col("angles"), np.float32)

    def part(self, s: slice) -> Vectors:
        out = object.__new__(Vectors)
        out.__dict__ = {k: v[s] for k, v in self.__dict__.items()}
        return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; an error past 63 bits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = a.shape[1] * int(np.abs(a).max()) * int(np.abs(b).max())
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return a @ b.T
    raise ValueError("scores of these vectors do not fit a 64-bit number")


class Firsts:
    """The first ``k`` (score descending, id ascending) of many windows.
    A window takes scores from its ``low`` to its ``high``."""

    def __init__(self, k: int, low: np.ndarray, high: np.ndarray):
        self.k, self.low, self.high = k, low.copy(), high
        self.window, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(window):
            return
        w, s, i = (np.concatenate(x) for x in ((self.window, window), (self.score, score), (self.id, ids)))
        order = np.lexsort((i, -s, w))
        w, s, i = w[order], s[order], i[order]
        first = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
        size = np.diff(np.concatenate((first, [len(w)])))
        nth = np.arange(len(w)) - np.repeat(first, size)
        kept = nth < self.k
        self.window, self.score, self.id = w[kept], s[kept], i[kept]
        full = size >= self.k      # nothing below the last of a full window can come in
        at = w[first[full]]
        self.low[at] = np.maximum(self.low[at], s[first[full] + self.k - 1])


def bounds(a: Vectors, x: Vectors) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of every pair's score, safe under rounding."""
    least = np.zeros((len(a.id), len(x.id)), np.float32)
    most = np.full(least.shape, np.pi, np.float32)
    for r in range(a.angles.shape[1]):
        s, t = a.angles[:, r][:, None], x.angles[:, r][None]
        np.maximum(least, np.abs(s - t), out=least)
        both = s + t
        np.minimum(most, np.minimum(both, np.float32(2 * np.pi) - both), out=most)
    reach = a.norm[:, None] * x.norm[None]
    room = 1 + 1e-9 * reach
    return (np.cos(np.minimum(most + SLACK, np.pi)) * reach - room, np.cos(np.maximum(least - SLACK, 0)) * reach + room)


def block_bounds(a: Vectors, x: Vectors) -> tuple[np.ndarray, np.ndarray]:
    """The same for each anchor and a whole block of rows, by the extremes of
    the block's angles and norms."""
    lo, hi = x.angles.min(axis=0), x.angles.max(axis=0)
    least = np.maximum(np.maximum(lo - a.angles, a.angles - hi), 0).max(axis=1, initial=0)
    far = np.minimum(a.angles + hi, np.float32(2 * np.pi) - a.angles - lo).min(axis=1, initial=np.pi)
    up, down = np.cos(np.maximum(least - SLACK, 0)), np.cos(np.minimum(np.minimum(far, np.pi) + SLACK, np.pi))
    big, small = a.norm * x.norm.max(initial=0), a.norm * x.norm.min(initial=0)
    room = 1 + 1e-9 * big
    return np.where(down < 0, down * big, down * small) - room, np.where(up > 0, up * big, up * small) + room


def match(a: Vectors, x: Vectors, firsts: Firsts, each: int, same: bool) -> None:
    """Offer the rows ``x`` to the windows of the anchors: ``each`` windows an
    anchor, rows of its label (``same``, but not its own id) or of others."""
    low, high = firsts.low.reshape(-1, each), firsts.high.reshape(-1, each)
    down, up = block_bounds(a, x)
    rows = np.flatnonzero(((up[:, None] >= low) & (down[:, None] <= high) & (low <= high)).any(axis=1))
    if not len(rows):
        return
    b = a.part(rows)
    open_ = b.label[:, None] == x.label[None]
    open_ = open_ & (b.id[:, None] != x.id[None]) if same else ~open_
    down, up = bounds(b, x)
    meets = np.zeros(open_.shape, bool)
    for w in range(each):
        lw, hw = low[rows, w][:, None], high[rows, w][:, None]
        meets |= (up >= lw) & (down <= hw) & (lw <= hw)
    open_ &= meets
    some, cols = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
    if not len(some):
        return
    s = scores(b.q[some], x.q[cols])
    live = open_[np.ix_(some, cols)]
    ids = x.id[cols]
    new: list[tuple] = []
    for w in range(each):
        at = rows[some]
        i, j = np.nonzero(live & (s >= low[at, w][:, None]) & (s <= high[at, w][:, None]))
        new.append((at[i] * each + w, s[i, j], ids[j]))
    firsts.add(*(np.concatenate(c) for c in zip(*new, strict=True)))


def _pass(anchors: pa.Table, low: np.ndarray, high: np.ndarray, k: int, each: int, same: bool):
    """One pass over the rows for a chunk of anchors; per task, the first
    ``k`` rows of every window."""
    def blocks(t) -> Iterator[Vectors]:
        v = Vectors(t)
        for at in range(0, len(v.id), BLOCK):
            yield v.part(slice(at, at + BLOCK))

    def run(batches):
        a = Vectors(anchors)
        seed = Firsts(k, low, high)
        for x in blocks(anchors):        # floors only: these rows come again among all rows
            match(a, x, seed, each, same)
        firsts = Firsts(k, seed.low, high)
        for b in batches:
            for x in blocks(b):
                match(a, x, firsts, each, same)
        yield pa.RecordBatch.from_arrays(
            [pa.array(firsts.window), pa.array(firsts.score), pa.array(firsts.id)], names=["window", "score", "id"])
    return run


def _best(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("window").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(spark: SparkSession, vectors: DataFrame, anchor: Column, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   references: int = REFERENCES, chunk: int = CHUNK_ANCHORS) -> DataFrame:
    """Per anchor (rows where ``anchor`` holds) and each of its first
    ``positives`` other rows of its label, the first ``negatives`` rows of
    other labels with ``low`` / 100 to ``high`` / 100 of the positive's score:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Nulls: rows without an id, a label or a vector, or with a null or
    non-finite component, take no part.  Rows that repeat a vec_id: the first
    by (label, vector) stands for it.  Vectors of different lengths: the
    shorter ones end in zeros; an empty or all-zero vector scores 0 with
    every row.  Ties go to the smaller vec_id.  A positive with a negative
    score has an empty window.  Scores past 63 bits are an error.  An empty
    table, no anchors or no partners give no rows.  Other columns, whatever
    their names, are not read; very long vectors only make the chunks
    smaller.
    """
    rows = angled(spark, whole_vectors(vectors), references)
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    path = work_dir(spark, "hard-negatives")
    marked = rows.where(anchor)
    count, length = marked.agg(F.count("*"), F.max(F.size("q"))).first()
    chunk = max(1, min(chunk, CHUNK_BYTES // (8 * (length or 1) + 4 * references + 24)))
    chunks = -(-count // chunk)
    spark.createDataFrame([], out).write.parquet(path)
    for c in range(chunks):
        # unique ids dealt by hash: chunks differ little in size
        some = marked.where(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)) == c).drop("near", "angle").toArrow()
        ids = some.column("vec_id").to_numpy()
        n = len(ids)
        offered = rows.drop("near", "angle")
        kind = "window long, score long, id long"
        found = _best(offered.mapInArrow(_pass(some, np.full(n, NONE), np.full(n, LAST), positives, 1, True), kind),
                      positives).toArrow()     # at most `positives` rows an anchor of the chunk
        place, nth = found.column("window").to_numpy(), found.column("rank").to_numpy() - 1
        at = place * positives + nth
        lows, highs = np.full(n * positives, LAST), np.full(n * positives, NONE)   # empty where there is none
        score = found.column("score").to_numpy()
        lows[at], highs[at] = -(-low * score // WHOLE), high * score // WHOLE
        pairs = spark.createDataFrame(pa.table({
            "window": at, "anchor_id": ids[place], "positive_id": found.column("id"), "positive_score": score}))
        best = _best(offered.mapInArrow(_pass(some, lows, highs, negatives, positives, False), kind), negatives)
        (best.join(F.broadcast(pairs), "window")
         .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                 "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(path))
    return spark.read.schema(out).parquet(path)
