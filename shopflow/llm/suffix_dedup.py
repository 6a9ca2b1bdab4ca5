"""Suffix-array dedup of passages: bytes covered by a ``LENGTH``-byte string
that also starts earlier in the corpus.

1. Anchors.  Of the 32-byte strings inside a window of ``LENGTH`` bytes, the
   one with the smallest hash (the leftmost of equals) is its anchor.  Equal
   windows have equal anchors at equal places, so a window whose anchor
   occurs once in the corpus has no equal.  About one position in 35 is an
   anchor; only these move, packed by hash, to find those that occur twice.
2. Suffix buckets.  Each repeated anchor takes the bytes around it that its
   windows cover to the bucket of its hash.  A bucket is sorted in blocks of
   bounded size.  In a block, the positions of a difference cover modulo
   ``PERIOD`` (counted from the anchor, so that suffixes that can be equal
   lie alike to the cover) get ranks of their next ``DEPTH`` bytes first.
   The suffixes that start at one distance before one anchor are a suffix
   bucket: they agree on the anchor's bytes at least, a long tie, which the
   rank of the next cover position and the few bytes outside it resolve.
3. In the sorted order the first suffix of each run of equals stays, the
   others' windows are removed; overlapping windows merge into spans.

Within a task, anchors that repeat, and whole equal surroundings, are
settled before the shuffle, so of a passage that a third of all documents
hold, one copy per task moves.

An anchor whose records hold more suffixes than a block is sorted some
distances at a time, since suffixes at different distances never compare.
Where even one distance has more than a block (an anchor of more than
``block / (1 + REACH)`` records: a line shorter than ``LENGTH`` in very many
contexts), the anchor has no bucket of its own: its windows move one by one,
by a 128-bit hash of their bytes, the first of equals in a task only, so that
its contexts spread over all buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm.common import boxed, saved, shuffle_parts
from shopflow.llm.gather import cut, pack, ragged, slices, unpack

LENGTH = 100
GRAM = 32
SPAN = LENGTH - GRAM + 1     # 32-byte strings in a window
PERIOD = 31
COVER = np.array([0, 1, 3, 8, 12, 18])  # every difference modulo 31 occurs
REACH = 12                   # at most so far to the next cover position
DEPTH = LENGTH - REACH       # bytes that a cover rank orders
BLOCK = 400_000              # suffixes sorted at a time
HELD = 24 << 20              # bytes a task holds before it hands them on
# Positions and spans of documents (measured) up to this size are broadcast;
# larger ones are joined by shuffle.
BROADCAST_BYTES = 16 << 20
_PLACE = np.uint64(24)       # bits of a place inside a piece of text
_PIECE = 8 << 20             # a longer text is searched in overlapping pieces
_LAST = np.iinfo(np.int64).max

_TO_NEXT = np.array([min((c - r) % PERIOD for c in COVER) for r in range(PERIOD)])


# -- anchors -----------------------------------------------------------------
def gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes at each position but the last 31."""
    h = b.astype(np.uint64)
    for k, c in ((1, 0x100), (2, 0x10000), (4, 0x100000000)):  # eight bytes, exactly
        h = h[:-k] * np.uint64(c) + h[k:]
    for k, c in ((8, 0x9E3779B97F4A7C15), (16, 0xC2B2AE3D27D4EB4F)):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h = h[:-k] * np.uint64(c) + h[k:]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


def anchors(b: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the texts that end at ``ends`` in ``b``: each anchor's place, hash,
    and its first and last window start."""
    none = np.zeros(0, np.int64)
    if len(b) < LENGTH:
        return none, none.astype(np.uint64), none, none
    h = gram_hashes(b)
    m = (h >> _PLACE << _PLACE) | np.arange(len(h), dtype=np.uint64)
    k = 1
    while 2 * k <= SPAN:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    m = np.minimum(m[:len(m) - (SPAN - k)], m[SPAN - k:])
    place = (m & np.uint64((1 << int(_PLACE)) - 1)).astype(np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    first = ragged(starts, np.maximum(ends - starts - LENGTH + 1, 0))  # window starts
    if not len(first):
        return none, none.astype(np.uint64), none, none
    at = place[first]
    new = np.concatenate(([True], at[1:] != at[:-1]))
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(first)) - 1
    return at[lo], h[at[lo]], first[lo], first[hi]


def _found(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, tuple]]:
    """Buffer, start of each text in it (a piece's start may lie before), the
    row of each text, its anchors; long texts come in pieces."""
    raw = [t.encode() for t in batch.column("text").to_pylist()]
    short = [k for k, t in enumerate(raw) if LENGTH <= len(t) <= _PIECE]
    if short:
        b = np.frombuffer(b"".join(raw[k] for k in short), np.uint8)
        ends = np.cumsum([len(raw[k]) for k in short])
        yield b, np.concatenate(([0], ends[:-1])), np.array(short), anchors(b, ends)
    for k, t in enumerate(raw):
        for at in range(0, len(t) - LENGTH + 1, _PIECE) if len(t) > _PIECE else ():
            b = np.frombuffer(t[at:at + _PIECE + LENGTH - 1], np.uint8)
            yield b, np.array([-at]), np.array([k]), anchors(b, np.array([len(b)]))


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    doc = batch.column("doc_id").fill_null(_LAST).to_numpy(zero_copy_only=False).astype(np.int64)
    return doc, batch.column("tie").to_numpy().astype(np.int64)


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in
                                       enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["bucket", "kind", "blob"])


PACKED = "bucket int, kind int, blob binary"
TO_SORT, TO_DOCS, HOT, WINDOWS = 0, 1, 2, 3


def doc_bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    return ((doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _to_docs(buckets: int, doc: np.ndarray, *more: np.ndarray) -> list[tuple[int, int, bytes]]:
    """Records for their documents, packed by the documents' buckets."""
    b = doc_bucket(doc, buckets)
    order = np.argsort(b, kind="stable")
    return [(k, TO_DOCS, pack(*(a[order][s] for a in (doc, *more)))) for k, s in cut(b[order], buckets)]


def _hash_bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    h = h * np.uint64(0x9E3779B97F4A7C15)  # anchors are smallest hashes: most have the same first bits
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _anchor_records(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            h, doc, tie, pos = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(h, kind="stable")
            h, doc, tie, pos = h[order], doc[order], tie[order], pos[order]
            new = np.concatenate(([True], h[1:] != h[:-1]))
            twice = ~new | ~np.append(new[1:], True)  # repeats inside this task
            rows = _to_docs(buckets, doc[twice], tie[twice], pos[twice])
            times = np.diff(np.append(np.flatnonzero(new), len(h)))
            h, doc, tie, pos = h[new], doc[new], tie[new], pos[new]
            bucket = _hash_bucket(h, buckets)
            order = np.argsort(bucket, kind="stable")
            h, doc, tie, pos, times = (a[order] for a in (h, doc, tie, pos, times))
            for k, s in cut(bucket[order], buckets):
                rows.append((k, TO_SORT, pack(h[s], doc[s], tie[s], pos[s].astype(np.uint32), times[s])))
            return _rows(rows)
        for b in slices(batches):
            doc, tie = _ids(b)
            for _, start, row, (pos, h, _, _) in _found(b):
                k = np.searchsorted(start, pos, side="right") - 1
                held.append((h, doc[row[k]], tie[row[k]], pos - start[k]))
                size += 32 * len(h)
            if size > HELD:
                yield flush()
                size = 0
        if held:
            yield flush()
    return run


def _repeated(buckets: int, most: int):
    """Places of the anchors that occur twice; those that occur more than
    ``most`` times."""
    def run(t: pa.Table) -> pa.Table:
        out = [(r["bucket"], TO_DOCS, r["blob"]) for r in t.filter(pc.equal(t.column("kind"), TO_DOCS)).to_pylist()]
        parts = [unpack(x, np.uint64, np.int64, np.int64, np.uint32, np.int64) for x in
                 t.filter(pc.equal(t.column("kind"), TO_SORT)).column("blob").to_pylist()]
        if parts:
            h, doc, tie, pos, times = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            h = h[order]
            new = np.concatenate(([True], h[1:] != h[:-1]))
            hot = h[new][np.add.reduceat(times[order], np.flatnonzero(new)) > most]
            if len(hot):
                out.append((t.column("bucket")[0].as_py(), HOT, hot.tobytes()))
            twice = order[~new | ~np.append(new[1:], True)]
            twice = twice[times[twice] == 1]  # the others are with their documents
            out += _to_docs(buckets, doc[twice], tie[twice], pos[twice].astype(np.int64))
        return pa.Table.from_batches([_rows(out)])
    return run


def _per_doc(name: str, merge):
    """Records of a bucket of documents: one row per document; hot anchors
    are handed on."""
    def run(t: pa.Table) -> pa.Table:
        hot = t.filter(pc.equal(t.column("kind"), HOT)).column("blob").to_pylist()
        kinds = [np.int64] * (3 if name == "pos" else 4)
        parts = [unpack(x, *kinds) for x in t.filter(pc.equal(t.column("kind"), TO_DOCS)).column("blob").to_pylist()]
        cols = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * len(kinds)
        order = np.lexsort(cols[::-1])
        cols = [c[order] for c in cols]
        doc, tie = cols[:2]
        edge = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (tie[1:] != tie[:-1])))) if len(doc) else []
        rows = [(int(doc[a]), int(tie[a]), merge(*(c[a:b] for c in cols[2:])))
                for a, b in zip(edge, [*edge[1:], len(doc)], strict=True)]
        none = [None] * len(hot)
        return pa.table({"doc_id": pa.array([None if r[0] == _LAST else r[0] for r in rows] + none, pa.int64()),
                         "tie": pa.array([r[1] for r in rows] + none, pa.int64()),
                         name: pa.array([r[2] for r in rows] + none, pa.binary()),
                         "hot": pa.array([None] * len(rows) + hot, pa.binary())})
    return run


def _merged(start: np.ndarray, stop: np.ndarray) -> bytes:
    """Sorted spans to maximal disjoint ones, starts then stops."""
    reach = np.maximum.accumulate(stop)
    new = np.concatenate(([True], start[1:] > reach[:-1]))
    at = np.flatnonzero(new)
    return pack(start[at], reach[np.append(at[1:], len(start)) - 1])


# -- suffix buckets ----------------------------------------------------------
def _surroundings(buckets: int, hot: np.ndarray):
    """``hot``: hashes of the anchors whose windows move one by one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        windows: dict[bytes, tuple] = {}
        settled: list[tuple] = []
        size = 0

        def flush():
            rows = _to_docs(buckets, *(np.array(x, np.int64) for x in zip(*settled, strict=True))) if settled else []
            settled.clear()
            keys = list(held)
            bucket = _hash_bucket(np.array([k[0] for k in keys], np.uint64), buckets)
            order = np.argsort(bucket, kind="stable")
            keys = [keys[k] for k in order]
            h = np.array([k[0] for k in keys], np.uint64)
            off = np.array([k[1] for k in keys], np.int64)
            doc, tie, lo = (np.array([held[k][j] for k in keys], np.int64) for j in range(3))
            n = np.array([len(k[2]) for k in keys], np.int64)
            for k, s in cut(bucket[order], buckets):
                raw = np.frombuffer(b"".join(x[2] for x in keys[s]), np.uint8)
                rows.append((k, TO_SORT, pack(h[s], off[s], doc[s], tie[s], lo[s], n[s], raw)))
            held.clear()
            if windows:
                key = np.frombuffer(b"".join(windows), np.uint64).reshape(-1, 2)
                at = np.array(list(windows.values()), np.int64)
                bucket = _hash_bucket(key[:, 0], buckets)
                order = np.argsort(bucket, kind="stable")
                key, at = key[order], at[order]
                for k, s in cut(bucket[order], buckets):
                    rows.append((k, WINDOWS, pack(key[s, 0], key[s, 1], at[s, 0], at[s, 1], at[s, 2])))
                windows.clear()
            return _rows(rows)

        def first(found: dict, key, at: tuple) -> tuple | None:
            """Hold the first place of equals; the other one, if it goes."""
            old = found.setdefault(key, at)
            if at < old:  # the earlier one stays
                found[key], at, old = at, old, at
            return at if at > old else None
        for b in slices(batches):
            doc, tie = _ids(b)
            wanted = [np.frombuffer(x, np.int64) for x in b.column("pos").to_pylist()]
            for buf, start, row, (pos, h, lo, hi) in _found(b):
                if not len(pos):
                    continue
                raw = buf.tobytes()
                k = np.searchsorted(start, pos, side="right") - 1
                edge = np.searchsorted(k, np.arange(len(start) + 1))
                pick = np.concatenate([a + np.flatnonzero(np.isin(pos[a:z] - start[j], wanted[row[j]]))
                                       for j, (a, z) in enumerate(zip(edge, edge[1:])) if z > a])
                for p, g, x, y, j, many in zip(pos[pick].tolist(), h[pick].tolist(), lo[pick].tolist(), hi[pick].tolist(),
                                               k[pick].tolist(), np.isin(h[pick], hot).tolist(), strict=True):
                    at = (int(doc[row[j]]), int(tie[row[j]]), x - int(start[j]))
                    if many:
                        before = len(windows)
                        run_of: tuple | None = None  # windows of this record that go, one after the other
                        for w in range(x, y + 1):
                            gone = first(windows, xxhash.xxh3_128_digest(raw[w:w + LENGTH]), (*at[:2], at[2] + w - x))
                            if run_of and gone and gone == (*run_of[:2], run_of[3] - LENGTH + 1):
                                run_of = (*run_of[:3], run_of[3] + 1)
                            elif gone:
                                if run_of:
                                    settled.append(run_of)
                                run_of = (*gone, gone[2] + LENGTH)
                        if run_of:
                            settled.append(run_of)
                        size += 300 * (len(windows) - before)
                        continue
                    before = len(held)
                    gone = first(held, (g, p - x, raw[x:y + LENGTH]), at)
                    if gone:
                        settled.append((*gone, gone[2] + y - x + LENGTH))
                    size += (len(held) - before) * (y - x + LENGTH + 200)
            if size > HELD or len(settled) > 500_000:
                yield flush()
                size = 0
        if held or settled or windows:
            yield flush()
    return run


def _block(h, off, doc, tie, lo, n, raw, at) -> list[np.ndarray]:
    """Sort the suffixes of some records (grouped by anchor); the spans of
    those that equal an earlier one."""
    order = np.lexsort((lo, tie, doc))
    h, off, doc, tie, lo, n, at = (a[order] for a in (h, off, doc, tie, lo, n, at))
    group = np.unique(h, return_inverse=True)[1]
    count = n - LENGTH + 1                        # suffixes of each record
    # cover positions, counted from the anchor, and the ranks of their bytes
    rec = np.repeat(np.arange(len(n)), count + REACH)
    j = np.arange(len(rec)) - np.repeat(np.cumsum(count + REACH) - (count + REACH), count + REACH)
    sample = np.isin((j - off[rec]) % PERIOD, COVER)
    where = at[rec[sample]] + j[sample]
    text = np.lib.stride_tricks.sliding_window_view(raw, DEPTH)[where]
    rank_of = np.zeros(len(rec), np.int64)
    rank_of[sample] = _ranks(text)
    base = np.cumsum(count + REACH) - (count + REACH)
    # suffixes: bucket (anchor, distance before it), cover rank, other bytes
    rec = np.repeat(np.arange(len(n)), count)
    j = np.arange(len(rec)) - np.repeat(np.cumsum(count) - count, count)
    dist = off[rec] - j
    step = _TO_NEXT[(-dist) % PERIOD]
    rank = rank_of[base[rec] + j + step]
    place = at[rec] + j
    hi, low = np.zeros(len(rec), np.uint64), np.zeros(len(rec), np.uint64)
    for k in range(REACH):                        # bytes before the cover position, then after its depth
        byte = raw[place + k + np.where(k < step, 0, DEPTH)].astype(np.uint64)
        if k < 8:
            hi = (hi << np.uint64(8)) | byte
        else:
            low = (low << np.uint64(8)) | byte
    bucket = group[rec] * np.int64(2 * LENGTH) + dist
    order = np.lexsort((low, hi, rank, bucket))   # stable: equals stay in corpus order
    same = np.ones(len(order), bool)
    same[:1] = False
    for key in (bucket, rank, hi, low):
        same[1:] &= key[order][1:] == key[order][:-1]
    # rows that repeat an id and its text do not remove each other
    start = np.flatnonzero(~same)
    head = order[np.repeat(start, np.diff(np.append(start, len(order))))]
    mine, heads = rec[order], rec[head]
    same &= ~((doc[mine] == doc[heads]) & (tie[mine] == tie[heads]) & (lo[mine] + j[order] == lo[heads] + j[head]))
    gone = np.zeros(len(order), bool)
    gone[order[same]] = True
    runs = np.flatnonzero(gone & ~np.concatenate(([False], gone[:-1] & (rec[1:] == rec[:-1]))))
    ends = np.flatnonzero(gone & ~np.concatenate((gone[1:] & (rec[1:] == rec[:-1]), [False])))
    r = rec[runs]
    return [doc[r], tie[r], lo[r] + j[runs], lo[r] + j[ends] + LENGTH]


def _distances(h, off, doc, tie, lo, n, at, block: int) -> Iterator[tuple]:
    """The records of a block; or, of one anchor with more suffixes than a
    block, their parts at some distances before it at a time."""
    count = n - LENGTH + 1
    if count.sum() <= block:
        yield h, off, doc, tie, lo, n, at
        return
    step = max(1, block // len(h) - REACH)
    for near in range(int((off - count + 1).min()), int(off.max()) + 1, step):
        first = np.clip(off - near - step + 1, 0, count)     # of the suffixes at [near, near + step)
        stop = np.clip(off - near + 1, 0, count)
        k = np.flatnonzero(stop > first)
        f = first[k]
        yield h[k], off[k] - f, doc[k], tie[k], lo[k] + f, stop[k] - f + LENGTH - 1, at[k] + f


def _ranks(text: np.ndarray) -> np.ndarray:
    """Dense ranks of equally long byte strings."""
    words = np.ascontiguousarray(text).view(f"S{text.shape[1]}").ravel() if len(text) else np.zeros(0, "S1")
    return np.unique(words, return_inverse=True)[1]


def _windows(blobs: list[bytes]) -> list[np.ndarray]:
    """The spans of the windows that equal an earlier one."""
    one, two, doc, tie, lo = (np.concatenate(x) for x in zip(
        *(unpack(x, np.uint64, np.uint64, *[np.int64] * 3) for x in blobs), strict=True))
    order = np.lexsort((lo, tie, doc, two, one))
    one, two, doc, tie, lo = (a[order] for a in (one, two, doc, tie, lo))
    new = np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    # rows that repeat an id and its text do not remove each other
    gone = (doc != doc[head]) | (tie != tie[head]) | (lo != lo[head])
    return [doc[gone], tie[gone], lo[gone], lo[gone] + LENGTH]


def _sorted_buckets(buckets: int, block: int):
    def run(t: pa.Table) -> pa.Table:
        out = [(r["bucket"], TO_DOCS, r["blob"]) for r in t.filter(pc.equal(t.column("kind"), TO_DOCS)).to_pylist()]
        windows = t.filter(pc.equal(t.column("kind"), WINDOWS)).column("blob").to_pylist()
        if windows:
            out += _to_docs(buckets, *_windows(windows))
        parts = [unpack(x, np.uint64, *[np.int64] * 5, np.uint8) for x in
                 t.filter(pc.equal(t.column("kind"), TO_SORT)).column("blob").to_pylist()]
        if parts:
            h, off, doc, tie, lo, n, raw = (np.concatenate(x) for x in zip(*parts, strict=True))
            at = np.cumsum(n) - n
            order = np.argsort(h, kind="stable")
            h, off, doc, tie, lo, n, at = (a[order] for a in (h, off, doc, tie, lo, n, at))
            new = np.concatenate(([True], h[1:] != h[:-1]))
            many = ~new | ~np.append(new[1:], True)
            h, off, doc, tie, lo, n, at, new = (a[many] for a in (h, off, doc, tie, lo, n, at, new))
            total = np.cumsum(n - LENGTH + 1)
            group = np.flatnonzero(new)
            begin = 0
            while begin < len(group):  # whole anchors, up to a block's suffixes
                a = group[begin]
                before = total[a - 1] if a else 0
                last = np.searchsorted(total[np.append(group[begin + 1:], len(h)) - 1], before + block, side="right")
                stop = begin + max(int(last), 1)
                z = group[stop] if stop < len(group) else len(h)
                some = [x[a:z] for x in (h, off, doc, tie, lo, n, at)]
                for g, o, d, t_, x, m, w in _distances(*some, block):
                    out += _to_docs(buckets, *_block(g, o, d, t_, x, m, raw, w))
                begin = stop
        return pa.Table.from_batches([_rows(out)])
    return run


# -- the operator ------------------------------------------------------------
def _join(docs: DataFrame, side: DataFrame, column: str, how: str) -> DataFrame:
    size = side.agg(F.sum(F.length(column) + 32)).first()[0] or 0
    right = side.select(F.col("doc_id").alias("_d"), F.col("tie").alias("_t"), column)
    if size <= BROADCAST_BYTES:
        right = F.broadcast(right)
    return docs.join(right, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tie") == F.col("_t")), how).drop("_d", "_t")


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie"), *more)


def removed_spans(spark: SparkSession, docs: DataFrame, buckets: int | None = None,
                  block: int = BLOCK) -> DataFrame:
    """``doc_id``, ``tie`` (hash of the text), ``spans`` of the texts that
    lose bytes."""
    buckets = buckets or shuffle_parts(spark)
    keyed = _keyed(docs)
    found = saved(
        keyed.mapInArrow(_anchor_records(buckets), PACKED)
        .groupBy("bucket").applyInArrow(_repeated(buckets, block // (1 + REACH)), PACKED)
        .groupBy("bucket").applyInArrow(_per_doc("pos", lambda p: p.tobytes()), "doc_id long, tie long, pos binary, hot binary"),
        "anchors")
    # one in block / (1 + REACH) of the repeated anchors at most
    hot = np.frombuffer(b"".join(r["hot"] for r in found.where("hot is not null").select("hot").collect()), np.uint64)
    places = found.where("hot is null").drop("hot")
    return saved(
        _join(keyed, places, "pos", "inner").mapInArrow(_surroundings(buckets, hot), PACKED)
        .groupBy("bucket").applyInArrow(_sorted_buckets(buckets, block), PACKED)
        .groupBy("bucket").applyInArrow(_per_doc("spans", _merged), "doc_id long, tie long, spans binary, hot binary")
        .drop("hot"),
        "spans")


def _kept(raw: bytes, spans: bytes | None) -> tuple[bytes, int, int]:
    if spans is None:
        return raw, 0, 0
    start, stop = unpack(spans, np.int64, np.int64)
    edges = [0, *np.stack([start, stop], axis=1).ravel().tolist(), len(raw)]
    kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
    return kept, int((stop - start).sum()), len(start)


def suffix_dedup(spark: SparkSession, docs: DataFrame, buckets: int | None = None,
                 block: int = BLOCK) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256`` of the UTF-8 text.

    Null text counts as empty; a null doc_id comes after all others; rows
    with one doc_id and different texts are ordered by a hash of the text;
    rows equal in both are judged alike and do not remove each other.  An
    empty table gives an empty result.
    """
    joined = _join(_keyed(docs), removed_spans(spark, docs, buckets, block), "spans", "left")

    def run(batches):
        for b in slices(batches):
            raw = [t.encode() for t in b.column("text").to_pylist()]
            got = [_kept(t, s) for t, s in zip(raw, b.column("spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(t) for t in raw], pa.int64()), pa.array([g[1] for g in got], pa.int64()),
                 pa.array([g[2] for g in got], pa.int64()), pa.array([hashlib.sha256(g[0]).hexdigest() for g in got], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return joined.select("doc_id", "text", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with the removed bytes cut out of ``text`` (a character that
    a cut splits goes with it) and ``n_chars`` counted again."""
    whole = boxed(docs, "doc_id", "text")
    joined = _join(_keyed(whole, "_row"), removed_spans(spark, docs), "spans", "left")

    @F.pandas_udf("string")
    def rest(text, spans):
        import pandas as pd
        return pd.Series([_kept(t.encode(), None if s is None else bytes(s))[0].decode(errors="ignore")
                          for t, s in zip(text, spans, strict=True)])
    text = F.when(F.col("spans").isNull(), F.col("_row.text")).otherwise(rest("text", "spans"))
    out = joined.withColumn("text", text)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.select(*[new[c].alias(c) if c in new else F.col(f"_row.`{c}`") for c in docs.columns])
