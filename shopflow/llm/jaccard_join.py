"""N-gram Jaccard join by adaptive multi-match prefixes.

1. Documents with equal shingle sets form a class; one of each goes on.
2. Every shingle moves once, packed by hash, to count the classes that hold
   it.  A class needs three quarters of its shingles shared with others to
   have a link at all; the classes that do keep their shared shingles.
3. Shingles are ordered from rare to frequent.  Two linked sets share at
   least ``l`` shingles of their ``l``-prefixes: the first
   n - ceil(0.75 n) + l in that order.  Each class chooses ``l`` by the
   estimated cost of its candidates (lists to read, pairs to verify): a
   longer prefix requires as many more shared shingles.  A pair must share
   ``l`` = the smaller of the two in both ``l``-prefixes.
4. Candidates are verified on the complete shared sets.  First every class
   is held against one hub of its prefix lists, the smallest class that it
   shares most of them with; classes that this links form components, and
   only pairs across components are candidates after that.  Short lists
   are joined with themselves and their pairs counted.  The members of long
   lists, grouped by the lists they share, are compared block by block: a
   block pair's complete intersections are one matrix product, of which only
   the links that join components come out.  A large group of near copies
   so never becomes rows of pairs, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopflow.llm.common import SPACE_CHARS, boxed, saved, shuffle_parts
from shopflow.llm.components import components
from shopflow.llm.gather import cut, pack, slices, unpack

WORDS = 5
NEED, OF = 3, 4              # the similarity, 0.75, as a fraction
DEEPEST = 12                 # most shared prefix shingles a class may require
VERIFY = 16.0                # cost of verifying a pair, in list entries read
HUB_ROUNDS = 2
LONG_LIST = 48               # a longer list's members are compared in blocks
BLOCK = 1000                 # classes in a block
COLUMNS = 4096               # shingles multiplied at a time
CHUNK = 3_000_000            # shingles a task packs at a time
BROADCAST_BYTES = 48 << 20
_C = np.uint64(0x9E3779B97F4A7C15)
_LOW48 = np.uint64((1 << 48) - 1)


# -- shingle sets ------------------------------------------------------------
def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(batch: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.  As bytes, a text is cut
    at the six ASCII white-space characters and only A-Z change case."""
    words = [t.encode().lower().split() for t in batch]
    n = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, int(n.sum()))
    whole = np.full(max(len(flat) - WORDS + 1, 0), WORDS, np.uint64)
    for j in range(WORDS):
        whole = _mixed(whole * _C + flat[j:len(flat) - WORDS + 1 + j]) if len(whole) else whole
    out = []
    for at, k in zip((np.cumsum(n) - n).tolist(), n.tolist(), strict=True):
        if k >= WORDS:
            out.append(np.unique(whole[at:at + k - WORDS + 1]))
        else:
            s = np.full(1 if k else 0, k, np.uint64)
            for j in range(k):
                s = _mixed(s * _C + flat[at + j:at + j + 1])
            out.append(s)
    return out


def members(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``tie`` (hash of the text), ``key`` (64-bit hash of the
    set; null if empty), ``n_shingles`` of every row."""
    def run(batches):
        for b in slices(batches):
            sets = shingle_sets(b.column("text").to_pylist())
            keys = [int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64)) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tie"), pa.array(keys, pa.int64()),
                                              pa.array([len(s) for s in sets], pa.int64())], names=["doc_id", "tie", "key", "n_shingles"])
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie")).mapInArrow(
        run, "doc_id long, tie long, key long, n_shingles long")


def _first() -> Column:
    """Of a group's rows the smallest doc_id (null: largest), then text hash."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie"))


def _representatives(docs: DataFrame, every: DataFrame) -> DataFrame:
    """``key`` and ``text`` of one row per class."""
    one = every.where("key is not null").groupBy("key").agg(_first().alias("x")).select(
        "key", F.col("x.doc_id").alias("_d"), F.col("x.tie").alias("_t"))
    text = F.coalesce(F.col("text"), F.lit(""))
    if 32 * one.count() <= BROADCAST_BYTES:
        one = F.broadcast(one)
    on = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_t"))
    return docs.select("doc_id", text.alias("text")).join(one, on).select("key", "text")


# -- shared shingles ---------------------------------------------------------
PACKED = "bucket int, blob binary"


def _rows(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())],
                                      names=["bucket", "blob"])


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def _shingles(buckets: int):
    """Per bucket of hashes: keys, their numbers of shingles here and in
    all, and the low 48 bits of the shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = 0

        def flush():
            keys = np.fromiter(held, np.int64, len(held))
            n = np.fromiter(map(len, held.values()), np.int64, len(held))
            h = np.concatenate(list(held.values()))
            held.clear()
            doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
            b = _bucket(h, buckets)
            order = np.argsort(b.astype(np.uint16) if buckets < 65536 else b, kind="stable")
            h, doc = h[order] & _LOW48, doc[order]
            rows = []
            for k, s in cut(b[order], buckets):
                d, here = np.unique(doc[s], return_counts=True)
                low = h[s]
                rows.append((k, pack(keys[d], n[d].astype(np.uint32), here.astype(np.uint32),
                                     low.astype(np.uint32), (low >> np.uint64(32)).astype(np.uint16))))
            return _rows(rows)
        for b in slices(batches):
            for key, s in zip(b.column("key").to_pylist(), shingle_sets(b.column("text").to_pylist()), strict=True):
                if key in held or not len(s) or int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64)) != key:
                    continue  # of a row that repeats the id of another class
                held[key] = s
                size += len(s)
            if size > CHUNK:
                yield flush()
                size = 0
        if held:
            yield flush()
    return run


def _shared(buckets: int):
    """The shingles that at least two classes hold, sent to the classes."""
    def run(t: pa.Table) -> pa.Table:
        bucket = t.column("bucket")[0].as_py()
        parts = [unpack(x, np.int64, np.uint32, np.uint32, np.uint32, np.uint16) for x in t.column("blob").to_pylist()]
        key = np.concatenate([np.repeat(p[0], p[2]) for p in parts])
        n = np.concatenate([np.repeat(p[1], p[2]) for p in parts])
        h = np.concatenate([p[3].astype(np.uint64) | p[4].astype(np.uint64) << np.uint64(32) for p in parts])
        order = np.lexsort((key, h))
        key, n, h = key[order], n[order], h[order]
        one = np.concatenate(([True], (h[1:] != h[:-1]) | (key[1:] != key[:-1])))  # a repeated row counts once
        key, n, h = key[one], n[one], h[one]
        start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        df = np.diff(np.append(start, len(h)))
        df = np.repeat(df, df)
        many = df > 1
        key, n, h, df = key[many], n[many], h[many], df[many]
        b = _bucket(_mixed(key.astype(np.uint64)), buckets)
        order = np.lexsort((key, b))
        key, n, h, df, b = (a[order] for a in (key, n, h, df, b))
        h |= np.uint64(bucket) << np.uint64(48)
        return pa.Table.from_batches([_rows([(k, pack(key[s], n[s], h[s], np.minimum(df[s], 1 << 30).astype(np.uint32)))
                                             for k, s in cut(b, buckets)])])
    return run


def _survivors(t: pa.Table) -> pa.Table:
    """Classes with enough shared shingles, these from rare to frequent."""
    key, n, h, df = (np.concatenate(x) for x in zip(*(unpack(x, np.int64, np.uint32, np.uint64, np.uint32)
                                                      for x in t.column("blob").to_pylist()), strict=True))
    order = np.lexsort((h, df, key))
    key, n, h, df = key[order], n[order].astype(np.int64), h[order].astype(np.int64), df[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.append(first, len(key)))
    good = OF * size >= NEED * n[first]
    take = np.repeat(good, size)
    offsets = np.concatenate(([0], np.cumsum(size[good]))).astype(np.int32)
    lists = lambda a, t: pa.ListArray.from_arrays(pa.array(offsets), pa.array(a, t))
    return pa.table({"key": pa.array(key[first][good]), "n": pa.array(n[first][good]),
                     "shared": lists(h[take], pa.int64()), "df": lists(df[take].astype(np.int64), pa.int64())})


# -- prefixes ----------------------------------------------------------------
def prefix(n: int, df: np.ndarray) -> tuple[int, int]:
    """The chosen ``l`` and the number of shared shingles in its prefix; the
    n - len(df) unshared ones come first in the order."""
    unshared = n - len(df)
    shortest = n - -(-NEED * n // OF)             # without l
    cost = np.concatenate(([0], np.cumsum(df - 1.0)))
    depth = np.arange(1, min(DEEPEST, -(-NEED * n // OF)) + 1)
    take = np.clip(shortest + depth - unshared, 0, len(df))
    choice = int(np.argmin(cost[take] + VERIFY * cost[take] / depth))
    return int(depth[choice]), int(take[choice])


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols: list[list] = [[], [], [], []]
        df, shared = b.column("df"), b.column("shared")
        keys, ns = b.column("key").to_pylist(), b.column("n").to_pylist()
        for k in range(b.num_rows):
            n = ns[k]
            d = df[k].values.to_numpy()
            depth, take = prefix(n, d)
            at = n - len(d) + np.arange(take)
            level = np.maximum(at - (n - -(-NEED * n // OF)) + 1, 1)
            cols[0].append(shared[k].values.to_numpy()[:take])
            cols[1].append(np.full(take, keys[k], np.int64))
            cols[2].append(np.full(take, depth, np.int32))
            cols[3].append(level.astype(np.int32))
        n_of = np.repeat(np.array(ns, np.int64), [len(x) for x in cols[0]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols] + [pa.array(n_of)],
                                         names=["token", "key", "depth", "level", "n"])


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, exactly."""
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("s_a"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("s_b"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("both", both)
    return joined.where((NEED + OF) * F.col("both") >= NEED * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _labelled(postings: DataFrame, found: DataFrame | None) -> DataFrame:
    """Postings of the lists that touch several components."""
    if found is None:
        out = postings.withColumn("root", F.col("key"))
    else:
        roots = found.select(F.col("node").alias("key"), "root")
        out = postings.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    spread = out.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("token")
    return out.join(spread, "token", "left_semi")


def links(sets: DataFrame) -> DataFrame | None:
    """``node``, ``root`` of the linked classes; None without candidates."""
    postings = saved(sets.mapInArrow(_postings, "token long, key long, depth int, level int, n long"), "postings")
    found, all_links = None, None
    near = (NEED * F.greatest("n_a", "n_b") <= OF * F.least("n_a", "n_b"))
    for _ in range(HUB_ROUNDS):
        lists = _labelled(postings, found)
        hub = Window.partitionBy("token")
        with_hub = lists.withColumn("hub", F.min(F.struct("root", "key", "n")).over(hub)).where("root <> hub.root")
        met = with_hub.select(F.col("hub.key").alias("a"), F.col("key").alias("b"),
                              F.col("hub.n").alias("n_a"), F.col("n").alias("n_b")).where(near)
        counted = met.groupBy("a", "b").agg(F.count("*").alias("c"))
        best = counted.groupBy("b").agg(F.max(F.struct("c", F.negative("a").alias("m"))).alias("x"))
        new = saved(_linked(best.select(F.negative("x.m").alias("a"), "b"), sets), "hub-links")
        if new.isEmpty():
            break
        all_links = new if all_links is None else all_links.unionByName(new)
        found = saved(components(all_links), "classes")
    lists = _labelled(postings, found)
    size = lists.groupBy("token").agg(F.count("*").alias("members"))
    lists = saved(lists.join(size, "token"), "lists")
    short, long = lists.where(F.col("members") <= LONG_LIST), lists.where(F.col("members") > LONG_LIST)
    side = lambda x: short.select("token", *(F.col(c).alias(f"{c}_{x}") for c in ("key", "depth", "level", "n", "root")))
    least = F.least("depth_a", "depth_b")
    met = side("a").join(side("b"), "token").where(
        (F.col("key_a") < F.col("key_b")) & (F.col("root_a") != F.col("root_b")) & near
        & (F.col("level_a") <= least) & (F.col("level_b") <= least))
    candidates = met.groupBy(F.col("key_a").alias("a"), F.col("key_b").alias("b")).agg(
        F.count("*").alias("c"), F.first(least).alias("l")).where("c >= l")
    last = saved(_linked(candidates, sets).unionByName(_block_links(long, sets)), "links-across")
    if not last.isEmpty():
        all_links = last if all_links is None else all_links.unionByName(last)
        found = saved(components(all_links), "classes")
    return found


def _block_links(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components among the members of long lists."""
    hub = F.min("key").over(Window.partitionBy("token"))
    groups = saved(components(lists.select(F.col("key").alias("a"), hub.alias("b"))), "groups")
    sizes = groups.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    roots = lists.select("key", F.col("root").alias("component")).distinct()
    rows = (groups.join(sizes, "root").select(F.col("node").alias("key"), F.col("root").alias("g"), "blocks")
            .join(roots, "key").join(sets.select("key", "n", "shared"), "key"))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode_outer(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("g", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine",
                       "key", "component", "n", "shared")
    return rows.groupBy("g", "i", "j").applyInArrow(_compare, "a long, b long")


def _compare(t: pa.Table) -> pa.Table:
    """All pairs of two blocks; the links that join components."""
    i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
    mine = t.column("mine").to_numpy()
    key, root, n = (t.column(c).to_numpy() for c in ("key", "component", "n"))
    a, b = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
    links: list[tuple[int, int]] = []
    if len(a) and len(b) and len(np.unique(root)) > 1:
        shared = t.column("shared").combine_chunks()
        size = np.diff(shared.offsets.to_numpy())
        _, column, times = np.unique(shared.flatten().to_numpy(), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(size)), size)
        row, column = row[times[column] > 1], column[times[column] > 1]
        column = np.unique(column, return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros((len(a), len(b)), np.float32)
        for k in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            s = slice(*np.searchsorted(column, (k, k + COLUMNS)))
            m = np.zeros((len(key), COLUMNS), np.float32)
            m[row[s], column[s] - k] = 1
            both += m[a] @ m[b].T
        x, y = np.nonzero((NEED + OF) * both.astype(np.int64) >= NEED * (n[a][:, None] + n[b][None, :]))
        parent = {int(r): int(r) for r in np.unique(root)}

        def top(v: int) -> int:
            while parent[v] != v:
                parent[v] = v = parent[parent[v]]
            return v
        differ = root[a[x]] != root[b[y]]
        for p, q in zip(a[x[differ]].tolist(), b[y[differ]].tolist(), strict=True):
            u, v = top(int(root[p])), top(int(root[q]))
            if u != v:
                parent[max(u, v)] = min(u, v)
                links.append((int(key[p]), int(key[q])))
    return pa.table({"a": pa.array([p for p, _ in links], pa.int64()), "b": pa.array([q for _, q in links], pa.int64())})


def _rooted(spark: SparkSession, docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """``members`` with the ``root`` of each row's component, a class key;
    null without shingles."""
    buckets = min(buckets or shuffle_parts(spark), 1 << 14)
    every = saved(members(docs), "members")
    sets = saved(
        _representatives(docs, every).mapInArrow(_shingles(buckets), PACKED)
        .groupBy("bucket").applyInArrow(_shared(buckets), PACKED)
        .groupBy("bucket").applyInArrow(_survivors, "key long, n long, shared array<long>, df array<long>"), "shared")
    found = links(sets)
    if found is None:
        return every.withColumn("root", F.col("key"))
    joined = every.join(found.select(F.col("node").alias("key"), "root"), "key", "left")
    return joined.withColumn("root", F.coalesce("root", "key"))


def jaccard_join(spark: SparkSession, docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``,
    ``component_id`` (smallest doc_id reachable by links, itself included).

    A null or wordless text has no shingles and no links.  Rows that repeat a
    doc_id each keep their own set; a null doc_id is larger than all others,
    and the component of null ids alone is null.  Repeated rows are linked.
    Very long texts are read whole.  Ties: a similarity of exactly 0.75 links;
    shingles of one frequency are ordered by their hash.  Other columns,
    whatever their names, are not read.  An empty table gives an empty result.
    """
    joined = _rooted(spark, docs, buckets)
    low = joined.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("low"))
    return joined.join(low, "root", "left").select(
        "doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("low")).alias("component_id"))


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of each component, by doc_id (null: largest), then by a hash
    of the text; every row without shingles stays."""
    first = _rooted(spark, docs).where("root is not null").groupBy("root").agg(_first().alias("x")).select(
        F.col("x.doc_id").alias("_id"), F.col("x.tie").alias("_t"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = boxed(docs, "doc_id", F.xxhash64(text).alias("_tie"), (F.translate(text, SPACE_CHARS, "") == "").alias("_bare"))
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_t"))
    kept = rows.where("not _bare").join(first, on, "left_semi").dropDuplicates(["doc_id", "_tie"])
    return kept.unionByName(rows.where("_bare")).select("_row.*")
