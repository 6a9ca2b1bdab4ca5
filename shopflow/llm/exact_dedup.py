"""Exact dedup by Grace hashing.

Records are partitioned by a hash of their normalised text; each partition
is streamed through an open-addressing table that compares complete texts
and holds at most ``TABLE_BYTES`` of them.  A record whose text is in the
table is absorbed; once the table is full it is frozen, and every record
with another text is spilled: written to a table in the shared checkpoint
folder, then partitioned again with the next level's hash function, until
no bucket spills.  A text is either in a bucket's table with all its records
or spilled with all of them, so each level is exact.

Each task also runs its own input through such a table before the shuffle,
so of a hot text only one record per task moves.  Documents then get their
class by the SHA-256 of the text, which carries no text; Spark splits a hot
digest there, as it splits any skewed join.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopflow.llm.common import SPACE_CHARS, boxed, saved, shuffle_parts

TABLE_BYTES = 64 << 20
RECORD = "sha string, content string, cp long, id long, n long"


class ContentTable:
    """Open addressing with linear probing over complete texts."""

    def __init__(self, budget: int):
        self.budget, self.bytes = budget, 0
        self.slots = [-1] * 1024
        self.rows: list[list] = []  # [sha, content, code points, smallest id, count]

    def add(self, sha: str, content: str, cp: int, doc_id: int | None, n: int) -> bool:
        """Absorb the record; False if its text is new and the table full."""
        mask = len(self.slots) - 1
        at = int(sha[:8], 16) & mask
        while (k := self.slots[at]) >= 0:
            row = self.rows[k]
            if row[1] == content:
                if better(cp, doc_id, row[2], row[3]):
                    row[2], row[3] = cp, doc_id
                row[4] += n
                return True
            if row[0] == sha:
                raise ValueError(f"two texts share the SHA-256 {sha}")
            at = (at + 1) & mask
        if self.rows and self.bytes + len(content) > self.budget:
            return False
        self.slots[at] = len(self.rows)
        self.rows.append([sha, content, cp, doc_id, n])
        self.bytes += len(content) + 200
        if 2 * len(self.rows) > len(self.slots):
            self._grow()
        return True

    def _grow(self) -> None:
        mask = 2 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for k, row in enumerate(self.rows):
            at = int(row[0][:8], 16) & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = k


def better(cp: int, doc_id: int | None, than_cp: int, than_id: int | None) -> bool:
    """More code points first, then the smaller id; a null id comes last."""
    if cp != than_cp:
        return cp > than_cp
    return doc_id is not None and (than_id is None or doc_id < than_id)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for k in range(0, b.num_rows, 512):
            yield from zip(*(c.to_pylist() for c in b.slice(k, 512).columns), strict=True)


SCHEMA = pa.schema([("sha", pa.string()), ("content", pa.string()), ("cp", pa.int64()),
                    ("id", pa.int64()), ("n", pa.int64())])


def _batches(rows: Iterator[list], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += len(r[1] or "") + 100
        if n > size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), SCHEMA, strict=True)], schema=SCHEMA)
            held, n = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), SCHEMA, strict=True)], schema=SCHEMA)


def _combine(budget: int):
    """Before the shuffle: one record per text and table fill."""
    def run(batches):
        def rows():
            held = ContentTable(budget)
            for r in _rows(batches):
                if not held.add(*r):
                    yield from held.rows
                    held = ContentTable(budget)
                    held.add(*r)
            yield from held.rows
        yield from _batches(rows())
    return run


def _resolve(budget: int):
    """One bucket: records of texts that fit come out without their text."""
    def run(batches):
        def rows():
            held = ContentTable(budget)
            for r in _rows(batches):
                if not held.add(*r):
                    yield r  # spilled
            for sha, _, cp, doc_id, n in held.rows:
                yield [sha, None, cp, doc_id, n]
        yield from _batches(rows())
    return run


def records(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.translate(text, SPACE_CHARS, "")
    return docs.select(F.sha2(bare, 256).alias("sha"), bare.alias("content"),
                       F.length(text).cast("long").alias("cp"), F.col("doc_id").cast("long").alias("id"),
                       F.lit(1).cast("long").alias("n"))


def classes(spark: SparkSession, docs: DataFrame, table_bytes: int = TABLE_BYTES,
            buckets: int | None = None) -> DataFrame:
    """One row per distinct text: ``text_sha256``, ``keep_id``, ``keep_cp``,
    ``group_size``."""
    buckets = buckets or shuffle_parts(spark)
    left = records(docs).mapInArrow(_combine(min(table_bytes, 16 << 20)), RECORD)
    done, level = [], 0
    while True:
        bucket = F.xxhash64(F.lit(level), F.col("sha"))  # another hash function at each level
        out = saved(left.repartition(buckets, bucket).mapInArrow(_resolve(table_bytes), RECORD),
                    f"grace-{level}")
        done.append(out.where("content is null"))
        left = out.where("content is not null")
        if left.isEmpty():
            break
        level += 1
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    return whole.select(F.col("sha").alias("text_sha256"), F.col("id").alias("keep_id"),
                        F.col("cp").alias("keep_cp"), F.col("n").alias("group_size"))


def exact_dedup(spark: SparkSession, docs: DataFrame, table_bytes: int = TABLE_BYTES,
                buckets: int | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``,
    ``kept``, ``text_sha256``, ``n_code_points``.

    Null text counts as empty; a null doc_id is the largest; of rows equal
    in text, doc_id and length exactly one is kept, also where the kept id
    is null.  Very long texts are compared whole; one above the table's
    bytes is spilled like any that does not fit.  Ties in length go to the
    smaller doc_id.  Other columns, whatever their names, are not read.  An
    empty table gives an empty result.
    """
    found = classes(spark, docs, table_bytes, buckets)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id"), F.sha2(F.translate(text, SPACE_CHARS, ""), 256).alias("text_sha256"),
                       F.length(text).cast("long").alias("n_code_points"), F.xxhash64(text).alias("tie"))
    again = Window.partitionBy("doc_id", "text_sha256", "n_code_points").orderBy("tie")
    rows = rows.withColumn("copy", F.row_number().over(again))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_code_points") == F.col("keep_cp")) & (F.col("copy") == 1)
    return rows.join(found, "text_sha256").select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", "n_code_points")


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    ids = exact_dedup(spark, docs).where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), F.col("n_code_points").alias("_cp"))
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = boxed(docs, "doc_id", F.sha2(F.translate(text, SPACE_CHARS, ""), 256).alias("_s"),
                   F.length(text).cast("long").alias("_n"))
    on = (F.col("_s") == F.col("_sha")) & (F.col("_n") == F.col("_cp")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return marked.join(ids, on, "left_semi").dropDuplicates(["doc_id", "_s", "_n"]).select("_row.*")
