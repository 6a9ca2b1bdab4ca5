"""Token ids as Parquet list columns.

Rows are in ascending doc_id over the files.  Ids are dictionary-encoded
(one page of a vocabulary fits), the ascending columns use delta encoding
(data pages of version 2), row groups and pages are small and fixed, and the
page indexes that the writer adds let a reader fetch the metadata columns
alone, or the tokens of a doc_id range without the rest of a file.

Each task writes its ids with their place inside its part; the parts' totals
(one number each) give the global places.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm.byte_tokens import byte_tokens
from shopflow.llm.common import save, shuffle_parts, texts
from shopflow.llm.gather import slices

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
SLICE_BYTES = 4 << 20   # of text, encoded at a time
FORMAT = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.page.row.count.limit": "2000",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#local_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}
COLUMNS = "doc_id long, part int, local_start long, n_tokens long, ids array<int>"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("local_start", pa.int64()),
                     ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _encode(tokenizer: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = byte_tokens(tokenizer), TaskContext.get().partitionId(), 0
        for b in slices(batches, chars=SLICE_BYTES):
            flat, n = enc.encode(b.column("text"), end)
            offsets = np.concatenate(([0], np.cumsum(n)))
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array(np.full(len(n), part, np.int32)),
                 pa.array(at + offsets[:-1]), pa.array(n), ids], schema=_SCHEMA)
            at += int(offsets[-1])
    return run


def write_tokens(spark: SparkSession, docs: DataFrame, tokenizer: str, end: int,
                 parts: int | None = None) -> str:
    """Encode every text (null: empty), append ``end``, write; the path."""
    ordered = (texts(docs).repartitionByRange(parts or shuffle_parts(spark), "doc_id")
               .sortWithinPartitions("doc_id", "text"))
    return save(ordered.mapInArrow(_encode(tokenizer, end), COLUMNS), "tokens", **FORMAT)


def read_tokens(spark: SparkSession, path: str, *columns: str, first: int | None = None,
                last: int | None = None) -> DataFrame:
    """The named columns (default all) of a doc_id range; only their pages
    are read."""
    df = spark.read.schema(COLUMNS).parquet(path)
    if first is not None:
        df = df.where(F.col("doc_id") >= first)
    if last is not None:
        df = df.where(F.col("doc_id") <= last)
    return df.select(*columns) if columns else df


def part_offsets(tokens: DataFrame) -> dict[int, int]:
    """Ids before each part; one number per part, from the metadata columns."""
    rows = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    out, at = {}, 0
    for r in sorted(rows, key=lambda r: r["part"]):
        out[r["part"]] = at
        at += r["n"]
    return out


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def ids_of(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and the offsets of each row, whatever slice this is."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), offsets


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start`` (ids of all
    documents before it), ``n_tokens``, ``ids_crc32``.

    An empty text has the end id alone; rows with equal or null doc_id each
    have their place (null first, then by text); an empty table gives none.
    """
    tokens = read_tokens(spark, path)
    offsets = part_offsets(tokens)

    def run(batches):
        byte_tokens.cache_clear()   # this worker may have encoded the texts: let go of what it holds
        for b in batches:
            flat, o = ids_of(b.column("ids"))
            start = b.column("local_start").to_numpy() + np.array(
                [offsets[p] for p in b.column("part").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(start.astype(np.int64)), b.column("n_tokens"),
                 pa.array([crc(flat[o[k]:o[k + 1]]) for k in range(b.num_rows)], pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return tokens.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
