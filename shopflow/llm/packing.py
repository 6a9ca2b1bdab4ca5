"""Packing: concatenate and cut.

Pass one writes every document's ids with their place inside the task's part
and adds the token totals of the parts; their prefix sums are the global
offsets.  Pass two cuts the concatenation at every multiple of the window:
a document yields one piece per window it touches.  A window that straddles
two documents or two parts is the pieces (boundary records) that carry its
``sequence_id``, in order of ``offset``.  Only the last sequence can be short.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm.byte_tokens import byte_tokens
from shopflow.llm.token_store import crc, ids_of, part_offsets, read_tokens, write_tokens

WINDOW = 2048
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def cut(first: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of documents at [first, first + n): row, start in the document,
    length, sequence, offset in it."""
    lo, hi = first // window, (first + n - 1) // window
    per = np.where(n > 0, hi - lo + 1, 0)
    row = np.repeat(np.arange(len(n)), per)
    seq = lo[row] + np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    begin = np.maximum(seq * window, first[row])
    stop = np.minimum((seq + 1) * window, first[row] + n[row])
    return row, begin - first[row], stop - begin, seq, begin - seq * window


def pieces(spark: SparkSession, path: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    tokens = read_tokens(spark, path)
    offsets = part_offsets(tokens)

    def run(batches):
        byte_tokens.cache_clear()   # this worker may have encoded in pass one: let go of what it holds
        for b in batches:
            flat, o = ids_of(b.column("ids"))
            n = b.column("n_tokens").to_numpy()
            first = b.column("local_start").to_numpy() + np.array(
                [offsets[p] for p in b.column("part").to_pylist()], np.int64)
            row, start, length, seq, at = cut(first, n, window)
            part = [flat[o[r] + s:o[r] + s + k] for r, s, k in zip(row, start, length, strict=True)]
            cols = [b.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length),
                    pa.array([crc(p) for p in part], pa.int64()), pa.array(n[row]), pa.array(seq), pa.array(at)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                cols.append(pa.array([p.tolist() for p in part], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return tokens.mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, end: int, window: int = WINDOW,
         with_ids: bool = False) -> DataFrame:
    """The pieces of every document (null text: empty, the end id alone).
    Rows with equal or null doc_id are each packed; an empty table packs to
    nothing."""
    return pieces(spark, write_tokens(spark, docs, tokenizer, end), window, with_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """The id sequences of ``pack(..., with_ids=True)``: a group holds one
    window at most."""
    placed = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(placed, lambda x: x["ids"])).alias("ids"))
