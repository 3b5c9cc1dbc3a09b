"""Packing by power-of-two decomposition (operator 3)."""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import parts, stage
from caudal.llm.tokens import BATCH_BYTES, KEPT_PIECES, cut, piece_table

END_ID = 0


def lengths(n: int, longest: int) -> list[int]:
    """``n`` as powers of two from large to small, none above ``longest`` (itself a power of two)."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, longest: int = 1024, with_ids: bool = False, kept: int = KEPT_PIECES) -> DataFrame:
    """One row per piece: each document's ids (with the end id 0) cut into powers of two.

    A piece is a sequence of its own, so no sequence crosses documents and none needs padding.
    Sequences of one ``length`` form a bucket that is trained on together: ``sequence_id`` counts the longest ones
    first, so a bucket is a range of numbers without gaps.  Pieces are written once, numbered by length within their task;
    one count for each task and length, summed over the tasks, turns these into numbers of the whole, and no piece is shuffled for it.
    ``with_ids`` adds the ids as ``ids array<int>``.
    ``kept`` bounds the pieces of text a worker remembers (memory against time, the result is the same).
    NULL or empty text is the end id alone; repeated rows are packed each by itself; a NULL id
    stays NULL; other columns are never read; an empty table gives an empty result.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    end = array("I", [END_ID]).tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
    names, kinds = [*names, "task", "nth"], [*kinds, pa.int64(), pa.int64()]

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = piece_table(tokenizer_path, True)
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in parts(batches, BATCH_BYTES):
            lists = [cut(tokenizer_path, x or "") for x in batch.column("text").to_pylist()]
            bounds, every = known.batch(lists, kept)
            at, rows = bounds.tolist(), []
            for doc_id, low, high in zip(batch.column("doc_id").to_pylist(), at, at[1:], strict=False):
                ids = every[low:high].tobytes() + end
                n, start = len(ids) // 4, 0
                for length in lengths(n, longest):
                    piece = ids[4 * start : 4 * (start + length)]
                    own = (array("I", piece).tolist(),) if with_ids else ()
                    rows.append((doc_id, start, length, zlib.crc32(piece), n, *own, task, seen[length]))
                    start, seen[length] = start + length, seen[length] + 1
            for i in range(0, len(rows), 20_000):
                columns = zip(*rows[i : i + 20_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if with_ids else "") + ", task long, nth long"
    pieces = stage(rows.mapInArrow(cut_up, schema), "pieces")
    counts = pieces.groupBy("length", "task").agg((F.max("nth") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("length").agg(F.sum("n").alias("n"))  # one row a length
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(F.col("length"), F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("base"))
    firsts = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).join(F.broadcast(bases), "length")
    placed = pieces.join(firsts.select("length", "task", (F.col("base") + F.col("first")).alias("first")), ["length", "task"])
    return placed.select(
        *names[:5], (F.col("first") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *names[5:-2]
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """The pieces (``with_ids``) as one folder per length, ready for batches of equal lengths.

    Rebalanced by length, so that a folder has few files and the bucket of full sequences,
    which holds most ids, is still written by many tasks.  Repeated pieces are written as often as they occur, a NULL id stays NULL,
    and without pieces there is no folder.
    """
    packed.hint("rebalance", "length").write.partitionBy("length").mode("overwrite").parquet(path)
