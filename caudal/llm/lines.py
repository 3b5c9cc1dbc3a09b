"""Line dedup with two Bloom filters, once seen and twice seen (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import free_name, keyed, parts, row_key, stage, utf8

#: Bits of each Bloom filter.  What is broadcast has this fixed size (16 MB) whatever the input; a
#: fuller filter only lets more lines through to the exact count.  Raise it with the corpus, to 2**32 at most.
FILTER_BITS = 1 << 27
#: Filters are built and merged by segments of this many bits.
SEGMENT_BITS = 1 << 21
#: Rows merged by one task: filters of so many scan tasks, then so many merged ones.
MERGED = 128
SPACE = b" \t\n\x0b\x0c\r"
BATCH_BYTES = 8 << 20


def _digests(text: bytes, min_chars: int) -> list[bytes]:
    """A 128-bit digest per line's key; empty bytes for a key of fewer than ``min_chars`` code points."""
    keys = [line.strip(SPACE).lower() for line in text.split(b"\n")]
    return [xxhash.xxh3_128_digest(x) if x and (min_chars < 2 or len(x.decode()) >= min_chars) else b"" for x in keys]


def _bits(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two probes of digests given as unsigned longs."""
    last = np.uint64(FILTER_BITS - 1)
    return (digests & last).astype(np.int64), ((digests >> np.uint64(32)) & last).astype(np.int64)


def _longs(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8")[::2]


def _written(places: np.ndarray) -> bytes:
    """Bit places of a segment: as a list while they are few, else as a bitmap."""
    if len(places) < SEGMENT_BITS // 32:
        return b"L" + places.astype("<u4").tobytes()
    held = np.zeros(SEGMENT_BITS, dtype=np.uint8)
    held[places] = 1
    return b"B" + np.packbits(held).tobytes()


def _read(written: bytes) -> np.ndarray:
    if written[:1] == b"B":
        return np.frombuffer(written, dtype=np.uint8, offset=1)
    held = np.zeros(SEGMENT_BITS, dtype=np.uint8)
    held[np.frombuffer(written, dtype="<u4", offset=1)] = 1
    return np.packbits(held)


def _build(min_chars: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.zeros(0, dtype=np.uint64)]
        for batch in parts(batches, BATCH_BYTES):
            found = [x for text in utf8(batch) for x in {*_digests(text, min_chars)} if x]
            seen.append(_longs(found))
        lines, counts = np.unique(np.concatenate(seen), return_counts=True)
        once = np.unique(np.concatenate(_bits(lines)))
        twice = np.unique(np.concatenate(_bits(lines[counts > 1])))
        task = TaskContext.get().partitionId()
        for k in np.unique(once // SEGMENT_BITS).tolist():
            one, two = (x[np.searchsorted(x, k * SEGMENT_BITS) : np.searchsorted(x, (k + 1) * SEGMENT_BITS)] - k * SEGMENT_BITS for x in (once, twice))
            yield pa.RecordBatch.from_pydict({"segment": [k], "task": pa.array([task], pa.int64()), "once": [_written(one)], "twice": [_written(two)]})

    return build


def _merged(frame: DataFrame, group: F.Column | int) -> DataFrame:
    """Filters merged: once is the union, twice the union of all twices and of what two onces share."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        once = twice = np.zeros(SEGMENT_BITS // 8, dtype=np.uint8)
        for a, b in zip(rows["once"], rows["twice"], strict=True):
            one, two = _read(a), _read(b)
            twice, once = twice | two | (once & one), once | one
        written = [b"B" + x.tobytes() for x in (once, twice)]
        return pd.DataFrame({"segment": rows["segment"][:1], "task": rows["task"][:1], "once": written[:1], "twice": written[1:]})

    keyed_rows = frame.withColumn("task", group)
    return keyed_rows.groupBy("segment", "task").applyInPandas(merge, "segment long, task long, once binary, twice binary")


def twice_seen(texts: DataFrame, min_chars: int) -> bytes:
    """The filter of keys that two or more documents may share, ``FILTER_BITS`` / 8 bytes long.

    Every scan task folds its documents into a pair of filters; pairs are merged in two steps by segment.
    """
    pairs = texts.mapInArrow(_build(min_chars), "segment long, task long, once binary, twice binary")
    merged = _merged(_merged(pairs, F.floor(F.col("task") / MERGED)), F.lit(0).cast("long"))
    held = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in merged.select("segment", "twice").toLocalIterator():
        at = row.segment * SEGMENT_BITS // 8
        held[at : at + SEGMENT_BITS // 8] = _read(bytes(row.twice))
    return held.tobytes()


def repeated_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none") -> DataFrame:
    """``d, t, lines``: per document the digests of its lines to drop, and whether its first one stays.

    ``keep="first"`` leaves the first line of the first document (smallest id, NULL first, then text hash).
    """
    if keep not in ("none", "first"):
        raise ValueError("keep must be none or first")
    rows = keyed(docs).select("d", "t", "text")
    shared = docs.sparkSession.sparkContext.broadcast(twice_seen(rows.select("text"), min_chars))

    def suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in parts(batches, BATCH_BYTES):
            found = [[x for x in {*_digests(text, min_chars)} if x] for text in utf8(batch)]
            flat = [x for lines in found for x in lines]
            row = np.repeat(np.arange(len(found)), [len(x) for x in found])
            likely = np.ones(len(flat), dtype=bool)
            for bit in _bits(_longs(flat)):
                likely &= (held[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1).astype(bool)
            at = np.flatnonzero(likely)
            row = pa.array(row[at])
            yield pa.RecordBatch.from_arrays([batch.column("d").take(row), batch.column("t").take(row), pa.array([flat[i] for i in at], pa.binary())], ["d", "t", "line"])

    suspects = stage(rows.mapInArrow(suspected, "d long, t long, line binary"), "suspected-lines")
    counted = suspects.groupBy("line").agg(F.count_distinct("d", "t").alias("n"), F.min(F.struct("d", "t")).alias("first")).where(F.col("n") >= min_docs)
    # As a table of its own, so that a line of very many documents is split where the suspects join it.
    confirmed = stage(counted, "repeated-lines")
    first = (F.struct("d", "t") == F.col("first")) if keep == "first" else F.lit(False)
    hits = suspects.join(confirmed, "line").select("d", "t", F.struct("line", first.alias("stays")).alias("hit"))
    return hits.groupBy("d", "t").agg(F.collect_set("hit").alias("lines"))


def _left_over(text: bytes, hits: list[dict] | None, min_chars: int) -> tuple[bytes, int, int]:
    """The text without the lines hit, its lines before, and the lines dropped."""
    n = text.count(b"\n") + 1
    if not hits:
        return text, n, 0
    stays = {x["line"]: x["stays"] for x in hits}
    left = []
    for line, digest in zip(text.split(b"\n"), _digests(text, min_chars), strict=True):
        if digest not in stays or stays[digest]:
            left.append(line)
            if digest in stays:
                stays[digest] = False
    return b"\n".join(left), n, n - len(left)


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none") -> DataFrame:
    """``d, t, doc_id, text, n_lines, n_dropped`` with the text left over.

    A line's key is the line without ASCII white space at its ends, ASCII letters lower-cased.  Keys
    of at least ``min_chars`` code points in at least ``min_docs`` documents lose their lines.  The
    twice-seen filter keeps all other lines out of the shuffle; what passes it is counted exactly by
    128-bit digests, with partial counts before the shuffle.
    NULL or empty text is one empty line, which is never dropped; NULL ids count as ids; rows equal
    in id and text are one document to the count and get the same result each; other columns are
    never read; an empty table gives an empty result.
    """
    rows = keyed(docs)
    found = rows.join(repeated_lines(docs, min_docs, min_chars, keep), ["d", "t"], "left")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, BATCH_BYTES):
            found = [_left_over(text, hits, min_chars) for text, hits in zip(utf8(batch), batch.column("lines").to_pylist(), strict=True)]
            texts, n_lines, n_dropped = ([x[i] for x in found] for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), batch.column("t"), batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                ["d", "t", "doc_id", "text", "n_lines", "n_dropped"],
            )

    return found.select("d", "t", "doc_id", "text", "lines").mapInArrow(drop, "d long, t long, doc_id long, text string, n_lines long, n_dropped long")


def digest_columns(kept: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of :func:`dedup_lines`."""
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def replace_texts(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none") -> DataFrame:
    """The documents with the text of :func:`dedup_lines`, and ``n_chars`` (if there is one) counted anew.

    NULL text becomes empty; all other columns and all rows stay.
    """
    key = row_key(docs)
    hits = free_name([*docs.columns, *key], "lines")
    found = docs.withColumns(key).join(
        repeated_lines(docs, min_docs, min_chars, keep).select(*[F.col(c).alias(n) for c, n in zip("dt", key, strict=True)], F.col("lines").alias(hits)),
        list(key), "left",
    )
    names, kinds = docs.columns, docs.schema
    at, length = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, BATCH_BYTES):
            pairs = zip(utf8(batch), batch.column(hits).to_pylist(), strict=True)
            texts = pa.array([_left_over(text, hit, min_chars)[0] for text, hit in pairs], pa.binary()).cast(pa.string())
            columns = [batch.column(n) for n in names]
            columns[at] = texts
            if length is not None:
                columns[length] = pa.compute.utf8_length(texts).cast(columns[length].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return found.select(*names, hits).mapInArrow(replace, kinds)
