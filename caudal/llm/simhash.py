"""SimHash near-dedup with covering locality-sensitive hashing (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import free_name, keyed, parts, row_key, stage, utf8
from caudal.llm.components import components

SEED = 42
#: Fingerprints compared with each other in one piece of work; larger buckets are cut into such blocks.
BLOCK = 2048
#: Buckets up to this size are compared together, by distance in sorted order.
SMALL = 48
BATCH_BYTES = 4 << 20


def fingerprint(text: bytes, shingle: int) -> int:
    """Bit i is 1 if set in over half the hashes of the text's shingles, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        texts = [b" ".join(words)]
    else:
        texts = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), texts), dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 15):
        some = hashes[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``d, t, doc_id, fingerprint`` (as a signed long) of every row; texts stay in their task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, BATCH_BYTES):
            found = pa.array([fingerprint(x, shingle) for x in utf8(batch)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("d"), batch.column("t"), batch.column("doc_id"), found], ["d", "t", "doc_id", "fingerprint"])

    return keyed(docs).mapInArrow(run, "d long, t long, doc_id long, fingerprint long")


def masks(radius: int) -> list[int]:
    """2**(radius + 1) - 1 masks of 64 bits: any two fingerprints within the radius agree under one of them.

    Each bit position gets a nonzero vector of radius + 1 bits.  Mask v holds the positions whose vector has an odd
    product with v.  At most ``radius`` differing positions never span all the vectors, so some v is
    orthogonal to all of them and its mask holds none of them.
    """
    n = 2 ** (radius + 1)
    vectors = [1 + i % (n - 1) for i in range(64)]
    return [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2) for v in range(1, n)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n points and the links a - b, the smallest point reachable from each."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _linked(group: np.ndarray, block: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of sorted rows: every point to the smallest it is connected with there, never all pairs."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    number = np.repeat(np.arange(len(starts)), sizes)
    ends = np.repeat(starts + sizes, sizes)
    small = np.repeat(sizes <= SMALL, sizes)
    a, b, rows = [], [], np.flatnonzero(small)
    for step in range(1, min(SMALL, int(sizes.max(initial=0))) + 1):
        rows = rows[rows + step < ends[rows]]
        near = np.bitwise_count(prints[rows] ^ prints[rows + step]) <= radius
        a.append(rows[near])
        b.append(rows[near] + step)
    label = _smallest(len(group), np.concatenate([*a, rows[:0]]), np.concatenate([*b, rows[:0]]))
    for start, size in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        own, side = prints[start : start + size], block[start : start + size]
        x, y = [], []
        left = np.flatnonzero(side == side.min())
        right = np.flatnonzero(side == side.max())
        for i in range(0, len(left), 256):
            near = np.argwhere(np.bitwise_count(own[left[i : i + 256], None] ^ own[None, right]) <= radius)
            x.append(left[i + near[:, 0]])
            y.append(right[near[:, 1]])
        label[start : start + size] = start + _smallest(size, np.concatenate(x), np.concatenate(y))
    del number
    moved = np.flatnonzero(label != np.arange(len(group)))
    return prints[label[moved]], prints[moved]


def links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """``a, b``: links of distinct fingerprints that connect all within the radius.

    Every table of the cover holds each fingerprint under its masked bits.  Buckets of one are left; a bucket of
    more than ``BLOCK`` is numbered by a window, which spills, and cut into blocks; each pair of blocks is compared by
    itself, so no task compares a bucket.  A comparison gives one link per point, to the smallest it is connected with.
    """
    cover = [_signed(m) for m in masks(radius)]
    tables = F.array(*[F.struct(F.lit(k).alias("k"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("bits")) for k, m in enumerate(cover)])
    held = prints.select("fingerprint", F.explode(tables).alias("at")).select("at.k", "at.bits", "fingerprint")
    bucket = Window.partitionBy("k", "bits")
    counted = held.withColumn("n", F.count(F.lit(1)).over(bucket)).where("n > 1")
    placed = counted.withColumn("block", F.floor((F.row_number().over(bucket.orderBy("fingerprint")) - 1) / BLOCK).cast("int"))
    last = F.floor((F.col("n") - 1) / BLOCK).cast("int")
    other = F.explode(F.sequence(F.lit(0), last))
    paired = placed.select("k", "bits", "fingerprint", "block", other.alias("other")).select(
        F.xxhash64("k", "bits", F.least("block", "other"), F.greatest("block", "other")).alias("work"), "block", "fingerprint"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> pa.RecordBatch:
            group, block = table["work"].to_numpy(), table["block"].to_numpy()
            x, y = _linked(group, block, table["fingerprint"].to_numpy().view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

        for batch in batches:
            rest.append(batch)
            work = batch.column("work").to_numpy()
            if len(work) and work[0] != work[-1]:
                at = int(np.searchsorted(work, work[-1]))
                yield done(pa.Table.from_batches([*rest[:-1], batch.slice(0, at)]))
                rest = [batch.slice(at)]
        if rest and sum(x.num_rows for x in rest):
            yield done(pa.Table.from_batches(rest))

    return paired.repartition("work").sortWithinPartitions("work", "block", "fingerprint").mapInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``d, t, doc_id, fingerprint, component_id, root``: documents joined through fingerprints at most ``radius`` bits apart.

    ``component_id`` is the smallest id reachable, the document's own included.  Components may share it (NULL ids, or
    several texts under one id); ``root``, the smallest fingerprint of the component, tells them apart.  Exact copies share a
    fingerprint and are folded before any comparison.  No words or NULL text: fingerprint zero, linked like
    any other.  Fewer words than a shingle: the whole sequence is the one shingle.  NULL ids are never the
    smallest unless the component has no other (then the result is NULL).  Repeated rows keep one result each; other
    columns are never read; an empty table gives an empty result.
    """
    marked = stage(fingerprints(docs, shingle), "fingerprints")
    prints = stage(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    roots = components(links(prints.select("fingerprint"), radius))
    rooted = prints.join(roots, prints["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "low", F.coalesce("root", "fingerprint").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select("fingerprint", "component_id", "root")
    return marked.join(named, "fingerprint").select("d", "t", "doc_id", "fingerprint", "component_id", "root")


def representatives(found: DataFrame) -> DataFrame:
    """``d, t``: the one document of each component that stays, the smallest id (then text hash)."""
    return found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "d", "t")).alias("one")).select("one.d", "one.t")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """The documents, all columns as they are, with one row of each component (see :func:`near_duplicates`).

    Components that share their smallest id, or have none, each keep one.
    The one of smallest id (NULL last), then text hash, stays; of rows equal in both, the first by the other columns.
    """
    key = row_key(docs)
    one = representatives(near_duplicates(docs, shingle, radius)).select(*[F.col(c).alias(n) for c, n in zip("dt", key, strict=True)])
    nth = free_name([*docs.columns, *key], "nth")
    order = [F.col(f.name) for f in docs.schema.fields if f.dataType.typeName() != "map"]
    same = Window.partitionBy(*key).orderBy(*order)
    return docs.withColumns(key).join(one, list(key)).withColumn(nth, F.row_number().over(same)).where(F.col(nth) == 1).select(*docs.columns)
