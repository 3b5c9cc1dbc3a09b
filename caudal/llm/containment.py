"""Benchmark decontamination by size-partitioned MinHash containment search (operator 10)."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import parts
from caudal.llm.rolling import Rolling

#: Characters of items that one pass over the documents looks for; more items take more passes.  The index of a slice takes
#: about 30 bytes a character in every Python worker, 120 MB for a full one.
SLICE_CHARS = 4 << 20
BATCH_BYTES = 1 << 20
SHINGLE = 5
THRESHOLD = 0.8
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_PLAIN = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))


def words(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII punctuation and white space part them."""
    return (text or "").lower().encode("utf-8", "replace").translate(_PLAIN).split()


def _shingles(items: list[bytes], n: int) -> set[bytes]:
    return set(map(b" ".join, zip(*(items[i:] for i in range(n)), strict=False)))


class Index:
    """Items partitioned by their number of shingles (powers of two), each with its bottom-k MinHash sketch.

    A document that holds the share t of an item's n shingles misses at most n - ceil(t n) of them, so it
    holds one of the n - ceil(t n) + 1 that hash lowest: the sketch of that size finds every such document.
    A partition is only searched with documents that have enough shingles for its smallest item.
    """

    def __init__(self, items: list[tuple[int | None, str | None]], n: int, threshold: float):
        self.n, self.threshold = n, threshold
        self.items: list[tuple[int | None, int, frozenset[bytes]]] = []
        found: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        self.needed: dict[tuple[int, int], int] = {}
        hashes = Rolling()
        for item_id, text in items:
            own = words(text)
            width = min(n, len(own))
            if not width:
                continue
            shingles = _shingles(own, width)
            enough = math.ceil(threshold * len(shingles) - 1e-9)
            part = (width, len(shingles).bit_length())
            self.needed[part] = min(self.needed.get(part, enough), enough)
            values = np.sort(hashes.texts(sorted(shingles)))[: len(shingles) - enough + 1]
            found[part] += [(int(x), len(self.items)) for x in values]
            self.items.append((item_id, enough, frozenset(shingles)))
        self.parts = {}
        for part, pairs in found.items():
            pairs.sort()
            values = np.array([x for x, _ in pairs], dtype=np.uint64)
            coarse = np.zeros(1 << 16, dtype=bool)
            coarse[values >> np.uint64(48)] = True
            self.parts[part] = values, np.array([i for _, i in pairs]), coarse

    def search(self, texts: list[list[bytes]], hashes: Rolling) -> Iterator[tuple[int, int, int]]:
        """(row, item, shared shingles) of every item of which a text holds enough."""
        candidates: dict[int, set[int]] = defaultdict(set)
        for width in {w for w, _ in self.parts}:
            values, row, counts = hashes.shingles(texts, width)
            high = values >> np.uint64(48)
            for part, (known, item, coarse) in self.parts.items():
                if part[0] != width:
                    continue
                at = np.flatnonzero(coarse[high])
                at = at[counts[row[at]] >= self.needed[part]]
                first, last = np.searchsorted(known, values[at]), np.searchsorted(known, values[at], "right")
                for k, i, j in zip(at[first < last].tolist(), first[first < last].tolist(), last[first < last].tolist(), strict=True):
                    candidates[int(row[k])].update(item[i:j].tolist())
        for k, some in candidates.items():
            held = {w: _shingles(texts[k], w) for w in {self.width(i) for i in some}}
            for i in sorted(some):
                shared = len(self.items[i][2] & held[self.width(i)])
                if shared >= self.items[i][1]:
                    yield k, i, shared

    def width(self, i: int) -> int:
        return next(iter(self.items[i][2])).count(b" ") + 1


def _slices(items: DataFrame, slice_chars: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """Distinct items in slices of about ``slice_chars`` characters, dealt by hash."""
    own = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    n = math.ceil((own.agg(F.sum(F.length("text"))).first()[0] or 0) / slice_chars)
    for k in range(n):
        rows = own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def find_items(docs: DataFrame, items: DataFrame, n: int = SHINGLE, threshold: float = THRESHOLD, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared, containment``: items whose shingles a document holds to the threshold.

    Items are the query set: slices of bounded size are broadcast and each passes over all documents in one scan
    without a shuffle.  Candidates come from the partitioned sketches; every one is verified on the shingles'
    own text.  An item of m < ``n`` words is one shingle of m words and sought as such; without words it is in
    no document.  NULL text is empty; NULL ids stay NULL; repeated documents give repeated rows, repeated items
    one; other columns are never read; empty tables give an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, n_shingles long, n_shared long, containment double"
    out = rows.where("false").selectExpr("doc_id", "0L AS item_id", "0L AS n_shingles", "0L AS n_shared", "0D AS containment")
    for some in _slices(items, slice_chars):
        shared = docs.sparkSession.sparkContext.broadcast(Index(some, n, threshold))

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, hashes = shared.value, Rolling()
            for batch in parts(batches, BATCH_BYTES):
                ids, found = batch.column("doc_id").to_pylist(), []
                for k, i, both in index.search([words(x) for x in batch.column("text").to_pylist()], hashes):
                    item_id, _, shingles = index.items[i]
                    found.append({"doc_id": ids[k], "item_id": item_id, "n_shingles": len(shingles), "n_shared": both, "containment": both / len(shingles)})
                yield pa.RecordBatch.from_pylist(found, pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shingles", pa.int64()), ("n_shared", pa.int64()), ("containment", pa.float64())]))

        out = out.union(rows.mapInArrow(find, schema))
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, n: int = SHINGLE, threshold: float = THRESHOLD, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """The documents, all columns as they are, that hold no item to the threshold (see :func:`find_items`).

    Each document is judged by its whole text alone: repeated rows stay or go together, NULL or empty text holds no item and
    stays, NULL ids do not matter.  Without items all documents stay; an empty table stays empty; columns of any name are kept.
    """
    for some in _slices(items, slice_chars):
        shared = docs.sparkSession.sparkContext.broadcast(Index(some, n, threshold))

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, hashes = shared.value, Rolling()
            for batch in parts(batches, BATCH_BYTES):
                clean = np.ones(batch.num_rows, dtype=bool)
                for k, _, _ in index.search([words(x) for x in batch.column("text").to_pylist()], hashes):
                    clean[k] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
