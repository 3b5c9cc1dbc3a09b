"""Repeated byte windows by depth-limited radix sort of sparse suffixes (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import keyed, parts, stage, utf8
from caudal.llm.rolling import Rolling, mix

BATCH_BYTES = 8 << 20
#: Bytes hashed at once; places in such a chunk fit the low bits of a packed word.
CHUNK_BITS = 20
_PLACE = np.uint64((1 << CHUNK_BITS) - 1)


def gram_bytes(depth: int) -> int:
    """The first digit: about a third of the depth, so a window holds many candidates for its anchor."""
    return max(1, depth // 3)


def anchors(data: np.ndarray, bounds: np.ndarray, depth: int, hashes: Rolling) -> Iterator[dict[str, np.ndarray]]:
    """Runs of windows with the same anchor, by chunk of the joined texts that ``bounds`` delimits.

    The anchor of a window is its gram of lowest hash, the leftmost of equals: equal windows have it at the same
    offset.  A run is a maximal row of windows of one text with one anchor.  Digits of a run: ``a`` the anchor
    itself, ``whole`` all bytes of the run's windows and the anchor's offset, ``left`` and ``right`` the anchor
    with the bytes half-way out to the depth (0 where the run has no such window).
    """
    gram = gram_bytes(depth)
    room = depth - gram  # bytes of a window beside its anchor
    half = (room + 1) // 2
    step = (1 << CHUNK_BITS) - depth
    for low in range(0, max(0, len(data) - depth + 1), step):
        part = data[low : low + step + depth - 1]
        sums = hashes.sums(part)
        grams = hashes.windows(sums, gram)
        least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        span = 1
        while 2 * span <= room + 1:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < room + 1:
            more = room + 1 - span
            least = np.minimum(least[:-more], least[more:])
        # Window starts of this chunk, cut at the ends of texts.
        first = max(0, int(np.searchsorted(bounds, low, "right")) - 1)
        last = int(np.searchsorted(bounds, low + len(part)))
        edge = np.zeros(len(part) + 1, dtype=np.int64)
        starts = np.clip(bounds[first:last] - low, 0, len(part))
        ends = np.clip(bounds[first + 1 : last + 1] - low - depth + 1, starts, len(part))
        np.add.at(edge, starts, 1)
        np.add.at(edge, ends, -1)
        valid = np.flatnonzero(np.cumsum(edge)[: len(least)] > 0)
        if not len(valid):
            continue
        at = (least[valid] & _PLACE).astype(np.int64)
        new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)])
        s1, s2, at = valid[new], valid[np.r_[new[1:] - 1, len(valid) - 1]], at[new]
        whole = hashes.spans(sums, s1, s2 + depth)
        whole = mix(whole ^ ((at - s1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        has_left, has_right = at - s1 >= half, at - s2 <= half
        left = np.where(has_left, hashes.spans(sums, np.where(has_left, at - half, at), at + gram), np.uint64(0))
        right = np.where(has_right, hashes.spans(sums, at, np.where(has_right, np.minimum(at + gram + room - half, len(part)), at + gram)), np.uint64(0))
        doc = np.searchsorted(bounds, low + s1, "right") - 1
        yield {"doc": doc, "s1": low + s1 - bounds[doc], "s2": low + s2 - bounds[doc], "at": low + at - bounds[doc], "a": grams[at], "whole": whole, "left": left, "right": right}


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(x) for x in texts], out=bounds[1:])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), bounds


def _merged(starts: np.ndarray, ends: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals in order joined where they meet; ``apart`` tells texts.  (first row, start, end) of each."""
    if not len(starts):
        return np.zeros(0, dtype=np.int64), starts, ends
    reach = ends.copy()
    new = np.r_[True, (apart[1:] != apart[:-1]) | (starts[1:] > reach[:-1])]
    first = np.flatnonzero(new)
    return first, starts[first], np.maximum.reduceat(ends, first)


def _u64(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _runs(depth: int):
    """All runs of a task; those whose windows an earlier text of the same batch has are already decided (kind 0)."""
    names = ["kind", "d", "t", "start", "end", "at", "a", "whole", "digits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Rolling()
        for batch in parts(batches, BATCH_BYTES):
            d, t, texts = batch.column("d").to_numpy(), batch.column("t").to_numpy(), utf8(batch)
            order = np.lexsort((t, d))
            order = order[np.r_[True, (d[order][1:] != d[order][:-1]) | (t[order][1:] != t[order][:-1])]] if len(order) else order
            d, t = d[order], t[order]
            found = list(anchors(*_joined([texts[i] for i in order]), depth, hashes))
            if not found:
                continue
            r = {k: np.concatenate([x[k] for x in found]) for k in found[0]}
            _, firsts = np.unique(r["whole"], return_index=True)
            is_first = np.zeros(len(r["whole"]), dtype=bool)
            is_first[firsts] = True
            seen, one = np.flatnonzero(~is_first), np.flatnonzero(is_first)
            row, start, end = _merged(r["s1"][seen], r["s2"][seen] + depth, r["doc"][seen])
            doc, none = r["doc"][seen][row], np.zeros(len(row), dtype=np.int64)
            place = mix(mix(t[doc].view(np.uint64)) ^ start.astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(none.astype(np.int8)), pa.array(d[doc]), pa.array(t[doc]), pa.array(start), pa.array(end), pa.array(none), _u64(place), pa.array(none), pa.array(none)], names)
            doc = r["doc"][one]
            digits = (r["left"][one] & np.uint64(0xFFFFFFFF00000000)) | (r["right"][one] >> np.uint64(32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(one), dtype=np.int8)), pa.array(d[doc]), pa.array(t[doc]), pa.array(r["s1"][one]), pa.array(r["s2"][one] + depth), pa.array(r["at"][one]), _u64(r["a"][one]), _u64(r["whole"][one]), _u64(digits)],
                names,
            )

    return run


def _window_hashes(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = Rolling(1), Rolling(2)
        for batch in parts(batches, BATCH_BYTES):
            ids = zip(batch.column("d").to_pylist(), batch.column("t").to_pylist(), utf8(batch), batch.column("spans").to_pylist(), strict=True)
            for d, t, text, spans in ids:
                starts = np.unique(np.concatenate([np.arange(x["lo"], x["hi"] + 1) for x in spans]))
                data = np.frombuffer(text, dtype=np.uint8)
                x, y = (h.spans(h.sums(data), starts, starts + depth) for h in (one, two))
                n = len(starts)
                yield pa.RecordBatch.from_arrays([_u64(x), _u64(y), pa.array(np.full(n, d)), pa.array(np.full(n, t)), pa.array(starts)], ["x", "y", "d", "t", "start"])

    return run


def repeated_spans(docs: DataFrame, depth: int = 100) -> DataFrame:
    """``d, t, start, end``: byte spans whose windows of ``depth`` bytes all start earlier too.

    Sparse suffixes stand for all: each window is ordered at its anchor.  Most-significant-digit passes:
    1. the anchor; runs equal in all bytes are decided at once, all but the first are repeats;
    2. firsts of groups that still differ: the anchor with the bytes half-way out, left and right;
    3. the windows of runs that still share a digit, through the full depth: equal groups are the repeated windows.
    Groups of one leave after every pass.  Copies within a scan task are folded before the first shuffle.
    """
    rows = keyed(docs)
    gram = gram_bytes(depth)
    half = (depth - gram + 1) // 2
    runs = rows.select("d", "t", "text").mapInArrow(
        _runs(depth), "kind byte, d long, t long, start long, end long, at long, a long, whole long, digits long"
    )
    group = Window.partitionBy("kind", "a")
    place = ["d", "t", "start"]
    first = stage(
        runs.withColumn("nth", F.rank().over(Window.partitionBy("kind", "a", "whole").orderBy(*place)))
        .withColumn("differ", F.min("whole").over(group) != F.max("whole").over(group))
        .where("kind = 0 OR nth > 1 OR differ"),
        "suffix-runs",
    )
    done = first.where("kind = 0 OR nth > 1").select("d", "t", "start", "end")
    open_runs = first.where("kind = 1 AND nth = 1").select("a", "d", "t", "start", (F.col("end") - depth).alias("stop"), "at", "digits")
    left, right = F.shiftrightunsigned("digits", 32), F.col("digits").bitwiseAND(F.lit(0xFFFFFFFF))
    edge = F.col("at") - half
    sides = F.array(
        F.struct(F.lit(0).alias("side"), left.alias("digit"), F.col("start").alias("lo"), F.least("stop", edge).alias("hi")),
        F.struct(F.lit(1).alias("side"), right.alias("digit"), F.greatest("start", edge).alias("lo"), F.col("stop").alias("hi")),
    )
    halves = open_runs.select("a", "d", "t", F.explode(sides).alias("s")).select("a", "d", "t", "s.*").where("lo <= hi")
    kept = halves.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("a", "side", "digit"))).where("n > 1")
    wanted = kept.groupBy("d", "t").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    windows = rows.join(wanted, ["d", "t"]).select("d", "t", "doc_id", "text", "spans").mapInArrow(
        _window_hashes(depth), "x long, y long, d long, t long, start long"
    )
    again = windows.withColumn("nth", F.rank().over(Window.partitionBy("x", "y").orderBy(*place))).where("nth > 1")
    return done.union(again.select("d", "t", "start", (F.col("start") + depth).alias("end")))


def cut_repeats(docs: DataFrame, depth: int = 100) -> DataFrame:
    """``doc_id, kept, n_bytes, n_spans`` per row: ``kept`` (binary) has the bytes that no earlier window covers.

    A byte goes if a ``depth``-byte string over it also starts earlier: in a smaller id (NULL before all, then text
    hash), or earlier in the same document; strings are judged on the input.  Matches never cross documents; texts are UTF-8
    bytes, so what is left may not be text.  NULL text is empty and keeps nothing; rows equal in id and text are one
    document and get the same result each; other columns are never read; an empty table gives an empty result.
    """
    rows = keyed(docs)
    spans = repeated_spans(docs, depth).groupBy("d", "t").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, BATCH_BYTES):
            kept, n_bytes, n_spans = [], [], []
            for text, found in zip(utf8(batch), batch.column("spans").to_pylist(), strict=True):
                n_bytes.append(len(text))
                pairs = np.array(sorted((x["start"], x["end"]) for x in found or ()), dtype=np.int64).reshape(-1, 2)
                ends = np.maximum.accumulate(pairs[:, 1]) if len(pairs) else pairs[:, 1]
                _, starts, ends = _merged(pairs[:, 0], ends, np.zeros(len(pairs)))
                n_spans.append(len(starts))
                edges = [0, *np.stack([starts, ends], axis=1).ravel().tolist(), len(text)]
                kept.append(b"".join(text[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.binary()), pa.array(n_bytes, pa.int64()), pa.array(n_spans, pa.int64())], ["doc_id", "kept", "n_bytes", "n_spans"])

    found = rows.join(spans, ["d", "t"], "left").select("d", "t", "doc_id", "text", "spans")
    return found.select("doc_id", "text", "spans").mapInArrow(cut, "doc_id long, kept binary, n_bytes long, n_spans long")


def digest_columns(kept: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of :func:`cut_repeats`."""
    return kept.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
