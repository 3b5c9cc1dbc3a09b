"""Periodic runs of words by seed and extend on diagonals (operator 11)."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import parts, utf8
from caudal.llm.rolling import mix

BATCH_BYTES = 4 << 20
#: Words compared at once when a seed is extended, at first and at most.
STEP, LONGEST_STEP = 64, 1 << 16
_ODD = np.uint64(0x9E3779B97F4A7C15)
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def seed_words(least: int) -> int:
    """Words of the narrowest seed: the largest power of two that every run of a lag up to it is sure to match in a row.

    A run of period q and length max(least, 3 q) or more matches itself q words on over max(least - q, 2 q) words.
    """
    return 1 << max(1, 2 * least // 3).bit_length() - 1


def _reach(words: np.ndarray, at: int, lag: int, stop: int) -> int:
    """The first place from ``at`` on where a word differs from the one ``lag`` later, ``stop - lag`` at most."""
    step = STEP
    while at + lag < stop:
        end = min(at + step, stop - lag)
        differ = words[at:end] != words[at + lag : end + lag]
        if differ.any():
            return at + int(differ.argmax())
        at, step = end, min(4 * step, LONGEST_STEP)
    return at


def _reach_back(words: np.ndarray, at: int, lag: int, start: int) -> int:
    """The first place of the row of matches that ends before ``at``."""
    step = STEP
    while at > start:
        low = max(start, at - step)
        differ = words[low:at] != words[low + lag : at + lag]
        if differ.any():
            return at - int(differ[::-1].argmax())
        at, step = low, min(4 * step, LONGEST_STEP)
    return at


def _seeds(words: np.ndarray, bounds: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(place, lag)`` of grams that occur again ``lag`` words on in the same text, by gram width k.

    Width k serves the lags above k / 2 (the narrowest: all lags) up to k.  A run of such a smallest period q holds at
    least one pair of equal k-grams q apart, and as k >= q no equal gram lies between (else the run had a shorter
    period), so pairs of *next* occurrences are enough: a gram that occurs m times gives m - 1 pairs, not m * m.
    A gram that is alone in its text is left out of all wider passes.
    """
    n = len(words)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    stop = bounds[1:][text]
    salt = mix(text.astype(np.uint64) * _ODD)
    longest = int(np.diff(bounds).max(initial=0)) // times
    hashes, width, narrowest = mix(words.astype(np.uint64) + _ODD), 1, seed_words(least)
    open_at = np.arange(n)
    while True:
        open_at = open_at[open_at + width <= stop[open_at]]
        if width >= narrowest:
            # Bucket counts first: most grams stand alone and are never sorted.
            keys = mix(hashes[open_at] ^ salt[open_at])
            bits = max(4, (4 * len(keys)).bit_length())
            bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
            shared = np.bincount(bucket, minlength=1)[bucket] > 1
            keys, places = keys[shared], open_at[shared]
            order = np.argsort(keys, kind="stable")
            keys, places = keys[order], places[order]
            same = keys[1:] == keys[:-1]
            lag = places[1:] - places[:-1]
            wanted = same & (lag <= width) & ((lag > width // 2) | (width == narrowest))
            yield places[:-1][wanted], lag[wanted]
            again = np.zeros(len(keys), dtype=bool)
            again[1:] |= same
            again[:-1] |= same
            open_at = np.sort(places[again])
        if width >= max(longest, narrowest) or not len(open_at):
            return
        # A wider gram occurs again only where both of its halves do.
        held = np.zeros(n + width, dtype=bool)
        held[open_at] = True
        open_at = open_at[held[open_at + width]]
        hashes[open_at] = mix(hashes[open_at] * _ODD + hashes[open_at + width])
        width *= 2


def periodic_runs(words: np.ndarray, bounds: np.ndarray, least: int, times: int) -> np.ndarray:
    """Rows (text, start, length, period) by text, start and period; ``bounds`` delimits the texts in ``words``.

    Seeds of one diagonal (lag) are taken in order of place.  A seed below the lag's furthest covered place belongs to
    a stretch already extended and is passed over, so every diagonal is gone along once.
    """
    found: list[tuple[int, int, int, int]] = []
    for places, lags in _seeds(words, bounds, least, times):
        order = np.lexsort((places, lags))
        places, lags = places[order], lags[order]
        # Seeds in a row lie on one stretch: the first stands for them.
        head = np.flatnonzero(np.r_[True, (lags[1:] != lags[:-1]) | (places[1:] != places[:-1] + 1)]) if len(places) else []
        covered: dict[int, int] = defaultdict(int)
        texts = np.searchsorted(bounds, places[head], "right") - 1
        for at, lag, text in zip(places[head].tolist(), lags[head].tolist(), texts.tolist(), strict=True):
            if at < covered[lag]:
                continue
            first, stop = int(bounds[text]), int(bounds[text + 1])
            start, end = _reach_back(words, at, lag, first), _reach(words, at, lag, stop)
            covered[lag] = end
            length = end + lag - start
            if length >= max(least, times * lag):
                found.append((text, start - first, length, lag))
    rows = np.array(sorted(found), dtype=np.int64).reshape(-1, 4)
    # A multiple of the period gives the same stretch again: the smallest one stays.
    one = np.r_[True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1)] if len(rows) else np.zeros(0, dtype=bool)
    rows = rows[one]
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _find(least: int, times: int):
    kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, BATCH_BYTES):
            texts = [x.split() for x in utf8(batch)]
            bounds = np.zeros(len(texts) + 1, dtype=np.int64)
            np.cumsum([len(x) for x in texts], out=bounds[1:])
            number: dict[bytes, int] = defaultdict()
            number.default_factory = number.__len__
            words = np.fromiter((i for x in texts for i in map(number.__getitem__, x)), dtype=np.int64, count=int(bounds[-1]))
            rows = periodic_runs(words, bounds, least, times)
            cuts = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
            runs, collapsed = [], []
            for i, text in enumerate(texts):
                own = rows[cuts[i] : cuts[i + 1], 1:]
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own.tolist()])
                if len(own):
                    edge = np.zeros(len(text) + 1, dtype=np.int64)
                    np.add.at(edge, own[:, 0] + own[:, 2], 1)
                    np.add.at(edge, own[:, 0] + own[:, 1], -1)
                    text = [text[j] for j in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist()]
                collapsed.append(b" ".join(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(bounds)), pa.array(runs, kind), pa.array(collapsed, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return find


def find_runs(docs: DataFrame, least: int = 24, times: int = 3) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` per row: the periodic stretches of the text, and the text without their repeats.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  A run is a stretch of smallest period q (words q apart are equal)
    of max(least, times * q) words or more that no neighbouring word extends; ``runs`` holds start, length and period by
    start, then period.  ``collapsed`` joins by one space the words that no run holds beyond its first q.

    Texts do not meet, so nothing is shuffled; a text is worked on whole, in n log n for n words whatever repeats in it,
    at about 100 bytes a word, and short texts are taken together.
    NULL and empty texts (or texts of white space) have no run and collapse to the empty text; repeated rows get the
    same result each; a NULL id stays NULL; other columns are never read; an empty table gives an empty result.
    """
    if least < 1 or times < 3:
        raise ValueError("least must be 1 or more, times 3 or more")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.mapInArrow(_find(least, times), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def digest_columns(found: DataFrame) -> DataFrame:
    """Of :func:`find_runs`: number of runs, the one of greatest length / period (then smallest start, then period), digests."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    longer = lambda a, x: x["length"] * a["period"] > a["length"] * x["period"]
    best = F.reduce("runs", none, lambda a, x: F.when(a.isNull() | longer(a, x), x).otherwise(a))
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    rows = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: one document in ten (by crc32 of its id) repeats a stretch of its words to its end.

    With h the crc32, g = h / 10 and n words, words from a = g % n on repeat with period 1 + (n - a) / (3 + g % 8).
    """
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    rows = rows.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)) + 1)
    again = F.transform(
        "words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    )
    return rows.select("doc_id", F.when(F.col("p").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))
