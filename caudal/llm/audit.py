"""Filter interaction audit by truth-table survival words (operator 12)."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import parts, utf8

LETTERS = "ABCDE"
SUBSETS = 1 << len(LETTERS)
BATCH_BYTES = 8 << 20
CAPITALS = bytes(range(65, 91))
SIGNS = b"#$%&*|"
#: Rows without an id are spread over so many join keys; none of them matches a label.
SPREAD = 997
#: Word of every failure mask: bit s is set if a document that fails these filters survives the subset s of filters.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not failed & s) for failed in range(SUBSETS)], dtype=np.uint32)


def failed_filters(text: bytes, n_chars: int) -> int:
    """Bits 0 to 3: under 200 words; under half of them distinct; over 3 % capitals; holds a sign."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        (len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1 | (100 * capitals > 3 * n_chars) << 2
        | (len(text.translate(None, SIGNS)) < len(text)) << 3
    )


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches, BATCH_BYTES):
        texts, chars = utf8(batch), pa.compute.utf8_length(batch.column("text")).to_pylist()
        failed = [failed_filters(x, n) for x, n in zip(texts, chars, strict=True)]
        digests = [hashlib.sha256(x).digest() for x in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(failed, pa.int32()), pa.array(digests, pa.binary())],
            ["doc_id", "part", "failed", "digest"],
        )


def judged(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``part, failed, good, toxic, n``: how many documents of a part and labels fail the same filters.

    Bit 4 of ``failed`` is set for a document whose whole text a smaller id has too.  Copies are not joined with their
    first: documents of one text are folded per task to a row for each part and label, with the smallest id and
    the number of rows that have it, so that a hot text arrives as a few rows and only these are compared.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).mapInArrow(_judge, "doc_id long, part string, failed int, digest binary")
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    nobody = F.when(F.col("doc_id").isNull(), 1 + F.monotonically_increasing_id() % SPREAD).otherwise(0)
    rows = rows.withColumn("spread", nobody).withColumn("label_id", F.coalesce("doc_id", F.lit(0).cast("long")))
    labelled = rows.join(said.withColumn("spread", F.lit(0).cast("long")), ["label_id", "spread"], "left")
    group = ["digest", "part", "failed", "good", "toxic"]
    flags = [F.coalesce(x, F.lit(False)).alias(x) for x in ("good", "toxic")]
    same = labelled.select("doc_id", "spread", *group[:3], *flags).groupBy("doc_id", "spread", *group).agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    folded = same.groupBy(*group).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"), first.alias("first")
    )
    least = F.min("first.doc_id").over(Window.partitionBy("digest"))
    firsts = F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = folded.withColumn("least", least).withColumn("kept", F.col("unnamed") + firsts)
    copy = F.col("failed").bitwiseOR(F.lit(1 << LETTERS.index("E")))
    both = F.array(F.struct("failed", F.col("kept").alias("n")), F.struct(copy.alias("failed"), (F.col("n") - F.col("kept")).alias("n")))
    return split.select("part", "good", "toxic", F.inline(both)).where("n > 0")


def positional_counts(words: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """How often each of the 32 bits is set, a word counted ``weights`` times: carry-save adders over whole words.

    A word enters the level of every set bit of its weight.  Three words of a level give a sum that stays and
    a carry for the next level, until at most two words a level are left to be read bit by bit.
    """
    counts, level, carried = np.zeros(32, dtype=np.int64), 0, np.zeros(0, dtype=np.uint32)
    while len(carried) or (weights >> level).any():
        held, carries = np.concatenate([carried, words[(weights >> level) & 1 == 1]]), [np.zeros(0, dtype=np.uint32)]
        while len(held) > 2:
            third = len(held) // 3
            a, b, c = held[:third], held[third : 2 * third], held[2 * third : 3 * third]
            half = a ^ b
            carries.append((a & b) | (half & c))
            held = np.concatenate([half ^ c, held[3 * third :]])
        for word in held:
            counts += ((word >> np.arange(32, dtype=np.uint32)) & 1).astype(np.int64) << level
        carried, level = np.concatenate(carries), level + 1
    return counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, weights = WORDS[batch.column("failed").to_numpy()], batch.column("n").to_numpy()
        names = pa.compute.dictionary_encode(batch.column("part"))
        part = names.indices.to_numpy()
        order = np.argsort(part, kind="stable")
        ends = np.searchsorted(part[order], np.arange(len(names.dictionary) + 1))
        flags = [np.ones(len(part), dtype=bool)] + [batch.column(x).to_numpy(zero_copy_only=False) for x in ("good", "toxic")]
        for k, name in enumerate(names.dictionary.to_pylist()):
            own = order[ends[k] : ends[k + 1]]
            counts = [positional_counts(words[own[f[own]]], weights[own[f[own]]]) for f in flags]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * SUBSETS, pa.string()), pa.array(range(SUBSETS), pa.int32()), *map(pa.array, counts)],
                ["part", "subset", "documents", "good", "toxic"],
            )


def survivors(marked: DataFrame) -> DataFrame:
    """``part, subset, documents, good, toxic``: what each of the 32 sets of filters leaves, all and by label.

    ``marked`` is as :func:`judged` gives it.  Each row's failures become the 32-bit word of the subsets it survives;
    words are counted by position in each batch, and the counts are added up by part and subset.
    """
    counts = marked.select("part", "failed", "good", "toxic", "n").mapInArrow(
        _count, "part string, subset int, documents long, good long, toxic long"
    )
    return counts.groupBy("part", "subset").agg(*[F.sum(x).alias(x) for x in ("documents", "good", "toxic")])


def interactions(left: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from what each set of filters leaves (:func:`survivors`).

    ``kept`` after the step and ``removed`` by it; ``redundant``: fail its filter but are gone before; ``unique_fails``:
    fail its filter alone; ``good_lost`` and ``toxic_lost`` of those removed; ``shapley``: what the filter removes, summed over all orders.
    """
    n, everything = len(LETTERS), SUBSETS - 1
    row = F.struct("subset", "documents", "good", "toxic")
    by_part = left.groupBy("part").agg(F.array_sort(F.collect_list(row)).alias("s"))

    def count(subset: Column | int, label: str = "documents") -> Column:
        return F.get("s", subset if isinstance(subset, Column) else F.lit(subset))[label]

    def over_orders(bit: int) -> Column:
        before = [s for s in range(SUBSETS) if not s & bit]
        return sum((math.factorial(s.bit_count()) * math.factorial(n - 1 - s.bit_count()) * (count(s) - count(s | bit)) for s in before), F.lit(0).cast("long"))

    orders = F.array(*[F.lit("".join(p)) for p in permutations(LETTERS)])
    fixed = by_part.withColumns({"shapleys": F.array(*[over_orders(1 << i) for i in range(n)]), "uniques": F.array(*[count(everything ^ 1 << i) - count(everything) for i in range(n)])})
    steps = fixed.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    nth = F.ascii(F.col("filter_order").substr(F.col("step"), F.lit(1))) - ord(LETTERS[0])
    letters = F.transform(F.split(F.col("filter_order").substr(F.lit(1), F.col("step")), ""), lambda x: F.ascii(x) - ord(LETTERS[0]))
    bits = F.reduce(letters, F.lit(0), lambda a, i: a.bitwiseOR(F.call_function("shiftleft", F.lit(1), i)))
    steps = steps.withColumns({"nth": nth, "after": bits}).withColumn("bit", F.call_function("shiftleft", F.lit(1), F.col("nth")))
    before, after = F.col("after").bitwiseXOR(F.col("bit")), F.col("after")
    lost = {x: count(before, x) - count(after, x) for x in ("documents", "good", "toxic")}
    return steps.select(
        "part", "filter_order", "step", count(after).alias("kept"), lost["documents"].alias("removed"),
        (count(0) - count(F.col("bit")) - lost["documents"]).alias("redundant"), F.get("uniques", "nth").alias("unique_fails"),
        lost["good"].alias("good_lost"), lost["toxic"].alias("toxic_lost"), F.get("shapleys", "nth").alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """:func:`interactions` of the five filters over all documents, by ``part`` (NULL: empty text).

    Filters: A under 200 words; B under half of the words distinct; C over 3 % of the code points ``[A-Z]``; D holds one of
    ``#$%&*|``; E a smaller id has the same whole text.  Words are ``[^\\x20\\x09-\\x0D]+``.
    NULL text is empty.  A NULL id neither fails E nor is smaller than another, and has no label; rows equal in id and
    text count each and none makes the other a copy; of several labels of an id any 1 counts; NULL labels are not 1; other columns are never
    read; a very long text is judged whole by itself; without documents there is no part and no row.
    """
    return interactions(survivors(judged(docs, labels, part)))
