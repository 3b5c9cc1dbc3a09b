"""Mixing sources to target weights by prefix sums over hash-random order (operator 13): DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import stage

SPACE = r"\x20\x09-\x0D"
#: Order keys have so many bits; a source's keys are cut into ranges of about so many rows.
KEY_BITS = 60
RANGE_ROWS = 1 << 12
#: Equal rows travel together up to this number.
COPIES = 1 << 10
#: Bits of a row's number within its task in ``monotonically_increasing_id``.
_LOCAL = 33


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text, without an array of them."""
    ended = F.rtrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.length(F.regexp_replace(ended, f"[{SPACE}]*+[^{SPACE}]++", "x")).cast("long")


def order_key(value: Column) -> Column:
    """The first 15 hex digits of the MD5 of a text: uniform, the same in every run and in other engines."""
    return F.substring(F.md5(value.cast("binary")), 1, KEY_BITS // 4)


def _rows(docs: DataFrame, seed: str) -> DataFrame:
    """``source, doc_id, size, key, n``: equal rows folded, so that copies under one id do not meet in one task."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    key = order_key(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), text))
    rows = docs.select(F.col("source").cast("string").alias("source"), doc_id.alias("doc_id"), n_words(text).alias("size"), key.alias("key"))
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


def targets(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), total: int | None = None, most: int = 3) -> DataFrame:
    """``source, nth, n_rows, source_size, weight, target``: what each source should give, in words.

    ``rows`` has ``source, size, n``.  Sources in order of code points, NULL last, have the weights in turn and share ``total``
    (all sizes) by them; a target stops at ``most`` times its source's size and the excess is shared again by weight among
    the others, until none is above.

    The order is found by a range sort and the row numbers of its tasks, so sources may be many.  Each round of sharing
    is one aggregate of one row; it stops more sources or is the last.
    """
    by_source = rows.groupBy("source").agg(F.sum("n").alias("n_rows"), F.sum(F.col("size") * F.col("n")).alias("source_size"))
    ordered = stage(by_source.orderBy(F.col("source").asc_nulls_last()).withColumn("m", F.monotonically_increasing_id()), "mix-sources")
    ordered = ordered.withColumn("task", F.shiftright("m", _LOCAL))
    # One row per task of the sort.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = ordered.groupBy("task").agg(F.count(F.lit(1)).alias("c")).select("task", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"))
    nth = F.col("base") + F.col("m").bitwiseAND(F.lit((1 << _LOCAL) - 1))
    share = F.get(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("nth") % len(weights)).cast("int"))
    cap = F.col("source_size") * most
    ranked = ordered.join(base, "task").withColumn("nth", nth).withColumns({"weight": share, "cap": cap})
    ranked = stage(ranked.select("source", "nth", "n_rows", "source_size", "weight", "cap"), "mix-ranked")
    level, stopped = None, F.lit(False)
    while True:
        row = ranked.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(~stopped, F.col("weight"))).alias("open"), F.sum(F.when(stopped, F.col("cap"))).alias("held")
        ).first()
        if not row["open"]:
            level = float("inf")
            break
        asked = (row["all"] if total is None else total) - (row["held"] or 0)
        if level == asked / row["open"]:
            break
        level = asked / row["open"]
        stopped = F.col("cap") < F.lit(level) * F.col("weight")
    target = F.least(F.lit(level) * F.col("weight"), F.col("cap").cast("double"))
    return ranked.select("source", "nth", "n_rows", "source_size", "weight", target.alias("target"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), total: int | None = None, most: int = 3, seed: str = "",
    range_rows: int = RANGE_ROWS, copies: int = COPIES,
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, source, key`` per row: how many of its words the mix takes, repeats counted.

    Documents of a source stand in a random order that their id and text give (``seed`` gives another).  A prefix sum of
    sizes places each in it; the mix takes the source as often as its target holds it whole, and then once more up to the very
    word where the target ends.  So a source gives exactly its target (without the fraction of a word), only the document at the cut
    gives part of its words, and a rerun gives the same.

    Prefix sums: keys are uniform, so the high bits that cut a source into ranges of ``range_rows`` follow from its number of rows.
    Sums by range combine on the map side, are added up over the ranges of a source, and each range is summed by itself, so a
    source of any size is spread over its ranges.  Only ids, sizes and keys are shuffled, never texts.  Equal rows are folded first and
    go on in groups of ``copies`` that have places of their own.

    NULL or empty text has size 0 and takes 0; NULL is a source of its own; a NULL id stays NULL; equal rows keep a row each, and where the cut
    falls among them they differ in ``taken``; sources without words have target 0; other columns are never read; an empty
    table gives an empty result.
    """
    rows = stage(_rows(docs, seed), "mix-rows")
    sources = targets(rows, weights, total, most)
    bits = F.when(F.col("n_rows") > range_rows, F.ceil(F.log2(F.col("n_rows") / range_rows))).otherwise(0).cast("int")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    cut = sources.select(
        F.col("source").alias("of"), "nth", "source_size", "target", epochs.alias("epochs"), (budget - epochs * F.col("source_size")).alias("rest"), bits.alias("bits")
    )
    groups = rows.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / copies))).alias("group")
    )
    place = F.when(F.col("group") == 0, F.col("key")).otherwise(order_key(F.concat_ws("/", "key", "group")))
    groups = groups.withColumns({"place": place, "n": F.least(F.col("n") - F.col("group") * copies, F.lit(copies))})
    part = F.call_function("shiftright", F.conv("place", 16, 10).cast("long"), F.lit(KEY_BITS) - F.col("bits"))
    placed = groups.join(cut, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("range", part)
    width = F.col("size") * F.col("n")
    before = Window.partitionBy("nth").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("nth", "range").agg(F.sum(width).alias("words")).select("nth", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("nth", "range").orderBy("place", F.col("doc_id").asc_nulls_first(), "size", "key").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.join(starts, ["nth", "range"]).withColumn("start", F.col("base") + F.coalesce(F.sum(width).over(within), F.lit(0)))
    each = summed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))
    last = F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("start") - F.col("i") * F.col("size")))
    return each.select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + last).alias("taken"), "source", "key")


def mixed_texts(docs: DataFrame, plan: DataFrame, seed: str = "") -> DataFrame:
    """``doc_id, source, epoch, text`` of what the plan of :func:`mix` (same ``seed``) takes: a row for each time a document is taken.

    The document at a source's cut gives its first words, joined by one space.  Rows that give nothing are left out; equal rows
    of ``docs`` each give what their row of the plan says.
    """
    text, doc_id = F.coalesce(F.col("text").cast("string"), F.lit("")), F.col("doc_id").cast("long")
    key = order_key(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), text))
    texts = docs.select(key.alias("text_key"), text.alias("text")).dropDuplicates(["text_key"])
    times = plan.where("taken > 0").select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size")))).alias("epoch"))
    here = F.least("size", F.col("taken") - (F.col("epoch") - 1) * F.col("size")).cast("int")
    words = F.filter(F.split("text", f"[{SPACE}]+"), lambda w: w != "")
    some = F.when(here < F.col("size"), F.array_join(F.slice(words, F.lit(1), here), " ")).otherwise(F.col("text"))
    return times.join(texts, F.col("key") == F.col("text_key")).select("doc_id", "source", "epoch", some.alias("text"))
