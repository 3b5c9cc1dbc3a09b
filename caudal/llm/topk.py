"""Exact top-k inner-product search by a three-phase uniform threshold (operator 8)."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import stage

#: Queries and rows that meet in one piece of work, about.
QUERY_BLOCK = 2048
ROW_BLOCK = 8192
#: Score lists: the vector's components are dealt into so many slices.
LISTS = 2
#: Rows that a list of a cell names in the first phase, times k.
HEAD = 6
_NONE = -(2**62)


def scaled(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """``vec_id, v, n``: components times ``scale``, rounded down to integers, and the number of rows equal in id and vector.

    Rows without an id or vector, and vectors holding NULL or non-finite components, take no part.  Nor do vectors whose
    length, scaled, is 2**31 or more: only between such can a score leave the range of a long.  Different vectors under one
    id each stay.  Shorter vectors are filled up with zeros.
    """
    x = F.transform("embedding", lambda c: c.cast("double") * scale)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    square = F.reduce(x, F.lit(0.0), lambda a, c: a + F.pow(F.floor(F.when(F.abs(c) < 2.0**32, c).otherwise(2.0**32)).cast("double"), 2))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine & (square < 2.0**62))
    v = F.transform(x, lambda c: F.floor(F.when(F.abs(c) < 2.0**32, c).otherwise(0.0)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("n"))


def _matrix(table: pa.Table) -> np.ndarray:
    flat = table["v"].combine_chunks().flatten().to_numpy()
    return flat.reshape(table.num_rows, -1)


def _partials(queries: pa.Table, rows: pa.Table, lists: int):
    """(first of some queries, their partial scores against all rows by list, and which row is the query itself)."""
    q, r = _matrix(queries), _matrix(rows)
    q_ids, r_ids = queries["query_id"].to_numpy(), rows["vec_id"].to_numpy()
    # Products of doubles are exact while sums stay below 2**53; beyond, integers are used.
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(r).max(initial=0)) * q.shape[1]
    kind = np.float64 if bound < 2**53 else np.int64
    cuts = [q.shape[1] * j // lists for j in range(lists + 1)]
    for i in range(0, len(q), 256):
        own = q_ids[i : i + 256, None] == r_ids[None, :]
        yield i, [(q[i : i + 256, at].astype(kind) @ r[:, at].astype(kind).T).astype(np.int64) for at in map(slice, cuts, cuts[1:])], own


def _gather(k: int, lists: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Phase 1 on a cell: each list names its highest rows; the k best totals of those, and each list's lowest score."""

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        q_ids, r_ids = queries["query_id"].to_numpy(), rows["vec_id"].to_numpy()
        if len(q_ids) and len(r_ids):
            for i, partials, own in _partials(queries, rows, lists):
                ids, n = q_ids[i : i + len(own)], min(HEAD * k, len(r_ids))
                named = np.concatenate([np.argpartition(-np.where(own, _NONE, p), n - 1, axis=1)[:, :n] for p in partials], axis=1)
                named.sort(axis=1)
                again = np.zeros(named.shape, dtype=bool)
                again[:, 1:] = named[:, 1:] == named[:, :-1]
                total = sum(np.take_along_axis(p, named, axis=1) for p in partials)
                total = np.where(again | np.take_along_axis(own, named, axis=1), _NONE, total)
                best = np.sort(total, axis=1)[:, -k:]
                a, b = np.nonzero(best > _NONE)
                out.append((ids[a], np.full(len(a), -1), best[a, b]))
                for j, p in enumerate(partials):
                    low = np.where(own, -_NONE, p).min(axis=1)
                    some = low < -_NONE
                    out.append((ids[some], np.full(some.sum(), j), low[some]))
        return _table(out, ["query_id", "list", "score"])

    return run


def _collect(lists: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Phases 2 and 3 on a cell: rows at or above a list's cutoff, scored exactly; those that reach the total stay."""

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        q_ids, r_ids = queries["query_id"].to_numpy(), rows["vec_id"].to_numpy()
        q_n, r_n = queries["n"].to_numpy(), rows["n"].to_numpy()
        if len(q_ids) and len(r_ids):
            cutoff = queries["cutoffs"].combine_chunks().flatten().to_numpy().reshape(-1, lists)
            least = queries["least"].to_numpy()
            for i, partials, own in _partials(queries, rows, lists):
                n = slice(i, i + len(own))
                enough = np.zeros(own.shape, dtype=bool)
                for j, p in enumerate(partials):
                    enough |= p >= cutoff[n, j, None]
                a, b = np.nonzero(enough & ~own)
                total = sum(p[a, b] for p in partials)
                kept = total >= least[n][a]
                a, b = a[kept], b[kept]
                out.append((q_ids[n][a], r_ids[b], total[kept], q_n[n][a] * r_n[b]))
        return _table(out, ["query_id", "vec_id", "score", "n"])

    return run


def _table(out: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.Table:
    columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0) for _ in names]
    return pa.table({n: pa.array(c.astype(np.int64)) for n, c in zip(names, columns, strict=True)})


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, lists: int = LISTS) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest inner products, ties to the smaller id.

    Both frames have ``vec_id, v, n`` as :func:`scaled` gives them; a query's own id is no candidate.  Several vectors under
    one id are candidates each by itself; as queries they share one ranking, where a pair of rows stands once for each row of either
    side: a row that occurs ``n`` times holds ``n`` ranks.  Fewer candidates than k give fewer ranks, an empty table none; other columns
    of the vectors are never read.  A score is the sum of one partial score per list (slice of the components).
    1. Each list of a cell names its highest rows; the cell sends the k best totals of these and each list's lowest score.
       The k-th best total of all cells is safe: k rows reach it.
    2. That total, counted from the lowest scores and shared evenly over the lists, is the cutoff: a row below it in every
       list stays below the total.  Cutoffs go back to all cells, which collect the rows at or above.
    3. What is missing of a collected row's score is added exactly where the row lies; rows that reach the total are ranked.
    Queries meet rows in a grid of blocks, dealt by hash; cutoffs travel with the queries.  Of equal vectors only the
    k + 1 smallest ids can be in a result (a query may be one itself), so the others leave before.
    """
    size = max([0, *(r[0] or 0 for r in (vectors.agg(F.max(F.size("v"))).first(), queries.agg(F.max(F.size("v"))).first()))])
    whole = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size("v"))).alias("v")
    same = Window.partitionBy("v").orderBy("vec_id")
    rows = stage(vectors.select("vec_id", whole, "n").withColumn("nth", F.dense_rank().over(same)).where(F.col("nth") <= k + 1).drop("nth"), "vectors")
    asked = stage(queries.select(F.col("vec_id").alias("query_id"), whole, "n"), "queries")
    n_q, n_r = (max(1, math.ceil(f.count() / block)) for f, block in ((asked, QUERY_BLOCK), (rows, ROW_BLOCK)))
    if not size:
        lists = 1

    def each(frame: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        return frame.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int")).withColumn(other, every)

    def meet(some: DataFrame, function: Callable, schema: str) -> DataFrame:
        left = each(some, "query_id", "qb", n_q, "rb", n_r).groupBy("qb", "rb")
        right = each(rows, "vec_id", "rb", n_r, "qb", n_q).groupBy("qb", "rb")
        return left.cogroup(right).applyInArrow(function, schema)

    local = stage(meet(asked, _gather(k, lists), "query_id long, list long, score long"), "score-lists")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    totals = local.where("list < 0").withColumn("nth", F.row_number().over(best)).where(F.col("nth") == k)
    lowest = local.where("list >= 0").groupBy("query_id", "list").agg(F.min("score").alias("low"))
    lows = lowest.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("list", "low"))).alias("by_list"), F.sum("low").alias("base"))
    # Fewer than k rows in all: every row is in.
    cutoffs = (
        lows.join(totals.select("query_id", "score"), "query_id", "left")
        .withColumn("least", F.coalesce("score", "base"))
        .withColumn("share", F.expr(f"(least - base + {lists - 1}) div {lists}"))
        .select("query_id", "least", F.transform("by_list.low", lambda low: low + F.col("share")).alias("cutoffs"))
    )
    scores = meet(asked.join(cutoffs, "query_id"), _collect(lists), "query_id long, vec_id long, score long, n long")
    # Equal rows hold as many ranks as there are of them.
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = scores.withColumn("before", F.coalesce(F.sum("n").over(final), F.lit(0))).where(F.col("before") < k)
    ranks = F.sequence((F.col("before") + 1).cast("int"), F.least(F.col("before") + F.col("n"), F.lit(k)).cast("int"))
    return placed.select("query_id", F.explode(ranks).alias("rank"), "vec_id", "score")
