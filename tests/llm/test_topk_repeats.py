"""Exact top-k with repeated rows, repeated queries and components of any size."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest

from caudal.llm import topk
from caudal.llm.common import ship_package
from caudal.llm.queries import QUERIES, SQL
from compare import difference


@pytest.fixture(scope="module")
def llm(spark):
    ship_package(spark)
    return spark


def test_repeated_rows_hold_ranks_of_their_own(llm, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)]
    rows += [rows[5]] * 2 + [rows[100]] * 2 + [rows[200]] + [(5, rows[6][1]), (7, rows[200][1])] + [(i, rows[9][1]) for i in range(400, 460)]
    frame = llm.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, v string, n int")
    frame.repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    message, found, _ = difference(con, llm, str(tmp_path), QUERIES["op8_threshold_topk"], SQL["op8_threshold_topk"])
    assert message is None and found == 40


def test_components_of_any_size(llm):
    rows = [(0, [1.0, 2.0]), (1, [1e300, 0.0]), (2, [-1e17, 5.0]), (3, [1.5e6, -1.4e6]), (4, [2.0e6, 9.0e6]), (5, [float("nan"), 1.0]), (6, [3.0, -0.5])]
    vectors = topk.scaled(llm.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert {r.vec_id for r in vectors.collect()} == {0, 3, 6}
    found = topk.top_k(vectors, vectors.where("vec_id = 0"), 10).collect()
    want = sorted(((1024 * 1024 * (v[0] + 2 * v[1])), i) for i, v in rows if i in (3, 6))[::-1]
    assert [(r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [(i, int(s)) for s, i in want]
