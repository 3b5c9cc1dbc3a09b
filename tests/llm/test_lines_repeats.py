"""Line dedup with repeated rows and ids against its SQL: rows of one id and text are one document."""

from __future__ import annotations

import duckdb
import pytest

from caudal.llm.common import ship_package
from caudal.llm.queries import QUERIES, SQL
from compare import difference


@pytest.fixture(scope="module")
def llm(spark):
    ship_package(spark)
    return spark


@pytest.mark.parametrize("ids", [[*range(9), 0], [*range(10)], [None] * 10, [1] * 10, [*range(9), None]])
def test_repeated_ids_and_rows(llm, tmp_path, ids):
    rows = [(d, f"own {i}\n shared LINE\nend {i}") for i, d in enumerate(ids)]
    rows += [rows[0]] * 12 + [(50, "twice\nsame")] * 12 + [(60, None), (60, ""), (None, None), (61, "\n\n")]
    llm.createDataFrame([(*r, "en", 1) for r in rows], "doc_id long, text string, lang string, nth int").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    message, found, _ = difference(con, llm, str(tmp_path), QUERIES["op9_bloom_lines"], SQL["op9_bloom_lines"])
    assert message is None and found == len(rows)
