"""From raw documents to packed sequences: language, repeated lines, near copies, benchmark items, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caudal.llm import containment, language, lines, packing, simhash
from caudal.llm.common import ship_package, stage, table
from caudal.llm.queries import tokenizer

#: A document whose words do not agree on a language to this share is rejected.
LEAST_SCORE = 0.5
#: Rows that travel to and from a Python worker at once, with whole texts in them: what an executor holds besides its heap.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MOST_ROWS = 1000


def _sent(function):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        rows = int(spark.conf.get(ARROW_ROWS, "10000"))
        spark.conf.set(ARROW_ROWS, str(min(rows, MOST_ROWS) if rows > 0 else MOST_ROWS))
        return function(spark, docs, sf_dir)

    return run


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language told with some certainty.

    Texts that are NULL, empty or without letters are rejected; repeated rows stay or go together; an empty table stays empty.
    """
    return language.only_known(docs, language.fit(docs), LEAST_SCORE)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; ``n_chars`` follows the text.

    All rows stay, also those left without a line; rows equal in id and text count as one document; an empty table stays empty.
    """
    return lines.replace_texts(docs, 10, 1)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of smallest id (NULL last, then by text).

    Texts without a word are copies of one another; of rows equal in all columns one stays; an empty table stays empty.
    """
    return simhash.keep_one(docs, 3, 3)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; NULL or empty texts hold none, repeated rows stay or go together."""
    return containment.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of the remaining documents; NULL or empty text is the end id alone, repeated rows are packed each by itself."""
    return packing.pack(docs, tokenizer(), 1024)


STAGES = [
    ("language", _sent(language_stage)),
    ("lines", _sent(line_stage)),
    ("near_duplicates", _sent(near_duplicate_stage)),
    ("benchmark", _sent(benchmark_stage)),
    ("packing", _sent(packing_stage)),
]

#: A trained chain, bit counts over hashes and a tokenizer are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read back."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name}")
    return docs
