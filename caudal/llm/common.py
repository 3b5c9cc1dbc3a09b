"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.session import scratch_dir

#: Stands for a NULL id in keys, so that NULL ids join and sort before all others.
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (NULL becomes empty) and the key ``d``, ``t`` of the row: id and hash of the text.

    Rows equal in id and text share the key: they count as one document and get the same result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"), text.alias("text"), F.coalesce(doc_id, F.lit(NO_ID)).alias("d"), F.xxhash64(text).alias("t")
    )


def row_key(docs: DataFrame) -> dict[str, Column]:
    """The key ``d``, ``t`` of :func:`keyed` under names that no column of ``docs`` has."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = {"d": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "t": F.xxhash64(text)}
    return {free_name(docs.columns, f"row_{k}"): v for k, v in key.items()}


def stage(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    path = scratch_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def hex64(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def utf8(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column without copying through Python strings; NULL is empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def parts(batches: Iterator[pa.RecordBatch], limit: int, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows of about ``limit`` bytes of text; a longer row stands alone."""
    for batch in batches:
        first, held = 0, 0
        for i, size in enumerate(pa.compute.binary_length(batch.column(name)).to_pylist()):
            if held and held + (size or 0) > limit:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += size or 0
        if first < batch.num_rows:
            yield batch.slice(first)


def free_name(taken: list[str], base: str) -> str:
    """``base``, with underscores where a column of that name exists (names compare without case)."""
    lower = {x.lower() for x in taken}
    while base.lower() in lower:
        base += "_"
    return base


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for drivers that run from a source folder."""
    context = spark.sparkContext
    if getattr(context, "_caudal_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="caudal-code-"), "caudal.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(os.path.join(root, "caudal")):
            for name in names:
                if name.endswith(".py"):
                    archive.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    context.addPyFile(path)
    context._caudal_shipped = True
