"""Resumable harvest ingest into a table that several streams share (ST-01).

The checkpoint of a stream takes the place of the resumption token: a run reads
the page files that arrived since the last one and appends their rows.  Batch
reads keep rows that occur on two overlapping pages, as the harvest does; the
ingest keeps each key once, whatever stream or run brought it first.

A table is a folder of

* ``ingest_stream=S/ingest_batch=N``: the rows of a batch.  S is the identity that the stream's checkpoint holds, so no two
  streams and no new checkpoint ever write to the same folder.
* ``_keys/ingest_bucket=B``: a digest of every key with the batch that brought it, by hash bucket.  A batch
  looks only into the buckets of its own keys; no batch reads the rows of the table.  ``_layout`` keeps the number of buckets.
* ``_sketches/ingest_stream=S/ingest_batch=N`` (observations): quantile sketches of the batch's new rows.
* ``_commits/ingest_stream=S/ingest_batch=N``: batches that are complete, written last.

A batch that fails leaves at most rows and digests without a commit: nobody takes them for known, and the batch that runs
again replaces its rows.  That needs no state and no event time: a file may arrive in any order and as late as it likes.
Streams into one table run one after another; of two that bring the same new key at the same moment both keep it.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from caudal import schemas as S
from caudal.operators.statistics import merge_sketches, quantile_sketches, with_month

#: Partition folders of the table: the stream and its batch that wrote a row.
STREAM, BATCH = "ingest_stream", "ingest_batch"
#: Partition folder of the key index, and their number in a new table unless another is asked for: enough that
#: the digests of a bucket (32 bytes a key) are read in a moment, few enough that a batch writes no crumbs.
BUCKET, BUCKETS = "ingest_bucket", 16
IDENTITY = "ingest_identity"
#: The source would skip files much older than the newest one it has seen.
ANY_AGE = "36500d"

_COMMIT = f"{STREAM} string, {BATCH} long"
_COMMITS = f"rows long, {_COMMIT}"
_KEYS = f"{IDENTITY} binary, {_COMMIT}, {BUCKET} int"


def page_stream(
    spark: SparkSession, landing: str, page_schema: str, field: str,
    multi_line: bool = True, files_per_batch: int | None = None,
) -> DataFrame:
    """Streaming rows of JSON pages."""
    reader = spark.readStream.schema(page_schema).option("multiLine", multi_line).option("mode", "FAILFAST")
    reader = reader.option("maxFileAge", ANY_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    pages = reader.json(landing)
    folders = [c for c in pages.columns if c != field]
    return pages.select(F.explode(field).alias("_item"), *folders).select("_item.*", *folders)


def record_stream(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming (identifier, datestamp, setSpec, setSpecs, metadata) of record pages."""
    from caudal.sources.records import parse_record_text

    reader = spark.readStream.option("maxFileAge", ANY_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse_record_text(reader.text(landing, wholetext=True))


def observation_stream(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """Streaming (series_id, timestart, timeend, valor) of landed observations, times rounded to the minute."""
    from caudal.sources.catalogue_b import conform_observations

    reader = spark.readStream.schema(S.OBSERVATION_JSON).option("mode", "FAILFAST").option("maxFileAge", ANY_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return conform_observations(reader.json(landing))


def identity(columns: list[str], key: list[str]) -> Column:
    """What makes a row the same as another: a digest of its key or, where a key column is NULL, of the whole row."""
    whole = F.concat(F.lit("row "), F.to_json(F.struct(*sorted(columns))))
    named = F.concat(F.lit("key "), F.to_json(F.struct(*key)))
    known = F.lit(True)
    for k in key:
        known = known & F.col(k).isNotNull()
    return F.unhex(F.sha2(F.when(known, named).otherwise(whole), 256))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(IDENTITY), F.lit(buckets)).cast("int").alias(BUCKET)


def _empty(spark: SparkSession, schema: str | StructType) -> DataFrame:
    # As a constant of the plan: no task has to turn Python rows into it.
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def lay_out(spark: SparkSession, table: str, buckets: int | None = None) -> int:
    """Make the folders of a table that has none yet, so that a first batch reads empty ones; its number of buckets."""
    _empty(spark, _COMMITS).write.mode("ignore").partitionBy(STREAM, BATCH).parquet(f"{table}/_commits")
    _empty(spark, _KEYS).write.mode("ignore").partitionBy(BUCKET).parquet(f"{table}/_keys")
    spark.range(1).select(F.lit(buckets or BUCKETS).alias("buckets")).write.mode("ignore").parquet(f"{table}/_layout")
    kept = spark.read.schema("buckets int").parquet(f"{table}/_layout").first()[0]
    if buckets not in (None, kept):
        raise ValueError(f"the table has {kept} key buckets, not {buckets}")
    return kept


def commits(spark: SparkSession, table: str) -> DataFrame:
    """(ingest_stream, ingest_batch) of the complete batches."""
    return spark.read.schema(_COMMITS).parquet(f"{table}/_commits").select(STREAM, BATCH)


def known_identities(spark: SparkSession, table: str, buckets: list[int]) -> DataFrame:
    """Digests of the keys that complete batches brought, of these buckets alone."""
    index = spark.read.schema(_KEYS).parquet(f"{table}/_keys")
    return index.filter(F.col(BUCKET).isin(buckets)).join(commits(spark, table), [STREAM, BATCH], "left_semi").select(IDENTITY)


def read_ingested(spark: SparkSession, table: str, schema: str | StructType) -> DataFrame:
    """The rows of complete batches, with ``ingest_stream`` and ``ingest_batch``; no rows before the first."""
    full = StructType([*_empty(spark, schema).schema, *StructType.fromDDL(_COMMIT)])
    return spark.read.schema(full).parquet(table).join(commits(spark, table), [STREAM, BATCH], "left_semi").select(*full.names)


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The id in the checkpoint's metadata: the same for every run that resumes it."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def append_batch(
    batch: DataFrame, table: str, stream: str, number: int, key: list[str], buckets: int,
    derive: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> None:
    """Add the rows of a batch whose key the table does not have: rows first, then their digests, then the commit.

    ``buckets`` is what :func:`lay_out` says of the table.  ``derive`` names further tables of the batch, each computed from its new rows.
    A batch that is committed already (the run ended before its checkpoint knew) changes nothing.
    """
    session, columns = batch.sparkSession, batch.columns
    if commits(session, table).filter((F.col(STREAM) == stream) & (F.col(BATCH) == number)).head(1):
        return
    rows = batch.withColumn(IDENTITY, identity(columns, key)).dropDuplicates([IDENTITY]).persist()
    try:
        touched = [r[0] for r in rows.select(_bucket(buckets)).distinct().collect()]  # one number a bucket
        fresh = rows.join(known_identities(session, table, touched), IDENTITY, "left_anti")
        folder = f"{table}/{STREAM}={stream}/{BATCH}={number}"
        fresh.select(*columns).write.mode("overwrite").parquet(folder)
    finally:
        rows.unpersist()
    # The digests of what was written, whatever was computed again on the way.
    new = session.read.schema(batch.schema).parquet(folder)
    for name, compute in (derive or {}).items():
        compute(new).write.mode("overwrite").parquet(f"{table}/_{name}/{STREAM}={stream}/{BATCH}={number}")
    written = new.select(identity(columns, key).alias(IDENTITY))
    index = written.select(IDENTITY, F.lit(stream).alias(STREAM), F.lit(number).cast("long").alias(BATCH), _bucket(buckets))
    index.repartition(BUCKET).sortWithinPartitions(BUCKET, IDENTITY).write.mode("append").partitionBy(BUCKET).parquet(f"{table}/_keys")
    count = written.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.lit(stream).alias(STREAM), F.lit(number).cast("long").alias(BATCH))
    count.write.mode("append").partitionBy(STREAM, BATCH).parquet(f"{table}/_commits")


def _append(
    rows: DataFrame, table: str, checkpoint: str, key: list[str], buckets: int | None,
    derive: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> StreamingQuery:
    """Start a run that appends what has landed since the last one."""
    kept = lay_out(rows.sparkSession, table, buckets)

    def write(batch: DataFrame, number: int) -> None:
        append_batch(batch, table, stream_identity(batch.sparkSession, checkpoint), number, key, kept, derive)

    return (
        rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def ingest_pages(
    spark: SparkSession, landing: str, table: str, checkpoint: str, page_schema: str, field: str,
    key: list[str], buckets: int | None = None, **options,
) -> StreamingQuery:
    """Append the rows of all pages landed since the last run, each key once; rows with a NULL in
    their key are told apart by the whole row.  ``table`` and ``checkpoint`` belong on storage every executor reaches."""
    return _append(page_stream(spark, landing, page_schema, field, **options), table, checkpoint, key, buckets)


def ingest_records(
    spark: SparkSession, landing: str, table: str, checkpoint: str, buckets: int | None = None, **options
) -> StreamingQuery:
    """Append the records landed since the last run, each identifier once; records without one are told apart by all they have."""
    return _append(record_stream(spark, landing, **options), table, checkpoint, ["identifier"], buckets)


def monthly_sketches(observations: DataFrame) -> DataFrame:
    return quantile_sketches(with_month(observations), ["series_id", "mon"], "valor")


def ingest_observations(
    spark: SparkSession, landing: str, table: str, checkpoint: str, key: list[str] | None = None,
    buckets: int | None = None, **options,
) -> StreamingQuery:
    """Append the observations landed since the last run, each (series, start) once, with their sketches by series and month."""
    rows = observation_stream(spark, landing, **options)
    return _append(rows, table, checkpoint, key or ["series_id", "timestart"], buckets, {"sketches": monthly_sketches})


def read_sketches(spark: SparkSession, table: str) -> DataFrame:
    """(series_id, mon, count, total, sketch) over all complete batches: quantiles of the whole table without reading its rows."""
    fields = StructType.fromDDL(f"series_id long, mon int, count long, total double, sketch binary, {_COMMIT}")
    parts = spark.read.schema(fields).parquet(f"{table}/_sketches").join(commits(spark, table), [STREAM, BATCH], "left_semi")
    return merge_sketches(parts, ["series_id", "mon"])
