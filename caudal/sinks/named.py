"""Files by name: one file per row, through a Python data source (SNK-05, SNK-07)."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

# The writer travels by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Written last, by the driver: a folder without it is not complete.
DONE = "_SUCCESS"
#: Longest name kept as it is, in bytes of its encoded form.
LONGEST = 200
#: Bytes of files read at once, and files of which that many are small.
READ_BYTES, READ_FILES = 8 << 20, 1000
#: What an index of written files holds.
INDEX = pa.schema([("name", pa.string())])


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:").rstrip("/")


def _write_all(out, value: bytes) -> None:
    left = memoryview(value)
    while left:
        left = left[out.write(left) :]


class _Index:
    """A task's table of names, moved to its place whole; a task that runs again replaces it by the same one."""

    def __init__(self, folder: str | None):
        self.writer = None
        if folder is not None:
            self.store, root = store_of(folder)
            self.part = f"{root}/_part-{uuid.uuid4().hex}"
            self.place = f"{root}/names-{uuid.uuid4().hex if TaskContext.get() is None else TaskContext.get().partitionId()}.parquet"
            self.writer = pa.parquet.ParquetWriter(self.part, INDEX, filesystem=self.store)

    def add(self, names: list[str]) -> None:
        if self.writer:
            self.writer.write_table(pa.table([pa.array(names, pa.string())], INDEX))

    def close(self) -> None:
        if self.writer:
            self.writer.close()
            self.store.move(self.part, self.place)


@dataclass
class Written(WriterCommitMessage):
    """What a task has to say: two numbers, whatever it wrote."""

    files: int
    size: int


class NamedFilesWriter(DataSourceArrowWriter):
    """Each row's ``value`` becomes the file ``name`` in the folder.

    A task writes a file beside its place and moves it there whole, so nobody sees half a file, and a task that runs
    again or twice at a time puts the same bytes under the same names.  Nothing but counts goes to the driver, which marks
    the folder as complete.  With an ``index`` folder, every task also leaves a table of its names there.
    """

    def __init__(self, path: str, overwrite: bool, index: str | None = None):
        self.path, self.index = path, index
        if index is not None:
            store, root = store_of(index)
            store.create_dir(root, recursive=True)
            if overwrite:
                store.delete_dir_contents(root)
        store, root = store_of(path)
        store.create_dir(root, recursive=True)
        if overwrite:
            store.delete_dir_contents(root)
        elif store.get_file_info(f"{root}/{DONE}").type != fs.FileType.NotFound:
            store.delete_file(f"{root}/{DONE}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = store_of(self.path)
        beside = f"{root}/_part-{uuid.uuid4().hex}"
        # On a local disk by system calls, which take a fraction of the time for small files, and out of a folder of the
        # task's own, so that tasks do not wait for each other to make files in the one.
        local = isinstance(store, fs.LocalFileSystem)
        listed, files, size = _Index(self.index), 0, 0
        try:
            if local:
                os.mkdir(beside)
            for batch in iterator:
                names, values = batch.column("name").to_pylist(), batch.column("value").cast(pa.binary()).to_pylist()
                for name, value in zip(names, values, strict=True):
                    if not name or "/" in name or "\0" in name or name in (".", ".."):
                        raise ValueError(f"not a file name: {name!r}")
                    if local:
                        with open(f"{beside}/part", "wb", buffering=0) as out:
                            _write_all(out, value or b"")
                        os.replace(f"{beside}/part", f"{root}/{name}")
                    else:
                        with store.open_output_stream(beside) as out:
                            out.write(value or b"")
                        store.move(beside, f"{root}/{name}")
                    files, size = files + 1, size + len(value or b"")
                listed.add(names)
            listed.close()
        finally:
            if local and os.path.isdir(beside):
                store.delete_dir(beside)
        return Written(files, size)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = store_of(self.path)
        told = [m for m in messages if m is not None]
        with store.open_output_stream(f"{root}/{DONE}") as out:
            out.write(f"{sum(m.files for m in told)} files, {sum(m.size for m in told)} bytes\n".encode())

    def abort(self, messages: list[Written | None]) -> None:
        """Files written so far are whole and stay; without the mark the folder counts as incomplete."""


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, value binary"

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(self.options["path"], overwrite, self.options.get("index"))


def write_named(files: DataFrame, path: str, mode: str = "overwrite", index: str | None = None) -> None:
    """Write ``name, value`` (text or binary) as files of a folder that all executors reach; names are expected to differ.

    ``index``: another folder, for a table of the names written (``overwrite`` only); :func:`read_named` reads the files by it.
    """
    if index is not None and mode != "overwrite":
        raise ValueError("an index is of one write")
    spark = files.sparkSession
    spark.dataSource.register(NamedFiles)
    writer = files.select("name", F.col("value").cast("binary").alias("value")).write.format("named_files").mode(mode)
    (writer if index is None else writer.option("index", index)).save(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_named(spark: SparkSession, path: str, index: str) -> DataFrame:
    """``name, value`` (binary) of the files that :func:`write_named` listed in ``index``.

    Names are dealt out as a table: millions of files are neither listed by the driver nor planned one by one.  A file that
    is not there is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(path)
        local = isinstance(store, fs.LocalFileSystem)

        def content(name: str) -> bytes:
            with open(f"{root}/{name}", "rb", buffering=0) if local else store.open_input_stream(f"{root}/{name}") as file:
                return file.read()

        def batch_of(names: list[str], values: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.binary())], ["name", "value"])

        for batch in batches:
            names, values, held = [], [], 0
            for name in batch.column("name").to_pylist():
                names.append(name)
                values.append(content(name))
                held += len(values[-1])
                if held >= READ_BYTES or len(names) >= READ_FILES:
                    yield batch_of(names, values)
                    names, values, held = [], [], 0
            if names:
                yield batch_of(names, values)

    # By number, as a small table of names stands for many files.
    names = spark.read.schema("name string").parquet(index).repartition(shuffle_partitions(spark), "name")
    return names.mapInArrow(read, "name string, value binary")


def file_name(identifier: Column, suffix: str = "") -> Column:
    """A file name for any text: letters, digits, ``-``, ``_`` and ``.`` as they are, all else percent-encoded.

    Different texts get different names.  A leading ``_`` or ``.``, which readers take for hidden, is encoded too; of a name that is too long the
    end gives way to a digest of the text.  NULL and empty text have no name.
    """
    plain = F.replace(F.replace(F.url_encode(identifier), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))
    plain = F.when(plain.startswith("_"), F.concat(F.lit("%5F"), F.substr(plain, F.lit(2)))).when(
        plain.startswith("."), F.concat(F.lit("%2E"), F.substr(plain, F.lit(2)))
    ).otherwise(plain)
    short = F.concat(F.substr(plain, F.lit(1), F.lit(LONGEST - 41)), F.lit("-"), F.sha1(identifier.cast("binary")))
    return F.when(identifier != "", F.concat(F.when(F.length(plain) > LONGEST, short).otherwise(plain), F.lit(suffix)))


def records_as_files(records: DataFrame) -> DataFrame:
    """``name, value``: a file ``<identifier>.xml`` per record with metadata (SNK-05).

    Of several records of one identifier the one with the latest datestamp is kept (then the last by text).  Records without an
    identifier are named by a digest of their XML.
    """
    from caudal.sinks.files import with_schema_location

    stamp = F.col("datestamp") if "datestamp" in records.columns else F.lit("")
    xml = records.filter(F.col("metadata").isNotNull()).select("identifier", F.coalesce(stamp, F.lit("")).alias("datestamp"), with_schema_location(F.col("metadata")).alias("value"))
    unnamed = F.concat(F.lit("unnamed-"), F.sha1(F.col("value").cast("binary")), F.lit(".xml"))
    named = xml.select(F.coalesce(file_name(F.col("identifier"), ".xml"), unnamed).alias("name"), "datestamp", "value")
    return named.groupBy("name").agg(F.max_by("value", F.struct("datestamp", "value")).alias("value"))


def page_copies(spark: SparkSession, landing: str) -> DataFrame:
    """``name, value``: landed record pages byte for byte under ``records_<cursor>.xml`` (SNK-07).

    A page that tells no cursor keeps its name.  Different pages that would share a name, as those of two harvests, get a
    digest of their bytes in it; equal ones are one file.  Only names and digests are shuffled.
    """
    pages = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing).select("path", "content")
    # Any bytes can be read so; the tag is plain ASCII.
    cursor = F.regexp_extract(F.decode("content", "ISO-8859-1"), r"""<(?:[\w.-]+:)?resumptionToken\s[^>]*?\bcursor\s*=\s*["'](\d+)["']""", 1)
    own = file_name(F.url_decode(F.regexp_extract("path", r"([^/]*)$", 1)))
    base = F.when(cursor != "", F.concat(F.lit("records_"), cursor, F.lit(".xml"))).otherwise(own)
    named = pages.select(base.alias("base"), F.sha1("content").alias("digest"), F.col("content").alias("value"))
    shared = named.groupBy("base").agg(F.count_distinct("digest").alias("n")).filter("n > 1")
    told = named.join(shared.select(F.col("base").alias("shared")), F.col("base") == F.col("shared"), "left")
    stem, ending = F.regexp_extract("base", r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract("base", r"^(.*?)(\.[^.]*)?$", 2)
    apart = F.concat(stem, F.lit("-"), F.substr(F.col("digest"), F.lit(1), F.lit(16)), ending)
    return told.select(F.when(F.col("shared").isNotNull(), apart).otherwise(F.col("base")).alias("name"), "value")
