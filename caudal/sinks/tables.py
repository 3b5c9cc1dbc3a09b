"""Many CSV tables in one job: every row goes to its tables, range-sorted inside each (SNK-02, SNK-03)."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter

from caudal.sinks.named import Written, store_of

# The writer travels by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules["caudal.sinks.named"])

CSV = {"escape": '"', "emptyValue": "", "timeZone": "UTC"}
#: Characters that a partition folder cannot show as they are; fixed values of the folder convention.
_ESCAPED = "\"#%'*/:=?\\\x7f{[]^"
NO_NAME = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Table:
    """Rows that fulfil ``where`` go to ``folder`` (a name, or a column for a folder by value) with these columns."""

    folder: str | Column
    where: Column
    columns: list[Column]
    names: list[str]


def partition_folder(parent: str, key: str, value: Column) -> Column:
    """``parent/key=value`` as a partitioned reader expects it; NULL and empty text have the folder of no value."""
    escaped = F.transform(F.split(value, ""), lambda c: F.when(
        F.lit(_ESCAPED).contains(c) | (c < " "), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))
    ).otherwise(c))
    text = F.when(value != "", F.array_join(escaped, "")).otherwise(F.lit(NO_NAME))
    return F.concat(F.lit(f"{parent}/{key}="), text)


def _line(columns: list[Column], names: list[str]) -> Column:
    return F.to_csv(F.struct(*[c.alias(n) for c, n in zip(columns, names, strict=True)]), CSV)


def _header(names: list[str]) -> str:
    return ",".join('"' + n.replace('"', '""') + '"' if any(x in n for x in ',"\n\r') else n for n in names)


class TablesWriter(DataSourceArrowWriter):
    """Lines ``folder, header, line`` in order of folder as part files, each with its header.

    A task writes a part beside its place and moves it there whole, under a name that follows from the job and the task: run
    again it replaces itself.  Tables named in ``expected`` exist even without rows.
    """

    def __init__(self, path: str, expected: dict[str, str], cleared: list[str]):
        self.path, self.expected, self.job = path, expected, uuid.uuid4().hex
        store, root = store_of(path)
        for folder in [*expected, *cleared]:
            store.create_dir(f"{root}/{folder}", recursive=True)
            store.delete_dir_contents(f"{root}/{folder}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = store_of(self.path)
        task, files, rows, current, out, part = TaskContext.get().partitionId(), 0, 0, None, None, None

        def close() -> None:
            if out is not None:
                out.close()
                store.move(part, f"{root}/{current}/part-{task:05}-{self.job}.csv")

        for batch in iterator:
            folders, headers, lines = (batch.column(x).to_pylist() for x in ("folder", "header", "line"))
            for folder, header, line in zip(folders, headers, lines, strict=True):
                if folder != current:
                    close()
                    store.create_dir(f"{root}/{folder}", recursive=True)
                    current, part, files = folder, f"{root}/{folder}/_part-{uuid.uuid4().hex}", files + 1
                    out = store.open_output_stream(part)
                    out.write(f"{header}\n".encode())
                out.write(f"{line}\n".encode())
                rows += 1
        close()
        return Written(files, rows)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = store_of(self.path)
        for folder, header in self.expected.items():
            from pyarrow import fs

            if not any(f.base_name.startswith("part-") for f in store.get_file_info(fs.FileSelector(f"{root}/{folder}"))):
                with store.open_output_stream(f"{root}/{folder}/part-00000-{self.job}.csv") as out:
                    out.write(f"{header}\n".encode())
            with store.open_output_stream(f"{root}/{folder}/_SUCCESS"):
                pass

    def abort(self, messages: list[Written | None]) -> None:
        """Parts written so far stay; a table without its mark is not complete."""


class CsvTables(DataSource):
    @classmethod
    def name(cls) -> str:
        return "csv_tables"

    def schema(self) -> str:
        return "folder string, header string, line string"

    def writer(self, schema, overwrite: bool) -> TablesWriter:
        import json

        return TablesWriter(self.options["path"], json.loads(self.options["expected"]), json.loads(self.options["cleared"]))


def write_tables(rows: DataFrame, path: str, tables: list[Table], order_by: list[str], cleared: list[str] | None = None) -> None:
    """All tables by one write.  ``rows`` are read to sample the ranges and to write, so a costly plan is better staged before.

    Each row is turned into the lines of the tables it belongs to.  Lines are spread by range over table and ``order_by`` (a hash
    of the line splits ties), so a table is in order over its part files, a large one is split and small ones share a task.
    ``cleared`` names folders, beside the tables named here, whose earlier files go.
    """
    import json

    def entry(t: Table) -> Column:
        folder = F.lit(t.folder) if isinstance(t.folder, str) else t.folder
        return F.when(t.where, F.struct(folder.alias("folder"), F.lit(_header(t.names)).alias("header"), _line(t.columns, t.names).alias("line")))

    lines = rows.select(*order_by, F.inline(F.array_compact(F.array(*[entry(t) for t in tables]))))
    order = ["folder", *order_by, F.xxhash64("line")]
    spread = lines.repartitionByRange(*order).sortWithinPartitions(*order).select("folder", "header", "line")
    expected = {t.folder: _header(t.names) for t in tables if isinstance(t.folder, str)}
    rows.sparkSession.dataSource.register(CsvTables)
    (
        spread.write.format("csv_tables").mode("append")
        .option("expected", json.dumps(expected)).option("cleared", json.dumps(cleared or [])).save(path)
    )
