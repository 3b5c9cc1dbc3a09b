"""CSV, JSON and XML sinks (SNK-01..SNK-07).

A table is a folder of part files, each with a header.  ``single_file`` puts
everything through one task and is meant for small exports only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caudal import dictionaries as D
from caudal import schemas as S
from caudal.session import scratch_dir
from caudal.sinks.named import records_as_files, shuffle_partitions, write_named
from caudal.sinks.tables import Table, partition_folder, write_tables


def _printable(df: DataFrame) -> DataFrame:
    """Booleans as ``True``/``False``, the spelling importers of these tables expect."""
    return df.select(
        [
            F.initcap(F.col(n).cast("string")).alias(n) if t == "boolean" else F.col(n)
            for n, t in df.dtypes
        ]
    )


def write_csv(
    df: DataFrame, path: str, order_by: list[str] | None = None, single_file: bool = False,
    partition_by: list[str] | None = None, mode: str = "overwrite",
) -> None:
    """Header, no index, NULL as empty field (SNK-01).

    ``order_by`` sorts over the part files by range.  A hash of the row breaks
    ties, so that rows of one frequent value still spread over several files.
    """
    out = _printable(df)
    if order_by:
        out = out.orderBy(*order_by, F.xxhash64(*out.columns))
    if single_file:
        out = out.coalesce(1)
    writer = out.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw rows as JSON lines, every batch of them (SNK-04)."""
    df.write.mode(mode).json(path)


def write_result(df: DataFrame, path: str, format: str = "csv") -> None:
    """Any result as a table or as JSON (SNK-06)."""
    if format == "csv":
        write_csv(df, path)
    elif format == "json":
        write_json(df, path)
    else:
        raise ValueError(f"unknown result format {format!r}")


def write_observations(observations: DataFrame, path: str, mode: str = "append") -> None:
    """Observations (series_id, timestart, ...) in ``day=`` folders, clustered by series (F-05).

    Rows are sorted by range over day, series and time: a file holds few series of few days, so its minima and maxima and
    a Bloom filter on the id tell a reader of some series which files to skip, and a day or series of any size is split.
    ``read_observations`` reads this layout and leaves out days and files.  Rows without a start lie in a folder of their own.
    """
    from caudal.operators.statistics import utc_day

    dated = observations.withColumn("day", utc_day(observations, "timestart"))
    order = ["day", "series_id", "timestart"]
    (
        dated.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).partitionBy("day")
        .option("parquet.bloom.filter.enabled#series_id", "true").parquet(path)
    )


def write_scratch(df: DataFrame, label: str) -> DataFrame:
    """The table written once in the shared scratch folder and read back."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _conformed(rows: DataFrame, columns: list[str]) -> list[Column]:
    """The columns of :func:`conform` as expressions, in the spelling of the tables."""
    kinds = dict(rows.dtypes)
    known = [F.col(f"`{c}`") if c in kinds else F.lit(None).cast(S.column_type(c)) for c in columns]
    return [F.initcap(x.cast("string")) if kinds.get(c) == "boolean" else x for c, x in zip(columns, known, strict=True)]


def write_by_variable(
    series: DataFrame, path: str, fixed: dict[str, list[str]] | None = None,
) -> None:
    """One table per variable name (SNK-02, A-07), all in one job.

    Variables with a fixed column list go to ``<path>/<name>.csv`` with exactly
    those columns.  All others keep their columns and go to
    ``<path>/other/variableName=<name>``; the name is dropped from the files.
    """
    fixed = S.SERIES_COLUMNS if fixed is None else fixed
    name, rest = F.col("variableName"), [c for c in series.columns if c != "variableName"]
    tables = [Table(f"{n}.csv", name == n, _conformed(series, columns), columns) for n, columns in fixed.items()]
    # A row without a name is in no fixed table either.
    others = F.coalesce(~name.isin(list(fixed)), F.lit(True)) if fixed else F.lit(True)
    tables.append(Table(partition_folder("other", "variableName", name), others, _conformed(series, rest), rest))
    order = [c for c in ("STATION_ID", "EXTERNAL_PARAMETER_ID") if c in series.columns]
    write_tables(series, path, tables, order, cleared=["other"])


def write_steps(
    series: DataFrame, variables: DataFrame | None, path: str, separate: bool = True, combined: bool = True,
    whole: str | None = None,
) -> None:
    """Catalogue B tables per variable and time step, per quantity (SNK-03, U-02) and as a ``whole``, all in one job.

    Variables outside the known file names are written as ``<path>/other/name=INA_<nombre>``, named by the variable
    table, or by their id where it does not name them.
    """
    variable, rows = F.col("EXTERNAL_PARAMETER_ID"), series
    tables: list[Table] = []
    if whole:
        tables.append(Table(whole, F.lit(True), _conformed(series, series.columns), series.columns))

    def quantity(folder: str, where: Column, name: str) -> Table:
        columns = S.SERIES_COLUMNS[name]
        median = series.withColumn("THRESHOLD_MEAN", F.lit(None).cast("double")) if "THRESHOLD_MEAN" not in series.columns else series
        values = dict(zip(columns, _conformed(median, columns), strict=True))
        # The mean threshold is the median there (P-14).
        values["THRESHOLD_MEAN"] = F.col("THRESHOLD_P50") if "THRESHOLD_P50" in series.columns else F.lit(None).cast("double")
        return Table(folder, where, [values[c] for c in columns], columns)

    if separate:
        known = list(D.TABLE_BY_VARIABLE)
        tables += [quantity(f"{name}.csv", variable == i, D.CONFORMED_VARIABLES[i]) for i, name in D.TABLE_BY_VARIABLE.items()]
        label = variable.cast("string")
        if variables is not None:
            names = variables.groupBy(F.col("id").alias("_variable")).agg(F.min("nombre").alias("_nombre"))
            rows = series.join(names, variable == F.col("_variable"), "left")
            label = F.coalesce("_nombre", label)
        others = F.coalesce(~variable.isin(known), F.lit(True))
        folder = partition_folder("other", "name", F.concat(F.lit("INA_"), label))
        tables.append(Table(folder, others, _conformed(series, series.columns), series.columns))
    if combined:
        tables += [quantity(f"{name}.csv", variable.isin(ids), table) for name, (table, ids) in D.COMBINED_TABLES.items()]
    write_tables(rows, path, tables, ["STATION_ID", "EXTERNAL_PARAMETER_ID"], cleared=["other"] if separate else [])


def with_schema_location(metadata) -> "Column":  # noqa: F821
    """Set the schema location attribute on the root element of an XML text."""
    declared = r"\s(?:[\w.-]+:)?schemaLocation\s*=\s*(?:\"[^\"]*\"|'[^']*')"
    root = r"(?s)^(\s*(?:<\?.*?\?>|<!--.*?-->|\s)*<[\w.:-]+)([^>]*?)(/?>)"
    head = F.regexp_extract(metadata, root, 0)
    start = F.regexp_extract(metadata, root, 1)
    attributes = F.regexp_replace(F.regexp_extract(metadata, root, 2), declared, "")
    prefix = F.when(
        attributes.contains("xmlns:xsi="), F.lit("")
    ).otherwise(F.lit(' xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance"'))
    location = F.lit(f' xsi:schemaLocation="{D.RECORD_SCHEMA_LOCATION}"')
    tail = F.substr(metadata, F.length(head) + 1)
    end = F.regexp_extract(metadata, root, 3)
    return F.when(head != "", F.concat(start, attributes, prefix, location, end, tail)).otherwise(metadata)


def records_as_xml(records: DataFrame) -> DataFrame:
    """(identifier, value): every record's XML with its schema location (SNK-05)."""
    return records.filter(F.col("metadata").isNotNull()).select(
        "identifier", with_schema_location(F.col("metadata")).alias("value")
    )


def write_records_xml(records: DataFrame, path: str, per_record: bool = False, index: str | None = None) -> None:
    """Record XML as one table of (identifier, value), or as a file ``<identifier>.xml`` per record.

    A file per record is what a consumer of single files needs, but millions of
    small files are not a table; the table is the default.  ``index`` is a folder for a table of the files' names.
    """
    if per_record:
        # By number: small files take time each, and partitions merged by their bytes would leave them to a few tasks.
        dealt = records_as_files(records).repartition(shuffle_partitions(records.sparkSession), "name")
        write_named(dealt, path, index=index)
    else:
        records_as_xml(records).write.mode("overwrite").parquet(path)
