"""Session settings and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

RECOMMENDED_CONF = {
    # Results are defined in UTC (availability thresholds, months of observations).
    "spark.sql.session.timeZone": "UTC",
    # Runtime sizes decide between broadcast and sort-merge, split skewed join
    # partitions and merge small ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keep splitting a skewed join even where it costs the plan one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Building a plan from Python should not record a stack trace per column.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "caudal", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(RECOMMENDED_CONF)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (tests, a laptop) gets a local folder where that setting is absent; on a
    cluster each executor would write to its own disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix=f"{label}-")


def literal_table(spark: SparkSession, schema: str, rows: list[tuple]) -> "DataFrame":  # noqa: F821
    """A fixed table as an inline VALUES relation: its size is known to the planner."""
    from pyspark.sql.types import _parse_datatype_string

    fields = _parse_datatype_string(schema).fields

    def text(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return repr(value)

    values = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    names = ", ".join(f.name for f in fields)
    cols = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields)
    return spark.sql(f"SELECT {cols} FROM VALUES {values} AS t({names})")
