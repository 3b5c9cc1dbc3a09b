"""Saved tables: series CSV and basin polygons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal import schemas as S


def read_series_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A series table written earlier, all parts of its folder (SRC-16)."""
    # Declared by position: the header is checked against the schema.  Fields may hold line breaks; a
    # value that does not fit its column fails the read.
    return (
        spark.read.schema(S.series_csv_schema(columns))
        .option("header", True).option("enforceSchema", False).option("escape", '"')
        .option("multiLine", True).option("mode", "FAILFAST").csv(path)
    )


def read_basins(spark: SparkSession, path: str) -> DataFrame:
    """(basin_ord, name, edges, bounds) of the polygons of GeoJSON files (SRC-14), in order of file and place."""
    features = (
        spark.read.schema(S.BASINS_GEOJSON).option("multiLine", True).option("mode", "FAILFAST")
        .json(path)
        .select(F.col("_metadata.file_path").alias("file"), F.posexplode("features").alias("place", "f"))
        .select(F.struct("file", "place").alias("basin_ord"), "f")
    )
    # A Polygon nests its rings one level less than a MultiPolygon; both end as
    # one list of rings, since holes and parts count alike for even-odd parity.
    polygon = F.from_json("f.geometry.coordinates", "ARRAY<ARRAY<ARRAY<DOUBLE>>>")
    multi = F.flatten(F.from_json("f.geometry.coordinates", "ARRAY<ARRAY<ARRAY<ARRAY<DOUBLE>>>>"))
    rings = F.when(F.col("f.geometry.type") == "MultiPolygon", multi).otherwise(polygon)
    # Coordinates that cannot be read fail the job: a basin never vanishes.
    unread = F.col("f.geometry.coordinates").isNotNull() & (
        F.coalesce(F.exists(F.flatten(F.flatten(rings)), lambda c: c.isNull()), F.lit(True))
    )
    rings = F.when(unread, F.raise_error(F.concat(F.lit("MALFORMED coordinates in "), F.col("basin_ord.file")))).otherwise(rings)
    return basins_from_rings(
        features.select("basin_ord", F.col("f.properties.nombre_3").alias("name"), rings.alias("rings"))
    )


def basins_from_rings(rows: DataFrame) -> DataFrame:
    """Edges and bounds of polygons given as (basin_ord, name, rings of [x, y] points)."""

    def ring_edges(ring):
        return F.transform(
            F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))),
            lambda p, i: F.struct(
                p[0].alias("x1"), p[1].alias("y1"),
                F.get(F.get(ring, i + 1), F.lit(0)).alias("x2"),
                F.get(F.get(ring, i + 1), F.lit(1)).alias("y2"),
            ),
        )

    edges = rows.select("basin_ord", "name", F.flatten(F.transform("rings", ring_edges)).alias("edges"))

    def bound(agg, axis):
        return agg(F.transform("edges", lambda e: e[axis]))

    return edges.select(
        "*",
        F.struct(
            bound(F.array_min, "x1").alias("xmin"), bound(F.array_max, "x1").alias("xmax"),
            bound(F.array_min, "y1").alias("ymin"), bound(F.array_max, "y1").alias("ymax"),
        ).alias("bounds"),
    )
