"""Station to basin: strict point-in-polygon (J-08).

Spark has no containment test and a bounding-box condition alone would pair
every point with every polygon in a nested loop.  Polygons are therefore covered
by the cells of a quadtree, each polygon as fine as its own edges ask for, and
points meet them by cell and depth: an equi-join that Spark can broadcast when it
measures the cover to be small, and otherwise shuffle with its skew handling.
A cell that no edge of the polygon can decide holds none: it lies inside and
answers by itself.

Points are reduced to distinct coordinates first, so a place that holds a
large share of all rows is tested once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Size of the cells that are not split, edges that a cell may hold, and how often a cell may be split.
ROOT, MOST_EDGES, DEPTH = 16.0, 32, 6
#: Splits after which cells are dealt to all tasks.
DEALT_AT = 2
#: Share of a cell's size that rounding may put a coordinate beside it.
SLACK = 1e-6


def contains_strictly(edges: Column, x: Column, y: Column, beyond: Column | None = None) -> Column:
    """Even-odd ray test, with points on an edge or vertex outside; ``beyond`` counts crossings beside those of ``edges``."""

    def crosses(e: Column) -> Column:
        at = (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
        return ((e["y1"] > y) != (e["y2"] > y)) & (x < at)

    def touches(e: Column) -> Column:
        cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
        return (
            (cross == 0)
            & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        )

    count = F.size(F.filter(edges, crosses)) + (F.lit(0) if beyond is None else beyond)
    return ~F.exists(edges, touches) & (count % 2 == 1)


def _index(value: Column, root: float, depth: Column | int) -> Column:
    """The number of the cell of a depth; exact halves, so a cell's children are its halves for every value."""
    return F.floor(value / F.lit(float(root)) * F.pow(F.lit(2.0), depth if isinstance(depth, Column) else F.lit(depth))).cast("long")


def _cut(depth: str, cx: str, cy: str, cell: str, root: float) -> str:
    """A part of a cell with the edges that decide for its points, as SQL text: one expression to parse for a level of the tree.

    A ray towards larger x from a point of the part can meet only edges that reach its height and are not left of it.
    Those that are right of it are met or not by the height of the point alone: ``odd`` says whether their number is odd at
    the part's lower end, ``turns`` at which heights that changes.  Two edges of one corner turn it twice there, hence not
    at all, so however many edges lie to the right, few turns are left.
    """
    size = f"({float(root)}D / power(2D, {depth}))"
    reaches = "greatest(e.y1, e.y2) >= b.low AND least(e.y1, e.y2) <= b.high"
    beside = f"{reaches} AND least(e.x1, e.x2) > b.right"
    turned = f"""sort_array(filter(concat({cell}.turns, flatten(transform(filter({cell}.edges, e -> {beside}), e -> array(e.y1, e.y2)))),
        t -> t > b.low AND t <= b.high))"""
    # Of a run of equal heights the last stands for it, if there is an odd number of them.
    odd_ones = """transform(filter(transform(s, (v, i) -> named_struct('v', v, 'i', i)),
        r -> coalesce(get(s, r.i + 1) <> r.v, true) AND (r.i - array_position(s, r.v)) % 2 <> 0), r -> r.v)"""
    return f"""transform(array(named_struct(
        'left', ({cx} - {SLACK}D) * {size}, 'right', ({cx} + 1 + {SLACK}D) * {size},
        'low', ({cy} - {SLACK}D) * {size}, 'high', ({cy} + 1 + {SLACK}D) * {size})), b -> named_struct(
      'depth', {depth}, 'cx', CAST({cx} AS BIGINT), 'cy', CAST({cy} AS BIGINT),
      'edges', filter({cell}.edges, e -> {reaches} AND greatest(e.x1, e.x2) >= b.left AND least(e.x1, e.x2) <= b.right),
      'odd', ({cell}.odd + size(filter({cell}.turns, t -> t <= b.low)) + size(filter({cell}.edges, e -> {beside} AND (e.y1 > b.low) <> (e.y2 > b.low)))) % 2,
      'turns', transform(array({turned}), s -> {odd_ones})[0]
    ))[0]"""


def cover(basins: DataFrame, root: float = ROOT, most: int = MOST_EDGES, deepest: int = DEPTH) -> DataFrame:
    """(basin_ord, name, depth, cx, cy, edges, odd, turns): the quadtree cells of every basin that hold points of it.

    A cell with more than ``most`` edges is split into four, ``deepest`` times at most, each quarter with the edges that matter
    to it: the work is in proportion to the edges and the depth they need, wherever they crowd.  Cells that no edge
    touches lie wholly inside (``odd`` is 1, no ``turns``) or are left out.
    """
    bounds = F.col("bounds")
    columns = F.explode(F.sequence(_index(bounds["xmin"], root, 0), _index(bounds["xmax"], root, 0)))
    rows = F.explode(F.sequence(_index(bounds["ymin"], root, 0), _index(bounds["ymax"], root, 0)))
    whole = F.struct("edges", F.lit(0).alias("odd"), F.array().cast("array<double>").alias("turns")).alias("c")
    cells = basins.filter(F.size("edges") > 0).select("basin_ord", "name", "bounds", whole, columns.alias("cx"))
    cells = cells.select("basin_ord", "name", "c", "cx", rows.alias("cy")).select("basin_ord", "name", F.expr(_cut("0", "cx", "cy", "c", root)).alias("c"))
    quarter = _cut("c.depth + 1", "(c.cx * 2 + i % 2)", "(c.cy * 2 + i div 2)", "c", root)
    for depth in range(deepest):
        split = F.expr(f"explode(CASE WHEN c.depth = {depth} AND size(c.edges) > {most} THEN transform(sequence(0, 3), i -> {quarter}) ELSE array(c) END)")
        cells = cells.select("basin_ord", "name", split.alias("c")).filter("size(c.edges) > 0 OR size(c.turns) > 0 OR c.odd = 1")
        if depth + 1 == min(DEALT_AT, deepest):
            cells = cells.repartition("basin_ord", "c.depth", "c.cx", "c.cy")
    return cells.select("basin_ord", "name", "c.*")


def locate(
    points: DataFrame, basins: DataFrame, longitude: str, latitude: str,
    root: float = ROOT, most: int = MOST_EDGES, deepest: int = DEPTH,
) -> DataFrame:
    """(longitude, latitude, name) of the distinct points inside a basin; the last basin wins."""
    x, y = F.col("_x"), F.col("_y")
    places = (
        points.select(F.col(longitude).alias("_x"), F.col(latitude).alias("_y"))
        .filter(x.isNotNull() & y.isNotNull())
        .distinct()
    )
    # A point asks once a depth, whatever the number of cells.
    asked = places.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(deepest))))
    asked = asked.withColumns({"cx": _index(x, root, F.col("depth")), "cy": _index(y, root, F.col("depth"))})
    beyond = F.col("odd") + F.size(F.filter("turns", lambda t: t <= y))
    inside = asked.join(cover(basins, root, most, deepest), ["depth", "cx", "cy"]).filter(contains_strictly(F.col("edges"), x, y, beyond))
    return inside.groupBy("_x", "_y").agg(F.max_by("name", "basin_ord").alias("_basin"))


def assign_basin(
    df: DataFrame, basins: DataFrame, longitude: str, latitude: str, output: str, **limits
) -> DataFrame:
    """Add the name of the basin that holds each row's point, NULL without one."""
    located = locate(df, basins, longitude, latitude, **limits)
    x, y = F.col(longitude), F.col(latitude)
    placed = x.isNotNull() & y.isNotNull()
    joined = df.where(placed).join(located, (x == F.col("_x")) & (y == F.col("_y")), "left")
    # Rows without a point would all meet in one task of the join.
    rest = df.where(~placed).withColumn(output, F.lit(None).cast("string"))
    return joined.withColumn(output, F.col("_basin")).drop("_x", "_y", "_basin").unionByName(rest)
