"""Joins of coordinates with the places around them.

Places are gathered into cells: rows of equal latitude, each cut into columns about as wide
as the row is high, so fewer columns towards the poles. A cell is summed up by one of its
places and a reach: no place of the cell is farther from that place than the reach. By the
triangle inequality a cell is then at least ``distance - reach`` and its nearest place at most
``distance`` away, so whole cells are ruled out without reading their places.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplens.functions.geo import EARTH_RADIUS_KM, KM_PER_DEGREE, haversine_km
from triplens.session import cut

# A cell with more places than this is split into SPLIT x SPLIT cells of the next level.
LEAF_PLACES = 256
_SPLIT_BITS = 3
SPLIT = 1 << _SPLIT_BITS
# The last level has cells of radius / 2**36, less than a micrometre for a radius of 50 km: no
# two coordinates that a gazetteer tells apart share one.
DEEPEST = 12
_BITS = DEEPEST * _SPLIT_BITS
# Absorbs rounding where cells and reaches are compared with distances.
MARGIN = 1.0001
# Places, counted, are broadcast up to this many rows (tens of megabytes).
BROADCAST_ROWS = 200_000


def _on_map(rows: DataFrame) -> DataFrame:
    """Rows whose lng lies in [-180, 180): the date line has one name."""
    lng = F.col("lng")
    return rows.withColumn("lng", F.when(lng >= 180.0, lng - 360.0).otherwise(lng))


def _row(lat: Column, size: float) -> Column:
    return F.floor(lat / F.lit(size)).cast("long")


def _columns(row: Column, size: float) -> Column:
    """Number of columns of a row, from the length of its edge nearer to the equator."""
    edge = F.when(row >= 0, row).otherwise(-row - 1) * F.lit(size)
    around = F.lit(360.0) * F.cos(F.radians(F.least(edge, F.lit(90.0))))
    return F.greatest(F.floor(around / F.lit(size)), F.lit(1)).cast("long")


def _column(lng: Column, columns: Column) -> Column:
    return F.floor((lng + 180.0) / 360.0 * columns).cast("long")


def _cover(points: DataFrame, radius_km: float, size: float) -> DataFrame:
    """Repeat every point (lat, lng) for each cell (_row, _col) within the radius.

    The number of cells depends on the radius only: the columns widen towards the poles just
    as the circle does.
    """
    reach = radius_km * MARGIN / KM_PER_DEGREE
    angle = min(radius_km * MARGIN / EARTH_RADIUS_KM, math.pi / 2)
    # Half-width in longitude of a circle around this latitude; all around when it holds a pole.
    ratio = F.lit(math.sin(angle)) / F.cos(F.radians("lat"))
    around = (F.abs("lat") + reach >= 90.0) | (ratio >= 1.0)
    width = F.when(around, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(ratio, F.lit(1.0)))))
    rows = F.sequence(_row(F.col("lat") - reach, size), _row(F.col("lat") + reach, size))
    columns = F.col("_columns")
    first = _column(F.col("lng") - width, columns)
    last = F.least(_column(F.col("lng") + width, columns), first + columns - 1)
    wrapped = F.transform(F.sequence(first, last), lambda column: F.pmod(column, columns))
    return (
        points.withColumn("_row", F.explode(rows))
        .withColumn("_columns", _columns(F.col("_row"), size))
        .withColumn("_col", F.explode(wrapped))
        .drop("_columns")
    )


def _summed_up(places: DataFrame, by: list[str]) -> DataFrame:
    """One row per group of ``by``: a place of it (any will do) and the reach."""
    # A straight line on the map between two places of the group is no longer than this, and
    # the way over the globe is no longer than the line.
    tall = F.max("lat") - F.min("lat")
    wide = (F.max("lng") - F.min("lng")) * F.max(F.cos(F.radians("lat")))
    return places.groupBy(*by).agg(
        # Both come from the same row.
        F.first("lat").alias("_rep_lat"),
        F.first("lng").alias("_rep_lng"),
        (F.hypot(tall, wide) * KM_PER_DEGREE * MARGIN).alias("_reach"),
        F.count(F.lit(1)).alias("_n"),
    )


def _beside(places: DataFrame, rows: int) -> DataFrame:
    """Places as the side of a join: broadcast when counted to be few, sort-merged otherwise.

    Spark's own estimate does not know how many rows the cover of the other side makes, so it
    is not left to choose a broadcast here. Sort-merge joins split skewed cells at run time.
    """
    return F.broadcast(places) if rows <= BROADCAST_ROWS else places.hint("merge")


def _distance(lat: str, lng: str) -> Column:
    return haversine_km(F.col("lat"), F.col("lng"), F.col(lat), F.col(lng))


def cell_tree(places: DataFrame, size: float) -> tuple[list[DataFrame], DataFrame, list[int]]:
    """Cells of distinct ``places`` (lat, lng, ...), split where they hold more than ``LEAF_PLACES``.

    Returns the cells of each level (_row, _col, _rep_lat, _rep_lng, _reach, _n), the places with
    their leaf (_level, _row, _col), and the number of places each level was made from. Level 0 has
    the grid of ``size`` degrees; the places of its full cells alone are looked at on the next, which has
    SPLIT x SPLIT cells in one, and so on. Cells of a level are bits of one fine grid, so they
    nest exactly.
    """
    fine = float(1 << _BITS)
    row = F.floor(F.col("lat") / F.lit(size) * fine).cast("long")
    columns = _columns(F.shiftright("_fine_row", _BITS), size)
    column = F.floor((F.col("lng") + 180.0) / 360.0 * columns * fine).cast("long")
    pending = cut(places.withColumn("_fine_row", row).withColumn("_fine_col", column))
    levels, leaves, counts = [], None, [pending.count()]
    for level in range(DEEPEST + 1):
        shift = _BITS - level * _SPLIT_BITS
        here = pending.withColumn("_row", F.shiftright("_fine_row", shift)).withColumn("_col", F.shiftright("_fine_col", shift))
        cells = cut(_summed_up(here, ["_row", "_col"]))
        levels.append(cells)
        full = cells.where(F.col("_n") > LEAF_PLACES) if level < DEEPEST else cells.limit(0)
        split = 0 if level == DEEPEST else full.count()
        # At most one full cell for LEAF_PLACES places; few of them are broadcast, after this count.
        keys = _beside(full.select("_row", "_col"), split)
        settled = here.join(keys, ["_row", "_col"], "left_anti") if split else here
        settled = settled.withColumn("_level", F.lit(level)).select("_level", "_row", "_col", *places.columns)
        leaves = settled if leaves is None else leaves.unionByName(settled)
        if not split:
            break
        pending = cut(here.join(keys, ["_row", "_col"], "left_semi").select(*places.columns, "_fine_row", "_fine_col"))
        counts.append(pending.count())
    return levels, leaves, counts


def nearest(
    points: DataFrame, places: DataFrame, radius_km: float, point_key: list[str], value: str
) -> DataFrame:
    """``value`` of the nearest place within ``radius_km``; points with none keep NULL.

    ``points`` has ``point_key`` (unique) and (lat, lng) and should be a stored table;
    ``places`` has (lat, lng, value). Equal distances: the smallest value wins. Candidate
    cells are followed down the tree only where they are full and can still hold the nearest
    place, so a point next to a crowd is compared with cell summaries and with the places of a
    few leaves, none of which holds more than ``LEAF_PLACES``. Copies of a place collapse before
    the join.
    """
    size = radius_km / KM_PER_DEGREE
    distinct = _on_map(places).groupBy("lat", "lng").agg(F.min(value).alias("_value"))
    levels, leaves, counts = cell_tree(distinct, size)

    by_point = Window.partitionBy(*point_key)
    possible = F.col("_d") - F.col("_reach") <= F.col("_best")
    summary = ["_rep_lat", "_rep_lng", "_reach", "_n"]
    held = [*points.columns, "_best", "_level", "_row", "_col", "_d", "_reach", "_n"]
    asked = _cover(_on_map(points), radius_km, size).withColumn("_best", F.lit(radius_km * MARGIN))
    found = settled = None
    for level, cells in enumerate(levels):
        if level:
            # Full cells give way to the cells in them; the others wait for the end.
            settled, asked = found.where(F.col("_n") <= LEAF_PLACES), found.where(F.col("_n") > LEAF_PLACES)
            asked = asked.drop("_level", "_d", "_reach", "_n").withColumnsRenamed({"_row": "_up_row", "_col": "_up_col"})
            up = [F.shiftright(name, _SPLIT_BITS).alias(f"_up{name}") for name in ("_row", "_col")]
            joined = asked.join(_beside(cells.select("_row", "_col", *summary, *up), counts[level]), ["_up_row", "_up_col"])
        else:
            joined = asked.join(_beside(cells.select("_row", "_col", *summary), counts[0]), ["_row", "_col"])
        # What the level above already ruled out does not reach the shuffle by point.
        found = joined.withColumn("_d", _distance("_rep_lat", "_rep_lng")).withColumn("_level", F.lit(level)).where(possible).select(*held)
        if settled is not None:
            found = found.unionByName(settled)
        found = found.withColumn("_best", F.least("_best", F.min("_d").over(by_point) * MARGIN)).where(possible)
        if level + 1 < len(levels):
            # The next level reads what is found twice.
            found = cut(found)
    places_in = leaves.select("_level", "_row", "_col", F.col("lat").alias("_lat"), F.col("lng").alias("_lng"), "_value")
    matched = (
        found.join(_beside(places_in, counts[0]), ["_level", "_row", "_col"])
        .withColumn("_d", _distance("_lat", "_lng"))
        .where(F.col("_d") <= radius_km)
        .groupBy(*point_key)
        .agg(F.min(F.struct("_d", "_value"))["_value"].alias(value))
    )
    return points.join(matched, point_key, "left")


def nearby_names(
    points: DataFrame, places: DataFrame, radius_km: float, point_key: list[str], name: str = "name"
) -> DataFrame:
    """Distinct (point_key, name) of all places within ``radius_km``.

    Places are first gathered by cell and name: one is enough to settle a name, so copies and
    chains inside a cell cost one row. Only groups the circle's edge runs through are looked
    at place by place.
    """
    size = radius_km / KM_PER_DEGREE / 4
    row = _row(F.col("lat"), size)
    cells = cut(
        _on_map(places).select("lat", "lng", F.col(name).alias("_name")).distinct().withColumns({
            "_row": row, "_col": _column(F.col("lng"), _columns(row, size)),
        })
    )
    count = cells.count()
    met = (
        _cover(_on_map(points).select(*point_key, "lat", "lng"), radius_km, size)
        .join(_beside(_summed_up(cells, ["_row", "_col", "_name"]), count), ["_row", "_col"])
        .withColumn("_d", _distance("_rep_lat", "_rep_lng"))
        .where(F.col("_d") - F.col("_reach") <= radius_km)
    )
    inside = met.where(F.col("_d") <= radius_km)
    unsettled = met.where(F.col("_d") > radius_km)
    single = cells.select(
        "_row", "_col", "_name", F.col("lat").alias("_lat"), F.col("lng").alias("_lng")
    )
    at_edge = unsettled.join(_beside(single, count), ["_row", "_col", "_name"]).where(
        _distance("_lat", "_lng") <= radius_km
    )
    wanted = [*point_key, F.col("_name").alias(name)]
    return inside.select(*wanted).unionByName(at_edge.select(*wanted)).distinct()
