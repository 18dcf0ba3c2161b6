"""Exact k nearest places of each origin within its zone: a best-first descent of a cell tree."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courierflow.functions.geo import EARTH_RADIUS_KM, haversine_km

#: Degrees that hold the globe on either side of 0. Each level has cells a sixteenth as wide as the one above.
WIDEST, BITS = 512.0, 4
#: Kilometres that a cell may lie beyond the bound: distances are rounded to 6 digits before they are ranked.
SLACK_KM = 3e-6


def _reach(low: Column, high: Column) -> tuple[Column, Column]:
    """Least and greatest sin^2 of half an angle (in degrees) between two others."""

    def holds(turn: float) -> Column:  # a multiple of 360 degrees beside ``turn``
        return F.floor((high - turn) / 360) >= F.ceil((low - turn) / 360)

    a, b = (F.pow(F.sin(F.radians(x) / 2), 2) for x in (low, high))
    return F.when(holds(0.0), 0.0).otherwise(F.least(a, b)), F.when(holds(180.0), 1.0).otherwise(F.greatest(a, b))


def _distances(size: float) -> tuple[Column, Column]:
    """No place of the cell ``_r``, ``_c`` lies nearer or farther from ``_lat``, ``_lon`` than these kilometres."""
    south, west = F.col("_r") * F.lit(size), F.col("_c") * F.lit(size)
    north, east = F.least(south + size, F.lit(90.0)), west + size
    south = F.greatest(south, F.lit(-90.0))
    lat_near, lat_far = _reach(south - F.col("_lat"), north - F.col("_lat"))
    lon_near, lon_far = _reach(west - F.col("_lon"), east - F.col("_lon"))
    a, b = F.cos(F.radians(south)), F.cos(F.radians(north))
    narrow, wide = F.least(a, b), F.when((south <= 0) & (north >= 0), 1.0).otherwise(F.greatest(a, b))
    here = F.cos(F.radians("_lat"))
    chords = lat_near + here * F.greatest(narrow, F.lit(0.0)) * lon_near, lat_far + here * wide * lon_far
    return tuple(F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(c, F.lit(1.0)))) for c in chords)


def nearest_k(
    origins: DataFrame,
    places: DataFrame,
    k: int,
    origin_id: str,
    place_id: str,
    zone: str = "zone_id",
    finest: float = WIDEST / 2**24,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``k`` rows per origin with ``distance_km`` and ``rank``; all of a smaller zone.

    Places are counted per cell of ``finest`` degrees at most (3.4 m), and the counts summed up to cells
    that hold the globe. Each origin descends from there: at every level it adds up its cells by
    their farthest point until they hold ``k`` places, which bounds the distance of the k-th, and
    keeps the cells that reach within this bound. So a search goes on with a few cells near its
    bound however far away or crowded the places are, and only the places of its last cells are looked at.
    Only the ``k`` smallest ids of one position can be in a result, so co-located places are cut to
    ``k`` first. Ties go to the smaller id. Rows without a position take no part.
    """
    depth = max(1, ceil(log2(WIDEST / finest) / BITS))
    size = WIDEST / 2 ** (BITS * depth)
    cell = [zone, "_r", "_c"]
    at = places.where("lat IS NOT NULL AND lon IS NOT NULL").select(
        zone, place_id, "lat", "lon", *carry,
        F.floor(F.col("lat") / size).alias("_r"), F.floor(F.col("lon") / size).alias("_c")).repartition(*cell)
    here = Window.partitionBy(*cell, "lat", "lon").orderBy(place_id)
    spots = at.withColumn("_n", F.row_number().over(here)).where(F.col("_n") <= k).drop("_n")
    counts = spots.groupBy(*cell).agg(F.count("*").alias("_n"))

    def children(level: int) -> DataFrame:
        """The cells of a level with their counts, packed by the cell above: 256 at most."""
        up = lambda c, n: F.shiftright(c, BITS * (depth - n))
        cells = counts.groupBy(zone, up("_r", level).alias("_r"), up("_c", level).alias("_c")).agg(F.sum("_n").alias("_n"))
        above = [F.shiftright(c, BITS) if level > 1 else F.lit(0).cast("long") for c in ("_r", "_c")]
        packed = cells.groupBy(zone, above[0].alias("_up_r"), above[1].alias("_up_c"))
        return packed.agg(F.collect_list(F.struct("_r", "_c", "_n")).alias("_cells")).withColumnRenamed(zone, "_zone")

    base = origins.where("lat IS NOT NULL AND lon IS NOT NULL")
    front = base.select(
        origin_id, zone, F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), *[F.lit(0).cast("long").alias(c) for c in ("_r", "_c")])
    own = Window.partitionBy(origin_id, zone)
    for level in range(1, depth + 1):
        below = children(level)
        same = (front[zone] == below["_zone"]) & (front["_r"] == below["_up_r"]) & (front["_c"] == below["_up_c"])
        near, far = _distances(WIDEST / 2 ** (BITS * level))
        found = front.join(below, same).select(origin_id, front[zone], "_lat", "_lon", F.inline("_cells"))
        held = found.select("*", near.alias("_near"), far.alias("_far")).withColumn("_held", F.sum("_n").over(own.orderBy("_far")))
        bound = F.min(F.when(F.col("_held") >= k, F.col("_far"))).over(own)
        front = held.withColumn("_bound", bound).where(F.col("_bound").isNull() | (F.col("_near") <= F.col("_bound") + SLACK_KM))

    km = F.round(haversine_km(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon")), 6)
    pairs = front.join(spots, cell).select(origin_id, zone, place_id, *carry, km.alias("distance_km"))
    ranked = pairs.withColumn("rank", F.row_number().over(own.orderBy("distance_km", place_id)))
    return ranked.where(F.col("rank") <= k)
