"""Nearest-site join over a grid that coarsens until the answer is proven.

Points and sites meet in equal grid cells, a site standing for its own cell and
the eight around it. Whatever is not met lies at least one cell away, so a
point whose best site is nearer than one cell is settled; the others go on to a
grid of twice the width, where they are few. Each round is an equi-join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.geo import EARTH_RADIUS_KM, haversine_km
from meterline.session import delete_path, scratch_path

# Sites that the fullest cell of the first grid should hold at most.
SITES_PER_CELL = 16


def first_cell(sites: DataFrame) -> float:
    """Width in degrees of the first grid's cells, from the sites' box, number and fullest cell; three rows reach the driver."""
    south, north, west, east, n = sites.agg(F.min("s_lat"), F.max("s_lat"), F.min("s_lon"), F.max("s_lon"), F.count("*")).first()
    if not n:
        return 360.0
    width = min(180.0, max(1e-5, math.sqrt(max((north - south) * (east - west), 1e-10) / n)))
    most = sites.groupBy(F.floor(F.col("s_lat") / width), F.floor(F.col("s_lon") / width)).count().agg(F.max("count")).first()[0]
    return max(1e-5, width * math.sqrt(SITES_PER_CELL / max(most, SITES_PER_CELL)))


def _columns_of(width: float) -> int:
    return max(1, math.floor(360 / width))


def _cell(lat: Column, lon: Column, width: float) -> tuple[Column, Column]:
    """(row, column) of the grid; columns divide the circle evenly, each at least ``width`` wide."""
    across = _columns_of(width)
    return F.floor((lat + 90) / width).cast("int"), F.pmod(F.floor((lon + 180) / (360 / across)).cast("int"), F.lit(across))


def unseen_km(lat: Column, width: float) -> Column:
    """No site outside a point's nine cells is nearer than this: one row away, or one column away along the shortest way."""
    north = EARTH_RADIUS_KM * math.radians(width)
    turn = math.radians(min(90.0, 360 / _columns_of(width)))
    return F.least(F.lit(north), F.lit(EARTH_RADIUS_KM) * F.asin(F.cos(F.radians(lat)) * math.sin(turn)))


def valid(lat: Column, lon: Column) -> Column:
    return lat.isNotNull() & lon.isNotNull() & lat.between(-90, 90) & lon.between(-180, 180) & ~F.isnan(lat) & ~F.isnan(lon)


def nearest_join(points: DataFrame, sites: DataFrame, point: tuple[str, str], site: tuple[str, str], site_id: str, out: tuple[str, str] = ("nearest_id", "nearest_km"), cell: float | None = None) -> DataFrame:
    """``points`` with the id of the nearest of ``sites`` and its great-circle distance, both null where there is none.

    ``point`` and ``site`` name latitude and longitude in degrees. Of equally
    near sites the smallest id counts. Points and sites with a missing, NaN or
    impossible coordinate and sites without an id take no part; repeated points
    are looked up once. No sites: every point gets nulls; no points: no rows.
    """
    spark = points.sparkSession
    lat, lon = (points[f"`{c}`"].cast("double") for c in point)
    s_lat, s_lon = (sites[f"`{c}`"].cast("double") for c in site)
    usable = sites.filter(valid(s_lat, s_lon) & sites[f"`{site_id}`"].isNotNull()).select(sites[f"`{site_id}`"].alias("s_id"), s_lat.alias("s_lat"), s_lon.alias("s_lon")).distinct()
    scratch = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        scratch.append(path)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    usable = kept(usable, "nearest-sites")
    # Adding 0.0 makes one zero of the two, so that equal points meet.
    open_points = kept(points.filter(valid(lat, lon)).select((lat + 0.0).alias("p_lat"), (lon + 0.0).alias("p_lon")).distinct(), "nearest-points")
    width, parts = cell or first_cell(usable), []
    while True:
        last = _columns_of(width) <= 3 and 180 / width <= 2
        row, col = _cell(F.col("p_lat"), F.col("p_lon"), width)
        held = open_points.withColumn("row", row).withColumn("col", col)
        row, col = _cell(F.col("s_lat"), F.col("s_lon"), width)
        around = F.explode(F.array_distinct(F.array(*[F.struct((row + i).alias("row"), F.pmod(col + j, F.lit(_columns_of(width))).alias("col")) for i in (-1, 0, 1) for j in (-1, 0, 1)])))
        spread = usable.withColumn("around", around).select("s_id", "s_lat", "s_lon", "around.row", "around.col")
        km = haversine_km("p_lat", "p_lon", "s_lat", "s_lon")
        met = held.join(spread, ["row", "col"], "left").groupBy("p_lat", "p_lon").agg(F.min(F.when(F.col("s_id").isNotNull(), F.struct(km.alias("km"), F.col("s_id").alias("id")))).alias("best"))
        # Compared with a margin for the rounding of both distances.
        proven = F.lit(last) | (F.col("best.km") * (1 + 1e-9) + 1e-9 < unseen_km(F.col("p_lat"), width))
        met = kept(met.withColumn("proven", F.coalesce(proven, F.lit(False))), "nearest-round")
        parts.append(met.filter("proven").select("p_lat", "p_lon", "best"))
        open_points = met.filter("NOT proven").select("p_lat", "p_lon")
        if last or not open_points.limit(1).count():
            break
        width = min(360.0, width * 2)
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    found = found.select("p_lat", "p_lon", F.col("best.id").alias(out[0]), F.col("best.km").alias(out[1]))
    on = (lat + 0.0 == found["p_lat"]) & (lon + 0.0 == found["p_lon"])
    joined = points.join(found, on, "left").select(*[points[f"`{c}`"] for c in points.columns], *out)
    path = scratch_path(spark, "nearest-result")
    joined.write.parquet(path)
    for used in scratch:
        delete_path(spark, used)
    return spark.read.schema(joined.schema).parquet(path)
