"""Geographic enrichment.

Geometries stay JSON text until needed and are parsed with ``from_json``; centroids are
higher-order array expressions (``aggregate`` over ``sequence``), so they run in
whole-stage code with no Python. No size is assumed for the grid reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch import schema as S
from cellwatch.functions.columns import round6

POLYGON_DDL = "type string, coordinates array<array<array<double>>>"
MULTIPOLYGON_DDL = "type string, coordinates array<array<array<array<double>>>>"


def reference_lookup(lookup: DataFrame) -> DataFrame:
    """Grid reference with one row per id (smallest geometry text on a duplicate, so the
    enrichment join can never multiply fact rows)."""
    return (lookup.where(F.col("grid_id").isNotNull())
            .groupBy("grid_id").agg(F.min("geometry").alias("geometry")))


def geometry_reference(grid_id: Column) -> Column:
    """Stable text key of a cell's geometry."""
    return F.concat(F.lit(S.GEOMETRY_REFERENCE_PREFIX), grid_id.cast("string"))


def area_centroid(geometry: Column) -> Column:
    """Area-weighted (shoelace) centroid of a Polygon's outer ring -> struct(lon, lat).

    A zero-area ring falls back to the mean of its points; non-Polygon geometries give NULL.
    """
    g = F.from_json(geometry, POLYGON_DDL)
    ring = F.get(g["coordinates"], 0)

    def step(acc, i):
        x1, y1 = F.get(F.get(ring, i), 0), F.get(F.get(ring, i), 1)
        x2, y2 = F.get(F.get(ring, i + 1), 0), F.get(F.get(ring, i + 1), 1)
        cross = x1 * y2 - x2 * y1
        return F.struct((acc["a"] + cross).alias("a"),
                        (acc["cx"] + (x1 + x2) * cross).alias("cx"),
                        (acc["cy"] + (y1 + y2) * cross).alias("cy"))

    zero = F.lit(0.0).cast("double")
    init = F.struct(zero.alias("a"), zero.alias("cx"), zero.alias("cy"))
    acc = F.aggregate(F.sequence(F.lit(0), F.size(ring) - 2), init, step)
    mean_x = F.aggregate(ring, zero, lambda s, p: s + F.get(p, 0)) / F.size(ring)
    mean_y = F.aggregate(ring, zero, lambda s, p: s + F.get(p, 1)) / F.size(ring)
    lon = F.when(acc["a"] == 0, mean_x).otherwise(acc["cx"] / (F.lit(3.0) * acc["a"]))
    lat = F.when(acc["a"] == 0, mean_y).otherwise(acc["cy"] / (F.lit(3.0) * acc["a"]))
    ok = (g["type"] == "Polygon") & (F.size(ring) >= 3)
    return F.when(ok, F.struct(lon.alias("lon"), lat.alias("lat")))


def vertex_centroid(geometry: Column) -> Column:
    """P25: mean of every point of every ring (closing points included), Polygon or
    MultiPolygon -> struct(lon, lat)."""
    gtype = F.get_json_object(geometry, "$.type")
    poly_pts = F.flatten(F.from_json(geometry, POLYGON_DDL)["coordinates"])
    multi_pts = F.flatten(F.flatten(F.from_json(geometry, MULTIPOLYGON_DDL)["coordinates"]))
    pts = F.when(gtype == "Polygon", poly_pts).when(gtype == "MultiPolygon", multi_pts)
    pts = F.filter(pts, lambda p: F.size(p) >= 2)
    zero = F.lit(0.0).cast("double")
    n = F.size(pts)
    lon = F.aggregate(pts, zero, lambda s, p: s + F.get(p, 0)) / n
    lat = F.aggregate(pts, zero, lambda s, p: s + F.get(p, 1)) / n
    return F.when(n > 0, F.struct(lon.alias("lon"), lat.alias("lat")))


def with_centroids(lookup: DataFrame, *more: str) -> DataFrame:
    """Lookup + both centroid forms as plain columns."""
    a, v = area_centroid(F.col("geometry")), vertex_centroid(F.col("geometry"))
    return lookup.select("grid_id", *more, "geometry",
                         a["lon"].alias("centroid_longitude"), a["lat"].alias("centroid_latitude"),
                         v["lon"].alias("vertex_longitude"), v["lat"].alias("vertex_latitude"))


def geo_enrich(fact: DataFrame, lookup: DataFrame, broadcast: bool = True) -> DataFrame:
    """Fact LEFT JOIN grid reference on grid_id (row count preserved).

    ``broadcast=False`` is the J2 baseline: the same join planned as a shuffle join.
    """
    ref = with_centroids(reference_lookup(lookup)).select("grid_id", "centroid_longitude", "centroid_latitude")
    # No size is assumed for the reference: AQE broadcasts it when it measures small.
    ref = ref if broadcast else ref.hint("shuffle_merge")
    return (fact.join(ref, "grid_id", "left")
            .withColumn("geometry_reference",
                        F.when(F.col("centroid_longitude").isNotNull(), geometry_reference(F.col("grid_id")))))


def unmatched_grids(fact: DataFrame, lookup: DataFrame) -> DataFrame:
    """Grids of the fact with no reference geometry."""
    return fact.select("grid_id").distinct().join(lookup.select("grid_id"), "grid_id", "left_anti")


def enrichment_coverage(fact: DataFrame, enriched: DataFrame) -> DataFrame:
    """Rows equal, grids equal, share of grids and rows that found a geometry."""
    fact_rows = fact.agg(F.count(F.lit(1))).scalar()
    fact_grids = fact.agg(F.count_distinct("grid_id")).scalar()
    matched = F.col("centroid_longitude").isNotNull()
    return (enriched.agg(F.count(F.lit(1)).alias("enriched_rows"),
                         F.count_distinct("grid_id").alias("enriched_grids"),
                         F.sum(F.when(matched, 1).otherwise(0)).alias("matched_rows"),
                         F.count_distinct(F.when(matched, F.col("grid_id"))).alias("matched_grids"))
            .withColumns({"fact_rows": fact_rows, "fact_grids": fact_grids})
            .withColumn("coverage_pct", F.round(F.col("matched_grids") * 100.0 / F.col("fact_grids"), 2))
            .withColumn("passed", (F.col("enriched_rows") == F.col("fact_rows"))
                        & (F.col("enriched_grids") == F.col("fact_grids"))
                        & (F.col("matched_grids") == F.col("fact_grids"))))


def neighbour_distances(lookup: DataFrame) -> DataFrame:
    """Euclidean distance between each cell's centroid and the next cell id's centroid
    (self equi-join on id + 1); every distance must be > 0."""
    c = with_centroids(lookup).select("grid_id", "centroid_longitude", "centroid_latitude")
    nxt = c.select((F.col("grid_id") - 1).alias("grid_id"), F.col("grid_id").alias("neighbour_id"),
                   F.col("centroid_longitude").alias("n_lon"), F.col("centroid_latitude").alias("n_lat"))
    d = F.sqrt(F.pow(F.col("centroid_longitude") - F.col("n_lon"), 2)
               + F.pow(F.col("centroid_latitude") - F.col("n_lat"), 2))
    return (c.join(nxt, "grid_id")
            .select("grid_id", "neighbour_id", round6(d).alias("distance"))
            .withColumn("passed", F.col("distance") > 0))


def top_grids_with_geometry(fact: DataFrame, lookup: DataFrame, n: int = 10) -> DataFrame:
    """K2: aggregate by grid first, keep the top n, attach centroids to those n rows only."""
    from cellwatch.operators.facts import top_grids
    top = top_grids(fact, n).select("grid_id", "total_activity")
    # Raw geometry is joined to the n rows first, one per id; centroids are computed for these only.
    own = reference_lookup(lookup.join(F.broadcast(top.select("grid_id")), "grid_id", "left_semi"))
    joined = with_centroids(top.join(own, "grid_id", "left"), "total_activity")
    return (joined.select("grid_id", "total_activity", "centroid_longitude", "centroid_latitude")
            .orderBy(F.desc("total_activity"), F.asc("grid_id")))
