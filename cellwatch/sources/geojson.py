"""GeoJSON grid reference (S8): FeatureCollection or newline-delimited features.

The geometry is kept as compact JSON text (a ``string`` field in the parse schema), so
Polygon and MultiPolygon parse alike. Big references should be newline-delimited: one
feature per line is splittable, a whole-file document is read by one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURE_DDL = "type string, properties struct<cellId:int>, geometry string"
COLLECTION_DDL = ("type string, features array<struct<type:string, "
                  "properties:struct<cellId:int>, geometry:string>>")


def parse_features(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """One JSON feature per row -> (grid_id, geometry, geometry_type, feature_type)."""
    f = F.from_json(F.col(text_col), FEATURE_DDL)
    return (lines.select(f.alias("f"))
            .select(F.col("f.properties.cellId").alias("grid_id"),
                    F.col("f.geometry").alias("geometry"),
                    F.get_json_object(F.col("f.geometry"), "$.type").alias("geometry_type"),
                    F.col("f.type").alias("feature_type")))


def parse_collection(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Whole FeatureCollection documents -> one row per feature."""
    doc = F.from_json(F.col(text_col), COLLECTION_DDL)
    return (docs.select(doc.alias("d"))
            .select(F.col("d.type").alias("collection_type"), F.explode_outer("d.features").alias("f"))
            .select(F.col("f.properties.cellId").alias("grid_id"),
                    F.col("f.geometry").alias("geometry"),
                    F.get_json_object(F.col("f.geometry"), "$.type").alias("geometry_type"),
                    F.col("f.type").alias("feature_type"),
                    "collection_type"))


def read_grid_reference(spark: SparkSession, path: str, newline_delimited: bool = False) -> DataFrame:
    if newline_delimited:
        return parse_features(spark.read.text(path))
    return parse_collection(spark.read.option("wholetext", "true").text(path))


def grid_lookup(features: DataFrame) -> DataFrame:
    """Lookup frame (grid_id int, geometry string) of the features that carry an id and a geometry."""
    return (features.where(F.col("grid_id").isNotNull() & F.col("geometry").isNotNull())
            .select("grid_id", "geometry"))
