"""District boundaries from GeoJSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_PROPERTIES = "struct<sig_cd:string,sig_kor_nm:string,full_nm:string>"
# Coordinates nest 3 deep in a Polygon and 4 deep in a MultiPolygon, so they stay text here.
_FEATURE = f"struct<properties:{_PROPERTIES},geometry:struct<type:string,coordinates:string>>"


def _rows(features: DataFrame) -> DataFrame:
    return features.select(
        "feature.properties.*",
        F.col("feature.geometry.type").alias("geometry_type"),
        F.col("feature.geometry.coordinates").alias("coordinates"),
    )


def parse_features(lines: DataFrame, column: str = "value") -> DataFrame:
    """Regions from a text column that holds one GeoJSON feature per row."""
    return _rows(lines.select(F.from_json(column, _FEATURE).alias("feature")))


def load_regions_geo(spark: SparkSession, path: str) -> DataFrame:
    """Regions from a FeatureCollection document."""
    document = spark.read.schema(f"features array<{_FEATURE}>").json(path, multiLine=True)
    return _rows(document.select(F.explode("features").alias("feature")))
