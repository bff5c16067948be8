"""Region dimension: boundaries, codes, labels, centroids, values on the map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from danji.functions import region as R

_DEPTH3 = "array<array<array<double>>>"
_DEPTH4 = "array<array<array<array<double>>>>"


def polygon_points(geometry_type: Column, coordinates: Column) -> Column:
    """All vertices of a Polygon or MultiPolygon given as JSON text."""
    polygon = F.flatten(F.from_json(coordinates, _DEPTH3))
    multi = F.flatten(F.flatten(F.from_json(coordinates, _DEPTH4)))
    return F.when(geometry_type == "MultiPolygon", multi).otherwise(polygon)


def region_centroids(regions: DataFrame) -> DataFrame:
    """Mean of all vertices, computed inside the row, so a large outline never shuffles."""
    points = polygon_points(F.col("geometry_type"), F.col("coordinates"))

    def mean(axis: int) -> Column:
        total = F.aggregate(
            F.col("_points"), F.lit(0.0), lambda acc, p: acc + F.element_at(p, axis)
        )
        return F.try_divide(total, F.size("_points"))

    return (
        regions.withColumn("_points", points)
        .withColumns({"centroid_lon": mean(1), "centroid_lat": mean(2)})
        .drop("_points")
    )


def map_extent(points: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Mean centre and bounding box."""
    return points.agg(
        F.avg(lon).alias("center_lon"), F.avg(lat).alias("center_lat"),
        F.min(lon).alias("min_lon"), F.max(lon).alias("max_lon"),
        F.min(lat).alias("min_lat"), F.max(lat).alias("max_lat"),
    )


def regions_with_indicator(regions: DataFrame, values: DataFrame) -> DataFrame:
    """Regions with the value keyed by their code, else by their name; none keeps NULL.

    `values` is (key, value). A key listed twice takes its highest value; a code listed with NULL
    stays NULL, whatever its name has. Values are read once: a region asks for both of its keys.
    """
    one = values.groupBy("key").agg(F.max("value").alias("value"))
    asked = regions.select("sig_cd", "sig_kor_nm").distinct().select(
        "sig_cd", "sig_kor_nm", F.posexplode(F.array("sig_cd", "sig_kor_nm")).alias("_order", "key")
    )
    found = asked.join(one, "key").groupBy("sig_cd", "sig_kor_nm").agg(
        F.min(F.struct("_order", "value")).getField("value").alias("value")
    )
    return regions.join(found, ["sig_cd", "sig_kor_nm"], "left")


def label_frequency(places: DataFrame) -> DataFrame:
    """Number of provinces each district name occurs in, beside the name."""
    return places.withColumn("frequency", F.count("*").over(W.partitionBy("name")))


def disambiguate_region_label(places: DataFrame) -> DataFrame:
    """Label of each (province, name): the name, with its province when the name repeats.

    `places` holds one row per district of the country, so a name has a handful of rows.
    """
    label = F.when(
        F.col("frequency") > 1, F.concat("name", F.lit(" ("), "province", F.lit(")"))
    ).otherwise(F.col("name"))
    return label_frequency(places).withColumn("label", label)


def region_code_lookup(regions: DataFrame, labels: DataFrame) -> DataFrame:
    """Codes of labels: by name, and by province when the label or the caller gives one.

    `labels` is (label, province): province may be NULL. A name that fits several regions takes
    the highest code.
    """
    wanted = labels.select(
        R.label_name(F.col("label")).alias("sig_kor_nm"),
        F.coalesce(R.label_province(F.col("label")), F.col("province")).alias("province"),
    ).distinct()
    fits = F.col("province").isNull() | F.col("full_nm").startswith(F.col("province"))
    return (
        wanted.join(regions.select("sig_cd", "sig_kor_nm", "full_nm"), "sig_kor_nm").filter(fits)
        .groupBy("sig_kor_nm", "province").agg(F.max("sig_cd").alias("sig_cd"))
        .select("sig_cd").distinct()
    )


def resolve_region_selection(
    labels: DataFrame, provinces: DataFrame, places: DataFrame, exact: bool = False
) -> DataFrame:
    """Districts meant by a selection of labels.

    A label with a province adds that province; a plain one adds every selected province. By
    default the two sets are then combined freely, as two independent filters; `exact` keeps
    each label with its own provinces.
    """
    parsed = labels.select(
        R.label_name(F.col("label")).alias("name"), R.label_province(F.col("label")).alias("given")
    )
    chosen = provinces.select("province")
    own = parsed.filter("given IS NOT NULL").select("name", F.col("given").alias("province"))
    plain = parsed.filter("given IS NULL").select("name")
    if exact:
        spread = places.join(chosen, "province", "left_semi").join(plain, "name", "left_semi")
        return spread.unionByName(places.join(own, ["name", "province"], "left_semi")).distinct()
    # All chosen provinces if there is a plain label, else none: a join with one row or no row.
    some = plain.agg(F.count("*").alias("n")).filter("n > 0").select(F.lit(1).alias("_some"))
    every = chosen.withColumn("_some", F.lit(1)).join(some, "_some", "left_semi").drop("_some")
    wide = own.select("province").unionByName(every).distinct()
    return places.join(wide, "province", "left_semi").join(
        parsed.select("name"), "name", "left_semi"
    )


def province_list(regions: DataFrame) -> DataFrame:
    return regions.select(
        F.split_part("full_nm", F.lit(" "), F.lit(1)).alias("province")
    ).distinct()


def district_list(regions: DataFrame, province: str) -> DataFrame:
    return regions.filter(F.col("full_nm").startswith(province)).select("sig_kor_nm")
