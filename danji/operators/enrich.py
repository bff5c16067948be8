"""Attributes added to whole trade tables: coordinates and household counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from danji.functions import address as A
from danji.operators.skew import lookup_join


def join_coords(trades: DataFrame, coords: DataFrame) -> DataFrame:
    """Add lat and lon by road key, the trades' own if they have it; a key listed twice in coords repeats the trade."""
    if "road_part" in trades.columns:  # stored in buckets of both: a large key's coordinates go to each of its parts
        last = trades.filter("road_key IS NOT NULL AND road_part > 0").groupBy("road_key").agg(F.max("road_part").alias("_last"))
        parts = F.explode(F.sequence(F.lit(0), F.coalesce("_last", F.lit(0)))).alias("road_part")
        lookup = lookup_join(coords.select("road_key", "lat", "lon"), last, ["road_key"]).select("road_key", "lat", "lon", parts)
        return lookup_join(trades, lookup, ["road_key", "road_part"]).drop("road_part")
    if "road_key" in trades.columns:  # stored with it: it may be what the trades are bucketed by
        return lookup_join(trades, coords.select("road_key", "lat", "lon"), ["road_key"])
    lookup = coords.select(F.col("road_key").alias("_road_key"), "lat", "lon")
    keyed = A.with_road_key(trades, "_road_key")
    return lookup_join(keyed, lookup, ["_road_key"]).drop("_road_key")


def households_max(complexes: DataFrame) -> DataFrame:
    """Largest household count per complex name and second address word."""
    return complexes.groupBy(
        "complex", F.split_part("lot_address", F.lit(" "), F.lit(2)).alias("area_word")
    ).agg(F.max(F.col("households").cast("int")).alias("households"))


def join_households_simple(trades: DataFrame, complexes: DataFrame) -> DataFrame:
    """Add households by complex name and the second word of the address as written."""
    lookup = households_max(complexes).withColumnRenamed("area_word", "_area_word")
    keyed = trades.withColumn("_area_word", F.split_part("address", F.lit(" "), F.lit(2)))
    joined = lookup_join(keyed, lookup, ["complex", "_area_word"])
    return joined.select(*trades.columns, "households")
