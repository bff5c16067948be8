"""Upkeep of the coordinate table: what to geocode, legacy keys, match rate."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from danji.functions import address as A
from danji.functions.rounding import round_half_up
from danji.operators.skew import counted


def road_keys(*trade_tables: DataFrame) -> DataFrame:
    """Distinct (road_key, road) over trade tables; rows without a road have none."""
    seen = None
    for trades in trade_tables:
        part = counted(trades.filter("road IS NOT NULL AND road != ''"), "address", "road")
        seen = part if seen is None else seen.unionByName(part)
    keyed = A.with_road_key(seen).select("road_key", "road")
    return keyed.filter("road_key IS NOT NULL").distinct()


def addresses_to_geocode(coords: DataFrame, *trade_tables: DataFrame) -> DataFrame:
    """Road keys of trades that have no coordinates yet."""
    keys = road_keys(*trade_tables).select("road_key").distinct()
    return keys.join(coords.select("road_key"), "road_key", "left_anti")


def legacy_backfill(coords: DataFrame, *trade_tables: DataFrame) -> DataFrame:
    """Rows to add: a coordinate stored under a bare road, if only one full key has that road."""
    keys = road_keys(*trade_tables)
    unambiguous = (
        keys.groupBy("road").agg(F.min("road_key").alias("full"), F.max("road_key").alias("other"))
        .filter(F.col("full") == F.col("other")).select("road", "full")
    )
    legacy = coords.withColumnRenamed("road_key", "road")
    found = legacy.join(unambiguous, "road").select(F.col("full").alias("road_key"), "lon", "lat")
    return found.join(coords.select("road_key"), "road_key", "left_anti")


def backfill_legacy_coords(coords: DataFrame, *trade_tables: DataFrame) -> DataFrame:
    """The coordinate table with the backfilled rows."""
    return coords.unionByName(legacy_backfill(coords, *trade_tables))


def coord_match_rate(coords: DataFrame, trades: DataFrame) -> DataFrame:
    """Distinct road keys of trades, how many have coordinates, and the percentage."""
    keys = road_keys(trades).select("road_key").distinct()
    listed = coords.select("road_key", F.lit(1).alias("hit"))
    return (
        keys.join(listed, "road_key", "left")
        .agg(F.count("*").alias("total_keys"), F.count("hit").alias("matched"))
        .withColumn(
            "match_rate",
            round_half_up(F.try_divide(F.col("matched") * F.lit(100.0), "total_keys"), 2),
        )
    )


def match_coverage(pivot: DataFrame) -> DataFrame:
    """Rows in all, with households, with coordinates."""
    return pivot.agg(
        F.count("*").alias("total"), F.count("households").alias("with_households"),
        F.count("lon").alias("with_coords"),
    )
