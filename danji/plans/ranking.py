"""The volume pivot and the complex ranking, each one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window as W

from danji.functions import filters
from danji.operators import ranking as R


def complex_pivot(
    trades: DataFrame, coords: DataFrame, complexes: DataFrame, as_of_year: int, *,
    households: tuple[int, int] | None = None, dedupe_coords: bool = False, **region,
) -> DataFrame:
    """Counts per complex, area band and year with coordinates, households and turnover.

    By default a complex on k geocoded roads gives k rows per count, as the joins say;
    `dedupe_coords` keeps only the coordinates of its longest road key.
    `region` takes the arguments of filters.trade_filter_region.
    """
    placed = R.placed_volumes(trades, coords, as_of_year, dedupe=dedupe_coords, **region)
    placed = placed.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    sized = R.join_households_exact(placed, R.households_lookup(complexes))
    if households:
        sized = sized.filter(filters.household_range(F.col("households"), *households))
    return sized.select(
        "sido", "sigungu", "emd", "complex", "built_year", "age_band", "area_band",
        "contract_year", "n", "households", "turnover", "lon", "lat",
    )


def complex_ranking(pivot: DataFrame, metric: str = "n", limit: int = 20) -> DataFrame:
    """Ranked table of the top complexes; the size columns show only if any size is known."""
    top = R.top_complexes(R.complex_rollup(pivot), metric, limit)
    order = W.orderBy(F.desc(metric), "sido", "sigungu", "emd", "complex")
    # Only the limited rows reach this window.
    ranked = top.withColumn("rank", F.row_number().over(order))
    return ranked.select(
        "rank", "complex", "sigungu", "emd", "built_year", "age_band", "n", "households", "turnover"
    )


def display_columns(ranked: DataFrame) -> DataFrame:
    """Drop the size columns when no ranked complex has a size (at most `limit` rows are read)."""
    if ranked.filter(F.col("households").isNotNull()).isEmpty():
        return ranked.drop("households", "turnover")
    return ranked
