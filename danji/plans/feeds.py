"""Data behind the dashboards: overview, map and chart feeds (drawing is left to the caller)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from danji.functions import filters, trade as T
from danji.operators import index as X, prices as P, regions as G


def sales_overview(
    sales: DataFrame, chosen: Column, include_direct: bool = False
) -> dict[str, DataFrame]:
    """Summary row and the three newest sales of the chosen trades."""
    kept = sales.filter(chosen & filters.market_sales(include_direct))
    return {"summary": P.sales_summary(kept), "recent": P.recent_sales(kept)}


def choropleth_feed(
    regions: DataFrame, values: DataFrame, provinces: list[str] | None = None,
    unit: str = "%", decimals: int = 1,
) -> dict[str, DataFrame]:
    """Regions with value, label and centroid, and the colour range of all values.

    `values` is (key, value); a region without a value keeps NULL and has no label.
    """
    if provinces is not None:
        regions = regions.filter(filters.province_prefix(F.col("full_nm"), provinces))
    valued = G.region_centroids(G.regions_with_indicator(regions, values))
    number = F.format_string(f"%.{decimals}f", F.col("value").cast("double"))
    label = F.when(
        F.col("value").isNotNull(), F.concat("sig_kor_nm", F.lit("\n"), number, F.lit(unit))
    )
    layer = valued.withColumn("label", label).select(
        "sig_cd", "sig_kor_nm", "full_nm", "value", "label", "centroid_lon", "centroid_lat"
    )
    return {"layer": layer, "bounds": X.color_scale_bounds(values, "value")}


def scatter_feed(individual: dict[str, DataFrame]) -> DataFrame:
    """Points (x = day 15 of the month, y = price) per kind and pyeong band."""
    out = None
    for kind, rows in individual.items():
        part = rows.select(
            F.lit(kind).alias("kind"), F.col("pyeong_band").alias("band"),
            T.ym_to_date(F.col("ym")).alias("x"), F.col("price_eok").alias("y"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def bar_feed(trades: dict[str, DataFrame]) -> DataFrame:
    """Trade counts per kind and month."""
    out = None
    for kind, rows in trades.items():
        part = P.monthly_trade_count(rows).withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


def line_feed(monthly: dict[str, DataFrame]) -> DataFrame:
    """Median price and volume per kind and month label."""
    out = None
    for kind, rows in monthly.items():
        part = rows.select(
            F.lit(kind).alias("kind"), T.ym_label(F.col("ym")).alias("x"),
            F.col("median_eok").alias("y"), "volume",
        )
        out = part if out is None else out.unionByName(part)
    return out
