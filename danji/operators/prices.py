"""Price and volume over sales and deposit leases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from danji.functions import address as A, filters, trade as T
from danji.functions.rounding import round_half_up
from danji.operators.skew import counted, exact_median


def monthly_median_volume(trades: DataFrame, amount: str) -> DataFrame:
    """Median price (100 million, one decimal) and trade count per month."""
    return exact_median(trades, ["ym"], amount, "_median", rows="volume").select(
        "ym", round_half_up(F.col("_median") / 10000.0, 1).alias("median_eok"), "volume"
    )


def monthly_median_approx(trades: DataFrame, amount: str, accuracy: int = 10000) -> DataFrame:
    """As monthly_median_volume with an approximate median, for a first look at huge ranges."""
    return trades.groupBy("ym").agg(
        round_half_up(F.percentile_approx(amount, 0.5, accuracy) / 10000.0, 1).alias("median_eok"),
        F.count("*").alias("volume"),
    )


def sales_summary(sales: DataFrame) -> DataFrame:
    """One row: count, highest and lowest price; zeros when there is no sale."""
    return sales.agg(
        F.count("*").alias("n"),
        F.coalesce(T.price_in_eok(F.max("price")), F.lit(0.0)).alias("max_eok"),
        F.coalesce(T.price_in_eok(F.min("price")), F.lit(0.0)).alias("min_eok"),
    )


def recent_sales(sales: DataFrame, n: int = 3) -> DataFrame:
    """Newest sales, dearest first within a month; remaining ties by name, area and floor."""
    return (
        sales.orderBy(F.desc("ym"), F.desc("price"), "complex", "area_m2", "floor_no")
        .limit(n)
        .select(
            "ym", "complex", "area_m2", T.price_in_eok(F.col("price")).alias("price_eok"),
            "floor_no",
        )
    )


def individual_trades(trades: DataFrame, amount: str) -> DataFrame:
    area = F.col("area_m2")
    return trades.select(
        "ym", "complex", "area_m2", T.price_in_eok(F.col(amount)).alias("price_eok"), "floor_no",
        T.pyeong_floor(area).alias("pyeong"), T.pyeong_band(area).alias("pyeong_band"),
    )


def sale_and_lease(
    sales: DataFrame, rents: DataFrame, chosen: Column, include_direct: bool = False
) -> dict[str, tuple[DataFrame, str]]:
    """The filtered trades of both kinds, each with its amount column."""
    return {
        "sale": (sales.filter(chosen & filters.market_sales(include_direct)), "price"),
        "lease": (rents.filter(chosen & filters.lease_only()), "deposit"),
    }


def union_ym(sales: DataFrame, rents: DataFrame) -> DataFrame:
    return (
        sales.select("ym")
        .unionByName(rents.filter(filters.lease_only()).select("ym"))
        .filter(F.col("ym").isNotNull())
    )


def ym_range(sales: DataFrame, rents: DataFrame) -> DataFrame:
    return union_ym(sales, rents).agg(F.min("ym").alias("min_ym"), F.max("ym").alias("max_ym"))


def year_range(trades: DataFrame) -> DataFrame:
    """First and last contract year; year is monotone in ym, so only ym is aggregated."""
    return trades.agg(
        T.contract_year(F.min("ym")).alias("min_year"),
        T.contract_year(F.max("ym")).alias("max_year"),
    )


def union_sales_leases(sales: DataFrame, rents: DataFrame) -> DataFrame:
    """Distinct (address, complex) over sales and deposit leases."""
    both = sales.select("address", "complex").unionByName(
        rents.filter(filters.lease_only()).select("address", "complex")
    )
    named = both.filter("address IS NOT NULL AND complex IS NOT NULL")
    return counted(named, "address", "complex").drop("n")


def region_hierarchy_complex(sales: DataFrame, rents: DataFrame) -> DataFrame:
    """Distinct province > district > sub-district > complex."""
    parsed = A.with_region_columns(union_sales_leases(sales, rents))
    return (
        parsed.select("sido", "sigungu", "emd", "complex")
        .filter(filters.nonempty_region())
        .distinct()
    )


def yearly_median(monthly: DataFrame) -> DataFrame:
    """Median over the monthly medians of each year."""
    by_year = monthly.withColumn("year", T.contract_year(F.col("ym")))
    return exact_median(by_year, ["year"], "median_eok", "median_eok_year").select(
        "year", "median_eok_year"
    )


def yearly_change(yearly: DataFrame) -> DataFrame:
    """Percent change from the previous year row; there is one row per year."""
    value = F.col("median_eok_year")
    before = F.lag(value).over(W.orderBy("year"))
    return yearly.withColumn("change_pct", (F.try_divide(value, before) - 1) * 100.0)


def monthly_trade_count(trades: DataFrame) -> DataFrame:
    return trades.groupBy(T.ym_label(F.col("ym")).alias("month")).agg(F.count("*").alias("volume"))
