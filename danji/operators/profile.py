"""Profiles of the tables: counts, shares, ranges, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window as W

from danji.functions import address as A, filters, trade as T
from danji.functions.rounding import round_half_up
from danji.operators.skew import exact_quantiles


def category_counts(df: DataFrame, column, name: str = "category") -> DataFrame:
    return df.groupBy(column.alias(name)).agg(F.count("*").alias("n"))


def word_counts(trades: DataFrame) -> DataFrame:
    """Trades per number of address words; addresses are counted before they are split."""
    per_address = (
        trades.filter(F.col("address").isNotNull()).groupBy("address").agg(F.count("*").alias("n"))
    )
    words = F.size(F.split(A.squeeze_spaces(F.col("address")), " "))
    return per_address.groupBy(words.alias("word_count")).agg(F.sum("n").alias("n"))


def households_by_kind(complexes: DataFrame) -> DataFrame:
    return complexes.groupBy("kind_code").agg(
        F.count("*").alias("n"), F.sum("households").alias("households")
    )


def households_by_province(complexes: DataFrame) -> DataFrame:
    sido = F.split_part("lot_address", F.lit(" "), F.lit(1)).alias("sido")
    return complexes.filter(F.col("kind_code") == "1").groupBy(sido).agg(
        F.count("*").alias("n"), F.sum("households").alias("households")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        part = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def index_profile(index: DataFrame) -> DataFrame:
    """Count and first and last date of the monthly apartment rows."""
    rows = index.filter((F.col("asset_kind") == "아파트") & (F.col("freq") == "월간"))
    return rows.agg(
        F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date")
    )


def describe_metric(rows: DataFrame, value: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of a metric; one row."""
    simple = rows.agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
    )
    quartiles = exact_quantiles(
        rows.filter(F.col(value).isNotNull()), [], value, {"q1": 0.25, "median": 0.5, "q3": 0.75}
    ).drop("n", "_rows")
    # Both have one row, so they are joined by a constant.
    return simple.withColumn("_one", F.lit(1)).join(quartiles.withColumn("_one", F.lit(1)), "_one", "left").select(
        "n", "mean", "std", "min", "q1", "median", "q3", "max"
    )


def distinct_code_counts(index: DataFrame) -> DataFrame:
    """Distinct region codes per code length."""
    rows = index.filter((F.col("asset_kind") == "아파트") & (F.col("freq") == "월간"))
    return rows.groupBy(F.length("region_code").alias("code_length")).agg(
        F.count_distinct("region_code").alias("n_codes")
    )


def distinct_months(index: DataFrame) -> DataFrame:
    return index.groupBy("asset_kind").agg(F.count_distinct("date").alias("n_months"))


def band_share(trades: DataFrame) -> DataFrame:
    """Share of each pyeong band, smallest areas first; the window sees one row per band."""
    bands = trades.groupBy(T.pyeong_band(F.col("area_m2")).alias("pyeong_band")).agg(
        F.count("*").alias("n"), F.min("area_m2").alias("min_area")
    )
    total = F.sum("n").over(W.partitionBy())
    return bands.withColumn("share", round_half_up(F.col("n") * F.lit(100.0) / total, 1))


def filter_effect(sales: DataFrame) -> DataFrame:
    """Sales before and after the market filter, and the percentage left out, in one pass."""
    kept = filters.market_sales()
    return (
        sales.agg(F.count("*").alias("total"), F.count_if(kept).alias("kept"))
        .withColumn("excluded", F.col("total") - F.col("kept"))
        .withColumn(
            "excluded_pct",
            round_half_up(F.try_divide(F.col("excluded") * F.lit(100.0), "total"), 1),
        )
    )


def area_profile(trades: DataFrame, limit: int | None = 15) -> DataFrame:
    """Trades per area with its pyeong and band, smallest areas first."""
    area = F.col("area_m2")
    counted = trades.groupBy("area_m2").agg(F.count("*").alias("n")).select(
        "area_m2", T.pyeong_floor(area).alias("pyeong"), T.pyeong_band(area).alias("pyeong_band"), "n"
    )
    return counted if limit is None else counted.orderBy("area_m2").limit(limit)


def code_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """Sizes of two code sets and of their intersection, from one full join of the sets."""
    a = left.select("sig_cd").distinct().withColumn("in_left", F.lit(1))
    b = right.select("sig_cd").distinct().withColumn("in_right", F.lit(1))
    both = a.join(b, "sig_cd", "full")
    return both.agg(
        F.count("in_left").alias("n_left"), F.count("in_right").alias("n_right"),
        F.count(F.col("in_left") + F.col("in_right")).alias("n_both"),
    )


def sample_rows(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """Any n rows, or with a seed n rows in random order."""
    return df.limit(n) if seed is None else df.orderBy(F.rand(seed)).limit(n)


def top_by(df: DataFrame, metric: str, limit: int, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(metric), *ties).limit(limit)


def ordered_output(df: DataFrame, *order: str) -> DataFrame:
    """Final ordering of a result: '-name' sorts down; NULLs come last either way."""
    columns = [
        F.col(name[1:]).desc_nulls_last() if name.startswith("-") else F.col(name).asc_nulls_last()
        for name in order
    ]
    return df.orderBy(*columns)
