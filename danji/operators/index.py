"""Price indices: year-over-year change, ranges, pivots."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from danji.constants import LEVEL_DISTRICT, LEVEL_PROVINCE
from danji.functions import address as A, filters, region as R
from danji.functions.rounding import round_half_up
from danji.operators.ranking import listed_or_error
from danji.operators.skew import exact_median


def index_monthly(index: DataFrame, level: str, wanted: Iterable[str] | None = None) -> DataFrame:
    """Monthly apartment rows of one region level."""
    return index.filter(filters.index_rows() & filters.region_level(level, wanted)).select(
        "date", "region_code", "region_name", F.col("index_value").cast("double").alias("value")
    )


def _change(now: str, before: str):
    return round_half_up((F.col(now) - F.col(before)) / F.col(before) * 100.0, 1)


def yoy_point_join(index: DataFrame, year: int, month: int) -> DataFrame:
    """Change of each district between a month and the same month a year before.

    The index is read once, for the two months alone; a district's rows meet in one aggregate.
    """
    day, past = (F.make_date(F.lit(y), F.lit(month), F.lit(1)) for y in (year, year - 1))
    rows = index_monthly(index.filter((F.col("date") == day) | (F.col("date") == past)), LEVEL_DISTRICT)
    both = rows.groupBy("region_code").agg(
        F.max(F.when(F.col("date") == day, F.struct("value", "region_name"))).alias("now"),
        F.max(F.when((F.col("date") == past) & (F.col("value") > 0), F.col("value"))).alias("before"),
    )
    return both.filter("now IS NOT NULL AND before IS NOT NULL").select(
        R.district_code(F.col("region_code")).alias("sig_cd"), F.col("now.region_name").alias("region_name"),
        _change("now.value", "before").alias("yoy_pct"),
    )


def _yoy(rows: DataFrame) -> DataFrame:
    """Each month beside the same month a year before, found in a frame of that one month.

    One shuffle by region; a region has one value a month (of repeated ones the frame takes the
    greatest). Months without a positive value a year before are left out.
    """
    before = F.expr("""max(IF(value > 0, value, NULL)) OVER (PARTITION BY region_code ORDER BY date
        RANGE BETWEEN INTERVAL 12 MONTH PRECEDING AND INTERVAL 12 MONTH PRECEDING)""")
    return rows.withColumn("before", before).filter("before IS NOT NULL").select(
        "date", "region_code", "region_name", _change("value", "before").alias("yoy_pct")
    )


def yoy_self_join(index: DataFrame, level: str, wanted: Iterable[str] | None = None) -> DataFrame:
    """Change of every month against the same month a year before, by region."""
    return _yoy(index_monthly(index, level, wanted))


def series(rows: DataFrame, level: str, value: str) -> DataFrame:
    """(date, sig_cd, region_name, value); province rows have an empty code."""
    code = F.lit("") if level == LEVEL_PROVINCE else R.district_code(F.col("region_code"))
    return rows.select(
        "date", code.alias("sig_cd"), "region_name", F.col(value).cast("double").alias("value")
    )


def lease_ratio_map(ratio: DataFrame, year: int, month: int) -> DataFrame:
    """Lease ratio per district in a month."""
    day = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    wanted = (F.col("date") == day) & filters.ratio_rows() & filters.region_level(LEVEL_DISTRICT)
    return ratio.filter(wanted).select(
        R.district_code(F.col("region_code")).alias("sig_cd"), "region_name",
        F.col("ratio").cast("double").alias("ratio"),
    )


def district_trade_volume(sales: DataFrame, ym: int) -> DataFrame:
    """Active non-direct sales per district in a month.

    Parsed from the address, unless the table has the parts as columns of its own.
    """
    kept = sales.filter(
        (F.col("ym") == ym) & filters.exclude_direct_nulldrop() & filters.active_sales_wide()
    )
    if "sido" in sales.columns:
        sido, sigungu = F.col("sido"), F.col("sigungu")
        return kept.groupBy(A.volume_region_name(sido, sigungu).alias("sig_kor_nm")).agg(
            F.count("*").alias("volume")
        )
    per_address = kept.groupBy("address").agg(F.count("*").alias("n"))
    address = F.col("address")
    name = A.volume_region_name(A.parse_sido(address), A.parse_sigungu(address))
    return per_address.groupBy(name.alias("sig_kor_nm")).agg(F.sum("n").alias("volume"))


def date_bounds(rows: DataFrame) -> DataFrame:
    """First and last year and month."""
    return rows.agg(F.min("date").alias("a"), F.max("date").alias("b")).select(
        F.year("a").alias("start_year"), F.month("a").alias("start_month"),
        F.year("b").alias("end_year"), F.month("b").alias("end_month"),
    )


def index_date_range(index: DataFrame) -> DataFrame:
    return date_bounds(
        index.filter(filters.ratio_rows() & filters.region_level(LEVEL_DISTRICT))
    )


def yoy_date_range(index: DataFrame, precomputed: DataFrame | None = None) -> DataFrame:
    """Months that have a year-over-year value."""
    if precomputed is not None:
        return date_bounds(precomputed.filter(F.col("level") == LEVEL_DISTRICT))
    return date_bounds(yoy_self_join(index, LEVEL_DISTRICT))


def month_axis(bounds: DataFrame) -> DataFrame:
    """Every (year, month) between the bounds of date_bounds."""
    first = F.make_date("start_year", "start_month", F.lit(1))
    last = F.make_date("end_year", "end_month", F.lit(1))
    day = F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("day")
    return bounds.select(day).select(F.year("day").alias("year"), F.month("day").alias("month"))


def heatmap_pivot(rows: DataFrame, months: list[str] | None = None) -> DataFrame:
    """One row per region name, one column per month ('YYYY-MM', ascending).

    Names that occur under several codes take the value of the lowest code. A month outside a given
    list is an error; without a list the columns are the months there are, found by a query.
    """
    month = F.date_format("date", "yyyy-MM")
    if months is not None:
        month, months = listed_or_error(month, months), sorted(months)
    first = F.min_by("value", F.struct("sig_cd", "value"))
    dated = rows.filter(F.col("value").isNotNull()).withColumn("_month", month)
    return dated.groupBy("region_name").pivot("_month", months).agg(first)


def color_scale_bounds(rows: DataFrame, value: str) -> DataFrame:
    """Symmetric colour range: around 0 if any value is negative, else around the exact median."""
    ends = rows.agg(
        F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi")
    ).withColumn("_one", F.lit(1))
    middle = exact_median(rows, [], value, "median").select("median", F.lit(1).alias("_one"))
    # Both have one row, so they are joined by a constant.
    stats = ends.join(middle, "_one", "left").withColumn(
        "center", F.when(F.col("lo") < 0, F.lit(0.0)).otherwise(F.col("median"))
    )
    reach = F.greatest(F.abs(F.col("lo") - F.col("center")), F.abs(F.col("hi") - F.col("center")))
    return stats.select(
        "center", (F.col("center") - reach).alias("vmin"), (F.col("center") + reach).alias("vmax")
    )


def precomputed_yoy(index: DataFrame) -> DataFrame:
    """The optional table of year-over-year values, for both levels in one pass."""
    rows = index.filter(filters.index_rows()).select(
        "date", "region_code", "region_name", F.col("index_value").cast("double").alias("value")
    )
    level = F.when(R.is_province_code(F.col("region_code")), LEVEL_PROVINCE).otherwise(LEVEL_DISTRICT)
    return _yoy(rows).withColumn("level", level).select("date", "region_code", "region_name", "level", "yoy_pct")
