"""Index maps and time series, from precomputed tables when the catalog has them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from danji.constants import INDICATORS, LEVEL_DISTRICT, LEVEL_PROVINCE
from danji.functions import filters, region as R
from danji.functions.rounding import round_half_up
from danji.operators import index as X


def yoy_map(
    index: DataFrame, year: int, month: int, precomputed: DataFrame | None = None
) -> DataFrame:
    """Change per district in a month."""
    if precomputed is None:
        return X.yoy_point_join(index, year, month)
    day = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    rows = precomputed.filter((F.col("date") == day) & (F.col("level") == LEVEL_DISTRICT))
    return rows.select(
        R.district_code(F.col("region_code")).alias("sig_cd"), "region_name",
        round_half_up(F.col("yoy_pct"), 1).alias("yoy_pct"),
    )


def indicator_map(
    sale_index: DataFrame, lease_index: DataFrame, lease_ratio: DataFrame, sales: DataFrame,
    year: int, month: int, sale_yoy: DataFrame | None = None, lease_yoy: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The four indicators of a month by indicator name."""
    names = list(INDICATORS)
    return {
        names[0]: yoy_map(sale_index, year, month, sale_yoy),
        names[1]: yoy_map(lease_index, year, month, lease_yoy),
        names[2]: X.lease_ratio_map(lease_ratio, year, month),
        names[3]: X.district_trade_volume(sales, year * 100 + month),
    }


def indicator_long(maps: dict[str, DataFrame]) -> DataFrame:
    """The four indicators as (indicator, key, value); volume is keyed by region name."""
    value_columns = {"yoy": "yoy_pct", "direct": "ratio", "count": "volume"}
    out = None
    for name, info in INDICATORS.items():
        key = "sig_kor_nm" if info["type"] == "count" else "sig_cd"
        part = maps[name].select(
            F.lit(name).alias("indicator"), F.col(key).alias("key"),
            F.col(value_columns[info["type"]]).cast("double").alias("value"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def _timeseries(kind, level, table, precomputed, wanted, first, last) -> DataFrame | None:
    years = filters.year_between(F.col("date"), first, last)
    if kind == "direct":
        rows = table.filter(filters.ratio_rows() & filters.region_level(level, wanted) & years)
        return X.series(rows, level, "ratio")
    if kind != "yoy":
        return None
    if precomputed is None:
        near = table.filter(filters.year_between(F.col("date"), first - 1, last))
        return X.series(X.yoy_self_join(near, level, wanted).filter(years), level, "yoy_pct")
    rows = precomputed.filter((F.col("level") == level) & years)
    if wanted is not None:
        key = "region_name" if level == LEVEL_PROVINCE else R.district_code(F.col("region_code"))
        rows = rows.filter((F.col(key) if isinstance(key, str) else key).isin(list(wanted)))
    rounded = rows.withColumn("yoy_pct", round_half_up(F.col("yoy_pct"), 1))
    return X.series(rounded, level, "yoy_pct")


def timeseries_district(
    kind: str, table: DataFrame, codes: Iterable[str] | None, first: int, last: int,
    precomputed: DataFrame | None = None,
) -> DataFrame | None:
    """Series of chosen district codes; None for an indicator that has no series."""
    return _timeseries(kind, LEVEL_DISTRICT, table, precomputed, codes, first, last)


def timeseries_province(
    kind: str, table: DataFrame, names: Iterable[str] | None, first: int, last: int,
    precomputed: DataFrame | None = None,
) -> DataFrame | None:
    """Series of chosen provinces by short name."""
    return _timeseries(kind, LEVEL_PROVINCE, table, precomputed, names, first, last)
