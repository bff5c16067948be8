"""Row conditions. Every builder returns a Column, so Catalyst can push it to the scan."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from danji.constants import (
    DEPOSIT_LEASE, DIRECT_DEAL, INDEX_ASSET, INDEX_FREQ, LEVEL_PROVINCE, NOT_CANCELLED_STRICT,
    NOT_CANCELLED_WIDE, PYEONG_BAND_LAST, PYEONG_BANDS,
)
from danji.functions import address as A, region as R, trade as Tr


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def active_sales_strict() -> Column:
    c = F.col("cancelled_on")
    return c.isNull() | c.isin(NOT_CANCELLED_STRICT)


def active_sales_wide() -> Column:
    c = F.col("cancelled_on")
    return c.isNull() | c.isin(NOT_CANCELLED_WIDE)


def exclude_direct_nulldrop() -> Column:
    """Unknown deal types are dropped too."""
    return F.col("deal_type") != DIRECT_DEAL


def exclude_direct_nullkeep() -> Column:
    return F.col("deal_type").isNull() | (F.col("deal_type") != DIRECT_DEAL)


def market_sales(include_direct: bool = False) -> Column:
    """Sales that count for price and volume."""
    return active_sales_wide() if include_direct else exclude_direct_nullkeep() & active_sales_wide()


def lease_only() -> Column:
    return F.col("rent_kind") == DEPOSIT_LEASE


def _one_or_many(c: Column, wanted) -> Column:
    return c.isin(list(wanted)) if isinstance(wanted, (list, tuple, set)) else c == wanted


def trade_filter_region(
    sido=None, sigungu=None, emd=None, year_from=None, year_to=None,
    area_bands=None, pyeong_bands=None, rent_kind=None,
) -> Column:
    """Optional conditions over derived trade columns; the years become bounds on ym."""
    parts = [
        _one_or_many(F.col(name), wanted)
        for name, wanted in (
            ("sido", sido), ("sigungu", sigungu), ("emd", emd),
            ("area_band", area_bands), ("pyeong_band", pyeong_bands),
        )
        if wanted
    ]
    if year_from:
        parts.append(F.col("ym") >= year_from * 100)
    if year_to:
        parts.append(F.col("ym") < (year_to + 1) * 100)
    if rent_kind:
        parts.append(F.col("rent_kind") == rent_kind)
    return all_of(parts)


def pyeong_band_predicate(area: Column, bands: Iterable[str]) -> Column:
    """Any of the half-open pyeong ranges; no known band means no restriction."""
    pyeong = Tr.pyeong_raw(area)
    low, ranges = None, {}
    for edge, name in PYEONG_BANDS:
        ranges[name] = pyeong < edge if low is None else (pyeong >= low) & (pyeong < edge)
        low = edge
    ranges[PYEONG_BAND_LAST] = pyeong >= low
    chosen = [ranges[b] for b in dict.fromkeys(bands) if b in ranges]
    return reduce(lambda a, b: a | b, chosen) if chosen else F.lit(True)


def folders(sido=None, year_from=None, year_to=None) -> Column:
    """Conditions on the columns by which sources.tables.write_trades divides its folders."""
    parts = [_one_or_many(F.col("sido"), sido)] if sido else []
    if year_from:
        parts.append(F.col("contract_year") >= year_from)
    if year_to:
        parts.append(F.col("contract_year") <= year_to)
    return all_of(parts)


def is_stored(trades: DataFrame) -> bool:
    """Whether the table has the columns that write_trades adds."""
    return {"sido", "sigungu", "emd", "contract_year"} <= set(trades.columns)


def trade_filter_price(
    sido=None, sigungu=None, emd=None, complexes=None, pyeong_bands=None,
    ym_from=None, ym_to=None, stored: bool = False,
) -> Column:
    """Conditions over raw trade columns (the address is parsed here).

    With `stored` the trades are those of sources.tables.scan_trades: their region columns are used
    and whole folders are skipped by province and year.
    """
    address = F.col("address")
    if stored:
        region = [F.col(c) for c in ("sido", "sigungu", "emd")]
        parts = [folders(sido, ym_from and ym_from // 100, ym_to and ym_to // 100)]
    else:
        region = [A.parse_sido(address), A.parse_sigungu(address), A.parse_emd(address)]
        parts = [A.may_lie_in(address, sido, sigungu, emd)]
    if sido:
        parts.append(region[0] == sido)
    if sigungu:
        parts.append(region[1] == sigungu)
    if emd:
        parts.append(region[2].isin(list(emd)))
    if complexes:
        parts.append(F.col("complex").isin(list(complexes)))
    if pyeong_bands:
        parts.append(pyeong_band_predicate(F.col("area_m2"), pyeong_bands))
    if ym_from:
        parts.append(F.col("ym") >= ym_from)
    if ym_to:
        parts.append(F.col("ym") <= ym_to)
    return all_of(parts)


def valid_trade_rows() -> Column:
    return (
        F.col("address").isNotNull()
        & F.col("road").isNotNull() & (F.col("road") != "")
        & F.col("built_year").isNotNull() & (F.col("built_year") > 0)
    )


def region_level(level: str, wanted: Iterable[str] | None = None) -> Column:
    """Province rows (chosen by name) or district rows (chosen by 5-digit code)."""
    code = F.col("region_code")
    if level == LEVEL_PROVINCE:
        condition, key = R.is_province_code(code), F.col("region_name")
    else:
        condition, key = ~R.is_province_code(code), R.district_code(code)
    return condition if wanted is None else condition & key.isin(list(wanted))


def index_rows() -> Column:
    return (
        (F.col("asset_kind") == INDEX_ASSET)
        & (F.col("freq") == INDEX_FREQ)
        & R.is_full_code(F.col("region_code"))
    )


def ratio_rows() -> Column:
    """As index_rows, for the ratio table, which has no frequency column."""
    return (F.col("asset_kind") == INDEX_ASSET) & R.is_full_code(F.col("region_code"))


def year_between(date: Column, first: int, last: int) -> Column:
    """Calendar years as a date range, which Parquet statistics can prune."""
    return (date >= F.make_date(F.lit(first), F.lit(1), F.lit(1))) & (
        date < F.make_date(F.lit(last + 1), F.lit(1), F.lit(1))
    )


def area_tolerance(a: Column, b: Column) -> Column:
    return F.abs(a - b) < 1


def household_range(households: Column, low: int, high: int) -> Column:
    """Complexes whose size is unknown pass."""
    return households.isNull() | households.between(low, high)


def nonempty_region() -> Column:
    return all_of([F.col(c) != "" for c in ("sido", "sigungu", "emd")])


def name_pattern(name: Column, pattern: str) -> Column:
    return F.coalesce(name.rlike(pattern), F.lit(False))


def province_prefix(full_name: Column, provinces: Iterable[str]) -> Column:
    """Full region names that start with any chosen province."""
    return reduce(lambda a, b: a | b, [full_name.startswith(p) for p in provinces], F.lit(False))


def drop_null_metric(df: DataFrame, metric: str) -> DataFrame:
    return df.dropna(subset=[metric])


def search_complex(sales: DataFrame, text: str) -> DataFrame:
    """Distinct (address, complex, area) whose complex name contains the text, in no order.

    It reads all sales; sources.names.search_names finds the same in a table of names. For a list
    to show, order it where it is shown (profile.ordered_output).
    """
    return sales.filter(F.col("complex").contains(text)).select("address", "complex", "area_m2").distinct()


def date_slice(series: DataFrame, first=None, last=None, months: int | None = 60) -> DataFrame:
    """Rows between two months; by default the last 60 distinct months present, all with None."""
    if first is not None or last is not None:
        bounds = []
        if first is not None:
            bounds.append(F.col("date") >= F.lit(first))
        if last is not None:
            bounds.append(F.col("date") <= F.lit(last))
        return series.filter(all_of(bounds))
    if months is None:
        return series
    kept = series.select("date").distinct().orderBy(F.desc("date")).limit(months)
    # At most `months` rows, so the broadcast is bounded by the parameter.
    return series.join(F.broadcast(kept), "date", "left_semi")


def named_regions_or_head(df: DataFrame, names: list[str], n: int = 5) -> DataFrame:
    """The named regions; when none of them occurs, the first n by code."""
    named = df.filter(F.col("region_name").isin(names))
    # A join with one row or no row: the head counts only when no name occurs.
    some = named.agg(F.count("*").alias("n")).filter("n > 0").select(F.lit(1).alias("_some"))
    head = df.orderBy("sig_cd").limit(n).withColumn("_some", F.lit(1))
    return named.unionByName(head.join(some, "_some", "left_anti").drop("_some"))
