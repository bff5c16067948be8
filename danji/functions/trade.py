"""Columns derived from one transaction: bands, ages, months, prices, spreads."""

from pyspark.sql import Column, functions as F

from danji.constants import (
    AGE_BAND_LAST, AGE_BANDS, AREA_BAND_LAST, AREA_BANDS, DIRECT_DEAL, NOT_CANCELLED_WIDE,
    PYEONG_BAND_LAST, PYEONG_BANDS, PYEONG_PER_M2,
)
from danji.functions.rounding import round0_half_even, round1_half_even, round_half_up


def _below(value: Column, edges, last: str) -> Column:
    """Label of the first edge above the value; NULL falls to the last label."""
    label = F
    for edge, name in edges:
        label = label.when(value < edge, F.lit(name))
    return label.otherwise(F.lit(last))


def area_band(area: Column) -> Column:
    label = F
    for edge, name in AREA_BANDS:
        label = label.when(area <= edge, F.lit(name))
    return label.otherwise(F.lit(AREA_BAND_LAST))


def pyeong_raw(area: Column) -> Column:
    return area * PYEONG_PER_M2


def pyeong_floor(area: Column) -> Column:
    return F.floor(pyeong_raw(area)).cast("int")


def pyeong_round(area: Column) -> Column:
    """Nearest whole pyeong, ties to even."""
    return round0_half_even(pyeong_raw(area))


def pyeong_band(area: Column) -> Column:
    """Bands of ten pyeong, picked by position; NULL falls to the last label."""
    labels = F.array(*[F.lit(name) for _, name in PYEONG_BANDS], F.lit(PYEONG_BAND_LAST))
    last = len(PYEONG_BANDS)
    tens = F.floor(pyeong_raw(area) / 10).cast("int")
    place = F.least(F.greatest(F.coalesce(tens, F.lit(last)), F.lit(0)), F.lit(last))
    return F.get(labels, place)


def building_age(built_year: Column, as_of_year: int) -> Column:
    """At least 1; an unknown year also gives 1."""
    return F.greatest(F.lit(1), F.lit(as_of_year) - built_year)


def building_age_or_null(built_year: Column, as_of_year: int) -> Column:
    """At least 1; an unknown or zero year gives NULL."""
    return F.when(built_year != 0, building_age(built_year, as_of_year))


def age_band(built_year: Column, as_of_year: int) -> Column:
    return _below(F.lit(as_of_year) - built_year, AGE_BANDS, AGE_BAND_LAST)


def contract_year(ym: Column) -> Column:
    return F.floor(ym / 100).cast("int")


def price_in_eok(amount: Column) -> Column:
    """Amount in units of 10,000 to units of 100 million, one decimal."""
    return round_half_up(amount / 10000.0, 1)


def prev_month(ym: Column) -> Column:
    return F.when(ym % 100 == 1, ym - 89).otherwise(ym - 1)


def add_years(ym: Column, years) -> Column:
    return ym + F.lit(years) * 100


def month_index(ym: Column) -> Column:
    """Months on a line, so that differences count months."""
    return F.floor(ym / 100).cast("int") * 12 + ym % 100


def month_distance(a: Column, b: Column) -> Column:
    return F.abs(month_index(a) - month_index(b))


def ym_to_date(ym: Column, day: int = 15) -> Column:
    return F.make_date(F.floor(ym / 100).cast("int"), (ym % 100).cast("int"), F.lit(day))


def ym_label(ym: Column) -> Column:
    """'YYYY-MM'."""
    return F.concat(
        contract_year(ym).cast("string"), F.lit("-"), F.lpad((ym % 100).cast("string"), 2, "0")
    )


def ym_label_dot(ym: Column) -> Column:
    """'YYYY.M'."""
    return F.concat(contract_year(ym).cast("string"), F.lit("."), (ym % 100).cast("string"))


def turnover_rate(n: Column, households: Column) -> Column:
    return F.when(households > 0, round_half_up(n * F.lit(100.0) / households, 2))


def difference(a: Column, b: Column) -> Column:
    """a - b; a missing or zero amount gives NULL."""
    return F.when((a != 0) & (b != 0), a - b)


def lease_ratio_pct(deposit: Column, price: Column) -> Column:
    return F.when((deposit != 0) & (price != 0), round1_half_even(deposit / price * 100.0))


def vs_peak_pct(latest: Column, peak: Column) -> Column:
    return F.when(
        (latest != 0) & (peak != 0), round1_half_even((latest / peak - F.lit(1)) * 100.0)
    )


def direct_deal_note(deal_type: Column) -> Column:
    return F.when(deal_type == DIRECT_DEAL, F.lit(DIRECT_DEAL))


def cancel_status_bucket(cancelled_on: Column) -> Column:
    return (
        F.when(cancelled_on.isNull(), F.lit("NULL"))
        .when(cancelled_on.isin(NOT_CANCELLED_WIDE), cancelled_on)
        .otherwise(F.lit("날짜값"))
    )


def numeric_cast(text: Column, to: str = "double") -> Column:
    """Text to a number; text that is no number becomes NULL."""
    return text.try_cast(to)
