"""The return report: buy in one month, hold for whole years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from danji.functions import address as A, trade as T
from danji.functions.rounding import round1_half_even
from danji.operators import targets as G

INFO = ["sido", "sigungu", "emd", "complex", "area_m2", "pyeong", "households", "built_year"]


def report_months(purchase_ym: int, periods: Sequence[int]) -> dict[str, int]:
    """Column prefix -> month: the purchase and each sale after n years."""
    return {"buy": purchase_ym} | {f"y{n}": purchase_ym + n * 100 for n in periods}


def _amounts(targets: DataFrame, monthly: DataFrame, months: dict[str, int], kind: str, *extra):
    """All requested months of a target in one aggregation over its monthly rows."""
    return G.targets_band_join(targets, monthly).groupBy(*G.TARGET).agg(
        *[
            G.nearest_at(F.col("ym"), F.col("last"), ym).alias(f"{prefix}_{kind}")
            for prefix, ym in months.items()
        ],
        *extra,
    )


def roi_report(
    targets: DataFrame, sales: DataFrame, rents: DataFrame, complexes: DataFrame,
    purchase_ym: int, periods: Sequence[int] = (2, 4),
) -> DataFrame:
    """Per list entry: prices at purchase and after each period, gap, gain and return.

    The return is the gain over the purchase gap; it is NULL when that gap is not positive. A
    `position` of the list is kept as a last column.
    """
    months = report_months(purchase_ym, periods)
    market = G.monthly_sales(G.watched(sales, targets)).drop("last").withColumnRenamed("last_market", "last")
    built = F.min("built_year").alias("built_year")
    listed = A.with_region_columns(targets).withColumns(
        {
            "keyword": A.sigungu_keyword(F.col("address")),
            "pyeong": T.pyeong_round(F.col("area_m2")),
        }
    )
    joined = (
        listed.join(_amounts(targets, market, months, "sale", built), G.TARGET, "left")
        .join(_amounts(targets, G.monthly_leases(G.watched(rents, targets)), months, "lease"), G.TARGET, "left")
        .join(G.households_like_join(targets, complexes), ["complex", "keyword"], "left")
    )
    out = [*INFO, "buy_sale", "buy_lease", T.difference(
        F.col("buy_sale"), F.col("buy_lease")).alias("buy_gap")]
    buy_gap = T.difference(F.col("buy_sale"), F.col("buy_lease"))
    for n in periods:
        sale, lease = F.col(f"y{n}_sale"), F.col(f"y{n}_lease")
        gain = T.difference(sale, F.col("buy_sale"))
        out += [
            sale, lease,
            T.difference(sale, lease).alias(f"y{n}_gap"),
            gain.alias(f"y{n}_gain"),
            F.when(buy_gap > 0, round1_half_even(gain / buy_gap * 100.0)).alias(f"y{n}_return"),
        ]
    return joined.select(*out, *[c for c in targets.columns if c == "position"])
