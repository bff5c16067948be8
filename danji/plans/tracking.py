"""The tracking report: 24 columns per watched complex."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from danji.functions import address as A, trade as T
from danji.functions.rounding import round1_half_even
from danji.operators import targets as G

COLUMNS = [
    "sido", "sigungu", "emd", "complex", "area_m2", "pyeong", "households", "built_year", "age",
    "latest_sale", "sale_change", "latest_lease", "lease_change", "gap", "gap_change",
    "lease_ratio", "lease_ratio_change", "peak", "vs_peak", "prev_sale", "prev_lease", "prev_gap",
    "prev_lease_ratio", "note",
]


def spread_columns() -> dict[str, Column]:
    """Gap, ratio and month-over-month columns; a missing or zero amount makes them NULL."""
    sale, lease = F.col("latest_sale"), F.col("latest_lease")
    prev_sale, prev_lease = F.col("prev_sale"), F.col("prev_lease")
    return {
        "sale_change": T.difference(sale, prev_sale),
        "lease_change": T.difference(lease, prev_lease),
        "gap": T.difference(sale, lease),
        "prev_gap": T.difference(prev_sale, prev_lease),
        "lease_ratio": T.lease_ratio_pct(lease, sale),
        "prev_lease_ratio": T.lease_ratio_pct(prev_lease, prev_sale),
    }


def spread_changes() -> dict[str, Column]:
    return {
        "gap_change": F.col("gap") - F.col("prev_gap"),
        "lease_ratio_change": round1_half_even(F.col("lease_ratio") - F.col("prev_lease_ratio")),
    }


def tracking_report(
    targets: DataFrame, sales: DataFrame, rents: DataFrame, complexes: DataFrame, as_of_year: int
) -> DataFrame:
    """One row per list entry, with one pass over each fact table.

    A `position` of the list (see sources.targets.load_targets) is kept as a last column.
    """
    address, area = F.col("address"), F.col("area_m2")
    listed = A.with_region_columns(targets).withColumn("keyword", A.sigungu_keyword(address))
    joined = (
        listed.join(G.sale_summary(targets, sales), G.TARGET, "left")
        .join(G.lease_summary(targets, rents), G.TARGET, "left")
        .join(G.households_like_join(targets, complexes), ["complex", "keyword"], "left")
    )
    note = F.when(F.col("latest_is_direct"), F.lit("직거래"))
    return (
        joined.withColumns(spread_columns()).withColumns(spread_changes())
        .withColumns(
            {
                "pyeong": T.pyeong_round(area),
                "age": T.building_age_or_null(F.col("built_year"), as_of_year),
                "vs_peak": T.vs_peak_pct(F.col("latest_sale"), F.col("peak")),
                "note": note,
            }
        )
        .select(*COLUMNS, *[c for c in targets.columns if c == "position"])
    )
