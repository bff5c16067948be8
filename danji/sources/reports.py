"""Reports as text tables: fixed or dynamic headers, formatted values, CSV output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from danji.functions.rounding import round1_half_even
from danji.plans.roi import INFO, report_months

# Report column -> header. The sheet repeats one header for the four change
# columns; a Spark table needs distinct names, so theirs say what changed.
TRACKING_HEADERS = {
    "sido": "시도",
    "sigungu": "시군구",
    "emd": "읍면동",
    "complex": "단지명",
    "area_m2": "전용면적",
    "pyeong": "평형",
    "households": "세대수",
    "built_year": "건축년도",
    "age": "연식",
    "latest_sale": "당월매매",
    "sale_change": "매매 전월대비",
    "latest_lease": "당월전세",
    "lease_change": "전세 전월대비",
    "gap": "당월매-전",
    "gap_change": "매-전 전월대비",
    "lease_ratio": "전세가율(%)",
    "lease_ratio_change": "전월대비(%p)",
    "peak": "전고점",
    "vs_peak": "전고점대비(%)",
    "prev_sale": "전월매매",
    "prev_lease": "전월전세",
    "prev_gap": "전월매-전",
    "prev_lease_ratio": "전월전세가율(%)",
    "note": "비고",
}
PLAIN_NUMBERS = {"built_year", "age", "pyeong"}
STAMP = "마지막 업데이트"


def roi_headers(purchase_ym: int, periods: Sequence[int]) -> dict[str, str]:
    """Report column -> header; months and periods are part of the headers."""
    headers = {name: TRACKING_HEADERS[name] for name in INFO}
    for prefix, ym in report_months(purchase_ym, periods).items():
        month = f"{ym // 100}.{ym % 100}"
        headers[f"{prefix}_sale"] = f"{month} 매매가"
        headers[f"{prefix}_lease"] = f"{month} 전세가"
        headers[f"{prefix}_gap"] = f"{month} 갭"
        if prefix != "buy":
            years = prefix.removeprefix("y")
            headers[f"{prefix}_gain"] = f"{years}년 매매차익"
            headers[f"{prefix}_return"] = f"{years}년 수익률(%)"
    return headers


def format_value(value: Column, kind: T.DataType, separators: bool = True) -> Column:
    """'-' for NULL, thousands separators on whole numbers, one decimal on the others."""
    def whole(x: Column) -> Column:
        number = x.cast("bigint")
        return F.format_number(number, 0) if separators else number.cast("string")

    if isinstance(kind, (T.DoubleType, T.FloatType)):
        tenths = F.format_string("%.1f", round1_half_even(value))
        text = F.when(value == F.floor(value), whole(value)).otherwise(tenths)
    elif isinstance(kind, T.IntegralType):
        text = whole(value)
    else:
        text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(text)


def format_report(report: DataFrame, headers: dict[str, str]) -> DataFrame:
    """The report in header order, every value as text; by position if the report has one."""
    if "position" in report.columns:
        report = report.orderBy("position")
    types = {f.name: f.dataType for f in report.schema.fields}
    return report.select(
        *[
            format_value(F.col(name), types[name], name not in PLAIN_NUMBERS).alias(header)
            for name, header in headers.items()
        ]
    )


def export_tracking(report: DataFrame, path: str, stamp: str) -> None:
    """Replace the tracking table at `path`."""
    table = format_report(report, TRACKING_HEADERS).withColumn(STAMP, F.lit(stamp))
    table.write.mode("overwrite").csv(path, header=True)


def export_roi(
    report: DataFrame, path: str, purchase_ym: int, periods: Sequence[int], stamp: str
) -> None:
    """Replace the return table at `path`; the stamp column also tells month and periods."""
    month = f"{purchase_ym // 100}.{purchase_ym % 100}"
    years = ", ".join(str(n) for n in periods)
    note = f"매수시점: {month} | 비교기간: {years}년 | {STAMP}: {stamp}"
    table = format_report(report, roi_headers(purchase_ym, periods)).withColumn(STAMP, F.lit(note))
    table.write.mode("overwrite").csv(path, header=True)
