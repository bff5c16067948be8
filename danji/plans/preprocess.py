"""The trade preprocessor: an ordered list of named steps folded over a trade table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from danji.functions import address as A, filters, trade as T
from danji.operators import enrich


@dataclass(frozen=True)
class StepInputs:
    """What the steps may need beside the trades."""

    as_of_year: int | None = None
    coords: DataFrame | None = None
    complexes: DataFrame | None = None

    def need(self, name: str):
        value = getattr(self, name)
        if value is None:
            raise ValueError(f"this step needs {name}")
        return value


Step = Callable[[DataFrame, StepInputs], DataFrame]


def _parse_address(df: DataFrame, given: StepInputs) -> DataFrame:
    return A.with_region_columns(df)


def _area_band(df: DataFrame, given: StepInputs) -> DataFrame:
    return df.withColumn("area_band", T.area_band(F.col("area_m2")))


def _pyeong(df: DataFrame, given: StepInputs) -> DataFrame:
    area = F.col("area_m2")
    return df.withColumns({"pyeong": T.pyeong_floor(area), "pyeong_band": T.pyeong_band(area)})


def _age(df: DataFrame, given: StepInputs) -> DataFrame:
    year, built = given.need("as_of_year"), F.col("built_year")
    return df.withColumns({"age": T.building_age(built, year), "age_band": T.age_band(built, year)})


def _coords(df: DataFrame, given: StepInputs) -> DataFrame:
    return enrich.join_coords(df, given.need("coords"))


def _households(df: DataFrame, given: StepInputs) -> DataFrame:
    return enrich.join_households_simple(df, given.need("complexes"))


STEPS: dict[str, Step] = {
    "parse_address": _parse_address,
    "area_band": _area_band,
    "pyeong": _pyeong,
    "building_age": _age,
    "join_coords": _coords,
    "join_households": _households,
}
DEFAULT_STEPS = ["parse_address", "area_band", "pyeong", "building_age"]

# The step names users already know.
KOREAN_STEP_NAMES = {
    "주소파싱": "parse_address",
    "면적분류": "area_band",
    "평형환산": "pyeong",
    "연식계산": "building_age",
    "좌표연결": "join_coords",
    "세대수연결": "join_households",
}


def preprocess_trades(
    trades: DataFrame, steps: Sequence[str] | str | None = None, *,
    as_of_year: int | None = None, coords: DataFrame | None = None,
    complexes: DataFrame | None = None,
) -> DataFrame:
    """Apply steps in order. None: the four column steps; "all": all six; []: a plain scan."""
    if steps is None:
        steps = DEFAULT_STEPS
    elif steps == "all":
        steps = list(STEPS)
    names = [KOREAN_STEP_NAMES.get(s, s) for s in steps]
    for name in names:
        if name not in STEPS:
            raise ValueError(f"unknown step {name!r}; known steps: {', '.join(STEPS)}")
    given = StepInputs(as_of_year, coords, complexes)
    for name in names:
        trades = trades.transform(STEPS[name], given)
    return trades


def derive_trade_columns(trades: DataFrame, as_of_year: int) -> DataFrame:
    """Valid trades with every derived column of the ranking queries."""
    area, built, ym = F.col("area_m2"), F.col("built_year"), F.col("ym")
    kept = ["address", "complex", "area_m2", "ym", "built_year", "road"]
    if "rent_kind" in trades.columns:
        kept.append("rent_kind")
    valid = trades.filter(filters.valid_trade_rows()).select(*kept)
    return A.with_region_columns(A.with_road_key(valid)).withColumns(
        {
            "area_band": T.area_band(area),
            "pyeong": T.pyeong_raw(area),
            "pyeong_band": T.pyeong_band(area),
            "contract_year": T.contract_year(ym),
            "age": T.building_age(built, as_of_year),
            "age_band": T.age_band(built, as_of_year),
        }
    )
