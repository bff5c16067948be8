"""Trade volume per complex, its repair by lookups, and the ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from danji.functions import address as A, filters, trade as T
from danji.operators.skew import counted

PLACE = ["sido", "sigungu", "complex"]


def volume_by_complex(
    trades: DataFrame, as_of_year: int, *, sido=None, sigungu=None, emd=None, **conditions
) -> DataFrame:
    """Valid trades counted per complex, road, area band and year.

    Trades are counted by their raw columns and only the counts are parsed: the region, age band
    and road key depend on the raw columns alone.
    """
    area = F.col("area_m2")
    if filters.is_stored(trades):
        years = (conditions.get("year_from"), conditions.get("year_to"))
        trades = trades.filter(filters.folders(sido, *years))
    possible = filters.valid_trade_rows() & A.may_lie_in(F.col("address"), sido, sigungu, emd)
    rows = trades.filter(possible).withColumns(
        {
            "area_band": T.area_band(area), "pyeong_band": T.pyeong_band(area),
            "contract_year": T.contract_year(F.col("ym")),
        }
    )
    groups = counted(
        rows.filter(filters.trade_filter_region(**conditions)),
        "address", "complex", "built_year", "road", "area_band", "contract_year",
    )
    parsed = A.with_region_columns(A.with_road_key(groups)).withColumn(
        "age_band", T.age_band(F.col("built_year"), as_of_year)
    )
    return parsed.filter(filters.trade_filter_region(sido, sigungu, emd))


def placed_volumes(
    trades: DataFrame, coords: DataFrame, as_of_year: int, *, sido=None, sigungu=None, emd=None,
    dedupe: bool = False, **conditions,
) -> DataFrame:
    """volume_by_complex with sub-districts filled and coordinates found, in one pass over the trades.

    Trades are counted once by their raw columns; rows that the conditions reject are counted too,
    by address, complex and road alone, since the lookups see them. What best_emd and best_coords
    look up by joins is then found in windows over a complex, all of them dealt by one shuffle of
    the counts: a window holds a complex's distinct values, never its trades.
    """
    address = F.col("address")
    near = trades.filter(address.isNotNull() & A.may_lie_in(address, sido, sigungu))
    if filters.is_stored(trades):
        near = near.filter(filters.folders(sido))
    chosen = filters.valid_trade_rows() & filters.trade_filter_region(**conditions)
    rows = near.withColumns(
        {"area_band": T.area_band(F.col("area_m2")), "pyeong_band": T.pyeong_band(F.col("area_m2")),
         "contract_year": T.contract_year(F.col("ym"))}
    ).withColumn("chosen", F.coalesce(chosen & A.may_lie_in(address, emd), F.lit(False)))
    detail = ["built_year", "area_band", "contract_year"]
    levels = rows.withColumns({c: F.when(F.col("chosen"), F.col(c)) for c in detail})
    groups = counted(levels, "address", "complex", "road", "chosen", *detail)
    parsed = A.with_region_columns(A.with_road_key(groups)).filter(
        filters.trade_filter_region(sido, sigungu)
    )
    known = coords.filter(F.col("lon").isNotNull()).groupBy("road_key").agg(
        F.min(F.struct("lon", "lat")).alias("point")
    )
    # Counts are dealt by complex; both windows and what follows keep that.
    seen = parsed.join(known, "road_key", "left")
    place, named = W.partitionBy(*PLACE), F.col("complex").isNotNull() & (F.col("emd") != "")
    per_emd = F.sum("n").over(W.partitionBy(*PLACE, "emd"))
    modal = F.min(F.when(named, F.struct((-F.col("emd_n")).alias("less"), "emd"))).over(place)
    filled = seen.withColumn("emd_n", per_emd).withColumn(
        "filled", A.fill_emd(F.col("emd"), modal.getField("emd"))
    )
    point = F.struct((-F.length("road_key")).alias("less"), "road_key", "point.lon", "point.lat")
    there = F.when(named & F.col("point").isNotNull(), point)
    here = W.partitionBy(*PLACE, "filled")
    points = F.array(F.min(there).over(here)) if dedupe else F.collect_set(there).over(here)
    found = (
        filled.withColumn("points", points)
        .filter(F.col("chosen") & filters.trade_filter_region(emd=emd))
        .withColumn("best", F.explode_outer("points"))
    )
    kept = [
        "address", "complex", "road", "road_key", *detail, "n", "sido", "sigungu",
        F.col("filled").alias("emd"), F.col("best.lon").alias("best_lon"), F.col("best.lat").alias("best_lat"),
    ]
    located = found.select(*kept).join(coords, "road_key", "left")
    return located.withColumns(
        {"lon": F.coalesce("best_lon", "lon"), "lat": F.coalesce("best_lat", "lat"),
         "age_band": T.age_band(F.col("built_year"), as_of_year)}
    ).drop("best_lon", "best_lat")


def best_emd(trades: DataFrame) -> DataFrame:
    """Most frequent sub-district per complex; ties go to the first by name.

    Counted per raw address first: there are far fewer addresses than trades to parse.
    """
    return best_emd_of(trades.withColumn("n", F.lit(1)))


def best_emd_of(counts: DataFrame) -> DataFrame:
    """best_emd from counts `n` per address and complex, whatever else they are divided by."""
    addresses = counted(counts.filter(F.col("address").isNotNull()), "address", "complex", n=F.sum("n"))
    per_emd = (
        A.with_region_columns(addresses).filter(F.col("emd") != "")
        .groupBy(*PLACE, "emd").agg(F.sum("n").alias("n"))
    )
    return per_emd.groupBy(*PLACE).agg(
        F.min(F.struct((-F.col("n")).alias("less"), "emd")).getField("emd").alias("best_emd")
    )


def best_coords(trades: DataFrame, coords: DataFrame, dedupe: bool = False) -> DataFrame:
    """Coordinates per complex and road, or (dedupe) those of the longest road key per complex."""
    return best_coords_of(counted(trades, "address", "complex", "road"), coords, dedupe)


def best_coords_of(counts: DataFrame, coords: DataFrame, dedupe: bool = False) -> DataFrame:
    """best_coords from counts per address, complex and road, whatever else they are divided by."""
    seen = counts.filter(F.col("road").isNotNull()).select("address", "complex", "road")
    keyed = (
        A.with_region_columns(A.with_road_key(seen)).filter(F.col("emd") != "")
        .select(*PLACE, "emd", "road_key").distinct()
    )
    found = keyed.join(coords.filter(F.col("lon").isNotNull()), "road_key")
    if not dedupe:
        return (
            found.groupBy(*PLACE, "emd", "road_key")
            .agg(F.min(F.struct("lon", "lat")).alias("best"))
            .select(*PLACE, "emd", "road_key", F.col("best.lon").alias("best_lon"),
                    F.col("best.lat").alias("best_lat"))
        )
    order = F.struct((-F.length("road_key")).alias("less"), "road_key", "lon", "lat")
    return (
        found.groupBy(*PLACE, "emd").agg(F.min(order).alias("best"))
        .select(*PLACE, "emd", F.col("best.road_key").alias("road_key"),
                F.col("best.lon").alias("best_lon"), F.col("best.lat").alias("best_lat"))
    )


def households_lookup(complexes: DataFrame) -> DataFrame:
    """Largest household count per base lot address and first word of the complex name."""
    return (
        complexes.filter(F.col("kind_code") == "1")
        .groupBy(
            A.lot_address_base(F.col("lot_address")).alias("lot_base"),
            A.complex_first_word(F.col("complex")).alias("first_word"),
        )
        .agg(F.max("households").alias("households"))
    )


def join_best_emd(volumes: DataFrame, emds: DataFrame) -> DataFrame:
    """Replace an empty sub-district by the most frequent one of the complex."""
    joined = volumes.join(emds, PLACE, "left")
    return joined.withColumn("emd", A.fill_emd(F.col("emd"), F.col("best_emd"))).drop("best_emd")


def join_best_coords(volumes: DataFrame, best: DataFrame) -> DataFrame:
    """Prefer the looked-up coordinates to those of the row's own road."""
    joined = volumes.join(best.drop("road_key"), [*PLACE, "emd"], "left")
    return joined.withColumns(
        {"lon": F.coalesce("best_lon", "lon"), "lat": F.coalesce("best_lat", "lat")}
    ).drop("best_lon", "best_lat")


def join_households_exact(volumes: DataFrame, lookup: DataFrame) -> DataFrame:
    """Add households and turnover by the full lot address and the complex name."""
    base = F.concat("sido", F.lit(" "), "sigungu", F.lit(" "), "emd")
    keyed = volumes.withColumn("lot_base", base)
    named = lookup.withColumnRenamed("first_word", "complex")
    joined = keyed.join(named, ["lot_base", "complex"], "left").drop("lot_base")
    return joined.withColumn("turnover", T.turnover_rate(F.col("n"), F.col("households")))


def complex_rollup(pivot: DataFrame) -> DataFrame:
    """One row per complex: summed count; other attributes from its largest row that has them.

    Equal counts are settled by year, area band, building year and coordinates, highest first.
    """
    order = F.struct("n", "contract_year", "area_band", "built_year", "lon", "lat")

    def largest(name: str) -> Column:
        value = F.col(name)
        return F.max_by(value, F.when(value.isNotNull(), order)).alias(name)

    keys = ["sido", "sigungu", "emd", "complex"]
    rolled = (
        pivot.dropna(subset=keys).groupBy(*keys)
        .agg(
            F.sum("n").alias("total"),
            *[largest(c) for c in ("lon", "lat", "built_year", "age_band", "households")],
        )
        .withColumnRenamed("total", "n")
    )
    return rolled.withColumn("turnover", T.turnover_rate(F.col("n"), F.col("households")))


def top_complexes(rolled: DataFrame, metric: str = "n", limit: int = 20) -> DataFrame:
    """Top complexes by count or turnover; equal ones in the order of their names."""
    return (
        filters.drop_null_metric(rolled, metric)
        .orderBy(F.desc(metric), "sido", "sigungu", "emd", "complex")
        .limit(limit)
    )


def year_pivot(pivot: DataFrame, value: str, years: list[int] | None = None) -> DataFrame:
    """One column per contract year holding the sum; rows with a NULL key are left out.

    A year outside a given list is an error. Without a list the columns are the years there are,
    for which the pivot is run once to find them.
    """
    keys = [
        "sido", "sigungu", "emd", "complex", "built_year", "age_band", "area_band",
        "households", "lon", "lat",
    ]
    rows = pivot.dropna(subset=keys)
    if years is not None:
        rows = rows.withColumn("contract_year", listed_or_error(F.col("contract_year"), years))
    return rows.groupBy(*keys).pivot("contract_year", years).agg(F.sum(value))


def listed_or_error(value: Column, listed: list) -> Column:
    """The value, or an error if it is neither NULL nor listed."""
    message = F.concat(F.lit("not in the list of columns: "), value.cast("string"))
    return F.when(value.isNull() | value.isin(listed), value).otherwise(F.raise_error(message))


def max_households_ceil(complexes: DataFrame) -> DataFrame:
    top = F.max("households")
    return complexes.agg((F.ceil(top / 1000) * 1000).cast("int").alias("max_households"))


def region_hierarchy(trades: DataFrame) -> DataFrame:
    """Distinct province > district > sub-district."""
    return region_hierarchy_of(trades)


def region_hierarchy_of(counts: DataFrame) -> DataFrame:
    """region_hierarchy from counts per address, whatever else they are divided by."""
    addresses = counted(counts.filter(F.col("address").isNotNull()), "address")
    return (
        A.with_region_columns(addresses).select("sido", "sigungu", "emd")
        .filter(filters.nonempty_region()).distinct()
    )


def region_tree(hierarchy: DataFrame) -> DataFrame:
    """One row per province: {district: [sub-districts]}. Its size is that of the country's map."""
    districts = hierarchy.groupBy("sido", "sigungu").agg(
        F.sort_array(F.collect_set("emd")).alias("emds")
    )
    return districts.groupBy("sido").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("sigungu", "emds")))).alias("districts")
    )
