"""Trades of watched complexes, found set-at-a-time.

A target is (complex, area); it owns the trades of that complex name whose area differs by less
than 1. The trades of the listed names are first reduced to one row per (complex, area, month), so a complex that holds
a large part of all trades is reduced on the map side before any join.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from danji.constants import DEPOSIT_LEASE
from danji.functions import address as A, filters, trade as T

TARGET = ["complex", "area_m2"]

# A trade's day, amount and direct-deal mark in one decimal that orders by exactly these, so that
# "the latest trade" is a plain max in a hash aggregate. It holds every int day and bigint amount.
_DAY, _AMOUNT = Decimal(2**31), Decimal(2**63)


def pack(day: Column, amount: Column, mark: Column | None = None) -> Column:
    days = F.coalesce(day, F.lit(0)).cast("decimal(10,0)") + F.lit(_DAY)
    key = days * F.lit(2 * _AMOUNT) + (amount.cast("decimal(20,0)") + F.lit(_AMOUNT))
    return key * 2 + (F.lit(0) if mark is None else F.coalesce(mark.cast("int"), F.lit(0)))


def packed_amount(key: Column) -> Column:
    low = key % F.lit(4 * _AMOUNT)
    return ((low - key % 2) / 2 - F.lit(_AMOUNT)).cast("bigint")


def packed_mark(key: Column) -> Column:
    return key % 2 == 1


def watched(trades: DataFrame, targets: DataFrame) -> DataFrame:
    """The trades of the complex names on the list; put first, so only they are aggregated."""
    return trades.join(targets.select("complex").distinct(), "complex", "left_semi")


def monthly_sales(sales: DataFrame) -> DataFrame:
    """Per (complex, area, month): latest and highest active sale, and the latest market sale.

    Equal days are settled by the higher price, then by the direct deal.
    """
    active = filters.active_sales_strict()
    key = pack(F.col("day"), F.col("price"), F.col("deal_type") == "직거래")
    return sales.groupBy("complex", "area_m2", "ym").agg(
        F.max(F.when(active, key)).alias("last"),
        F.max(F.when(active & filters.exclude_direct_nulldrop(), key)).alias("last_market"),
        F.max(F.when(active, F.col("price"))).alias("peak"),
        F.min("built_year").alias("built_year"),
    )


def monthly_leases(rents: DataFrame) -> DataFrame:
    """Per (complex, area, month): latest deposit lease, the higher deposit first."""
    leases = rents.filter(F.col("rent_kind") == DEPOSIT_LEASE)
    return leases.groupBy("complex", "area_m2", "ym").agg(
        F.max(pack(F.col("day"), F.col("deposit"))).alias("last")
    )


def targets_band_join(targets: DataFrame, monthly: DataFrame) -> DataFrame:
    """Monthly rows of each target: equal complex name, areas less than 1 apart.

    Areas less than 1 apart have floors at most 1 apart, so the target is put into three
    one-square-metre cells and the join is an equi-join on (complex, cell).
    """
    cell = F.floor("area_m2")
    wanted = targets.select(*TARGET).distinct().select(
        "complex", F.col("area_m2").alias("target_area"),
        F.explode(F.array(cell - 1, cell, cell + 1)).alias("_cell"),
    )
    return (
        monthly.withColumn("_cell", cell)
        .join(wanted, ["complex", "_cell"])
        .filter(filters.area_tolerance(F.col("area_m2"), F.col("target_area")))
        .drop("_cell", "area_m2")
        .withColumnRenamed("target_area", "area_m2")
    )


def target_months(targets: DataFrame, monthly: DataFrame) -> DataFrame:
    """One row per target and month, from the monthly rows of all its areas."""
    extra = [
        fold(name).alias(name)
        for name, fold in (("peak", F.max), ("built_year", F.min)) if name in monthly.columns
    ]
    return (
        targets_band_join(targets, monthly).groupBy(*TARGET, "ym")
        .agg(F.max("last").alias("last"), *extra)
    )


def _latest_and_previous(months: DataFrame, *extra: Column) -> DataFrame:
    """Latest month with a trade, and the calendar month before it if that has one.

    A target has one row per month here. Months without a counted trade come last, so the month
    before, when it has a trade, is the next row.
    """
    by_target = W.partitionBy(*TARGET)
    order = by_target.orderBy(F.col("last").isNotNull().desc(), F.desc("ym"))
    ranked = months.withColumns(
        {
            "_rank": F.row_number().over(order),
            "_next_ym": F.lead("ym").over(order),
            "_next_last": F.lead("last").over(order),
        }
    ).select("*", *extra).filter(F.col("_rank") == 1)
    follows = F.col("_next_ym") == T.prev_month(F.col("ym"))
    return ranked.withColumns(
        {
            "latest_ym": F.when(F.col("last").isNotNull(), F.col("ym")),
            "latest": packed_amount(F.col("last")),
            "previous": F.when(follows, packed_amount(F.col("_next_last"))),
        }
    )


def sale_summary(targets: DataFrame, sales: DataFrame) -> DataFrame:
    """Everything the reports need from sales, with one pass over them.

    Latest sale and its month and direct mark, the sale of the month before, the highest active
    price, and the earliest building year among all trades.
    """
    by_target = W.partitionBy(*TARGET)
    months = target_months(targets, monthly_sales(watched(sales, targets)))
    latest = _latest_and_previous(
        months, F.max("peak").over(by_target).alias("top"),
        F.min("built_year").over(by_target).alias("first_built"),
    )
    return latest.select(
        *TARGET, "latest_ym", F.col("latest").alias("latest_sale"),
        packed_mark(F.col("last")).alias("latest_is_direct"),
        F.col("previous").alias("prev_sale"), F.col("top").alias("peak"),
        F.col("first_built").alias("built_year"),
    )


def lease_summary(targets: DataFrame, rents: DataFrame) -> DataFrame:
    """Latest deposit lease and its month, and the lease of the month before."""
    return _latest_and_previous(target_months(targets, monthly_leases(watched(rents, targets)))).select(
        *TARGET, F.col("latest_ym").alias("latest_lease_ym"),
        F.col("latest").alias("latest_lease"), F.col("previous").alias("prev_lease"),
    )


def households_like_join(targets: DataFrame, complexes: DataFrame) -> DataFrame:
    """Households of the register entries named like the target, in its district (the largest).

    The keyword may stand anywhere in the lot address. A lot number holds only digits and hyphens,
    so a keyword without those is looked for in the address without its lot number. The register
    then has one row per complex name and neighbourhood, however many lots share the name.
    """
    wanted = targets.select(
        "complex", A.sigungu_keyword(F.col("address")).alias("keyword")
    ).distinct()
    numbered = F.col("keyword").rlike("[0-9-]")
    lot = F.col("lot_address")

    def found(keywords: DataFrame, text: Column) -> DataFrame:
        register = watched(complexes, targets).groupBy("complex", text.alias("_text")).agg(
            F.max("households").alias("households")
        )
        return keywords.join(register, "complex").filter(
            F.col("_text").contains(F.col("keyword"))
        )

    both = found(wanted.filter(~numbered), A.lot_address_base(lot)).unionByName(
        found(wanted.filter(numbered), lot)
    )
    return both.groupBy("complex", "keyword").agg(F.max("households").alias("households"))


def nearest_rank(around: DataFrame, max_months: int) -> DataFrame:
    """The better of the trades `before` and `after` a requested month, each a struct (ym, last).

    Fewest months away, then the later day and the higher amount, as `last` orders them.
    """
    def offer(side: str) -> Column:
        distance = T.month_distance(F.col(f"{side}.ym"), F.col("target_ym"))
        near = F.col(side).isNotNull() & (distance <= max_months)
        return F.when(near, F.struct((-distance).alias("minus"), F.col(f"{side}.last").alias("last")))

    best = F.greatest(offer("before"), offer("after"))
    return around.withColumn("best", best).filter(F.col("best").isNotNull())


def nearest_month_price(
    requests: DataFrame, monthly: DataFrame, max_months: int = 12
) -> DataFrame:
    """Price at (complex, area, target_ym): that month's, else the nearest within max_months.

    Equally near months are settled by the later day of month, then the higher amount. A target's
    months and its requests are one list, sorted once: a request sees the last trade up to its
    month and the next one after it, so no trade is paired with more than its neighbours.
    """
    trades = target_months(requests, monthly).filter(F.col("last").isNotNull())
    trade = F.struct("ym", "last")
    line = trades.select(*TARGET, "ym", trade.alias("trade"), F.lit(None).cast("int").alias("target_ym"))
    asked = requests.select(
        *TARGET, F.col("target_ym").alias("ym"), F.lit(None).cast(line.schema["trade"].dataType).alias("trade"),
        F.col("target_ym").cast("int"),
    ).distinct()
    # A trade of the requested month itself stands before the request.
    place = "PARTITION BY complex, area_m2 ORDER BY ym, trade IS NULL"
    around = line.unionByName(asked).selectExpr(
        *TARGET, "target_ym",
        f"last_value(trade) IGNORE NULLS OVER ({place} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS before",
        f"lead(trade, 1) IGNORE NULLS OVER ({place}) AS after",
    ).filter("target_ym IS NOT NULL")
    return nearest_rank(around, max_months).select(
        *TARGET, "target_ym", packed_amount(F.col("best.last")).alias("amount"),
        (-F.col("best.minus")).alias("distance"),
    )


def nearest_at(ym: Column, last: Column, target_ym: int, max_months: int = 12) -> Column:
    """Aggregate over a target's months: the amount nearest to one fixed month."""
    distance = T.month_distance(ym, F.lit(target_ym))
    # (closeness, day, amount) in one decimal, above the 97 bits of a packed trade.
    key = (max_months - distance).cast("decimal(8,0)") * F.lit(Decimal(2**97)) + last
    return packed_amount(F.max(F.when(distance <= max_months, key)))


def _found(candidates: DataFrame, sales: DataFrame) -> DataFrame:
    """(complex, area_m2, address, actual): where and with what area a candidate was traded."""
    known = watched(sales, candidates).select("address", "complex", "area_m2").distinct()
    return targets_band_join(candidates, known.withColumn("actual", F.col("area_m2")))


def _one_apart(areas: DataFrame) -> DataFrame:
    """Of each complex's rows, by rising actual_area, those that are 1 or more above the last one taken.

    A gap of 1 or more begins a new chain, whatever was taken before it, and the chain's first row
    is taken. Only chains of several rows, such as those of areas written a little differently, are
    walked, each by itself.
    """
    rising = W.partitionBy("complex").orderBy("actual_area")
    gap = F.col("actual_area") - F.lag("actual_area").over(rising)
    chains = areas.withColumn("_new", F.coalesce(gap >= 1, F.lit(True)).cast("int")).withColumn(
        "_chain", F.sum("_new").over(rising)
    ).groupBy("complex", "_chain").agg(
        F.sort_array(F.collect_list(F.struct("actual_area", "area_m2"))).alias("_rows")
    )
    first = F.slice("_rows", 1, 1)
    walked = F.aggregate(
        "_rows", first, lambda kept, row: F.when(
            row["actual_area"] - F.element_at(kept, -1)["actual_area"] >= 1, F.concat(kept, F.array(row))
        ).otherwise(kept),
    )
    kept = F.when(F.size("_rows") == 1, F.col("_rows")).otherwise(walked)
    return chains.select("complex", F.explode(kept).alias("_row")).select("complex", "_row.actual_area", "_row.area_m2")


def validate_targets(candidates: DataFrame, sales: DataFrame, listed: DataFrame) -> DataFrame:
    """Status of each candidate (complex, area): not_found, ambiguous, duplicate or accepted.

    An accepted candidate carries the address and the actual area of its trades: the smallest
    area at the address, which for one address is also the first found. The candidates of a batch
    are taken by rising area: one whose actual area is less than 1 from that of an earlier accepted
    one of its name is a duplicate, as if it had been added after it.
    """
    found = (
        _found(candidates, sales).groupBy(*TARGET)
        .agg(
            F.min("address").alias("address"), F.max("address").alias("_last_address"),
            F.min("actual").alias("actual_area"),
        )
    )
    actual = found.select(
        "complex", F.col("actual_area").alias("area_m2")
    ).distinct()
    taken = (
        targets_band_join(actual, listed.select(*TARGET))
        .select("complex", F.col("area_m2").alias("actual_area")).distinct()
        .withColumn("_taken", F.lit(True))
    )
    judged = (
        candidates.select(*TARGET).distinct().join(found, TARGET, "left")
        .join(taken, ["complex", "actual_area"], "left")
    )
    alone = F.col("address") == F.col("_last_address")
    free = judged.filter(alone & F.col("_taken").isNull())
    added = _one_apart(free.groupBy("complex", "actual_area").agg(F.min("area_m2").alias("area_m2")))
    added = added.select(*TARGET, F.lit(True).alias("_added"))
    status = (
        F.when(F.col("address").isNull(), "not_found")
        .when(~alone, "ambiguous")
        .when(F.col("_added"), "accepted")
        .otherwise("duplicate")
    )
    shown = F.col("status").isin("accepted", "duplicate")
    return judged.join(added, TARGET, "left").withColumn("status", status).select(
        *TARGET, "status", F.when(shown, F.col("address")).alias("address"),
        F.when(shown, F.col("actual_area")).alias("actual_area"),
    )


def ambiguous_addresses(candidates: DataFrame, sales: DataFrame) -> DataFrame:
    """The addresses and areas a user may mean by a candidate whose name is traded at several."""
    found = _found(candidates, sales).distinct()
    several = found.groupBy(*TARGET).agg(F.countDistinct("address").alias("n")).filter("n > 1")
    return found.join(several, TARGET, "left_semi").select(*TARGET, "address", F.col("actual").alias("actual_area"))


def accept_targets(judged: DataFrame, listed: DataFrame) -> DataFrame:
    """The list with the accepted candidates added."""
    added = judged.filter("status = 'accepted'").select(
        "address", "complex", F.col("actual_area").alias("area_m2")
    )
    return listed.select("address", "complex", "area_m2").unionByName(added.distinct())


def remove_targets(listed: DataFrame, removals: DataFrame) -> DataFrame:
    """The list without entries named in removals whose area is less than 1 away."""
    gone = targets_band_join(removals, listed.select(*TARGET).withColumn("listed", F.col("area_m2")))
    gone = gone.select("complex", F.col("listed").alias("area_m2")).distinct()
    return listed.join(gone, TARGET, "left_anti").select(*listed.columns)
