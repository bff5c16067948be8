"""Joins and medians that keep any one key from filling one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window as W


def lookup_join(facts: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join row-level facts to a lookup on equal keys.

    Catalyst broadcasts a lookup whose estimated bytes are within the session's threshold, and AQE
    does when the counted bytes are; else both sides are shuffled and AQE splits a key (or the rows
    without one) that fills a partition. Unmatched lookup rows never come out.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a lookup is joined left or inner, not {how}")
    return facts.join(lookup, keys, how)


def counted(df: DataFrame, *columns: str, n: Column | None = None) -> DataFrame:
    """Distinct values of the columns with their row count `n`, or another positive aggregate.

    The values are tied to the count, so that Catalyst leaves conditions on what is parsed from
    them above this aggregate: they are judged once per distinct value, not once per row.
    """
    groups = df.groupBy(*columns).agg((F.count("*") if n is None else n).alias("n"))
    return groups.withColumns({c: F.when(F.col("n") > 0, F.col(c)) for c in columns})


#: Buckets to a doubling of the value: values in one bucket agree in about five digits.
BUCKETS = 1 << 16


def _joined(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """a and the other columns of b, where the columns are the same, null too."""
    right = b.withColumnsRenamed({c: f"_right_{c}" for c in columns})
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in columns])
    return a.join(right, same).drop(*[f"_right_{c}" for c in columns])


def _upto(keys: list[str], order: str) -> Column:
    running = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return F.sum("_n").over(running)


def _holds(rank: Column) -> Column:
    """Whether a rank, counted from 1, falls on this row of a running count."""
    return (rank <= F.col("_upto")) & (rank > F.col("_upto") - F.col("_n"))


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float], rows: str = "_rows"
) -> DataFrame:
    """Exact quantiles per key, interpolated between neighbours, the number of values as `n`, and of rows.

    Rows are first counted per (key, value). A rank is then looked for in a histogram of the values'
    magnitudes, and only the values of the bucket that holds it are ordered. So no task orders all
    values of a key, however many it has, but its buckets, whose number the range of the values
    bounds. NULL values count as rows only; a key without values has NULL quantiles.
    """
    number = F.col("_value").cast("double")
    size = F.floor(F.log2(F.abs(number) + 1) * BUCKETS)
    groups = df.groupBy(*keys, F.col(value).alias("_value")).agg(F.count("*").alias("_n")).withColumn(
        "_bucket", F.when(number < 0, -size).otherwise(size)
    )
    by_key = W.partitionBy(*keys)
    buckets = groups.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_all")).withColumn(
        "_n", F.when(F.col("_bucket").isNotNull(), F.col("_all")).otherwise(0)
    ).withColumns({
        "_upto": _upto(keys, "_bucket"), "n": F.sum("_n").over(by_key), rows: F.sum("_all").over(by_key),
    })
    # Two ranks for each quantile: the values on either side of its place.
    wanted = []
    for i, q in enumerate(quantiles.values()):
        place = F.lit(float(q)) * (F.col("n") - 1)
        wanted += [
            F.struct(F.lit(2 * i + j).alias("which"), (side(place) + 1).alias("rank"))
            for j, side in enumerate((F.floor, F.ceil))
        ]
    held = (
        buckets.withColumn("_want", F.explode(F.array(*wanted)))
        .filter(_holds(F.col("_want.rank")) | (F.col("n") == 0))
        .selectExpr(*keys, "_bucket", "n", rows, "_want.which AS _which", "_want.rank - (_upto - _n) AS _rank")
    )
    inside = _joined(groups, held, [*keys, "_bucket"]).withColumn("_upto", _upto([*keys, "_which"], "_value"))
    found = inside.filter(_holds(F.col("_rank")) | (F.col("n") == 0)).groupBy(*keys).agg(
        F.max("n").alias("n"), F.max(rows).alias(rows),
        *[F.max(F.when(F.col("_which") == w, F.col("_value"))).alias(f"_{w}") for w in range(len(wanted))],
    )
    out = {}
    for i, (name, q) in enumerate(quantiles.items()):
        place = F.lit(float(q)) * (F.col("n") - 1)
        low, high, share = F.col(f"_{2 * i}"), F.col(f"_{2 * i + 1}"), place - F.floor(place)
        out[name] = F.when(share == 0, low.cast("double")).otherwise(low * (1 - share) + high * share)
    return found.withColumns(out).select(*keys, *quantiles, "n", rows)


def exact_median(df: DataFrame, keys: list[str], value: str, out: str, rows: str | None = None) -> DataFrame:
    """Exact median per key, with the number of values as `n`; see exact_quantiles.

    `rows` names a column for the number of rows, those without a value included; without it, keys
    that have no value are left out.
    """
    if rows:
        return exact_quantiles(df, keys, value, {out: 0.5}, rows)
    return exact_quantiles(df.filter(F.col(value).isNotNull()), keys, value, {out: 0.5}).drop("_rows")
