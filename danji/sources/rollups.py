"""Stored partial counts of trades, kept up month by month, and stored lookups.

The counts are a row per month and distinct (address, complex, road). Most lookups and hierarchies are
made of such counts, so a question about a hundred million trades reads a few million rows, and a new
month of trades changes that month's folder only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

COUNTED = ["address", "complex", "road"]
MANIFEST = "version bigint, source string, path string, months array<int>, trades bigint"


def touched_months(batch: DataFrame) -> list[int | None]:
    """The months a batch of new, changed or withdrawn trades belongs to, from a distinct aggregate."""
    return sorted((r[0] for r in batch.select("ym").distinct().collect()), key=lambda m: (m is not None, m or 0))


def _of_months(trades: DataFrame, months: Iterable[int | None]) -> DataFrame:
    """The trades of some months; a condition that reaches the scan."""
    known = [m for m in months if m is not None]
    wanted = F.col("ym").isin(known)
    return trades.filter(wanted | F.col("ym").isNull() if None in months else wanted)


def refresh_counts(trades: DataFrame, path: str, source: str, months: list[int | None] | None = None) -> None:
    """Count the trades of the touched months anew and put them in the place of what was stored.

    `trades` is the whole table as it is now, `source` names its state, such as its version or the
    time of its last load. Without `months` all are counted. Only the touched months' folders are
    overwritten (dynamic partition overwrite); a month that has lost all its trades is overwritten
    by a mark without a count. Counting anew, not adding, makes a refresh that is run twice, or
    after one that was cut off, right. The manifest's row is written last: until then the counts
    pass for those of the state before, and readers that ask for the new one compute.
    """
    spark = trades.sparkSession
    rows = trades if months is None else _of_months(trades, months)
    counts = rows.groupBy("ym", *COUNTED).agg(F.count("*").alias("n"))
    if months is not None:
        counts = counts.unionByName(
            spark.createDataFrame([(m, 0) for m in months], "ym int, n bigint"), allowMissingColumns=True
        )
    writer = counts.withColumn("month", F.col("ym")).drop("ym").hint("rebalance", "month").write.mode("overwrite")
    mode = "static" if months is None else "dynamic"
    writer.option("partitionOverwriteMode", mode).partitionBy("month").parquet(f"{path}/counts")
    stored = _stored_counts(spark, path).agg(F.sum("n").alias("trades"))
    _note(stored.select("trades"), path, source, f"{path}/counts", months)


def _note(trades: DataFrame, path: str, source: str, data: str, months: list[int | None] | None) -> None:
    """Append the manifest's next row; `trades` is one row of one count."""
    last = manifest(trades.sparkSession, path)
    number = 1 if last is None else last["version"] + 1
    listed = F.lit(None).cast("array<int>") if months is None else F.array(*[F.lit(m).cast("int") for m in months]).cast("array<int>")
    trades.select(
        F.lit(number).cast("bigint").alias("version"), F.lit(source).alias("source"), F.lit(data).alias("path"),
        listed.alias("months"), F.coalesce("trades", F.lit(0)).cast("bigint").alias("trades"),
    ).coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest row of a manifest, or None; a manifest has a row per refresh."""
    try:
        row = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").orderBy(F.desc("version")).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row.asDict() if row else None


def _stored_counts(spark: SparkSession, path: str) -> DataFrame:
    kept = spark.read.schema("address string, complex string, road string, n bigint, month int").parquet(f"{path}/counts")
    return kept.filter("n > 0").select(F.col("month").alias("ym"), *COUNTED, "n")


def trade_counts(trades: DataFrame, path: str | None = None, source: str | None = None) -> DataFrame:
    """(ym, address, complex, road, n): the stored counts if they are of this state, else counted now."""
    if path is not None:
        last = manifest(trades.sparkSession, path)
        if last is not None and last["source"] == source:
            return _stored_counts(trades.sparkSession, path)
    return trades.groupBy("ym", *COUNTED).agg(F.count("*").alias("n"))


def stored_lookup(spark: SparkSession, path: str, source: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """A lookup that is made of a whole table, stored once for each state of its source.

    Each state is written to a folder of its own and then named by the manifest's next row, so that a
    reader sees the old lookup or the new one, and never half of one.
    """
    last = manifest(spark, path)
    if last is None or last["source"] != source:
        data = f"{path}/version-{1 if last is None else last['version'] + 1}"
        compute().write.mode("overwrite").parquet(data)
        _note(spark.read.parquet(data).agg(F.count("*").alias("trades")), path, source, data, None)
        last = manifest(spark, path)
    return spark.read.parquet(last["path"])
