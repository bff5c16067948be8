"""Tables read from Parquet, renamed to engine names; foreign layouts normalised."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from danji.functions import address as A, trade as Tr
from danji.schemas import source_schema, source_to_engine
from danji.session import shared_folder


def scan(
    spark: SparkSession, path: str, schema: T.StructType, names: dict[str, str]
) -> DataFrame:
    """Read Parquet with a fixed schema and rename its columns; nothing else is read."""
    return spark.read.schema(schema).parquet(path).select(
        *[F.col(f"`{src}`").alias(eng) for src, eng in names.items()]
    )


def scan_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table of danji.schemas by its source column names."""
    return scan(spark, path, source_schema(table), source_to_engine(table))


def table_or_fallback(
    spark: SparkSession, name: str, compute: Callable[[], DataFrame]
) -> DataFrame:
    """The catalog table if it exists, else the computed plan."""
    return spark.table(name) if spark.catalog.tableExists(name) else compute()


# Columns of the foreign layout.
FOREIGN_AREA = "전용면적(㎡)"
FOREIGN_PRICE = "거래금액(만원)"
FOREIGN_DEPOSIT = "보증금(만원)"


def is_foreign(df: DataFrame) -> bool:
    return FOREIGN_AREA in df.columns


def _amount(column: str) -> Column:
    """A comma text as a number; a text that is none is an error, never a missing price."""
    text = F.col(f"`{column}`")
    number = Tr.numeric_cast(F.replace(text, F.lit(","), F.lit("")), "bigint")
    unread = F.concat(F.lit(f"not an amount in {column}: "), text)
    return F.when(text.isNotNull() & number.isNull(), F.raise_error(unread)).otherwise(number).cast("bigint")


def _foreign_address() -> Column:
    emd = F.coalesce(F.col("`읍면동`"), F.lit(""))
    return F.concat(F.col("`시도`"), F.lit(" "), F.col("`시군구`"), F.lit(" "), emd)


def _renamed(df: DataFrame, *names: str) -> list[Column]:
    """Columns that both layouts share, in engine names."""
    engine = source_to_engine("sales") | source_to_engine("rents")
    return [F.col(f"`{n}`").alias(engine[n]) for n in names if n in df.columns]


def normalize_foreign_sales(df: DataFrame) -> DataFrame:
    """Sales in engine columns, from either layout."""
    rest = ["계약년월", "계약일", "층", "건축년도", "도로명", "해제사유발생일", "거래유형"]
    if not is_foreign(df):
        return df.select(*_renamed(df, *source_to_engine("sales")))
    return df.select(
        _foreign_address().alias("address"), *_renamed(df, "단지명"),
        F.col(f"`{FOREIGN_AREA}`").alias("area_m2"), _amount(FOREIGN_PRICE).alias("price"),
        *_renamed(df, *rest),
    )


def normalize_foreign_rents(df: DataFrame) -> DataFrame:
    """Rents in engine columns, from either layout."""
    rest = ["계약년월", "계약일", "층", "건축년도", "도로명"]
    if not is_foreign(df):
        return df.select(*_renamed(df, *source_to_engine("rents")))
    return df.select(
        _foreign_address().alias("address"), *_renamed(df, "단지명", "전월세구분"),
        F.col(f"`{FOREIGN_AREA}`").alias("area_m2"), _amount(FOREIGN_DEPOSIT).alias("deposit"),
        *_renamed(df, *rest),
    )


def scan_trades(spark: SparkSession, path: str) -> DataFrame:
    """What write_trades stored, with its region and year columns, by engine names."""
    return spark.read.parquet(path)


def write_trades(trades: DataFrame, path: str) -> None:
    """Store trades by province and contract year, so that those filters skip whole folders.

    Rows are shuffled by (province, year, month) to keep files few; AQE splits a month that is
    too large for one task.
    """
    derived = A.with_region_columns(trades).withColumn("contract_year", Tr.contract_year(F.col("ym")))
    (
        derived.hint("rebalance", "sido", "contract_year", "ym")
        .write.mode("overwrite").partitionBy("sido", "contract_year").parquet(path)
    )


# A bucket of more rows is avoided while there are fewer buckets than that; up to so many a shuffle writes
# rows to files as they come and keeps none in memory.
BUCKET_ROWS, MOST_BUCKETS = 250_000, 200
# A road key is dealt to several buckets if it has more rows than this, and more than this part of a bucket.
PART_ROWS, PART_OF_BUCKET = 50_000, 16


def write_bucketed(trades: DataFrame, table: str, path: str, key: str = "complex", buckets: int | None = None) -> None:
    """Store trades as the catalog's table `table` at `path`, in buckets sorted by `key`.

    `key` is complex, or road_key, which is added. Joins and groupings on it then read the trades
    where they lie: the other side is dealt to the buckets, the trades are not. So that Spark keeps to
    them there are as many buckets as shuffle partitions, or more for many trades (they are counted
    first), unless told otherwise; fewer are dealt anew. Rows are shuffled to their bucket before they
    are written, so a bucket is one file. A road key with many trades, or the trades without one, would
    make a large bucket: where there are such, a column `road_part` numbers the parts that each is dealt
    in, the buckets are of key and part, and join_coords joins by both. The trades of one complex stay
    in one bucket.
    """
    if key not in ("complex", "road_key"):
        raise ValueError(f"trades are stored by complex or road_key, not {key}")
    spark = trades.sparkSession
    derived = A.with_region_columns(A.with_road_key(trades)).withColumn("contract_year", Tr.contract_year(F.col("ym")))
    if key == "road_key":
        shared_folder(spark)
        counts = derived.groupBy(key).agg(F.count("*").alias("n")).checkpoint()
        rows = counts.agg(F.sum("n")).first()[0] or 0
    else:
        rows = 0 if buckets else derived.count()
    n = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(MOST_BUCKETS, ceil(rows / BUCKET_ROWS)))
    keys = [key]
    if key == "road_key":
        # Fewer than PART_OF_BUCKET large keys to a bucket.
        most = max(PART_ROWS, rows // (n * PART_OF_BUCKET))
        large = counts.filter(F.col("n") > most).select(
            F.col(key).alias("_large"), F.ceil(F.col("n") / most).cast("int").alias("_parts"))
        if not large.isEmpty():
            part = F.pmod(F.xxhash64(*derived.columns), F.col("_parts")).cast("int")
            derived = derived.join(F.broadcast(large), F.col(key).eqNullSafe(F.col("_large")), "left").withColumn(
                "road_part", F.coalesce(part, F.lit(0))).drop("_large", "_parts")
            keys.append("road_part")
    (
        derived.repartition(n, *keys).write.mode("overwrite").option("path", path)
        .bucketBy(n, *keys).sortBy(key).saveAsTable(table)
    )


def scan_bucketed(spark: SparkSession, table: str) -> DataFrame:
    """What write_bucketed stored, with its region columns, road key and maybe its part, by engine names."""
    return spark.table(table)
