"""A table of complex names with postings of their letters, for searches that don't read the trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The longest piece of a name that has a posting.
LETTERS = 3
#: Folders of the postings; a search reads those of its pieces.
FOLDERS = 64


def _pieces(name: Column) -> Column:
    """The distinct pieces of one to three letters of a name."""
    starts = F.sequence(F.lit(1), F.length(name))
    pieces = [
        F.transform(F.filter(starts, lambda at: at + n - 1 <= F.length(name)), lambda at: F.substring(name, at, F.lit(n)))
        for n in range(1, LETTERS + 1)
    ]
    return F.array_distinct(F.concat(*pieces))


def _folder(piece: Column) -> Column:
    return F.pmod(F.crc32(piece.cast("binary")), F.lit(FOLDERS)).cast("int")


def write_names(trades: DataFrame, path: str) -> None:
    """Store the distinct (address, complex, area) of trades, and the pieces of each distinct name.

    Names are made distinct before they are cut, and a piece is written once for each name it
    stands in, so the postings grow with the names and not with the trades.
    """
    places = trades.select("address", "complex", "area_m2").distinct()
    places.write.mode("overwrite").parquet(f"{path}/places")
    names = trades.sparkSession.read.parquet(f"{path}/places").select("complex").filter("complex <> ''").distinct()
    postings = names.select(F.explode(_pieces(F.col("complex"))).alias("piece"), "complex").withColumn("folder", _folder(F.col("piece")))
    # Rows of a folder are dealt by name too: a piece that every name has fills no single task.
    postings.hint("rebalance", "folder", "complex").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/postings")


def search_names(spark: SparkSession, path: str, text: str) -> DataFrame:
    """Distinct (address, complex, area) whose complex name contains the text, in no order.

    A name that contains the text has all its pieces; names that have them are verified. Only the
    folders of these pieces are read, then the places of the names that were found. The empty text
    is in every name.
    """
    places = spark.read.parquet(f"{path}/places").filter(F.col("complex").contains(text))
    if not text:
        return places
    size = min(LETTERS, len(text))
    pieces = sorted({text[at : at + size] for at in range(len(text) - size + 1)})
    folders = [r[0] for r in spark.createDataFrame([(p,) for p in pieces], "piece string").select(_folder(F.col("piece"))).distinct().collect()]
    postings = spark.read.parquet(f"{path}/postings").filter(F.col("folder").isin(folders) & F.col("piece").isin(pieces))
    found = postings.groupBy("complex").agg(F.count("*").alias("n")).filter(
        (F.col("n") == len(pieces)) & F.col("complex").contains(text)
    )
    return places.join(found.select("complex"), "complex", "left_semi").select("address", "complex", "area_m2")
