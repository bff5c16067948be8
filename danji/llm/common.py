"""What several operators share: reading tables, cutting lineage, connected components."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts, [\x20\x09-\x0D].
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a checkpoint in the folder all executors share.

    The folder is the session's spark.checkpoint.dir. Where it is unset, a local master gets a
    temporary folder and any other master gets an error.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="danji-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared file system that this program has written and needs no more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def forget(checkpointed: DataFrame) -> None:
    """Delete the files of what cut() gave, once nothing is computed from it any more."""
    file = checkpointed._jdf.logicalPlan().rdd().getCheckpointFile()
    if file.isDefined():
        remove(checkpointed.sparkSession, file.get())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without_spaces(text: Column) -> Column:
    """The text without [\\x20\\x09-\\x0D]; byte searches, cheaper than a regular expression."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Bits of a filter: it is broadcast as at most 8 MB.
FILTER_BITS = 1 << 26
#: A key is hot that has more than this part of all rows; there are fewer hot keys than that.
HOT_PART = 4096


def marks(rows: DataFrame, *keys: str) -> DataFrame:
    """A bitmap of FILTER_BITS with a bit for the hash of each row's keys: one row per 32,768 bits with a mark."""
    bit = rows.select((F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS)) + 1).alias("bit"))
    return bit.groupBy(F.bitmap_bucket_number("bit").alias("mark_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("mark_bits")
    )


def with_mark(rows: DataFrame, marked: DataFrame, *keys: Column, name: str = "marked") -> DataFrame:
    """rows and whether their keys' bit is set: always for keys that were marked, seldom for others."""
    bit = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS)) + 1
    place = F.bitmap_bit_position(bit)
    octet = F.conv(F.hex(F.substring(marked["mark_bits"], (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(octet.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0, F.lit(False))
    joined = rows.join(F.broadcast(marked), F.bitmap_bucket_number(bit) == marked["mark_bucket"], "left")
    return joined.select(*[rows[c] for c in rows.columns], is_set.alias(name))


def hot_left_join(rows: DataFrame, table: DataFrame, keys: list[str], n: str) -> DataFrame:
    """rows left-joined with table, whose keys are unique and whose column n says how many rows bear them.

    Keys with more than 1 / HOT_PART of all those rows are looked up in a broadcast table of fewer
    than HOT_PART rows, so that their rows stay where they are; the others are joined by a shuffle.
    """
    total = table.agg(F.sum(n)).first()[0] or 0
    hot = F.col(n) * HOT_PART > total
    added = [c for c in table.columns if c not in keys]
    first = rows.join(F.broadcast(table.where(hot).withColumn("is_hot", F.lit(True))), keys, "left")
    rest = first.where("is_hot is null").drop("is_hot", *added).join(table.where(~hot), keys, "left")
    return first.where("is_hot").drop("is_hot").unionByName(rest)


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of each node with an edge, root the smallest node of its component.

    edges: columns a and b, bigint, any order, repeats allowed; null ends are left out.
    Alternating large and small stars (Kiveris and others, 2014): every step is a grouped minimum,
    which is combined on the map side, and an equi-join that AQE can split at a hub. The number of
    edges never grows, and a round's edges are written to the checkpoint folder, from which those of the
    round before are deleted.
    """
    work = cut(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = None
    for _ in range(most_rounds):
        both = work.unionAll(work.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct()
        )
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        past = work
        work = cut(
            large.join(least, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b").distinct()
        )
        now = work.agg(F.count("*"), F.sum(F.hash("a", "b").cast("bigint")), F.sum(F.hash("b").cast("bigint"))).first()
        forget(past)
        if now == state:
            return work.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                work.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = now
    raise RuntimeError(f"components not settled after {most_rounds} rounds")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for an application, so that tasks can import it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="danji-code-")) / "danji_llm.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in [root / "__init__.py", *sorted((root / "llm").glob("*.py"))]:
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()
