"""The watch-list: JSON entries of {address, complex, area}, an array or one a line."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from danji.schemas import engine_schema, source_schema, source_to_engine
from danji.session import shared_folder


def load_targets(spark: SparkSession, path: str, position: bool = False) -> DataFrame:
    """The list, or no rows when there is no file.

    A file holds one array document or one object per line; a folder may hold several files. Files of
    lines are split like any text, however large. Only a file with a line that begins with a bracket
    is a document, and only such files, whose paths the driver learns, are read as wholes. With
    `position` a column of that name tells the order in the file (of several files, by their names).
    """
    schema = source_schema("targets")
    names = source_to_engine("targets").items()

    def entries(rows: DataFrame, place: Column) -> DataFrame:
        out = [F.col(f"_entry.`{src}`").alias(eng) for src, eng in names]
        return rows.select(*out, *([place.alias("position")] if position else []))

    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], engine_schema("targets"))
        return rows.withColumn("position", F.lit(None).cast("string")) if position else rows
    file = F.col("_metadata.file_path")
    documents = [r[0] for r in lines.filter(F.ltrim("value").startswith("[")).select(file.alias("f")).distinct().collect()]
    # A line's place: its split's place in the file, then its place in the split.
    place = F.format_string("%s#%020d#%020d", file, "_metadata.file_block_start", F.monotonically_increasing_id())
    of_lines = lines.filter(~file.isin(documents)) if documents else lines
    single = entries(
        of_lines.filter(F.trim("value") != "").select(
            place.alias("_place"), F.from_json("value", schema, {"mode": "FAILFAST"}).alias("_entry")
        ),
        F.col("_place"),
    )
    if not documents:
        return single
    whole = spark.read.text([unquote(d) for d in documents], wholetext=True).select(
        file.alias("_file"), F.posexplode(F.from_json("value", T.ArrayType(schema), {"mode": "FAILFAST"})).alias("_at", "_entry")
    )
    return entries(whole, F.format_string("%s#%010d", "_file", "_at")).unionByName(single)


def write_targets(targets: DataFrame, path: str) -> None:
    """Replace the list at `path`, also one that `targets` was read from.

    The rows are checkpointed to the session's checkpoint folder first, since overwriting
    removes the files the plan would read.
    """
    shared_folder(targets.sparkSession)
    kept = targets.select(
        *[F.col(eng).alias(src) for src, eng in source_to_engine("targets").items()]
    ).checkpoint()
    kept.write.mode("overwrite").json(path)
