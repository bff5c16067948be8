"""Exact duplicates by progressive refinement: length, then a hash of the start, then a full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from danji.llm.common import cut, hot_left_join, marks, with_mark, without_spaces

PREFIX = 256
START = ["bare_length", "start_hash"]


def _scan(docs: DataFrame, id_col: str, text_col: str, digest: Column) -> DataFrame:
    """row (a number of its own), doc_id, points, bare_length, start_hash and the digest; no text."""
    text = F.coalesce(docs[text_col], F.lit(""))
    out = docs.select(docs[id_col].alias("doc_id"), F.length(text).alias("points"), without_spaces(text).alias("bare"))
    return out.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "points",
        F.length("bare").alias("bare_length"),
        F.xxhash64(F.substring("bare", 1, PREFIX)).alias("start_hash"),
        digest.alias("text_sha256"),
    )


def _shared_starts(scanned: DataFrame) -> DataFrame:
    """A bitmap of the (length, start) that several rows have, looked for where several have the length."""
    lengths = scanned.groupBy("bare_length").agg(F.count("*").alias("n")).where("n > 1")
    of_length = with_mark(scanned, marks(lengths, "bare_length"), scanned["bare_length"]).where("marked")
    return marks(of_length.groupBy(*START).agg(F.count("*").alias("n")).where("n > 1"), *START)


def _hashed(docs: DataFrame, id_col: str, text_col: str, starts: DataFrame) -> DataFrame:
    """The rows that share their (length, start), with their digests; no other text is hashed in full."""
    text = F.coalesce(docs[text_col], F.lit(""))
    bare = without_spaces(text)
    keys = docs.select(
        docs[id_col].alias("doc_id"), F.length(text).alias("points"), F.length(bare).alias("bare_length"),
        F.xxhash64(F.substring(bare, 1, PREFIX)).alias("start_hash"), text.alias("whole"),
    )
    shared = with_mark(keys, starts, keys["bare_length"], keys["start_hash"]).where("marked")
    return shared.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "points", *START,
        F.sha2(without_spaces(F.col("whole")), 256).alias("text_sha256"),
    )


def _groups(full: DataFrame) -> DataFrame:
    """bare_length, text_sha256, group_size, keep_points, keep_id, keep_row of the texts that several rows have."""
    # Most code points, then the smallest id, null last, then any one row.
    best = F.min(F.struct((-F.col("points")).alias("minus"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    return (
        full.groupBy("bare_length", "text_sha256").agg(F.count("*").alias("group_size"), best.alias("best"))
        .where("group_size > 1")
        .selectExpr(
            "bare_length", "text_sha256", "group_size", "-best.minus as keep_points", "best.doc_id as keep_id", "best.row as keep_row"
        )
    )


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False
) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without [\\x20\\x09-\\x0D]. Of equal texts one row is kept: the
    most code points, then the smallest id, null last; of rows that repeat these any one.

    The refinement: rows whose length without spaces is unique are done; of the rest, rows whose
    (length, hash of the first 256 characters) is unique are done; only what is left is read in
    full and hashed by SHA-256. With digest_all every row shall carry its digest, so the digest is
    taken in the first scan; otherwise text_sha256 is null for rows that an earlier step settles,
    and a second scan hashes the surviving rows only (and a few that a filter of 8 MB can't tell
    from them).

    Which lengths and starts are shared is known from aggregates that are combined on the map side,
    and goes back to the rows as a broadcast bitmap: rows aren't shuffled for it, hot lengths are no
    matter. Groups of equal texts are joined back to the keys, hot ones by broadcast. A null text
    counts as empty, empty texts form a group; ids of any type that can be ordered, null or repeated;
    other columns are not read; an empty table gives no rows.
    """
    bare_digest = F.sha2(F.col("bare"), 256) if digest_all else F.lit(None).cast("string")
    scanned = cut(_scan(docs, id_col, text_col, bare_digest))
    starts = cut(_shared_starts(scanned))
    if digest_all:
        full, every = with_mark(scanned, starts, *map(scanned.__getitem__, START)).where("marked"), scanned
    else:
        full = cut(_hashed(docs, id_col, text_col, starts))
        settled = with_mark(scanned, starts, *map(scanned.__getitem__, START)).where("not marked").drop("marked")
        every = settled.unionByName(full)
    groups = cut(_groups(full))
    return hot_left_join(every, groups, ["bare_length", "text_sha256"], "group_size").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.expr("group_size is null or row = keep_row").alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that another row of the same text replaces; all columns stay.

    One row of each group stays: most code points, then the smallest id, null last. A row is judged by
    its own text, so ids may be null or repeated; of rows that repeat id, points and text one stays, the
    first as JSON. Rows that share id and length with no dropped row pass by a bitmap, without being
    hashed or shuffled; only the others are hashed and joined. An empty table stays empty.
    """
    starts = cut(_shared_starts(cut(_scan(docs, id_col, text_col, F.lit(None).cast("string")))))
    full = cut(_hashed(docs, id_col, text_col, starts))
    copies = full.groupBy("doc_id", "points", *START, "text_sha256").agg(F.count("*").alias("rows"))
    best = F.expr("points = keep_points and doc_id <=> keep_id")
    judged = cut(
        copies.join(_groups(full), ["bare_length", "text_sha256"]).where(~best | (F.col("rows") > 1))
        .select("doc_id", "points", *START, "text_sha256", best.alias("best"))
    )
    # The id and the length as written tell nearly all dropped rows from the others; the texts decide.
    keys = {"doc_id": docs[id_col], "points": F.length(F.coalesce(docs[text_col], F.lit("")))}
    row = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)])
    rows = docs.select(row.alias("row"), *[c.alias(n) for n, c in keys.items()])
    rows = with_mark(rows, marks(judged, *keys), *map(rows.__getitem__, keys))
    suspects = rows.where("marked").withColumn(
        "text_sha256", F.sha2(without_spaces(F.coalesce(F.col(f"row.c{docs.columns.index(text_col)}"), F.lit(""))), 256)
    )

    def same(judged: DataFrame) -> Column:
        return (
            suspects["doc_id"].eqNullSafe(judged["doc_id"]) & (suspects["points"] == judged["points"])
            & (suspects["text_sha256"] == judged["text_sha256"])
        )

    left = rows.where("not marked").select("row").unionAll(suspects.join(judged, same(judged), "left_anti").select("row"))
    repeated = judged.where("best")
    if not repeated.isEmpty():
        one = (
            suspects.join(repeated, same(repeated), "left_semi")
            .groupBy("doc_id", "points", "text_sha256").agg(F.min_by("row", F.to_json("row")).alias("row"))
        )
        left = left.unionAll(one.select("row"))
    return left.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
