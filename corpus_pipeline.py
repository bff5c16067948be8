"""The corpus pipeline: documents in, packed sequences out, each stage one operator of danji.llm."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from danji.llm.common import cut, remove, table
from danji.llm.exact_dedup import drop_exact_duplicates
from danji.llm.jaccard_join import drop_similar
from danji.llm.mixing import mixture
from danji.llm.packing import pack
from danji.llm.queries import END_ID, MIX_SEED, MIX_WEIGHTS, SEQUENCE, bytes_tokens, held_out, mix_levels
from danji.llm.toxic_crf import learn, toxicity

#: The mixture of the pipeline: four fifths of the tokens left, a document twice at most.
KEPT_TOKENS = (4, 5)
EPOCHS = 2


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field, learnt from the labels, doesn't reject; each row by its own text."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    field = learn(table(spark, sf_dir, "documents"), labels)
    # The rest of the row goes as the id, so that null and repeated ids are no matter; the text goes once.
    rest = [docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"]
    row = F.struct(*rest, docs["text"].isNull().alias("no_text"))
    judged = toxicity(docs.select(row.alias("row"), docs["text"]), field, "row", with_text=True).where("predicted = 0")
    text = F.when(~F.col("doc_id.no_text"), F.col("text"))
    return judged.select(*[(text if c == "text" else F.col(f"doc_id.c{i}")).alias(c) for i, c in enumerate(docs.columns)])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest as written, then the smallest id."""
    return drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each component of links: five-word shingles, 0.8 or more."""
    return drop_similar(docs, width=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them; one that the last prefix ends in is taken whole.

    A row is its id and a hash of all its columns, so null and repeated ids are no matter; rows that
    are the same throughout come out as often as they are taken together. An empty table stays empty.
    """
    key = F.struct(docs["doc_id"].alias("id"), F.xxhash64(*[docs[c] for c in docs.columns]).alias("hash"))
    drawn = mixture(
        docs.select(key.alias("doc_id"), docs["lang"], docs["source"], docs["text"]),
        mix_levels(), MIX_WEIGHTS, bytes_tokens(), fraction=KEPT_TOKENS, max_epochs=EPOCHS, seed=MIX_SEED,
    )
    taken = cut(
        drawn.groupBy(F.col("doc_id").alias("key"))
        .agg(F.sum(F.expr("epochs + if(tail_tokens > 0, 1, 0)")).alias("times"), F.count("*").alias("rows")).where("times > 0")
    )
    row = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)])
    rows = docs.select(row.alias("row"), key.alias("key"))
    same = rows["key"]["id"].eqNullSafe(taken["key"]["id"]) & (rows["key"]["hash"] == taken["key"]["hash"])
    joined = rows.join(taken, same).select(rows["row"], rows["key"], "times", "rows")
    one = joined.where("rows > 1").groupBy("key").agg(F.first("row").alias("row"), F.max("times").alias("times"))
    times = F.sequence(F.lit(1).cast("bigint"), F.col("times"))
    out = joined.where("rows = 1").select("row", F.explode(times).alias("time"))
    if not taken.where("rows > 1").isEmpty():
        out = out.unionAll(one.select("row", F.explode(times).alias("time")))
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 4096 tokens; every row is packed, empty ones as an end sign."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, SEQUENCE)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix),
    ("packing", pack_documents),
]

#: A learnt field and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each result written to the shared folder and read again; the last one stays."""
    cut(spark.range(1))  # sets the folder where the session has none
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4()}"
    docs, past = table(spark, sf_dir, "documents"), None
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if past:
            remove(spark, past)
        past = path
    return docs
