"""Registered queries of the operators, and their SQL where SQL can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from danji.llm.common import table
from danji.llm.exact_dedup import exact_duplicates
from danji.llm.host_reputation import Rule, judge_urls
from danji.llm.jaccard_join import similar_components
from danji.llm.kmeans_tree import nearest
from danji.llm.mixing import mixture
from danji.llm.packing import pack
from danji.llm.periodic_runs import periodic_runs, repeated_tails
from danji.llm.prefix_trie import coded_turns, rebuilt, sequences, trie
from danji.llm.secret_scan import secret_spans
from danji.llm.spot_signatures import compared_in_order
from danji.llm.sql import ORACLE
from danji.llm.surrogates import replace_entities
from danji.llm.token_counts import token_counts
from danji.llm.toxic_crf import learn, toxicity

MIX_WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 5, "fr": 2, "de": 2, "es": 1}}
MIX_EPOCHS = 4
MIX_SEED = 17

SURROGATE_KEY = "danji-surrogates"
RULES = [
    Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"),
    Rule("block", "net/es/"), Rule("block", "net/fr/"),
]
MOST_BAD = 0.25
END_ID, SEQUENCE = 2, 4096
TOKEN_LIMIT = 4096


def mix_levels() -> dict[str, Column]:
    """The tree of the mixture; a source's domain is its number modulo 4."""
    number = F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int")
    domain = F.concat(F.lit("d"), F.coalesce(number % 4, F.lit(0)).cast("string"))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def bytes_tokens() -> Column:
    """Four bytes a token, rounded up: the budget's measure where no tokenizer runs."""
    return F.expr("(octet_length(coalesce(text, '')) + 3) div 4")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"), mix_levels(), MIX_WEIGHTS, bytes_tokens(), max_epochs=MIX_EPOCHS, seed=MIX_SEED)


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents"), SURROGATE_KEY)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_ID, SEQUENCE)


def op5_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id"), F.expr("int(toxic = 1 or quality = 0)").alias("bad")
    )
    return judge_urls(table(spark, sf_dir, "pages"), labels, RULES, MOST_BAD)


def op6_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), TOKEN_LIMIT)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are not learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def op9_toxic_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    field = learn(docs, labels.where(~held_out(F.col("doc_id"))))
    scored = toxicity(docs, field)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "spans")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(table(spark, sf_dir, "documents"), width=3, percent=90)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = sequences(coded_turns(table(spark, sf_dir, "conversations")))
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    return trie(rebuilt(own, head, F.col("conv_id") - F.col("conv_id") % 20, 3))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(repeated_tails(table(spark, sf_dir, "documents")))
    # The greatest length, then the smallest start, then the smallest period.
    longest = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.expr("-best.start").alias("start"), F.col("best.length").alias("length"),
        F.expr("-best.period").alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared_in_order(table(spark, sf_dir, "documents"))


#: SQL of the queries whose results SQL can express.
ORACLE_SQL = ORACLE

QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing, op2_surrogates, op3_exact_dedup, op4_packing, op5_host_reputation, op6_kmeans_tree,
        op7_secret_scan, op8_token_counts, op9_toxic_crf, op10_jaccard_join,
        op11_prefix_trie, op12_periodic_runs, op13_spot_signatures,
    )
}
