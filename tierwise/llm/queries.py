"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm import divergence, edits, linededup, mixing, ngrams, passages, pieces, quality, ranked, rules, secrets, simhash, spotsigs
from tierwise.llm.common import documents


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_prints(documents(spark, sf_dir))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op3_backoff_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores rounded to 4 decimals: sums of logarithms depend on their order in the last digits."""
    return ngrams.scores(documents(spark, sf_dir)).withColumn("log_score", F.round("log_score", 4))


def sentencepiece_digests(docs: DataFrame) -> DataFrame:
    coded = pieces.encode(docs.select("doc_id", "text"), piece_model(), decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_digests(documents(spark, sf_dir))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", F.col("secret_spans").alias("all"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind):
        return F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("all", lambda s: s["kind"].isin(secrets.BASE))
    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("all")).alias("spans"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir)).drop("host", "key1", "key2")


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(documents(spark, sf_dir))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "text", "line_dedup.n_lines", "line_dedup.n_removed")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three edits to each document: a cut after a third, new words in the middle, a note at the end."""
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = documents(spark, sf_dir).select("doc_id", "text")
    n = F.length(F.coalesce("text", F.lit("")))
    third, half = F.floor(n / 3).cast("int"), F.floor(n / 2).cast("int")
    changes = F.array(
        F.struct(third.alias("start"), (third + 7).alias("end"), F.lit("").alias("new")),
        F.struct(half.alias("start"), (half + 5).alias("end"), F.substring(F.coalesce("text", F.lit("")), 1, 40).alias("new")),
        F.struct((n + 40).alias("start"), (n + 40).alias("end"), F.lit("\nRevised in 2024.").alias("new")),
    )
    trees = edits.build(docs, ranks, pattern).withColumn("n_before", F.col("n_tokens")).withColumn("edits", changes)
    after = edits.apply_edits(trees, ranks, pattern)
    return after.select(
        "doc_id",
        F.col("n_before").alias("n_tokens"),
        F.col("n_tokens").alias("n_tokens_edited"),
        "n_reencoded",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("edited_sha256"),
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(documents(spark, sf_dir))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.best_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_spotsigs,
        op2_mix_sources,
        op3_backoff_scores,
        op4_sentencepiece,
        op5_simhash,
        op6_secrets,
        op7_quality,
        op8_passages,
        op9_line_dedup,
        op10_token_counts,
        op11_source_divergence,
        op12_ranked_search,
        op13_quality_rules,
    )
}
