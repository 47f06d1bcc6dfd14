"""Documents to token ids: quality rules, line dedup, near-dedup, source mixing, SentencePiece."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm import linededup, mixing, pieces, quality, simhash
from tierwise.llm.common import text_keys
from tierwise.llm.queries import piece_model
from tierwise.runtime import durable


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others stay as they are, further columns too.

    Null texts count as empty and are rejected, as is every text of under ten words. Of equal
    lines the first text that carries them keeps them. An empty table gives none.
    """
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated lines go; a document of nothing but such lines goes with them.

    ``n_chars`` is counted anew where lines went; other columns stay. Null and empty texts have no
    lines and stay. Of repeated rows the first by id keeps its lines.
    """
    own = [c for c in docs.columns if c == "line_dedup"]
    cut = linededup.drop_repeated_lines(docs.withColumnsRenamed({c: f"__{c}" for c in own}))
    left = cut.where((F.col("line_dedup.n_removed") == 0) | (F.col("line_dedup.n_removed") < F.col("line_dedup.n_lines")))
    changed = F.col("line_dedup.n_removed") > 0
    return left.select(
        *[
            F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(t).alias(c) if c == "n_chars"
            else F.col(f"`__{c}`" if c in own else f"`{c}`").alias(c)
            for c, t in docs.dtypes
        ]
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: that of the smallest doc_id, null last, then by text hashes.

    A document is told by its id and its text, so rows without id, or of one id and different
    texts, are not taken for copies; of rows equal in both one stays. Texts without words are
    alike. Only rows that occur several times are shuffled to drop the others.
    """
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *[k.alias(f"k{i}") for i, k in enumerate(text_keys(F.col("text")))])
    keyed = docs.withColumn("__row", row)
    groups = simhash.near_duplicates(keyed.select("__row", "text"), doc_id="__row")
    kept = groups.where(F.col("doc_id") == F.col("component_id")).groupBy(F.col("doc_id").alias("__kept")).agg((F.count("*") > 1).alias("__often"))
    stay = keyed.join(kept, F.col("__row") == F.col("__kept"))
    once = stay.where(~F.col("__often")).unionByName(stay.where("__often").dropDuplicates(["__row"]))
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at the square root of their size; a document may come several times, or not at all.

    A null source is a source of its own. Draws follow the doc_id, so rows that share one get equal
    counts. An empty table gives none.
    """
    return mixing.mix(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, ids, n_tokens, decoded_sha256) of each row: whole texts, null as empty (the end id alone)."""
    coded = pieces.encode(docs.select("doc_id", "source", "text"), piece_model(), decoded="decoded")
    return coded.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode_pieces),
]

# Components of near copies need XXH64 and reachability. The operators are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
