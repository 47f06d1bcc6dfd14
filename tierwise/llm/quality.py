"""Quality rules: word statistics of one text, and line frequency across documents of one host."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import text_keys, words
from tierwise.operators.lookup import BROADCAST_ROWS
from tierwise.runtime import durable

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
MIN_DOCUMENTS = 20
MAX_SHARE = 0.02
MAX_REMOVED_PERCENT = 70


def measures(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", carry: str | None = None
) -> DataFrame:
    """One row per document: its keys and what its own words and lines show.

    A null text has no words. ``n_dup_lines`` counts lines with a word that equal an
    earlier line; ``n_repeat_words`` the words inside any window of five words that
    stands in the text twice or more. Columns other than the three named are ignored, or
    kept together as the struct ``carry``.
    """
    kept = [carry] if carry else []
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(carry)] if carry else []
    rows = docs.select(
        *whole,
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(host), F.lit("")).alias("host"),
        *[k.alias(n) for k, n in zip(text_keys(F.col(text)), ("key1", "key2"))],
        F.coalesce(F.col(text), F.lit("")).alias("body"),
        words(F.col(text)).alias("w"),
    )
    held = rows.select(
        *kept,
        "doc_id",
        "host",
        "key1",
        "key2",
        F.size("w").cast("long").alias("n_words"),
        F.array_join("w", "").alias("solid"),
        F.filter(F.split("body", "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("lines"),
        F.when(F.size("w") < WINDOW, F.array().cast("array<bigint>"))
        .otherwise(F.transform(F.sequence(F.lit(1), F.size("w") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("w", i, WINDOW))))
        .alias("grams"),
    )
    # Only texts that repeat a window are sorted: equal windows become neighbours.
    ordered = held.withColumn(
        "pairs",
        F.when(
            F.size(F.array_distinct("grams")) < F.size("grams"),
            F.array_sort(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
        ),
    )

    def repeated(x, i):
        before = (i > 0) & (F.get("pairs", i - 1)["g"] == x["g"])
        after = (i + 1 < F.size("pairs")) & (F.get("pairs", i + 1)["g"] == x["g"])
        return before | after

    starts = ordered.withColumn("starts", F.array_sort(F.transform(F.filter("pairs", repeated), lambda x: x["i"])))
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, s: F.struct((a["n"] + F.least(F.lit(WINDOW), s - a["last"])).alias("n"), s.alias("last")),
        lambda a: a["n"],
    )
    found = F.struct(
        "n_words",
        F.length("solid").cast("long").alias("word_chars"),
        (F.length("solid") - F.length(F.translate("solid", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    # A generated row: filters on the measures are not pushed below it, where they would be worked out again.
    return starts.select(*kept, "doc_id", "host", "key1", "key2", F.inline(F.array(found)))


def depleted(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    max_share: float = MAX_SHARE,
    max_removed_percent: int = MAX_REMOVED_PERCENT,
) -> DataFrame:
    """(host, key1, key2) of texts that lose most of their words with the host's frequent lines.

    Lines are lower-cased, inner spaces collapsed. A line is removed on a host when more
    than ``min_documents`` and more than ``max_share`` of the host's different texts carry
    it; the first text (smallest doc_id) that carries it keeps it, so that something of
    each group of copies stays. Exact copies count once and share one verdict. A text is
    depleted when over ``max_removed_percent`` of its words go. Null hosts are one host.
    """
    clean = F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), "[ \\t\\x0b\\f\\r]+", " ")
    lines = F.filter(F.transform(F.split(clean, "\n"), F.trim), lambda x: x != "")
    entries = F.transform(
        lines,
        lambda x: F.struct(
            F.xxhash64(x).alias("line"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("n")
        ),
    )
    each = docs.select(
        F.col(doc_id).alias("doc"),
        F.coalesce(F.col(host), F.lit("")).alias("host"),
        *[k.alias(n) for k, n in zip(text_keys(F.col(text)), ("key1", "key2"))],
        F.explode(entries).alias("e"),
    )
    # One row per line and different text; a hot line is spread by the texts that carry it.
    held = each.groupBy("host", "key1", "key2", F.col("e.line").alias("line")).agg(
        F.min("doc").alias("doc"), F.sum("e.n").alias("n")
    )
    texts = held.groupBy("host", "key1", "key2").agg(F.sum("n").alias("total"))
    hosts = texts.groupBy("host").agg(F.count("*").alias("texts"))
    frequent = (
        held.groupBy("host", "line")
        .agg(F.count("*").alias("carriers"), F.min(F.struct("doc", "key1", "key2")).alias("owner"))
        .where(F.col("carriers") > min_documents)
        .join(hosts, "host")
        .where(F.col("carriers") > max_share * F.col("texts"))
        .select("host", "line", "owner")
    )
    lost = (
        held.join(frequent, ["host", "line"])
        .where((F.col("key1") != F.col("owner.key1")) | (F.col("key2") != F.col("owner.key2")))
        .groupBy("host", "key1", "key2")
        .agg(F.sum("n").alias("lost"))
    )
    return (
        lost.join(texts, ["host", "key1", "key2"])
        .where(100 * F.col("lost") > max_removed_percent * F.col("total"))
        .select("host", "key1", "key2")
    )


BASE_FAILED = f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words"
KEYS = ["host", "key1", "key2"]


def without(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose keys are not in the stored table ``gone``, which is shipped only if it is small."""
    return rows.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, keys, "left_anti")


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", **limits) -> DataFrame:
    """Measures and verdict, one row per document.

    ``base_failed``: fewer than ten words, or over a fifth of them in repeated windows.
    ``kept``: not base_failed and not depleted. An empty table gives no rows.
    """
    gone = depleted(docs, doc_id, text, host, **limits).withColumn("gone", F.lit(True))
    return (
        measures(docs, doc_id, text, host)
        .withColumn("base_failed", F.expr(BASE_FAILED))
        .join(gone, KEYS, "left")
        .withColumn("kept", ~F.col("base_failed") & F.col("gone").isNull())
        .drop("gone")
    )


def keep_good(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", **limits) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns."""
    gone = durable(depleted(docs, doc_id, text, host, **limits), "depleted")
    passed = measures(docs, doc_id, text, host, carry="__doc").where(f"not ({BASE_FAILED})")
    return without(passed, gone, KEYS).select("__doc.*")
