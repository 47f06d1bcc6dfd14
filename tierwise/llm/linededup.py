"""Line dedup by winnowing over line hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import LINE_SPACE, SPACE, text_keys
from tierwise.operators.lookup import lookup
from tierwise.runtime import durable

MIN_RUN = 3
MIN_WORDS = 50


def line_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_run: int = MIN_RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per window of non-blank lines: from each line on, ``min_run`` lines or, if fewer reach them, ``min_words`` words.

    A text that reaches neither has one window of all its lines. ``low`` is the smallest line hash
    of the window and ``at`` the line that has it: the fingerprint that any equal run of lines
    selects too. ``run`` holds two hashes of the window, by two hashes of each line.
    """
    solid = F.filter(
        F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(LINE_SPACE))),
        lambda x: x != "",
    )
    hashes = F.transform(
        solid,
        lambda x: F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.lit("second"), x).alias("g"), F.size(F.split(x, SPACE)).alias("n")),
    )
    rows = docs.select(
        F.col(doc_id).alias("doc"), *[k.alias(n) for k, n in zip(text_keys(F.col(text)), ("key1", "key2"))], hashes.alias("lines")
    ).where(F.size("lines") > 0)

    def size(s):
        # Lines of a window: each start of it that has too few words asks for one more.
        few = [F.aggregate(F.slice("lines.n", s + 1, k), F.lit(0), lambda x, y: x + y) < min_words for k in range(1, min_run)]
        return sum((f.cast("int") for f in few), F.lit(1))

    def window(w):
        first, second = F.slice("lines.h", w["s"] + 1, w["n"]), F.slice("lines.g", w["s"] + 1, w["n"])
        low = F.array_min(first)
        return F.struct(
            w["s"].alias("start"),
            w["n"].alias("size"),
            F.struct(F.xxhash64(first).alias("run1"), F.xxhash64(second).alias("run2")).alias("run"),
            low.alias("low"),
            (w["s"] + F.array_position(first, low) - 1).alias("at"),
        )

    starts = F.transform(F.sequence(F.lit(0), F.size("lines") - 1), lambda s: F.struct(s.alias("s"), size(s).alias("n")))
    whole = F.filter(starts, lambda w: (w["s"] == 0) | (w["s"] + w["n"] <= F.size("lines")))
    return rows.select("doc", "key1", "key2", F.inline(F.transform(whole, window)))


def repeated_windows(windows: DataFrame) -> DataFrame:
    """Windows that stand earlier too, by (doc, position).

    A fingerprint seen at one place only cannot lie in a repeated run, so just the windows
    of the other fingerprints are matched. Each is compared with the first window of equal
    content, never with all others; overlapping windows together are the run, extended both ways.
    """
    place = F.struct("doc", "key1", "key2", "at")
    shared = durable(
        windows.groupBy("low")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("n"))
        .where(~F.col("first").eqNullSafe(F.col("last")))
        .select("low", "n", F.lit(True).alias("shared")),
        "shared-lines",
    )
    # A line or run of very many windows is spread over tasks.
    candidates = lookup(windows, shared, "low", "n").where("shared").drop("shared")
    spot = F.struct("doc", "key1", "key2", "start")
    first = durable(
        candidates.groupBy("run")
        .agg(F.min(spot).alias("first"), F.max(spot).alias("last"), F.count("*").alias("n"))
        .where(~F.col("first").eqNullSafe(F.col("last")))
        .select("run", "n", "first"),
        "first-runs",
    )
    return (
        lookup(candidates, first, "run", "n", counted=windows)
        .where(F.col("first").isNotNull() & ~spot.eqNullSafe(F.col("first")))
        .select("doc", "key1", "key2", "start", "size")
    )


def drop_repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_run: int = MIN_RUN, min_words: int = MIN_WORDS
) -> DataFrame:
    """``docs`` with ``text`` freed of lines that lie in a run of lines seen earlier.

    A run is at least ``min_run`` non-blank lines, or fewer that hold at least ``min_words`` words (for a
    text that has neither: the whole text), compared without outer spaces; earlier is by doc_id, then text, then line. Blank lines stay. Adds a
    struct ``line_dedup`` (n_lines non-blank, n_removed). Rows equal in doc_id and text count as one
    document and are treated alike; null texts stay null. All other columns pass through, but for one named ``line_dedup``.
    """
    docs = docs.drop("line_dedup")
    windows = durable(line_windows(docs, doc_id, text, min_run, min_words), "line-windows")
    gone = (
        repeated_windows(windows)
        .groupBy("doc", "key1", "key2")
        .agg(F.collect_set(F.struct("start", "size")).alias("starts"))
        .select(F.struct("doc", "key1", "key2").alias("__line_key"), F.col("starts").alias("__line_starts"))
    )
    keys = F.struct(F.col(doc_id).alias("doc"), *[k.alias(n) for k, n in zip(text_keys(F.col(text)), ("key1", "key2"))])
    plain = [F.col(f"`{c}`") for c in docs.columns]
    joined = docs.select(*plain, keys.alias("__key")).join(gone, F.col("__key").eqNullSafe(F.col("__line_key")), "left")
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    blank = lambda x: F.btrim(x, F.lit(LINE_SPACE)) == ""
    parted = joined.withColumn("__lines", lines).withColumn(
        "__solid",
        F.transform(
            F.filter(F.transform("__lines", lambda x, i: F.struct(blank(x).alias("b"), i.alias("i"))), lambda x: ~x["b"]),
            lambda x: x["i"],
        ),
    )
    cut = parted.withColumn(
        "__cut",
        F.when(
            F.col("__line_starts").isNotNull(),
            F.array_distinct(F.flatten(F.transform("__line_starts", lambda s: F.slice("__solid", s["start"] + 1, s["size"])))),
        ),
    )
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__cut")
    shorter = F.array_join(F.transform(left, lambda i: F.get("__lines", i)), "\n")
    found = F.struct(
        F.when(F.col("__cut").isNull(), F.col(text)).otherwise(shorter).alias("__text"),
        F.struct(
            F.size("__solid").cast("long").alias("n_lines"),
            F.when(F.col("__cut").isNull(), 0).otherwise(F.size("__cut")).cast("long").alias("n_removed"),
        ).alias("line_dedup"),
    )
    # A generated row: filters on it are not pushed below, where the lines would be worked out again.
    return cut.select(*plain, F.inline(F.array(found))).select(
        *[F.col("__text").alias(n) if n == text else c for n, c in zip(docs.columns, plain)], "line_dedup"
    )
