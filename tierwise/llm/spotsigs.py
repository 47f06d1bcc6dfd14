"""SpotSigs fingerprints: chains of content words that follow common words."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwise.operators.lookup import BROADCAST_ROWS, HOT_SHARE, lookup
from tierwise.runtime import durable

CHAIN = 3
SLICES = 128
ROWS = 1000
SIMILAR = 0.8

# Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to a in is that it for was on with as be by this at are from "
    "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es "
    "de la le et les des en un du une que est pour qui dans par pas sur au "
    "que el y los se del las por con no una su para lo"
).split()


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """Sorted distinct 32-bit hashes of a text's spot signatures; null and wordless texts have none.

    Words are runs of letters and digits, lower-cased. Each common word, and the start of the
    text, is followed by a signature: its next ``chain`` words that aren't common (fewer at the end).
    """
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    marked = F.array_join(
        F.transform(F.split(plain, " "), lambda w: F.when(w.isin(sorted(set(ANCHORS))), F.lit("#")).otherwise(w)), " "
    )
    chains = F.regexp_extract_all(
        F.concat(F.lit("# "), marked, F.lit(" ")), F.lit(rf"#(?= ((?:(?:# )*+[^ #]+ ){{1,{chain}}}))"), F.lit(1)
    )
    hashes = F.transform(chains, lambda c: F.shiftright(F.xxhash64(F.replace(c, F.lit("# "), F.lit(""))), 32).cast("int"))
    return F.array_sort(F.array_distinct(hashes))


def spelled(signature_set: Column) -> Column:
    """The set as a string: eight hex digits for each signature, ascending, joined by one space."""
    return F.array_join(
        F.transform(signature_set, lambda h: F.lpad(F.lower(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), " "
    )


def likeness(a: Column, b: Column) -> Column:
    """Jaccard of two signature sets; two empty sets are alike, an empty and another set are not."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.greatest(F.size(a), F.size(b)) == 0, F.lit(1.0)).when(
        F.least(F.size(a), F.size(b)) == 0, F.lit(0.0)
    ).otherwise(both / (F.size(a) + F.size(b) - both))


def slices_of(docs: DataFrame, key: str) -> tuple[list, list[tuple]]:
    """Upper bounds of up to SLICES slices of ``key``, and (slice, least, most, rows) of each."""
    share = [i / SLICES for i in range(1, SLICES)]
    bounds = sorted(set(docs.agg(F.percentile_approx(key, share, 10000)).first()[0] or []))
    rows = docs.groupBy(slice_number(F.col(key), bounds).alias("s")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count("*").alias("n"))
    return bounds, sorted(tuple(r) for r in rows.collect())


def slice_number(key: Column, bounds: list) -> Column:
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < key))


def with_next(docs: DataFrame, doc_id: str, columns: list[str]) -> DataFrame:
    """``docs`` with ``next_<column>`` of the next row by (doc_id, text); after the last comes the first.

    Rows are dealt to buckets of about ROWS neighbours: slices between quantiles of doc_id, cut evenly
    inside. The next row is found in the bucket, to which the next bucket's first is added. Null doc_ids come first of all.
    """
    bounds, slices = slices_of(docs.select(doc_id), doc_id)
    number = F.col(doc_id)
    place = slice_number(number, bounds)
    start, width = F.lit(0), F.lit(1)
    for s, lo, hi, n in slices:
        if lo is not None:
            step = max(1, -(-(hi - lo + 1) // max(1, -(-n // ROWS))))
            start, width = F.when(F.col("__s") == s, F.lit(lo)).otherwise(start), F.when(F.col("__s") == s, F.lit(step)).otherwise(width)
    held = docs.withColumn("__s", F.when(number.isNull(), -1).otherwise(place)).withColumn(
        "__t", F.when(number.isNull(), F.lit(0)).otherwise(F.floor((number - start) / width)).cast("long")
    )
    numbers = docs.select(F.col(doc_id)).withColumn("__s", F.when(number.isNull(), -1).otherwise(place)).withColumn(
        "__t", F.when(number.isNull(), F.lit(0)).otherwise(F.floor((number - start) / width)).cast("long")
    )
    buckets = durable(numbers.groupBy("__s", "__t").agg(F.count("*").alias("n")), "buckets")
    # At most SLICES + 1 rows.
    firsts = sorted(tuple(r) for r in buckets.groupBy("__s").agg(F.min("__t")).collect())
    follow = F.lit(None).cast("struct<s:int,t:bigint>")
    for k, (s, _) in enumerate(firsts):
        s2, t2 = firsts[(k + 1) % len(firsts)]
        follow = F.when(F.col("__s") == s, F.struct(F.lit(s2).cast("int").alias("s"), F.lit(t2).cast("bigint").alias("t"))).otherwise(follow)
    inner = F.lead("__t").over(Window.partitionBy("__s").orderBy("__t"))
    after = buckets.select(
        "__s", "__t", F.when(inner.isNotNull(), F.struct(F.col("__s").cast("int").alias("s"), inner.alias("t"))).otherwise(follow).alias("__after")
    )
    near = Window.partitionBy("__s", "__t")
    plain = [F.col(c) for c in docs.columns]
    heads = held.withColumn("__at", F.row_number().over(near.orderBy(doc_id, "text"))).where("__at = 1")
    heads = heads.select(F.struct(F.col("__s").cast("int").alias("s"), F.col("__t").alias("t")).alias("__after"), *plain)
    # Each bucket gets the first row of the next as a guest, so that all rows are shuffled once.
    guests = after.join(heads, "__after").select(*plain, "__s", "__t", F.lit(1).alias("__guest"))
    full = held.select(*plain, "__s", "__t", F.lit(0).alias("__guest")).unionByName(guests)
    row = F.lead(F.struct(*columns)).over(near.orderBy("__guest", doc_id, "text"))
    return full.withColumn("__next", row).where("__guest = 0").select(*plain, *[F.col(f"__next.{c}").alias(f"next_{c}") for c in columns])


def edited_prints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each whole text and of its edited text, and how alike they are.

    The last floor(n_chars / 2) code points of a text give way to the first as many (or all) of the
    next document's, by doc_id. Null texts count as empty. Returns doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    marked = rows.withColumn("spots", signatures(F.col("text")))
    half = F.floor(F.length("text") / 2).cast("int")
    paired = with_next(marked, "doc_id", ["text", "spots"])
    changed = paired.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "spots",
        "next_spots",
        F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half)).alias("edited"),
    )
    signed = changed.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "spots", "next_spots", signatures(F.col("edited")).alias("edited_spots")
    )
    return signed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        spelled(F.col("spots")).alias("fingerprint"),
        spelled(F.col("edited_spots")).alias("edited_fingerprint"),
        likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
    )


def length_class(size: Column, similar: float) -> Column:
    """Partition of a set by its length: sets as alike as ``similar`` lie in the same or in neighbouring ones."""
    width = max(math.log(1 / similar), 0.01)
    return F.when(size == 0, F.lit(-2)).otherwise(F.floor(F.log(size.cast("double")) / width + 1e-9)).cast("int")


def near_documents(
    queries: DataFrame,
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similar: float = SIMILAR,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """(query_id, first_id, n_docs, likeness): all signature sets of ``docs`` at least ``similar`` to a query's.

    Texts with equal sets are one class, named by its smallest doc_id and its number of documents;
    a query meets its own class too. Exact: the signatures of a set are taken rarest first, and two sets as alike as
    ``similar`` (above 0) share one of the first n - ceil(similar * n) + 1. These meet within partitions of set length;
    pairs whose lengths rule them out are dropped before the sets are compared. Sets without signatures (null,
    empty, wordless texts) are alike with likeness 1 and unlike all others. Queries may be any rows, also such as
    ``docs`` lacks; rows repeated in id and text are one query. Other columns are ignored.
    """
    marked = lambda rows: rows.select(F.col(doc_id).alias("id"), signatures(F.col(text)).alias("spots"))
    named = lambda rows: rows.withColumn("set", F.struct(F.xxhash64("spots"), F.xxhash64(F.lit("second"), "spots")))
    sets = durable(
        named(marked(docs)).groupBy("set").agg(F.min("id").alias("first_id"), F.count("*").alias("n_docs"), F.first("spots").alias("spots")),
        "signature-sets",
    )
    asked = durable(named(marked(queries)).distinct(), "query-sets")
    wanted = asked.groupBy("set").agg(F.first("spots").alias("spots"))
    counts = durable(sets.select(F.explode("spots").alias("sig")).groupBy("sig").agg(F.count("*").alias("n")), "signature-counts")

    def prefixes(rows: DataFrame) -> DataFrame:
        """(set, size, sig): the rarest signatures of each set, as many as a partner must share one of."""
        each = rows.select("set", F.size("spots").alias("size"), F.explode("spots").alias("sig"))
        table = counts.select("sig", "n", F.col("n").alias("often"))
        found = lookup(each, table, "sig", "n", broadcast_rows=broadcast_rows, hot_share=hot_share)
        ranked = found.groupBy("set", "size").agg(
            F.array_sort(F.collect_list(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "sig"))).alias("rare")
        )
        need = (F.col("size") - F.ceil(similar * F.col("size") - 1e-9) + 1).cast("int")
        some = ranked.select("set", "size", F.explode(F.transform(F.slice("rare", 1, need), lambda r: r["sig"])).alias("sig"))
        none = rows.where(F.size("spots") == 0).select("set", F.lit(0).alias("size"), F.lit(0).alias("sig"))
        return some.unionByName(none)

    size = F.col("size")
    index = durable(prefixes(sets).withColumn("part", length_class(size, similar)), "signature-index")
    own = length_class(size, similar)
    asking = durable(
        prefixes(wanted).select(
            F.col("set").alias("asker"),
            size.alias("asker_size"),
            "sig",
            F.explode(F.when(size == 0, F.array(own)).otherwise(F.array(own - 1, own, own + 1))).alias("part"),
        ),
        "asked-signatures",
    )
    # A common signature's sets are spread over salted copies of its questions.
    rows = index.groupBy("sig", "part").agg(F.count("*").alias("held"))
    limit = max(1.0, index.count() / hot_share)
    hot = rows.where(F.col("held") > limit).select("sig", "part", F.ceil(F.col("held") / limit).cast("int").alias("copies"))
    # Fewer than hot_share rows.
    salt = lambda frame: frame.join(F.broadcast(hot), ["sig", "part"], "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    held = salt(index).withColumn("salt", F.pmod(F.xxhash64("set"), "copies").cast("int")).drop("copies")
    put = salt(asking).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    pairs = (
        put.join(held, ["sig", "part", "salt"])
        .where(F.least("size", "asker_size") >= similar * F.greatest("size", "asker_size") - 1e-9)
        .select("asker", "set")
        .distinct()
    )
    left = pairs.join(wanted.select(F.col("set").alias("asker"), F.col("spots").alias("asker_spots")), "asker")
    near = (
        left.join(sets, "set")
        .withColumn("likeness", likeness(F.col("asker_spots"), F.col("spots")))
        .where(F.col("likeness") >= similar)
        .select("asker", "first_id", "n_docs", "likeness")
    )
    return asked.select(F.col("id").alias("query_id"), F.col("set").alias("asker")).join(near, "asker").drop("asker")
