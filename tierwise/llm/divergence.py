"""How the words of each source differ from those of its language and of the other sources."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwise.llm.common import LETTERS, term_lists
from tierwise.operators.lookup import lookup
from tierwise.runtime import durable

LEAST_DOCS = 3
TOP = 200
SCALE = 1_000_000_000
# Distinct (group, term) entries a task holds before it hands them on.
HELD = 300_000


def term_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """(lang, source, term, count, docs): occurrences of each term and rows that hold it.

    Tasks add up in bounded tables first, so the shuffle carries partial sums, and a very common
    term or source reaches one reducer as a row per task at most.
    """

    def rows(table: dict) -> pa.RecordBatch:
        flat = [(lang, source, term, n, docs[term]) for (lang, source), (total, docs) in table.items() for term, n in total.items()]
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*flat), kinds)], ["lang", "source", "term", "count", "docs"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i) for i in range(3))):
                total, within = table.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
                before = len(total)
                seen: set[bytes] = set()
                for terms in term_lists(text.as_py(), LETTERS):
                    total.update(terms)
                    seen.update(terms)
                within.update(seen)
                size += len(total) - before
                if size >= held:
                    yield rows(table)
                    table, size = {}, 0
        if size:
            yield rows(table)

    partial = docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "lang string, source string, term binary, count bigint, docs bigint"
    )
    return partial.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs")
    )


def whole(a: Column, b: Column) -> Column:
    """Quotient of two whole numbers that aren't negative, rounded down."""
    return F.call_function("div", a, b)


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), in decimals, which don't overflow."""
    wide = "decimal(19,0)"
    return whole((count + 1).cast(wide) * F.lit(SCALE).cast("decimal(10,0)"), F.greatest(total + terms, F.lit(1)).cast(wide)).cast("long") + 1


def excess(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares stay below 2^30, so the square is exact."""
    return whole((p - q) * (p - q), q)


def term_part(entries: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """Terms a source uses more than its language, ranked through cells of equal counts."""
    cells = entries.groupBy("lang", "source", "count", "lang_count").agg(F.count("*").alias("terms"))
    cells = lookup(cells.withColumn("group", F.struct("lang", "source")), groups, "group", "docs")
    p, q = share(F.col("count"), F.col("total"), F.col("kept")), share(F.col("lang_count"), F.col("lang_total"), F.col("kept"))
    cells = durable(
        cells.select("lang", "source", "count", "lang_count", "terms", p.alias("p"), q.alias("q"))
        .where(F.col("p") > F.col("q"))
        .select("lang", "source", "count", "lang_count", "terms", excess(F.col("p"), F.col("q")).alias("value")),
        "divergence-cells",
    )
    group = Window.partitionBy("lang", "source")
    best = (
        cells.groupBy("lang", "source", "value")
        .agg(F.sum("terms").alias("terms"))
        .withColumn("at", F.row_number().over(group.orderBy(F.desc("value"))))
        .where(F.col("at") <= top)  # each value holds a term at least
        .withColumn("before", F.coalesce(F.sum("terms").over(group.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .where(F.col("before") < top)
        .select("lang", "source", "value", "before")
    )
    ranked = durable(cells.join(best, ["lang", "source", "value"]), "divergence-ranked")
    cell = F.struct("lang", "source", "count", "lang_count")
    table = ranked.select(cell.alias("cell"), "value", "before", "terms")
    found = lookup(entries.withColumn("cell", cell), table, "cell", "terms", spread="term").where(F.col("value").isNotNull())
    tied = Window.partitionBy("lang", "source", "value").orderBy("term")
    return (
        found.withColumn("at", F.row_number().over(tied))
        .where(F.col("at") <= top)
        .withColumn("rank", (F.col("before") + F.col("at")).cast("int"))
        .where(F.col("rank") <= top)
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    )


def pair_part(kept: DataFrame, entries: DataFrame, groups: DataFrame) -> DataFrame:
    """Each source against each other source of its language, summed over cells of two counts.

    A sum over all terms is that over terms which neither source has, corrected for the terms of
    the one, of the other and of both. Only the last need pairs, and terms of equal counts in all
    sources share them; what is in one source only comes from how often it has each count.
    """
    wide = "decimal(38,0)"
    none = groups.select("lang", "source", "total", "kept", share(F.lit(0), F.col("total"), F.col("kept")).alias("zero"))
    sides = none.alias("a").join(none.alias("b"), (F.col("a.lang") == F.col("b.lang")) & (F.col("a.source") != F.col("b.source")))

    def base(p, q):
        return excess(F.col(p), F.col(q)).cast(wide)

    start = sides.select(
        F.col("a.lang").alias("lang"),
        F.col("a.source").alias("source"),
        F.col("b.source").alias("item"),
        # No kept term: no share is defined, and the sum is 0.
        F.when(F.col("a.kept") > 0, F.col("a.kept") * base("a.zero", "b.zero")).otherwise(0).cast(wide).alias("part_value"),
    )

    counts = entries.groupBy("lang", "source", "count").agg(F.count("*").alias("terms"))
    counts = lookup(counts.withColumn("group", F.struct("lang", "source")), groups.drop("lang", "source"), "group", "docs").select(
        "lang", "source", "terms", share(F.col("count"), F.col("total"), F.col("kept")).alias("p"),
        share(F.lit(0), F.col("total"), F.col("kept")).alias("zero"),
    )
    # A third of the counts may belong to one language: they meet its list of sources, a row each.
    others = none.groupBy("lang").agg(F.collect_list(F.struct("source", "zero")).alias("others"), F.count("*").alias("docs"))
    one = (
        lookup(counts, durable(others, "divergence-others"), "lang", "docs", spread="p")
        .select("lang", "source", "terms", "p", "zero", F.explode("others").alias("o"))
        .where(F.col("source") != F.col("o.source"))
        .select("lang", "source", "terms", "p", "zero", F.col("o.source").alias("other"), F.col("o.zero").alias("other_zero"))
    )
    lone = one.select(
        "lang",
        F.explode(
            F.array(
                F.struct(
                    F.col("source"), F.col("other").alias("item"),
                    (F.col("terms") * (base("p", "other_zero") - base("zero", "other_zero"))).cast(wide).alias("part_value"),
                ),
                F.struct(
                    F.col("other").alias("source"), F.col("source").alias("item"),
                    (F.col("terms") * (base("other_zero", "p") - base("other_zero", "zero"))).cast(wide).alias("part_value"),
                ),
            )
        ).alias("e"),
    ).select("lang", "e.*")

    alike = kept.groupBy("lang", F.array_sort("entries").alias("entries")).agg(F.count("*").alias("terms"))
    cells = (
        alike.select("lang", "terms", "entries", F.posexplode("entries").alias("i", "a"))
        .select("lang", "terms", "a", F.explode(F.slice("entries", F.col("i") + 2, F.size("entries"))).alias("b"))
        .groupBy("lang", F.col("a.source").alias("source"), F.col("b.source").alias("item"), F.col("a.count").alias("x"), F.col("b.count").alias("y"))
        .agg(F.sum("terms").alias("terms"))
    )
    for side, name in (("source", "a"), ("item", "b")):
        table = groups.select("group", "docs", F.col("total").alias(f"{name}_total"), F.col("kept").alias(f"{name}_kept"))
        cells = lookup(cells.withColumn("group", F.struct("lang", F.col(side).alias("source"))), table, "group", "docs", spread="x").drop("group")
    cells = cells.select(
        "lang", "source", "item", "terms",
        share(F.col("x"), F.col("a_total"), F.col("a_kept")).alias("p"), share(F.lit(0), F.col("a_total"), F.col("a_kept")).alias("p0"),
        share(F.col("y"), F.col("b_total"), F.col("b_kept")).alias("q"), share(F.lit(0), F.col("b_total"), F.col("b_kept")).alias("q0"),
    )

    def both(p, q, p0, q0):
        return (F.col("terms") * (base(p, q) - base(p, q0) - base(p0, q) + base(p0, q0))).cast(wide).alias("part_value")

    shared = cells.groupBy("lang", "source", "item").agg(
        F.sum(both("p", "q", "p0", "q0")).cast(wide).alias("there"), F.sum(both("q", "p", "q0", "p0")).cast(wide).alias("back")
    )
    shared = shared.select(
        "lang",
        F.explode(
            F.array(
                F.struct("source", "item", F.col("there").alias("part_value")),
                F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("part_value")),
            )
        ).alias("e"),
    ).select("lang", "e.*")

    summed = start.unionByName(lone).unionByName(shared).groupBy("lang", "source", "item").agg(F.sum("part_value").cast("long").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def source_divergence(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    least_docs: int = LEAST_DOCS, top: int = TOP, held: int = HELD,
) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``term`` and ``pair`` of the audit.

    Terms are runs of ASCII letters and of all characters beyond ASCII, A-Z lower-cased; a
    language keeps those in at least ``least_docs`` of its rows. Counts give shares p, whole
    numbers out of SCALE; p differs from q by floor((p - q)^2 / q). ``term`` ranks a source's
    terms with p above the language's share, to rank ``top``; ``pair`` ranks the other sources
    of the language by the sum over all kept terms. Equal values rank by item, by UTF-8.

    Null text, language or source counts as empty. Each row is a document, repeated ones too.
    Texts are read whole, very long ones in parts. An empty table gives no row; a language without
    kept terms gives pairs of value 0, one with a single source none. Columns of any other name
    are ignored. One source or term may hold most rows: they are summed before the shuffle, and
    joins to their rows are spread.
    """
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    counted = term_counts(rows, held)
    kept = durable(
        counted.groupBy("lang", "term")
        .agg(
            F.sum("count").alias("lang_count"),
            F.sum("docs").alias("docs"),
            # One entry per source of the language.
            F.collect_list(F.struct("source", "count")).alias("entries"),
        )
        .where(F.col("docs") >= least_docs)
        .drop("docs"),
        "divergence-kept",
    )
    entries = kept.select("lang", "term", "lang_count", F.inline("entries"))
    totals = entries.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_count").alias("lang_total"))
    groups = durable(
        rows.groupBy("lang", "source")
        .agg(F.count("*").alias("docs"))
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang", "source", F.struct("lang", "source").alias("group"), "docs",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "kept", "lang_total")],
        ),
        "divergence-groups",
    )
    pairs = pair_part(kept, entries, groups)
    return term_part(entries, groups.drop("lang", "source"), top).unionByName(pairs)
