"""Column statistics that stay exact and bounded on any number of rows.

Every fit in this library ends in a handful of numbers per column. They are
computed by Spark aggregates, come back as one small row per column, and are
applied as literals, so an apply step is a pure projection (also on a stream).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Up to this many rows one `percentile` buffer holds a column comfortably.
ONE_BUFFER_ROWS = 1_000_000
# Histogram cells per narrowing pass.
CELLS = 1024
# With more columns than this, rows are unpivoted and grouped by column: one
# narrow compiled aggregate instead of hundreds side by side, and the final
# merges are spread over the columns.
WIDE_COLUMNS = 12


def summarise(df: DataFrame, wanted: Mapping[Any, Column]) -> dict[Any, Any]:
    """Evaluate aggregate expressions over ``df`` and return one row as a dict."""
    names = list(wanted)
    row = df.agg(*[wanted[n].alias(f"v{i}") for i, n in enumerate(names)]).first()
    return {n: row[i] for i, n in enumerate(names)}


def unpivot(df: DataFrame, exprs: Mapping[Any, Column], *carry: Column) -> DataFrame:
    """(carry..., f, x): one row per expression, f being its position."""
    names = [f"x{i}" for i in range(len(exprs))]
    ready = df.select(*carry, *[c.cast("double").alias(n) for n, c in zip(names, exprs.values())])
    kept = ready.columns[: len(carry)]
    cells = [v for i, n in enumerate(names) for v in (F.lit(i), F.col(n))]
    return ready.select(*kept, F.stack(F.lit(len(names)), *cells).alias("f", "x"))


def per_column(
    df: DataFrame,
    exprs: Mapping[Any, Column],
    stats: Mapping[str, Callable[[Column], Column]],
    by: Column | None = None,
) -> dict[Any, dict[Any, Any]]:
    """The same aggregates over many expressions: {name: {stat: value}}, or
    {(name, group): {stat: value}} with ``by`` (a few groups, e.g. classes)."""
    names = list(exprs)
    group = [by.alias("__by")] if by is not None else []
    out: dict[Any, dict[Any, Any]] = {}
    if len(names) <= WIDE_COLUMNS:
        frame = df.select(*group, *[exprs[n].cast("double").alias(f"x{i}") for i, n in enumerate(names)])
        aggregates = [f(F.col(f"x{i}")).alias(f"{s}{i}") for i in range(len(names)) for s, f in stats.items()]
        keys = ["__by"] if group else []
        for r in frame.groupBy(*keys).agg(*aggregates).collect() if names else []:
            for i, n in enumerate(names):
                out[(n, r["__by"]) if group else n] = {s: r[f"{s}{i}"] for s in stats}
        return out
    keys = ["f", "__by"] if group else ["f"]
    long = unpivot(df, exprs, *group)
    for r in long.groupBy(*keys).agg(*[f(F.col("x")).alias(s) for s, f in stats.items()]).collect():
        n = names[r["f"]]
        out[(n, r["__by"]) if group else n] = {s: r[s] for s in stats}
    if not group:
        for n in names:
            out.setdefault(n, {s: 0 if s == "n" else None for s in stats})
    return out


def _rank_plan(n: int, p: float) -> tuple[int, int, float]:
    at = p * (n - 1)
    low = min(int(math.floor(at)), n - 1)
    high = min(low + 1, n - 1)
    return low, high, at - low


def quantiles(
    df: DataFrame,
    wanted: Mapping[Any, tuple[Column, Sequence[float]]],
    one_buffer_rows: int = ONE_BUFFER_ROWS,
    rows: int | None = None,
) -> dict[Any, list[float | None]]:
    """Exact linearly interpolated quantiles of several expressions at once.

    ``wanted`` maps a name to (expression, probabilities); missing values are
    skipped. Small inputs use `percentile` aggregates. Beyond that the ranks
    are located by narrowing: each pass counts rows per histogram cell (a
    map-side combined shuffle of at most ``CELLS`` rows per interval) and keeps
    the cell that holds the rank, until the rank is the first or last row of its
    cell or all rows there are equal. No buffer grows with the data, and all
    columns and probabilities share each scan. Infinities and NaN (largest) rank as values on either path. ``rows`` is the row count where
    the caller has it already.
    """
    if not wanted:
        return {}
    exprs = {n: c for n, (c, _) in wanted.items()}
    basics: dict[Any, dict[str, Any]] = {}
    if rows is None or rows > one_buffer_rows:
        finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) != math.inf), c)
        basics = per_column(
            df,
            exprs,
            {
                "all": F.count,
                "n": lambda c: F.count(finite(c)),
                "low": lambda c: F.min(finite(c)),
                "high": lambda c: F.max(finite(c)),
                "below": lambda c: F.count(F.when(c == -math.inf, 1)),
                "nan": lambda c: F.count(F.when(F.isnan(c), 1)),
            },
        )
        rows = max(b["all"] for b in basics.values())
    if rows <= one_buffer_rows:
        asked = sorted({float(p) for _, ps in wanted.values() for p in ps})
        found = per_column(df, exprs, {"q": lambda c: F.percentile(c, F.array(*[F.lit(p) for p in asked]))})
        return {
            n: [found[n]["q"][asked.index(float(p))] if found[n]["q"] is not None else None for p in ps]
            for n, (_, ps) in wanted.items()
        }

    plans = {(n, p): _rank_plan(basics[n]["all"], p) for n, (_, ps) in wanted.items() for p in ps if basics[n]["all"]}
    ranks = {(n, k) for (n, _), (low, high, _) in plans.items() for k in (low, high)}
    # Infinities and NaN (the largest) are counted apart; only finite ranks are narrowed.
    values: dict[tuple[Any, int], float] = {}
    for n, k in ranks:
        b = basics[n]
        if k < b["below"]:
            values[n, k] = -math.inf
        elif k >= b["below"] + b["n"]:
            values[n, k] = math.nan if k >= b["all"] - b["nan"] else math.inf
    inner = {(n, k - basics[n]["below"]) for n, k in ranks if (n, k) not in values}
    found = _values_at_ranks(df, exprs, inner, basics)
    values |= {(n, k + basics[n]["below"]): v for (n, k), v in found.items()}
    out: dict[Any, list[float | None]] = {}
    for n, (_, ps) in wanted.items():
        out[n] = []
        for p in ps:
            if (n, p) not in plans:
                out[n].append(None)
                continue
            low, high, part = plans[n, p]
            a, b = values[n, low], values[n, high]
            if part and not (math.isfinite(a) and math.isfinite(b)):
                out[n].append((1 - part) * a + part * b)
            else:
                out[n].append(a if part == 0 else a + (b - a) * part)
    return out


def _values_at_ranks(df, exprs, ranks, basics) -> dict[tuple[Any, int], float]:
    """Value of each 0-based rank of each column, by repeated narrowing."""
    found: dict[tuple[Any, int], float] = {}
    # rank -> (rows below the interval, rows inside, lowest, highest value inside)
    open_ = {(n, k): (0, basics[n]["n"], basics[n]["low"], basics[n]["high"]) for n, k in ranks}
    names = list(exprs)
    spark = df.sparkSession
    while True:
        for key in list(open_):
            below, inside, low, high = open_[key]
            if low == high or key[1] == below:
                found[key] = low
            elif key[1] == below + inside - 1:
                found[key] = high
            else:
                continue
            del open_[key]
        if not open_:
            return found
        active = sorted({n for n, _ in open_}, key=names.index)
        keys = sorted({(active.index(n), *state) for (n, _), state in open_.items()})
        number = {key: i for i, key in enumerate(keys)}
        of_rank = {(n, k): number[(active.index(n), *state)] for (n, k), state in open_.items()}
        intervals = spark.createDataFrame(
            [(i, f, low, high) for (f, _, _, low, high), i in number.items()], "i int, fi int, low double, high double"
        )
        asked = spark.createDataFrame(
            [(of_rank[n, k], k - state[0], j) for j, ((n, k), state) in enumerate(open_.items())],
            "ai int, k bigint, j int",
        )
        x, low, high = F.col("x"), F.col("low"), F.col("high")
        # Halved terms keep the width finite for extreme limits.
        share = (x / 2 - low / 2) / (high / 2 - low / 2)
        cell = F.least(F.floor(share * CELLS), F.lit(CELLS - 1)).cast("int")
        # Intervals and asked ranks: a few per column and probability.
        per_cell = (
            unpivot(df, {n: exprs[n] for n in active})
            .join(F.broadcast(intervals), (F.col("f") == F.col("fi")) & (x >= low) & (x <= high))
            .groupBy("i", cell.alias("cell"))
            .agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        )
        # At most CELLS rows per interval reach this window.
        before = Window.partitionBy("i").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        placed = per_cell.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        inside = (F.col("k") >= F.col("before")) & (F.col("k") < F.col("before") + F.col("n"))
        hits = placed.join(F.broadcast(asked), (F.col("i") == F.col("ai")) & inside)
        order = list(open_)
        for r in hits.select("j", "before", "n", "lo", "hi").collect():
            key = order[r["j"]]
            open_[key] = (open_[key][0] + r["before"], r["n"], r["lo"], r["hi"])


def quantiles_of(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], **kw) -> dict[str, list[float | None]]:
    return quantiles(df, {c: (F.col(c), probabilities) for c in columns}, **kw)


def mean_and_std(df: DataFrame, columns: Sequence[str], population: bool = False) -> dict[str, tuple[float | None, float | None]]:
    spread = F.stddev_pop if population else F.stddev_samp
    got = per_column(df, {c: F.col(c) for c in columns}, {"mean": F.avg, "std": spread})
    return {c: (s["mean"], s["std"]) for c, s in got.items()}


def corrected_skewness(c: Column) -> Column:
    """Bias-corrected sample skewness; NULL under three values, 0 when flat."""
    n = F.count(c).cast("double")
    flat = F.var_pop(c) < F.lit(1e-14)
    value = F.skewness(c) * F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return F.when(n < 3, None).when(flat, 0.0).otherwise(value)
