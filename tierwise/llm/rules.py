"""Quality classifier: a sparse ensemble of rules over text statistics, compiled to column expressions."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import words
from tierwise.runtime import durable

# Labelled rows the classifier is fitted on, at most; all others only get scores.
SAMPLE = 20_000
TREES = 30
DEPTH = 3
PENALTY = 0.001
SEED = 13

# (name, characters) whose share of a text is a statistic. Fixed values.
CLASSES = (
    ("symbol", "#$%&*+<=>@[]^_{}~"),
    ("bar", "|"),
    ("bang", "!?"),
    ("stop", ".,;:"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("digit", "0123456789"),
)
STATISTICS = [
    "n_words", "word_length", "longest_word", "distinct_words", "adjacent_words", "short_words",
    "n_lines", "distinct_lines", "line_words", *[f"{name}_chars" for name, _ in CLASSES],
]


def held_out(doc_id: Column) -> Column:
    """Rows no label is learned from; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(3)) == 1


def with_statistics(df: DataFrame, text: str = "__text") -> DataFrame:
    """``df`` with numbers about each whole text, named ``__s_<statistic>``; null counts as empty.

    Shares lie in 0..1 and are 0 where nothing is there to share. They are columns of their own:
    a struct's fields would be worked out again wherever a rule reads one.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    ready = df.withColumns({"__whole": whole, "__words": words(F.col(text)), "__lines": F.filter(F.split(whole, "\n"), lambda x: x != "")})
    n, chars = F.size("__words"), F.length("__whole")

    def part(count: Column, of: Column) -> Column:
        return F.when(of > 0, count / of).otherwise(0.0).cast("double")

    lengths = F.transform("__words", F.length)
    columns = {
        "n_words": n.cast("double"),
        "word_length": part(F.length(F.array_join("__words", "")), n),
        "longest_word": F.coalesce(F.array_max(lengths), F.lit(0)).cast("double"),
        "distinct_words": part(F.size(F.array_distinct("__words")), n),
        "adjacent_words": part(F.size(F.filter("__words", lambda w, i: w == F.get("__words", i - 1))), n),
        "short_words": part(F.size(F.filter(lengths, lambda k: k <= 3)), n),
        "n_lines": F.size("__lines").cast("double"),
        "distinct_lines": part(F.size(F.array_distinct("__lines")), F.size("__lines")),
        "line_words": part(n, F.size("__lines")),
        **{f"{name}_chars": part(chars - F.length(F.translate("__whole", members, "")), chars) for name, members in CLASSES},
    }
    return ready.withColumns({f"__s_{c}": columns[c] for c in STATISTICS}).drop("__whole", "__words", "__lines")


@dataclass(frozen=True)
class Rule:
    """A conjunction: each (statistic, above, most) holds if above < value <= most; None leaves a side open."""

    ranges: tuple[tuple[str, float | None, float | None], ...]

    def column(self) -> Column:
        out = F.lit(True)
        for name, above, most in self.ranges:
            value = F.col(f"__s_{name}")
            if above is not None:
                out = out & (value > above)
            if most is not None:
                out = out & (value <= most)
        return out

    def __str__(self) -> str:
        sides = [(name, sign, at) for name, above, most in self.ranges for sign, at in ((">", above), ("<=", most)) if at is not None]
        return " and ".join(f"{name} {sign} {at:g}" for name, sign, at in sides)


SPLIT = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def paths(tree: str, names: list[str]) -> list[Rule]:
    """The rule of each node below the root of a tree, from its printed form."""
    found, open_ranges = [], []
    for line in tree.splitlines():
        if not (m := SPLIT.match(line)):
            continue
        depth = len(m[1])
        while open_ranges and open_ranges[-1][0] >= depth:
            open_ranges.pop()
        open_ranges.append((depth, names[int(m[2])], m[3], float(m[4])))
        sides: dict[str, list[float | None]] = {}
        for _, name, sign, at in open_ranges:
            above, most = sides.setdefault(name, [None, None])
            if sign == ">":
                sides[name][0] = at if above is None else max(above, at)
            else:
                sides[name][1] = at if most is None else min(most, at)
        found.append(Rule(tuple((name, *sides[name]) for name in sorted(sides))))
    return found


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules; ``bias`` alone decides where no rule holds."""

    bias: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1 as one expression over the statistics."""
        total = F.lit(self.bias)
        for rule, weight in self.weights:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, most: int) -> DataFrame:
    """(__key, __label, statistics) of at most about ``most`` labelled documents that may be learned from.

    An id with several labels takes the smallest, and one with several texts the row of the
    smallest statistics, so an id counts once however many rows carry it.
    """
    known = durable(
        labels.select(F.col(f"`{doc_id}`").alias("__key"), F.col(f"`{label}`").cast("double").alias("__label"))
        .where(F.col("__key").isNotNull() & F.col("__label").isNotNull() & ~held_out(F.col("__key")))
        .groupBy("__key")
        .agg(F.min("__label").alias("__label")),
        "rule-labels",
    )
    n = known.count()
    if n > most:
        # Four deviations below the bound, so that it isn't passed by chance.
        rate = (most - 4 * most**0.5) / n
        known = known.where(F.pmod(F.xxhash64(F.lit("rules"), "__key"), F.lit(1 << 40)) < int(rate * (1 << 40)))
    rows = docs.select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("__text"))
    rows = rows.join(F.broadcast(known), F.col("__id") == F.col("__key"))  # at most ``most`` ids
    numbers = F.struct(*[f"__s_{c}" for c in STATISTICS])
    stats = with_statistics(rows).groupBy("__key").agg(F.first("__label").alias("__label"), F.min(numbers).alias("__stats"))
    # Bounded, and in one order, so that a fit repeats.
    return durable(stats.repartition(1).sortWithinPartitions("__key").select("__key", "__label", "__stats.*"), "rule-sample")


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = SEED,
) -> RuleModel:
    """Grow shallow trees on the labelled sample, take their paths as rules, weigh them by lasso.

    Without rows of both labels there is nothing to tell apart: the bias is then that of the one
    label seen (0.5 without any).
    """
    rows = labelled_sample(docs, labels, doc_id, text, label, sample)
    n, ones = rows.agg(F.count("*"), F.sum("__label")).first()
    if not n or ones in (0, n):
        return RuleModel(0.0 if not n else (10.0 if ones else -10.0), ())
    columns = [f"__s_{c}" for c in STATISTICS]
    ready = rows.select("__label", *columns, array_to_vector(F.array(*columns)).alias("__vector"))
    forest = RandomForestClassifier(
        featuresCol="__vector", labelCol="__label", numTrees=trees, maxDepth=depth, subsamplingRate=0.7,
        minInstancesPerNode=max(2, n // 1000), seed=seed,
    ).fit(ready)
    rules = list(dict.fromkeys(rule for tree in forest.trees for rule in paths(tree.toDebugString, STATISTICS)))
    if not rules:
        return RuleModel(math.log(ones / (n - ones)), ())
    marked = ready.select("__label", array_to_vector(F.array(*[r.column().cast("double") for r in rules])).alias("__rules"))
    lasso = LogisticRegression(
        featuresCol="__rules", labelCol="__label", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=100, tol=1e-6
    ).fit(durable(marked, "rule-marks"))
    weights = tuple((rule, float(w)) for rule, w in zip(rules, lasso.coefficients.toArray()) if w)
    return RuleModel(float(lasso.intercept), weights)


def classify(docs: DataFrame, model: RuleModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row, in one projection."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("__text"))
    scored = with_statistics(rows).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def quality_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted): ``fit`` on the labels, then ``classify`` all documents.

    Labels teach only through rows that aren't held out; scores read nothing but the text. Null and
    empty texts have statistics of 0 and a score as any other. Repeated rows each get one, equal
    texts an equal one. Texts are read whole, very long ones too. Rows labelled null, or whose id
    is null, teach nothing. Columns of any other name are ignored; an empty table gives no row, and
    without labels every score is 0.5.
    """
    return classify(docs, fit(docs, labels, **options))
