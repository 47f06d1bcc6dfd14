"""Source divergence, ranked search and the rule classifier beside brute force, also on awkward rows."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tierwise.llm import common, divergence, ranked, rules

LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LETTERS_DIGITS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, count bigint, term string, n bigint, score double, rank int"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def awkward():
    """Nulls, empty and very long texts, ties, repeated rows, a hot source; columns whose names clash with results."""
    rng = random.Random(4)
    words = ["Alpha", "beta", "ÉTÉ", "été", "x9y", "gamma", "Beta", "日本", "ab1", "zz"] + [f"w{chr(97 + i)}" for i in range(20)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)]
    texts += [None, "", "12 34", "!!", texts[0], texts[0], " ".join(rng.choices(words, k=30_000)), "\x00\x7f\nalpha\talpha"]
    rows = []
    for i, t in enumerate(texts):
        lang = [None, "en", "de", ""][i % 4] if i > 20 else "en"
        source = "hot" if i % 3 else [None, "s1", "s2"][i % 9 // 3]
        rows.append((None if i in (5, 9) else i // 2 if i > 60 else i, t, lang, source, 1, "t", 2, 0.5, 3))
    return rows


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def test_terms_of_bytes_are_those_of_the_pattern():
    rng = random.Random(2)
    text = "".join(rng.choice("aZ09 @[`{\x7f\x80éÉ日\n\t_-") for _ in range(5000))
    for pattern, kept in ((LETTERS, common.LETTERS), (LETTERS_DIGITS, common.LETTERS_DIGITS)):
        want = [w.encode() for w in pattern.findall(lower(text))]
        for most in (1, 7, 10**9):
            assert [t for part in common.term_lists(text.encode(), kept, most) for t in part] == want
    assert list(common.term_lists(None, common.LETTERS)) == list(common.term_lists(b"", common.LETTERS)) == []


def divergence_by_hand(rows, least=3, top=200):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        lang, source = r[2] or "", r[3] or ""
        terms = LETTERS.findall(lower(r[1]))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, source in counts:
        kept = [t for t, n in docs[lang].items() if n >= least]
        others = [s for g, s in counts if g == lang]
        whole = Counter()
        for s in others:
            whole.update(counts[lang, s])

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}

        p, q = shares(counts[lang, source]), shares(whole)
        f = lambda a, b: (a - b) * (a - b) // b
        terms = sorted(((-f(p[t], q[t]), t.encode()) for t in kept if counts[lang, source][t] and p[t] > q[t]))[:top]
        out |= {(lang, source, "term", t.decode(), -v, i + 1) for i, (v, t) in enumerate(terms)}
        pairs = []
        for s in others:
            if s != source:
                o = shares(counts[lang, s])
                pairs.append((-sum(f(p[t], o[t]) for t in kept), s.encode()))
        out |= {(lang, source, "pair", s.decode(), -v, i + 1) for i, (v, s) in enumerate(sorted(pairs))}
    return out


@pytest.mark.parametrize("least, top, held", [(3, 200, 300_000), (1, 2, 7), (1000, 5, 100)])
def test_divergence_equals_brute_force(docs, rows, least, top, held):
    got = divergence.source_divergence(docs, least_docs=least, top=top, held=held)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == divergence_by_hand(rows, least, top)


def test_divergence_of_large_counts_is_exact(spark):
    """Counts beyond what 64 bits hold after scaling."""
    n = 98_765_432_109_876
    df = spark.createDataFrame([(n, 7, n - 3)], "count bigint, kept bigint, total bigint")
    got = df.select(divergence.share(F.col("count"), F.col("total"), F.col("kept")).alias("p")).first()["p"]
    assert got == 1 + 10**9 * (n + 1) // (n - 3 + 7)


def test_divergence_of_few_rows(docs):
    assert divergence.source_divergence(docs.limit(0)).count() == 0
    assert divergence.source_divergence(docs.where("doc_id = 1")).count() == 0


def search_by_hand(docs, items, top=10):
    terms = [(r[0], LETTERS_DIGITS.findall(lower(r[1]))) for r in docs]
    terms = [(d, t) for d, t in terms if t]
    n, total = len(terms), sum(len(t) for _, t in terms)
    df = Counter(t for _, ts in terms for t in set(ts))
    out = []
    for item, text in items:
        asked = Counter(LETTERS_DIGITS.findall(lower(text)))
        scored = []
        for d, ts in terms:
            tf, m = Counter(ts), 25 + 75 * len(ts) * n // total
            score = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t, k in asked.items() if tf[t])
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored, key=lambda s: s[:3])[:top])]
    return sorted(out, key=str)


ITEMS = [(1, "alpha beta BETA x9y"), (2, None), (3, ""), (4, "nowhere"), (5, "été ÉTÉ 日本 zz zz zz"), (6, "12 34"), (None, "gamma"), (1, "wa wb wc wd we wf")]


@pytest.mark.parametrize("block", [50_000, 3])
def test_search_equals_brute_force(spark, docs, rows, block, monkeypatch):
    monkeypatch.setattr(ranked, "ROWS", 4)
    items = spark.createDataFrame([(i, t, 0.1) for i, t in ITEMS], "item_id bigint, text string, score double")
    got = ranked.best_documents(docs, items, block_terms=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == search_by_hand(rows, ITEMS)


def test_search_of_empty_tables_and_text_ids(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert ranked.best_documents(docs.limit(0), items).count() == 0
    assert ranked.best_documents(docs, items.limit(0)).count() == 0
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    assert ranked.best_documents(named, items).where("doc_id like 'd%'").count() > 0


def test_bounds_are_never_below_scores(rows):
    """Also for sketches that can't grow with their terms, and for very frequent ones."""
    rng = random.Random(9)
    queries = [(q, {b"t%d" % rng.randrange(3000): rng.randint(1, 9000) for _ in range(12)}) for q in range(20)]
    block = ranked.Block(queries, 1000, 90_000, 10)
    for size in (1, 40, 2500):
        names = [b"t%d" % i for i in rng.sample(range(3000), size)]
        times = [rng.choice([1, 2, 254, 255, 256, 100_000]) for _ in names]
        most = block.bounds(sum(times), ranked.folded(names, times))
        exact = block.impacts(sum(times), b" ".join(names), times)
        for q in range(20):
            assert exact[block.at[q]] @ block.weights[q] <= most[q]


def test_rules_of_a_printed_tree():
    tree = """DecisionTreeClassificationModel: depth=2
  If (feature 0 <= 0.5)
   If (feature 1 <= -1.0E-3)
    Predict: 0.0
   Else (feature 1 > -1.0E-3)
    Predict: 1.0
  Else (feature 0 > 0.5)
   If (feature 0 <= 2.0)
    Predict: 1.0
   Else (feature 0 > 2.0)
    Predict: 0.0
"""
    assert [str(r) for r in rules.paths(tree, ["a", "b"])] == [
        "a <= 0.5", "a <= 0.5 and b <= -0.001", "a <= 0.5 and b > -0.001", "a > 0.5", "a > 0.5 and a <= 2", "a > 2"
    ]


def test_text_statistics(spark):
    texts = ["Go go go. a|b #1\n\nline two\nline two", None, "", "  \n "]
    df = rules.with_statistics(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, __text string"))
    got = {r["i"]: r.asDict() for r in df.collect()}
    first = got[0]
    want = {"n_words": 9, "word_length": 26 / 9, "longest_word": 4, "distinct_words": 7 / 9, "adjacent_words": 0, "short_words": 7 / 9, "n_lines": 3, "distinct_lines": 2 / 3, "line_words": 3}
    want |= {"upper_chars": 1 / 35, "digit_chars": 1 / 35, "symbol_chars": 1 / 35, "bar_chars": 1 / 35, "stop_chars": 1 / 35, "bang_chars": 0}
    assert len(texts[0]) == 35
    assert {k: first[f"__s_{k}"] for k in want} == pytest.approx(want)
    assert all(v == 0 for i in (1, 2) for k, v in got[i].items() if k.startswith("__s_"))


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, rules.fit(docs, labels, trees=8)


def test_classifier_on_rows_held_out(spark, model):
    _, _, fitted = model
    docs, labels = (spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    scored = rules.classify(docs, fitted).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in scored) / len(scored)
    assert len(scored) > 80 and right >= 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)


def test_score_column_equals_the_rules_by_hand(model):
    docs, _, fitted = model
    stats = rules.with_statistics(docs.select("doc_id", F.col("text").alias("__text")))
    rows = stats.select("*", fitted.score().alias("score")).drop("__text").collect()
    assert fitted.weights
    for r in rows:
        total = fitted.bias
        for rule, weight in fitted.weights:
            if all((lo is None or r[f"__s_{n}"] > lo) and (hi is None or r[f"__s_{n}"] <= hi) for n, lo, hi in rule.ranges):
                total += weight
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)))


def test_classifier_on_awkward_rows(docs, rows, model):
    out = rules.classify(docs, model[2]).collect()
    assert len(out) == len(rows) and all(r["score"] is not None and r["predicted"] in (0, 1) and r["held_out"] is not None for r in out)
    by_id = defaultdict(set)
    for r in out:
        by_id[r["doc_id"]].add(r["held_out"])
    assert all(len(v) == 1 for v in by_id.values()) and by_id[None] == {False}
    assert rules.classify(docs.limit(0), model[2]).count() == 0


def test_labels_held_out_teach_nothing(spark, model):
    docs, labels, fitted = model
    turned = labels.withColumn("quality", F.when(rules.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    odd = turned.unionByName(turned.limit(3)).unionByName(turned.limit(2).withColumn("doc_id", F.lit(None).cast("bigint"))).unionByName(turned.limit(2).withColumn("quality", F.lit(None).cast("int")).withColumn("doc_id", F.lit(-5).cast("bigint")))
    assert rules.fit(docs, odd, trees=8) == fitted


def test_too_few_labels(docs, model):
    _, labels, _ = model
    for few, score in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1 / (1 + math.exp(-10))), (labels.where("quality = 0"), 1 / (1 + math.exp(10)))):
        got = {r["score"] for r in rules.quality_scores(model[0], few).collect()}
        assert len(got) == 1 and got.pop() == pytest.approx(score)


def test_sample_is_bounded(spark, model):
    docs, labels, _ = model
    assert rules.labelled_sample(docs, labels, "doc_id", "text", "quality", 60).count() <= 60
