"""Stages of the pipeline on awkward rows, and the whole of it."""

import random
from collections import Counter

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

import corpus_pipeline as pipe

# Names of columns the stages make on their way, too.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, ids string, line_dedup int, decoded string, component_id int, fp int"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    texts = [(i, prose(i, 40)) for i in range(12)]
    # No id; one id of two texts; copies of a row, of a text; null, empty, very long.
    texts += [(None, prose(50, 40)), (None, prose(51, 40)), (None, prose(52, 40)), (7, prose(53, 40)), (3, prose(3, 40)), (3, prose(3, 40)), (90, prose(4, 40))]
    texts += [(91, None), (92, ""), (93, prose(60, 30_000))]
    return [(i, t, "en", None if n % 5 == 0 else "s", len(t or ""), "x", 1, "y", 2, 3) for n, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.mark.parametrize("name, stage", pipe.STAGES)
def test_stage_takes_awkward_rows_and_none(spark, docs, rows, name, stage):
    out = stage(spark, docs, SMALL)
    last = name == "sentencepiece"
    assert out.columns == (["doc_id", "source", "ids", "n_tokens", "decoded_sha256"] if last else docs.columns)
    assert stage(spark, docs.limit(0), SMALL).count() == 0
    given = Counter((r[0], r[1]) for r in rows)
    found = out.collect()
    if last:
        assert len(found) == len(rows) and min(r["n_tokens"] for r in found) == 1
    else:
        assert {(r["doc_id"], r["text"]) for r in found} <= set(given)


def test_near_dedup_loses_no_text(spark, docs, rows):
    got = Counter((r["doc_id"], r["text"]) for r in pipe.near_dedup(spark, docs, SMALL).collect())
    assert max(got.values()) == 1
    # Null and empty are one text without words; 90 copies the text of 4.
    assert {t or "" for _, t in got} == {r[1] or "" for r in rows}
    assert (90, prose(4, 40)) not in got and (4, prose(4, 40)) in got and (92, "") not in got
    assert len(got) == len({r[1] or "" for r in rows})


def test_line_dedup_counts_characters_anew(spark):
    block = "\n".join(prose(200 + k, 12) for k in range(4))
    df = spark.createDataFrame([(i, f"{prose(300 + i, 9)}\n{block}\n{prose(400 + i, 9)}", "en", "s", 1) for i in range(3)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r["doc_id"]: r for r in pipe.line_dedup(spark, df, SMALL).collect()}
    assert block in got[0]["text"] and block not in got[1]["text"] and got[1]["n_chars"] == len(got[1]["text"]) and got[0]["n_chars"] == 1


def test_whole_pipeline(spark):
    out = pipe.run(spark, SMALL)
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert ids and ids <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert out.where(F.col("n_tokens") != F.size("ids")).isEmpty()
