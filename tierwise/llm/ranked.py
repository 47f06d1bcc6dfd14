"""Ranked lexical search: documents for each query text, through sketches of their impacts."""

from __future__ import annotations

import math
import zlib
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.llm.common import LETTERS_DIGITS, term_lists
from tierwise.runtime import durable

TOP = 10
# Coordinates of a sketch: a power of two of about so many for each different term, within limits.
SPREAD = 8
LEAST, MOST = 64, 1 << 16
# Occurrences from here on count as any number.
MANY = 255
# Different terms of the queries that go over the index at once.
BLOCK_TERMS = 50_000
ROWS = 512
CHUNK_BYTES = 32_000_000


def folded(terms: list[bytes], times: list[int]) -> bytes:
    """Largest number of occurrences among the terms that share a coordinate; one byte each."""
    size = LEAST
    while size < MOST and size < SPREAD * len(terms):
        size *= 2
    sketch = np.zeros(size, np.uint8)
    at = np.fromiter(map(zlib.crc32, terms), np.int64, len(terms)) & (size - 1)
    np.maximum.at(sketch, at, np.minimum(np.asarray(times, np.int64), MANY).astype(np.uint8))
    return sketch.tobytes()


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, sketch, terms, times): one row for each row of ``docs`` that has a term.

    An impact grows with the occurrences, so the sketch keeps their maxima, from which those of
    the impacts follow once the corpus is counted. ``terms`` are joined by spaces, in UTF-8.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("sketch", T.BinaryType()),
            T.StructField("terms", T.BinaryType()),
            T.StructField("times", T.ArrayType(T.IntegerType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [batch.schema.field(0).type, pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int32())]

            def chunk(rows: list[tuple]) -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], schema.names)

            rows, size = [], 0
            for key, value in zip(batch.column(0), batch.column(1)):
                counts: Counter[bytes] = Counter()
                for terms in term_lists(value.as_py(), LETTERS_DIGITS):
                    counts.update(terms)
                if not counts:
                    continue
                names, times = list(counts), list(counts.values())
                row = (key.as_py(), sum(times), folded(names, times), b" ".join(names), times)
                rows.append(row)
                size += len(row[2]) + len(row[3]) + 40 * len(times)
                if size >= CHUNK_BYTES:
                    yield chunk(rows)
                    rows, size = [], 0
            if rows:
                yield chunk(rows)

    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text")).mapInArrow(run, schema)


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(number, item_id, terms, times) of the items with a term, stored; ``number`` names a row."""
    schema = T.StructType(
        [
            T.StructField("item_id", items.schema[item_id].dataType),
            T.StructField("terms", T.ArrayType(T.BinaryType())),
            T.StructField("times", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for value in batch.column(1):
                counts.append(Counter())
                for terms in term_lists(value.as_py(), LETTERS_DIGITS):
                    counts[-1].update(terms)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([list(c) for c in counts], pa.list_(pa.binary())),
                    pa.array([list(c.values()) for c in counts], pa.list_(pa.int64())),
                ],
                schema.names,
            )

    found = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").cast("binary").alias("text")).mapInArrow(run, schema)
    return durable(found.where(F.size("terms") > 0).withColumn("number", F.monotonically_increasing_id()), "ranked-items")


def document_frequencies(index: DataFrame, wanted: frozenset[bytes]) -> dict[bytes, int]:
    """Documents that hold each of the ``wanted`` terms, of which a block has boundedly many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for value in batch.column(0):
                counts.update(wanted.intersection(value.as_py().split(b" ")))
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["term", "docs"])

    found = index.select("terms").mapInArrow(run, "term binary, docs bigint").groupBy("term").agg(F.sum("docs").alias("docs"))
    return {bytes(r["term"]): r["docs"] for r in found.collect()}


class Block:
    """Some queries with weighted terms, and the best documents a task has seen for each."""

    def __init__(self, queries: list[tuple[int, dict[bytes, int]]], n_docs: int, n_terms: int, top: int):
        self.numbers = [number for number, _ in queries]
        self.place = {t: i for i, t in enumerate(dict.fromkeys(t for _, weights in queries for t in weights))}
        self.at = [np.array([self.place[t] for t in weights]) for _, weights in queries]
        self.weights = [np.array(list(weights.values()), np.int64) for _, weights in queries]
        self.flat_at, self.flat_weights = np.concatenate(self.at), np.concatenate(self.weights)
        self.starts = np.concatenate([[0], np.cumsum([len(w) for w in self.weights])[:-1]])
        self.hashes = np.fromiter(map(zlib.crc32, self.place), np.int64, len(self.place))
        self.coordinates: dict[int, np.ndarray] = {}
        self.n_docs, self.n_terms, self.top = n_docs, n_terms, top
        self.best: list[list[tuple]] = [[] for _ in queries]
        # Least score that can still enter; 1 until the list is full.
        self.enter = np.ones(len(queries), np.int64)

    def length_part(self, n: int) -> int:
        return 25 + (75 * n * self.n_docs) // self.n_terms

    def bounds(self, n: int, sketch: bytes) -> np.ndarray:
        """No score of the document is above these, one for each query."""
        size = len(sketch)
        if size not in self.coordinates:
            self.coordinates[size] = self.hashes & (size - 1)
        impacts = STEPS * 1_000_000_000 // (1000 * STEPS + 8 * self.length_part(n))
        impacts[MANY] = 1_000_000
        most = impacts[np.frombuffer(sketch, np.uint8)[self.coordinates[size]]]
        return np.add.reduceat(most[self.flat_at] * self.flat_weights, self.starts)

    def impacts(self, n: int, terms: bytes, times: list[int]) -> np.ndarray:
        """Exact impacts of the queries' terms in one document."""
        out = np.zeros(len(self.place), np.int64)
        m = self.length_part(n)
        for term, tf in zip(terms.split(b" "), times):
            if (i := self.place.get(term)) is not None:
                out[i] = 1_000_000_000 * tf // (1000 * tf + 8 * m)
        return out

    def offer(self, q: int, score: int, doc) -> None:
        best = self.best[q]
        insort(best, (-score, doc is None, 0 if doc is None else doc))
        if len(best) > self.top:
            best.pop()
        if len(best) == self.top:
            self.enter[q] = max(-best[-1][0], 1)

    def take(self, batch: pa.RecordBatch) -> None:
        """Bounds of all rows, then exact scores by descending bound until none can enter."""
        docs, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        most = np.stack([self.bounds(k, s.as_py()) for k, s in zip(n, batch.column(2))])
        exact: dict[int, np.ndarray] = {}
        for q in np.flatnonzero((most >= self.enter).any(0)):
            rows = np.flatnonzero(most[:, q] >= self.enter[q])
            for i in rows[np.argsort(-most[rows, q], kind="stable")].tolist():
                if most[i, q] < self.enter[q]:
                    break
                if i not in exact:
                    exact[i] = self.impacts(n[i], batch.column(3)[i].as_py(), batch.column(4)[i].as_py())
                score = int(exact[i][self.at[q]] @ self.weights[q])
                if score >= self.enter[q]:
                    self.offer(q, score, docs[i])


STEPS = np.arange(MANY + 1, dtype=np.int64)


def block_best(index: DataFrame, queries: list[tuple[int, dict[bytes, int]]], n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(number, doc_id, score): each task's ``top`` documents for each query."""
    schema = T.StructType([T.StructField("number", T.LongType()), T.StructField("doc_id", index.schema["doc_id"].dataType), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, kind = Block(queries, n_docs, n_terms, top), None
        for batch in batches:
            kind = batch.schema.field(0).type
            for a in range(0, batch.num_rows, ROWS):
                block.take(batch.slice(a, ROWS))
        rows = [(number, None if null else doc, -score) for number, best in zip(block.numbers, block.best) for score, null, doc in best]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), kind, pa.int64()))], schema.names)

    return index.select("doc_id", "n", "sketch", "terms", "times").mapInArrow(run, schema)


def blocks(items: DataFrame, most: int) -> Iterator[list[tuple[int, list[bytes], list[int]]]]:
    """Items in turn, as many at once as have ``most`` terms (one at least)."""
    held, size = [], 0
    for r in items.select("number", "terms", "times").toLocalIterator():
        if held and size + len(r["terms"]) > most:
            yield held
            held, size = [], 0
        held.append((r["number"], [bytes(t) for t in r["terms"]], r["times"]))
        size += len(r["terms"])
    if held:
        yield held


def best_documents(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    top: int = TOP, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of score above 0 for each item.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased.
    A term weighs floor(1000 ln((2N + 2) / (2 df + 1))); a document of n terms scores the sum of
    weight * (10^9 tf div (1000 tf + 8 m)), m = 25 + 75 n N div L, over the item's terms with repeats.

    The index is stored once. Each pass over it answers a block of items: a task bounds the
    scores of its rows by their sketches and scores by descending bound until no bound reaches the
    worst of its best. Tasks hand on ``top`` rows for each item, so no row or term is a hot key.

    Null or empty texts have no terms: such documents are never found and don't count, such items
    give no row. Each row of either table stands for itself, repeated ids too; equal scores go by
    ascending id, null last. Texts are read whole; sketches of very many terms stop growing and
    only bound less well. Columns of any other name are ignored. Empty tables give no row.
    """
    index = durable(build_index(docs, doc_id, text), "ranked-index")
    wanted = item_terms(items, item_id, item_text)
    n_docs, n_terms = index.agg(F.count("*"), F.sum("n")).first()
    found = []
    for held in blocks(wanted, block_terms) if n_docs else ():
        df = document_frequencies(index, frozenset(t for _, terms, _ in held for t in terms))
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for t, k in df.items()}
        queries = [(number, {t: weight[t] * k for t, k in zip(terms, times) if weight.get(t)}) for number, terms, times in held]
        if queries := [(number, weights) for number, weights in queries if weights]:
            found.append(block_best(index, queries, n_docs, n_terms, top))
    empty = index.select(F.lit(0).cast("long").alias("number"), "doc_id", F.lit(0).cast("long").alias("score")).limit(0)
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, found, empty).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(wanted.select("number", "item_id"), "number").select("item_id", "rank", "doc_id", "score")
