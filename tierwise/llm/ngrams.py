"""Stupid-backoff scores of documents under the n-gram counts of all other documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.common import words

ORDER = 2
BACKOFF = 0.4
# Characters of a block of documents that one task holds, and n-grams of one part of the count table.
BLOCK_CHARS = 12_000_000
PART_GRAMS = 2_000_000
CACHED_WORDS = 1_000_000

_known: dict[bytes, int] = {}


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word (ASCII letters lower-cased)."""
    parts = (text or "").encode().lower().split()
    if len(_known) > CACHED_WORDS:
        _known.clear()
    for w in set(parts).difference(_known):
        _known[w] = xxhash.xxh64_intdigest(w, 7)
    return np.fromiter(map(_known.__getitem__, parts), np.uint64, len(parts))


def stir(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def gram_hashes(texts: list[str | None], order: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Word counts of the texts; per n the hashes of n-grams that end at each word, and which words have one."""
    each = [word_hashes(t) for t in texts]
    sizes = np.array([len(e) for e in each], np.int64)
    flat = np.concatenate([*each, np.empty(0, np.uint64)])
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    grams, ends = [stir(flat)], [np.arange(len(flat))]
    for n in range(2, order + 1):
        at = np.flatnonzero(place >= n - 1)
        before = np.empty(len(flat), np.uint64)
        before[ends[-1]] = grams[-1]
        grams.append(stir(before[at - 1] * np.uint64(0xC2B2AE3D27D4EB4F) + flat[at] + np.uint64(n)))
        ends.append(at)
    return sizes, grams, ends


def scores(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """(doc_id, n_words, log_score, n_seen): one row per row of ``documents``.

    Each word scores c(n-gram) / c(its context) for the longest n-gram up to ``order`` that the
    other documents hold, times ``backoff`` for each order given up; a word they lack counts as one in
    all their words and one. ``log_score`` sums the natural logarithms, ``n_seen`` counts the words whose n-gram
    of full available order was found. A text without words scores 0. Counts cover all documents but
    the scored one, so copies of it do count; hash collisions of 64 bits are ignored.

    Documents lie in blocks of bounded size. A block asks for each different n-gram once; requests meet
    in the parts of the count table by hash, where a frequent n-gram has one entry per block at
    most, and the totals go back to the blocks.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    chars, total = rows.agg(F.sum(F.length("text")), F.sum(F.size(words(F.col("text"))))).first()
    chars, total = chars or 0, total or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    bits = max(1, int(np.ceil(np.log2(max(2, total * order / PART_GRAMS)))))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    def ask(part: pa.Table) -> pa.Table:
        block = part.column("block")[0].as_py()
        _, grams, _ = gram_hashes(part.column("text").to_pylist(), order)
        held, counts = np.unique(np.concatenate(grams), return_counts=True)
        home = (held >> np.uint64(64 - bits)).astype(np.int64)
        homes, starts = np.unique(home, return_index=True)
        edges = np.append(starts, len(held)).astype(np.int32)
        return pa.table(
            {
                "part": pa.array(homes),
                "block": pa.array(np.full(len(homes), block, np.int32)),
                "grams": pa.ListArray.from_arrays(edges, pa.array(held.view(np.int64))),
                "counts": pa.ListArray.from_arrays(edges, pa.array(counts.astype(np.int32))),
            }
        )

    def answer(part: pa.Table) -> pa.Table:
        lists = part.column("grams").combine_chunks()
        grams = lists.flatten().to_numpy()
        counts = part.column("counts").combine_chunks().flatten().to_numpy()
        _, at = np.unique(grams, return_inverse=True)
        totals = np.bincount(at, weights=counts).astype(np.int64)[at] if len(at) else np.empty(0, np.int64)
        sizes = lists.value_lengths().to_numpy()
        edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.table({"block": part.column("block"), "part": part.column("part"), "totals": pa.ListArray.from_arrays(edges, pa.array(totals))})

    def score(docs: pa.Table, found: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array([], pa.int64()), "log_score": pa.array([], pa.float64()), "n_seen": pa.array([], pa.int64())})
        sizes, grams, ends = gram_hashes(docs.column("text").to_pylist(), order)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        held, at = np.unique(np.concatenate(grams), return_inverse=True)
        found = found.sort_by("part")
        totals = found.column("totals").combine_chunks().flatten().to_numpy() if found.num_rows else np.empty(0, np.int64)
        own = at + np.concatenate([owner[e] for e in ends]) * max(len(held), 1)
        _, same, times = np.unique(own, return_inverse=True, return_counts=True)
        elsewhere = totals[at] - times[same]
        value = np.full(len(owner), -1.0)
        reach = np.minimum(np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1, order)
        seen = np.zeros(len(owner), bool)
        others = (total - sizes)[owner].astype(float)
        edges = np.concatenate([[0], np.cumsum([len(g) for g in grams])])
        by_end = []
        for n in range(order):
            wide = np.zeros(len(owner), np.int64)
            wide[ends[n]] = elsewhere[edges[n] : edges[n + 1]]
            by_end.append(wide)
        for n in range(order, 0, -1):
            here = (value < 0) & (reach >= n) & (by_end[n - 1] > 0)
            where = np.flatnonzero(here)
            below = by_end[n - 2][where - 1] if n > 1 else others[where]
            value[where] = backoff ** (reach[where] - n) * by_end[n - 1][where] / below
            seen[where] = reach[where] == n
        lost = value < 0
        value[lost] = backoff ** (reach[lost] - 1) / (others[lost] + 1)
        logs = np.bincount(owner, weights=np.log(value), minlength=len(sizes))
        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "n_words": pa.array(sizes),
                "log_score": pa.array(logs.astype(np.float64)),
                "n_seen": pa.array(np.bincount(owner, weights=seen, minlength=len(sizes)).astype(np.int64)),
            }
        )

    asked = dealt.groupBy("block").applyInArrow(ask, "part bigint, block int, grams array<bigint>, counts array<int>")
    answers = asked.groupBy("part").applyInArrow(answer, "block int, part bigint, totals array<bigint>")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, f"doc_id {kind}, n_words bigint, log_score double, n_seen bigint"
    )
