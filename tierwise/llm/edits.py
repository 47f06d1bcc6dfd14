"""Token counts that follow edits: a segment tree over the pre-tokens of each document."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAF = 32
PARTS = re.compile(r"(?s:.{160,}?[A-Za-z](?= [A-Za-z])|.+)")
LONG_PART = 1000
# Code points before an edit that its new neighbours can still change: a pre-token looks one
# code point past a run of spaces that it leaves by one, and two past an apostrophe.
CONTEXT = 3
CACHED = 500_000
TEXTS_AT_ONCE = 256


class Counter:
    """Pre-tokens of a text and the number of tokens of each."""

    def __init__(self, ranks: str, pattern: str):
        import regex
        import tiktoken

        with open(ranks, "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        self.coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def learn(self, pieces) -> None:
        if len(self.known) >= CACHED:
            self.known.clear()
        for piece in set(pieces).difference(self.known):
            self.known[piece] = len(self.coder.encode_ordinary(piece))

    def count(self, piece: str) -> int:
        if piece not in self.known:
            self.learn([piece])
        return self.known[piece]

    def leaves(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Code points and tokens of each leaf.

        A space between two letters always begins a pre-token, so a text is cut at such spaces and
        each part encoded on its own; a part without one for long is cut at its pre-tokens.
        """
        sizes, counts = [], []
        for part in PARTS.findall(text):
            if len(part) <= LONG_PART:
                sizes.append(len(part))
                counts.append(len(self.coder.encode_ordinary(part)))
                continue
            pieces = self.pattern.findall(part)
            self.learn(pieces)
            for k in range(0, len(pieces), LEAF):
                sizes.append(sum(map(len, pieces[k : k + LEAF])))
                counts.append(sum(map(self.known.__getitem__, pieces[k : k + LEAF])))
        return np.array(sizes, np.int64), np.array(counts, np.int64)


@lru_cache(maxsize=2)
def counter(ranks: str, pattern: str) -> Counter:
    return Counter(ranks, pattern)


class TokenTree:
    """Sums of code points and tokens over the leaves of one text; edits touch few leaves."""

    def __init__(self, text: str, sizes: np.ndarray, counts: np.ndarray, coder: Counter):
        self.text, self.coder, self.reencoded = text, coder, 0
        self.plant(list(sizes), list(counts))

    def plant(self, sizes: list[int], counts: list[int]) -> None:
        self.width = 1 << max(0, (len(sizes) - 1).bit_length())
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        self.chars[self.width : self.width + len(sizes)] = map(int, sizes)
        self.tokens[self.width : self.width + len(counts)] = map(int, counts)
        for i in range(self.width - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def put(self, leaf: int, size: int, count: int) -> None:
        i = leaf + self.width
        self.chars[i], self.tokens[i] = size, count
        while i > 1:
            i //= 2
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds a code point, and where the leaf starts."""
        i, start = 1, 0
        while i < self.width:
            i *= 2
            if position - start >= self.chars[i]:
                start += self.chars[i]
                i += 1
        return i - self.width, start

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace code points start to end (clipped to the text) and re-encode around them."""
        old = len(self.text)
        start = min(max(start, 0), old)
        end = min(max(end, start), old)
        self.text = self.text[:start] + new + self.text[end:]
        shift, safe = len(new) - (end - start), start + len(new)
        leaf, at = self.find(min(max(start - CONTEXT, 0), max(old - 1, 0))) if old else (0, 0)
        first, begin = leaf, at
        # Walk old leaf ends and new pre-token ends until they meet beyond the edit.
        sizes, counts, size, count, held = [], [], 0, 0, 0
        position = begin
        border = begin
        stop = None
        for m in self.coder.pattern.finditer(self.text, begin):
            while border + shift < position or border < end:
                if leaf >= self.width:
                    break
                border += self.chars[self.width + leaf]
                leaf += 1
            if position >= safe and border >= end and border + shift == position and (position > begin or shift == 0 and start == end and not new):
                stop = position
                break
            piece = m[0]
            position = m.end()
            size, count, held = size + len(piece), count + self.coder.count(piece), held + 1
            if held == LEAF:
                sizes.append(size)
                counts.append(count)
                size = count = held = 0
        if held:
            sizes.append(size)
            counts.append(count)
        last = leaf if stop is not None else self.width
        self.reencoded += sum(sizes)
        slots = last - first
        if len(sizes) <= slots:
            pad = slots - len(sizes)
            for k, (s, c) in enumerate(zip(sizes + [0] * pad, counts + [0] * pad)):
                if self.chars[self.width + first + k] != s or self.tokens[self.width + first + k] != c:
                    self.put(first + k, s, c)
            return
        kept = [(s, c) for s, c in zip(self.chars[self.width :], self.tokens[self.width :])]
        merged = [*kept[:first], *zip(sizes, counts), *kept[last:]]
        merged = [x for x in merged if x[0]]
        self.plant([s for s, _ in merged], [c for _, c in merged])

    def leaves(self) -> tuple[list[int], list[int]]:
        pairs = [(s, c) for s, c in zip(self.chars[self.width :], self.tokens[self.width :]) if s]
        return [s for s, _ in pairs], [c for _, c in pairs]


def build(docs: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with its tree: ``leaf_chars``, ``leaf_tokens`` (arrays) and ``n_tokens``.

    A null text counts as empty: no leaves, no tokens. Columns of these names are replaced.
    """
    docs = docs.drop("leaf_chars", "leaf_tokens", "n_tokens")
    numbers = T.ArrayType(T.LongType())
    schema = T.StructType(
        [*docs.schema.fields, T.StructField("leaf_chars", numbers), T.StructField("leaf_tokens", numbers), T.StructField("n_tokens", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = counter(ranks, pattern)
        for whole in batches:
            for k in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(k, TEXTS_AT_ONCE)
                found = [coder.leaves(t or "") for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
                added = [
                    pa.array([s for s, _ in found], pa.list_(pa.int64())),
                    pa.array([c for _, c in found], pa.list_(pa.int64())),
                    pa.array([int(c.sum()) for _, c in found], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], schema.names)

    return docs.mapInArrow(run, schema)


def with_edits(trees: DataFrame, edits: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``trees`` with the ``edits`` (doc_id, step, start, end, new) of each document, in order of step."""
    each = edits.groupBy(F.col(doc_id).alias("__edited")).agg(F.array_sort(F.collect_list(F.struct("step", "start", "end", "new"))).alias("edits"))
    return trees.drop("edits").join(each, F.col(doc_id).eqNullSafe(F.col("__edited")), "left").drop("__edited")


def apply_edits(trees: DataFrame, ranks: str, pattern: str, text: str = "text") -> DataFrame:
    """``trees`` after their ``edits`` (array of structs start, end, new), one after the other.

    Positions are code points of the text as it stands before each edit and are clipped to it;
    null parts mean 0, 0 and ''. ``text``, leaves and ``n_tokens`` are replaced; ``n_reencoded`` is the number of
    code points that were encoded again. No edits: nothing changes.
    """
    trees = trees.drop("n_reencoded")
    kept = [f for f in trees.schema.fields if f.name != "edits"]
    schema = T.StructType([*kept, T.StructField("n_reencoded", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = counter(ranks, pattern)
        for whole in batches:
            for k in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(k, TEXTS_AT_ONCE)
                rows = {n: batch.column(batch.schema.get_field_index(n)) for n in batch.schema.names}
                texts, chars, tokens, totals, again = [], [], [], [], []
                for t, s, c, changes in zip(*(rows[n].to_pylist() for n in (text, "leaf_chars", "leaf_tokens", "edits"))):
                    tree = TokenTree(t or "", s or [], c or [], coder)
                    for e in changes or []:
                        tree.edit(e["start"] or 0, e["end"] or 0, e["new"] or "")
                    sizes, counts = tree.leaves()
                    texts.append(tree.text if changes else t)
                    chars.append(sizes)
                    tokens.append(counts)
                    totals.append(tree.total)
                    again.append(tree.reencoded)
                numbers = pa.list_(pa.int64())
                rows |= {
                    text: pa.array(texts, pa.string()), "leaf_chars": pa.array(chars, numbers), "leaf_tokens": pa.array(tokens, numbers),
                    "n_tokens": pa.array(totals, pa.int64()), "n_reencoded": pa.array(again, pa.int64()),
                }
                yield pa.RecordBatch.from_arrays([rows[n] for n in schema.names], schema.names)

    return trees.mapInArrow(run, schema)
