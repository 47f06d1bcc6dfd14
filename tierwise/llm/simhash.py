"""SimHash near-dedup: majority fingerprints, linked through a vantage-point tree over their Hamming distances."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.llm.components import components
from tierwise.operators.lookup import lookup
from tierwise.runtime import durable

SHINGLE = 3
SEED = 42
MAX_BITS = 2
LEAF = 1000
SAMPLE = 16384
MAX_DEPTH = 11
BLOCK = 20000
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit majority of the XXH64 of all word shingles; zero without words."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    solid = b" ".join(parts)
    if len(parts) <= shingle:
        return xxhash.xxh64_intdigest(solid, SEED)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[: -shingle] + 1]).tolist()
    ends = ends[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for k in range(0, len(ends), HASHES_AT_ONCE):
        some = [digest(solid[a:b], SEED) for a, b in zip(starts[k : k + HASHES_AT_ONCE], ends[k : k + HASHES_AT_ONCE])]
        bits = np.unpackbits(np.array(some, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(ends), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp): one row per document, ``fp`` the fingerprint as a signed 64-bit number."""

    @F.pandas_udf("bigint")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.select(F.col(doc_id).alias("doc_id"), simhash(F.col(text)).alias("fp"))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def plant(sample: np.ndarray, depth: int, first: int = 0) -> tuple | int:
    """A vantage-point tree of the sample: (vantage, radius, inside, outside) or a shard's number."""
    if depth == 0 or len(sample) < 2:
        return first
    vantage = sample[0]
    far = distance(sample, vantage)
    radius = int(np.median(far))
    inside = far <= radius
    if inside.all():
        return first
    half = 1 << (depth - 1)
    return (
        int(vantage),
        radius,
        plant(sample[inside][::-1], depth - 1, first),
        plant(sample[~inside], depth - 1, first + half),
    )


def route(tree, fps: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, indices of visitors, whether each lives there) of all shards within ``reach``.

    A branch is skipped when the triangle inequality puts all its members farther than ``reach``.
    """
    todo = [(tree, np.arange(len(fps)), np.ones(len(fps), bool))]
    while todo:
        node, who, home = todo.pop()
        if not len(who):
            continue
        if isinstance(node, int):
            yield node, who, home
            continue
        vantage, radius, inside, outside = node
        far = distance(fps[who], np.int64(vantage)).astype(np.int16)
        near = far <= radius + reach
        todo.append((inside, who[near], home[near] & (far[near] <= radius)))
        away = far > radius - reach
        todo.append((outside, who[away], home[away] & (far[away] > radius)))


def close_pairs(visitors: np.ndarray, members: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (visitor, member) at most ``reach`` bits apart, ring by ring around one vantage."""
    if not len(visitors) or not len(members):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    vantage = members[len(members) // 2]
    ring_v, ring_m = distance(visitors, vantage), distance(members, vantage)
    order_v, order_m = np.argsort(ring_v, kind="stable"), np.argsort(ring_m, kind="stable")
    sorted_v, sorted_m = visitors[order_v], members[order_m]
    cut_v = np.searchsorted(ring_v[order_v], np.arange(66))
    cut_m = np.searchsorted(ring_m[order_m], np.arange(-reach, 66 + reach))
    left, right = [], []
    for d in range(65):
        a, b = cut_v[d], cut_v[d + 1]
        c, e = cut_m[d], cut_m[d + 2 * reach + 1]
        if a == b or c == e:
            continue
        step = max(1, 2_000_000 // (e - c))
        for k in range(a, b, step):
            block = sorted_v[k : min(k + step, b)]
            i, j = np.nonzero(distance(block[:, None], sorted_m[None, c:e]) <= reach)
            left.append(order_v[k + i])
            right.append(order_m[c + j])
    empty = [np.empty(0, np.int64)]
    return np.concatenate(left or empty), np.concatenate(right or empty)


def smallest_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 with links a-b, a common node of each connected part."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def links(unique: DataFrame, reach: int = MAX_BITS, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints ``reach`` or fewer bits apart.

    ``unique`` has distinct ``fp`` and is stored. The tree is planted on a bounded sample on the
    driver; every fingerprint lives in one shard and visits all shards that the triangle bounds
    leave open. A shard of more than ``block`` members or visitors is compared block by block in
    several tasks. Within a task links are reduced to one per fingerprint and part.
    """
    total = unique.count()
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(max(total, 1) / leaf)))))
    sample = unique.orderBy(F.xxhash64("fp")).limit(SAMPLE).toPandas()["fp"].to_numpy(np.int64)
    tree = plant(sample, depth)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for shard, who, home in route(tree, fps, reach):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(who), shard, np.int32)), pa.array(fps[who]), pa.array(home)], ["shard", "fp", "home"]
                )

    sent = durable(unique.select("fp").mapInArrow(send, "shard int, fp bigint, home boolean"), "vp-visits")
    sizes = sent.groupBy("shard").agg(F.sum(F.col("home").cast("long")).alias("members"), F.count("*").alias("visitors"))
    # One row per shard, at most 2 ** MAX_DEPTH of them.
    parted = F.col("visitors") > block
    blocks = sizes.select(
        "shard",
        F.when(parted, F.ceil(F.col("members") / block)).otherwise(1).cast("int").alias("rows"),
        F.when(parted, F.ceil(F.col("visitors") / block)).otherwise(1).cast("int").alias("columns"),
    )
    sent = sent.join(F.broadcast(blocks), "shard")
    rows, columns = F.greatest("rows", F.lit(1)), F.col("columns")
    spread = F.xxhash64(F.lit("block"), "fp")
    visits = sent.select(
        "shard", "fp", F.lit(False).alias("member"),
        F.explode(F.sequence(F.lit(0), rows - 1)).alias("m"), F.pmod(spread, columns).cast("int").alias("v"),
    )
    living = sent.where("home").select(
        "shard", "fp", F.lit(True).alias("member"),
        F.pmod(spread, rows).cast("int").alias("m"), F.explode(F.sequence(F.lit(0), columns - 1)).alias("v"),
    )

    def match(part: pa.Table) -> pa.Table:
        fps = part.column("fp").to_numpy()
        member = part.column("member").to_numpy()
        nodes, at = np.unique(fps, return_inverse=True)
        visitors, members = at[~member], at[member]
        i, j = close_pairs(nodes[visitors], nodes[members], reach)
        label = smallest_linked(len(nodes), visitors[i], members[j])
        linked = np.flatnonzero(label != np.arange(len(nodes)))
        return pa.table({"a": nodes[linked], "b": nodes[label[linked]]})

    return visits.unionByName(living).groupBy("shard", "m", "v").applyInArrow(match, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    Documents link when their fingerprints differ in ``reach`` or fewer bits; ``component_id`` is
    the smallest doc_id reachable. Texts without words (null, empty) have fingerprint zero and
    link like others. A null doc_id never names a component unless all its members lack one.
    """
    held = durable(fingerprints(docs, doc_id, text), "fingerprints")
    unique = durable(held.groupBy("fp").agg(F.min("doc_id").alias("first")), "unique-fingerprints")
    parts = components(links(unique, reach))
    labelled = unique.join(parts, unique["fp"] == parts["node"], "left").select(
        unique["fp"], "first", F.coalesce("root", unique["fp"]).alias("root")
    )
    named = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    table = labelled.join(named, "root").select("fp", "component_id")
    table = durable(table.select("fp", F.lit(1).alias("n"), "component_id"), "fingerprint-components")
    return lookup(held, table, "fp", "n", spread="doc_id").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
