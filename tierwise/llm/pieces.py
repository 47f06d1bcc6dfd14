"""SentencePiece BPE encoding by vectorised merge rounds, and decoding."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CHARS_AT_ONCE = 500_000
CACHED_WORDS = 200_000
ROUNDS = 200
NONE = np.iinfo(np.int64).max
# A long run of spaces is cut where its merges end: the longest piece of spaces only.
SPACES = 16
WORDS = re.compile(f" {{{SPACES}}}(?= )| {{0,{SPACES}}}[^ ]+| +")


class Pieces:
    """The tables of one model file, with a bounded cache of encoded words."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            spec = sentencepiece_model_pb2.ModelProto()
            spec.ParseFromString(file.read())
        normal = spec.normalizer_spec
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.add_dummy_prefix or spec.trainer_spec.model_type != 2:
            raise ValueError("only BPE models with identity normalisation and a dummy prefix are supported")
        model = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        size = model.get_piece_size()
        self.end = model.eos_id()
        self.size = size
        names = [model.id_to_piece(i) for i in range(size)]
        scores = np.array([model.get_score(i) for i in range(size)])
        byte = [model.is_byte(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) for i in range(size)]
        ids = {p: i for i, p in enumerate(names) if not byte[i] and not special[i]}
        if any(model.is_unused(i) for i in range(size)) or any(p.lstrip("▁").find("▁") >= 0 for p in ids):
            raise ValueError("unused pieces and pieces with inner spaces are not supported")

        self.byte_ids = np.zeros(256, np.int64)
        for i, b in enumerate(byte):
            if b:
                self.byte_ids[int(names[i][3:5], 16)] = i
        singles = sorted((ord(p), i) for p, i in ids.items() if len(p) == 1)
        self.chars = np.array([c for c, _ in singles])
        self.char_ids = np.array([i for _, i in singles])
        # Equal scores get equal ranks; better scores smaller ones.
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        pairs, calm = {}, np.ones(size, bool)
        for p, i in ids.items():
            for k in range(1, len(p)):
                a, b = ids.get(p[:k]), ids.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * size + b] = i
                    # A merge that may open an earlier-ranked pair is done one at a time.
                    for part in (a, b):
                        if self.rank[part] >= self.rank[i]:
                            calm[part] = False
        self.pair_table = pairs
        # Pairs by hash; a sparse table, so that nearly all are found at their first slot.
        self.slots = 1 << int(np.ceil(np.log2(16 * max(len(pairs), 1))))
        self.slot_keys, self.slot_ids = np.full(self.slots, -1, np.int64), np.full(self.slots, -1, np.int32)
        for key, i in pairs.items():
            at = int(self.slot(np.int64(key)))
            while self.slot_keys[at] >= 0:
                at = (at + 1) % self.slots
            self.slot_keys[at], self.slot_ids[at] = key, i
        self.calm = calm

        self.surface = [
            b"" if special[i] and not model.is_unknown(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in range(size)
        ]
        self.is_byte, self.is_control = np.array(byte), np.array([model.is_control(i) for i in range(size)])
        for i in range(size):
            if byte[i]:
                self.surface[i] = bytes([int(names[i][3:5], 16)])
            elif model.is_unknown(i):
                self.surface[i] = spec.trainer_spec.unk_surface.encode()
        self.leads = np.array([not byte[i] and not special[i] and names[i][0] == "▁" for i in range(size)])
        self.lengths = np.array([len(s) for s in self.surface], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.surface), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.words: dict[str, int] = {}
        self.pool, self.word_start, self.word_length = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def slot(self, key):
        return (key ^ (key >> 15) * 40503) & (self.slots - 1)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        key = left * self.size + right
        key[(left < 0) | (right < 0)] = -2
        at = self.slot(key)
        held = self.slot_keys[at]
        out = np.where(held == key, self.slot_ids[at], np.int32(-1))
        late = np.flatnonzero((held != key) & (held >= 0))
        while len(late):
            at[late] = (at[late] + 1) & (self.slots - 1)
            held = self.slot_keys[at[late]]
            out[late] = np.where(held == key[late], self.slot_ids[at[late]], -1)
            late = late[(held != key[late]) & (held >= 0)]
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        points[points == 32] = 0x2581
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        at = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        symbol = np.where(self.chars[at] == points, self.char_ids[at], -1 - points)
        done_symbol, done_owner = [], []
        rounds = 0
        while len(symbol):
            made = np.full(len(symbol), -1)
            inside = owner[:-1] == owner[1:]
            made[:-1] = np.where(inside, self.merged(symbol[:-1], symbol[1:]), -1)
            rank = np.where(made >= 0, self.rank[made], NONE)
            starts = np.flatnonzero(np.concatenate([[True], ~inside]))
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.concatenate([starts, [len(symbol)]]))
            open_ = np.repeat(lowest != NONE, sizes)
            # Compaction: words without a pair are done.
            if not open_.all():
                done_symbol.append(symbol[~open_])
                done_owner.append(owner[~open_])
                symbol, owner, made, rank = symbol[open_], owner[open_], made[open_], rank[open_]
                lowest, sizes = lowest[lowest != NONE], sizes[lowest != NONE]
                if not len(symbol):
                    break
            if rounds >= ROUNDS:
                self.finish_alone(symbol, owner, done_symbol, done_owner)
                break
            rounds += 1
            best = np.flatnonzero(rank == np.repeat(lowest, sizes))
            first = np.concatenate([[True], owner[best[1:]] != owner[best[:-1]]])
            fresh = np.concatenate([[True], best[1:] != best[:-1] + 1])
            # In a row of overlapping equal pairs every second one merges, from the left.
            index = np.arange(len(best))
            run = index - np.maximum.accumulate(np.where(fresh, index, 0))
            take = best[first | (self.calm[made[best]] & self.calm[made[best[np.maximum.accumulate(np.where(first, index, 0))]]] & (run % 2 == 0))]
            symbol = symbol.copy()
            symbol[take] = made[take]
            keep = np.ones(len(symbol), bool)
            keep[take + 1] = False
            symbol, owner = symbol[keep], owner[keep]
        symbols, owners = np.concatenate([*done_symbol, np.empty(0, np.int64)]), np.concatenate([*done_owner, np.empty(0, np.int64)])
        order = np.argsort(owners, kind="stable")
        symbols, owners = symbols[order].astype(np.int64), owners[order].astype(np.int64)
        return self.spell(symbols, owners, len(words))

    def finish_alone(self, symbol, owner, done_symbol, done_owner) -> None:
        """The few words with very many merges one by one: best pair first, leftmost of equals."""
        cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1], [True]]))
        for a, b in zip(cuts[:-1], cuts[1:]):
            part, n = symbol[a:b].tolist(), b - a
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            queue: list = []

            def offer(i: int) -> None:
                j = after[i] if i >= 0 else n
                if j < n and part[i] >= 0 and part[j] >= 0:
                    new = self.pair_table.get(part[i] * self.size + part[j])
                    if new is not None:
                        heapq.heappush(queue, (int(self.rank[new]), i, part[i], part[j], new))

            for i in range(n - 1):
                offer(i)
            while queue:
                _, i, x, y, new = heapq.heappop(queue)
                j = after[i]
                if part[i] != x or j >= n or part[j] != y:
                    continue
                part[i], part[j] = new, None
                after[i] = after[j]
                if after[j] < n:
                    before[after[j]] = i
                offer(before[i])
                offer(i)
            left = [p for p in part if p is not None]
            done_symbol.append(np.array(left, np.int64))
            done_owner.append(np.full(len(left), owner[a]))

    def spell(self, symbol: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters outside the vocabulary become the pieces of their UTF-8 bytes."""
        odd = np.flatnonzero(symbol < 0)
        if len(odd):
            coded = [list(chr(-1 - s).encode()) for s in symbol[odd].tolist()]
            times = np.ones(len(symbol), np.int64)
            times[odd] = [len(c) for c in coded]
            where = np.repeat(np.arange(len(symbol)), times)
            wide, owner = symbol[where], owner[where]
            wide[wide < 0] = self.byte_ids[np.array([b for c in coded for b in c])]
            symbol = wide
        return symbol.astype(np.int32), np.bincount(owner, minlength=n)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each text's with the end id last, and how many each has."""
        split = [WORDS.findall(" " + t.replace("▁", " ")) if t else [] for t in texts]
        if len(self.words) > CACHED_WORDS:
            self.forget()
        known = self.words
        new = list(set().union(*split).difference(known))
        if new:
            ids, sizes = self.encode_words(new)
            begin = len(self.pool) + np.cumsum(sizes) - sizes
            for k, w in enumerate(new, len(known)):
                known[w] = k
            self.pool = np.concatenate([self.pool, ids])
            self.word_start, self.word_length = np.concatenate([self.word_start, begin]), np.concatenate([self.word_length, sizes])
        counts = np.array([len(p) for p in split], np.int64)
        codes = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        sizes = self.word_length[codes]
        ends = np.cumsum(sizes)
        flat = self.pool[np.repeat(self.word_start[codes] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
        per_text = np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])])
        flat = np.insert(flat, np.cumsum(per_text), self.end)
        return flat.astype(np.int32), per_text + 1

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of id lists that lie in a row."""
        ids = ids.astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("an id lies outside the vocabulary")
        sizes = self.lengths[ids].copy()
        begin = self.offsets[ids].copy()
        # The dummy space goes: of the first piece that is no control id.
        text_of = np.repeat(np.arange(len(counts)), counts)
        real = np.flatnonzero(~self.is_control[ids])
        first = real[np.concatenate([[True], text_of[real[1:]] != text_of[real[:-1]]])] if len(real) else real
        first = first[self.leads[ids[first]]]
        begin[first] += 1
        sizes[first] -= 1
        ends = np.cumsum(sizes)
        raw = self.flat[np.repeat(begin - (ends - sizes), sizes) + np.arange(int(sizes.sum()))].tobytes()
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        out = []
        last = np.concatenate([[0], np.cumsum(counts)]).tolist()
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            try:
                out.append(raw[a:b].decode())
            except UnicodeDecodeError:
                out.append(self.mend(ids[last[k] : last[k + 1]], raw[a:b], sizes[last[k] : last[k + 1]]))
        return out

    def mend(self, ids: np.ndarray, raw: bytes, sizes: np.ndarray) -> str:
        """Runs of byte pieces on their own; each byte that fits no character becomes U+FFFD."""
        out, at, run = [], 0, b""
        for i, n in zip(ids.tolist(), sizes.tolist()):
            part, at = raw[at : at + n], at + n
            if self.is_byte[i]:
                run += part
                continue
            out.append(lenient(run))
            run = b""
            out.append(part.decode())
        return "".join([*out, lenient(run)])


def lenient(run: bytes) -> str:
    out = []
    while run:
        for n in (1, 2, 3, 4):
            try:
                out.append(run[:n].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            n = 1
            out.append("�")
        run = run[n:]
    return "".join(out)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def parts(column: pa.Array, most: int = CHARS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column of about ``most`` bytes each (one text at least)."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    at = 0
    total = np.cumsum(sizes)
    while at < len(sizes):
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + most, side="right")))
        yield at, to
        at = to


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with ``ids``: the pieces of each whole text and the end id (null text: as empty).

    Exactly as the sentencepiece library does without sampling. With ``decoded``, also what the
    ids decode to, in the same pass. Columns already so named are replaced.
    """
    docs = docs.drop(*[c for c in (ids, decoded) if c])
    added = [T.StructField(ids, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded, T.StringType())] if decoded else [])
    schema = T.StructType([*docs.schema.fields, *added])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            column = batch.schema.get_field_index(text)
            for a, b in parts(batch.column(column)):
                piece = batch.slice(a, b - a)
                flat, counts = model.encode(piece.column(column).to_pylist())
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), pa.array(flat, pa.int32()))
                back = [pa.array(model.decode(flat, counts), pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays([*piece.columns, lists, *back], names)

    return docs.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with ``text`` decoded from ``ids`` (null ids: empty); a column already so named is replaced."""
    df = df.drop(text)
    schema = T.StructType([*df.schema.fields, T.StructField(text, T.StringType())])
    names = [*df.columns, text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            column = batch.schema.get_field_index(ids)
            for a in range(0, batch.num_rows, 256):
                piece = batch.slice(a, 256)
                lists = piece.column(column)
                counts = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                texts = model.decode(lists.flatten().to_numpy(zero_copy_only=False), counts)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(texts, pa.string())], names)

    return df.mapInArrow(run, schema)
