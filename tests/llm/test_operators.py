"""Text operators beside brute-force versions, on small fixtures with awkward rows."""

import base64
import collections
import hashlib
import itertools
import json
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from conftest import SMALL
from tierwise.llm import edits, linededup, mixing, ngrams, passages, pieces, quality, secrets, simhash, spotsigs
from tierwise.llm.queries import QUERIES, piece_model

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def prose(seed, n):
    rng = random.Random(seed)
    return [rng.choice(["the", "of", "and"]) if rng.random() < 0.2 else "w%d" % rng.randint(0, 4000) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    long = " ".join(prose(1, 4000))
    lines = ["\n".join(" ".join(prose(k * 10 + j, 12)) for j in range(6)) for k in range(2, 8)]
    shared = " ".join(prose(99, 60))
    texts = [
        None, "", " \n\t ", "one", "a b", "A b", long, long, long + " tail", *lines, lines[0], lines[1] + "\n" + lines[2],
        " ".join(prose(50, 80)) + " " + shared + " " + " ".join(prose(51, 80)),
        " ".join(prose(52, 30)) + " " + shared + " " + " ".join(prose(53, 90)),
        "x x x x x x x x x x x x", "same line here\nsame line here\n\nsame line here\nother", "é日本 😀 <s> </s> ▁ \x00", " " * 50 + "z" * 300,
    ]
    out = [(i, t, "en", None if i == 3 else f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return out + [out[5], (None, "no id", "en", "src0", 5)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_fingerprint(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = np.array([xxhash.xxh64_intdigest(g.encode(), 42) for g in grams], dtype=np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))


def brute_components(ids, prints, reach=2):
    name = list(range(len(ids)))
    for _ in ids:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= reach:
                    name[i] = name[j] = min(name[i], name[j])
    groups = collections.defaultdict(list)
    for n, i in zip(name, ids):
        groups[n].append(i)
    return [min((i for i in groups[n] if i is not None), default=None) for n in name]


def test_simhash_equals_brute_force(docs, rows):
    want = [brute_fingerprint(r[1]) for r in rows]
    parts = brute_components([r[0] for r in rows], want)
    got = simhash.near_duplicates(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((r[0], f"{f:016x}", c) for r, f, c in zip(rows, want, parts)), key=str)


def test_tree_finds_every_close_pair():
    rng = np.random.default_rng(4)
    base = rng.integers(-(2**63), 2**63, 900)
    near = [x ^ (np.int64(1) << np.int64(rng.integers(0, 63))) ^ (np.int64(1) << np.int64(rng.integers(0, 63))) for x in base]
    fps = np.unique(np.concatenate([base, near]))
    want = set()
    for i, a in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count((fps[i + 1 :] ^ a).view(np.uint64)) <= 2):
            want.add((int(a), int(fps[i + 1 + j])))
    tree = simhash.plant(fps, 4)
    found = set()
    homes = 0
    for _, who, home in simhash.route(tree, fps, 2):
        homes += home.sum()
        i, j = simhash.close_pairs(fps[who], fps[who[home]], 2)
        for a, b in zip(fps[who][i].tolist(), fps[who[home]][j].tolist()):
            if a != b:
                found.add((min(a, b), max(a, b)))
    assert homes == len(fps)
    assert found == want


def test_links_in_blocks_are_the_same(spark):
    rng = random.Random(2)
    core = [rng.getrandbits(63) for _ in range(40)]
    fps = sorted({c ^ (1 << rng.randrange(60)) for c in core for _ in range(20)})
    unique = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    whole = simhash.components(simhash.links(unique, leaf=100)).collect()
    split = simhash.components(simhash.links(unique, leaf=100, block=40)).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, split)) and len(whole) == len(fps)


def test_pieces_equal_the_library(docs, rows):
    import sentencepiece

    path = piece_model()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = pieces.decode(pieces.encode(docs, path), path).select("text", "ids", "decoded").collect()
    assert len(got) == len(rows)
    for text, ids, decoded in got:
        want = library.encode(text or "", add_eos=True)
        assert ids == want and decoded == library.decode(want)
    once = pieces.encode(docs, path, decoded="decoded").select("text", "ids", "decoded").collect()
    assert sorted(map(str, once)) == sorted(map(str, got))


def test_pieces_odd_texts_and_ids():
    import sentencepiece

    model = pieces.Pieces(piece_model())
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    rng = random.Random(1)
    letters = ["a", "b", " ", "  ", "the", "ing", "▁", "日", "é", "\n", "1", "</s>", "<0x0A>", "\x00", "😀", " " * 17, " " * 40, "=="]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    texts += ["a" * 5000, "ab" * 3000, " " * 300, "=" * 4000, "日本語" * 800]
    ids, counts = model.encode(texts)
    edges = np.cumsum(counts) - counts
    for text, a, n in zip(texts, edges, counts):
        assert ids[a : a + n].tolist() == library.encode(text, add_eos=True)
    for _ in range(500):
        some = [rng.choice([rng.randrange(32000), rng.randrange(262)]) for _ in range(rng.randint(1, 9))]
        assert model.decode(np.array(some), np.array([len(some)])) == [library.decode(some)]


def brute_quality(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count = collections.Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(5)}
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for x in w for c in x), len(lines) - len(set(lines)), len(hit), failed


def test_quality_equals_brute_force(docs, rows):
    got = quality.quality(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    have = sorted(((r.doc_id, *[r[n] for n in names]) for r in got), key=str)
    assert have == sorted(((r[0], *brute_quality(r[1])) for r in rows), key=str)
    assert all(r.kept == (not r.base_failed) for r in got)


def test_frequent_lines_reject_depleted_texts_but_keep_their_first(spark):
    spam = "buy this now and never look back at anything again"
    other = "twice the offer for half the price only until tomorrow"
    texts = [f"{spam}\n{other}\nown {i}" for i in range(40)] + [" ".join(prose(i, 40)) for i in range(40)]
    docs = spark.createDataFrame([(i, t, "en", "h", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in quality.quality(docs, min_documents=5, max_share=0.05).collect()}
    assert got[0].kept and not any(got[i].kept or got[i].base_failed for i in range(1, 40)) and all(got[i].kept for i in range(40, 80))
    kept = quality.keep_good(docs, min_documents=5, max_share=0.05)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i].kept}


def brute_lines(rows, n=3, words=50):
    order = sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for doc_id, text in order:
        lines = text.split("\n")
        solid = [i for i, x in enumerate(lines) if x.strip(" \t\x0b\f\r")]
        gone = set()
        for s in range(len(solid)):
            size = next((k for k in range(1, n) if sum(len(lines[i].split()) for i in solid[s : s + k]) >= words), n)
            if s and s + size > len(solid):
                continue
            run = tuple(lines[i].strip(" \t\x0b\f\r") for i in solid[s : s + size])
            if run in seen:
                gone |= set(solid[s : s + size])
            seen.add(run)
        out[doc_id, text] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(solid), len(gone))
    return out


def test_line_dedup_equals_brute_force(docs, rows):
    want = brute_lines(rows)
    got = linededup.drop_repeated_lines(docs.withColumn("line_dedup", docs.lang)).collect()
    assert len(got) == len(rows)
    before = collections.defaultdict(set)
    for r in rows:
        before[r[0]].add(r[1] or "")
    for r in got:
        (original,) = before[r.doc_id]
        assert (r.text or "", r.line_dedup.n_lines, r.line_dedup.n_removed) == want[r.doc_id, original]


def test_few_long_lines_that_repeat_go(spark):
    rng = random.Random(9)
    long, half, other, short = (" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n)) for n in (60, 30, 25, 12))
    own = lambda k: f"line {k} of its own"
    texts = [
        f"{own(1)}\n{long}\n{own(2)}\n{half}\n{other}\n{own(3)}\n{short}\n{own(4)}",
        f"{own(5)}\n  {long}\n{own(6)}",
        f"{half}\n\n{other}\n{own(7)}\n{short}",
        f"{own(8)}\n{other}\n{half}\n{short}\n{own(9)}",
        long,
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r.text for r in linededup.drop_repeated_lines(docs).collect()}
    # A long line alone, two lines of 55 words together; not in another order, nor a short one.
    assert got == {0: texts[0], 1: f"{own(5)}\n{own(6)}", 2: f"\n{own(7)}\n{short}", 3: texts[3], 4: ""}


def brute_poisson(rate, u):
    p = c = math.exp(-rate)
    k = 0
    while c <= u and k < 500:
        k += 1
        p = p * rate / k
        c += p
    return k


def test_mixing_draws_and_weights(spark):
    rows = [(i, f"t{i}", "en", "big" if i % 3 else "small", 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mixing.mix(docs.withColumn("mix_copy", docs.lang), weights={"big": 1, "small": 3}, size=4000).collect()
    count = collections.Counter(r.doc_id for r in out)
    for i, _, _, s, _ in rows:
        u = int(hashlib.md5(f"mix-1:{i}:0".encode()).hexdigest()[:13], 16) / 2**52
        assert count[i] == brute_poisson({"big": 1 / 4 * 4000 / 2000, "small": 3 / 4 * 4000 / 1000}[s], u)
    share = sum(r.source == "small" for r in out) / len(out)
    assert 0.7 < share < 0.8 and [r.mix_key for r in out] == sorted(r.mix_key for r in out)


def test_mixing_large_rates_and_nulls(spark, docs, rows):
    one = spark.createDataFrame([(1, "a", "en", None, 1)], SCHEMA)
    n = mixing.mix(one, size=5000).count()
    assert 4500 < n < 5500
    assert mixing.mix(docs, weights={"nowhere": 1}).count() == 0


def key_der():
    body = b"\x02\x01\x00" + b"\x02\x20" + bytes(range(1, 33))
    return b"\x30" + bytes([len(body)]) + body


def test_secrets_structure():
    key = base64.b64encode(key_der()).decode()
    token = ".".join(base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=") for x in ({"alg": "HS256"}, {"a": 1})) + ".c2ln"
    fake = ".".join(base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=") for x in ({"no": "HS256"}, {"a": 1})) + ".c2ln"
    kinds = lambda t: [k for k, _, _ in secrets.scan(t)]
    assert kinds(f"x {key} y") == ["der"] and kinds(f"x {token} y") == ["jwt"] and kinds(f"x {fake} y") == []
    assert kinds("x M" + "A" * 60) == []
    assert "hexder" in kinds(f"k {key_der().hex()} .") and "hex" in kinds(f"k {key_der().hex()} .")
    assert "pem" in kinds(f"-----BEGIN PRIVATE KEY-----\n{key[:20]}\n{key[20:]}\n-----END PRIVATE KEY-----")
    text = "é PassWord: 'abc' secret=ABCDEFGHIJKL AKIAABCDEFGHIJKLMN AKIA123 deadbeefdeadbeef0 api_key = \"zz.zz-zz_zz==\""
    want = [("assign", *m.span()) for m in secrets.ASSIGN.finditer(text) if len(m[2]) >= 12]
    want += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    want += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    assert sorted(secrets.scan(text), key=lambda s: s[1]) == sorted(want, key=lambda s: s[1]) and len(want) == 4
    assert secrets.scan(None) == secrets.scan("") == []


def test_secrets_with_headers_encrypted_and_wrapped():
    kinds = lambda t: [k for k, _, _ in secrets.scan(t) if k not in secrets.BASE]
    wrap = lambda x, n=40: "\n".join(x[i : i + n] for i in range(0, len(x), n))
    tlv = lambda tag, x: bytes([tag, len(x)]) + x
    sealed = lambda oid: tlv(0x30, tlv(0x30, tlv(6, bytes.fromhex(oid)) + b"\x05\0") + tlv(4, bytes(range(40))))
    pbes2, sha256 = "2a864886f70d01050d", "608648016503040201"
    text = lambda x: base64.b64encode(x).decode()
    frame = lambda head, x: f"-----BEGIN RSA PRIVATE KEY-----\n{head}{wrap(text(x))}\n-----END RSA PRIVATE KEY-----"
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: DES-EDE3-CBC,0123456789ABCDEF\n\n"
    assert kinds(frame(head, bytes(range(80)))) == ["pem"] and kinds(frame(head, bytes(range(81)))) == []
    assert kinds(frame("Comment: mine\n\n", key_der())) == ["pem"] and kinds(frame("Comment: mine\n\n", bytes(80))) == []
    assert kinds(text(sealed(pbes2))) == ["der"] and kinds(text(sealed(sha256))) == []
    for key in (key_der(), sealed(pbes2)):
        for after in ("", "\nnext line", "\r\n"):
            whole = wrap(text(key)) + after
            (kind, start, end), = [s for s in secrets.scan("x " + whole) if s[0] == "der"]
            assert (kind, start, end) == ("der", 2, 2 + len(wrap(text(key))))
    part = lambda x: len(x).to_bytes(4, "big") + x
    ssh = b"openssh-key-v1\0" + part(b"none") * 2 + part(b"") + (1).to_bytes(4, "big") + part(bytes(51)) + part(bytes(136))
    assert kinds(text(ssh)) == ["openssh"] == kinds(wrap(text(ssh), 70)) == kinds(wrap(text(ssh), 70) + "\nword") and kinds(wrap(text(ssh[:-9]), 70)) == []


def brute_spots(text, chain=3):
    w = [x for x in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()]
    common = set(spotsigs.ANCHORS)
    starts = [-1] + [i for i, x in enumerate(w) if x in common]
    out = set()
    for s in starts:
        follow = [x for x in w[s + 1 :] if x not in common][:chain]
        if follow:
            out.add(" ".join(follow))
    return out


def test_spot_signatures(spark, docs, rows):
    got = spotsigs.edited_prints(docs).collect()
    assert len(got) == len(rows)
    order = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for (i, a), (_, b) in zip(order, order[1:] + order[:1]):
        half = len(a) // 2
        edited = a[: len(a) - half] + b[:half]
        spots = [brute_spots(x) for x in (a, edited, b)]
        alike = [1.0 if not spots[0] | s else len(spots[0] & s) / len(spots[0] | s) for s in spots[1:]]
        want.append((i, len(a), hashlib.sha256(edited.encode()).hexdigest(), len(spots[0]), len(spots[1]), *alike))
    have = [
        (r.doc_id, r.n_chars, r.edited_sha256, len(r.fingerprint.split()), len(r.edited_fingerprint.split()), r.near_edited, r.near_next)
        for r in got
    ]
    assert sorted(have, key=str) == sorted(want, key=str)


def test_spot_search_equals_brute_force(spark, docs, rows):
    rng = random.Random(8)
    near = []
    for k in range(40):
        w = prose(k % 7 + 300, 40 + 10 * (k % 5))
        for _ in range(k % 4):
            w[rng.randrange(len(w))] = "w%d" % rng.randint(0, 9)
        near.append((100 + k, " ".join(w), "en", "s", 1))
    every = docs.unionByName(spark.createDataFrame(near, SCHEMA)).withColumn("set", docs.lang)
    held = [(i, frozenset(brute_spots(t))) for i, t, *_ in rows + near]
    classes = collections.defaultdict(list)
    for i, s in held:
        classes[s].append(i)
    alike = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    first = lambda ids: min((i for i in ids if i is not None), default=None)
    want = {(i, first(ids), len(ids), alike(a, s)) for i, a in held for s, ids in classes.items() if alike(a, s) >= 0.8}
    for limits in ({}, {"broadcast_rows": 0, "hot_share": 20}):
        got = [tuple(r) for r in spotsigs.near_documents(every, every, **limits).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert any(x < 1 for *_, x in want)
    assert spotsigs.near_documents(every.where("doc_id % 100 = 0"), every).count() == sum(i is not None and i % 100 == 0 for i, *_ in want)
    nothing = every.where("false")
    assert spotsigs.near_documents(nothing, every).count() == spotsigs.near_documents(every, nothing).count() == 0


def test_counts_follow_edits(spark, docs, rows):
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coder = edits.Counter(ranks, pattern)
    rng = random.Random(3)
    letters = ["a", " ", "  ", "'", "s", "re", "\n", "1", ".", "é", " the", "'ll", "\t ", "日"]
    for k in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 400)))
        tree = edits.TokenTree(text, *coder.leaves(text), coder)
        for _ in range(4):
            a = rng.randint(0, len(tree.text) + 2)
            tree.edit(a, a + rng.choice([0, 1, 30]), "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 40, 300]))))
            assert tree.total == len(coder.coder.encode_ordinary(tree.text)) and tree.chars[1] == len(tree.text)
    changes = spark.createDataFrame([(6, 1, 10, 20, "new words"), (6, 2, 0, 0, "start "), (None, 1, 0, 2, None)], "doc_id bigint, step int, start int, end int, new string")
    after = edits.apply_edits(edits.with_edits(edits.build(docs, ranks, pattern), changes), ranks, pattern).collect()
    assert len(after) == len(rows)
    for r in after:
        assert r.n_tokens == len(coder.coder.encode_ordinary(r.text or ""))
    (long,) = [r for r in after if r.doc_id == 6]
    assert long.text.startswith("start ") and 0 < long.n_reencoded < 3000


def brute_scores(texts, backoff=0.4):
    each = [[w.lower() for w in words(t)] for t in texts]
    uni = [collections.Counter(w) for w in each]
    two = [collections.Counter(zip(w, w[1:])) for w in each]
    all1, all2, n = sum(uni, collections.Counter()), sum(two, collections.Counter()), sum(map(len, each))
    out = []
    for w, u, t in zip(each, uni, two):
        score = seen = 0
        for i, x in enumerate(w):
            rest, first = n - len(w), i == 0
            pair = 0 if first else all2[w[i - 1], x] - t[w[i - 1], x]
            if pair:
                score, seen = score + math.log(pair / (all1[w[i - 1]] - u[w[i - 1]])), seen + 1
                continue
            single = all1[x] - u[x]
            value = single / rest if single else 1 / (rest + 1)
            seen += bool(first and single)
            score += math.log(value * (1 if first else backoff))
        out.append((len(w), score, seen))
    return out


def test_backoff_scores(docs, rows):
    got = ngrams.scores(docs).collect()
    want = brute_scores([r[1] for r in rows])
    have = sorted((str(r.doc_id), r.n_words, round(r.log_score, 6), r.n_seen) for r in got)
    assert have == sorted((str(r[0]), n, round(s, 6), k) for r, (n, s, k) in zip(rows, want))


def test_passages_found_and_clean_left_alone(docs, rows):
    got = {r.doc_id: r for r in passages.repeated_passages(docs).collect()}
    a, b = [i for i, r in enumerate(rows) if r[1] and " ".join(prose(99, 60)) in r[1]]
    assert got[a].class_id == got[b].class_id == a and got[a].n_links == got[b].n_links == 1
    (start, end) = map(int, got[a].spans.split(":"))
    assert 75 <= start <= 85 and 135 <= end <= 145
    assert got[6].class_id == got[7].class_id == got[8].class_id == 6 and got[6].n_copies == 2
    for i in (0, 1, 3, 19, 20):
        assert got[i].n_links == 0 and got[i].spans == ""


def test_compact_windows_are_all_minima():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**63, 300).astype(np.uint64)
    where = passages.lowest(values, 46)
    assert where.tolist() == [int(s + np.argmin(values[s : s + 46] & ~passages.PLACES)) for s in range(255)]


def test_compact_windows_of_many_texts_at_once(monkeypatch):
    texts = ["", "a b", " ".join(prose(7, 49)), " ".join(prose(8, 50)), " ".join(prose(9, 700)), " ".join(prose(9, 700)), " ".join(prose(10, 51))]
    owner, shingles = passages.shingle_hashes(texts)
    assert np.bincount(owner, minlength=len(texts)).tolist() == [0, 0, 45, 46, 696, 696, 47]
    got = collections.Counter()
    key, place, first, last, content = passages.compact_windows(owner, shingles)
    for k, p, a, b, c in zip(key.tolist(), place, first, last, content.tolist()):
        assert owner[a] == owner[p] == owner[b + 45] and a <= b
        begin = int(np.searchsorted(owner, owner[a]))
        got[int(owner[a]), k, int(p - begin), int(a - begin), int(b - begin), c] += 1
    alone = collections.Counter()
    for t, text in enumerate(texts):
        alone.update((t, *x) for x in zip(*(x.tolist() for x in passages.compact_windows(*passages.shingle_hashes([text])))))
    assert got == alone and {t for t, *_ in alone} == {3, 4, 5, 6}
    # Every passage of a text is covered.
    for t, n in ((3, 1), (4, 651), (6, 2)):
        assert {s for u, _, _, a, b, _ in alone if u == t for s in range(a, b + 1)} == set(range(n))


def test_passages_alike_share_a_signature_at_their_shift():
    """One word of fifty changed, left out or added, at each place: some window of both starts there."""
    base = prose(77, 50)
    for i in range(50):
        for other in (base[:i] + ["new"] + base[i + 1 :], base[:i] + ["new"] + base[i:], base[:i] + base[i + 1 :] + ["end"]):
            a, b = prose(1, 80) + base + prose(2, 80), prose(3, 95) + other + prose(4, 80)
            if passages.alike([" ".join(base)], [" ".join(other[:50])])[0] < passages.SIMILAR:
                continue
            keys = [set(passages.compact_windows(*passages.shingle_hashes([" ".join(t)]))[0].tolist()) for t in (a, b)]
            assert keys[0] & keys[1], (i, len(other))


def test_texts_of_one_word_have_few_windows():
    """Stretches of one word and of a short period are windows at both ends, not at each start."""
    for text in ("x " * 5000, "a b c " * 2000):
        owner, shingles = passages.shingle_hashes([text])
        key, place, first, last, content = passages.compact_windows(owner, shingles)
        assert len(key) <= 2 * (1 + passages.HASHES)
        assert min(first) == 0 and max(last) == len(shingles) - passages.SPAN


def test_contents_are_equal_for_equal_stretches():
    values = np.array([5, 6, 7, 1, 5, 6, 7, 2, 5, 6], np.uint64)
    got = passages.contents(values, np.array([0, 4, 0, 8, 0, 1]), np.array([3, 7, 2, 10, 4, 4]))
    assert got[0] == got[1] and got[2] == got[3] and len(set(got.tolist())) == 4
    same = passages.firsts(np.array([0, 0, 0, 1]), np.array([9, 8, 9, 9], np.uint64), np.array([1, 1, 1, 1], np.uint64))
    assert same.tolist() == [0, 1, 0, 3]


def test_repeats_inside_a_text_get_their_spans(spark):
    """A passage that one text holds twice and another once; and stretches of one word."""
    shared = " ".join(prose(321, 60))
    texts = [
        " ".join([*prose(11, 40), shared, *prose(12, 70), shared, *prose(13, 40)]), " ".join([*prose(14, 90), shared, *prose(15, 10)]),
        "go " * 80 + " ".join(prose(16, 30)), " ".join(prose(17, 20)) + " go" * 120, " ".join(prose(18, 200)),
    ]
    got = {r.doc_id: r for r in passages.repeated_passages(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)).collect()}
    spans = {i: [tuple(map(int, x.split(":"))) for x in r.spans.split(",") if x] for i, r in got.items()}
    assert len(spans[0]) == 2 and spans[0][0][0] <= 40 and spans[0][0][1] >= 100 and spans[0][1][0] <= 170 and spans[0][1][1] >= 230
    assert len(spans[1]) == 1 and spans[1][0][0] <= 90 and spans[1][0][1] >= 150
    assert got[2].class_id == got[3].class_id == 2 and spans[2] and spans[3]
    assert got[4].class_id == 4 and spans[4] == [] and got[0].class_id == got[1].class_id == 0


def test_passage_likeness_equals_brute_force():
    rng = random.Random(6)
    left = [" ".join(prose(k, 50)) for k in range(60)] + ["", "a b", "x x x x x x x x", "a b c d e f"]
    right = [" ".join(rng.choice(["q", w]) if rng.random() < 0.05 * (k % 3) else w for w in t.split()) for k, t in enumerate(left[:60])] + ["", "", "x x x x x", "b"]
    sets = lambda t: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)}
    want = [len(sets(a) & sets(b)) / len(sets(a) | sets(b)) if sets(a) | sets(b) else 1.0 for a, b in zip(left, right)]
    assert passages.alike(left, right).tolist() == want and passages.alike([], []).tolist() == []


def test_likeness_at_every_start_equals_brute_force():
    rng = random.Random(12)
    left = [" ".join(prose(k, 50 + 7 * k)) for k in range(12)] + ["", "a b", " ".join(["x", "y"] * 60)]
    right = [" ".join("q" if rng.random() < 0.02 else w for w in t.split()) for t in left]
    length = passages.SPAN + passages.SHINGLE - 1
    cut = lambda t, s: " ".join(t.split()[s : s + length])
    want = [(k, s, passages.alike([cut(a, s)], [cut(b, s)])[0]) for k, (a, b) in enumerate(zip(left, right)) for s in range(len(a.split()) - length + 1)]
    assert list(zip(*(x.tolist() for x in passages.alike_at_starts(left, right)))) == want
    assert [len(x) for x in passages.alike_at_starts([], [])] == [0, 0, 0]


def test_passages_are_compared_at_inner_starts(spark):
    """One word of 50 is replaced: only few starts are alike, seldom the ends of a range of candidates."""
    texts = []
    for k in range(60):
        shared = prose(5000 + k, 50)
        changed = shared[:25] + ["other"] + shared[26:]
        texts += [" ".join(prose(6000 + 2 * k, 70) + shared + prose(7000 + k, 70)), " ".join(prose(6001 + 2 * k, 60) + changed + prose(8000 + k, 90))]
    got = {r.doc_id: r for r in passages.repeated_passages(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)).collect()}
    linked = [got[2 * k].class_id == got[2 * k + 1].class_id for k in range(60)]
    assert sum(linked) >= 50


def test_passages_of_near_copies_reach_their_original(spark):
    """Copies with one replaced word are seldom alike to each other, whichever of them owns a signature."""
    rng, each = random.Random(30), []
    for g in range(3):
        original = prose(40000 + g, 60)
        each.append([original] + [original[:i] + [f"v{rng.randint(0, 10**9)}"] + original[i + 1 :] for i in (rng.randrange(60) for _ in range(30))])
    texts = [" ".join(w) for group in each for w in group]
    got = {r.doc_id: r.class_id for r in passages.repeated_passages(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)).collect()}
    pairs = [(31 * g, 31 * g + k) for g in range(3) for k in range(1, 31)]
    length = passages.SPAN + passages.SHINGLE - 1
    cut = lambda i: [" ".join(texts[i].split()[s : s + length]) for s in range(60 - length + 1)]
    true = [(a, b) for a, b in pairs if (passages.alike(cut(a), cut(b)) >= passages.SIMILAR).any()]
    assert sum(got[a] == got[b] for a, b in true) >= 0.95 * len(true) > 60


@pytest.mark.parametrize("few", [32, 1])
def test_members_are_linked_as_by_brute_force(monkeypatch, few):
    """Unlike texts with a line in common, near copies and texts of repeated words: links and classes in each signature."""
    monkeypatch.setattr(passages, "FEW", few)
    rng, line, base = random.Random(8), prose(900, 30), prose(901, 58)
    texts = [prose(910 + k, 40) + line + prose(930 + k, 40) for k in range(8)]
    texts += [[f"n{k}" if i in (5 + 4 * k, 50 - 3 * k) else w for i, w in enumerate(base)] + prose(950 + k, 9 * k) for k in range(8)]
    texts += [sum(([w] * rng.randint(15, 30) for w in rng.sample("abc", 3)), []) for _ in range(8)]
    found = collections.defaultdict(list)
    shingles = [passages.shingle_hashes([" ".join(t)])[1] for t in texts]
    for t, values in enumerate(shingles):
        for key, place, first, last, _ in set(zip(*(x.tolist() for x in passages.compact_windows(np.zeros(len(values), np.int64), values)))):
            found[key].append((t, place, first, last))
    rows = [(k, *m) for k, ms in found.items() if len({m[0] for m in ms}) > 1 for m in ms]
    stretch = [shingles[t][first : last + passages.SPAN].view(np.uint8).reshape(-1, 8)[:, : passages.BYTES].tobytes() for _, t, _, first, last in rows]
    sig, t, place, first, last = (np.array(x) for x in zip(*rows))
    sig = sig.view(np.int64) if sig.dtype == np.uint64 else sig.astype(np.uint64).view(np.int64)
    table = pa.table({"unit": sig, "sig": sig, "t": t, "place": place, "first": first, "last": last, "copies": np.ones(len(t), np.int64), "stretch": pa.array(stretch, pa.binary())})
    got = {x[1:] for part in passages.Members(table).all_links() for x in zip(*(c.tolist() for c in part))}
    true = set()
    for ms in found.values():
        for (a, p, f, e), (b, q, g, h) in itertools.permutations(ms, 2):
            shift = q - p
            for s in range(max(f, g - shift), min(e, h - shift) + 1):
                x, y = (set(shingles[i][k : k + passages.SPAN].tolist()) for i, k in ((a, s), (b, s + shift)))
                if a != b and len(x & y) / len(x | y) >= passages.SIMILAR:
                    true.add((a, b, shift, s))
    starts = {(a, b, shift, s) for a, b, shift, low, high in got for s in range(low, high + 1)}
    assert starts and starts <= true

    def classes(pairs):
        root = list(range(len(texts)))
        for _ in texts:
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert classes({x[:2] for x in starts}) == classes({x[:2] for x in true})


def test_near_copies_are_linked_with_each_other(spark):
    """Three copies of a text with another word changed in two of them: each has a passage in common with both others."""
    base = prose(980, 60)
    texts = [" ".join(f"n{at}" if i == at else w for i, w in enumerate(base)) for at in (-1, 3, 56)]
    got = passages.repeated_passages(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links, r.spans) for r in got) == [(i, 0, 2, "0:60") for i in range(3)]


def test_unlike_texts_with_a_line_in_common_take_no_rounds(spark, monkeypatch):
    stored, durable = collections.Counter(), passages.durable
    monkeypatch.setattr(passages, "durable", lambda df, label: stored.update([label]) or durable(df, label))
    line, shared = prose(700, 30), prose(701, 70)
    texts = [" ".join(prose(710 + k, 40) + line + prose(740 + k, 40)) for k in range(20)] + [" ".join(prose(770 + k, 20) + shared) for k in range(2)]
    got = {r.doc_id: r for r in passages.repeated_passages(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)).collect()}
    assert [got[i].class_id for i in range(22)] == [*range(20), 20, 20] and got[3].spans == "" != got[21].spans
    assert max(stored.values()) == 1


def test_passages_with_a_word_more_are_linked_beside_their_shift(spark):
    """Texts start with 50 words, one added or left out at any place: the run in common may lie at another shift than the likeness."""
    texts, pairs = [], []
    for i in range(1, 49):
        for base, more in ((prose(9000 + i, 51), ["more", 0]), (prose(9100 + i, 51), [1])):
            other = base[:i] + more[:-1] + base[i + more[-1] :]
            a, b = " ".join(base[:50]), " ".join(other[:50])
            if passages.alike([a], [b])[0] >= passages.SIMILAR:
                pairs.append((len(texts), len(texts) + 1))
                texts += [a, b]
    got = {r.doc_id: r for r in passages.repeated_passages(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)).collect()}
    assert len(pairs) > 20 and all(got[a].class_id == got[b].class_id == a and got[a].spans == got[b].spans == "0:50" for a, b in pairs)


@pytest.mark.parametrize("at_once", [1 << 20, 16])
def test_shingles_are_equal_where_their_words_are(monkeypatch, at_once):
    monkeypatch.setattr(passages, "BYTES_AT_ONCE", at_once)
    texts = ["", " \t\n", "a b c d e", "\na\tB\rC\fd\x0be ", "ab c d e f g", "a bc d e f g", "\u00c4 \u00e4 x\x85y \u00e9\u00a0 \x1c z", "go " * 70, "w" * 90 + " a b c d E", *(" ".join(prose(k, 60)) for k in range(3))]
    words = [t.lower().encode().split() for t in texts]
    want = [(k, tuple(w[i : i + 5])) for k, w in enumerate(words) for i in range(len(w) - 4)]
    owner, shingles = passages.shingle_hashes(texts)
    assert owner.tolist() == [k for k, _ in want]
    assert len(set(zip(shingles.tolist(), (s for _, s in want)))) == len(set(shingles.tolist())) == len({s for _, s in want})
    twice = [len(set(want[s : s + 46])) < 46 for s in range(len(want) - 45) if want[s][0] == want[s + 45][0]]
    inside = [s for s in range(len(want) - 45) if want[s][0] == want[s + 45][0]]
    assert passages.repeating(owner, shingles)[inside].tolist() == twice and any(twice) and not all(twice)


def moved(df, column):
    """How many exchanges of the plan carry the column."""
    plan, found = df._jdf.queryExecution().executedPlan(), 0
    nodes = [plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan]
    while nodes:
        node = nodes.pop()
        found += node.nodeName() == "Exchange" and f"{column}#" in node.output().toString()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_texts_of_passages_are_moved_once(spark, monkeypatch):
    plans, durable = {}, passages.durable
    monkeypatch.setattr(passages, "durable", lambda df, label: plans.update({label: moved(df, "body")}) or durable(df, label))
    texts = [" ".join(prose(60 + k, 30) + prose(50, 70)) for k in range(4)]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        passages.repeated_passages(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plans["passage-windows"] == 0 and plans["passage-links"] == 1


@pytest.mark.parametrize("rows", [10_000, 3])
def test_shared_windows_of_frequent_keys_too(spark, monkeypatch, rows):
    """Windows that different texts share, copies of a text being one; a line in all texts is frequent in the second run."""
    monkeypatch.setattr(passages, "HOT_ROWS", rows)
    line = prose(800, 60)
    texts = [prose(810 + k, 50) + line + prose(830 + k, 20 + k) for k in range(12)] + [prose(850, 200)] * 9 + [prose(851, 90) + prose(852, 70)] + [prose(852, 70)]
    rows = [(k, " ".join(t)) for k, t in zip([*range(12), *[12] * 9, 13, 14], texts)]
    found = passages.windows(spark.createDataFrame(rows, "t bigint, body string").repartition(3)).localCheckpoint()
    assert bool(passages.frequent_keys(found).count()) == (passages.HOT_ROWS == 3)
    every, owners = set(map(tuple, found.collect())), collections.defaultdict(set)
    for t, key, *_ in every:
        owners[key].add(t)
    got = list(map(tuple, passages.shared_windows(found).select("t", "sig", "content", "place", "first", "last", "same").collect()))
    assert sorted(got) == sorted(x for x in every if len(owners[x[1]]) > 1) and {x[0] for x in got} == {*range(12), 13, 14}


def test_documents_without_id_count_as_copies(spark):
    """Copies without an id, some with: every row is there, the shared passage is linked once."""
    shared = " ".join(prose(870, 80))
    rows = [(None, "a " + shared, "en", "s", 1)] * 4 + [(7, "b " + shared, "en", "s", 1)] * 2 + [(9, " ".join(prose(871, 80)), "en", "s", 1)]
    got = passages.repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or -1, r.class_id, r.n_copies, r.n_links) for r in got) == [(-1, 7, 4, 1)] * 4 + [(7, 7, 2, 1)] * 2 + [(9, 9, 1, 0)]


@pytest.mark.parametrize("run", [quality.quality, simhash.near_duplicates, mixing.mix, spotsigs.edited_prints, ngrams.scores, passages.repeated_passages, linededup.drop_repeated_lines, secrets.secret_spans])
def test_empty_table(empty, run):
    assert run(empty).count() == 0


def test_every_query_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
