"""Secret scans with structural confirmation."""

from __future__ import annotations

import base64
import binascii
import json
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The order in which kinds at one start are listed; the first three are found by pattern alone.
KINDS = ["assign", "access", "hex", "pem", "der", "hexder", "openssh", "jwt"]
BASE = KINDS[:3]

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}")
HEX = re.compile(rf"[0-9a-f]{{{HEX_LEAST},}}")
# Candidates: what base64 or hex of a DER sequence, an OpenSSH container or a JSON object begins with.
PEM = re.compile(
    r"-----BEGIN ([A-Z0-9 ]{1,64})-----\s*+((?:[A-Za-z][A-Za-z0-9-]*:[^\n]*\n(?:[ \t]+[^\n]*\n)*+)*+)([A-Za-z0-9+/=\s]+)-----END \1-----"
)
SEALED = re.compile(r"^Proc-Type:[ \t]*4,[ \t]*ENCRYPTED[\s\S]*^DEK-Info:[ \t]*[A-Za-z0-9-]+,[ \t]*(?:[0-9A-Fa-f]{2}){8,}\s*$", re.MULTILINE)
DER64 = re.compile(r"(?<![A-Za-z0-9+/_-])M[A-P][A-Za-z0-9+/_-]{26,}={0,2}")
DERHEX = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{38,}(?![0-9A-Fa-f])")
OPENSSH = re.compile(r"(?<![A-Za-z0-9+/])b3BlbnNzaC1rZXktdjE[A-Za-z0-9+/]{20,}={0,2}")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(e[wy][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
WRAPPED = re.compile(r"[A-Za-z0-9+/_-]+(?:\r?\n[A-Za-z0-9+/_-]+)+={0,2}")
# Object ids of password-based encryption: PKCS#5 and PKCS#12.
PASSWORD_BASED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
DEEPEST = 16


def unbase64(text: str) -> bytes | None:
    solid = re.sub(r"\s+", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    if len(solid) % 4 == 1:
        return None
    try:
        return base64.b64decode(solid + "=" * (-len(solid) % 4), validate=True)
    except binascii.Error:
        return None


def der_items(data: bytes, depth: int = 0) -> list[tuple[int, bytes]] | None:
    """The (tag, content) items that fill ``data`` exactly, or None; nested lengths must fit too."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 128:
            width = size & 127
            if not 1 <= width <= 4 or at + width > len(data) or data[at] == 0:
                return None
            size = int.from_bytes(data[at : at + width], "big")
            if size < 128:
                return None
            at += width
        if at + size > len(data):
            return None
        content = data[at : at + size]
        if tag & 0x20 and (depth >= DEEPEST or der_items(content, depth + 1) is None):
            return None
        items.append((tag, content))
        at += size
    return items


def is_key(data: bytes | None) -> bool:
    """A DER private key, all lengths fitting: one sequence of a small version number and key material, or of
    a password-based algorithm and what it encrypts."""
    if not data or data[0] != 0x30:
        return False
    outer = der_items(data)
    if not outer or len(outer) != 1:
        return False
    inner = der_items(outer[0][1])
    if not inner or len(inner) < 2:
        return False
    if inner[0][0] == 0x30:
        algorithm = der_items(inner[0][1])
        named = bool(algorithm) and algorithm[0][0] == 6 and algorithm[0][1].startswith(PASSWORD_BASED)
        return named and len(inner) == 2 and inner[1][0] == 4 and len(inner[1][1]) > 0
    return inner[0][0] == 2 and len(inner[0][1]) == 1 and inner[0][1][0] <= 3


def is_openssh(data: bytes | None) -> bool:
    """The magic, then three length-prefixed strings, a key count and length-prefixed blobs to the end."""
    magic = b"openssh-key-v1\0"
    if not data or not data.startswith(magic):
        return False
    at, seen = len(magic), 0
    while at < len(data):
        if seen == 3:
            at += 4
            seen += 1
            continue
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        seen += 1
    return at == len(data) and seen >= 5


def der_size(data: bytes) -> int:
    """Bytes of the sequence that ``data`` begins with; 0 if what follows its length can't be a key."""
    width = data[1] & 127 if data[1] >= 128 else 0
    head = data[2 + width : 5 + width]
    if width > 4 or (head[:1] != b"\x30" and not (head[:2] == b"\x02\x01" and head[2:] <= b"\x03")):
        return 0
    return 2 + width + (int.from_bytes(data[2 : 2 + width], "big") if width else data[1])


def openssh_size(data: bytes) -> int:
    """Bytes of the container that ``data`` begins with: magic, three strings, a count, so many public keys and the private ones."""
    at, left, keys = 15, 3, None
    while left:
        if at + 4 > len(data):
            return 0
        number = int.from_bytes(data[at : at + 4], "big")
        at, left = at + 4 + number, left - 1
        if not left and keys is None:
            keys = int.from_bytes(data[at : at + 4], "big")
            at, left = at + 4, keys + 1
    return at


def wrapped_end(text: str, start: int, size_of, holds) -> int | None:
    """Where base64 that goes on over single line breaks from ``start`` ends, if its own lengths say so and ``holds``."""
    first = unbase64(text[start : start + 24])
    if not first or (size_of is der_size and not der_size(first)):
        return None
    run = WRAPPED.match(text, start)
    if not run:
        return None
    letters = [m.start() for m in re.finditer(r"[^\s=]", run[0])]
    solid = "".join(run[0][i] for i in letters)
    size = size_of(unbase64(solid[: len(solid) // 4 * 4]) or b"\0\0")
    need = -(-size * 4 // 3)
    if not 0 < need <= len(letters):
        return None
    end = letters[need - 1] + 1
    if end < len(run[0]) and run[0][end] not in "\r\n=":
        return None
    if not holds(unbase64(solid[:need])):
        return None
    return start + end + (len(run[0][end:]) - len(run[0][end:].lstrip("=")))


def is_token_header(segment: str) -> bool:
    raw = unbase64(segment)
    try:
        head = json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str)


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; code points, end exclusive."""
    if not text:
        return []
    out = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    framed = []
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            raw = unbase64(m[3])
            # What an encrypted body holds can't be seen: whole cipher blocks.
            if is_key(raw) or is_openssh(raw) or (raw and len(raw) % 8 == 0 and SEALED.search(m[2])):
                out.append(("pem", *m.span()))
                framed.append(m.span())

    def encoded(kind, pattern, size_of, holds):
        for m in pattern.finditer(text):
            if holds(unbase64(m[0])):
                out.append((kind, *m.span()))
            elif not any(a <= m.start() < b for a, b in framed) and (end := wrapped_end(text, m.start(), size_of, holds)):
                out.append((kind, m.start(), end))

    encoded("der", DER64, der_size, is_key)
    for m in DERHEX.finditer(text):
        if len(m[0]) % 2 == 0 and is_key(bytes.fromhex(m[0])):
            out.append(("hexder", *m.span()))
    if "b3BlbnNzaC1rZXktdjE" in text:
        encoded("openssh", OPENSSH, openssh_size, is_openssh)
    out += [("jwt", *m.span()) for m in TOKEN.finditer(text) if is_token_header(m[1])]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def secret_spans(docs: DataFrame, text: str = "text", spans: str = "secret_spans") -> DataFrame:
    """``docs`` with an array of structs (kind, start, end) of each whole text; null text: empty array.

    Kinds assign, access and hex are reported by their pattern. The other candidates are decoded
    (base64, hex) and reported only if their structure holds: keys whose nested lengths fit, and
    signed tokens whose header names an algorithm. A column already named ``spans`` is replaced.
    """

    @F.pandas_udf("array<struct<kind:string,start:bigint,end:bigint>>")
    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in scan(t)] for t in texts])

    return docs.drop(spans).withColumn(spans, find(F.col(text)))
