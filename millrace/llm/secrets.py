"""Secret scans: patterns for secrets that are written out, and structural confirmation of those that are encoded.

Three patterns report as they match: assignments of a password or token, access key ids and long hex runs. Base64 and
hex candidates are reported only if their bytes prove to be a secret: they are decoded and parsed to the end.

* ``key``: a private key. Either DER, where every tag and length must fit the bytes around it (RSA and DSA, EC, PKCS #8 plain or
  encrypted), or the OpenSSH form with its nested length-prefixed strings. Candidates are the body between PEM lines,
  a base64 run or a hex run; a run may also hold a whole PEM block or one more layer of base64.
* ``jwt``: a signed token. Three base64url parts, of which the first is a JSON object with a signing algorithm, the second
  a JSON object, and the third a signature of the length that the algorithm gives.

Public keys, certificates, unsigned tokens, and bytes that merely look random are not reported. Matches of one kind
never overlap; the leftmost wins. Places are code points, the end exclusive.

Each text is scanned whole and by itself, so rows may be null, empty, repeated, without id or very long, tables empty,
and other columns of any name; only ``keep`` and the text are read. A null text has no spans. The work of a text is in
proportion to its length: the parsers read each byte once for each layer, and there are ``LAYERS`` layers.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

#: Kinds in the order in which spans of equal start are listed; the first three are the plain patterns.
KINDS = ("assign", "access", "hex", "key", "jwt")
PATTERNS = KINDS[:3]

# The patterns and least lengths of plain secrets.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_LEAST = 6
ACCESS = re.compile("AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile("(?<![0-9a-f])[0-9a-f]{24,}")  # the same as runs of any length of which the short ones are dropped
ASSIGN_WORDS = ("passw", "secret", "token", "api")

LAYERS = 2
#: A run is decoded from this many characters on: the least private key (Ed25519, PKCS #8) has 48 bytes.
LEAST_RUN = 64
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{64,}={0,2}")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----([^-]*(?:-(?!----)[^-]*)*)-----END \1-----")
JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]{16,})")
#: Signature bytes by algorithm; RSA signatures are as long as the key.
SIGNATURES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": None,
              "RS256": None, "RS384": None, "RS512": None, "PS256": None, "PS384": None, "PS512": None}
OPENSSH = b"openssh-key-v1\0"


class Span(NamedTuple):
    start: int
    kind: str
    end: int
    detail: str


class Value(NamedTuple):
    """A DER value: its tag, where its content starts and ends."""

    tag: int
    start: int
    end: int


def values(data: bytes, start: int, end: int) -> list[Value] | None:
    """The DER values that fill data[start:end] exactly, None if they don't."""
    found = []
    while start < end:
        if start + 2 > end:
            return None
        tag, n, at = data[start], data[start + 1], start + 2
        if n >= 0x80:
            size = n & 0x7F
            if not 1 <= size <= 4 or at + size > end:
                return None
            n, at = int.from_bytes(data[at:at + size], "big"), at + size
            if n < 0x80 or n >> 8 * (size - 1) == 0:  # a shorter form exists
                return None
        if at + n > end:
            return None
        found.append(Value(tag, at, at + n))
        start = at + n
    return found


def _number(data: bytes, value: Value) -> bool:
    """A DER integer in its shortest form."""
    n = value.end - value.start
    return value.tag == 2 and n > 0 and not (n > 1 and (data[value.start] == 0 and data[value.start + 1] < 0x80 or data[value.start] == 0xFF and data[value.start + 1] >= 0x80))


def _small(data: bytes, value: Value) -> int | None:
    return data[value.start] if value.tag == 2 and value.end - value.start == 1 else None


def _algorithm(data: bytes, value: Value) -> bool:
    inner = values(data, value.start, value.end) if value.tag == 0x30 else None
    return bool(inner) and len(inner) <= 2 and inner[0].tag == 6 and inner[0].end > inner[0].start


def der_key(data: bytes) -> str | None:
    """Which private key the bytes are, if a DER value of the known forms ends where they do."""
    whole = values(data, 0, len(data))
    if not whole or len(whole) != 1 or whole[0].tag != 0x30:
        return None
    parts = values(data, whole[0].start, whole[0].end)
    if not parts:
        return None
    numbers = [_number(data, p) for p in parts]
    first, n = _small(data, parts[0]), len(parts)
    if all(numbers) and first == 0 and n in (6, 9):
        return "rsa" if n == 9 else "dsa"
    if first == 1 and n <= 4 and n > 1 and parts[1].tag == 4 and parts[1].end - parts[1].start >= 16 and all(p.tag in (0xA0, 0xA1) and values(data, p.start, p.end) for p in parts[2:]):
        return "ec"
    if first in (0, 1) and 3 <= n <= 5 and _algorithm(data, parts[1]) and parts[2].tag == 4 and all(p.tag in (0xA0, 0x81, 0xA1) for p in parts[3:]):
        # the key itself is a value once more: a sequence, or the octets of a curve
        inner = values(data, parts[2].start, parts[2].end)
        return "pkcs8" if inner and len(inner) == 1 and inner[0].tag in (0x30, 4, 2) else None
    if n == 2 and _algorithm(data, parts[0]) and parts[1].tag == 4 and parts[1].end - parts[1].start >= 16:
        return "pkcs8-encrypted"
    return None


def openssh_key(data: bytes) -> str | None:
    if not data.startswith(OPENSSH):
        return None
    at, strings, left = len(OPENSSH), 0, None
    while left is None or left:
        if strings == 3:  # cipher, kdf and its options are followed by the number of public keys
            if at + 4 > len(data):
                return None
            keys, at = int.from_bytes(data[at:at + 4], "big"), at + 4
            if not 1 <= keys <= len(data):
                return None
            left, strings = keys + 1, 4
            continue
        n = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + n > len(data) or at + 4 > len(data):
            return None
        at += 4 + n
        strings += 1
        left = None if left is None else left - 1
    return "openssh" if at == len(data) else None


def unbase64(run: str) -> bytes | None:
    """The bytes of a base64 or base64url run with whole or no padding; None if it mixes the alphabets."""
    core = run.rstrip("=")
    if ("-" in core or "_" in core) and ("+" in core or "/" in core):
        return None
    if len(core) % 4 == 1 or len(run) != len(core) and len(run) % 4:
        return None
    try:
        return base64.b64decode(core.replace("-", "+").replace("_", "/") + "=" * (-len(core) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def key_of(data: bytes | None, layers: int = LAYERS - 1) -> str | None:
    """Which private key the bytes are: one as it is, in PEM lines, or (``layers`` times) in base64 once more."""
    if not data:
        return None
    found = openssh_key(data) or (der_key(data) if data[0] == 0x30 else None)
    if found or not layers or not data.isascii():
        return found
    text = data.decode("ascii").strip()
    if pem := PEM.search(text):
        return pem_key(pem[2])
    return key_of(unbase64(text), layers - 1) if RUN.fullmatch(text) else None


def pem_key(body: str) -> str | None:
    """The key between PEM lines. Lines of older files may begin with headers that say how they are encrypted."""
    if "Proc-Type:" in body:
        head, _, body = body.replace("\r", "").partition("\n\n")
        data = unbase64("".join(body.split()))
        return "pem-encrypted" if "ENCRYPTED" in head and data and len(data) >= 32 and len(data) % 8 == 0 else None
    return key_of(unbase64("".join(body.split())), 0)


def signed_token(match: re.Match) -> str | None:
    """The algorithm of a signed token."""
    try:
        head, claims, signature = (unbase64(p) for p in match.groups())
        head, claims = json.loads(head or b""), json.loads(claims or b"")
    except (ValueError, RecursionError):
        return None
    if not isinstance(head, dict) or not isinstance(claims, dict) or not isinstance(head.get("alg"), str) or head["alg"] not in SIGNATURES or not signature:
        return None
    size = SIGNATURES[head["alg"]]
    return head["alg"] if len(signature) == size or size is None and len(signature) >= 64 else None


def plain_spans(text: str) -> Iterator[Span]:
    low = text.lower()  # longer words may arise, but none is lost
    if any(w in low for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                yield Span(m.start(), "assign", m.end(), m[1].lower())
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LEAST:
                yield Span(m.start(), "access", m.end(), "AKIA")
    for m in HEX.finditer(text):
        yield Span(m.start(), "hex", m.end(), "")


def encoded_spans(text: str) -> Iterator[Span]:
    """Private keys and signed tokens that their structure confirms."""
    done = 0
    blocks = []
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            if detail := pem_key(m[2]):
                blocks.append((m.start(), m.end()))
                yield Span(m.start(), "key", m.end(), detail)
    for m in RUN.finditer(text):
        while done < len(blocks) and blocks[done][1] <= m.start():
            done += 1
        if done < len(blocks) and blocks[done][0] < m.end():
            continue  # inside a block that is reported
        run = m[0]
        is_hex = not len(run) % 2 and re.fullmatch("[0-9a-fA-F]+", run)
        detail = key_of(bytes.fromhex(run)) if is_hex else None
        if detail := detail or key_of(unbase64(run)):
            yield Span(m.start(), "key", m.end(), detail)
    if "." in text:
        m = JWT.search(text)
        while m:
            if detail := signed_token(m):
                yield Span(m.start(), "jwt", m.end(), detail)
            m = JWT.search(text, m.end() if detail else m.end(1))


def spans(text: str | None) -> list[Span]:
    """All spans, by start and then kind."""
    if not text:
        return []
    return sorted([*plain_spans(text), *encoded_spans(text)], key=lambda s: (s.start, KINDS.index(s.kind)))


def listed(found: Sequence[Span], kinds: Sequence[str] = KINDS) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in found if s.kind in kinds)


SCHEMA = "spans array<struct<kind: string, start: long, end: long, detail: string>>"


def scan(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """``keep`` and the spans of each text: kind, start, end and what was confirmed (a word, a key's form, an algorithm)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("detail", pa.string())]))

    def run(batches):
        for batch in batches:
            texts = batch.column(len(keep))
            found = [[{"kind": s.kind, "start": s.start, "end": s.end, "detail": s.detail} for s in spans(t.as_py())] for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(found, kind)], names=[*keep, "spans"])

    frame = docs.select(*keep, text)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:len(keep)]), SCHEMA])
    return frame.mapInArrow(run, schema)


def digest(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """``keep``, the number of spans of each plain pattern, the checksum of those, and all spans, as text."""

    def run(batches):
        for batch in batches:
            found = [spans(t.as_py()) for t in batch.column(len(keep))]
            counts = [pa.array([sum(s.kind == kind for s in row) for row in found], pa.int64()) for kind in PATTERNS]
            sums = pa.array([hashlib.sha256(listed(row, PATTERNS).encode()).hexdigest() for row in found], pa.string())
            texts = pa.array([listed(row) for row in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *counts, sums, texts], names=[*keep, *(f"n_{k}" for k in PATTERNS), "base_sha256", "spans"])

    frame = docs.select(*keep, text)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:len(keep)])
    return frame.mapInArrow(run, f"{kept}, {', '.join(f'n_{k} long' for k in PATTERNS)}, base_sha256 string, spans string")
