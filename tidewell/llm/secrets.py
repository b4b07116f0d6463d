"""Secret scan: plain patterns, and encoded keys and tokens that are confirmed by their structure."""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidewell.llm.common import id_and_text, per_slice

#: Order of kinds where spans start at the same place: the base kinds first.
KINDS = ("assign", "access", "hex", "jwt", "pem", "der", "hexkey")

ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{12,})\.([A-Za-z0-9_-]{3,})\.([A-Za-z0-9_-]*)")
PEM = re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----([A-Za-z0-9+/=\s]*)-----END \1-----")
#: Base64, also wrapped over lines of at least 40 characters, and the rest of a key that does not end on a line.
BASE64 = re.compile(r"(?:[A-Za-z0-9+/]{40,}\r?\n[ \t]*)*[A-Za-z0-9+/]{4,}={0,2}")
HEXKEY = re.compile(r"[0-9A-Fa-f]{88,}")
#: What a private key starts with: a sequence and its length, then a version of one byte; or the name of the format.
KEY_HEAD = re.compile(rb"\x30(?:[\x20-\x7f]|\x81.|\x82..|\x83...)\x02\x01|openssh-key-v1\0", re.S)

WORDS = ("passw", "secret", "token", "api")
HEX_RUN = bytes(120 if chr(i) in "0123456789abcdef" else 32 for i in range(256))
CODE_RUN = bytes(120 if chr(i).isascii() and (chr(i).isalnum() or chr(i) in "+/") else 32 for i in range(256))

#: Longer than any private key in use; bounds what is parsed behind each possible start.
MAX_KEY = 1 << 16

SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _der_length(data: bytes, at: int) -> tuple[int, int] | None:
    """Length and place of the content of the element at ``at``."""
    if at + 2 > len(data):
        return None
    first = data[at + 1]
    if first < 0x80:
        return first, at + 2
    n = first & 0x7F
    if not 1 <= n <= 4 or at + 2 + n > len(data):
        return None
    return int.from_bytes(data[at + 2 : at + 2 + n], "big"), at + 2 + n


def _der_children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the elements that fill start..end exactly, else None."""
    found = []
    while start < end:
        if (got := _der_length(data, start)) is None:
            return None
        n, body = got
        if body + n > end:
            return None
        found.append((data[start], body, body + n))
        start = body + n
    return found


def _fields(data: bytes, at: int, count: int | None = None) -> tuple[list[bytes], int] | None:
    """``count`` strings with their lengths before them (all up to the end if None), and where they end."""
    found: list[bytes] = []
    while (at < len(data)) if count is None else (len(found) < count):
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return None
        found.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return found, at


def _openssh_end(data: bytes) -> int | None:
    """Where an OpenSSH key ends: cipher, derivation, its options, number of keys, their public parts, the private part."""
    if (got := _fields(data, 15, 3)) is None:
        return None
    (cipher, derivation, options), at = got
    count = int.from_bytes(data[at : at + 4], "big")
    if not cipher or not derivation or (cipher == b"none") != (derivation == b"none") or bool(options) == (cipher == b"none"):
        return None
    if not 1 <= count <= 16 or (got := _fields(data, at + 4, count + 1)) is None:
        return None
    (*public, private), at = got
    for blob in public:
        parts = _fields(blob, 0)
        if parts is None or len(parts[0]) < 2 or not parts[0][0].isascii():
            return None
    if len(private) < 16 or len(private) % 8:
        return None
    kind = _fields(public[0], 0)[0][0]
    if cipher == b"none":  # the check number twice, then the kind of the first key
        inner = _fields(private, 8, 1)
        if private[:4] != private[4:8] or inner is None or inner[0][0] != kind:
            return None
    return at


def _der_end(data: bytes) -> int | None:
    """Where the DER of a PKCS#1, PKCS#8 or SEC 1 private key at the start of ``data`` ends."""
    if data[:1] != b"\x30" or (got := _der_length(data, 0)) is None or got[0] + got[1] > len(data):
        return None
    end = got[0] + got[1]
    inner = _der_children(data, got[1], end)
    if not inner or len(inner) < 2 or inner[0][0] != 2 or inner[0][2] - inner[0][1] != 1:
        return None
    tags = [t for t, _, _ in inner]
    if len(tags) >= 9 and set(tags[:9]) == {2}:  # version and the eight numbers of an RSA key
        return end
    if tags[1] == 0x30 and len(tags) >= 3 and tags[2] == 4:  # algorithm, then the wrapped key
        algorithm = _der_children(data, inner[1][1], inner[1][2])
        return end if algorithm and algorithm[0][0] == 6 else None
    return end if tags[1] == 4 and 16 <= inner[1][2] - inner[1][1] <= 80 and all(t in (0xA0, 0xA1) for t in tags[2:]) else None


def key_end(data: bytes) -> int | None:
    """Where the private key at the start of ``data`` ends by all its nested lengths; None where there is none."""
    return _openssh_end(data) if data.startswith(b"openssh-key-v1\0") else _der_end(data)


def is_private_key(data: bytes) -> bool:
    """Whether the bytes are one private key, as DER or in the OpenSSH format, and nothing else."""
    return key_end(data) == len(data)


def _keys_within(data: bytes) -> Iterator[tuple[int, int]]:
    """Start and end of the private keys in ``data``, without overlap."""
    at = 0
    while head := KEY_HEAD.search(data, at):
        n = key_end(data[head.start() : head.start() + MAX_KEY])
        if n:
            yield head.start(), head.start() + n
        at = head.start() + (n or 1)


def _encoded_keys(text: str) -> Iterator[tuple[int, int]]:
    """Spans of private keys in base64, whatever comes before and after them in the same run of characters."""
    for m in BASE64.finditer(text):
        if m.end() - m.start() < 44:
            continue
        places = [m.start() + i for i, c in enumerate(m[0]) if c not in "\r\n \t="]
        body = "".join(text[i] for i in places) if len(places) < m.end() - m.start() else m[0]
        found: list[tuple[int, int]] = []
        for skip in range(4):  # a key can start at any character of the run
            part = body[skip:]
            data = base64.b64decode(part[: len(part) // 4 * 4] + _padded(part[len(part) // 4 * 4 :]))
            for start, end in _keys_within(data):
                if start % 3 == 0:
                    first, last = skip + start // 3 * 4, skip + -(-end * 8 // 6) - 1
                    stop = places[last] + 1
                    while end % 3 and stop < m.end() and text[stop] == "=":
                        stop += 1
                    found.append((places[first], stop))
        yield from _apart(found)


def _hex_keys(text: str) -> Iterator[tuple[int, int]]:
    for m in HEXKEY.finditer(text):
        found = []
        for skip in range(2):
            part = m[0][skip:]
            for start, end in _keys_within(bytes.fromhex(part[: len(part) // 2 * 2])):
                found.append((m.start() + skip + 2 * start, m.start() + skip + 2 * end))
        yield from _apart(found)


def _apart(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Spans in order; of those that overlap, the first and longest."""
    end = -1
    for start, stop in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= end:
            yield start, stop
            end = stop


def _padded(rest: str) -> str:
    return "" if len(rest) < 2 else rest + "=" * (4 - len(rest))


def _unbase64(text: str) -> bytes | None:
    """The bytes of base64 with or without its padding; None where it is not base64."""
    body = text.rstrip("=")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part: str) -> dict | None:
    raw = _unbase64(part.replace("-", "+").replace("_", "/"))
    try:
        value = json.loads(raw.decode()) if raw else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def find_spans(text: str) -> list[tuple[int, str, int]]:
    """All spans of one text as (start, kind, end) in order."""
    found: list[tuple[int, str, int]] = []
    lower = text.lower()  # only to see whether a pattern can match at all
    if any(w in lower for w in WORDS):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    raw = text.encode("utf-8", "surrogatepass")
    if b"x" * 32 in raw.translate(HEX_RUN):
        found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    if text.count(".") > 1:
        at = 0
        while m := JWT.search(text, at):  # a word and a dot before the header are no part of it
            head = _json_object(m[1])
            signed = head and isinstance(head.get("alg"), str) and _json_object(m[2]) is not None
            if signed:
                found.append((m.start(), "jwt", m.end()))
            at = m.end() if signed else m.end(1)
    if "PRIVATE KEY-----" in text:
        for m in PEM.finditer(text):
            key = _unbase64("".join(m[2].split()))
            if key and is_private_key(key):
                found.append((m.start(), "pem", m.end()))
    if b"x" * 40 in raw.translate(CODE_RUN):
        pem = [(a, b) for a, kind, b in found if kind == "pem"]
        found += [(a, "der", b) for a, b in _encoded_keys(text) if not any(s <= a < e for s, e in pem)]
        found += [(a, "hexkey", b) for a, b in _hex_keys(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and its spans (kind, start, end) in code points, end exclusive.

    ``assign``, ``access`` and ``hex`` are plain patterns, leftmost and without overlap per kind.
    ``jwt`` needs a header that decodes to a JSON object with an algorithm and a body that decodes
    to one; ``pem``, ``der`` and ``hexkey`` need bytes whose nested lengths are those of a private
    key. Such a key may start and end anywhere in a run of base64 or hex, and base64 may be wrapped over
    lines. A null text counts as empty and has no span; repeated rows give repeated rows, an empty
    table none. Texts are scanned whole; columns other than these two are not read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [
            [{"kind": k, "start": s, "end": e} for s, k, e in find_spans(t or "")]
            for t in batch.column("text").to_pylist()
        ]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, SPANS)], ["doc_id", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(per_slice(run), SCHEMA)
