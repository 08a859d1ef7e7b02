"""Secret scans: pattern matches, and spans that are reported only when their structure confirms them.

Base kinds are pattern matches with a least length: ``assign`` (a named value), ``access`` (an
access key id) and ``hex`` (a run of hex digits). The method adds kinds by decoding candidates and
parsing what comes out; a candidate that doesn't parse to its last byte is not reported:

* ``pem``: a private-key block; its body decodes from base64 and is a key encoding (or, with
  encryption headers, whole cipher blocks).
* ``key``: a run of base64 or hex digits that decodes to a key encoding.
* ``jwt``: three base64url parts; the header is a JSON object that names its algorithm, the payload a
  JSON object, and the signature has the length that the algorithm gives (none: empty).
* ``blob``: base64 or hex of text that holds an ``assign`` or ``access`` match of its own.

Key encodings are DER structures (two-prime RSA, PKCS#8, encrypted PKCS#8, EC) whose nested lengths
must fill their parents exactly, and the length-prefixed strings of an OpenSSH private key.

Every base match is one span ``kind:start:end`` in code points, end exclusive, of the whole match;
kinds may overlap each other, matches of one kind don't. Texts are scanned whole, in one pass per
pattern, whatever their length: each pattern's repeats are over disjoint classes and every
candidate is decoded once. Null and empty texts have no spans, repeated rows are scanned alike, an
empty table gives no rows, and only ``keep`` columns and the text are read. A task holds one slice
of an Arrow batch.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlens.llm.common import mapped, text_slices

SLICE_BYTES = 1 << 20
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "pem", "key", "jwt", "blob")
#: Least characters: of the value of ``assign``, and of a whole ``access`` and ``hex`` match.
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
#: Least characters of a run that is decoded.
LEAST_RUN = 40
#: Signature bytes by algorithm family of a signed token; None: any.
SIGNATURES = {"none": (0,), "HS256": (32,), "HS384": (48,), "HS512": (64,), "ES256": (64,), "ES384": (96,), "ES512": (132,), "EdDSA": (64, 114)}

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: A text without any of these, letters in lower case, has no ``assign`` match.
ASSIGN_PARTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST_HEX)
HEX_RUN = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{%d,}|[0-9A-F]{%d,})(?![0-9A-Za-z])" % (LEAST_RUN, LEAST_RUN))
BASE64_RUN = re.compile(r"[A-Za-z0-9+/]{%d,}={0,2}" % LEAST_RUN)
BASE64_URL_RUN = re.compile(r"[A-Za-z0-9_-]{%d,}={0,2}" % LEAST_RUN)
JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----([A-Za-z0-9+/=\s:,-]*?)-----END \1-----")


def _unpadded(run: str, url: bool = False) -> bytes | None:
    """Bytes of base64 text with or without its padding; None if it is none."""
    body = run.rstrip("=")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), altchars=b"-_" if url else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start, end) of the contents of the DER element at ``at``; None unless it ends by ``end``."""
    if at + 2 > end:
        return None
    tag, n, at = data[at], data[at + 1], at + 2
    if n >= 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or at + size > end or data[at] == 0:
            return None
        n, at = int.from_bytes(data[at : at + size], "big"), at + size
        if n < 0x80:
            return None  # DER gives the shortest length
    return (tag, at, at + n) if at + n <= end else None


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``at`` to ``end`` exactly; None if they don't."""
    out = []
    while at < end:
        one = _element(data, at, end)
        if one is None or len(out) > 64:
            return None
        out.append(one)
        at = one[2]
    return out


def der_key(data: bytes) -> str | None:
    """Kind of the private key that ``data`` encodes, every nested length filled; else None."""
    outer = _elements(data, 0, len(data))
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return None
    parts = _elements(data, outer[0][1], outer[0][2])
    if not parts:
        return None
    tags = [p[0] for p in parts]
    if tags[0] == 0x30 and tags == [0x30, 0x04]:
        algorithm = _elements(data, parts[0][1], parts[0][2])
        return "encrypted-pkcs8" if algorithm and algorithm[0][0] == 0x06 and len(algorithm) == 2 else None
    if tags[0] != 0x02 or parts[0][2] - parts[0][1] != 1:
        return None
    version = data[parts[0][1]]
    if version == 0 and len(tags) == 9 and set(tags) == {0x02}:
        n, p, q = (int.from_bytes(data[s:e], "big") for _, s, e in (parts[1], parts[4], parts[5]))
        return "rsa" if p > 1 and p * q == n else None
    if version in (0, 1) and tags[1:3] == [0x30, 0x04] and set(tags[3:]) <= {0xA0, 0x81, 0xA1}:
        algorithm = _elements(data, parts[1][1], parts[1][2])
        return "pkcs8" if algorithm and algorithm[0][0] == 0x06 and _elements(data, parts[2][1], parts[2][2]) else None
    if version == 1 and tags[1:2] == [0x04] and set(tags[2:]) <= {0xA0, 0xA1}:
        return "ec" if 16 <= parts[1][2] - parts[1][1] <= 66 and all(_elements(data, s, e) for _, s, e in parts[2:]) else None
    return None


def openssh_key(data: bytes) -> str | None:
    """``openssh`` if the length-prefixed strings of an OpenSSH private key fill ``data`` exactly."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return None
    at, lengths = len(magic), 0

    def string() -> bytes | None:
        nonlocal at
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data) or len(data) < at + 4:
            return None
        at += 4 + n
        return data[at - n : at]

    if any(string() is None for _ in range(3)):  # cipher, derivation and its options
        return None
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    while lengths <= keys:  # the public keys, then the private part
        if string() is None:
            return None
        lengths += 1
    return "openssh" if keys >= 1 and at == len(data) else None


def key_of(data: bytes | None) -> str | None:
    return (der_key(data) or openssh_key(data)) if data else None


def signed_token(header: str, payload: str, signature: str) -> bool:
    """Whether three parts are a signed token: header and payload JSON objects, signature as its algorithm says."""
    parts = [_unpadded(p, url=True) for p in (header, payload)]
    sign = _unpadded(signature, url=True) if signature else b""
    if None in parts or sign is None:
        return False
    try:
        head, body = (json.loads(p.decode()) for p in parts)
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    lengths = SIGNATURES.get(head["alg"])
    return len(sign) in lengths if lengths else len(sign) >= 64


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, index of kind, end) of the base matches."""
    out = []
    lowered = text.lower()
    if any(p in lowered for p in ASSIGN_PARTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _readable(data: bytes | None) -> bool:
    """Whether bytes are printable text that holds a named value or an access key id."""
    if not data:
        return False
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return False
    return all(c.isprintable() or c in "\r\n\t" for c in text) and any(k < 2 for _, k, _ in base_spans(text))


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, index of kind, end) of the candidates whose structure holds."""
    out = set()
    if "PRIVATE KEY-----" in text:
        for m in PEM.finditer(text):
            body, encrypted = m.group(2), "Proc-Type:" in m.group(2)
            body = re.split(r"\r?\n\r?\n", body, maxsplit=1)[-1] if encrypted else body
            data = _unpadded("".join(body.split()))
            if data and (key_of(data) or (encrypted and len(data) % 8 == 0)):
                out.add((m.start(), KINDS.index("pem"), m.end()))
    if "eyJ" in text:
        out.update((m.start(), KINDS.index("jwt"), m.end()) for m in JWT.finditer(text) if signed_token(*m.groups()))
    runs = [(m, _unpadded(m.group())) for m in BASE64_RUN.finditer(text)]
    runs += [(m, _unpadded(m.group(), url=True)) for m in BASE64_URL_RUN.finditer(text) if "-" in m.group() or "_" in m.group()]
    runs += [(m, bytes.fromhex(m.group())) for m in HEX_RUN.finditer(text) if len(m.group()) % 2 == 0]
    for m, data in runs:
        kind = "key" if key_of(data) else "blob" if _readable(data) else None
        if kind:
            out.add((m.start(), KINDS.index(kind), m.end()))
    return sorted(out)


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, matches per base kind, digest of the base spans, and all spans of ``text``."""
    counts = [f"n_{k}" for k in BASE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "__text", SLICE_BYTES):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            base = [base_spans(t) if t else [] for t in texts]
            more = [confirmed_spans(t) if t else [] for t in texts]
            per_kind = [pa.array([sum(k == i for _, k, _ in spans) for spans in base], pa.int64()) for i in range(len(BASE))]
            digests = pa.array([hashlib.sha256(listed(spans).encode()).hexdigest() for spans in base], pa.string())
            spans = pa.array([listed(sorted([*a, *b])) for a, b in zip(base, more)], pa.string())
            confirmed = pa.array([len(b) for b in more], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *per_kind, digests, spans, confirmed],
                                             [*batch.schema.names[:-1], *counts, "base_sha256", "spans", "n_confirmed"])

    rows = df.select(*keep, F.col(text).cast("string").alias("__text"))
    fields = [T.StructField(c, T.LongType()) for c in counts]
    fields += [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_confirmed", T.LongType())]
    return mapped(rows, run, T.StructType([*rows.schema.fields[:-1], *fields]))
