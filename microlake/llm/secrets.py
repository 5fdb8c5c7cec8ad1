"""Secret scans: Aho-Corasick prefilter, anchored expressions at the hits, checksum validation.

One automaton holds the keywords of every kind. A document without a keyword and without a
long hexadecimal run costs one pass of the automaton and one scan for the run; an
expression is tried only where its keyword stands, anchored there. Kinds with an embedded
check are kept only if it holds:

* ``github``  tokens ``gh?_`` + 30 characters + the CRC-32 of these in 6 base-62 digits
* ``npm``     tokens ``npm_``, built the same way
* ``jwt``     three base64url parts, the first two JSON objects, the first with ``alg``
* ``pem``     private key blocks whose base64 body is one DER sequence of the stated length, an
              ``openssh-key-v1`` record whose length fields add up, or, behind the header lines
              of an encrypted block, whole cipher blocks

An expression that fails scans no character run twice: hits further on in a run that cannot
lead to a match are passed over, so time grows with the text alone.

The kinds of the base set have no checksum; for them the stated length decides:

* ``assign``  a password, secret, token or key set to a value of 6 or more characters
* ``access``  ``AKIA`` identifiers of 20 or more characters
* ``hex``     lowercase hexadecimal runs of 24 or more digits

Spans are (kind, start, end) in code points, end exclusive.
"""
from __future__ import annotations

import base64
import binascii
import json
import re
import zlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm", "jwt", "pem")
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

#: kind -> (keywords, expression anchored at the keyword). On bytes: only ASCII letters have two cases.
_RULES = {
    "assign": ((b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey"),
               re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)),
    "access": ((b"akia",), re.compile(rb"AKIA[A-Z0-9]+")),
    "github": ((b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_"), re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")),
    "npm": ((b"npm_",), re.compile(rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")),
    "jwt": ((b"eyj",), re.compile(rb"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")),
    "pem": ((b"-----begin ",), re.compile(rb"-----BEGIN ([A-Z ]*PRIVATE KEY)-----((?:\s*+[A-Za-z][A-Za-z0-9-]*+:[\x20-\x7e]*+(?=\s))*+)"
                                            rb"([A-Za-z0-9+/=\s]+)-----END \1-----")),
}
_HEX = re.compile(rb"[0-9a-f]{24,}")
_OPENSSH = b"openssh-key-v1\0"
#: Cipher and initial vector of an encrypted block; the vector is as long as a cipher block.
_DEK = re.compile(rb"DEK-Info:\s*([A-Za-z0-9-]+),\s*((?:[0-9A-Fa-f]{2})+)")
#: The run a failed ``jwt`` has read: no later start in it can find the dots that were missing.
_JWT_PART = re.compile(rb"[A-Za-z0-9_-]*")
_ORDER = {kind: k for k, kind in enumerate(KINDS)}


def base62_crc(body: bytes) -> bytes:
    """CRC-32 of ``body`` in six base-62 digits."""
    x, out = zlib.crc32(body), ""
    for _ in range(6):
        x, d = divmod(x, 62)
        out = _DIGITS[d] + out
    return out.encode()


def _json_part(part: bytes) -> dict | None:
    try:
        value = json.loads(base64.urlsafe_b64decode(part + b"=" * (-len(part) % 4)))
    except (ValueError, binascii.Error, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _der_whole(der: bytes) -> bool:
    if len(der) < 2 or der[0] != 0x30:
        return False
    if der[1] < 0x80:
        return len(der) == 2 + der[1]
    n = der[1] & 0x7F
    return 0 < n <= 4 and len(der) == 2 + n + int.from_bytes(der[2:2 + n], "big")


def _openssh_whole(record: bytes) -> bool:
    """Cipher, derivation and its options, the number of keys, their public parts, the private part."""
    if not record.startswith(_OPENSSH):
        return False
    number = lambda at: int.from_bytes(record[at:at + 4], "big")
    at = len(_OPENSSH)
    cipher = record[at + 4:at + 4 + number(at)]
    for _ in range(3):
        at += 4 + number(at)
    keys = number(at)
    if not 0 < keys <= len(record):
        return False
    at += 4
    for _ in range(keys + 1):
        if at + 4 > len(record):
            return False
        at += 4 + number(at)
    tag = 16 if b"gcm" in cipher or b"poly1305" in cipher else 0
    return at + tag == len(record)


def _pem_whole(headers: bytes, body: bytes) -> bool:
    try:
        data = base64.b64decode(b"".join(body.split()), validate=True)
    except (ValueError, binascii.Error):
        return False
    if b"ENCRYPTED" in headers:
        dek = _DEK.search(headers)
        block = len(dek[2]) // 2 if dek else 0
        return bool(data) and block > 0 and (not dek[1].endswith(b"CBC") or len(data) % block == 0)
    return _der_whole(data) or _openssh_whole(data)


def _holds(kind: str, match: re.Match) -> bool:
    """The length or embedded check of a kind."""
    if kind == "assign":
        return len(match[2]) >= 6
    if kind == "access":
        return len(match[0]) >= 20
    if kind in ("github", "npm"):
        return base62_crc(match[0][4:34]) == match[0][34:]
    if kind == "jwt":
        head, payload, _ = match[0].split(b".")
        first = _json_part(head)
        return first is not None and "alg" in first and _json_part(payload) is not None
    return _pem_whole(match[2], match[3])


def _automaton():
    found = ahocorasick.Automaton()
    for kind, (keywords, _) in _RULES.items():
        for word in keywords:
            found.add_word(word.decode("latin-1"), (kind, len(word)))
    found.make_automaton()
    return found


class Scanner:
    """Spans of all kinds in a text."""

    def __init__(self):
        self._near = _automaton()

    def _in_bytes(self, data: bytes) -> list[tuple[int, int, str]]:
        hits: dict[str, list[int]] = {}
        for end, (kind, n) in self._near.iter(data.lower().decode("latin-1")):
            hits.setdefault(kind, []).append(end + 1 - n)
        spans = []
        for kind, starts in hits.items():
            at, expression = 0, _RULES[kind][1]
            for start in sorted(starts):
                if start < at:              # inside the match before it: leftmost, not overlapping
                    continue
                match = expression.match(data, start)
                if match:
                    at = match.end()
                    if _holds(kind, match):
                        spans.append((start, at, kind))
                elif kind == "jwt" and data.startswith(b"eyJ", start):
                    at = _JWT_PART.match(data, start).end()
        spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(data)]
        spans.sort(key=lambda s: (s[0], _ORDER[s[2]], s[1]))
        return spans

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        """(kind, start, end) by start, then kind as listed. Null and empty texts have none."""
        if not text:
            return []
        data = text.encode("utf-8", "surrogatepass")
        found = self._in_bytes(data)
        if len(data) == len(text):
            return [(kind, a, b) for a, b, kind in found]
        out, at, chars = [], 0, 0
        for a, b, kind in found:            # starts ascend, so the prefix is counted once
            chars += len(data[at:a].decode("utf-8", "surrogatepass"))
            at = a
            out.append((kind, chars, chars + len(data[a:b].decode("utf-8", "surrogatepass"))))
        return out


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every run of touching or overlapping spans replaced by its first kind in brackets."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _scan_batches(batches):
    scanner = Scanner()
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    for batch in batches:
        found = [[{"kind": k, "start": a, "end": b} for k, a, b in scanner.spans(t.as_py())] for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(span))], names=["doc_id", "found"])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, found): per document row all spans, an array of (kind, start, end) by start.

    Null and empty texts have an empty array; repeated rows and null doc_ids stay; an empty
    table gives no rows; other columns are not read.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_scan_batches, "doc_id long, found array<struct<kind:string,start:int,end:int>>")


def _redact_batches(text_at: int, chars_at: int | None):
    def run(batches):
        scanner = Scanner()
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            spans = [scanner.spans(t) for t in texts]
            cols = list(batch.columns)
            cols[text_at] = pa.array([redact(t, s) if s else t for t, s in zip(texts, spans)], batch.schema.field(text_at).type)
            if chars_at is not None:
                new = cols[text_at].to_pylist()
                cols[chars_at] = pa.array([len(t) if s else n for t, s, n in zip(new, spans, batch.column(chars_at).to_pylist())],
                                          batch.schema.field(chars_at).type)
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    return run


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret replaced by its kind in brackets; ``n_chars``, where there is one, follows.

    All rows and columns stay; texts without a secret are unchanged.
    """
    fields = docs.schema.fieldNames()
    chars = fields.index("n_chars") if "n_chars" in fields else None
    return docs.mapInArrow(_redact_batches(fields.index("text"), chars), docs.schema)
