"""Secret scans of whole texts: patterns first, structure as confirmation.

Three plain patterns give the base spans. Beyond them, base64 and hex candidates are decoded
and reported only when the bytes are a private key (nested DER lengths, or the OpenSSH
container to its end) or when a dotted text is a signed token whose header parses. Base64 may be
wrapped in lines, with or without PEM marks; without them the key's own length says where it ends.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from advisory_lake.llm.shared import id_and_text, per_row

KINDS = ("assign", "access", "hex", "private_key", "signed_token")

_ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----((?:[^-]++|-(?!----))*+)-----END \1-----")
_PEM_HEADER = re.compile(r"[\x20\t]*([A-Za-z-]+):[\x20\t]*(.*)")
_CIPHER = re.compile(r"[A-Z0-9-]+,((?:[0-9A-Fa-f]{16}){1,2})")
_ESCAPED_BREAK = re.compile(r"\\+[nr]")  # of texts inside JSON, which may be inside JSON again
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
_BASE64_LINES = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}(?:(?:\r?\n|(?:\\+r)?\\+n)[\x20\t]*[A-Za-z0-9+/_-]+)+")
_BREAK = re.compile(r"(?:\r?\n|(?:\\+r)?\\+n)[\x20\t]*")
_LONG_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_.-])")

_OPENSSH = b"openssh-key-v1\x00"
_INTEGER, _BITS, _OCTETS, _OBJECT_ID, _SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three plain patterns."""
    spans = []
    lowered = text.lower()
    if any(word in lowered for word in _ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans whose decoded bytes are a private key or a signed token."""
    spans = []
    if "PRIVATE KEY-----" in text:
        spans += [(m.start(), 3, m.end()) for m in _PEM.finditer(text) if is_private_block(_ESCAPED_BREAK.sub("\n", m[2]))]
    inside, tried = [(a, b) for a, _, b in spans], 0  # in order, none over another

    def covered(place: int) -> bool:
        i = bisect.bisect_left(inside, (place + 1,)) - 1
        return i >= 0 and place < inside[i][1]

    for m in _BASE64.finditer(text):
        if covered(m.start()):
            continue
        end = m.end() if is_private_key(decoded_base64(m[0])) else None
        if end is None and m.start() >= tried and (lines := _BASE64_LINES.match(text, m.start())):
            end, tried = _wrapped_end(text, lines), lines.end()
        if end is not None:
            spans.append((m.start(), 3, end))
            bisect.insort(inside, (m.start(), end))
    for m in _LONG_HEX.finditer(text):
        if not covered(m.start()) and is_private_key(bytes.fromhex(m[0])):
            spans.append((m.start(), 3, m.end()))
    if "eyJ" in text:
        spans += [(m.start(), 4, m.end()) for m in _TOKEN.finditer(text) if is_signed_token(m[1], m[2], m[3])]
    return spans


def decoded_base64(text: str) -> bytes | None:
    """Either alphabet, white space and missing padding allowed; None when it is not base64."""
    packed = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(packed + "=" * (-len(packed) % 4), validate=True)
    except binascii.Error:
        return None


def is_private_block(body: str) -> bool:
    """What stands between the marks of a PEM block: a key, or, after headers that name cipher and
    start value, bytes that fill blocks of that cipher."""
    lines, headers = body.strip().split("\n"), {}
    while lines and (m := _PEM_HEADER.fullmatch(lines[0].rstrip())):
        headers[m[1]] = m[2]
        del lines[0]
    data = decoded_base64("\n".join(lines))
    if headers.get("Proc-Type", "").replace(" ", "") != "4,ENCRYPTED":
        return is_private_key(data)
    named = _CIPHER.fullmatch(headers.get("DEK-Info", "").strip())
    return bool(named and data) and len(data) % (len(named[1]) // 2) == 0


def _wrapped_end(text: str, m: re.Match) -> int | None:
    """Where a key ends that begins a run of base64 lines; words on the lines below are not part
    of it, since the key tells its own length."""
    if text[m.start()] not in "Mb":  # of a sequence, of the OpenSSH name
        return None
    breaks = [(b.start(), b.end()) for b in _BREAK.finditer(text, m.start(), m.end())]
    stretches = list(zip([m.start(), *(b for _, b in breaks)], [*(a for a, _ in breaks), m.end()]))
    letters = "".join([text[a:b] for a, b in stretches])
    data = decoded_base64(letters[: len(letters) - (len(letters) % 4 == 1)])
    size = key_size(data) if data else None
    if size is None:
        return None
    wanted = -(-size * 4 // 3)
    data = decoded_base64(letters[:wanted])
    if wanted > len(letters) or data is None or not is_private_key(data):
        return None
    for a, b in stretches:
        if wanted <= b - a:
            end = a + wanted
            if end < b:  # letters that go on are no end
                return None
            while end < len(text) and text[end] == "=" and end < b + 2:
                end += 1
            return end
        wanted -= b - a
    return None


def key_size(data: bytes) -> int | None:
    """Bytes of the key that ``data`` begins with, by its own lengths."""
    if data.startswith(_OPENSSH):
        return _openssh_end(data)
    if len(data) < 6 or data[0] != _SEQUENCE:
        return None
    width = data[1] & 0x7F if data[1] & 0x80 else 0
    return 2 + width + (int.from_bytes(data[2 : 2 + width]) if width else data[1]) if width <= 4 else None


def _openssh_end(data: bytes) -> int | None:
    """Where an OpenSSH container ends: names of cipher and key derivation, options, public keys and
    the private part; that of a plain key begins with a number given twice."""
    at = len(_OPENSSH)

    def field() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4]) if at + 4 <= len(data) else len(data)
        start, at = at + 4, at + 4 + size
        return data[start:at] if at <= len(data) else None

    cipher, derivation, options = field(), field(), field()
    if not cipher or not derivation or options is None or at + 4 > len(data) or not (cipher + derivation).isascii():
        return None
    keys, at = int.from_bytes(data[at : at + 4]), at + 4
    if not 1 <= keys <= 16:
        return None
    for _ in range(keys):
        public = field()
        if public is None or not 0 < int.from_bytes(public[:4]) <= len(public) - 4:
            return None
    private = field()
    if not private or len(private) < 8 or len(private) % 8:
        return None
    if cipher == b"none" and (derivation != b"none" or options or private[:4] != private[4:8]):
        return None
    return at


def _items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and content of consecutive DER values that fill the bytes exactly."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size = int.from_bytes(data[at : at + width])
            if size < 128 or data[at] == 0:  # DER lengths are the shortest possible
                return None
            at += width
        if at + size > len(data):
            return None
        items.append((tag, data[at : at + size]))
        at += size
    return items


def is_private_key(data: bytes | None) -> bool:
    """PKCS#1, PKCS#8 (plain and encrypted), SEC 1, DSA or OpenSSH, by structure."""
    if not data:
        return False
    if data.startswith(_OPENSSH):
        return _openssh_end(data) == len(data)
    if data[0] != _SEQUENCE:
        return False
    outer = _items(data)
    if not outer or len(outer) != 1:
        return False
    fields = _items(outer[0][1])
    if not fields:
        return False
    tags = [tag for tag, _ in fields]
    if tags[0] == _INTEGER and len(fields[0][1]) == 1 and fields[0][1][0] in (0, 1):
        if len(tags) >= 9 and all(tag == _INTEGER for tag in tags[:9]):
            return True  # RSA: version and eight numbers
        if tags == [_INTEGER] * 6:  # DSA: version, prime, its subgroup's order, generator, both keys
            prime, group, generator, public, private = (len(content) for _, content in fields[1:])
            return prime >= 64 and 20 <= group <= 33 and 0 < private <= group and 0 < max(generator, public) <= prime
        if tags[1:3] == [_SEQUENCE, _OCTETS]:  # an algorithm, then the wrapped key
            named = _items(fields[1][1])
            return bool(named) and named[0][0] == _OBJECT_ID
        return fields[0][1][0] == 1 and len(tags) > 1 and tags[1] == _OCTETS and len(fields[1][1]) in (28, 32, 48, 66)
    if tags == [_SEQUENCE, _OCTETS]:  # encrypted: an algorithm with parameters, then bytes
        named = _items(fields[0][1])
        return bool(named) and named[0][0] == _OBJECT_ID and len(named) == 2
    return False


def is_signed_token(header: str, claims: str, signature: str) -> bool:
    try:
        top, body = (json.loads(decoded_base64(part) or b"") for part in (header, claims))
    except ValueError:
        return False
    signed = isinstance(top, dict) and isinstance(top.get("alg"), str) and top["alg"].lower() != "none"
    return signed and isinstance(body, dict) and len(decoded_base64(signature) or b"") >= 16


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


_ROWS = pa.schema(
    [("doc_id", pa.int64())]
    + [(name, pa.int64()) for name in ("n_assign", "n_access", "n_hex", "n_private_key", "n_signed_token")]
    + [("base_sha256", pa.string()), ("spans", pa.string())]
)


def _scanned(doc_id, text):
    base = base_spans(text or "")
    found = sorted(base + confirmed_spans(text or ""))
    counts = [sum(kind == k for _, kind, _ in found) for k in range(len(KINDS))]
    return (doc_id, *counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(found))


def scan(docs: DataFrame) -> DataFrame:
    """Secrets of each document: counts by kind, the digest of the base spans and all spans as
    ``kind:start:end`` in code points, end exclusive.

    Null and empty texts have no spans. Every row gives a row, repeated ones too; columns other
    than doc_id and text do not matter. Spans of different kinds may overlap.
    """
    return id_and_text(docs).mapInArrow(per_row(_scanned, _ROWS), ddl(_ROWS))


def redact(docs: DataFrame, mask: str = "[REDACTED]") -> DataFrame:
    """The same rows and columns with every span of ``text`` replaced; null stays null."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StringType

    @F.pandas_udf(StringType())
    def masked(texts):
        return texts.map(lambda text: None if text is None else _masked(text, mask))

    return docs.withColumn("text", masked(F.col("text").cast("string")))


def _masked(text: str, mask: str) -> str:
    pieces, at = [], 0
    for start, _, end in sorted(base_spans(text) + confirmed_spans(text)):
        if end <= at:
            continue
        if start >= at:
            pieces += [text[at:start], mask]
        at = end
    return "".join([*pieces, text[at:]]) if pieces else text


def ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "BIGINT", pa.string(): "STRING"}
    return ", ".join(f"`{field.name}` {names[field.type]}" for field in schema)
