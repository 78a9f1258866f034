"""Secrets in texts: candidates by pattern, more of them confirmed by their inner structure.

Three base kinds are patterns alone. Three further kinds are reported only after parsing:

* `jwt`: three base64url parts whose first is a JSON object with an "alg";
* `der`: base64 or hex that decodes to a DER private key, every nested length checked;
* `ssh`: base64 that decodes to an OpenSSH private key container, lengths checked.

Keys in base64 may follow any character, also one of base64 (the n of an escaped line break,
a header or path without a break). Where they end follows from their lengths; there a line
must end, or what is no base64, or the other alphabet, or a PEM footer must follow.

Offsets are code points, ends exclusive. Null and empty texts have no spans.
"""

import base64
import binascii
import codecs
import json
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmon.llm.common import whole

# Kinds and patterns of the base scan
BASE = {
    "assign": (
        re.compile(
            r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        lambda m: len(m.group(1)) >= 8,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 16),
    "hex": (re.compile(r"[0-9a-f]{32,}"), lambda m: True),
}
KINDS = [*BASE, "jwt", "der", "ssh"]
_WORDS = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)
_HEADER = re.compile("eyJ")  # how a JSON object begins in base64, after whatever character
_PART = re.compile("[A-Za-z0-9_-]+")
_PARTS = re.compile(r"\.([A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+")
_KEY = re.compile(r"M(?=[A-I][A-Za-z0-9+/_-]{22})|b(?=3BlbnNzaC1rZXktdjEA)")  # how they begin in base64
_RUN = re.compile(r"[A-Za-z0-9+/_-]+(?:(?:(?:\\+r)?\\+n|\r?\n)[ \t]*[A-Za-z0-9+/_-]+)*")
_LINE = re.compile(r"(?:(?:\\+r)?\\+n|\r?\n)[ \t]*|([A-Za-z0-9+/_-]+)")
_PADDING = re.compile("={0,2}")
_HEX = re.compile(r"[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){23,}|[0-9A-Fa-f]{48,}")
_SEQUENCE = re.compile("(?=30)")
_GAPS = re.compile(r"\\n|\s")
SSH_MAGIC = b"openssh-key-v1\0"


def decoded(block: str) -> bytes | None:
    """Base64 of either alphabet, white space and missing padding allowed."""
    body = _GAPS.sub("", block).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


class Run:
    """Lines of base64 characters, of which any may be the first of a key."""

    def __init__(self, text: str, start: int, end: int):
        self.text = text
        lines = [m.span(1) for m in _LINE.finditer(text, start, end) if m.group(1)]
        self.starts, self.places, size = [a for a, _ in lines], [], 0
        for a, b in lines:
            self.places.append(size)
            size += b - a
        self.body = "".join(text[a:b] for a, b in lines)
        self.phases: dict[int, memoryview] = {}

    def place(self, at: int) -> int:
        """Where a position of the text is in the body."""
        line = bisect_right(self.starts, at) - 1
        return self.places[line] + at - self.starts[line]

    def at(self, place: int) -> int:
        line = bisect_right(self.places, place) - 1
        return self.starts[line] + place - self.places[line]

    def content(self, place: int) -> memoryview:
        """What is decoded from here on; the run is decoded four times at most."""
        phase = place % 4
        if phase not in self.phases:
            body = self.body[phase:]
            self.phases[phase] = memoryview(decoded(body[: len(body) - (len(body) % 4 == 1)]) or b"")
        return self.phases[phase][place // 4 * 3 :]

    def end(self, place: int, size: int) -> int | None:
        """Where in the text a key of so many bytes ends, if it may end there."""
        last = place + -(-size * 4 // 3)
        end = self.at(last - 1) + 1
        if last < len(self.body) and self.at(last) == end and not self.text.startswith("-----", end):
            key = self.body[place:last]
            other = "-_" if "+" in key or "/" in key else "+/" if "-" in key or "_" in key else ""
            if self.text[end] not in other:
                return None
        return _PADDING.match(self.text, end).end()


def keys(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the private keys in base64, none inside another."""
    run, stop, after = None, 0, 0
    for m in _KEY.finditer(text):
        start = m.start()
        if start < after:
            continue
        if start >= stop:
            stop = _RUN.match(text, start).end()
            run = Run(text, start, stop)
        place = run.place(start)
        data = run.content(place)
        kind, size = ("der", der_size(data)) if m.group() == "M" else ("ssh", ssh_size(data))
        end = run.end(place, size) if size else None
        if end and (kind == "ssh" or is_der_key(data[:size])):
            yield kind, start, end
            after = end


def der_size(data: memoryview) -> int | None:
    """Bytes of the sequence that `data` begins with, if all are there and a number is first."""
    if len(data) < 6:
        return None
    size, at = data[1], 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4:
            return None
        size, at = int.from_bytes(data[2 : 2 + n], "big"), 2 + n
    return at + size if at + size <= len(data) and data[at : at + 1] == b"\2" else None


def der_items(data: bytes | memoryview) -> list[tuple[int, bytes | memoryview]] | None:
    """(tag, content) of the values that fill `data` exactly, or None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def is_der_key(data: bytes | memoryview) -> bool:
    """A private key: RSA or DSA integers, an EC key, or either wrapped with its algorithm."""
    outer = der_items(data) if data[:1] == b"\x30" else None
    if not outer or len(outer) != 1:
        return False
    inner = der_items(outer[0][1])
    if not inner or inner[0][0] != 0x02 or inner[0][1] not in (b"\0", b"\1"):
        return False
    tags = [tag for tag, _ in inner]
    if len(inner) >= 6 and tags[:6] == [0x02] * 6:
        return all(value for _, value in inner[:6])
    if tags[:2] == [0x02, 0x04] and inner[0][1] == b"\1":
        return len(inner[1][1]) >= 16 and all(t in (0xA0, 0xA1) and der_items(v) for t, v in inner[2:])
    if tags[:3] == [0x02, 0x30, 0x04]:
        algorithm = der_items(inner[1][1])
        return bool(algorithm) and algorithm[0][0] == 0x06 and len(inner[2][1]) >= 16
    return False


def ssh_size(data: memoryview) -> int | None:
    """Bytes of the container that `data` begins with: magic, cipher, kdf, kdf options, key
    count, the public keys and the private ones, all by length."""
    if data[: len(SSH_MAGIC)] != SSH_MAGIC:
        return None
    at, fields, want = len(SSH_MAGIC), 0, 4
    while fields < want:
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if fields == 3:  # the number of keys
            if not 1 <= size <= 64:
                return None
            want = 4 + size + 1
        elif at + size > len(data):
            return None
        else:
            at += size
        fields += 1
    return at


def is_signed_token(header: str, payload: str) -> bool:
    head, body = decoded(header), decoded(payload)
    if head is None or body is None:
        return False
    try:
        head = json.loads(head)
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str)


def opens(part: str) -> bool:
    """Whether what a header begins with can begin JSON text."""
    start = decoded(part[:24][: len(part[:24]) // 4 * 4]) or b""
    try:
        codecs.getincrementaldecoder("utf-8")().decode(start)
    except UnicodeDecodeError:
        return False
    return not any(b < 32 and b not in b"\t\n\r" for b in start)


def signed_tokens(text: str) -> Iterator[tuple[str, int, int]]:
    """Tokens whose header decodes, wherever in a run of base64 it begins; none inside another."""
    stop, after, parts = 0, 0, None
    for m in _HEADER.finditer(text):
        start = m.start()
        if start < after:
            continue
        if start >= stop:
            stop = _PART.match(text, start).end()
            parts = _PARTS.match(text, stop)
        if parts and opens(text[start : min(start + 24, stop)]) and is_signed_token(text[start:stop], parts.group(1)):
            after = parts.end()
            yield "jwt", start, after


def hex_keys(text: str) -> Iterator[tuple[str, int, int]]:
    """Private keys in hex, plain or with colons, wherever in a run they begin."""
    for m in _HEX.finditer(text):
        digits = m.group().replace(":", "")
        spread = 3 if len(digits) < len(m.group()) else 2  # characters for each byte
        data: dict[int, memoryview] = {}
        after = 0
        for found in _SEQUENCE.finditer(digits):
            at, odd = found.start(), found.start() % 2
            if at < after or odd and spread == 3:
                continue
            if odd not in data:
                data[odd] = memoryview(bytes.fromhex(digits[odd : len(digits) - (len(digits) - odd) % 2]))
            rest = data[odd][at // 2 :]
            size = der_size(rest)
            if size and is_der_key(rest[:size]):
                start = m.start() + at // 2 * spread + odd
                after = at + 2 * size
                yield "der", start, start + size * spread - (spread == 3)


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), by start and then by the order of KINDS."""
    found = []
    for kind, (pattern, good) in BASE.items():
        if kind == "assign" and not _WORDS.search(text) or kind == "access" and "AKIA" not in text:
            continue
        found += [(kind, *m.span()) for m in pattern.finditer(text) if good(m)]
    found += signed_tokens(text)
    found += keys(text)
    found += hex_keys(text)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def secret_spans(text: str) -> Column:
    """array<struct<kind, start, end>> of a text column."""

    @F.arrow_udf("array<struct<kind:string,start:long,end:long>>")
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            rows = [[dict(zip(("kind", "start", "end"), s)) for s in spans(t)] for t in batch.to_pylist()]
            yield pa.array(rows, kind)

    return scanned(whole(text))


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and its spans: a row per row of `docs`, in place, no shuffle."""
    return docs.select(F.col(doc_id).alias("doc_id"), secret_spans(text).alias("spans"))


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as text."""
    line = "array_join(transform({}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    base = "filter(spans, s -> s.kind in ('assign', 'access', 'hex'))"
    count = "cast(size(filter(spans, s -> s.kind = '{0}')) as long) as n_{0}"
    return found.selectExpr(
        "doc_id",
        *(count.format(k) for k in BASE),
        f"sha2({line.format(base)}, 256) as base_sha256",
        f"{line.format('spans')} as spans",
    )
