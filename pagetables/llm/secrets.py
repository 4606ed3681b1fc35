"""Secret scans: patterns, and candidates confirmed by the structure of what they decode to.

Three patterns give the base spans of a text: ``assign`` (a password, secret, token or key that
is given a value), ``access`` (access key names) and ``hex`` (long lower-case hexadecimal runs).
Confirmation adds spans of three more kinds, each only if what a candidate decodes to has the
structure of a secret:

* ``pem``: an armoured block whose label says private key, around a key encoding of base64;
* ``key``: a key encoding by itself, in base64 or hexadecimal;
* ``jwt``: a signed token: the header is a JSON object with a known ``alg``, the payload is a
  JSON object, and the signature has the length that the algorithm gives it.

A key encoding is either ASN.1, where nested lengths must fill each other exactly and the
members must be those of a private key (PKCS #1, SEC 1, PKCS #8, plain or encrypted, or the
older DSA form), or the wire format of OpenSSH, whose lengths must add up likewise.  Lengths are
read at their places, by decoding the few letters there, and an encoding is decoded as a whole
only when all lengths agree; none is over 64 KB.

Spans are in code points, end exclusive, ordered by start and then by kind.  Key encodings
within an armoured block are not reported once more.

Defined cases: NULL text is empty, and an empty text has no spans; rows without a key or with
one that repeats are scanned by themselves; an empty table gives no rows; columns beyond key and
text are not read.  A text is one unit of work, in a few times its size of memory.
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

from pagetables.functions.rows import by_bytes

BATCH_BYTES = 1024 * 1024
KINDS = ("assign", "access", "hex", "pem", "key", "jwt")
BASE = KINDS[:3]
SPANS = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_confirmed bigint, base_sha256 string, spans string"
)
# The patterns of the base spans and the least lengths of what they match.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
LEAST_VALUE = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

ARMOUR = re.compile(
    r"-----BEGIN ([A-Z0-9 ]{0,32})PRIVATE KEY-----((?:[A-Za-z0-9+/=\s]|\\[nr])*+)-----END \1PRIVATE KEY-----", re.ASCII
)
# The first letters of encodings: a sequence, then a number or another sequence; or OpenSSH's name.
BASE64_START = re.compile(r"M(?:[A-H]|I[E-L])[A-Za-z0-9+/]{5}|b3BlbnNzaC1rZXktdjEA")
HEX_START = re.compile(r"(?<![0-9A-Fa-f])(?:30[0-9A-Fa-f]{2}|6f70656e7373682d6b65792d763100)(?=[0-9A-Fa-f]{44})")
DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]++)+")
OPENSSH = b"openssh-key-v1\0"
# Object identifiers of key algorithms and of password-based encryption.
KEY_ALGORITHMS = {
    bytes.fromhex(x)
    for x in (
        "2a864886f70d010101",  # RSA
        "2a864886f70d01010a",  # RSA with PSS
        "2a8648ce380401",  # DSA
        "2a864886f70d010301",  # Diffie-Hellman
        "2a8648ce3d0201",  # elliptic curves
        "2b656e", "2b656f", "2b6570", "2b6571",  # X25519, X448, Ed25519, Ed448
    )
}
ENCRYPTION = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
# Bytes of a signature by algorithm; RSA signatures are as long as the modulus.
SIGNATURES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "ES256K": 64}
EDDSA = (64, 114)
RSA_SIGNED = {"RS256", "RS384", "RS512", "PS256", "PS384", "PS512"}
RSA_BYTES = (128, 2048)


class Malformed(ValueError):
    """Not the encoding that was looked for."""


class Letters:
    """Bytes of an encoded stretch of a text, decoded where they are read."""

    def __init__(self, text: str, begin: int, end: int, radix: int):
        self.text, self.begin, self.radix = text, begin, radix
        letters = end - begin
        self.size = letters * 3 // 4 if radix == 64 else letters // 2

    def read(self, at: int, n: int) -> bytes:
        if at < 0 or n < 0 or at + n > self.size:
            raise Malformed
        if self.radix == 16:
            first = self.begin + 2 * at
            got = _unhex(self.text[first : first + 2 * n])
        else:
            group, skip = divmod(at, 3)
            first, last = self.begin + 4 * group, self.end_of(at + n)
            got = _unbase64(self.text[first:last])[skip : skip + n]
        if len(got) < n:  # white space or padding in between
            raise Malformed
        return got

    def end_of(self, n: int) -> int:
        """Where in the text the first ``n`` bytes end."""
        return self.begin + (2 * n if self.radix == 16 else -(-n * 4 // 3))


def _unhex(part: str) -> bytes:
    try:
        return bytes.fromhex(part)
    except ValueError:
        raise Malformed from None


def _unbase64(part: str) -> bytes:
    part = part.rstrip("=")
    try:
        return base64.b64decode(part + "=" * (-len(part) % 4), validate=True)
    except (binascii.Error, ValueError):
        raise Malformed from None


# ASN.1: (tag, begin of content, end of content)
SEQUENCE, NUMBER, OCTETS, IDENTIFIER, BITS, CONTEXT = 0x30, 0x02, 0x04, 0x06, 0x03, 0xA0


def member(data: Letters, at: int, end: int) -> tuple[int, int, int]:
    """The member that begins at a place and must end within its parent."""
    head = data.read(at, min(6, end - at))
    if len(head) < 2:
        raise Malformed
    size, begin = head[1], at + 2
    if size & 0x80:
        width = size & 0x7F
        if not 1 <= width <= 2 or len(head) < 2 + width or not head[2]:
            raise Malformed  # lengths are minimal, and keys are far under 64 KB
        size, begin = int.from_bytes(head[2 : 2 + width], "big"), begin + width
        if size < 0x80:
            raise Malformed
    if begin + size > end:
        raise Malformed
    return head[0], begin, begin + size


def members(data: Letters, begin: int, end: int, most: int = 16) -> list[tuple[int, int, int]]:
    """All members of a stretch, which they must fill."""
    out = []
    while begin < end:
        if len(out) == most:
            raise Malformed
        out.append(member(data, begin, end))
        begin = out[-1][2]
    return out


def small_number(data: Letters, item: tuple[int, int, int]) -> int:
    if item[0] != NUMBER or item[2] - item[1] != 1:
        return -1
    return data.read(item[1], 1)[0]


def is_private(data: Letters, begin: int, end: int) -> bool:
    """Whether the members of an outer sequence are those of a private key."""
    if member(data, begin, end)[0] not in (NUMBER, SEQUENCE):
        return False
    items = members(data, begin, end)
    tags = [t for t, _, _ in items]
    if len(items) < 2:
        return False
    if tags[:2] == [SEQUENCE, OCTETS] and len(items) == 2:  # an encrypted key: algorithm, content
        inner = members(data, *items[0][1:])
        if not inner or inner[0][0] != IDENTIFIER or items[1][2] - items[1][1] < 16:
            return False
        return data.read(inner[0][1], inner[0][2] - inner[0][1]).startswith(ENCRYPTION)
    version = small_number(data, items[0])
    if version in (0, 1) and tags[1:3] == [SEQUENCE, OCTETS] and len(items) <= 5:
        inner = members(data, *items[1][1:])
        if not inner or inner[0][0] != IDENTIFIER:
            return False
        return data.read(inner[0][1], inner[0][2] - inner[0][1]) in KEY_ALGORITHMS and items[2][2] > items[2][1]
    if version == 1 and tags[1] == OCTETS and 16 <= items[1][2] - items[1][1] <= 80:
        return len(items) in (2, 3, 4) and all(t in (CONTEXT, CONTEXT + 1) for t in tags[2:])
    if version in (0, 1) and set(tags) == {NUMBER} and len(items) in (6, 9):
        sizes = [e - b for _, b, e in items]
        # Modulus and exponents, or a group and its two keys: none is shorter than 32 bytes.
        return sizes[1] >= 32 and (len(items) == 6 or sizes[3] >= sizes[1] // 2)
    return False


def key_end(data: Letters) -> int:
    """How many bytes a private key at the beginning has; ``Malformed`` if there is none."""
    if data.read(0, 1) == b"o":
        return openssh_end(data)
    tag, begin, end = member(data, 0, data.size)
    if tag != SEQUENCE or not is_private(data, begin, end):
        raise Malformed
    return end


def openssh_end(data: Letters) -> int:
    if data.read(0, len(OPENSSH)) != OPENSSH:
        raise Malformed
    at = len(OPENSSH)

    def part(at: int) -> tuple[int, int]:
        size = int.from_bytes(data.read(at, 4), "big")
        if size >= 1 << 16 or at + 4 + size > data.size:
            raise Malformed
        return at + 4, at + 4 + size

    for _ in range(3):  # cipher, key derivation, its options
        begin, at = part(at)
    count = int.from_bytes(data.read(at, 4), "big")
    if not 1 <= count <= 16:
        raise Malformed
    at += 4
    for _ in range(count):  # public keys, each beginning with its kind's name
        begin, at = part(at)
        name_begin, name_end = part(begin)
        if not 0 < name_end - name_begin <= at - begin - 4 or not data.read(name_begin, min(64, name_end - name_begin)).isascii():
            raise Malformed
    begin, end = part(at)
    if end == begin or (end - begin) % 8:
        raise Malformed
    return end


def armoured(text: str) -> list[tuple[int, int]]:
    """Blocks labelled private key that hold a key encoding."""
    out = []
    if "PRIVATE KEY-----" not in text:
        return out
    for found in ARMOUR.finditer(text):
        body = re.sub(r"\\[nr]|\s+", "", found[2])
        data = Letters(body, 0, len(body.rstrip("=")), 64)
        try:
            if data.size and key_end(data) == data.size:
                out.append(found.span())
        except Malformed:
            pass
    return out


def bare_keys(text: str) -> list[tuple[int, int]]:
    """Key encodings by themselves, the first of those that overlap."""
    out = []
    for starts, radix in ((BASE64_START, 64), (HEX_START, 16)):
        at = 0
        while found := starts.search(text, at):
            begin = found.start()
            at = begin + 1
            data = Letters(text, begin, len(text), radix)
            try:
                size = key_end(data)
                end = data.end_of(size)
                data.read(0, size)
            except Malformed:
                continue
            out.append((begin, end + _padding(text, end, size, radix)))
            at = end
    return sorted(out)


def _padding(text: str, end: int, size: int, radix: int) -> int:
    want = -size % 3 if radix == 64 else 0
    return want if text[end : end + want] == "=" * want else 0


def json_object(part: str) -> dict | None:
    """The JSON object that base64 for URLs stands for."""
    try:
        value = json.loads(_unbase64(part.translate({45: 43, 95: 47})).decode())
    except (Malformed, ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def signed_length_fits(algorithm: object, size: int) -> bool:
    if algorithm in RSA_SIGNED:
        return RSA_BYTES[0] <= size <= RSA_BYTES[1]
    return size in EDDSA if algorithm == "EdDSA" else isinstance(algorithm, str) and SIGNATURES.get(algorithm) == size


def signed_tokens(text: str) -> list[tuple[int, int]]:
    """Header, payload and signature, each in base64 for URLs, parted by dots."""
    out: list[tuple[int, int]] = []
    if "eyJ" not in text:
        return out
    for found in DOTTED.finditer(text):
        parts, at, skip = found[0].split("."), found.start(), 0
        for header, payload, signature in zip(parts, parts[1:], parts[2:]):
            begin = header.find("eyJ")
            skip -= 1
            if begin >= 0 and skip < 0 and payload.startswith("e"):
                said = json_object(header[begin:])
                size = len(signature) * 3 // 4
                if said is not None and len(signature) % 4 != 1 and signed_length_fits(said.get("alg"), size):
                    if json_object(payload) is not None:
                        out.append((at + begin, at + len(header) + len(payload) + len(signature) + 2))
                        skip = 2
            at += len(header) + 1
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the three patterns."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return spans + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    blocks = armoured(text)
    spans = [(b, 3, e) for b, e in blocks]
    block = 0
    for b, e in bare_keys(text):
        while block < len(blocks) and blocks[block][1] <= b:
            block += 1
        if block == len(blocks) or b < blocks[block][0]:
            spans.append((b, 4, e))
    return spans + [(b, 5, e) for b, e in signed_tokens(text)]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Counts and spans of every text, see ``SPANS``.  Narrow."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, BATCH_BYTES):
            out = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                content = value.as_py() or ""
                base, more = base_spans(content), confirmed_spans(content)
                counts = [sum(kind == k for _, kind, _ in base) for k in range(len(BASE))]
                digest = hashlib.sha256(written(base).encode()).hexdigest()
                out.append((doc_id, *counts, len(more), digest, written(base + more)))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_confirmed", "base_sha256", "spans"],
            )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(find, SPANS)
