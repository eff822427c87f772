"""Secrets in whole texts: patterns, and structures confirmed by decoding.

Patterns: assigned passwords and tokens, access key ids, long hexadecimal runs.
Beyond them, every base64 or hexadecimal candidate is decoded and reported only
if the bytes are what a key or token must be: a DER key whose nested lengths end
where they should, an OpenSSH key whose length-prefixed fields fill the blob, a
signed token whose header and claims parse and whose signature has the size its
algorithm gives. Keys go on over line ends, escaped line ends and joined string
literals; an unarmoured key ends where its own lengths say. A PEM block whose
headers say that it is encrypted cannot be parsed and is a kind of its own.

Defined results: NULL and empty texts have no spans; texts of any length are read
whole, in time in proportion to their length whatever they hold; equal rows are scanned one by one;
an empty table gives no rows. Of structures that overlap the first found stays. With ``redact``
other columns may have any name but ``found``, which is an error; else only id and text are read.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import json
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import slices

#: The base patterns, their least lengths and the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_WORDS = (b"passw", b"secret", b"token", b"api")
LEAST_ASSIGNED, LEAST_ACCESS = 8, 16
KINDS = ("assign", "access", "hex", "jwt", "pem_key", "der_key", "ssh_key", "pem_encrypted")
BASE_KINDS = KINDS[:3]

#: A header begins with a brace and a quote or white space; tried at every segment, as segments before a token may look like one.
SIGNED_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(?=((?:eyJ|ewo|eyA|ewk|ew0)[A-Za-z0-9_-]{5,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*))")
PEM_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----")
#: Two string literals joined: a closing quote, an operator or the end of the line, an opening quote.
QUOTED_JOIN = r"""(?<!\\)\\*["'`]\s*(?:[+.,&\\]\s*)?\\*["'`]"""
#: What may stand between two base64 characters of one key.
JOIN = re.compile(rf"""(?:\\+[nrt]|\\+(?=/)|\\*[\x20\t]*[\r\n]\s*|{QUOTED_JOIN})+""")
ESCAPED_END = re.compile(r"\\[nrt]")
PEM_JOIN = re.compile(QUOTED_JOIN)
PEM_ESCAPE = re.compile(r"\\+([nrt]?)")
PEM_HEADER = re.compile(r"[A-Za-z][A-Za-z0-9-]*:")
BASE64_CHUNK = re.compile(r"[A-Za-z0-9+/_-]+")
#: The first characters of a DER sequence, and of "openssh-key-v1" in base64.
KEY_STARTS = (re.compile(r"M[A-P]"), re.compile(r"b3Blbn"))
BASE64_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
TOKEN_STARTS = ("eyJ", "ewo", "eyA", "ewk", "ew0")
#: The most values side by side in a key, and public keys in an OpenSSH key.
DER_VALUES, SSH_KEYS = 12, 16
SIGNATURE_BYTES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}


#: Reads some bytes from a place on; fewer where the data ends.
Reader = Callable[[int, int], bytes]


def reader(data: bytes) -> Reader:
    return lambda at, count: data[at : at + count]


def der(read: Reader, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the values that fill the bytes from ``start`` to ``end`` exactly, else None.

    Only tags and lengths are read. No key has more than ``DER_VALUES`` values side by side.
    """
    items = []
    while start < end:
        head = read(start, min(6, end - start))
        if len(head) < 2 or len(items) == DER_VALUES:
            return None
        size, at = head[1], 2
        if size & 0x80:
            count = size & 0x7F
            if not 1 <= count <= 4 or len(head) < 2 + count:
                return None
            size, at = int.from_bytes(head[2 : 2 + count], "big"), 2 + count
        if start + at + size > end:
            return None
        items.append((head[0], start + at, start + at + size))
        start += at + size
    return items


def is_der_key(read: Reader, length: int) -> bool:
    """A private key in PKCS#1, SEC 1 or PKCS#8 form (plain or encrypted) that fills ``length`` bytes."""
    if length < 32 or read(0, 1) != b"0":
        return False
    outer = der(read, 0, length)
    if not outer or len(outer) != 1:
        return False
    inner = der(read, outer[0][1], outer[0][2])
    if not inner:
        return False
    tags = [t for t, _, _ in inner]
    first = read(inner[0][1], min(2, inner[0][2] - inner[0][1]))
    if tags[:9] == [0x02] * 9 and first in (b"\0", b"\1"):
        return True
    if tags[:2] == [0x02, 0x04] and first == b"\1" and inner[1][2] - inner[1][1] in range(20, 67):
        return True
    if tags[:3] == [0x02, 0x30, 0x04] and first in (b"\0", b"\1"):
        algorithm = der(read, inner[1][1], inner[1][2])
        return bool(algorithm) and algorithm[0][0] == 0x06 and inner[2][2] > inner[2][1]
    if tags == [0x30, 0x04]:
        algorithm = der(read, inner[0][1], inner[0][2])
        return bool(algorithm) and algorithm[0][0] == 0x06 and inner[1][2] - inner[1][1] >= 32
    return False


def is_ssh_key(data: bytes) -> bool:
    """An OpenSSH private key: the marker, then length-prefixed fields up to the end."""
    if not data.startswith(b"openssh-key-v1\0"):
        return False
    at, fields = 15, 0
    while at + 4 <= len(data):
        if fields == 3:  # the number of keys stands between the fields
            at += 4
            if at + 4 > len(data):
                return False
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4 + size
        fields += 1
    return at == len(data) and fields >= 5


def decoded(text: str) -> bytes | None:
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(header: str, claims: str, signature: str) -> bool:
    raw = decoded(header), decoded(claims), decoded(signature)
    if None in raw:
        return False
    try:
        head, body = json.loads(raw[0]), json.loads(raw[1])
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    algorithm, size = head["alg"], len(raw[2])
    if algorithm.lower() == "none":
        return size == 0
    if algorithm in SIGNATURE_BYTES:
        return size == SIGNATURE_BYTES[algorithm]
    return algorithm[:2] in ("RS", "PS") and size in (128, 256, 384, 512)


def key_kind(data: bytes | None) -> str | None:
    if data is None:
        return None
    return "ssh_key" if is_ssh_key(data) else "der_key" if is_der_key(reader(data), len(data)) else None


def pem_parts(body: str) -> tuple[dict[str, str], str]:
    """Headers and base64 text of what stands between the markers, without line ends, escapes and quotes."""
    plain = PEM_ESCAPE.sub(lambda m: "\n" if m[1] else "", PEM_JOIN.sub("", body))
    lines = [line.strip("\x20\t\r\"'`") for line in plain.split("\n")]
    while lines and not lines[0]:
        del lines[0]
    headers: dict[str, str] = {}
    name = ""
    if lines and PEM_HEADER.match(lines[0]):
        # headers, some of them continued, end at an empty line, or else at the last line with a colon
        last = max(i for i, line in enumerate(lines) if ":" in line)
        end = next((i for i, line in enumerate(lines) if not line and i > last), last + 1)
        for line in lines[:end]:
            if PEM_HEADER.match(line):
                name, _, value = line.partition(":")
                headers[name.lower()] = value.strip()
            else:
                headers[name.lower()] += line
        lines = lines[end:]
    return headers, "".join("".join(lines).split())


def pem_kind(body: str) -> str | None:
    headers, code = pem_parts(body)
    data = decoded(code)
    if not data:
        return None
    if "ENCRYPTED" in headers.get("proc-type", "").upper():
        return "pem_encrypted" if len(data) >= 32 and len(data) % 8 == 0 else None
    return "pem_key" if key_kind(data) else None


class JoinedCode:
    """The base64 characters of a text from a place on, over joins, as one code.

    It is built once; any later start before ``end`` is an offset into it, so the
    starts that one stretch of text holds do not each go through it again.
    """

    def __init__(self, text: str, start: int):
        chunks, self.places, self.offsets, length, at = [], [], [], 0, start
        while m := BASE64_CHUNK.match(text, at):
            chunks.append(m[0])
            self.places.append(at)
            self.offsets.append(length)
            length, at = length + len(m[0]), m.end()
            if not (join := JOIN.match(text, at)) or not BASE64_CHUNK.match(text, join.end(), join.end() + 1):
                break
            at = join.end()
        self.code, self.end = "".join(chunks).replace("-", "+").replace("_", "/"), at

    def offset(self, place: int) -> int:
        k = bisect.bisect(self.places, place) - 1
        return self.offsets[k] + place - self.places[k]

    def place(self, offset: int) -> int:
        """Where the first ``offset`` characters end in the text."""
        k = bisect.bisect_left(self.offsets, offset) - 1
        return self.places[k] + offset - self.offsets[k]

    def reader(self, start: int) -> Reader:
        """The bytes that the code means from the character ``start`` on; a read decodes no more than it asks for."""

        def read(at: int, count: int) -> bytes:
            first, last = at // 3, -(-(at + count) // 3)
            part = self.code[start + 4 * first : start + 4 * last]
            data = base64.b64decode(part[: len(part) - (len(part) % 4 == 1)] + "=" * (-len(part) % 4 % 3))
            return data[at - 3 * first : at - 3 * first + count]

        return read


def der_size(read: Reader) -> int | None:
    """The bytes of a DER sequence of an integer or a sequence, from its first bytes."""
    head = read(0, 7)
    if len(head) < 7 or head[0] != 0x30:
        return None
    count = head[1] & 0x7F if head[1] & 0x80 else 0
    if count > 4 or head[1] == 0x80 or head[2 + count] not in (0x02, 0x30):
        return None
    return 2 + count + (int.from_bytes(head[2 : 2 + count], "big") if count else head[1])


def ssh_size(read: Reader, length: int) -> int | None:
    """The bytes of an OpenSSH key within ``length``: three fields, a number, as many public keys, one private part."""
    if read(0, 15) != b"openssh-key-v1\0":
        return None
    at, fields, needed = 15, 0, 4
    while fields < needed and at + 4 <= length:
        size = int.from_bytes(read(at, 4), "big")
        if fields == 3 and needed == 4:  # the number of keys stands between the fields
            if not 1 <= size <= SSH_KEYS:
                return None
            at, needed = at + 4, 4 + size
            continue
        at, fields = at + 4 + size, fields + 1
    return at if fields == needed and at <= length else None


def joined_key(text: str, joined: JoinedCode, start: int) -> tuple[int, str] | None:
    """End and kind of the key in base64 at ``start``, which lies in ``joined``."""
    offset = joined.offset(start)
    read, left = joined.reader(offset), len(joined.code) - offset
    kind = "ssh_key" if text[start] == "b" else "der_key"
    size = ssh_size(read, left * 6 // 8) if kind == "ssh_key" else der_size(read)
    if not size:
        return None
    wanted = -(-8 * size // 6)
    if left < wanted or (kind == "der_key" and not is_der_key(read, size)):
        return None
    end = joined.place(offset + wanted)
    for _ in range(-wanted % 4):
        end += text.startswith("=", end)
    return end, kind


def base_spans(text: str) -> list[tuple[int, int, str]]:
    spans = []
    lower = text.encode().lower()
    if any(w in lower for w in ASSIGN_WORDS):
        spans += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return spans


def structure_spans(text: str) -> list[tuple[int, int, str]]:
    """Keys and signed tokens that decode to what they claim to be, none inside another of these."""
    spans: list[tuple[int, int, str]] = []

    def add(start: int, end: int, kind: str) -> None:
        at = bisect.bisect(spans, (start, end, kind))
        if (at == 0 or spans[at - 1][1] <= start) and (at == len(spans) or end <= spans[at][0]):
            spans.insert(at, (start, end, kind))

    if "PRIVATE KEY-----" in text:
        for m in PEM_BEGIN.finditer(text):
            marker, end = f"-----END {m[1]}-----", text.find("-----", m.end())
            if end >= 0 and text.startswith(marker, end) and (kind := pem_kind(text[m.end() : end])):
                add(m.start(), end + len(marker), kind)
    if any(t in text for t in TOKEN_STARTS):
        for m in SIGNED_TOKEN.finditer(text):
            if is_signed_token(*m.groups()):
                add(m.start(1), m.end(3), "jwt")
    if runs := list(BASE64_RUN.finditer(text)):
        for m in HEX_RUN.finditer(text):
            if kind := key_kind(bytes.fromhex(m[0])):
                add(*m.span(), kind)
        for m in runs:
            if kind := key_kind(decoded(m[0])):
                add(*m.span(), kind)
    for pattern in KEY_STARTS:
        reached, joined = 0, None
        for m in pattern.finditer(text):
            start = m.start()
            if start >= reached and (start == 0 or text[start - 1] not in BASE64_CHARACTERS or ESCAPED_END.match(text, start - 2)):
                if joined is None or start >= joined.end:
                    joined = JoinedCode(text, start)
                if key := joined_key(text, joined, start):
                    reached = key[0]
                    add(start, *key)
    return spans


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind) in code points, by start, then kind as listed."""
    return sorted(base_spans(text) + structure_spans(text), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPAN_TYPE = "array<struct<start:bigint,end:bigint,kind:string>>"


def scan_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", redact: bool = False) -> DataFrame:
    """doc_id, ``found`` (spans in code points) and, with ``redact``, the text with each span replaced by its kind.

    With ``redact`` all columns of ``docs`` are kept, ``found`` comes last and the
    text is replaced; a text without secrets, NULL too, stays as it is.
    """
    if "found" in docs.columns and redact:
        raise ValueError("The column found is made by this operator.")
    source = docs if redact else docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    column = text_column if redact else "text"
    fields = source.schema if redact else source.select("doc_id").schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", found {SPAN_TYPE}"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))

    def scan(batches):
        for batch in batches:
            for part, raw in slices(batch, column):
                texts = [t.decode() for t in raw]
                found = [find_spans(t) for t in texts]
                spans = pa.array([[{"start": s, "end": e, "kind": k} for s, e, k in f] for f in found], kind)
                arrays, names = [], []
                for name in part.schema.names:
                    if name == column and not redact:
                        continue
                    array = part.column(name)
                    if name == column and any(found):
                        array = pa.array([redacted(t, f) if f else o for t, f, o in zip(texts, found, array.to_pylist())], array.type)
                    arrays.append(array)
                    names.append(name)
                yield pa.RecordBatch.from_arrays([*arrays, spans], [*names, "found"])

    return source.mapInArrow(scan, schema)
