"""Secrets in texts: plain patterns, and candidates that are reported only once they decode."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from presskiln.llm.common import ship

# Kinds in the order in which spans of one start are listed; the first three are the base.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "signed", "key", "wrapped")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGNED, ACCESS_CHARS = 12, 18

# A signed token: header, body and signature, of which a JSON header begins like this in base64.
_SIGNED = re.compile(r"(?<![A-Za-z0-9_.-])(e[wy][A-Za-z0-9_-]{8,}+)\.([A-Za-z0-9_-]*+)\.([A-Za-z0-9_-]*+)(?![A-Za-z0-9_.-])")
# Runs long enough to hold a key or a wrapped secret, both forms of base64, and of hex digits.
_RUN = re.compile(r"([A-Za-z0-9+/_-]{32,}+)={0,2}")
_MARK = "-----"
_HEX_RUN = re.compile(r"(?:[0-9a-fA-F]{2}){24,}")
# Lines of a key's base64, as a run goes on behind a line end.
_LINE = re.compile(r"(?:\\n|\r?\n)?([A-Za-z0-9+/_-]+)")
# Bytes of a signature by algorithm (none: as long as the key, at least so many).
SIGNATURES = {
    "HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": (64, 114), "none": 0,
}
LEAST_SIGNATURE = 128
# What an unencrypted key file of the OpenSSH kind begins with, and bytes of its line.
SSH_MAGIC = b"openssh-key-v1\0"
# Tags of the nested encoding.
INTEGER, OCTETS, OBJECT, SEQUENCE = 0x02, 0x04, 0x06, 0x30
# A key is looked for in so many decoded bytes at most; nothing known is longer.
KEY_BYTES = 1 << 14


def unbase64(text: str) -> bytes | None:
    """Bytes of base64 in either alphabet, with or without padding; None if it is none."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def header(data: bytes, at: int = 0) -> tuple[int, int, int] | None:
    """(tag, first byte, end) of the element at ``at``; its end may lie behind the data."""
    if at + 2 > len(data):
        return None
    tag, size, begin = data[at], data[at + 1], at + 2
    if size & 0x80:
        more = size & 0x7F
        if not 1 <= more <= 3 or begin + more > len(data) or not data[begin]:
            return None
        size, begin = int.from_bytes(data[begin : begin + more]), begin + more
        if size < 0x80:
            return None  # lengths are written in their shortest form
    return tag, begin, begin + size


def elements(data: bytes, begin: int, end: int) -> list[tuple[int, int, int]] | None:
    """Elements that fill the span exactly; None if their lengths do not add up."""
    found = []
    while begin < end:
        element = header(data, begin)
        if element is None or element[2] > end:
            return None
        found.append(element)
        begin = element[2]
    return found


def private_key(data: bytes) -> int | None:
    """Bytes of the private key the data begin with, if its nested lengths all add up: the forms
    of RSA and DSA (integers), of elliptic curves, the general one around them, and that encrypted."""
    outer = header(data)
    if outer is None or outer[0] != SEQUENCE or outer[2] > len(data):
        return None
    parts = elements(data, outer[1], outer[2])
    if not parts or len(parts) < 2:
        return None
    tags = [tag for tag, _, _ in parts]
    version = data[parts[0][1] : parts[0][2]]
    if tags[0] == INTEGER and len(version) == 1 and version[0] <= 1:
        if set(tags) == {INTEGER}:
            sizes = [b - a for _, a, b in parts]
            return outer[2] if len(parts) in (6, 9) and sizes[1] >= 32 else None
        if tags[1] == OCTETS and version[0] == 1:
            return outer[2] if 16 <= parts[1][2] - parts[1][1] <= 66 else None
        if tags[1:3] == [SEQUENCE, OCTETS]:
            kind = elements(data, parts[1][1], parts[1][2])
            inner = header(data, parts[2][1])
            known = kind and kind[0][0] == OBJECT and inner and inner[0] in (SEQUENCE, OCTETS)
            return outer[2] if known and inner[2] == parts[2][2] else None
    elif tags == [SEQUENCE, OCTETS]:  # encrypted: the method, with its settings, and the rest
        kind = elements(data, parts[0][1], parts[0][2])
        known = kind and [t for t, _, _ in kind] == [OBJECT, SEQUENCE] and parts[1][2] - parts[1][1] >= 16
        return outer[2] if known and elements(data, kind[1][1], kind[1][2]) else None
    return None


def ssh_key(data: bytes) -> int | None:
    """Bytes of the key file of the OpenSSH kind the data begin with: names of cipher and derivation,
    its settings, one key or more, and the private part, each behind its length."""
    if not data.startswith(SSH_MAGIC):
        return None
    at = len(SSH_MAGIC)

    def string() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at : at + 4])
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    names = [string(), string(), string()]
    if None in names or at + 4 > len(data):
        return None
    keys = int.from_bytes(data[at : at + 4])
    at += 4
    if not 1 <= keys <= 16 or any(not string() for _ in range(keys)):
        return None
    private = string()
    return at if private and len(private) % 8 == 0 else None


def signed(head: str, body: str, signature: str) -> bool:
    """Whether the header names an algorithm, the body decodes and the signature has its length."""
    data, signed_by = unbase64(head), unbase64(signature)
    if data is None or signed_by is None or unbase64(body) is None:
        return False
    try:
        fields = json.loads(data)
    except (ValueError, RecursionError):
        return False
    name = fields.get("alg") if isinstance(fields, dict) else None
    if not isinstance(name, str) or not name:
        return False
    size = SIGNATURES.get(name)
    if size is None:
        return len(signed_by) >= LEAST_SIGNATURE
    return len(signed_by) in (size if isinstance(size, tuple) else (size,))


def plain_spans(text: str) -> Iterator[tuple[int, str, int]]:
    """(start, kind, end) of the base kinds: leftmost matches without overlap, failing ones dropped."""
    low = text.lower()
    if any(name in low for name in _NAMES):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGNED:
                yield m.start(), "assign", m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_CHARS:
                yield m.start(), "access", m.end()
    if b"x" * 16 in text.encode().translate(_HEX_LETTERS):
        for m in _HEX.finditer(text):
            yield m.start(), "hex", m.end()


def _runs_of(letters: str) -> bytes:
    """A byte table that turns the letters into ``x`` and all else into a blank."""
    return bytes(120 if chr(b) in letters else 32 for b in range(256))


# What every match of a pattern holds, looked for first: most texts hold none of it.
_NAMES = ("passw", "secret", "token", "apikey", "api_key")
_HEX_LETTERS, _ANY_HEX = _runs_of("0123456789abcdef"), _runs_of("0123456789abcdefABCDEF")
_LETTERS = _runs_of("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")


def _holds_secret(data: bytes) -> bool:
    """Decoded text that itself assigns a secret or names an access key."""
    if not data.isascii():
        return False
    text = data.decode()
    if not text.replace("\n", "").replace("\t", "").replace("\r", "").isprintable():
        return False
    return any(kind != "hex" for _, kind, _ in plain_spans(text))


def _key_in_run(text: str, begin: int) -> int | None:
    """End of the base64 key that begins here, over line ends; its lengths say where it stops."""
    lead = unbase64(text[begin : begin + 32])
    if lead is None:
        return None
    ssh = lead.startswith(SSH_MAGIC)
    outer = header(lead)
    if not ssh and (outer is None or outer[0] != SEQUENCE or not 32 <= outer[2] <= KEY_BYTES):
        return None
    need = -(-(KEY_BYTES if ssh else outer[2]) * 4 // 3)
    parts, ends, have, at = [], [], 0, begin
    while have < need and (m := _LINE.match(text, at)):
        parts.append(m[1])
        have, at = have + len(m[1]), m.end()
        ends.append((have, m.start(1)))
    body = "".join(parts)[:need]
    data = unbase64(body[: len(body) - (len(body) % 4 == 1)])
    size = data and (ssh_key(data) if ssh else private_key(data))
    if not size:
        return None
    chars = -(-size * 4 // 3)
    k = next(k for k, (have, _) in enumerate(ends) if have >= chars)
    return ends[k][1] + chars - (ends[k - 1][0] if k else 0)


def confirmed_spans(text: str) -> Iterator[tuple[int, str, int]]:
    """(start, kind, end) of what decodes: ``signed`` tokens, private ``key`` encodings in base64 or
    hex, and ``wrapped`` text, base64 or hex of a text that holds an assigned secret or access key."""
    if "." in text:
        for m in _SIGNED.finditer(text):
            if signed(m[1], m[2], m[3]):
                yield m.start(), "signed", m.end()
    data, done = text.encode(), 0
    for m in _RUN.finditer(text) if b"x" * 32 in data.translate(_LETTERS) else ():
        if m.start() < done:  # a further line of a key
            continue
        begin = end = None
        # A key begins with the run, or behind the marks of its file in it.
        for begin in {m.start(), m.start() + m[1].find(_MARK) + len(_MARK) if _MARK in m[1] else m.start()}:
            # The letter of an escaped line end is none of the key.
            begin += text[max(begin - 1, 0)] == "\\"
            end = _key_in_run(text, begin)
            if end is not None:
                break
        if end is not None:
            done = end
            yield begin, "key", end
        elif (inner := unbase64(m[1])) and _holds_secret(inner):
            yield m.start(), "wrapped", m.end()
    for m in _HEX_RUN.finditer(text) if b"x" * 48 in data.translate(_ANY_HEX) else ():
        inner = bytes.fromhex(m[0])
        if size := private_key(inner) or ssh_key(inner):
            yield m.start(), "key", m.start() + 2 * size
        elif _holds_secret(inner):
            yield m.start(), "wrapped", m.end()


def find(text: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """Base spans and all spans of a text, both by start, then kind as listed."""
    order = {kind: k for k, kind in enumerate(KINDS)}
    base = sorted(plain_spans(text), key=lambda s: (s[0], order[s[1]], s[2]))
    return base, sorted(base + list(confirmed_spans(text)), key=lambda s: (s[0], order[s[1]], s[2]))


def listed(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def redacted(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with every span, overlapping ones together, replaced by ``[SECRET]``."""
    out, done = [], 0
    for a, _, b in spans:
        if a >= done:
            out += [text[done:a], "[SECRET]"]
        done = max(done, b)
    return "".join(out) + text[done:]


RESULT = [
    *((f"n_{kind}", pa.int64(), "long") for kind in KINDS),
    ("base_sha256", pa.string(), "string"), ("spans", pa.string(), "string"), ("without_secrets", pa.string(), "string"),
]


def find_secrets(docs: DataFrame, redact: bool = True) -> DataFrame:
    """Columns of ``docs`` (with a ``text``), the number of spans of each kind, the hash of the base
    spans, all spans, and where asked for the text without secrets (``without_secrets``).

    Base kinds are plain patterns: an assigned value of 12 characters, an access key id, 16 hex
    digits. Beyond them a candidate counts only where it decodes: the header of a signed token is
    JSON that names its algorithm and the signature has that algorithm's length; the nested lengths
    of a private key add up to the byte; base64 or hex text holds a base secret of its own. Spans
    are kind:start:end in code points, end exclusive, by start, then kind.

    Null texts count as empty and stay null when redacted; empty ones have no spans; texts of any
    length are looked at whole, in time in proportion to them; repeated rows stay; an empty table
    gives no rows; columns of ``docs`` named like a result are replaced. One pass without a shuffle.
    """
    ship(docs.sparkSession)
    results = RESULT if redact else RESULT[:-1]
    names = [c for c in docs.columns if c not in {r[0] for r in RESULT}]

    def run(batches):
        for batch in batches:
            rows = []
            for value in batch["text"]:
                text = value.as_py()
                base, spans = find(text or "")
                kinds = [kind for _, kind, _ in spans]
                row = [kinds.count(kind) for kind in KINDS]
                row += [hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)]
                if redact:
                    row.append(text and redacted(text, spans))
                rows.append(row)
            columns = zip(*rows, strict=True) if rows else [[]] * len(results)
            more = [pa.array(list(c), r[1]) for c, r in zip(columns, results, strict=True)]
            yield pa.RecordBatch.from_arrays([batch[n] for n in names] + more, names + [r[0] for r in results])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    return docs.select(*names).mapInArrow(run, schema + "".join(f", {r[0]} {r[2]}" for r in results))


def op11_secrets(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_secrets(docs, redact=False).drop("text")
