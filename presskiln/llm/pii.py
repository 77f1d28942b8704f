"""Personal data by anchor expansion: an automaton finds anchors, small parsers find the borders."""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from presskiln.llm.common import KEPT, releasing, ship

# Kinds in the order in which spans are listed; the first four are the base.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "account", "login")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_FOUR = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_DEALT = re.compile(r"[0-9](?:[ -]?[0-9])+")
_DIALLED = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_USERINFO = re.compile(r"[A-Za-z0-9._~%!$&'*+,;=-]+(?::[^\s/@\"'<>]*)?@[A-Za-z0-9.-]+[A-Za-z0-9](?::[0-9]+)?")
_NUMBER = re.compile(r"(?:[ _-]?(?:number|no\.?|nr\.?|id))?[ ]?[:=#]?[ ]?([A-Z0-9](?:[ -]?[A-Z0-9]){5,33})(?![A-Za-z0-9])")
_CREDENTIAL = re.compile(r"[ ]?[:=][ ]?[\"']?([A-Za-z0-9_./+-]{16,})")

# Words that announce an identifier, and words that announce a credential.
CUES = ("account", "acct", "iban", "passport", "ssn", "social security", "tax id", "customer id")
CREDENTIAL_CUES = ("token", "secret", "password", "passwd", "api_key", "api-key", "apikey", "access_key")


def _automaton():
    found = ahocorasick.Automaton()
    for anchor in ("@", "+", *sorted(_DIGITS)):
        found.add_word(anchor, (anchor if anchor in "@+" else "digit", 1))
    found.add_word("://", ("scheme", 3))
    for kind, cues in (("number", CUES), ("credential", CREDENTIAL_CUES)):
        for cue in cues:
            for form in {cue, cue.capitalize(), cue.upper()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = 2 * d if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


class Finder:
    """Finds spans of personal data in a text.

    Base kinds are the leftmost, non-overlapping matches of their patterns that pass their tests,
    found from anchors that every match holds: the at-sign, the first digit of a run (a match that
    fails there fails at every later digit of the run), the plus sign. Beyond them: ``account``,
    an identifier with digits, or a long credential, right behind a cue; ``login``, user and host
    behind a scheme. The work is linear in the text.
    """

    def __init__(self):
        self.anchors = _automaton()

    def find(self, text: str) -> dict[str, list[tuple[int, int]]]:
        spans: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
        ends = dict.fromkeys(KINDS, 0)
        for last, (anchor, length) in self.anchors.iter(text):
            at = last + 1 - length
            if anchor == "digit":
                if at and text[at - 1] in _DIGITS:
                    continue
                if at >= ends["ip"] and (m := _FOUR.match(text, at)):
                    ends["ip"] = m.end()
                    if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
                        spans["ip"].append(m.span())
                if at >= ends["card"] and (m := _DEALT.match(text, at)):
                    ends["card"] = m.end()
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        spans["card"].append(m.span())
            elif anchor == "@":
                begin = at
                while begin > ends["email"] and text[begin - 1] in _LOCAL:
                    begin -= 1
                if begin < at and (m := _DOMAIN.match(text, at + 1)):
                    ends["email"] = m.end()
                    spans["email"].append((begin, m.end()))
            elif anchor == "+":
                if at >= ends["phone"] and (m := _DIALLED.match(text, at)):
                    ends["phone"] = m.end()
                    if 8 <= sum(c in _DIGITS for c in m[0]) <= 15:
                        spans["phone"].append(m.span())
            elif anchor == "scheme":
                begin = at
                while begin > ends["login"] and text[begin - 1] in _SCHEME:
                    begin -= 1
                if begin < at and (m := _USERINFO.match(text, last + 1)):
                    ends["login"] = m.end()
                    spans["login"].append((begin, m.end()))
            elif not (at and (text[at - 1].isalnum() or text[at - 1] == "_")) or anchor == "credential":
                m = (_NUMBER if anchor == "number" else _CREDENTIAL).match(text, last + 1)
                if m and m.start(1) >= ends["account"] and sum(c in _DIGITS for c in m[1]) >= 5:
                    ends["account"] = m.end(1)
                    spans["account"].append(m.span(1))
        return spans


def listed(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in kinds for a, b in spans[kind])


def redacted(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """The text with every span, overlapping ones together, replaced by the name of its kind."""
    out, done = [], 0
    runs: list[list] = []
    for a, b, kind in sorted((a, b, kind) for kind in KINDS for a, b in spans[kind]):
        if runs and a < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b, kind])
    for a, b, kind in runs:
        out += [text[done:a], f"[{kind.upper()}]"]
        done = b
    return "".join(out) + text[done:]


_FINDERS: dict[str, Finder] = KEPT["finders"]
RESULT = [
    *((f"n_{kind}", pa.int64(), "long") for kind in BASE),
    ("base_sha256", pa.string(), "string"), ("spans", pa.string(), "string"), ("redacted", pa.string(), "string"),
]


def find_pii(docs: DataFrame, redact: bool = True) -> DataFrame:
    """Columns of ``docs`` (with a ``text``) and counts of the base kinds, the hash of the base
    spans, all spans, and where asked for the text without personal data (``redacted``).

    Spans are kind:start:end in code points, end exclusive, by kind and start. Null texts count
    as empty and are redacted to null; repeated rows stay; columns of ``docs`` named like a result
    are replaced. One pass without a shuffle.
    """
    ship(docs.sparkSession)
    results = RESULT if redact else RESULT[:-1]
    names = [c for c in docs.columns if c not in {r[0] for r in RESULT}]

    def find(batches):
        if not _FINDERS:
            _FINDERS[""] = Finder()
        finder = _FINDERS[""]
        for batch in batches:
            rows = []
            for value in batch["text"]:
                text = value.as_py()
                spans = finder.find(text or "")
                row = [len(spans[kind]) for kind in BASE]
                row += [hashlib.sha256(listed(spans, BASE).encode()).hexdigest(), listed(spans, KINDS)]
                if redact:
                    row.append(text and redacted(text, spans))
                rows.append(row)
            columns = zip(*rows, strict=True) if rows else [[]] * len(results)
            more = [pa.array(list(c), r[1]) for c, r in zip(columns, results, strict=True)]
            yield pa.RecordBatch.from_arrays([batch[n] for n in names] + more, names + [r[0] for r in results])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    return docs.select(*names).mapInArrow(releasing(find, "finders"), schema + "".join(f", {r[0]} {r[2]}" for r in results))


def op3_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_pii(docs, redact=False).drop("text")
