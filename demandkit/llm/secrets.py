"""Secret scans by assignment-aware lexing.

Two layers over whole texts. The base layer has three fixed patterns
(assignments to sensitive names, access-key ids, long hex runs). The lexing
layer parses source and configuration syntax (``name = literal``, ``name:
literal``, ``name := literal``, ``name => literal``, quoted (with escapes) or
bare, literals joined by ``+``; ``name["key"]`` is a name of both parts) into
name-literal pairs of any length, propagates constants through
``name = other_name``, and scores each literal by how sensitive the names are
that it reaches and by its own shape. It only adds spans that no base span
covers already.

Spans are ``kind:start:end`` in code points, end exclusive. Defined cases:
null or empty texts have no spans; equal texts have equal spans; a literal
reached by several names scores by the most sensitive; other columns are
ignored. The work is one pass per document; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, map_passes, utf8

KINDS = ("assign", "access", "hex", "literal")

ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Weight of a part of a target name (fixed values).
SENSITIVE = {"password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "secret": 3, "token": 3, "apikey": 3,
             "credential": 3, "credentials": 3, "bearer": 2, "auth": 2, "authorization": 2, "private": 1.5,
             "access": 1, "api": 1, "signing": 1.5, "encryption": 1.5, "key": 1.5, "salt": 1.5, "dsn": 1,
             "connection": 1, "client": 0.5, "pass": 2, "jwt": 2}
#: Literals that stand for a value given elsewhere (fixed values).
PLACEHOLDERS = re.compile(r"(?i)^(?:x+|\*+|\.+|change_?me|example.*|your[_-].*|todo|none|null|true|false|\$\{.*|<.*|%\(.*)$")
LEAST_SCORE = 4.0

#: Names and literals have any length. The patterns are possessive, and a name
#: starts where no name goes on, so a long text takes linear time.
_NAME = r"[A-Za-z_][A-Za-z0-9_.-]*+"
_QUOTED = r"\"[^\"\\\n]*+(?:\\.[^\"\\\n]*+)*+\"|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'"
_INDEX = rf"\[(?:{_QUOTED}|[^\[\]\n\"'])*+\]"
_PAIR = re.compile(
    rf"(?P<q>[\"']?)(?<![A-Za-z0-9_.-])[0-9.-]*+(?P<name>{_NAME})(?P=q)(?P<index>(?:{_INDEX})*+)"
    rf"[\x20\t]*+(?::=|=>|=(?!=)|:(?![:/]))[\x20\t]*+"
    rf"(?P<value>(?:{_QUOTED})(?:[\x20\t]*+\+[\x20\t]*+(?:{_QUOTED}|{_NAME}))*+|[A-Za-z0-9_$+/=.~!@%^&*-]++)", re.A)
_ITEM = re.compile(rf"(?P<text>{_QUOTED})|(?P<ref>{_NAME})", re.A)
_QUOTES = re.compile(_QUOTED, re.A)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_HEX_CLASS = bytes(1 if chr(b) in "0123456789abcdef" else 0 for b in range(256))


@dataclass
class Literal:
    start: int
    end: int
    value: str
    name_score: float


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, by start, then kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def name_score(name: str) -> float:
    """Sensitivity of a target name: the sum over its parts."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    joined = "".join(parts)
    return sum(SENSITIVE.get(p, 0) for p in parts) or (3 if "apikey" in joined or "password" in joined else 0)


def shape_score(value: str) -> float:
    """How much a literal looks like a credential: length, entropy, classes."""
    if len(value) < 8 or PLACEHOLDERS.match(value):
        return -10.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return (entropy >= 3.0) + (classes >= 2) + (n >= 16) - 2.0 * (classes == 1 and not any(map(str.isdigit, value)))


def literals(text: str) -> list[Literal]:
    """Literals of all name-literal pairs, with the score of the most
    sensitive name each reaches, through constants too."""
    found: list[Literal] = []
    constants: dict[str, list[Literal]] = {}
    for m in _PAIR.finditer(text):
        name, at = m["name"], m.start("value")
        own = name_score(" ".join([name, *_QUOTES.findall(m["index"])]))
        reached: list[Literal] = []
        value = m["value"]
        if value[0] in "\"'":
            items = [(i.start(), i.end(), i["text"], i["ref"]) for i in _ITEM.finditer(value)]
            texts = [x for x in items if x[2] is not None]
            joined = "".join(x[2][1:-1] for x in texts)
            made = Literal(at + texts[0][0] + 1, at + texts[-1][1] - 1, joined, own)
            found.append(made)
            reached = [made] + [c for x in items if x[3] for c in constants.get(x[3], ())]
        elif value in constants:
            reached = constants[value]
        else:
            made = Literal(at, at + len(value), value, own)
            found.append(made)
            reached = [made]
        for x in reached:
            x.name_score = max(x.name_score, own)
        constants[name] = reached
    return found


def lexed_spans(text: str, least: float = LEAST_SCORE) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of literals that score as secrets."""
    return sorted((x.start, 3, x.end) for x in literals(text)
                  if x.name_score > 0 and x.name_score + shape_score(x.value) >= least)


def scan_text(raw: bytes) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and added spans of one text. Byte searches decide which
    patterns can match at all; they skip no match."""
    low = raw.lower()
    assigned = b"=" in raw or b":" in raw
    base_due = (assigned and any(w in low for w in WORDS)) or b"AKIA" in raw \
        or b"\x01" * 16 in raw.translate(_HEX_CLASS)
    if not base_due and not assigned:
        return [], []
    text = raw.decode("utf-8", "replace")
    base = base_spans(text) if base_due else []
    added = lexed_spans(text) if assigned else []
    return base, [(s, k, e) for s, k, e in added if not any(b <= s and e <= z for b, _, z in base)]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_literal."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))

    def step(b: pa.RecordBatch) -> dict:
        found = [scan_text(t) for t in b.column("text").to_pylist()]
        count = lambda k: [sum(x[1] == k for x in base) for base, _ in found]
        return {"doc_id": b.column("doc_id"), "n_assign": count(0), "n_access": count(1), "n_hex": count(2),
                "base_sha256": [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found],
                "spans": [joined(base + added) for base, added in found],
                "n_literal": [len(added) for _, added in found]}

    return map_passes(slim, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                            "spans string, n_literal long", step)


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The documents with every span replaced; null texts stay null, and rows
    and all other columns stay as they are."""
    names = docs.columns
    schema = docs.schema

    def run(batches):
        for b in batches:
            texts = [_redacted(t, mark) for t in b.column("text").to_pylist()]
            i = names.index("text")
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, b.schema.field(i).type) if j == i else c for j, c in enumerate(b.columns)], schema=b.schema)

    return map_arrow(docs, run, schema)


def _redacted(text: str | None, mark: str) -> str | None:
    if text is None:
        return None
    base, added = scan_text(text.encode())
    out, at = [], 0
    for s, _, e in sorted(base + added):
        if e > at:
            out += [text[at:max(s, at)], mark]
            at = e
    return "".join([*out, text[at:]])
