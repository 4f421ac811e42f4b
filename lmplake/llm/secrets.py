"""Secret scans by assignment-aware lexing.

Three base patterns (their matches are found leftmost and non-overlapping, each kind
by itself, and short ones dropped afterwards) and a lexer for source and configuration
text:

* ``assign``: a sensitive word, ``:`` or ``=``, and 8 or more characters of a value;
* ``access``: an access key ID of 16 or more characters;
* ``hex``: 32 or more lower-case hex digits;
* ``literal``: what the lexer adds. It reads statements ``name = value``, ``name: value``,
  ``name := value``, ``name => value``, ``"name": value``, ``<name>value</name>`` and
  ``<add key="name" value="value"/>``, with optional ``export``, ``const``, types and so on
  before the name, quoted values with escapes and quoted values joined by ``+``, ``.`` or ``..``.
  A constant that is assigned to a name is remembered and carried on: when a sensitive name
  gets its value from other names (``password = PREFIX + part``), the literals behind them
  are reported, also through several names. A literal is scored by the target's name (words
  of the name after splitting at ``_``, ``-``, ``.`` and case changes, each with a weight), its
  length and its entropy, and reported from ``MIN_SCORE`` on; placeholders are not. A value joined from several is scored as
  what it is joined to, repeats included.

Spans are code points, end exclusive, and only literals that are not inside a base span
of kind ``assign`` are added.

Defined cases: null and empty texts have no span; texts are scanned whole (lexing is
linear in their length); rows that repeat give repeated rows; other columns pass through
``carry``. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lmplake.llm.common import map_arrow

#: The base patterns (fixed values); each with the group that counts and its least length.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("passw", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "literal")

#: Weights of the words of a target name.
NAME_WEIGHT = {
    "password": 3.0, "passwd": 3.0, "pwd": 3.0, "pass": 2.0, "passphrase": 3.0, "secret": 3.0, "token": 3.0,
    "apikey": 3.0, "credential": 3.0, "credentials": 3.0, "private": 2.0, "access": 1.0, "auth": 1.5, "key": 1.5,
    "api": 1.0, "bearer": 2.0, "signing": 1.5, "client": 0.5, "encryption": 1.5, "salt": 1.5, "dsn": 1.5, "cert": 1.0,
}
#: Words that say that a name is about something else.
NAME_AGAINST = {"path": 2.0, "file": 2.0, "url": 1.5, "name": 2.0, "id": 1.0, "length": 3.0, "count": 3.0, "type": 2.0, "field": 2.0}
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|changeme|example.*|your.*|<.*>|\$\{.*\}|\{\{.*\}\}|%.*%|todo|none|null|true|false|undefined)$")
MIN_LITERAL = 8
MIN_SCORE = 4.0
TOLD = 1024  # longer values are no placeholders
_JOIN = r"\s*(?:\+|\.\.?)\s*"
_QUOTED = r""""(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\\n]|\\.)*`"""
_TERM = rf"(?:{_QUOTED}|[A-Za-z_$][\w.$]*)"
#: A name, an assignment sign and what is assigned: joined terms, or a bare word.
STATEMENT = re.compile(
    rf"""(?<![\w$.-])["']?([A-Za-z_$][\w.$-]*)["']?[ \t]*(?::=|=>|(?<![=!<>])=(?!=)|:(?![:/]))[ \t]*"""
    rf"""(?:({_TERM}(?:{_JOIN}{_TERM})*)|([^\s"'`;,<>(){{}}]+))""")
ELEMENT = re.compile(r"<([A-Za-z_][\w.-]*)(?:\s[^<>]*)?>([^<>]+)</\1>")
PAIR = re.compile(r"""\b(?:key|name)\s*=\s*"([^"\n]*)"\s+value\s*=\s*"([^"\n]*)\"""")
TERM = re.compile(rf"({_QUOTED})|([A-Za-z_$][\w.$]*)")
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def name_score(name: str) -> float:
    parts = [w.lower() for w in WORD.findall(name)]
    pairs = {a + b for a, b in zip(parts, parts[1:])}
    return sum(NAME_WEIGHT.get(w, 0) - NAME_AGAINST.get(w, 0) for w in [*parts, *pairs])


class Value:
    """What a name stands for: literals and other names' values, joined. Its figures are made from theirs, not from
    its text, so a chain of any length costs each statement the same; a value is told in full up to ``TOLD`` characters."""
    __slots__ = ("spans", "parts", "size", "counts", "kinds", "text", "reported")

    def __init__(self, text: str, pieces: list):
        """``pieces`` in their order: spans of ``text``, or values."""
        self.spans = [p for p in pieces if isinstance(p, tuple)]
        self.parts = [p for p in pieces if not isinstance(p, tuple)]
        self.reported, self.kinds, self.size = False, 0, 0.0
        counts: Counter = Counter()
        told: list[str] | None = []
        for p in pieces:
            if isinstance(p, tuple):
                piece = text[p[0]:p[1]]
                own, size, kinds, words = Counter(piece), len(piece), 0, piece
                for c in own:
                    kinds |= 1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 4 if "0" <= c <= "9" else 8
            else:
                own, size, kinds, words = p.counts, p.size, p.kinds, p.text
            for c, n in own.items():
                counts[c] += n
            self.size += size
            self.kinds |= kinds
            told = None if told is None or words is None or self.size > TOLD else [*told, words]
        if self.size > 1e200:  # doubled some hundred times; only proportions matter
            counts, self.size = Counter({c: n * 1e-100 for c, n in counts.items()}), self.size * 1e-100
        self.counts, self.text = counts, None if told is None else "".join(told)

    def entropy(self) -> float:
        """Bits for each character."""
        return -sum(c / self.size * math.log2(c / self.size) for c in self.counts.values() if c > 0)

    def score(self, name: str) -> float:
        if self.size < MIN_LITERAL or " " in self.counts or (self.text is not None and PLACEHOLDER.match(self.text)):
            return 0.0
        s = name_score(name)
        return 0.0 if s <= 0 else s + min(2.0, self.entropy() / 2) + 0.5 * (self.kinds.bit_count() - 1)


def literals(text: str) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name."""
    if "=" not in text and ":" not in text and "</" not in text:
        return []
    known: dict[str, Value] = {}
    out: set[tuple[int, int]] = set()

    def judge(name: str, value: Value) -> None:
        if name_score(name) <= 0 or value.reported or value.score(name) < MIN_SCORE:
            return
        left = [value]
        while left:  # each value is reported once
            v = left.pop()
            if not v.reported:
                v.reported = True
                out.update(v.spans)
                left += v.parts

    for m in STATEMENT.finditer(text):
        pieces: list = []
        if m[2] is None:
            pieces = [m.span(3)]
        else:
            for t in TERM.finditer(text, m.start(2), m.end(2)):
                if t[1] is not None:
                    if t.end() - t.start() > 2:
                        pieces.append((t.start() + 1, t.end() - 1))
                elif t[2] in known:
                    pieces.append(known[t[2]])
                elif m.span(2) == t.span():
                    pieces.append(t.span())  # a bare word
        if pieces:
            known[m[1]] = Value(text, pieces)
            judge(m[1], known[m[1]])
    for p in (ELEMENT, PAIR):
        for m in p.finditer(text):
            judge(m[1], Value(text, [m.span(2)]))
    return sorted(out)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches."""
    low, out = text.lower(), []
    if any(w in low for w in ASSIGN_WORDS):  # else the slow pattern can't match
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def spans_of(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans: literals in a base assignment are not added again."""
    base = base_spans(text)
    starts = [s for s, k, _ in base if k == 0]  # in order, and apart from each other
    ends = [e for _, k, e in base if k == 0]
    within = lambda a, b: (i := bisect_right(starts, a)) > 0 and b <= ends[i - 1]
    more = [(a, 3, b) for a, b in literals(text) if not within(a, b)]
    return base, sorted(base + more)


def listing(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: all), n_assign, n_access, n_hex, n_literal,
    base_sha256 (of the base spans' listing) and spans (all, listed)."""
    carry = docs.columns if carry is None else carry
    outputs = ["n_assign", "n_access", "n_hex", "n_literal", "base_sha256", "spans"]
    if set(outputs) & set(carry):
        raise ValueError(f"the input already has columns {sorted(set(outputs) & set(carry))}")
    fields = [docs.schema[c] for c in carry]
    src = docs.select(*carry, docs[text].alias("_text"))

    def run(batches):
        for b in batches:
            rows = []
            for t in b.column(len(fields)):
                base, spans = spans_of(t.as_py() or "")
                n = Counter(k for _, k, _ in spans)
                rows.append((*[n[k] for k in range(4)], hashlib.sha256(listing(base).encode()).hexdigest(), listing(spans)))
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *[pa.array(c, pa.int64()) for c in cols[:4]],
                                              pa.array(cols[4], pa.string()), pa.array(cols[5], pa.string())],
                                             names=[*carry, *outputs])

    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in fields],
                           *[T.StructField(c, T.LongType()) for c in outputs[:4]],
                           *[T.StructField(c, T.StringType()) for c in outputs[4:]]])
    return map_arrow(src, run, schema)
