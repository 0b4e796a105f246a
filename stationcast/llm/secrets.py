"""Secret scan: patterns, and assignment-aware lexing of source and configuration text.

Base kinds are three fixed patterns.  On top of them the text around every
assignment sign is lexed into name-literal pairs:

* a target name, dotted or quoted (``db.password``, ``"api-key"``), left of
  ``=``, ``:``, ``:=``, ``=>`` or ``->``;
* a value right of it: quoted literals, bare words and other names, joined by
  ``+`` or by adjacency of quoted literals.

Constants are propagated in text order: a literal given to ``x`` counts again
where ``password = x`` or ``secret = x + "..."`` follows.  The literals that
reach a target of a strongly sensitive name add their spans as kind ``literal``
whatever they look like, unless they are too short or a placeholder.  For any
other target they are scored by how sensitive its name is and how random they
look, and added from the threshold on.
Base spans always stay; a literal inside a base span is not reported again.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from stationcast.llm.common import map_batches

#: Fixed base patterns: kind, pattern, group whose length counts, least length.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]{16,}"), 0, 16),  # maximal runs: the same as runs of any length, 16+ kept
)
_KINDS = {kind: k for k, (kind, *_) in enumerate(BASE)} | {"literal": len(BASE)}

#: Parts of target names and how sensitive they make the name.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "token": 0.9, "credential": 0.9,
             "credentials": 0.9, "apikey": 1.0, "private": 0.7, "access": 0.5, "auth": 0.7, "key": 0.6, "bearer": 0.9, "signing": 0.6}
#: Parts of target names that report any literal which is no placeholder.
STRONG = {"password", "passwd", "passphrase", "pwd", "secret", "credential", "credentials"}
#: A literal of such words only stands for a value that is put in elsewhere.
PLACEHOLDER = {*SENSITIVE, "your", "my", "the", "api", "here", "change", "changeme", "me", "example", "placeholder", "insert", "enter", "replace", "todo",
               "redacted", "masked", "hidden", "none", "null", "nil", "undefined", "unset", "empty", "required", "optional", "true", "false", "string"}
#: A pair of name and literal is reported from this score on.
THRESHOLD = 0.55
#: Literals shorter than this are never secrets.
LEAST = 8

_SIGN = re.compile(r":=|=>|->|=|:")
#: A target ends right before the sign; looked for in the part of the line before it.
_TARGET = re.compile(r"""(?:["'`]([\w.\- ]+)["'`]\]?|([A-Za-z_$][\w$\-]*(?:(?:\.|::)[A-Za-z_$][\w$\-]*)*))(?:\s*:\s*[A-Za-z_][\w\[\]<>.]*)?\s*\Z""")
_TERM = re.compile(r"""[ \t]*(?:(["'`])((?:\\.|(?!\1)[^\\\n])*)\1|([A-Za-z0-9_$+/.=\-]+))""")
_JOIN = re.compile(r"""[ \t]*(\+|\.\.|(?=["'`]))""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_NAME = re.compile(r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)*\Z")
_TEMPLATE = re.compile(r"\$\{[^}]*\}|\{\{.*\}\}|\{[\w.]*\}|<[^<>]*>|%\(\w+\)s|\$[A-Za-z_]\w*")
#: Code points before the sign in which a target is looked for first; more where it reaches further.
BEHIND = 200


class Span(NamedTuple):
    start: int
    end: int
    kind: str


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of every base kind, too short ones dropped."""
    return [Span(m.start(), m.end(), kind) for kind, pattern, group, least in BASE
            for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]


def sensitivity(name: str) -> float:
    """How sensitive a target name is: its parts add up, up to 1."""
    parts = [p.lower() for p in _PART.findall(name)]
    joined = {a + b for a, b in zip(parts, parts[1:])}
    return min(1.0, sum(SENSITIVE.get(p, 0.0) for p in {*parts, *joined}))


def strong(name: str) -> bool:
    """Whether the name alone makes its literals secrets."""
    return any(p.lower() in STRONG for p in _PART.findall(name))


def placeholder(value: str) -> bool:
    """Whether a literal stands for a value that is put in elsewhere."""
    if _TEMPLATE.fullmatch(value.strip()):
        return True
    words = re.findall(r"[^\W\d_]+|\d+", value)
    return all(w.lower() in PLACEHOLDER or all(p.lower() in PLACEHOLDER for p in _PART.findall(w) or [w]) for w in words)


def randomness(length: float, shares: dict[str, float]) -> float:
    """0 to 1: entropy of the characters against 4 bits, lifted by mixed kinds of characters."""
    if length < LEAST or any(map(str.isspace, shares)):
        return 0.0
    entropy = -sum(p * math.log2(p) for p in shares.values() if p > 0)
    chars = "".join(shares)
    kinds = [bool(re.search(p, chars)) for p in ("[a-z]", "[A-Z]", "[0-9]", r"[^A-Za-z0-9]")]
    mixed = 0.95 if sum(kinds) == 2 and kinds[2] and not kinds[3] else 0.4 + 0.3 * min(sum(kinds) - 1, 2)  # letters with digits
    return min(1.0, entropy / 4) * mixed


class _Value:
    """What is given to a target: a literal (start, end, text), or other values
    joined.  Joined values refer to their parts and hold sums over them, so
    what a text takes grows with the text, not with what its names stand for."""
    __slots__ = ("span", "text", "parts", "real", "_sums", "found")

    def __init__(self, span=None, text="", parts=(), real=False):
        self.span, self.text, self.parts, self._sums, self.found = span, text, parts, None, False
        self.real = real or any(p.real for p in parts)  # a part that is a literal and no placeholder

    def sums(self) -> tuple[float, dict[str, float]]:
        """Length, and every character's share of it."""
        if self._sums is None:
            if not self.parts:
                length, counts = float(len(self.text)), Counter(self.text)
            else:
                counts, length = Counter(), 0.0
                for n, shares in [p.sums() for p in self.parts]:
                    length += n
                    for c, share in shares.items():
                        counts[c] += share * n
            # beyond 10^15 characters only the shares matter
            self._sums = min(length, 1e15), {c: k / length for c, k in counts.items()}
        return self._sums

    def spans(self) -> list[tuple[int, int]]:
        """Places of its literals, those that were asked for before left out."""
        out, todo = [], [self]
        while todo:
            v = todo.pop()
            if not v.found:
                v.found = True
                todo += v.parts
                if v.span and v.span[1] > v.span[0]:
                    out.append(v.span)
        return out


def target_before(text: str, at: int) -> re.Match | None:
    """The name that ends right before the sign at ``at``, on its line, however long it is."""
    size = BEHIND
    while True:
        low = max(0, at - size)
        line = text.rfind("\n", low, at)
        part = text[line + 1 if line >= 0 else low:at]
        found = _TARGET.search(part)
        open_ = found.start() == 0 if found else part.rstrip().rstrip("]")[-1:] in ("'", '"', "`")
        if line >= 0 or not low or not open_:
            return found
        size *= 4  # the name, or its quote, may begin before


def literal_spans(text: str) -> list[Span]:
    """Literals that reach sensitive targets, through constants too."""
    known: dict[str, _Value] = {}
    found, after = [], 0
    for sign in _SIGN.finditer(text):
        if sign.start() < after:  # inside a value that is lexed already
            continue
        at = sign.start()
        target = target_before(text, at)
        if not target:
            continue
        name = target[1] or target[2]
        parts, pos = [], sign.end()  # every literal or name that the value is made of
        while term := _TERM.match(text, pos):
            if term[1]:
                parts.append(_Value(term.span(2), term[2], real=not placeholder(term[2])))
            elif _NAME.match(term[3]) and term[3] in known:
                parts.append(known[term[3]])
            else:  # a name that is called or indexed is no literal
                parts.append(_Value(term.span(3), term[3], real=text[term.end():term.end() + 1] not in ("(", "[") and not placeholder(term[3])))
            pos = term.end()
            if not (join := _JOIN.match(text, pos)):
                break
            pos = join.end()
        if not parts:
            continue
        after = pos
        value = known[name] = parts[0] if len(parts) == 1 else _Value(parts=parts)
        score = sensitivity(name)
        if not score and not value.parts:
            continue
        length, shares = value.sums()  # of joined values always, so those made of them have it at hand
        if score and (strong(name) and value.real and length >= LEAST and len(shares) > 1 or score * randomness(length, shares) >= THRESHOLD):
            found += [Span(s, e, "literal") for s, e in value.spans()]
    return found


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, both by start and then by kind."""
    order = lambda s: (s.start, _KINDS[s.kind], s.end)
    base = sorted(base_spans(text), key=order)
    more = [s for s in dict.fromkeys(literal_spans(text)) if not any(b.start <= s.start and s.end <= b.end for b in base)]
    return base, sorted(base + more, key=order)


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row for every row of ``docs``: ``key``, the spans (array of start,
    end, kind; code points, end exclusive) and whether each is a base span.

    Null and empty texts have no spans; null and repeated keys give a row each;
    an empty table gives an empty result; other columns are not read."""
    kind = docs.schema[key].dataType

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for t in batch.column(1).to_pylist():
            base, spans = find_spans(t or "")
            own = set(base)
            rows.append([{"start": s.start, "end": s.end, "kind": s.kind, "base": s in own} for s in spans])
        spans = pa.array(rows, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("base", pa.bool_())])))
        return pa.RecordBatch.from_arrays([batch.column(0), spans], [key, "spans"])
    return map_batches(docs.select(key, text), run, f"`{key}` {kind.simpleString()}, spans array<struct<start:long,end:long,kind:string,base:boolean>>")


def digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, all spans as text."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal")}
        for spans in batch.column(1).to_pylist():
            base = [s for s in spans if s["base"]]
            kinds = Counter(s["kind"] for s in spans)
            text = lambda some: ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in some)
            for k, v in (("n_assign", kinds["assign"]), ("n_access", kinds["access"]), ("n_hex", kinds["hex"]),
                         ("base_sha256", hashlib.sha256(text(base).encode()).hexdigest()), ("spans", text(spans)), ("n_literal", kinds["literal"])):
                out[k].append(v)
        arrays = [pa.array(v, pa.string() if k in ("base_sha256", "spans") else pa.int64()) for k, v in out.items()]
        return pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *out])
    return map_batches(scan(docs), run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long")
