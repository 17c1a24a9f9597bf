r"""Secret scan: fixed patterns plus assignment-aware lexing.

Base spans, leftmost and non-overlapping per kind: ``assign`` (a named value),
``access`` (AKIA keys) and ``hex`` (long lower-case hex runs).  The lexer then
reads the text as source code or configuration: every ``name = literal`` (also
``:``, ``=>``, ``:=``, quoted names, ``"a" + "b"`` and names of constants)
becomes a name-literal pair; constants are propagated to a fixed point, and a
literal counts as a secret (kind ``literal``) when a name it reaches is
sensitive and its score is high enough.  An unquoted value (.env, INI, YAML,
properties) is a literal up to the next blank unless it names something the
text assigns; calls and subscripts are code, and a short word of letters in one
case is a word.  A YAML block scalar gives one literal a line.  A value that
consists of placeholders is none, but the default in ``${NAME:-default}`` is.

Offsets are code points, ends exclusive.  Defined cases: null or empty text has
no spans; spans never cross documents; a constant defined twice keeps both
literals; repeated rows are scanned alike; texts are scanned whole, each line once;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import blocks, id_and_text

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, as [0-9a-f]+ with a length test finds
KINDS = ("assign", "access", "hex", "literal")

# Parts of names that make an assigned literal sensitive.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0,
             "token": 0.9, "apikey": 1.0, "accesskey": 1.0, "privatekey": 1.0,
             "credential": 0.8, "credentials": 0.8, "auth": 0.6}

_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_STRING = r"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'"
_NAME = r"[A-Za-z_][A-Za-z0-9_.-]*"
_BIND = re.compile(rf"(?:(?<![A-Za-z0-9_.\"'-])({_NAME})|[\"']({_NAME})[\"'])[ \t]*(?::=|=>|=(?!=)|:(?![:/]))[ \t]*(?=\S)")
_QUOTED = re.compile(rf"[bBfFrRuU]{{0,2}}({_STRING})[ \t]*(\+)?[ \t]*")
_PART_OF_SUM = re.compile(rf"({_NAME})(?:[ \t]*\+[ \t]*(?=[\"'])|[ \t]+\+[ \t]+(?=[A-Za-z_]))")
_SUM_OF_NAMES = re.compile(rf"({_NAME})[ \t]*\+[ \t]*(?={_NAME})")
_CALL = re.compile(r"[A-Za-z_][\w.]*([(\[])", re.ASCII)
_CLOSED = re.compile(r"[)\]](?=[\s;,.)\]}]|\Z)")
# An unquoted value ends at a blank, before the next "; name=", and off a line of its own at a quote.
_NEXT = rf"[;&,][\"']?{_NAME}[\"']?[=:]"
_BARE_LINE = re.compile(rf"(?:(?!{_NEXT})\S)+")
_BARE = re.compile(rf"(?:(?!{_NEXT})[^\s\"'`])+")
_CHAINED = re.compile(rf"({_NAME})(?::=|=>|=|:)(?=[\"'])")
_KEY = re.compile(rf"{_NAME}:")
_LINE_LEAD = re.compile(r"[ \t]*(?:-[ \t]+)?(?:(?:export|set|setx|ENV|ARG)[ \t]+)?", re.ASCII)
_SCALAR = re.compile(r"[|>][0-9+-]*[ \t]*(?:#[^\n]*)?\n")
_HOLDER = r"\$\{[^{}]*\}|\$\([^()]*\)|\{\{[^{}]*\}\}|\{[A-Za-z_][\w.]*\}|<[^<>]*>|%\([^()]*\)[a-z]|%[A-Z_][A-Z0-9_]*%|\$[A-Z_][A-Z0-9_]*"
_HOLDERS = re.compile(rf"(?:[:/@,.-]*(?:{_HOLDER}))+", re.ASCII)
_NAMED = re.compile(rf"\$(?:\{{({_NAME})\}}|({_NAME}))")
_DEFAULT = re.compile(r"\$\{[\w.]+:[-=]?([^{}\s]+)\}", re.ASCII)
_WORD = re.compile(r"[A-Za-z_]?[a-z_]{1,14}|[A-Z_]{1,15}")
_CLOSERS = {")": "(", "]": "[", "}": "{", ">": "<"}

SCHEMA = ("doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, "
          "base_sha256 string, spans string")


def sensitivity(name: str) -> float:
    """How strongly a target name suggests a secret: 0 to 1."""
    parts = [p.lower() for p in _PART.findall(name)]
    joined = parts + [a + b for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(p, 0.0) for p in joined), default=0.0)


def literal_score(value: str) -> float:
    """0 to 1: long, varied values without blanks look like secrets."""
    if len(value) < 6 or re.search(r"\s", value) or _HOLDERS.fullmatch(value) or value.lower() in ("password", "secret", "changeme", "example"):
        return 0.0
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    classes = sum(bool(re.search(c, value)) for c in ("[a-z]", "[A-Z]", "[0-9]", r"[^\w]"))
    return min(1.0, entropy / 4 * (0.5 + 0.25 * classes))


def _line(text: str, at: int, seen: dict) -> tuple[int, int, int, int]:
    """The line that ``at`` lies in: start, end, and where its last closing ``)`` and ``]`` stand.

    ``seen`` keeps the last line, so a line is read once however many names it assigns.
    """
    line = seen.get("line")
    if not line or not line[0] <= at <= line[1]:
        start, end = text.rfind("\n", 0, at) + 1, text.find("\n", at)
        end = len(text) if end < 0 else end
        last = {c[0]: c.start() for c in _CLOSED.finditer(text, start, end)}
        line = seen["line"] = (start, end, last.get(")", -1), last.get("]", -1))
    return line


def bare_value(text: str, bind: re.Match, at: int, ends: dict) -> tuple[int, int]:
    """Where the unquoted value at ``at`` starts and ends (alike: there is none).

    ``ends`` keeps where the last run ended, which holds for every start inside it.
    """
    if text[at] in "\"'`" or text[at] in "#;" and text[at - 1] in " \t":
        return at, at
    lead, _, *last = _line(text, bind.start(), ends)
    call = _CALL.match(text, at)
    if call and last[call[1] == "["] >= call.end():
        return at, at
    kind = _BARE_LINE if _LINE_LEAD.fullmatch(text, lead, bind.start()) else _BARE
    if ends.get(kind, at) <= at:
        value = kind.match(text, at)
        ends[kind] = value.end() if value else at
    end = ends[kind]
    counts = None
    while end > at and (text[end - 1] in ",;" or text[end - 1] in _CLOSERS):
        closer = text[end - 1]
        if closer in _CLOSERS:
            counts = counts or {c: text.count(c, at, end) for pair in _CLOSERS.items() for c in pair}
            if counts[closer] <= counts[_CLOSERS[closer]]:
                break
            counts[closer] -= 1
        end -= 1
    return at, end


def block_lines(text: str, bind: re.Match) -> list[tuple[int, int]]:
    """The lines of the YAML block scalar that starts where ``bind`` ends."""
    scalar = _SCALAR.match(text, bind.end())
    if not scalar:
        return []
    lead = text.rfind("\n", 0, bind.start()) + 1
    indent = len(text[lead:bind.start()]) - len(text[lead:bind.start()].lstrip(" \t-"))
    out, at = [], scalar.end()
    while at < len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        line = text[at:end]
        if line.strip():
            start = at + len(line) - len(line.lstrip(" \t"))
            if start - at <= indent:
                break
            out.append((start, at + len(line.rstrip())))
        at = end + 1
    return out


def name_literal_pairs(text: str) -> tuple[dict[str, list], dict[str, set[str]]]:
    """Literals (start, end) assigned to each name, and names each name reads."""
    literals: dict[str, list] = {}
    reads: dict[str, set[str]] = {}
    binds = list(_BIND.finditer(text))
    names = {b[1] or b[2] for b in binds}
    longest = max(map(len, names), default=0)
    ends: dict = {}

    def literal(target: str, start: int, end: int) -> None:
        if named := _NAMED.fullmatch(text, start, end):
            if (named[1] or named[2]) in names:
                reads.setdefault(target, set()).add(named[1] or named[2])
                return
        if default := _DEFAULT.fullmatch(text, start, end):
            start, end = default.span(1)
        literals.setdefault(target, []).append((start, end))

    for bind in binds:
        target, at = bind[1] or bind[2], bind.end()
        if lines := block_lines(text, bind):
            for start, end in lines:
                literal(target, start, end)
            continue
        while at < len(text):
            if value := _QUOTED.match(text, at):
                literal(target, value.start(1) + 1, value.end(1) - 1)
                at = value.end()
                if value[2]:
                    continue
            elif chained := _CHAINED.match(text, at):
                reads.setdefault(target, set()).add(chained[1])
            elif (part := _PART_OF_SUM.match(text, at)) or (part := _SUM_OF_NAMES.match(text, at)) and part[1] in names:
                reads.setdefault(target, set()).add(part[1])
                at = part.end()
                continue
            else:
                start, end = bare_value(text, bind, at, ends)
                if end - start <= longest and text[start:end] in names:
                    reads.setdefault(target, set()).add(text[start:end])
                elif end > start and not (_WORD.fullmatch(text, start, end) or _KEY.fullmatch(text, start, end)):
                    literal(target, start, end)
            break
    return literals, reads


def literal_spans(text: str, threshold: float = 0.5) -> list[tuple[int, int]]:
    """Spans of literals that reach a sensitive name, directly or as constants."""
    if "=" not in text and ":" not in text:
        return []
    literals, reads = name_literal_pairs(text)
    if not literals:
        return []
    weight = {n: sensitivity(n) for n in literals.keys() | reads.keys()}
    queue = [n for n, w in weight.items() if w]
    while queue:  # sensitivity flows from a target to the constants it is built from
        name = queue.pop()
        for source in reads.get(name, ()):
            if weight.get(source, 0.0) < weight[name]:
                weight[source] = weight[name]
                queue.append(source)
    found: dict[int, int] = {}
    for start, end, w in sorted((s, e, weight[n]) for n, spans in literals.items() if weight[n] for s, e in spans):
        if end not in found and w * literal_score(text[start:end]) >= threshold:  # else a longer literal ends here
            found[end] = start
    return sorted((s, e) for e, s in found.items())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the three base kinds."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def all_spans(text: str) -> list[tuple[int, int, int]]:
    """Base spans and literal spans that no base span covers, by start and kind."""
    base = base_spans(text)
    reach = [0, *accumulate((e for _, _, e in base), max)]
    more = [(s, 3, e) for s, e in literal_spans(text)
            if reach[bisect_right(base, s, key=lambda x: x[0])] < e]
    return sorted(base + more)


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _texts(batches):
    for rows, _, _ in blocks(batches):
        yield rows, rows.column(rows.schema.get_field_index("text")).to_pylist()


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Per document: counts of base spans, their digest, and all spans."""

    def scan(batches):
        for rows, texts in _texts(batches):
            found = [all_spans(t) for t in texts]
            base = [[x for x in f if x[1] < 3] for f in found]
            count = lambda k: pa.array([sum(x[1] == k for x in b) for b in base], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), count(0), count(1), count(2),
                 pa.array([hashlib.sha256(render(b).encode()).hexdigest() for b in base]),
                 pa.array([render(f) for f in found])],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return id_and_text(docs).mapInArrow(scan, SCHEMA)


def redact(text: str, mark: str = "[REDACTED]") -> str:
    """The text with every found span replaced; overlapping spans become one mark."""
    out, at = [], 0
    for start, _, end in all_spans(text):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns with secrets masked; null text stays null."""
    where = docs.columns.index(text_col)

    def mask(batches):
        for b in batches:
            texts = pa.array([None if t is None else redact(t) for t in b.column(where).to_pylist()], pa.string())
            yield b.set_column(where, b.schema.field(where), texts)

    return docs.mapInArrow(mask, docs.schema)
