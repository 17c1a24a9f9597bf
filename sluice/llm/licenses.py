"""License scan: phrases and identifier tags by Aho-Corasick, expressions by shunting-yard.

Each text is lower-cased (A-Z) and reduced to its words with one space between
them; one automaton finds every notice phrase there, overlapping ones too.  A
second automaton finds SPDX tags and licence fields (``"license": "..."``,
``License: ...``) in the raw text; the expression behind one goes through a
shunting-yard parser into postfix form, which is evaluated: ``with`` ties an
exception to its licence, ``and`` binds both sides, ``or`` leaves the choice.
Of each expression come the licences it may put on the reader, those that bind
under every choice, the number of choices, and whether permissive licences
alone can satisfy it.  Licences it names become labels.

Defined cases: null or empty text has no words, labels '' and score 0; phrases
never cross documents; a malformed expression yields no label, nor does a
licence field that names no known licence; repeated rows are scanned alike;
texts are scanned whole, in time proportional to their length; an empty table
gives no rows.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import LOWER_BYTES, SPACED_BYTES, blocks, id_and_text, ids_of

# Base phrases and their labels.
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache",
                "cc by": "cc-by", "mit license": "mit"}
# Further notice phrases the method looks for.
MORE_PHRASES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "creative commons attribution": "cc-by",
    "bsd license": "bsd",
}
# Identifier prefixes of licence expressions and their labels.
IDENTIFIERS = {"apache": "apache", "mit": "mit", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl",
               "bsd": "bsd", "mpl": "mpl", "cc-by": "cc-by", "cc0": "cc0", "isc": "isc",
               "unlicense": "unlicense", "epl": "epl"}
TAGS = ("spdx-license-identifier:", "spdx-license-identifier :")
# Fields of package descriptions that hold an expression.
FIELDS = ('"license":', '"license" :', "'license':", "license:", "license :", "license =", "license=")
# Labels whose licences ask for no more than notices.
PERMISSIVE = {"apache", "mit", "bsd", "cc-by", "cc0", "isc", "unlicense"}

_TOKEN = re.compile(rb"[ \t]*(\(|\)|[a-z0-9][a-z0-9.+-]*)")
_OPENING = re.compile(rb"[ \t]*[\"']?")
_OPERATORS = {"or": 1, "and": 2, "with": 3}

SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
          "base_labels string, labels string, score double, expressions array<string>, "
          "outcomes array<struct<licenses: array<string>, binding: array<string>, choices: bigint, permissive: boolean>>")


def parse_expression(text: bytes, at: int = 0, end: int | None = None) -> tuple[list[str], str] | None:
    """Licence ids and the postfix form of the expression at ``at`` in ``text``.

    Shunting-yard: ``with`` binds tighter than ``and``, ``and`` than ``or``;
    reading stops at the first place where no expression can go on.  None when
    there is no well-formed expression.
    """
    out: list[str] = []
    stack: list[str] = []
    names: list[str] = []
    operand, end = True, len(text) if end is None else end
    while m := _TOKEN.match(text, at, end):
        word = m[1].decode()
        if operand:
            if word == "(":
                stack.append(word)
            elif word == ")" or word in _OPERATORS:
                return None
            else:
                if not (stack and stack[-1] == "with"):
                    names.append(word)
                out.append(word)
                operand = False
        elif word == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
        elif word in _OPERATORS:
            while stack and stack[-1] != "(" and _OPERATORS[stack[-1]] >= _OPERATORS[word]:
                out.append(stack.pop())
            stack.append(word)
            operand = True
        else:
            break
        at = m.end()
    if operand or "(" in stack:
        return None
    return names, " ".join(out + stack[::-1])


#: ``choices`` of an outcome at most; there may be 2**n of them.
MANY = 2**63 - 1


def evaluate(postfix: str) -> dict:
    """What a postfix expression asks for.

    ``licenses``: all it names, with their exceptions; ``binding``: those in force
    whatever is chosen; ``choices``: ways to choose; ``permissive``: one of
    them has permissive licences only.  A node's value is made from its sides'
    values, so the choices are counted but not listed.
    """
    stack: list[dict] = []
    for word in postfix.split():
        if word not in _OPERATORS:
            stack.append({"licenses": [word], "binding": {word}, "choices": 1, "permissive": label_of(word) in PERMISSIVE})
            continue
        right, left = stack.pop(), stack.pop()
        if word == "with":
            exception = f" with {'/'.join(right['licenses'])}"
            stack.append(left | {"licenses": [x + exception for x in left["licenses"]], "binding": {x + exception for x in left["binding"]}})
            continue
        few, many = sorted((left, right), key=lambda v: len(v["licenses"]))
        both = {"licenses": many["licenses"]}
        both["licenses"].extend(few["licenses"])
        if word == "and":
            both["binding"] = many["binding"]
            both["binding"] |= few["binding"]
            both["choices"] = min(left["choices"] * right["choices"], MANY)
            both["permissive"] = left["permissive"] and right["permissive"]
        else:
            both["binding"] = left["binding"] & right["binding"]
            both["choices"] = min(left["choices"] + right["choices"], MANY)
            both["permissive"] = left["permissive"] or right["permissive"]
        stack.append(both)
    (value,) = stack
    return value | {"licenses": sorted(set(value["licenses"])), "binding": sorted(value["binding"])}


def label_of(identifier: str) -> str | None:
    """Label of a licence identifier such as ``apache-2.0`` or ``gpl-3.0-or-later``."""
    while identifier:
        if identifier in IDENTIFIERS:
            return IDENTIFIERS[identifier]
        identifier = identifier.rpartition("-")[0]
    return None


def _automaton(words):
    found = ahocorasick.Automaton()
    for key, value in words:
        found.add_word(key, value)
    found.make_automaton()
    return found


class Scanner:
    def __init__(self):
        self.phrases = _automaton((f" {p} ", (len(p), p in BASE_PHRASES, label))
                                  for p, label in (MORE_PHRASES | BASE_PHRASES).items())
        self.tags = _automaton([*((t, True) for t in TAGS), *((f, False) for f in FIELDS)])

    def scan(self, raw: bytes) -> tuple:
        """(n_words, places of base phrases, base labels, all labels, expressions, outcomes)."""
        words = raw.translate(SPACED_BYTES).split()
        line = f" {b' '.join(words).decode()} "
        places, base, labels, expressions, outcomes = [], set(), set(), [], []
        at = word = 0
        for end, (length, is_base, label) in self.phrases.iter(line):
            labels.add(label)
            if is_base:
                start = end - length  # the phrase's first letter
                if start >= at:
                    word += line.count(" ", at, start)
                    at = start
                    places.append(word - 1)
                else:
                    places.append(word - line.count(" ", start, at) - 1)
                base.add(label)
        lower = raw.translate(LOWER_BYTES)
        if b"license" in lower:
            line_end = read = -1
            # latin-1 keeps one character per byte, so ends are byte offsets
            for end, is_tag in self.tags.iter(lower.decode("latin-1")):
                start = end + 1
                if start <= read:  # a shorter form of the field just read
                    continue
                if line_end < start:
                    line_end = lower.find(b"\n", start)
                    line_end = len(lower) if line_end < 0 else line_end
                if not is_tag:
                    start = _OPENING.match(lower, start, line_end).end()
                parsed = parse_expression(lower, start, line_end)
                known = {x for x in map(label_of, parsed[0]) if x} if parsed else set()
                if parsed and (is_tag or known):
                    expressions.append(parsed[1])
                    outcomes.append(evaluate(parsed[1]))
                    labels |= known
                    read = start
        return len(words), places, base, labels, expressions, outcomes


_OUTCOME = pa.struct([("licenses", pa.list_(pa.string())), ("binding", pa.list_(pa.string())), ("choices", pa.int64()), ("permissive", pa.bool_())])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per document: word count, base phrase places, labels, expressions and what they ask for, score.

    The score is the share of evidence against none: n / (n + 1) over base
    places and expressions.
    """

    def scan(batches):
        scanner = Scanner()
        for rows, data, offsets in blocks(batches):
            raw = data.tobytes()
            found = [scanner.scan(raw[offsets[k]:offsets[k + 1]]) for k in range(rows.num_rows)]
            evidence = [len(f[1]) + len(f[4]) + len(f[3] - f[2]) for f in found]
            columns = [
                pa.array([f[0] for f in found], pa.int64()), pa.array([len(f[1]) for f in found], pa.int64()),
                pa.array([min(f[1], default=None) for f in found], pa.int64()),
                pa.array([max(f[1], default=None) for f in found], pa.int64()),
                pa.array([",".join(sorted(f[2])) for f in found]), pa.array([",".join(sorted(f[3])) for f in found]),
                pa.array([n / (n + 1) for n in evidence], pa.float64()),
                pa.array([f[4] for f in found], pa.list_(pa.string())),
                pa.array([f[5] for f in found], pa.list_(_OUTCOME))]
            yield pa.RecordBatch.from_arrays([ids_of(rows), *columns],
                                             ["doc_id", "n_words", "n_base", "first_word", "last_word",
                                              "base_labels", "labels", "score", "expressions", "outcomes"])

    return id_and_text(docs).mapInArrow(scan, SCHEMA)
