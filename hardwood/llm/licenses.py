"""Licence scan: Aho-Corasick for notice phrases and identifier tags, shunting-yard for expressions.

Text is lower-cased (A-Z) and read as words, runs of ``[0-9a-z]`` and non-ASCII characters. One
automaton over the words finds every place of every phrase, overlapping ones too, and the tag
``SPDX-License-Identifier``. The licence expression after a tag, up to the end of its line, is
parsed by a shunting-yard (``with`` binds tighter than ``and``, ``and`` tighter than ``or``) and
evaluated: its identifiers become labels, and ``permissive`` tells whether some choice it offers
holds permissive licences only. An identifier has a digit or a dash, or is a name known here, so
that prose after a tag is none.

Defined results: NULL or empty text has no words, no places and score 0. A broken expression gives
the labels of its leading well-formed identifiers and no verdict. Repeated rows are scanned alike.
The time for a text grows with its length, however many phrases and tags it holds.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame

from hardwood.llm.common import map_rows

#: Base phrases and their labels (fixed values).
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further notice phrases: label, and how strongly one place speaks for a licence.
NOTICES = {
    "lesser general public license": ("lgpl", 0.9),
    "affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "boost software license": ("bsl", 0.9),
    "bsd license": ("bsd", 0.8),
    "isc license": ("isc", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.7),
    "permission is hereby granted free of charge": ("mit", 0.7),
    "creative commons attribution": ("cc", 0.8),
    "released into the public domain": ("unlicense", 0.6),
}
BASE_WEIGHT = 0.9
TAG = "spdx license identifier"
PERMISSIVE = {"mit", "apache", "bsd", "isc", "bsl", "zlib", "unlicense", "cc0", "0bsd"}

_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)
_RAW_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9.+:-]+)")
_STRENGTH = {"or": 1, "and": 2, "with": 3}
_AFTER_TAG = re.compile(r"[ \t]*:?[ \t]*([^\r\n]*)")
#: Licence identifiers without a digit or a dash, beside the labels above.
_PLAIN_NAMES = PERMISSIVE | {label for label, _ in NOTICES.values()} | set(BASE.values()) | {
    "beerware", "curl", "libpng", "ntp", "openssl", "php", "postgresql", "python", "ruby", "sleepycat", "vim", "wtfpl", "x11",
}


def family(identifier: str) -> str:
    return re.split(r"[-+]", identifier.lower(), maxsplit=1)[0]


def is_identifier(token: str) -> bool:
    return "-" in token or any(c.isdigit() for c in token) or token.lower().rstrip("+") in _PLAIN_NAMES


def postfix(expression: str, names_licence: Callable[[str], bool] = bool) -> list[str]:
    """The shunting-yard's output; it stops at the first token that cannot follow."""
    out: list[str] = []
    waiting: list[str] = []
    operand_next, at = True, 0
    while match := _TOKEN.match(expression, at):
        token, at = match[1].rstrip(".:-"), match.end()
        operator = token.lower() if token.lower() in _STRENGTH else None
        if operand_next and (token == ")" or operator) or not operand_next and not (token == ")" or operator):
            break
        if operand_next and token != "(" and not names_licence(token):
            break
        if token == "(":
            waiting.append(token)
        elif token == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                break
            waiting.pop()
        elif operator:
            while waiting and waiting[-1] != "(" and _STRENGTH[waiting[-1]] >= _STRENGTH[operator]:
                out.append(waiting.pop())
            waiting.append(operator)
            operand_next = True
        else:
            out.append(token)
            operand_next = False
    return out + [w for w in reversed(waiting) if w != "("]


def evaluate(expression: str) -> tuple[set[str], bool | None]:
    """Labels of the licences in an expression, and whether a permissive choice satisfies it."""
    labels: set[str] = set()
    values: list[tuple[bool, str]] = []
    for token in postfix(expression, is_identifier):
        if token not in _STRENGTH:
            values.append((family(token) in PERMISSIVE, family(token)))
        elif len(values) < 2:
            return labels | {v[1] for v in values if v[1]}, None
        else:
            right, left = values.pop(), values.pop()
            if token == "with":  # an exception is no licence
                values.append(left)
                continue
            labels |= {v[1] for v in (left, right) if v[1]}
            values.append((left[0] or right[0] if token == "or" else left[0] and right[0], ""))
    labels |= {v[1] for v in values if v[1]}
    return labels, values[0][0] if len(values) == 1 else None


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    weights = {p: (label, BASE_WEIGHT, True) for p, label in BASE.items()}
    weights |= {p: (label, weight, False) for p, (label, weight) in NOTICES.items()}
    weights[TAG] = (None, 0.0, False)
    for phrase, (label, weight, base) in weights.items():
        # Spaces at both ends keep matches on whole words; neighbours share a space.
        found.add_word(f" {phrase} ", (phrase.count(" ") + 2, label, weight, base))
    found.make_automaton()
    return found


def _expressions(text: str, ends: list[int]) -> list[str]:
    """What follows the words with these numbers, up to the end of the line."""
    wanted, out = set(ends), []
    for number, match in enumerate(_RAW_WORD.finditer(text)):
        if number in wanted:
            out.append(_AFTER_TAG.match(text, match.end())[1])
    return out


def scan(text: str | None, machine: ahocorasick.Automaton) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, permissive."""
    words = (text or "").encode().translate(_WORDS).split()
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    base: list[tuple[int, str]] = []
    labels: set[str] = set()
    missing, tags, verdicts = 1.0, [], []
    passed, read = 0, 0  # spaces up to the match's last character; matches come by their ends
    for end, (gaps, label, weight, is_base) in machine.iter(joined):
        passed, read = passed + joined.count(" ", read, end + 1), end + 1
        start = passed - gaps
        if label is None:
            tags.append(start + 2)  # the tag's third word
            continue
        labels.add(label)
        missing *= 1 - weight
        if is_base:
            base.append((start, label))
    for expression in _expressions(text, tags) if tags else []:
        found, verdict = evaluate(expression)
        labels |= found
        missing *= 0.02 if found else 1
        verdicts += [verdict] if verdict is not None else []
    starts = [s for s, _ in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({b for _, b in base})), ",".join(sorted(labels)), 1 - missing,
        all(verdicts) if verdicts else None,
    )


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """Append the results of ``scan`` to every row."""
    at = docs.columns.index(text)

    def make():
        machine = automaton()
        return lambda part: list(zip(*(scan(t, machine) for t in part.column(at).to_pylist()), strict=True))

    added = (
        "n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, permissive boolean"
    )
    return map_rows(docs, make, added, keep=[c for c in docs.columns if c != text])


