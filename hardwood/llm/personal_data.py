"""Personal data by a linear-chain conditional random field over word shapes, and fixed forms.

Words are runs between white space, lines are the chains. A word's shape holds counts of digits,
letters, dots, dashes and the like in small classes; the field's features are the shapes of a word
and its neighbours, their single parts, and the transitions between labels (outside, begin and
inside of each kind). It is trained by maximum likelihood on a small labelled table that is made
from templates here. Decoding is Viterbi, many lines together in numpy; a line in which no word can
gain from any label but "outside", by an upper bound on every path, needs no decoding.

The fixed forms (e-mail, IP address, card, phone) are found by exact patterns, leftmost and not
overlapping within a kind, and always stay; the field adds spans beside them, also of secrets
(long hexadecimal keys), when they pass its kind's plain check (digits, dots) and overlap none.

Defined results: NULL or empty text has no spans. Offsets are code points, ends exclusive. Spans
are ordered by start, then kind. Texts of any length are read whole; repeated rows are read alike.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame

from hardwood.llm.common import map_rows

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
MASKS = {kind: f"<{kind.upper()}>" for kind in KINDS}
LABELS = ["O", *(f"{p}-{k}" for k in KINDS for p in "BI")]

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# Starting at the first digit of a run changes no match and keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of the address pattern, found from their @ signs."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            out.append((start, match.end()))
            end = match.end()
        else:
            end = max(end, start if start == at else end)
        at = text.find("@", max(at + 1, end))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed forms."""
    if not text:
        return []
    out = [(a, b, "email") for a, b in _emails(text)] if "@" in text else []
    if _ANY_DIGIT.search(text):
        if "." in text:
            out += [
                (m.start(), m.end(), "ip") for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
            ]
        for m in _DIGITS.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), m.end(), "card"))
        if "+" in text:
            out += [
                (m.start(), m.end(), "phone") for m in _PHONE.finditer(text)
                if 9 <= sum(c.isascii() and c.isdigit() for c in m[0]) <= 15
            ]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


# ---- word shapes

_CLASSES = 11
_CLASS = np.full(128, 9, np.uint8)
for _chars, _class in ((" \t\n\r\x0b\x0c", 0), ("abcdefghijklmnopqrstuvwxyz", 1), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2),
                       ("0123456789", 3), ("@", 4), (".", 5), ("-", 6), ("+", 7), ("()", 8)):
    for _c in _chars:
        _CLASS[ord(_c)] = _class
_HEX = np.zeros(128, bool)
_HEX[[ord(c) for c in "0123456789abcdefABCDEF\"'`,;:="]] = True
# Parts of a shape and how many values each has.
_PARTS = (("digits", 7), ("letters", 4), ("at", 2), ("dots", 4), ("dash", 2), ("plus", 2), ("paren", 2), ("hex", 2), ("other", 2))
_SHAPES = int(np.prod([n for _, n in _PARTS]))


class Words:
    """Words of many texts: where they lie, their shapes and their lines."""

    def __init__(self, texts: list[str]):
        codes = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
        # A line end between texts keeps lines apart.
        gap = np.array([10], np.uint32)
        joined = np.concatenate([c for own in codes for c in (own, gap)]) if codes else gap
        self.text_starts = np.cumsum([0, *(len(c) + 1 for c in codes)])
        kinds = np.where(joined < 128, _CLASS[np.minimum(joined, 127)], 10).astype(np.uint8)
        solid = kinds > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8)))
        self.starts, self.ends = edges[::2], edges[1::2]
        lines = np.cumsum(joined == 10, dtype=np.int64)
        self.line = lines[self.starts]
        self.shape = self._shapes(joined, kinds)

    def _counts(self, flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
        return total[self.ends] - total[self.starts]

    def _shapes(self, joined: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        n = len(self.starts)
        if not n:
            return np.zeros(0, np.int64)
        # Most words are letters alone; the counts are taken over the others only.
        odd = (kinds > 2) & (kinds < 10)
        special = self._counts(odd) > 0
        shape = np.zeros(n, np.int64)
        length = self.ends - self.starts
        letters = np.digitize(length, [1, 2, 8])
        values = {"letters": letters}
        shape[~special] = self._combine({"letters": letters[~special]}, int((~special).sum()))
        at = np.flatnonzero(special)
        if len(at):
            starts, ends = self.starts[at], self.ends[at]
            size = ends - starts
            flat = np.repeat(starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            own = np.repeat(np.arange(len(at)), size)
            kind, code = kinds[flat], joined[flat]
            of = np.bincount(own * _CLASSES + kind, minlength=len(at) * _CLASSES).reshape(-1, _CLASSES)
            hexes = np.bincount(own, weights=(code < 128) & _HEX[np.minimum(code, 127)], minlength=len(at))
            values = {
                "digits": np.digitize(of[:, 3], [1, 4, 5, 9, 12, 20]),
                "letters": np.digitize(of[:, 1] + of[:, 2] + of[:, 10], [1, 2, 8]),
                "at": of[:, 4] > 0, "dots": np.minimum(of[:, 5], 3), "dash": of[:, 6] > 0,
                "plus": of[:, 7] > 0, "paren": of[:, 8] > 0,
                "hex": (hexes == size) & (size >= 16), "other": of[:, 9] > 0,
            }
            shape[at] = self._combine(values, len(at))
        return shape

    @staticmethod
    def _combine(values: dict, n: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        for name, count in _PARTS:
            out = out * count + values.get(name, 0)
        return out


def _part_values() -> np.ndarray:
    """Rows of 0/1 features, one per shape: each part's value."""
    out, rest = [], np.arange(_SHAPES)
    for _, count in reversed(_PARTS):
        out.append(np.eye(count)[rest % count])
        rest = rest // count
    return np.concatenate(out, axis=1)


# ---- the labelled table

_FILL = ("the report was sent on Monday to our office and nobody read it yet . see page 12 of 340 , "
         "Version 2.0. , 3.14 percent or 1,000 units in 2024 | 10:30 mp3 x86 Er*** the&&& und die nicht "
         "la de que el los año größer été A1 (see above) half-way e.g. 12/05/2024 #7 $5 -3 +4 v1.2.3 "
         "www.example.org 4.5.6 no. 77 555 1984, 20-30 well-known").split()
_FRAMES = ("write to {email} for more", "{email}", "mail: {email}, or call {phone} now", "call {phone} today", "tel. {phone}.",
           "phone {phone} is ours", "host {ip} replied", "from {ip}, port 80", "{ip}", "card {card} was charged", "pay with {card}.",
           "{card}", "token = {secret} was found", "key: {secret}", "{secret}", "the {ip} and {email} of it")


def labelled_table(rows: int = 420, seed: int = 11) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Small training table: lines of text with the spans of personal data in them."""
    rng = np.random.default_rng(seed)
    pick = lambda items: items[int(rng.integers(len(items)))]
    number = lambda n: "".join(str(d) for d in rng.integers(0, 10, n))
    name = lambda n: "".join(pick("abcdefghiklmnoprstuvw") for _ in range(n))

    def value(kind: str) -> str:
        if kind == "email":
            return f"{name(rng.integers(2, 9))}{pick(['', '.', '_'])}{number(rng.integers(0, 3))}@{name(5)}{pick(['', '1', '.mail'])}.{pick(['com', 'org', 'net'])}"
        if kind == "ip":
            return ".".join(str(x) for x in rng.integers(1, 255, 4))
        if kind == "card":
            return pick([" ", "-"]).join(number(4) for _ in range(4)) if rng.random() < 0.6 else number(16)
        if kind == "phone":
            return pick([f"+{number(1)} ({number(3)}) {number(3)}-{number(4)}", f"+{number(2)} {number(3)} {number(6)}", f"+{number(11)}",
                         f"({number(3)}) {number(3)}-{number(4)}", f"{number(3)}-{number(3)}-{number(4)}"])
        text = "".join(pick("0123456789abcdef") for _ in range(pick([20, 32, 40])))
        return pick(['"{}"', "{}"]).format(text)

    out = []
    for i in range(rows):
        filler = lambda: " ".join(pick(_FILL) for _ in range(rng.integers(0, 7)))
        pieces, spans = [filler() + " "], []
        if i % 3:
            for part in re.split(r"(\{\w+\})", pick(_FRAMES)):
                if part.startswith("{"):
                    kind = part[1:-1]
                    filled = value(kind)
                    at = sum(map(len, pieces))
                    spans.append((at, at + len(filled), kind))
                    pieces.append(filled)
                else:
                    pieces.append(part)
        pieces.append(" " + filler())
        out.append(("".join(pieces), spans))
    return out


# ---- the field

class Field:
    """Score tables of the trained field."""

    def __init__(self, own, before, after, moves, first):
        self.own, self.before, self.after, self.moves, self.first = own, before, after, moves, first
        gain = lambda w: (w[:, 1:] - w[:, :1]).max(axis=1)
        # Above what "outside" scores, a word adds at most its gains and two better transitions.
        top = max(float(moves.max() - moves[0, 0]), float((first - first[0]).max()), 0.0)
        self.gains = gain(own) + 2 * top, gain(before), gain(after)

    def neighbours(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Shapes before and after each word in its line; the last row of a table is 'none'."""
        shape, same = words.shape, words.line[1:] == words.line[:-1]
        before, after = np.full(len(shape), _SHAPES), np.full(len(shape), _SHAPES)
        before[1:][same], after[:-1][same] = shape[:-1][same], shape[1:][same]
        return before, after

    def decode(self, words: Words) -> np.ndarray:
        """The label of every word."""
        labels = np.zeros(len(words.shape), np.int8)
        if not len(labels):
            return labels
        before, after = self.neighbours(words)
        bound = self.gains[0][words.shape] + self.gains[1][before] + self.gains[2][after]
        wanted = np.isin(words.line, np.unique(words.line[bound >= 0]))
        at = np.flatnonzero(wanted)
        if not len(at):
            return labels
        emissions = self.own[words.shape[at]] + self.before[before[at]] + self.after[after[at]]
        starts = np.flatnonzero(np.concatenate([[True], words.line[at][1:] != words.line[at][:-1]]))
        lengths = np.diff(np.append(starts, len(at)))
        order = np.argsort(lengths, kind="stable")
        low = 0
        while low < len(order):
            high = low + 1
            while high < len(order) and (high - low + 1) * lengths[order[high]] <= 20_000:
                high += 1
            rows = order[low:high]
            for row, path in zip(rows, self._viterbi(emissions, starts[rows], lengths[rows]), strict=True):
                labels[at[starts[row] : starts[row] + lengths[row]]] = path
            low = high
        return labels

    def _viterbi(self, emissions, starts, lengths):
        longest, n = int(lengths.max()), len(starts)
        score = self.first + emissions[starts]
        back = np.zeros((longest, n, len(LABELS)), np.int8)
        for t in range(1, longest):
            live = np.flatnonzero(lengths > t)
            paths = score[live][:, :, None] + self.moves
            back[t, live] = paths.argmax(axis=1)
            score[live] = paths.max(axis=1) + emissions[starts[live] + t]
        out = []
        last = score.argmax(axis=1)
        for i in range(n):
            path, label = [], int(last[i])
            for t in range(int(lengths[i]) - 1, -1, -1):
                path.append(label)
                label = int(back[t, i, label])
            out.append(path[::-1])
        return out


def train(rows: list[tuple[str, list[tuple[int, int, str]]]] | None = None, steps: int = 60) -> Field:
    """Maximum likelihood by full-batch Adam with a small ridge; forward and backward in numpy."""
    rows = labelled_table() if rows is None else rows
    words = Words([text for text, _ in rows])
    gold = np.zeros(len(words.shape), int)
    text_of = np.searchsorted(words.text_starts, words.starts, "right") - 1
    for i, w in enumerate(text_of):
        a, b = words.starts[i] - words.text_starts[w], words.ends[i] - words.text_starts[w]
        for start, end, kind in rows[w][1]:
            if a < end and b > start:
                gold[i] = 1 + 2 * KINDS.index(kind) + int(a > start)
    L, features = len(LABELS), _part_values()
    width = features.shape[1]
    none = np.zeros((1, width))
    table = np.concatenate([features, none])
    shapes_used, own_at = np.unique(words.shape, return_inverse=True)
    f = Field.__new__(Field)
    before, after = Field.neighbours(f, words)
    inputs = np.concatenate([table[words.shape], table[before], table[after], np.eye(len(shapes_used))[own_at]], axis=1)
    starts = np.flatnonzero(np.concatenate([[True], words.line[1:] != words.line[:-1]]))
    lengths = np.diff(np.append(starts, len(gold)))
    n, longest = len(starts), int(lengths.max())
    W, T, S = np.zeros((inputs.shape[1], L)), np.zeros((L, L)), np.zeros(L)
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (W, T, S)]
    log_sum = lambda x, axis: (m := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis=axis))
    for step in range(1, steps + 1):
        e = inputs @ W
        alpha, beta = np.full((longest, n, L), -1e9), np.zeros((longest, n, L))
        alpha[0] = S + e[starts]
        for t in range(1, longest):
            live = np.flatnonzero(lengths > t)
            alpha[t, live] = log_sum(alpha[t - 1, live][:, :, None] + T, 1) + e[starts[live] + t]
        total = log_sum(alpha[lengths - 1, np.arange(n)], 1)
        for t in range(longest - 2, -1, -1):
            live = np.flatnonzero(lengths > t + 1)
            beta[t, live] = log_sum(T + (e[starts[live] + t + 1] + beta[t + 1, live])[:, None, :], 2)
        error, dT = np.zeros((len(gold), L)), -1e-2 * T
        for t in range(longest):
            live = np.flatnonzero(lengths > t)
            error[starts[live] + t] = -np.exp(alpha[t, live] + beta[t, live] - total[live][:, None])
            if t:
                pair = alpha[t - 1, live][:, :, None] + T + (e[starts[live] + t] + beta[t, live])[:, None, :]
                dT = dT - np.exp(pair - total[live][:, None, None]).sum(0)
                np.add.at(dT, (gold[starts[live] + t - 1], gold[starts[live] + t]), 1)
        error[np.arange(len(gold)), gold] += 1
        dS = error[starts].sum(0) - 1e-2 * S
        for p, g, (m, v) in zip((W, T, S), (inputs.T @ error - 2e-2 * W, dT, dS), state, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.25 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    own = features @ W[:width]
    own[shapes_used] += W[3 * width :]
    pad = lambda w: np.concatenate([features @ w, np.zeros((1, L))])
    return Field(own, pad(W[width : 2 * width]), pad(W[2 * width : 3 * width]), T, S)


def _passes(kind: str, found: str) -> bool:
    digits = sum(c.isascii() and c.isdigit() for c in found)
    if kind == "email":
        return "@" in found[1:-1] and "." in found
    if kind == "ip":
        return all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in found.split(".")) and found.count(".") == 3
    if kind == "card":
        only = "".join(c for c in found if c not in " -")
        return 12 <= len(only) <= 19 and len(only) == digits and _luhn(only)
    if kind == "phone":
        return 9 <= digits <= 15 and all(c in "+ ().-" or c.isdigit() for c in found)
    return len(found) >= 16 and digits >= 3 and all(c in "0123456789abcdefABCDEF" for c in found)


def all_spans(texts: list[str | None], field: Field) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    whole = [t or "" for t in texts]
    words = Words(whole)
    labels = field.decode(words)
    extra: list[list[tuple[int, int, str]]] = [[] for _ in whole]
    at = np.flatnonzero(labels)
    for i in at:
        kind, inside = KINDS[(labels[i] - 1) // 2], labels[i] % 2 == 0
        text = int(np.searchsorted(words.text_starts, words.starts[i], "right")) - 1
        offset = words.text_starts[text]
        a, b = int(words.starts[i] - offset), int(words.ends[i] - offset)
        own = extra[text]
        if inside and i and labels[i - 1] and words.line[i] == words.line[i - 1] and own and own[-1][2] == kind:
            own[-1] = (own[-1][0], b, kind)
        else:
            own.append((a, b, kind))
    out = []
    for text, own in zip(whole, extra, strict=True):
        base = base_spans(text)
        added = []
        for a, b, kind in own:
            while a < b and text[a] in "\"'`,;:=<>[]{}.!?":
                a += 1
            while b > a and text[b - 1] in "\"'`,;:=<>[]{}.!?":
                b -= 1
            if b > a and _passes(kind, text[a:b]) and not any(a < e and s < b for s, e, _ in base):
                added.append((a, b, kind))
        out.append((base, sorted({*base, *added}, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))))
    return out


def _written(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Append n_email, n_ip, n_card, n_phone, base_sha256 and spans to every row."""
    shared, at = docs.sparkSession.sparkContext.broadcast(train()), docs.columns.index(text)

    def make():
        field = shared.value

        def compute(part):
            found = all_spans(part.column(at).to_pylist(), field)
            counts = [[sum(s[2] == kind for s in base) for base, _ in found] for kind in BASE_KINDS]
            sums = [hashlib.sha256(_written(base).encode()).hexdigest() for base, _ in found]
            return [*counts, sums, [_written(spans) for _, spans in found]]

        return compute

    added = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return map_rows(docs, make, added, keep=[c for c in docs.columns if c != text])


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span, and what overlaps it, replaced by its kind."""
    out, end = [], 0
    for a, b, kind in spans:
        if a >= end:
            out += [text[end:a], MASKS[kind]]
        end = max(end, b)
    return "".join([*out, text[end:]])


def mask_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data in the text replaced; NULL stays NULL. The text comes last."""
    shared, at = docs.sparkSession.sparkContext.broadcast(train()), docs.columns.index(text)

    def make():
        field = shared.value

        def compute(part):
            texts = part.column(at).to_pylist()
            found = all_spans(texts, field)
            return [[None if t is None else masked(t, spans) for t, (_, spans) in zip(texts, found, strict=True)]]

        return compute

    return map_rows(docs, make, f"`{text}` string").select(*docs.columns)
