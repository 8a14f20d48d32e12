"""Unigram tokens by Viterbi over a double-array trie of scored pieces, and back to text.

A piece table (text, score and kind of every id) comes from a SentencePiece model file. The scores
of a BPE model are merge ranks, no log probabilities, so ``fit`` estimates those from all texts:
the distinct words are counted, segmented into as few pieces as possible, and the pieces' counts
give log probabilities, which are estimated again from the best segmentations under themselves.
White space becomes a marker, one marker is put before the text, and the segmentation with the
greatest sum of piece scores is taken. A character that no piece covers costs less than any piece by
``UNKNOWN_PENALTY`` and becomes its UTF-8 bytes' pieces. Decoding joins pieces and bytes, turns
markers to spaces and drops the first; it restores every text exactly, also one that holds the
marker character itself, which is always encoded as bytes.

No piece holds a marker after another character, nor a line end (checked when the trie is built),
so the best path of a text is the best paths of its words, which are solved many together in numpy.
The ``KNOWN_WORDS`` most frequent words are solved once and broadcast with the model; a task solves
the others as they come and remembers some. Ties go to the longer last piece.

Defined results: NULL and empty texts have no tokens and decode to an empty text. Without any text
all pieces score alike. Log probabilities are rounded to 2^-20, so that sums of them are exact.
Texts of any length are encoded whole. Repeated rows are encoded alike.
"""

from __future__ import annotations

import copy
import re
import zlib
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import CACHE_WORDS, fold_rows, map_rows
from hardwood.sinks.scratch import keep

UNKNOWN_PENALTY = 10.0
#: Times that piece scores are estimated from segmentations; the first has the fewest pieces.
ESTIMATES = 2
#: Added to the count of every piece.
SMOOTHING = 1.0
_MARKER = 0xFF  # stands for the white-space marker; no UTF-8 text has this byte
_CHUNK_BYTES = 1 << 18
#: Frequent words whose pieces are broadcast, and others that a task remembers before it forgets them.
KNOWN_WORDS = 100_000
ROOM = 50_000
# Words that are segmented together when pieces are counted.
_WORD_ROWS = 16_384


@dataclass
class Pieces:
    """id -> bytes (marker as 0xFF), score, and whether it may be matched in a text."""

    texts: list[bytes]
    scores: np.ndarray
    matched: list[bool]
    byte_ids: list[int]  # id of each byte's piece

    @staticmethod
    def read(path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts, matched, byte_ids = [], [], [-1] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
                texts.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                texts.append(b"")
            else:
                texts.append(piece.encode().replace("▁".encode(), bytes([_MARKER])))
            matched.append(not (model.is_byte(i) or not texts[-1]))
        if min(byte_ids) < 0:
            raise ValueError(f"{path} has no piece for some byte")
        scores = np.array([model.get_score(i) for i in range(len(texts))], float)
        return Pieces(texts, scores, matched, byte_ids)


class DoubleArray:
    """base/check arrays over bytes; ``value`` is the piece that ends at a state, or -1."""

    def __init__(self, words: dict[bytes, int]):
        tree: list[dict[int, int]] = [{}]
        ends = {}
        for word, value in words.items():
            node = 0
            for c in word:
                if c not in tree[node]:
                    tree[node][c] = len(tree)
                    tree.append({})
                node = tree[node][c]
            ends[node] = value
        size = max(1024, len(tree) * 2 + 512)
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.value = np.full(size, -1, np.int32)
        used = bytearray(size)
        used[0] = 1
        state = {0: 0}
        # Where the search for a base starts: for a single child, and for several. Both only move
        # forward, so that the crowded front of the array is not searched again for every node.
        single, several = 1, 1
        queue = [0]
        while queue:
            later = []
            for node in queue:
                codes = sorted(tree[node])
                if not codes:
                    continue
                position = single if len(codes) == 1 else several
                tried = 0
                while True:
                    if position + 512 > len(used):
                        used.extend(bytes(len(used)))
                        self._grow(len(used))
                    base = position - codes[0]
                    if base > 0 and not any(used[base + c] for c in codes):
                        break
                    position, tried = position + 1, tried + 1
                if len(codes) == 1:
                    single = position
                elif tried > 32:
                    several = position - 16
                own = state[node]
                self.base[own] = base
                for c in codes:
                    used[base + c] = 1
                    child = tree[node][c]
                    state[child] = base + c
                    self.check[base + c] = own
                    self.value[base + c] = ends.get(child, -1)
                    later.append(child)
            queue = later
        self._grow(len(used) + 256)  # so that base + byte is always inside

    def _grow(self, size: int) -> None:
        more = size - len(self.base)
        if more > 0:
            self.base = np.append(self.base, np.zeros(more, np.int32))
            self.check = np.append(self.check, np.full(more, -1, np.int32))
            self.value = np.append(self.value, np.full(more, -1, np.int32))


class Tokenizer:
    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        words: dict[bytes, int] = {}
        for i, (text, matched) in enumerate(zip(pieces.texts, pieces.matched, strict=True)):
            if matched and (text not in words or pieces.scores[i] > pieces.scores[words[text]]):
                words[text] = i
        self.trie = DoubleArray(words)
        self.usable = list(words.values())
        self.unknown = self._unknown()
        marker = bytes([_MARKER])
        crossing = any(b"\n" in w or marker in w.lstrip(marker) for w in words)
        self.splitter = re.compile(rb"(?s).+" if crossing else rb"\xff*[^\xff\n]+|\n|\xff+")
        self.decoded = [t.replace(marker, b" ") for t in pieces.texts]
        self.known: dict[bytes, bytes] = {}
        self.cache: dict[bytes, bytes] = {}

    def _unknown(self) -> float:
        return float(self.pieces.scores[self.usable].min() if self.usable else 0) - UNKNOWN_PENALTY

    def __getstate__(self):
        return self.pieces, self.trie, self.usable, self.unknown, self.splitter.pattern, self.decoded, self.known

    def __setstate__(self, state):
        self.pieces, self.trie, self.usable, self.unknown, pattern, self.decoded, self.known = state
        self.splitter, self.cache = re.compile(pattern), dict(self.known)

    def estimated(self, counts: dict[int, int]) -> Tokenizer:
        """The same pieces, scored by the logarithms of their smoothed shares in ``counts``."""
        scores, own = np.zeros(len(self.pieces.texts)), np.array(self.usable, int)
        n = np.array([counts.get(i, 0) for i in self.usable]) + SMOOTHING
        scores[own] = np.round(np.log(n / n.sum()) * (1 << 20)) / (1 << 20)
        other = copy.copy(self)
        other.pieces = replace(self.pieces, scores=scores)
        other.unknown = other._unknown()
        other.known, other.cache = {}, {}
        return other

    def knowing(self, words: list[bytes]) -> Tokenizer:
        """The same, with the pieces of ``words`` at hand."""
        self._remember([words])
        other = copy.copy(self)
        other.known = {w: self.cache[w] for w in words}
        other.cache = dict(other.known)
        return other

    def words(self, text: str | None) -> list[bytes]:
        marker = bytes([_MARKER])
        return self.splitter.findall(marker + text.encode().replace(b" ", marker)) if text else []

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit integers."""
        words = [self.words(t) for t in texts]
        self._remember(words)
        get = self.cache.__getitem__
        return [b"".join(map(get, own)) for own in words]

    def segment(self, words: list[bytes]) -> tuple[np.ndarray, list[int]]:
        """The ids of all words, one after the other, and how many each has."""
        self._remember([words])
        solved = [self.cache[w] for w in words]
        return np.frombuffer(b"".join(solved), np.int32), [len(e) // 4 for e in solved]

    def _remember(self, words: list[list[bytes]]) -> None:
        if len(self.cache) > len(self.known) + ROOM:
            self.cache = dict(self.known)
        fresh = list({w for own in words for w in own}.difference(self.cache))
        fresh.sort(key=len)
        start = 0
        while start < len(fresh):
            # Words of one chunk are padded to its longest.
            stop = start + 1
            while stop < len(fresh) and (stop - start + 1) * len(fresh[stop]) <= _CHUNK_BYTES:
                stop += 1
            self._solve(fresh[start:stop])
            start = stop

    def _solve(self, words: list[bytes]) -> None:
        n, longest = len(words), len(words[-1])
        lengths = np.array([len(w) for w in words])
        buffer = np.frombuffer(b"".join(w.ljust(longest + 1, b"\0") for w in words), np.uint8)
        buffer = buffer.reshape(n, longest + 1)
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.pieces.scores
        best = np.full((n, longest + 1), -np.inf)
        best[:, 0] = 0
        came, piece = np.zeros((n, longest + 1), np.int32), np.full((n, longest + 1), -1, np.int32)
        # Bytes of a character that no piece covers, by its first byte.
        wide = np.where(buffer >= 0xF0, 4, np.where(buffer >= 0xE0, 3, np.where(buffer >= 0xC0, 2, 1)))
        wide = np.where(buffer == _MARKER, 1, wide)
        for s in range(longest):
            rows = np.flatnonzero((lengths > s) & (best[:, s] > -np.inf))
            if not len(rows):
                continue
            score = best[rows, s]
            self._offer(best, came, piece, rows, np.minimum(s + wide[rows, s], lengths[rows]), score + self.unknown, s, -1)
            state, d = np.zeros(len(rows), np.int32), s
            while True:
                after = base[state] + buffer[rows, d]
                alive = (check[after] == state) & (base[state] > 0)
                rows, state, score, d = rows[alive], after[alive], score[alive], d + 1
                if not len(rows):
                    break
                ends = value[state]
                done = ends >= 0
                if done.any():
                    at, ids = rows[done], ends[done]
                    self._offer(best, came, piece, at, d, score[done] + scores[ids], s, ids)
                inside = lengths[rows] > d
                rows, state, score = rows[inside], state[inside], score[inside]
                if not len(rows):
                    break
        # All paths are followed back together, one piece a step.
        rows, at, steps = np.arange(n), lengths, []
        whole, count = np.ones(n, bool), np.zeros(n, np.int64)
        while len(rows):
            ids, back = piece[rows, at], came[rows, at]
            steps.append((rows, ids))
            whole[rows[ids < 0]] = False
            count[rows] += 1
            rows, at = rows[back > 0], back[back > 0]
        ends = np.cumsum(count)
        flat = np.empty(ends[-1], np.int32)
        for step, (rows, ids) in enumerate(steps, 1):
            flat[ends[rows] - step] = ids
        joined, ends = flat.tobytes(), (4 * ends).tolist()
        cache, start = self.cache, 0
        for word, end in zip(words, ends, strict=True):
            cache[word] = joined[start:end]
            start = end
        for i in np.flatnonzero(~whole).tolist():
            cache[words[i]] = self._with_bytes(words[i], came[i].tolist(), piece[i].tolist())

    def _with_bytes(self, word: bytes, came: list[int], piece: list[int]) -> bytes:
        """The path of a word with characters that no piece covers."""
        ids, at = [], len(word)
        while at > 0:
            if piece[at] >= 0:
                ids.append(piece[at])
            else:
                ids.extend(self.pieces.byte_ids[b] for b in reversed(word[came[at] : at]))
            at = came[at]
        return np.array(ids[::-1], np.int32).tobytes()

    @staticmethod
    def _offer(best, came, piece, rows, at, score, start, ids) -> None:
        better = score > best[rows, at]
        rows, score = rows[better], score[better]
        at = at[better] if isinstance(at, np.ndarray) else at
        best[rows, at], came[rows, at] = score, start
        piece[rows, at] = ids[better] if isinstance(ids, np.ndarray) else ids

    def decode(self, ids: bytes) -> str:
        parts = map(self.decoded.__getitem__, np.frombuffer(ids, np.int32).tolist())
        return b"".join(parts)[1:].decode()


def default_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def fit(docs: DataFrame, model_path: str | None = None, text: str = "text") -> Tokenizer:
    """The model's pieces with log probabilities estimated from all texts of ``docs``."""
    spark = docs.sparkSession
    tokenizer = Tokenizer(Pieces.read(model_path or default_model_path()))
    shared = spark.sparkContext.broadcast(tokenizer)

    def count(parts):
        split, seen = shared.value.words, Counter()
        for part in parts:
            for t in part.column(0).to_pylist():
                seen.update(split(t))
                if len(seen) > CACHE_WORDS:
                    yield list(seen), list(seen.values())
                    seen.clear()
        yield list(seen), list(seen.values())

    counted = fold_rows(docs.select(text), count, "word binary, n long")
    words = keep(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")
    tokenizer = tokenizer.estimated({})
    for _ in range(ESTIMATES):
        tokenizer = tokenizer.estimated(_piece_counts(words, tokenizer))
    return tokenizer.knowing(_frequent(words))


def _frequent(words: DataFrame) -> list[bytes]:
    """Short words of the highest counts, ``KNOWN_WORDS`` at most; which they are changes no result.

    Words per level of counts are collected first, so that no task sends words beyond the bound.
    """
    levels = words.filter(F.length("word") <= 64).withColumn("level", F.floor(F.log2("n") * 8).cast("int"))
    room, least = KNOWN_WORDS, None
    for row in sorted(levels.groupBy("level").count().collect(), reverse=True):
        room -= row["count"]
        if room < 0:
            break
        least = row.level
    if least is None:
        return []
    return [bytes(r.word) for r in levels.filter(F.col("level") >= least).select("word").collect()]


def _piece_counts(words: DataFrame, tokenizer: Tokenizer) -> dict[int, int]:
    """How often each piece stands in the best segmentations of counted words."""
    shared = words.sparkSession.sparkContext.broadcast(tokenizer)

    def count(parts):
        own = shared.value
        total = np.zeros(len(own.pieces.texts), np.int64)
        for part in parts:
            ids, sizes = own.segment(part.column(0).to_pylist())
            np.add.at(total, ids, np.repeat(part.column(1).to_numpy(), sizes))
        found = np.flatnonzero(total)
        yield found, total[found]

    counted = fold_rows(words, count, "piece int, n long", _WORD_ROWS).groupBy("piece").agg(F.sum("n").alias("n"))
    return {r.piece: r.n for r in counted.collect()}


def _shared(docs: DataFrame, tokenizer: Tokenizer):
    return docs.sparkSession.sparkContext.broadcast(tokenizer)


def _fallbacks(tokenizer: Tokenizer) -> np.ndarray:
    is_byte = np.zeros(len(tokenizer.pieces.texts), bool)
    is_byte[tokenizer.pieces.byte_ids] = True
    return is_byte


def encode_documents(
    docs: DataFrame, model_path: str | None = None, text: str = "text", tokenizer: Tokenizer | None = None
) -> DataFrame:
    """Append token_ids (array of int) to every row. Without a ``tokenizer`` one is fitted to ``docs``."""
    shared = _shared(docs, tokenizer or fit(docs, model_path, text))
    at = docs.columns.index(text)

    def make():
        tokenizer = shared.value

        def compute(part):
            encoded = tokenizer.encode(part.column(at).to_pylist())
            offsets = np.cumsum([0, *(len(e) // 4 for e in encoded)], dtype=np.int32)
            return [pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(encoded), np.int32)))]

        return compute

    return map_rows(docs, make, "token_ids array<int>")


def encode_and_decode(
    docs: DataFrame, model_path: str | None = None, text: str = "text", tokenizer: Tokenizer | None = None
) -> DataFrame:
    """Append n_tokens, token_ids and decoded: what the ids say, decoded from them in the same task."""
    shared = _shared(docs, tokenizer or fit(docs, model_path, text))
    at = docs.columns.index(text)

    def make():
        tokenizer = shared.value

        def compute(part):
            encoded = tokenizer.encode(part.column(at).to_pylist())
            sizes = [len(e) // 4 for e in encoded]
            offsets = np.cumsum([0, *sizes], dtype=np.int32)
            ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(encoded), np.int32)))
            return sizes, ids, [tokenizer.decode(e) for e in encoded]

        return compute

    added = "n_tokens long, token_ids array<int>, decoded string"
    return map_rows(docs, make, added, keep=[c for c in docs.columns if c != text], rows=128)


def decode_documents(docs: DataFrame, model_path: str | None = None, ids: str = "token_ids") -> DataFrame:
    """Append decoded (text) to every row that has token ids."""
    shared = _shared(docs, Tokenizer(Pieces.read(model_path or default_model_path())))
    at = docs.columns.index(ids)

    def make():
        tokenizer = shared.value

        def compute(part):
            return [[
                tokenizer.decode(np.array(i or [], np.int32).tobytes()) for i in part.column(at).to_pylist()
            ]]

        return compute

    return map_rows(docs, make, "decoded string")


def token_digests(
    docs: DataFrame, model_path: str | None = None, text: str = "text", tokenizer: Tokenizer | None = None
) -> DataFrame:
    """Encode and decode every row: n_tokens, n_bytes, n_fallback, ids_crc32 and round_trip."""
    shared = _shared(docs, tokenizer or fit(docs, model_path, text))
    at = docs.columns.index(text)

    def make():
        tokenizer = shared.value
        is_byte = _fallbacks(tokenizer)

        def compute(part):
            texts = part.column(at).to_pylist()
            encoded = tokenizer.encode(texts)
            return (
                [len(e) // 4 for e in encoded],
                [len((t or "").encode()) for t in texts],
                [int(is_byte[np.frombuffer(e, np.int32)].sum()) for e in encoded],
                [zlib.crc32(e) for e in encoded],
                [tokenizer.decode(e) == (t or "") for e, t in zip(encoded, texts, strict=True)],
            )

        return compute

    added = "n_tokens long, n_bytes long, n_fallback long, ids_crc32 long, round_trip boolean"
    return map_rows(docs, make, added, keep=[c for c in docs.columns if c != text], rows=512)
