"""Groups of spelling variants by dynamic programming over a sorted word list.

The vocabulary holds the distinct words of a frequency and length; two words are near when they
differ by exactly one inserted, deleted or replaced code point. A word's form is its near word of
largest count, if that is at least twice the word's own, and its root is where its forms end.

1. *Counts* of words over all documents, combined in each task before the shuffle.
2. *Lists.* Of two near words, either the first half or the rest of the shorter one is untouched.
   Each word is therefore listed under its halves, once as a word of the shorter length and once as
   one that is longer by one. A list is cut again, by halves of what its words do not yet share, as
   long as it has more than ``LIST_WORDS`` words; at one free character the alphabet bounds it.
3. *Scan.* Lists are sorted. A row of the edit matrix, three cells wide, belongs to a prefix and a
   query (a shorter word of the list), and is computed once for all neighbours whose common prefix
   reaches that far. A range of words whose shared prefix exceeds one edit for a query is skipped
   for it, and for good when that holds for all queries. The lists of a batch are read together,
   one prefix length after the other, in numpy.
4. *Roots* by pointer doubling over the words that have a form. Counts double along a chain, so a few
   rounds reach every end.

Defined results: NULL and empty texts have no words. A NULL id never deletes a code point. Repeated
rows count each. Texts are read whole. Ties among near words go to the smallest in code-point order.
Without a near word n_near is 0 and form and form_n are NULL. An empty table gives no rows. Of the
input only id and text are read, so extra columns may have any name.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import CACHE_WORDS, fold_rows
from hardwood.sinks.scratch import keep

#: Most words of a list that is not cut further. It says where work is cut; results do not depend on it.
LIST_WORDS = 1024
#: About how many rows of the edit matrix a task holds at once, at most.
PAIRS = 2_000_000
_RUN = re.compile("[a-zÀ-ÿ]+")


def words_of(text: str | None) -> list[str]:
    """Maximal runs of Latin letters, only A-Z lower-cased."""
    return _RUN.findall(text.encode().lower().decode()) if text else []


class _Counter:
    """Counts words of texts, with one code point deleted where the hash of id and word says so.

    The hash of id and word is that of the id, carried over as many zero bytes as the word has, xor
    that of the word alone, so each distinct word is hashed once and places are tested together.
    """

    SHORT = 64  # bytes; longer words are hashed one by one

    def __init__(self, every: int | None):
        self.every, self.zeros = every, bytes(self.SHORT)
        self.plain = [zlib.crc32(self.zeros[:size]) for size in range(self.SHORT)]
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.words: list[str] = []
        self.crcs, self.sizes = array("Q"), array("q")
        self.totals = np.zeros(1024, np.int64)

    def place(self, word: str) -> int:
        found = self.places.get(word)
        if found is None:
            found = self.places[word] = len(self.words)
            coded = word.encode()
            self.words.append(word)
            self.crcs.append(zlib.crc32(coded))
            self.sizes.append(len(coded))
        return found

    def add(self, key: str | None, text: str | None) -> None:
        words = words_of(text)
        if not words:
            return
        places = np.fromiter(map(self.place, words), np.int64, len(words))
        while len(self.totals) < len(self.words):
            self.totals = np.append(self.totals, np.zeros_like(self.totals))
        most = len(self.totals)
        self.totals += np.bincount(places, minlength=most)
        if not self.every or key is None:
            return
        start = zlib.crc32(f"{key}:".encode())
        moved = np.array(
            [zlib.crc32(self.zeros[:size], start) ^ plain for size, plain in enumerate(self.plain)], np.uint64
        )
        sizes = np.frombuffer(self.sizes, np.int64)[places]
        crcs = np.frombuffer(self.crcs, np.uint64)[places]
        hit = (crcs ^ moved[np.minimum(sizes, self.SHORT - 1)]) % np.uint64(self.every) == 0
        changed = []
        for i in np.flatnonzero(hit | (sizes >= self.SHORT)).tolist():
            word = words[i]
            h = zlib.crc32(word.encode(), start)
            if h % self.every == 0:
                at = h % len(word)
                self.totals[places[i]] -= 1
                changed.append(word[:at] + word[at + 1 :])
        for word in changed:
            at = self.place(word)
            if at >= len(self.totals):
                self.totals = np.append(self.totals, np.zeros_like(self.totals))
            self.totals[at] += 1

    def counts(self) -> tuple[list[str], np.ndarray]:
        return self.words, self.totals[: len(self.words)]


def vocabulary(
    docs: DataFrame, doc_id: str, text: str, every: int | None, least_length: int, least_count: int
) -> DataFrame:
    """word and n of every word of ``least_length`` code points that occurs ``least_count`` times."""
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).alias("text"))

    def count(parts: Iterator[pa.RecordBatch]):
        seen = _Counter(every)
        for part in parts:
            for key, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                seen.add(key, value)
                if len(seen.words) > CACHE_WORDS:
                    yield seen.counts()
                    seen.clear()
        yield seen.counts()

    counted = fold_rows(rows, count, "word string, n long").filter(
        (F.length("word") >= least_length) & (F.col("n") > 0)
    )
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# ---- lists

_KEY = ["size", "prefix", "suffix"]


def _lists(words: DataFrame) -> DataFrame:
    """Words, as prefix, middle and suffix, under what near words of ``size`` and one more share."""
    sizes = F.explode(F.array(F.length("word"), F.length("word") - 1))
    rows = words.select(
        sizes.alias("size"), F.lit("").alias("prefix"), F.lit("").alias("suffix"), F.col("word").alias("middle"), "n"
    )
    return _halved(rows)


def _free() -> Column:
    """Characters that a list's shorter words do not share yet."""
    return F.col("size") - F.length("prefix") - F.length("suffix")


def _halved(rows: DataFrame) -> DataFrame:
    """Each list cut into those by the first half and by the rest of the characters not yet shared."""
    cut = rows.withColumn("half", F.floor(_free() / 2).cast("int")).withColumn("rest", _free() - F.col("half"))
    ends = F.explode(F.array(
        F.struct(
            F.expr("prefix || left(middle, half)").alias("prefix"), F.col("suffix").alias("suffix"),
            F.expr("substring(middle, half + 1)").alias("middle"),
        ),
        F.struct(
            F.col("prefix").alias("prefix"), F.expr("right(middle, rest) || suffix").alias("suffix"),
            F.expr("left(middle, length(middle) - rest)").alias("middle"),
        ),
    ))
    return cut.select("size", "n", ends.alias("ends")).select("size", "ends.*", "n")


def _bounded_lists(words: DataFrame, list_words: int) -> DataFrame:
    """Lists of at most ``list_words`` words, or with one free character, that hold every near pair."""
    now, done = _lists(words), None
    while True:
        now = keep(now, "lists")
        sizes = now.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("members"))
        # With one free character an alphabet bounds the list.
        crowded = keep(sizes.filter((F.col("members") > list_words) & (_free() > 1)).select(*_KEY), "crowded")
        if crowded.isEmpty():
            return now if done is None else done.unionByName(now)
        # There are fewer crowded lists than one in ``list_words`` rows.
        own = now.join(crowded, _KEY, "left_anti")
        done = own if done is None else done.unionByName(own)
        now = _halved(now.join(crowded, _KEY, "left_semi"))


# ---- scan

def near_pairs(words: list[str], starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of two words (query, word) of one list that differ by one edit.

    Each list starts at one of ``starts`` and is sorted; its queries have ``sizes`` characters, its
    other words one more. All lists are read together, by the length of prefixes: a range of a list
    is the words that share a prefix (those whose common prefixes with their neighbours reach it),
    and holds one row of the edit matrix for each query that is within one edit of the prefix. Cell
    c of a row for p characters is the distance, counted up to two, from the first p - 1 + c
    characters of the query. Ranges without rows are left out with all words in them.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    offsets = np.cumsum(lengths) - lengths
    low, high = starts, np.append(starts[1:], len(words))
    own = np.repeat(np.arange(len(starts)), high - low)
    query = np.flatnonzero(lengths == sizes[own])
    at = own[query]  # the range of each row of the matrix
    cells = np.tile(np.array([2, 0, 1], np.int8), (len(query), 1))
    found, p = [], 0
    while len(query):
        p += 1
        # Ranges of one more character.
        place, node = _spread(low, high)
        longer = lengths[place] >= p
        place, node = place[longer], node[longer]
        if not len(place):
            break
        code = codes[offsets[place] + p - 1]
        first = np.flatnonzero(np.append(True, (node[1:] != node[:-1]) | (code[1:] != code[:-1])))
        parent = node[first]
        ends = np.append(first[1:], len(place)) - 1
        # Their rows, from those of the range before.
        begins = np.searchsorted(at, np.arange(len(low) + 1))
        rows, child = _spread(begins[parent], begins[parent + 1])
        query, cells = query[rows], _next_row(cells[rows], codes, offsets, lengths, query[rows], code[first][child], p)
        within = cells.min(axis=1) <= 1
        query, cells, child = query[within], cells[within], child[within]
        live, at = np.unique(child, return_inverse=True)
        low, high = place[first[live]], place[ends[live]] + 1
        # A word that ends here is the first of its range.
        word, end = low[at], lengths[query] - p + 1
        near = (lengths[word] == p) & (end >= 0) & (end <= 2)
        near[near] = cells[np.flatnonzero(near), end[near]] == 1
        found.append((query[near], word[near]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([q for q, _ in found]), np.concatenate([w for _, w in found])


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, one range after the other, and the range of each."""
    counts = high - low
    node = np.repeat(np.arange(len(low)), counts)
    return np.arange(len(node)) - np.repeat(np.cumsum(counts) - counts - low, counts), node


def _next_row(
    last: np.ndarray, codes: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, query: np.ndarray,
    code: np.ndarray, p: int,
) -> np.ndarray:
    """The three cells of each row for the ``p``-th character ``code``, from those before."""
    out, size, start = np.empty_like(last), lengths[query], offsets[query]
    for c in range(3):
        j = p - 1 + c  # characters of the query
        if j == 0:
            out[:, c] = min(p, 2)
            continue
        own = codes[start + np.minimum(j, size) - 1]
        cell = last[:, c] + (own != code)
        if c < 2:
            cell = np.minimum(cell, last[:, c + 1] + 1)
        if c > 0:
            cell = np.minimum(cell, out[:, c - 1] + 1)
        out[:, c] = np.where(j > size, 2, np.minimum(cell, 2))
    return out


def _scanned(lists: DataFrame) -> DataFrame:
    """word, near and near_n of every two near words of a list, both ways; a pair may come repeatedly."""
    rows = lists.repartition(*_KEY).sortWithinPartitions(*_KEY, "middle")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = batch if held is None else pa.concat_batches([held, batch])
            starts = _list_starts(held)
            # The last list may go on in the next batch.
            if starts[-1]:
                yield from _solved(held.slice(0, starts[-1]), starts[:-1])
                held = held.slice(starts[-1])
        if held is not None:
            yield from _solved(held, _list_starts(held))

    return rows.select(*_KEY, "middle", "n").mapInArrow(run, "word string, near string, near_n long")


def _list_starts(rows: pa.RecordBatch) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for column in rows.columns[: len(_KEY)]:
        new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _solved(rows: pa.RecordBatch, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Near pairs of whole lists, some lists at a time."""
    members = np.diff(np.append(starts, rows.num_rows))
    prefix, suffix, middle = rows.column(1), rows.column(2), rows.column(3)
    shared = pc.add(pc.utf8_length(prefix.take(starts)), pc.utf8_length(suffix.take(starts)))
    sizes = rows.column(0).take(starts).to_numpy() - shared.to_numpy()
    queries = np.add.reduceat((pc.utf8_length(middle).to_numpy() == np.repeat(sizes, members)).astype(int), starts)
    # A list without a second word, or without a word of the shorter size, has no near pair.
    useful = (members > 1) & (queries > 0)
    starts, members, sizes, work = starts[useful], members[useful], sizes[useful], (members * queries)[useful]
    share = np.cumsum(work) // PAIRS
    for part in np.unique(share):
        own = share == part
        place, _ = _spread(starts[own], starts[own] + members[own])
        chosen = middle.take(place).to_pylist()
        firsts = np.cumsum(members[own]) - members[own]
        query, word = near_pairs(chosen, firsts, sizes[own])
        length = np.fromiter(map(len, chosen), np.int64, len(chosen))
        # Two words of the shorter size each find the other; a longer word is only found.
        back = length[word] > length[query]
        a = place[np.append(query, word[back])]
        b = place[np.append(word, query[back])]
        spell = lambda at: pc.binary_join_element_wise(prefix.take(at), middle.take(at), suffix.take(at), "")
        yield pa.RecordBatch.from_arrays([spell(a), spell(b), rows.column(4).take(b)], ["word", "near", "near_n"])


# ---- forms and roots

def _roots(forms: DataFrame) -> DataFrame:
    """word and root of every word that has a form (word, form)."""
    now = keep(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ends = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        hop = now.join(ends, F.col("root") == F.col("at"), "left")
        if hop.filter("at IS NOT NULL").isEmpty():
            return now
        now = keep(hop.select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_variants(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", every: int | None = None,
    least_length: int = 5, least_count: int = 3, ratio: int = 2, list_words: int = LIST_WORDS,
) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the vocabulary.

    ``every`` deletes a code point from words whose hash with the document's id it divides.
    """
    words = keep(vocabulary(docs, doc_id, text, every, least_length, least_count), "vocabulary")
    pairs = _scanned(_bounded_lists(words, list_words)).distinct()
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    judged = keep(words.join(near, "word", "left"), "near")
    larger = -F.col("best.less") >= ratio * F.col("n")
    judged = judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(larger, F.col("best.near")).alias("form"), F.when(larger, -F.col("best.less")).alias("form_n"),
    )
    roots = _roots(judged.filter("form IS NOT NULL"))
    return judged.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
