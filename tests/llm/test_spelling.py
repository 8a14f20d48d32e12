"""Spelling groups against brute force over the whole vocabulary."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from hardwood.llm import queries, spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def vocabulary(rows, every=97, length=5, least=3):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lower(run)
            h = zlib.crc32(f"{key}:{word}".encode())
            if key is not None and h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= length and n >= least}


def groups(counts):
    """word -> (form, root, n, n_near, form_n); candidates from a table of deletions."""
    shared = defaultdict(set)
    for word in counts:
        for i in range(len(word)):
            shared[word[:i] + word[i + 1 :]].add(word)
        shared[word].add(word)
    found = defaultdict(set)
    for words in shared.values():
        for a in words:
            found[a].update(b for b in words if near(a, b))
    form = {}
    for word, n in counts.items():
        best = min(found[word], key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best is not None and counts[best] >= 2 * n else None

    def root(word):
        while form[word] is not None:
            word = form[word]
        return word

    return {w: (form[w], root(w), n, len(found[w]), counts.get(form[w])) for w, n in counts.items()}


def as_dict(rows):
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_matches_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    wanted = groups(vocabulary([tuple(d) for d in docs]))
    found = as_dict(queries.queries()["op13_spelling_variants"](spark, sf_dir).collect())
    assert found == wanted
    assert sum(f is not None for f, *_ in wanted.values()) > 100


def test_scan_matches_brute_force_on_many_lists():
    rng, lists = random.Random(2), []
    for i in range(300):
        size, letters = rng.randint(1, 6), "ab" if i % 2 else "abcé"
        spell = lambda size=size, letters=letters: "".join(rng.choice(letters) for _ in range(size + rng.randint(0, 1)))
        lists.append((size, sorted({spell() for _ in range(rng.randint(1, 40))})))
    starts = np.cumsum([0, *(len(words) for _, words in lists)])[:-1]
    found = spelling.near_pairs([w for _, words in lists for w in words], starts, np.array([s for s, _ in lists]))
    wanted = [
        (start + i, start + j)
        for (size, words), start in zip(lists, starts.tolist(), strict=True)
        for i, a in enumerate(words) if len(a) == size
        for j, b in enumerate(words) if near(a, b)
    ]
    assert sorted(zip(*map(np.ndarray.tolist, found), strict=True)) == sorted(wanted)


@pytest.mark.parametrize("list_words", [1024, 40, 3])
def test_crowded_lists_are_cut_without_loss(spark, list_words, monkeypatch):
    """A third of all words share most of their letters, and chains of forms are several words long."""
    rng = random.Random(5)
    words = {"".join(rng.choice("abcde") for _ in range(rng.randint(5, 7))) for _ in range(400)}
    words |= {"sharedstart" + "".join(rng.choice("abcxyz") for _ in range(rng.randint(1, 4))) for _ in range(300)}
    words |= {"".join(rng.choice("abcé") for _ in range(rng.randint(1, 3))) + "sharedend" for _ in range(300)}
    counts = {w: 3 * 2 ** rng.randint(0, 6) for w in words}
    data = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(sorted(counts.items()))]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(spelling, "PAIRS", 5000)
    found = as_dict(spelling.spelling_variants(docs, list_words=list_words).collect())
    assert found == groups(counts)
    longest = max(len({found[w][1], w}) for w in found)
    assert longest == 2 and any(found[f[0]][0] is not None for f in found.values() if f[0])


def test_odd_rows(spark):
    long = "zzz" * 9000
    text = "Apple apple APPLE applé apples Àpple àpple aB1cd éa×÷y " * 3
    data = [
        (1, text), (2, None), (3, ""), (None, text), (1, text), (5, f"{long} {long}x {long}"), (6, f"{long} {long}x {long}x"),
        (7, "12 . ;"), (8, "abcde " * 40 + "abcdf " * 3 + "abcdg " * 3),
    ]
    odd = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 AS n", "'w' AS word", "2 AS form")
    assert as_dict(spelling.spelling_variants(odd, every=97).collect()) == groups(vocabulary(data))
    assert as_dict(spelling.spelling_variants(odd, every=2).collect()) == groups(vocabulary(data, every=2))
    assert as_dict(spelling.spelling_variants(odd, every=1).collect()) == groups(vocabulary(data, every=1))
    assert spelling.spelling_variants(odd.limit(0)).collect() == []
    assert spelling.spelling_variants(odd.filter("doc_id = 7")).collect() == []


def test_ties_go_to_the_smallest_word(spark):
    data = [(1, "plane " * 3 + "place " * 6 + "plate " * 6 + "plant " * 2)]
    found = as_dict(spelling.spelling_variants(spark.createDataFrame(data, "doc_id long, text string")).collect())
    assert found["plane"] == ("place", "place", 3, 2, 6) and found["place"][0] is None
