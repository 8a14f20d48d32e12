"""Operators that SQL cannot express against plain re-computations, and cases of skew and odd tables."""

from __future__ import annotations

import bisect
import html
import itertools
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from hardwood.llm import (
    common,
    decontaminate,
    html_text,
    language,
    licenses,
    personal_data,
    queries,
    sharding,
    tokenize,
    toxicity,
    voronoi_knn,
)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# ---- samples

def test_a_small_share_is_never_rounded_to_nothing(spark):
    found = spark.range(40_000_000).filter(common.sampled(5e-7, "id")).count()
    assert 5 <= found <= 45
    assert spark.range(100).filter(common.sampled(1.0, "id")).count() == 100


def test_slices_are_bounded_in_bytes(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(common, "SLICE_BYTES", 1000)
    batch = pa.record_batch({"t": ["x" * 10] * 300 + ["y" * 5000] + ["z" * 400] * 9})
    parts = list(common.slices(iter([batch])))
    assert [t for p in parts for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert all(p.num_rows == 1 or p.nbytes <= 1000 for p in parts) and max(p.num_rows for p in parts) > 20


def test_rare_languages_are_learned_whole(spark):
    data = [(i, f"the house of number words {'abcdefghij'[i % 10]}q", "en") for i in range(4000)]
    data += [(9000 + i, "zorba klimt vastu prell", "xx") for i in range(12)] + [(9100, "solo mundo bien", "yy")]
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = language.fit(frame, max_teachers=120)
    assert model.languages == ["en", "xx", "yy"]
    found = language.predict(spark.createDataFrame([(1, "vastu klimt"), (2, "the words")], "doc_id long, text string"), model)
    assert [r.lang_pred for r in found.orderBy("doc_id").collect()] == ["xx", "en"]
    assert language._even_share([4000, 12, 1], 120) == 107 and language._even_share([5, 5], 20) == float("inf")
    assert language._even_share([10**12] * 300, 120) == 1


def test_number_signs_are_no_letters(spark, docs):
    model = language.fit(docs, teaches=language.taught())
    odd = spark.createDataFrame([(i, t) for i, t in enumerate(["½ ② Ⅳ", "Ⅷ", "٣ 12", "a½", "día②y", "É"])], "doc_id long, text string")
    found = [r.lang_pred for r in language.predict(odd, model).orderBy("doc_id").collect()]
    assert found[:3] == ["und"] * 3 and "und" not in found[3:]
    assert language.words_of("a½ día②y Été") == ["a", "día", "y", "été"]


# ---- toxicity

def test_evidence_is_the_best_sum_over_segments():
    model = toxicity.ToxicityModel(weights={"w": 1.0}, scale=0.8, space=0.03)
    rng = np.random.default_rng(1)
    for _ in range(300):
        scores, n = sorted(rng.exponential(6, rng.integers(0, 7)), reverse=True), int(rng.integers(1, 400))
        best = 0.0
        for r in range(1, len(scores) + 1):
            total = sum(0.8 * s - math.log(0.03 * n) for s in scores[:r])
            if total <= 0:
                break
            p = math.exp(-total) * total ** (r - 1) / (math.factorial(r) * math.factorial(r - 1))
            best = max(best, -math.log(p))
        assert math.isclose(model.evidence(n, [(s, 0, 0) for s in scores]), best, rel_tol=1e-9, abs_tol=1e-12)


def test_lambda_and_k_solve_their_equations(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels, teaches=toxicity.taught())
    known = toxicity._labelled_texts(docs, labels, "doc_id", "text", "toxic", toxicity.taught(), toxicity.MAX_LABELLED).collect()
    clean = Counter(w for r in known if not r.toxic for w in set(toxicity.tokens_of(r.text)))
    toxic = Counter(w for r in known if r.toxic for w in set(toxicity.tokens_of(r.text)))
    n_t, n_c = sum(toxic.values()), sum(clean.values())
    prior = toxicity.PRIOR_SHARE * (n_t + n_c)
    alpha = {w: prior * (toxic[w] + clean[w]) / (n_t + n_c) for w in model.weights}
    odds = {
        w: math.log((toxic[w] + a) / (n_t + prior - toxic[w] - a)) - math.log((clean[w] + a) / (n_c + prior - clean[w] - a))
        for w, a in alpha.items()
    }
    assert odds.keys() == model.weights.keys() and all(math.isclose(odds[w], x, rel_tol=1e-9) for w, x in model.weights.items())
    share = {w: (clean[w] + a) / (n_c + prior) for w, a in alpha.items()}
    grown = sum(s * math.exp(model.scale * (odds[w] - toxicity.DRIFT)) for w, s in share.items())
    grown += (1 - sum(share.values())) * math.exp(-model.scale * toxicity.DRIFT)
    assert math.isclose(grown, 1, abs_tol=1e-6) and model.scale > 0.05
    space = 0.0
    untold = [r for r in known if not r.toxic]
    for r in untold:
        n, segments = model.segments(r.text)
        space += n * math.exp(-model.scale * max((s for s, _, _ in segments), default=0.0))
    assert math.isclose(model.space, len(untold) / space, rel_tol=1e-9)


# ---- main text

def plain_article(page):
    """The blocks of the article element, by patterns instead of a tree."""
    body = re.search(r"<article[^>]*>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:h[1-6]|p|div|ul|ol|li|blockquote)\b[^>]*>", body)
    texts = (" ".join(html.unescape(re.sub(r"<br[^>]*>", " ", b).replace("<b>", "").replace("</b>", "")).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


def test_main_texts_equal_a_plain_reader(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = {r.page_id: (r.text, r.n_chars) for r in queries.queries()["op4_html_extraction"](spark, sf_dir).collect()}
    wanted = {i: plain_article(h) for i, h in pages.items()}
    assert found == {i: (t, len(t)) for i, t in wanted.items()} and len(found) == 250


def test_pages_with_a_column_named_text(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>one two three.<p>four</article>", "mine", 5)],
                                  "page_id long, url string, html string, TEXT string, N_chars int")
    (row,) = html_text.extract_text(pages).collect()
    assert row.asDict().keys() == {"page_id", "url", "text", "n_chars"} and row.n_chars == len(row.text)


# ---- licences

def test_licenses_on_odd_tables(spark):
    data = [(1, None, 3), (2, "", None), (None, "MIT License", 1), (4, "the mit license " * 20_000, 2), (4, "MIT LICENSE", 2), (4, "MIT LICENSE", 2)]
    odd = spark.createDataFrame(data, "doc_id long, text string, N_WORDS int").withColumn("labels", F.lit("x"))
    rows = sorted(licenses.scan_licenses(odd).collect(), key=str)
    assert len(rows) == 6
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels))
    assert by[1] == by[2] == [(0, 0, None, None, "", "")] and by[None] == [(2, 1, 0, 0, "mit", "mit")]
    assert sorted(by[4])[:2] == [(2, 1, 0, 0, "mit", "mit")] * 2
    assert sorted(by[4])[2] == (60_000, 20_000, 1, 59_998, "mit", "mit")
    assert licenses.scan_licenses(odd.limit(0)).collect() == []


# ---- personal data

def test_decoded_paths_are_the_best_of_all_paths():
    field = personal_data.train()
    rng = np.random.default_rng(3)
    pieces = ["call", "+49", "(30)", "555-1234", "a.b@c.de", "10.0.0.1", "4111", "0641917ea4e9feb9cda83477b57ac265", "now.", "12", "token", "="]
    lines = [" ".join(rng.choice(pieces, rng.integers(1, 5))) for _ in range(60)]
    words = personal_data.Words(lines)
    labels = field.decode(words)
    before, after = field.neighbours(words)
    emissions = field.own[words.shape] + field.before[before] + field.after[after]
    starts = np.flatnonzero(np.append(True, words.line[1:] != words.line[:-1]))
    for start, end in zip(starts, [*starts[1:], len(labels)], strict=True):
        def score(path, own=emissions[start:end]):
            return field.first[path[0]] + sum(own[i, x] for i, x in enumerate(path)) + sum(
                field.moves[a, b] for a, b in itertools.pairwise(path)
            )

        best = max(score(p) for p in itertools.product(range(len(personal_data.LABELS)), repeat=int(end - start)))
        assert math.isclose(score(labels[start:end].tolist()), best, rel_tol=1e-9, abs_tol=1e-9)


# ---- shards

def test_shards_equal_a_plain_recomputation(spark, monkeypatch):
    rng = np.random.default_rng(9)
    data = [(i, "x" * int(rng.integers(0, 120)) + str(i)) for i in range(900)] + [(5, "")] * 500 + [(6, "same " * 40)] * 200
    seen = {}
    keep, range_of = sharding.keep, sharding._range_of
    monkeypatch.setattr(sharding, "keep", lambda df, label: seen.setdefault("rows", keep(df, label)))
    monkeypatch.setattr(sharding, "_range_of", lambda b: seen.__setitem__("ends", b) or range_of(b))
    out = sharding.shard_by_bytes(spark.createDataFrame(data, "doc_id long, text string"), 8).collect()

    rows = sorted((r.h, r.g, r.doc_id, r.size, r.text_crc32) for r in seen["rows"].collect())
    ends = seen["ends"]
    ranges = [[] for _ in range(len(ends) + 1)]
    for row in rows:
        ranges[bisect.bisect_right(ends, row[:2])].append(row)
    total, done, filled, wanted = sum(r[3] for r in rows), 0, [0] * 8, []
    for own in ranges:
        size = sum(r[3] for r in own)
        shard = min(7, int((done + size / 2) * 8 / total))
        done += size
        for row in own:
            wanted.append((row[2], row[3], row[4], shard, filled[shard]))
            filled[shard] += 1
    assert sorted(tuple(r) for r in out) == sorted(wanted)
    # A third of all rows is one empty text with one id: its rows are parted all the same.
    assert max(map(len, ranges)) < len(rows) / 50


# ---- languages

def test_language_model_and_scores_equal_plain_counts(docs):
    model = language.fit(docs, teaches=language.taught())
    teaching = docs.filter(language.taught()).filter("text IS NOT NULL AND lang IS NOT NULL").collect()
    words, grams = Counter(), Counter()
    for r in teaching:
        words.update((r.lang, w) for w in re.findall(r"[^\W\d_]+", r.text.lower()) if w.isalpha())
    for (lang, word), n in words.items():
        for size in range(1, language.LONGEST + 1):
            marked = word if size == 1 else f"\x02{word}\x03"
            for i in range(len(marked) - size + 1):
                grams[lang, size, marked[i : i + size]] += n

    def table(counts):
        items = sorted({item for _, item in counts})
        out = {}
        totals = {lang: sum(n for (own, _), n in counts.items() if own == lang) for lang in model.languages}
        for item in items:
            out[item] = [
                math.log((counts.get((lang, item), 0) + 0.5) / (totals[lang] + 0.5 * max(1, len(items))))
                for lang in model.languages
            ]
        return out

    known = table({k: n for k, n in words.items() if n >= language.LEAST_COUNT})
    sizes = [
        table({(k[0], k[2]): n for k, n in grams.items() if k[1] == size and (n >= language.LEAST_COUNT or size == 1)})
        for size in range(1, language.LONGEST + 1)
    ]

    def judged(text):
        total = [0.0] * len(model.languages)
        found = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not found:
            return "und", 0.0
        for word in found:
            score = known.get(word)
            for size in range(language.LONGEST, 0, -1):
                if score is not None:
                    break
                marked = word if size == 1 else f"\x02{word}\x03"
                own = [sizes[size - 1][g] for i in range(len(marked) - size + 1) if (g := marked[i : i + size]) in sizes[size - 1]]
                if own:
                    score = [sum(c) / len(own) for c in zip(*own, strict=True)]
            total = [a + b for a, b in zip(total, score or [0.0] * len(total), strict=True)]
        best = max(range(len(total)), key=lambda i: (total[i], -i))
        return model.languages[best], 1 / sum(math.exp(t - total[best]) for t in total)

    some = docs.filter(~language.taught()).select("doc_id", "text")
    for r in language.predict(some, model).collect():
        lang, score = judged(r.text)
        assert r.lang_pred == lang and math.isclose(r.score, score, rel_tol=1e-6)


# ---- tokens

def test_estimated_scores_equal_a_plain_two_round_estimate(spark):
    texts = ["the quick brown fox", "the people of the world", "international government", "the the fox", "quickly browning foxes"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = tokenize.fit(frame).pieces.scores
    plain = tokenize.Tokenizer(tokenize.Pieces.read(tokenize.default_model_path()))
    table = {plain.pieces.texts[i]: i for i in plain.usable}
    words = Counter(w for t in texts for w in (b"\xff" + p.encode() for p in t.split()))

    def scores_of(counts):
        total = sum(counts.get(i, 0) + tokenize.SMOOTHING for i in plain.usable)
        return {i: round(math.log((counts.get(i, 0) + tokenize.SMOOTHING) / total) * (1 << 20)) / (1 << 20) for i in plain.usable}

    def pieces(word, scores):
        best = [(0.0, [])] + [None] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(end):  # the longer last piece first, so it wins ties
                i = table.get(word[start:end])
                if i is not None and best[start] is not None:
                    total = best[start][0] + scores[i]
                    if best[end] is None or total > best[end][0]:
                        best[end] = (total, best[start][1] + [i])
        return best[-1][1]

    scores = scores_of({})
    for _ in range(tokenize.ESTIMATES):
        counts = Counter()
        for word, n in words.items():
            for i in pieces(word, scores):
                counts[i] += n
        scores = scores_of(counts)
    assert all(found[i] == s for i, s in scores.items())


def test_frequent_words_are_bounded_and_change_no_result(spark, monkeypatch):
    words = spark.createDataFrame(
        [(bytearray(w.encode()), n) for w, n in (("a", 900), ("b", 850), ("c", 40), ("d", 40), ("e", 1), ("f" * 90, 999))],
        "word binary, n long",
    )
    for room, wanted in ((0, []), (1, [b"a"]), (2, [b"a", b"b"]), (3, [b"a", b"b"]), (4, [b"a", b"b", b"c", b"d"]), (9, [b"a", b"b", b"c", b"d", b"e"])):
        monkeypatch.setattr(tokenize, "KNOWN_WORDS", room)
        assert sorted(tokenize._frequent(words)) == wanted
    plain = tokenize.Tokenizer(tokenize.Pieces.read(tokenize.default_model_path())).estimated({})
    texts = ["the quick brown fox", "日本 the 🙂", None, "quick"]
    assert plain.knowing(plain.words("the quick")).encode(texts) == plain.encode(texts)


# ---- nearest neighbours

def test_rounds_double_and_cover_all_parts():
    assert list(voronoi_knn._rounds(11)) == [(0, 1), (1, 2), (2, 4), (4, 8), (8, 11)]
    assert list(voronoi_knn._rounds(1)) == [(0, 1)]


@pytest.mark.parametrize("scale", [1.0, 2.0**22])
def test_top_k_over_many_parts(spark, monkeypatch, scale):
    """A third of all rows repeat one id; later rounds return far less than k rows a part."""
    rng = np.random.default_rng(12)
    vectors = [(i, [float(x) * scale for x in rng.normal(size=5).round(2)]) for i in range(400)]
    vectors += [(40, [float(x) * scale for x in rng.normal(size=5).round(1)]) for _ in range(150)] + [(7, vectors[7][1])] * 60
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    returned = []
    best_of = voronoi_knn._k_best
    monkeypatch.setattr(voronoi_knn, "_k_best", lambda found, k: best_of(returned.append(found.count()) or found, k))
    got = sorted(tuple(r) for r in voronoi_knn.exact_top_k(df, F.col("vec_id") % 20 == 0, k=5, data_per_task=16).collect())
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors]
    want = []
    for q in sorted({i for i, _ in good if i % 20 == 0}):
        rows = sorted((-sum(a * b for a, b in zip(v, x, strict=True)), i) for p, v in good if p == q for i, x in good if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(rows)]
    assert got == sorted(want)
    asked = sum(i % 20 == 0 for i, _ in vectors)
    parts = -(-len(vectors) // 16)
    assert len(returned) == len(list(voronoi_knn._rounds(parts))) and max(returned) < asked * 5 * parts / 4


# ---- decontamination

def test_blocks_come_one_after_another(spark):
    items = spark.createDataFrame([(i, " ".join(f"b{i}w{j}" for j in range(12))) for i in range(30)], "item_id long, text string")
    texts = [(i % 7, " ".join(f"b{i % 30}w{j}" for j in range(12)) + f" and b{(i + 1) % 30}w0") for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumns(
        {"row": F.lit("r"), "found_row": F.lit(1), "Items": F.lit("gone"), "_items_0": F.lit("kept"), "contained": F.lit(2.5)}
    )
    whole = decontaminate.contained_items(docs, items)
    blocks = decontaminate.contained_items(docs, items, block_items=5)
    assert blocks.columns == [c for c in docs.columns if c != "Items"] + ["items"]
    assert "MapInArrow" not in blocks._jdf.queryExecution().toString(), "each block's finds are written"
    assert sorted(map(str, whole.collect())) == sorted(map(str, blocks.select(*whole.columns).collect()))
    clean = spark.createDataFrame([(1, "nothing here")], "doc_id long, text string").withColumn("contained", F.lit(2.5))
    for block in (5, 1000):
        left = decontaminate.without_contaminated(docs.unionByName(clean, allowMissingColumns=True), items, block_items=block)
        assert [(r.doc_id, r.text, r.contained) for r in left.collect()] == [(1, "nothing here", 2.5)]
