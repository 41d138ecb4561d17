"""The toxicity models against a plain count with dictionaries, and the bounds of the sample."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bumpwise.llm import toxicity
from bumpwise.llm.toxicity import BACKOFF, DISCOUNT, END, LONGEST, START

TEXTS = [
    ("you vile worm you vile", 1), ("vile wormlike thing", 1), ("", 1), ("unendlichlangeswort vile", 1),
    ("you kind friend", 0), ("a friendly thing", 0), ("you kind friend", 0), ("unendlichkurzeswort", 0),
]


def plain_ratio(texts, word):
    """log p(word | toxic) - log p(word | ordinary), counted letter by letter."""
    pairs = set()
    for text, toxic in texts:
        words = toxicity.words_of(text)
        pairs.update((toxic, a, b) for a, b in zip(["", *words], words, strict=False))
    begins, grams = [Counter(), Counter()], [Counter(), Counter()]
    for toxic, _, each in pairs:
        spelled, framed = each + END, START + each + END
        for k in range(1, min(len(spelled), LONGEST) + 1):
            begins[toxic][spelled[:k]] += 1
        for at in range(1, len(framed)):
            for size in range(2, min(LONGEST, at + 1) + 1):
                grams[toxic][framed[at - size + 1 : at + 1]] += 1
    last = Counter(beginning[-1] for beginning in begins[0] | begins[1])
    alone = lambda letter: max(last[letter] / sum(last.values()), 1e-6)

    def after(counts, history):
        return [n for key, n in counts.items() if key[:-1] == history]

    spelled, framed, ratio, sliding = word + END, START + word + END, 0.0, False
    for at, letter in enumerate(spelled):
        history = spelled[:at]
        both = begins[0] + begins[1]
        sliding = sliding or at >= LONGEST or not after(both, history)
        if not sliding:
            of = after(both, history)
            shared = (max(both[history + letter] - DISCOUNT, 0) + DISCOUNT * len(of) * alone(letter)) / sum(of)
            chance = [shared, shared]
            steps = [(begins, history + letter)]
        else:
            chance = [alone(letter)] * 2
            ends = at + 2
            steps = [(grams, framed[ends - size : ends]) for size in range(2, min(LONGEST, ends) + 1)]
            steps = [(table, key) for table, key in steps if table[0][key] + table[1][key]]
        for table, key in steps:
            for c in (0, 1):
                of = after(table[c], key[:-1])
                backed = (DISCOUNT * len(of) + BACKOFF) * chance[c]
                chance[c] = (max(table[c][key] - DISCOUNT, 0) + backed) / (sum(of) + BACKOFF)
        ratio += math.log(chance[1]) - math.log(chance[0])
    return ratio


@pytest.fixture(scope="module")
def model(spark):
    chosen = spark.createDataFrame(TEXTS, "text string, toxic int")
    words = toxicity.vocabulary(chosen)
    return toxicity.build(words)


WORDS = ["vile", "friend", "you", "worm", "unendlichlangeswort", "unendlichkurzes", "langeswort", "viler", "zz", "a", "f"]


def test_word_ratios_equal_plain_counts(model):
    told = toxicity.word_ratios(model, WORDS)
    assert np.allclose(told, [plain_ratio(TEXTS, word) for word in WORDS], rtol=1e-5, atol=1e-6)
    assert told[0] > 0 > told[1]


def test_figures_of_texts_are_sums_over_all_words(spark, model):
    texts = ["you vile friend", None, "", "vile " * 50_000, "42 !", "kind friend friend"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    told = {r["doc_id"]: r for r in toxicity.rate(rows, model, (3.0, 2.0, -1.0), {"doc_id": F.col("doc_id")}).collect()}
    for number, text in enumerate(texts):
        said = [plain_ratio(TEXTS, word) for word in set(toxicity.words_of(text))]
        said = dict(zip(set(toxicity.words_of(text)), said, strict=True))
        words = toxicity.words_of(text)
        length = len(words) + toxicity.PRIOR_WORDS
        ratio = sum(said[word] for word in words) / length
        telling = sum(max(said[word] - toxicity.EVIDENCE, 0) for word in words) / length
        row = told[number]
        assert row["ratio"] == pytest.approx(ratio, rel=1e-4, abs=1e-7)
        assert row["telling"] == pytest.approx(telling, rel=1e-4, abs=1e-7)
        assert row["score"] == pytest.approx(1 / (1 + math.exp(1 - 3 * ratio - 2 * telling)), rel=1e-4)
    assert told[5]["ratio"] < min(0, told[0]["ratio"]) and max(0, told[0]["ratio"]) < told[3]["ratio"]


def test_the_curve_is_that_of_a_search_and_survives_few_or_parted_labels():
    rng = np.random.default_rng(3)
    toxic = (rng.random(400) < 0.4).astype(float)
    figures = np.column_stack((rng.normal(size=400) + toxic, rng.exponential(size=400) + 0.5 * toxic))
    a, b, c = toxicity.fit_curve(figures, toxic)

    def loss(a, b, c):
        z = figures @ [a, b] + c
        weight = np.where(toxic == 1, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean()))
        scale = figures.std(axis=0)
        drawn = np.array([a * scale[0] - toxicity.TOWARDS[0], b * scale[1] - toxicity.TOWARDS[1]])
        offset = c + np.dot(toxicity.TOWARDS, (figures / scale).mean(axis=0))
        return (weight * (np.logaddexp(0, z) - toxic * z)).sum() + 0.5 * (drawn**2).sum() + 0.05 * offset**2

    assert all(
        loss(a, b, c) <= loss(a + x, b + y, c + z) for x in (-0.02, 0, 0.02) for y in (-0.02, 0, 0.02) for z in (-0.02, 0, 0.02)
    )
    for few in (2, 4, 40):
        parted = np.arange(few) % 2
        curve = toxicity.fit_curve(np.column_stack((parted, 5.0 * parted)), parted)
        assert np.isfinite(curve).all() and curve[1] > 0
    assert toxicity.fit_curve(np.zeros((6, 2)), np.arange(6) % 2) == pytest.approx((0, 0, 0))
    against = toxicity.fit_curve(np.column_stack((-figures[:, 0] - 2 * toxic, figures[:, 1])), toxic)
    alone = toxicity.fit_curve(np.column_stack((np.zeros(400), figures[:, 1])), toxic)
    assert against == alone and alone[0] == 0 < alone[1]


def test_the_sample_is_bounded_by_characters(spark, monkeypatch):
    rows = [(n, f"text {n} " * 10) for n in range(40)] + [(40, "x" * 3000), (41, None), (3, "text 3 " * 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(42)], "doc_id long, toxic int")
    whole = toxicity.sample(docs, labels)
    assert whole.count() == len(rows)
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 800)
    less = toxicity.sample(docs, labels).groupBy("toxic").agg(F.sum(F.char_length("text")).alias("n")).collect()
    assert len(less) == 2 and all(300 < r["n"] <= 800 for r in less)
    assert sorted(toxicity.sample(docs, labels).collect()) == sorted(toxicity.sample(docs, labels).collect())
