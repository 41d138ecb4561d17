"""Ranked search against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from bumpwise.llm import search as module
from bumpwise.llm.search import Lists, counted, ranked_search, search, terms_of

DOCUMENTS, ITEMS = "doc_id long, text string", "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(documents, items, top=10):
    counts = [(doc, Counter(words(text))) for doc, text in documents if words(text)]
    n_documents, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(term for _, c in counts for term in c)
    out = []
    for item, text in sorted(set(items), key=repr):
        scored = []
        for doc, c in counts:
            m = 25 + 75 * sum(c.values()) * n_documents // length
            score = 0
            for term, times in Counter(words(text)).items():
                if c[term]:
                    w = math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df[term] + 1)))
                    score += times * w * ((1_000_000_000 * c[term]) // (1000 * c[term] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, null, doc) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if null else doc, -score))
    return sorted(out, key=repr)


def found(spark, documents, items, **options):
    frame = spark.createDataFrame(documents, DOCUMENTS)
    for name in ("query", "rank", "score", "known"):
        frame = frame.selectExpr("*", f"'x' AS {name}")
    result = ranked_search(frame.repartition(3), spark.createDataFrame(items, ITEMS), **options)
    return sorted((tuple(row) for row in result.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def made(seed, n, vocabulary=40):
    chosen = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [(i, " ".join(chosen.choices(names, weights, k=chosen.randint(1, 60)))) for i in range(n)]


@pytest.mark.parametrize("block", [7, 64, 2048])
def test_equals_scoring_all(spark, monkeypatch, block):
    monkeypatch.setattr(module, "BLOCK_DOCUMENTS", block)
    documents = made(block, 500)
    items = [(i, text) for i, text in made(block + 1, 12)] + [(90, "absent words"), (91, None), (92, "")]
    assert found(spark, documents, items) == brute(documents, items)


def test_batches_of_queries(spark):
    documents, items = made(3, 200), [(i, text) for i, text in made(4, 23)]
    assert found(spark, documents, items, batch=5) == brute(documents, items)


def test_ties_repeats_nulls_and_long_texts(spark):
    documents = [(i % 7, "same words here") for i in range(30)]
    documents += [(None, "same words here"), (50, None), (51, ""), (52, " \t\n"), (None, None)]
    documents += [(60, "Ünïcödé 漢字 SAME-words " + "long " * 100_000), (61, "x" * 3_000_000 + " same")]
    documents += [(2**63 - 1, "rare"), (None, "rare"), (-5, "rare Rare RARE")]
    items = [(1, "SAME words"), (1, "SAME words"), (2, "ÜNÏCÖDÉ Ünïcödé 漢字"), (3, "long"), (4, "rare"), (None, "here here")]
    assert found(spark, documents, items) == brute(documents, items)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None)], [(1, "a")]) == []


def test_terms_across_slices(monkeypatch):
    text = "Alpha, beta;GAMMA délta_1 " + "y" * 50 + " end"
    for size in (1, 2, 3, 5, 8, 64):
        monkeypatch.setattr(module, "_SLICE", size)
        assert [w.decode() for part in terms_of(text) for w in part] == words(text)
        assert sum(counted(text).values()) == len(words(text))


def random_lists(seed, documents, sizes):
    chosen = np.random.default_rng(seed)
    places = [np.sort(chosen.choice(documents, size, replace=False)) for size in sizes]
    impacts = chosen.integers(1, 50, sum(sizes))
    return Lists(np.arange(len(sizes)), np.array(sizes), np.concatenate(places), impacts, documents)


def test_range_maxima():
    lists = random_lists(1, 200, [1, 2, 3, 64, 100, 200])
    starts = np.cumsum([0, 1, 2, 3, 64, 100])
    for start, size in zip(starts, [1, 2, 3, 64, 100, 200], strict=True):
        pairs = [(a, b) for a in range(0, size + 1, 3) for b in range(a, size + 1)]
        first, last = (np.array(side) + start for side in zip(*pairs, strict=True))
        best = lists.largest(first[:, None], last[:, None])[:, 0]
        for a, b, at in zip(first, last, best, strict=True):
            assert (at == -1) == (a == b)
            assert a == b or (a <= at < b and lists.impacts[at] == lists.impacts[a:b].max())


@pytest.mark.parametrize("top", [1, 5, 500])
def test_best_first_search_is_exact(top):
    lists = random_lists(top, 400, [3, 40, 200, 400])
    query = {0: 1, 1: 2, 2: 1, 3: 1, 99: 4}
    scores = np.zeros(400, np.int64)
    for term, times in query.items():
        if term < 4:
            inside = lists.keys // 400 == term
            scores[lists.places[inside]] += times * lists.impacts[inside]
    order = sorted((-score, place) for place, score in enumerate(scores.tolist()) if score > 0)[:top]
    got, _ = search(lists, query, 1, top)
    assert sorted((-score, place) for score, place in got)[:top] == order


def test_bounds_spare_most_documents():
    """A rare term decides: few intervals are split."""
    documents = 5000
    places = np.concatenate([np.arange(documents), np.arange(0, documents, 500)])
    impacts = np.concatenate([np.full(documents, 3), np.full(10, 1000)])
    lists = Lists(np.arange(2), np.array([documents, 10]), places, impacts, documents)
    got, splits = search(lists, {0: 1, 1: 1}, 1, 10)
    assert len(got) == 10 and splits < 100
