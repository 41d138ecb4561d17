"""The ten operators on awkward rows and against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from bumpwise.llm import bpe, ctw, embeddings, graph, jaccard, language, lines, mixing, quality, sharding, toxicity
from bumpwise.llm.common import fold, word_count
from bumpwise.llm.queries import ORACLES, QUERIES
from conftest import SMALL
from llm_fixtures import awkward, documents  # noqa: F401
from tools.compare import rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(seed, n_words, vocabulary=400):
    draw = random.Random(seed)
    stock = [f"w{draw.randrange(vocabulary)}" for _ in range(n_words)]
    return " ".join(stock)


# ---- sharding


def test_shards_are_gapless_and_grow_into_the_new_one(documents):
    docs = documents([(i, prose(i, 5)) for i in range(3000)])
    tree = sharding.uniform_tree()
    rows = sharding.place(docs, tree, sharding.with_own_region(tree)).collect()
    by_shard = {}
    for row in rows:
        by_shard.setdefault(row["shard"], []).append(row["slot"])
        assert row["grown_shard"] in (row["shard"], 24)
    assert sorted(by_shard) == list(range(24))
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert 60 < sum(row["grown_shard"] == 24 for row in rows) < 190
    assert all(75 < len(slots) < 180 for slots in by_shard.values())


def test_changed_weights_move_rows_only_between_changed_subtrees(documents):
    docs = documents([(i, "") for i in range(4000)])
    tree = sharding.uniform_tree()
    first = tree.children[0]
    rack = first.children[0]
    heavy = sharding.Node(rack.name, 1.0, tuple(sharding.Node(c.name, 2.0, (), c.shard) for c in rack.children))
    changed = sharding.Node("root", 1.0, (sharding.Node(first.name, 1.0, (heavy, *first.children[1:])), tree.children[1]))
    rows = sharding.with_shard(sharding.with_shard(docs, tree, ["doc_id"], "a"), changed, ["doc_id"], "b").collect()
    moved = [(row["a"], row["b"]) for row in rows if row["a"] != row["b"]]
    assert moved and all(b < 12 for _, b in moved)  # only into the region that became heavier
    assert all(b < 4 for a, b in moved if a < 12)  # inside it only into the heavier rack


def test_sharding_awkward(awkward):
    rows = sharding.place(awkward, sharding.uniform_tree()).collect()
    assert len(rows) == awkward.count()
    sizes = {row["doc_id"]: (row["size"], row["text_crc32"]) for row in rows}
    assert sizes[1] == sizes[2] == (8, 0)
    assert sizes[7] == (150_008, zlib.crc32(b"word " * 30_000))
    assert all(row["grown_shard"] is None for row in rows)
    assert sharding.place(awkward.limit(0), sharding.uniform_tree()).count() == 0


# ---- mixing


@pytest.mark.parametrize("seed", range(4))
def test_knapsack_equals_exhaustive_search(seed):
    draw = random.Random(seed)
    lengths = draw.sample(range(2, 30), 5)
    left = [draw.randrange(0, 4) for _ in lengths]
    budget = draw.randrange(1, 60)
    sums = {0}
    for length, n in zip(lengths, left, strict=True):
        sums = {s + k * length for s in sums for k in range(n + 1)}
    picks = mixing.knapsack(lengths, left, budget)
    used = dict.fromkeys(range(5), 0)
    for i, n in picks:
        used[i] += n
    assert all(used[i] <= left[i] for i in used)
    assert sum(lengths[i] * n for i, n in picks) == max(s for s in sums if s <= budget)


def test_mix_meets_its_targets(documents):
    draw = random.Random(3)
    docs = documents(
        [(i, "w " * draw.randrange(0, 400), "en", draw.choice(["a", "a", "a", "b", "ü", None])) for i in range(1500)]
    )
    rows = mixing.mix(docs, word_count(F.col("text"))).collect()
    again = mixing.mix(docs.repartition(3), word_count(F.col("text"))).collect()
    assert {(r["doc_id"], r["taken"]) for r in rows} == {(r["doc_id"], r["taken"]) for r in again}
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert r["source_size"] >= r["size"]
    weights = dict(zip(["a", "b", "ü", None], [1, 2, 3, 1], strict=True))
    total, goal, open_ = sum(sizes.values()), {}, set(sizes)
    while True:
        rest = total - sum(goal.values())
        level = rest / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > 3 * sizes[s]}
        if not over:
            goal |= {s: level * weights[s] for s in open_}
            break
        goal |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over
    for s in sizes:
        assert target[s] == pytest.approx(goal[s])
        assert abs(taken[s] - goal[s]) <= 1


def test_mixing_awkward(awkward):
    rows = mixing.mix(awkward, word_count(F.col("text"))).collect()
    assert len(rows) == awkward.count()
    assert all(r["taken"] == 0 for r in rows if r["doc_id"] in (1, 2, 5))
    assert mixing.mix(awkward.limit(0), word_count(F.col("text"))).count() == 0


# ---- quality


def test_quality_equals_sql(spark):
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    frame = QUERIES["op8_quality_rules"](spark, SMALL)
    answer = database.execute(ORACLES["op8_quality_rules"])
    assert rows_of(frame.columns, frame.collect()) == rows_of([c[0] for c in answer.description], answer.fetchall())


def test_quality_awkward_and_filterable(documents, awkward):
    rows = quality.clean_lines(awkward).where("kept or not kept").collect()
    assert len(rows) == awkward.count()
    found = {r["doc_id"]: r for r in rows}
    assert found[1]["n_words"] == found[2]["n_words"] == found[5]["n_words"] == 0
    assert found[7]["n_repeat_words"] == 30_000 and found[7]["base_failed"]
    good = prose(1, 60) + ".\n"
    menu = "Home | News | Sport | Login\n"
    mixed = quality.clean_lines(documents([(1, good + menu + prose(3, 30) + '.')])).first()
    assert mixed["kept"] and mixed["n_lines_removed"] == 1 and "Home" not in mixed["clean_text"]
    assert not quality.clean_lines(documents([(1, prose(2, 60) + ".\n" + menu * 40)])).first()["kept"]
    assert quality.clean_lines(awkward.limit(0)).count() == 0


# ---- language


def test_languages_are_told_apart(documents):
    syllables = {"aa": ["ka", "lo", "mi"], "bb": ["str", "eng", "ur"], "cc": ["é", "ñu", "ío"]}
    draw = random.Random(1)
    text = lambda s: " ".join("".join(draw.choices(s, k=3)) for _ in range(30))
    docs = documents([(i, text(s), name) for i in range(60) for name, s in [list(syllables.items())[i % 3]]])
    model = language.learn(docs.where("doc_id < 45"))
    rows = language.identify(docs.where("doc_id >= 45"), model, {"doc_id": F.col("doc_id"), "lang": F.col("lang")}).collect()
    assert all(r["lang_pred"] == r["lang"] and 0.3 < r["score"] <= 1 for r in rows)


def test_language_awkward(awkward, documents):
    model = language.learn(documents([(1, "alpha beta gamma", "en"), (2, None, "de"), (3, "x", None)]))
    rows = language.identify(awkward, model, {"doc_id": F.col("doc_id")}).collect()
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows}
    assert len(rows) == awkward.count() and found[1] == found[2] == found[5] == ("und", 0.0)
    none = language.identify(awkward, language.learn(awkward), {"doc_id": F.col("doc_id")}).collect()
    assert {r["lang_pred"] for r in none} == {"und"}


# ---- toxicity


def test_toxic_words_are_learned_and_rare_ones_are_neutral(spark, documents):
    draw = random.Random(5)
    bad = ["grobian", "schurkel", "lumpazi"]
    rows, labels = [], []
    for i in range(240):
        words = prose(i, 60, 80).split()
        if i % 2:
            for at in draw.sample(range(60), 6):
                words[at] = draw.choice(bad)
        rows.append((i, "".join("abcdefgh"[int(c)] if c in "01234567" else c for c in " ".join(words))))
        labels.append((i, i % 2))
    docs, labels = documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model, curve = toxicity.learn(docs.where("doc_id < 180"), labels.where("doc_id < 180"))
    told = toxicity.rate(docs.where("doc_id >= 180"), model, curve, {"doc_id": F.col("doc_id")}).collect()
    right = sum((r["score"] >= toxicity.THRESHOLD) == (r["doc_id"] % 2 == 1) for r in told)
    assert right >= 57
    assert abs(toxicity.word_ratios(model, ["zzyzx"])[0]) < 0.5


@pytest.mark.parametrize("script", ["compounds", "unspaced"])
def test_toxic_parts_after_the_eighth_letter_are_found(spark, documents, script):
    draw = random.Random(6)
    letters = [chr(c) for c in range(0x4E00, 0x4F00)] if script == "unspaced" else list("abcdefghijklmnopqrst")
    some = lambda n: "".join(draw.choice(letters) for _ in range(n))
    bad = [some(6 if script == "compounds" else 3) for _ in range(3)]
    first = [some(9) for _ in range(60)]
    rows, labels = [], []
    for i in range(240):
        words = [(draw.choice(first) if script == "compounds" else some(12)) + some(6) for _ in range(40)]
        if i % 2:
            for at in draw.sample(range(40), 6):
                words[at] = words[at][: draw.randrange(9, 13)] + draw.choice(bad) + some(2)
        rows.append((i, " ".join(words)))
        labels.append((i, i % 2))
    docs, labels = documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model, curve = toxicity.learn(docs.where("doc_id < 180"), labels.where("doc_id < 180"))
    told = toxicity.rate(docs.where("doc_id >= 180"), model, curve, {"doc_id": F.col("doc_id")}).collect()
    right = sum((r["score"] >= toxicity.THRESHOLD) == (r["doc_id"] % 2 == 1) for r in told)
    assert right >= 57
    assert min(toxicity.word_ratios(model, [some(15) + b for b in bad])) > toxicity.EVIDENCE


def test_toxicity_awkward(spark, awkward):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model, curve = toxicity.learn(awkward, none)
    rows = toxicity.rate(awkward, model, curve, {"doc_id": F.col("doc_id")}).collect()
    assert len(rows) == awkward.count() and {r["score"] for r in rows} == {0.0}
    some = spark.createDataFrame([(4, 1), (6, 0), (6, None), (None, 1), (1, 0)], "doc_id long, toxic int")
    model, curve = toxicity.learn(awkward, some)
    assert toxicity.rate(awkward, model, curve, {"doc_id": F.col("doc_id")}).count() == awkward.count()


# ---- BPE


def test_bpe_equals_the_library(spark, awkward):
    tiktoken, public = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    ranks, pattern = bpe.public_vocabulary()
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.encode_documents(
        awkward, ranks, pattern, {"doc_id": F.col("doc_id"), "text": F.col("text")}, texts_back=True
    ).collect()
    assert len(rows) == awkward.count()
    for row in rows:
        text = row["text"] or ""
        ids = library.encode_ordinary(text)
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert bytes(row["decoded"]) == text.encode()
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


@pytest.mark.parametrize("seed", range(5))
def test_both_trees_merge_alike(seed):
    """A small vocabulary with many ties; pieces from 1 to 64 bytes, then beyond."""
    draw = random.Random(seed)
    ranks = {bytes([b]): b for b in range(256)}
    while len(ranks) < 330:
        a, b = draw.choice(list(ranks)[97:100] + list(ranks)[256:]), draw.choice(list(ranks)[97:100])
        ranks.setdefault(a + b, len(ranks))
    vocabulary = bpe.Vocabulary(ranks)
    pieces = [bytes(draw.choices(b"abc", k=draw.randrange(1, 65))) for _ in range(200)]
    for piece, ids in zip(pieces, bpe.encode_pieces(pieces, vocabulary), strict=True):
        plain = [ranks[bytes([b])] for b in piece]
        while True:
            found = [(vocabulary.pairs.get(pair, 1 << 60), i) for i, pair in enumerate(zip(plain, plain[1:], strict=False))]
            if piece in ranks or not found or min(found)[0] == 1 << 60:
                break
            rank, i = min(found)
            plain[i : i + 2] = [rank]
        wanted = [ranks[piece]] if piece in ranks else plain
        assert ids.tolist() == wanted == bpe.encode_piece(piece, vocabulary)


# ---- similarity joins


def _components(nodes, links):
    top = {n: n for n in nodes}

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_a_long_chain_and_stars(spark):
    draw = random.Random(2)
    chain = list(range(300))
    links = list(zip(chain, chain[1:], strict=False)) + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 5000)]
    draw.shuffle(links)
    frame = spark.createDataFrame([(b, a) if draw.random() < 0.5 else (a, b) for a, b in links], "a long, b long")
    found = {r["node"]: r["component"] for r in graph.components(frame).collect()}
    assert found == _components({n for link in links for n in link}, links)
    assert graph.components(frame.limit(0)).count() == 0


@pytest.mark.parametrize("percent,words", [(85, 4), (80, 5), (50, 2)])
def test_jaccard_equals_brute_force(documents, percent, words):
    draw, rows = random.Random(percent), []
    for group in range(25):
        base = prose(group, draw.choice([3, 4, 12, 60, 150])).split()
        for _ in range(draw.randrange(1, 9)):
            copy = list(base)
            for _ in range(draw.randrange(0, 4)):
                copy[draw.randrange(len(copy))] = f"n{draw.randrange(9999)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows), rows[3][1].upper()), (len(rows) + 1, None), (len(rows) + 2, " \n")]
    sets = {}
    for i, text in rows:
        w = WORD.findall(lower(text))
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    wanted = _components(sets, links)
    found = jaccard.jaccard_components(documents(rows), {"doc_id": F.col("doc_id")}, jaccard.Similarity(words, percent)).collect()
    clusters = {}
    for r in found:
        assert r["n_shingles"] == len(sets[r["doc_id"]])
        if r["cluster"] is not None:
            clusters.setdefault(r["cluster"], []).append(r["doc_id"])
    got = {i: min(members) for members in clusters.values() for i in members}
    assert got == {i: wanted[i] for i in sets if sets[i]} and len(links) > 20


def test_jaccard_awkward(awkward):
    rows = jaccard.jaccard_components(awkward, {"doc_id": F.col("doc_id")}).collect()
    assert len(rows) == awkward.count()
    found = {r["doc_id"]: r for r in rows}
    assert found[1]["n_shingles"] == found[2]["n_shingles"] == 0 and found[7]["n_shingles"] == 1
    assert found[None]["cluster"] == found[4]["cluster"]
    assert jaccard.jaccard_components(awkward.limit(0), {"doc_id": F.col("doc_id")}).count() == 0


def test_lines_equal_brute_force(documents):
    draw, rows = random.Random(8), []
    for group in range(20):
        base = prose(group, draw.choice([2, 10, 40])).split()
        for _ in range(draw.randrange(1, 6)):
            text = []
            for _ in range(2):
                copy = list(base)
                if draw.random() < 0.6:
                    copy[draw.randrange(len(copy))] = f"n{draw.randrange(9999)}"
                text.append(" ".join(copy))
            rows.append((len(rows), "\n".join([*text, "", f"own line {group} {len(rows)} " + prose(1000 + len(rows), 20)])))
    placed = [(i, at, line) for i, text in rows for at, line in enumerate(text.split("\n")) if line]
    grams = lambda line: {line[k : k + 9] for k in range(len(line) - 8)} if len(line) >= 9 else {line}
    sets = [grams(line) for _, _, line in placed]
    near = [
        (a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
        if 100 * len(sets[a] & sets[b]) >= lines.PERCENT * len(sets[a] | sets[b])
    ]
    of = _components(range(len(sets)), near)
    gone = {(placed[n][0], placed[n][1]) for n in of if of[n] != n}
    found = {r["doc_id"]: r for r in lines.without_repeats(documents(rows)).collect()}
    different = 0
    for i, text in rows:
        kept = "\n".join(line for at, line in enumerate(text.split("\n")) if (i, at) not in gone)
        different += found[i]["text"] != kept
    assert different <= 0.02 * len(rows) and len(gone) > 20  # MinHash may miss one of a hundred


def test_lines_of_60_to_80_characters(documents):
    draw, rows = random.Random(3), []
    for length in [*range(60, 80), *[64] * 10, *[66] * 10]:
        line = (f"{draw.randrange(10**6)} " + prose(2000 + len(rows), 30))[:length].strip() + "."
        rows += [(len(rows), line), (len(rows) + 1, line[: -1 - len(rows) // 2 % 3])]
    removed = {r["doc_id"]: r["_n_removed"] for r in lines.without_repeats(documents(rows)).collect()}
    assert removed == {i: i % 2 for i in range(len(rows))}


def test_lines_without_blanks(documents):
    draw, rows = random.Random(4), []
    for alphabet in (range(0x4E00, 0x5200), range(0x0E01, 0x0E2F), range(0x61, 0x7B)):
        for _ in range(8):
            line = "".join(chr(draw.choice(alphabet)) for _ in range(200))
            rows += [(len(rows), line), (len(rows) + 1, chr(draw.choice(alphabet)) + "#" + line[2:])]
    links = ["https://w" + "".join(draw.choice("abcdefgh/-") for _ in range(90)) for _ in range(30)]
    rows += [(len(rows) + i, line) for i, line in enumerate(links)]
    docs = documents(rows)
    removed = {r["doc_id"]: r["_n_removed"] for r in lines.without_repeats(docs).collect()}
    assert removed == {i: i % 2 if i < 48 else 0 for i in range(len(rows))}


def test_lines_awkward(awkward):
    rows = lines.without_repeats(awkward).collect()
    assert len(rows) == awkward.count()
    found = {r["doc_id"]: r for r in rows}
    assert found[1]["text"] is None and found[2]["text"] == "" and found[5]["text"] == "\n\n \t\r\n"
    assert found[4]["text"] != "" and found[None]["text"] == ""  # the id that is not null keeps the line
    assert lines.without_repeats(awkward.limit(0)).count() == 0


def test_vectors_equal_brute_force(spark):
    draw = np.random.default_rng(4)
    centers = draw.normal(size=(30, 20))
    vectors = [c + 0.25 * draw.normal(size=20) for c in centers for _ in range(12)]
    vectors += [vectors[0], vectors[0] * 2, vectors[1] * 0]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    n = len(rows)
    rows += [(n, None), (n + 1, [1.0, None] + [0.0] * 18), (n + 2, [float("nan")] * 20), (n + 3, [1.0]), (n + 4, [float("inf")] * 20), (n + 5, [])]
    frame = spark.createDataFrame(rows, "id long, e array<double>")
    found = {r["vec_id"]: r for r in embeddings.near_duplicates(frame, "id", "e").collect()}
    units = {i: np.array(v) / np.linalg.norm(v) for i, v in rows[: n - 1]}
    links = [(a, b) for a in units for b in units if a < b and units[a] @ units[b] >= embeddings.COSINE]
    of = _components(range(n + 6), links)
    for i in range(n + 6):
        assert found[i]["n_links"] == sum(i in link for link in links)
        assert found[i]["component_id"] == of[i] and found[i]["kept"] == (of[i] == i)
    assert len(links) > 50
    assert embeddings.near_duplicates(frame.limit(0), "id", "e").count() == 0


def test_vectors_in_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 16)
    draw = np.random.default_rng(5)
    rows = [(i, [float(x) for x in 1 + 0.3 * draw.normal(size=16)]) for i in range(150)]
    frame = spark.createDataFrame(rows, "id long, e array<float>")
    found = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(frame, "id", "e").collect()}
    units = np.array([v for _, v in rows], np.float32).astype(float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    assert found == {i: int(n) - 1 for i, n in enumerate((units @ units.T >= embeddings.COSINE).sum(axis=1))}


# ---- context-tree weighting


def _plain_model(texts, depth):
    """Counts and weighted probabilities of every context, by recursion on dictionaries."""
    counts = {}
    for text in texts:
        data = [ctw.MARK] * depth + list(lower(text).encode()) + [ctw.MARK]
        for at in range(depth, len(data)):
            for d in range(depth + 1):
                context, bits = tuple(data[at - d : at]), 1
                for k in range(8):
                    bit = data[at] >> (7 - k) & 1
                    counts.setdefault((context, bits), [0, 0])[bit] += 1
                    bits = bits << 1 | bit
    estimate = lambda c: math.lgamma(c[0] + 0.5) + math.lgamma(c[1] + 0.5) - math.lgamma(sum(c) + 1) - math.log(math.pi)
    children = {}
    for context, bits in counts:
        if context:
            children.setdefault((context[1:], bits), []).append((context, bits))
    weighted = {}
    for node in sorted(counts, key=lambda n: -len(n[0])):
        own = estimate(counts[node])
        split = sum(weighted[c][0] for c in children.get(node, []))
        if len(node[0]) == depth:
            weighted[node] = (own, 1.0)
        else:
            weighted[node] = (np.logaddexp(own, split) - math.log(2), 1 / (1 + math.exp(min(700, split - own))))
    return counts, weighted


def _plain_score(text, model, depth):
    counts, weighted = model
    data, total = [ctw.MARK] * depth + list(lower(text).encode()) + [ctw.MARK], 0.0
    for at in range(depth, len(data)):
        bits = 1
        for k in range(8):
            bit, chance = data[at] >> (7 - k) & 1, 0.5
            for d in range(depth, -1, -1):
                node = (tuple(data[at - d : at]), bits)
                if node in counts:
                    zeros, ones = counts[node]
                    own, weight = (ones + 0.5) / (zeros + ones + 1), weighted[node][1]
                    chance = weight * own + (1 - weight) * chance
                else:
                    chance = 0.5
            total += math.log10(chance if bit else 1 - chance)
            bits = bits << 1 | bit
    return total


def test_scores_equal_a_plain_context_tree(documents):
    texts = [prose(i, 30, 12) + ("É" if i % 3 else " Zz\n") for i in range(14)] + [None, "", "abc " * 20]
    docs = documents(list(enumerate(texts)))
    rows = ctw.score(docs, F.col("doc_id") < 10, {"doc_id": F.col("doc_id")}).collect()
    model = _plain_model(texts[:10], ctw.DEPTH)
    uses = {}
    for text in texts[:10]:
        for word in [*WORD.findall(lower(text)), None]:
            uses[word] = uses.get(word, 0) + 1
    n, v = sum(uses.values()), len(uses)
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row["doc_id"]]
        words = [*WORD.findall(lower(text)), None]
        base = sum(math.log10((uses.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        assert row["train_tokens"] == n and row["n_tokens"] == len(words)
        assert row["n_known"] == sum(w in uses for w in words)
        assert row["base_score"] == pytest.approx(base)
        assert row["score"] == pytest.approx(_plain_score(text, model, ctw.DEPTH), rel=1e-5)


def test_scores_do_not_depend_on_blocks(documents, monkeypatch):
    docs = documents([(i, prose(i, 200, 50)) for i in range(60)])
    one = {r["doc_id"]: r["score"] for r in ctw.score(docs, F.col("doc_id") % 5 != 1, {"doc_id": F.col("doc_id")}).collect()}
    monkeypatch.setattr(ctw, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(ctw, "_CHUNK", 500)
    many = {r["doc_id"]: r["score"] for r in ctw.score(docs, F.col("doc_id") % 5 != 1, {"doc_id": F.col("doc_id")}).collect()}
    assert one == pytest.approx(many, rel=1e-6)


def test_scoring_awkward(awkward):
    rows = ctw.score(awkward, fold("doc_id", 5) != 1, {"doc_id": F.col("doc_id")}).collect()
    assert len(rows) == awkward.count() and all(r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 5)} == {1}
    untaught = ctw.score(awkward, F.lit(False), {"doc_id": F.col("doc_id")}).collect()
    assert {r["train_tokens"] for r in untaught} == {0}
    assert ctw.score(awkward.limit(0), F.lit(True), {"doc_id": F.col("doc_id")}).count() == 0
