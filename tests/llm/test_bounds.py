"""Sizes and awkward columns: vectors of several lengths, long texts, many lines, plain recomputation."""

from __future__ import annotations

import math
import random
import struct
import time
import tracemalloc

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from bumpwise.llm import ctw, embeddings, jaccard, language, lines, sharding, sketch
from bumpwise.session import setting
from llm_fixtures import documents  # noqa: F401


def test_vectors_of_several_lengths(spark):
    draw = np.random.default_rng(6)
    rows, units = [], {}
    for length, count in ((8, 40), (3, 30), (20, 25), (1, 6), (5, 1)):
        center = draw.normal(size=length)
        for _ in range(count):
            vector = center + 0.35 * draw.normal(size=length)
            rows.append((len(rows), [float(x) for x in vector]))
            units[len(rows) - 1] = vector / np.linalg.norm(vector)
    rows += [(None, rows[0][1]), (500, rows[-1][1]), (501, rows[-1][1] + [0.0])]
    frame = spark.createDataFrame(rows, "id long, e array<double>").withColumn("node", F.lit("x")).withColumn("links", F.lit(1))
    found = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(frame, "id", "e").collect()}
    alike = lambda a, b: len(a) == len(b) and float(a @ b) >= embeddings.COSINE
    every = {**units, None: units[0], 500: units[len(units) - 1]}
    for key, unit in every.items():
        assert found[key] == sum(alike(unit, other) for name, other in every.items() if name != key)
    assert found[501] == 0 and sum(found.values()) > 100


def plain_profile(text):
    """The bundle of a text's trigrams, one by one."""
    symbols = [0]
    for letter in text.lower():
        code = ord(letter) if letter.isalpha() else 0
        if code or symbols[-1]:
            symbols.append(code)
    symbols += [0] if symbols[-1] else []
    total = np.zeros(language.DIMENSIONS, np.int64)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
        if b:
            v = [language._letter_vector(x).astype(np.int64) for x in (a, b, c)]
            total += np.roll(v[0], 2) * np.roll(v[1], 1) * v[2]
    return total


@pytest.mark.parametrize("kept", [0, 1 << 16])
def test_languages_equal_plain_vectors(spark, documents, monkeypatch, kept):
    monkeypatch.setattr(language, "_KEPT_TRIGRAMS", kept)
    monkeypatch.setattr(language, "_AT_ONCE", 7)
    texts = {"en": ["the cat sat on the mat", "A dog, a cat!", "éa b c"], "xx": ["zuk bek 12 tir", "漢字 zuk", "tir-tir"]}
    rows = [(i, t, lang) for i, (t, lang) in enumerate((t, lang) for lang, ts in texts.items() for t in ts)]
    asked = ["the mat", "bek zuk", "漢", "x", "12 34", "", "CAT tir the zuk"]
    batch = documents(rows).select("text", "lang")
    # in this process, so that the small sizes count
    taught = {}
    for part in language._teach(iter(batch.toArrow().to_batches())):
        for lang, place, value in zip(*(c.to_pylist() for c in part.columns), strict=True):
            taught.setdefault(lang, np.zeros(language.DIMENSIONS, np.int64))[place] += value
    for lang, ts in texts.items():
        assert (taught[lang] == sum(map(plain_profile, ts))).all()
    model = (sorted(taught), np.array([taught[x] for x in sorted(taught)], float))
    frame = documents([(i, t) for i, t in enumerate(asked)]).selectExpr("text AS _text", "doc_id")
    work = language._answer(*model, ["doc_id"])
    got = [r for part in work(iter(frame.toArrow().to_batches())) for r in part.to_pylist()]
    for row in got:
        own = plain_profile(asked[row["doc_id"]]).astype(float)
        if not own.any():
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        cosines = [own @ p / np.linalg.norm(own) / np.linalg.norm(p) for p in model[1]]
        assert row["lang_pred"] == model[0][int(np.argmax(cosines))]
        assert row["score"] == pytest.approx(min(1, max(0, max(cosines))))


def test_a_long_text_of_many_letters_stays_small():
    chosen = random.Random(3)
    text = "".join(chr(0x4E00 + chosen.randrange(3000)) for _ in range(1_000_000))
    tracemalloc.start()
    (group, counts), rows, bound = language.trigrams([text], np.zeros(1, np.int64))
    total = bound.bundle(counts, rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts.sum() == 1_000_000 - 0 and np.abs(total).max() > 0
    assert peak < 300 << 20


def test_code_length_per_byte(documents):
    texts = ["abab abab abab", None, "", "Ünïcödé 漢字", "x" * 3000]
    rows = ctw.score(documents(list(enumerate(texts))), F.lit(True), {"doc_id": F.col("doc_id")}).collect()
    for row in rows:
        size = len((texts[row["doc_id"]] or "").encode()) + 1
        assert row["n_bytes"] == size
        assert row["bits_per_byte"] == pytest.approx(-row["score"] * math.log2(10) / size)
    found = {r["doc_id"]: r["bits_per_byte"] for r in rows}
    assert found[4] < found[0] < 16 and found[4] < 1


def spark_hash(*values):
    seed = 42
    for value in values:
        data = value.encode() if isinstance(value, str) else struct.pack("<q", value)
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed


def test_shards_equal_a_plain_descent(documents):
    def leaf(name, weight, number):
        return sharding.Node(name, weight, (), number)

    tree = sharding.Node("root", 1.0, (
        sharding.Node("a", 1.0, (sharding.Node("a/0", 1.0, (leaf("a/0/0", 1.0, 0), leaf("a/0/1", 2.5, 1))),)),
        sharding.Node("b", 1.0, (sharding.Node("b/0", 1.0, (leaf("b/0/0", 0.0, 2), leaf("b/0/1", 4.0, 3))), sharding.Node("b/1", 1.0, (leaf("b/1/0", 0.5, 4),)))),
    ))

    def descend(key):
        node = tree
        while node.children:
            draws = []
            for place, child in enumerate(node.children):
                bits = spark_hash(f"7:{child.name}", key) >> 11
                if child.weight > 0:
                    draws.append((-math.log((bits + 0.5) / 2.0**53) / child.weight, place))
            node = node.children[min(draws)[1]]
        return node.shard

    rows = sharding.with_shard(documents([(i, "") for i in range(-300, 900)]), tree, ["doc_id"], "shard", seed=7).collect()
    assert all(row["shard"] == descend(row["doc_id"]) for row in rows)
    assert {row["shard"] for row in rows} == {0, 1, 3, 4}


def test_lines_of_documents_with_clashing_columns(documents):
    names = "gone,_id,_hash,_key_id,_key_hash,_gone,_split,_n_lines,_n_removed,node,place,line"
    docs = documents([(1, "a common line of words\nown one"), (2, "a common line of words\nother two"), (None, None)], extra=names)
    rows = lines.without_repeats(docs).orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == [None, "a common line of words\nown one", "other two"]
    assert rows[0].asDict().keys() >= set(names.split(",")) and {r["_gone"] for r in rows} == {"x"}
    assert [r["__n_removed"] for r in rows] == [0, 0, 1] and {r["_n_removed"] for r in rows} == {"x"}


def test_a_document_of_many_equal_lines(documents):
    """Taking lines out is linear: 100,000 equal lines, all but one of which go."""
    docs = documents([(1, "the same line again\n" * 100_000 + "the end of it"), (2, "another line")])
    started = time.time()
    found = {r["doc_id"]: r for r in lines.without_repeats(docs).collect()}
    assert time.time() - started < 60
    assert found[1]["text"] == "the same line again\nthe end of it\n" or found[1]["text"] == "the same line again\nthe end of it"
    assert found[1]["_n_removed"] == 99_999 and found[2]["_n_removed"] == 0


def test_buckets_do_not_change_what_is_shared(spark):
    """A piece cut into few or very many buckets gives the same shared shingles."""
    import pyarrow as pa

    chosen = random.Random(4)
    texts = [" ".join(f"w{chosen.randrange(40)}" for _ in range(chosen.randrange(0, 30))) for _ in range(200)] + [None, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["_text"])
    found = []
    for bits in (4, 9, 20):
        packed = pa.Table.from_batches(list(jaccard._packed(2, bits)(iter([batch]))))
        rows = set()
        for bucket in set(packed.column("bucket").to_pylist()):
            part = packed.filter(pa.compute.equal(packed.column("bucket"), bucket)).combine_chunks()
            told = jaccard._shared(bits)(part).to_pydict()
            rows |= set(zip(told["node"], told["size"], told["df"], [x & (2**64 - 1) for x in told["shingle"]]))
        found.append(sorted((node, size, df) for node, size, df, _ in rows))
    assert found[0] == found[1] == found[2] and len(found[0]) > 100


def test_similar_lines_are_found_at_every_similarity(documents):
    """Of pairs that are barely similar, 95 % at least; and none below the threshold."""
    draw, rows, alike = random.Random(12), [], {}
    letters = "abcdefghijklmnopqrstuvwxyz "
    grams = lambda line: {line[k : k + 9] for k in range(len(line) - 8)}
    for n in range(900):
        line = [draw.choice(letters) for _ in range(draw.randrange(60, 300))]
        copy = list(line)
        for _ in range(max(1, len(line) * draw.randrange(1, 4) // 200)):
            copy[draw.randrange(len(copy))] = "#"
        a, b = ("x" + "".join(part) + "x" for part in (line, copy))
        x, y = grams(a), grams(b)
        alike[2 * n + 1] = len(x & y) / len(x | y)
        rows += [(2 * n, a), (2 * n + 1, b)]
    found = {r["doc_id"]: r["_n_removed"] for r in lines.without_repeats(documents(rows)).collect()}
    assert not any(found[i] for i, j in alike.items() if j < 0.8)
    for low, high in ((0.8, 0.85), (0.85, 0.9), (0.9, 1.01)):
        of = [found[i] for i, j in alike.items() if low <= j < high]
        assert len(of) >= 50 and sum(of) >= 0.95 * len(of)


def test_families_below_the_threshold_stay_and_sketches_lose_no_link(spark):
    draw = random.Random(13)
    base = [draw.choice("abcdefghijklmnop ") for _ in range(150)]
    family = []
    for _ in range(60):
        copy = list(base)
        for _ in range(draw.randrange(0, 5)):
            copy[draw.randrange(len(copy))] = draw.choice("0123456789")
        family.append("".join(copy))
    texts = spark.createDataFrame(list(enumerate(family)), "node long, line string")
    pairs = texts.select(F.col("node").alias("a")).crossJoin(texts.select(F.col("node").alias("b"))).where("a < b")
    grams = [{line[k : k + 9] for k in range(len(line) - 8)} for line in family]
    near = {
        (a, b) for a in range(60) for b in range(a + 1, 60)
        if 100 * len(grams[a] & grams[b]) >= 80 * len(grams[a] | grams[b])
    }
    within = lines._within_bound(pairs, lines.sketches(texts))
    left = {tuple(r) for r in within.collect()}
    assert near <= left and len(left) < 0.5 * (len(near) + 1770)
    assert {tuple(r) for r in lines._linked(within, texts).collect()} == near


def test_a_line_of_millions_of_characters(documents):
    line = "".join(random.Random(14).choices("abcdefgh ", k=2_000_000))
    rows = {r["doc_id"]: r for r in lines.without_repeats(documents([(1, line), (2, line + "!"), (3, "short")])).collect()}
    assert [rows[i]["_n_removed"] for i in (1, 2, 3)] == [0, 1, 0]


def _varied(draw, n_texts, n_words):
    return [" ".join(f"w{draw.randrange(10**6)}" for _ in range(n_words)) for _ in range(n_texts)]


def test_sets_are_packed_piece_by_piece(spark):
    """10 MB of text take a few times 1 MB of text, not of all or of 4 MB (59 MB before, 16 after)."""
    import pyarrow as pa

    texts = pa.array(_varied(random.Random(15), 3000, 450), pa.string())
    batch = pa.RecordBatch.from_arrays([texts], ["_text"])
    assert batch.nbytes > 9e6
    tracemalloc.start()
    try:
        packed = sum(piece.num_rows for piece in jaccard._packed(5, 6)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert packed >= 9 * 64 and peak < 30e6


def test_only_texts_that_may_link_are_split_whole(documents):
    draw = random.Random(16)
    single = _varied(draw, 200, 120)
    near = [" ".join([*text.split()[:-1], f"n{n}"]) for n, text in enumerate(_varied(draw, 20, 120)) for n in range(3)]
    docs = documents(list(enumerate([*single, *near, single[0], None, "two words"])))
    keys = docs.select("doc_id", F.xxhash64("text").alias("_key"), F.col("text").alias("_text"))
    placed = keys.mapInArrow(jaccard._nodes(4, ["doc_id", "_key"]), "doc_id long, _key long, n_shingles long, node long")
    left, n_bytes = jaccard.open_texts(docs, placed, jaccard.Similarity(), 1 << 20)
    left = {r["_text"] for r in left.collect()}
    assert set(near) <= left and len(left & set(single)) < 20 and 0 < n_bytes < 1 << 19
    # without a share of the hashes that could tell, all stay
    every, _ = jaccard.open_texts(docs, placed, jaccard.Similarity(4, 20), 1 << 20)
    assert every.count() == len(single) + len(near) + 2


def test_sketches_of_sets_lose_no_link_and_bound_families_below_the_threshold(spark):
    import pyarrow as pa

    draw, family = random.Random(17), []
    base = _varied(draw, 1, 180)[0].split()
    for _ in range(80):
        copy = list(base)
        for _ in range(draw.randrange(0, 9)):
            copy[draw.randrange(len(copy))] = f"n{draw.randrange(10**6)}"
        family.append(" ".join(copy))
    sets = jaccard.shingle_sets(pa.array(family, pa.string()), 4)
    # a shingle that only one set has is counted in the size alone, as in similar_nodes
    several = {x for s in sets for x in s.tolist() if sum(x in set(t.tolist()) for t in sets) > 1}
    shared = [[int(x.astype("int64")) for x in s if int(x) in several] for s in sets]
    nodes = spark.createDataFrame([(n, len(s), h) for n, (s, h) in enumerate(zip(sets, shared, strict=True))], "node long, size int, shared array<long>")
    side = lambda to: jaccard.sketches(nodes).select(*[F.col(c).alias(f"{c}_{to}") for c in ("node", "size", "n", *sketch.NAMES)])
    met = side("x").join(side("y"), F.col("node_x") < F.col("node_y")).where(jaccard._may_link("x", "y", 85))
    left = {(r["node_x"], r["node_y"]) for r in met.select("node_x", "node_y").collect()}
    plain = [set(s.tolist()) for s in sets]
    near = {(a, b) for a in range(80) for b in range(a + 1, 80) if 100 * len(plain[a] & plain[b]) >= 85 * len(plain[a] | plain[b])}
    assert near <= left and len(near) > 300 and len(left) < len(near) + 0.35 * (3160 - len(near))
    pairs = spark.createDataFrame(sorted(left), "a long, b long")
    assert {tuple(r) for r in jaccard._linked(pairs, nodes, 85).collect()} == near


def test_wider_sketches_of_long_lines_lose_no_link_and_leave_fewer_pairs(spark):
    draw = random.Random(18)
    base = [draw.choice("abcdefghijklmnop ") for _ in range(700)]
    family = ["", "short", "short!"]
    for _ in range(60):
        copy = list(base)
        for _ in range(draw.randrange(1, 14)):
            copy[draw.randrange(len(copy))] = draw.choice("0123456789")
        family.append("".join(copy))
    n_lines = len(family)
    texts = spark.createDataFrame(list(enumerate(family)), "node long, line string")
    pairs = texts.select(F.col("node").alias("a")).crossJoin(texts.select(F.col("node").alias("b"))).where("a < b")
    grams = [{line[k : k + 9] for k in range(max(1, len(line) - 8))} for line in family]
    near = {
        (a, b) for a in range(n_lines) for b in range(a + 1, n_lines)
        if 100 * len(grams[a] & grams[b]) >= 80 * len(grams[a] | grams[b])
    }
    narrow = {tuple(r) for r in lines._within_bound(pairs, lines.sketches(texts)).collect()}
    wide = {tuple(r) for r in lines._within_wide_bound(pairs, texts).collect()}
    false = lambda left: len(left - near)
    assert near <= wide <= narrow and len(near) > 100 and false(narrow) > 100 and false(wide) < 0.6 * false(narrow)
    held = {r["node"]: r for r in lines.wide_sketches(texts).collect()}
    assert all(sum(w.bit_count() if w >= 0 else (w + 2**64).bit_count() for w in r["words"]) == r["bits"] for r in held.values())
    assert all(len(r["words"]) == lines.WIDE_WORDS and r["n"] == max(1, len(family[n]) - 8) for n, r in held.items())


def test_a_bound_counts_the_bits_of_two_sketches_once(spark):
    """More, and the condition of a join is a method too long for the virtual machine's compiler."""
    texts = spark.createDataFrame([(1, "one line"), (2, "another line")], "node long, line string")
    x = lines.sketches(texts).select(*lines._sketch("x"))
    y = lines.sketches(texts).select(*lines._sketch("y"))
    plan = x.join(y, lines._may_link("x", "y"))._jdf.queryExecution().optimizedPlan()
    joins = [line for line in plan.toString().splitlines() if "Join" in line]
    assert len(joins) == 1 and joins[0].count("bit_count") == sketch.WORDS


def test_a_setting_is_taken_back(spark):
    name = "spark.sql.codegen.aggregate.fastHashMap.capacityBit"
    before = spark.conf.get(name, None)
    with pytest.raises(ValueError, match="stop"), setting(spark, name, "18"):
        assert spark.conf.get(name) == "18"
        raise ValueError("stop")
    assert spark.conf.get(name, None) == before


@pytest.mark.parametrize("spread", [0.02, 0.33])
def test_links_of_tiles_equal_brute_force(monkeypatch, spread):
    """Clusters far apart (few blocks are open between chunks) and vectors in all directions."""
    monkeypatch.setattr(embeddings, "_CHUNK", 8)
    draw, width = np.random.default_rng(19), 24
    centers = draw.normal(size=(20, width))
    rows = np.concatenate([c + spread * draw.normal(size=(9, width)) for c in centers] + [centers + 0.25 * draw.normal(size=centers.shape)])
    units = embeddings._units(rows)
    variances, axes = np.linalg.eigh(units.T @ units)
    blocks = embeddings.blocks_of(variances, 8)
    shares = np.array([variances[b].sum() for b in blocks])
    budgets = 0.2 * shares / shares.sum()
    names, copies = np.arange(1000, 1000 + len(rows)), draw.integers(1, 4, len(rows))
    cut = 111
    parts = [
        embeddings._Tile(names[at].astype("<i8").tobytes(), copies[at].astype("<i8").tobytes(), rows[at].tobytes(), width, "<f8", axes)
        for at in (slice(0, cut), slice(cut, None))
    ]
    counts, up = np.zeros(len(rows), int), np.arange(len(rows))
    for x, y in ((0, 0), (0, 1), (1, 1)):
        found = embeddings._links_between(parts[x], parts[y], blocks, budgets, 0.9).to_pydict()
        for node, to, links in zip(*(found[c] for c in ("node", "to", "links")), strict=True):
            counts[node - 1000] += links
            a, b = up[node - 1000], up[to - 1000]
            up[up == max(a, b)] = min(a, b)
    alike = units @ units.T >= 0.9
    np.fill_diagonal(alike, False)
    assert counts.tolist() == (alike @ copies).tolist() and alike.sum() > 20
    plain = np.arange(len(rows))
    for _ in rows:
        plain = np.minimum(plain, np.where(alike, plain, len(rows)).min(axis=1))
    assert up.tolist() == plain.tolist()
    if spread < 0.1:
        opened = embeddings._open_blocks(parts[0], parts[1], blocks, budgets).sum(axis=2)
        assert (opened == 0).any() and ((opened > 0) & (opened <= embeddings._FEW)).any()


def test_tiles_meet_without_a_shuffle(spark):
    """Each vector was sent once per block and tile that its own one meets: 731 MB of 20."""
    draw, n = np.random.default_rng(20), 3000
    rows = [(k, 1, [float(x) for x in v]) for k, v in enumerate(draw.normal(size=(n, 12)).astype(np.float32))]
    nodes = spark.createDataFrame(rows, "node long, copies long, vector array<float>")
    axes, _ = embeddings.rotation(nodes, 12)
    tiled = embeddings.tiles(nodes, n, 12, axes)
    held = tiled.collect()
    assert sorted(x for r in held for x in np.frombuffer(r["nodes"], "<i8").tolist()) == list(range(n))
    assert len(held) >= 10 and all(len(r["nodes"]) <= 8 * embeddings._LEAST_TILE for r in held)
    met = embeddings._meet(tiled, 0.9)
    assert "Exchange hashpartitioning" not in met._jdf.queryExecution().executedPlan().toString()
    assert met.count() == len(held) * (len(held) + 1) // 2
    far = spark.createDataFrame([(1, [0.9, 0.0], [1.0, 0.1]), (2, [-1.0, 0.0], [-0.9, 0.1])], "tile long, low array<double>, high array<double>")
    assert {(r["tile_a"], r["tile_b"]) for r in embeddings._meet(far, 0.9).collect()} == {(1, 1), (2, 2)}


def test_own_shingles_come_packed_and_are_counted_whole():
    """A row per bucket and part of the nodes, not one per bucket and node."""
    import pyarrow as pa

    draw = random.Random(21)
    texts = [*_varied(draw, 300, 60), *[" ".join(["same"] * 50 + [f"x{n}"]) for n in range(20)], "", None]
    texts += [" ".join([*texts[0].split()[:-1], "end"])]
    sets = jaccard.shingle_sets(pa.array(texts, pa.string()), 5)
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["_text"])
    bits = 6
    packed = pa.Table.from_batches(list(jaccard._packed(5, bits)(iter([batch]))))
    found = []
    for number in sorted(set(packed.column("bucket").to_pylist())):
        found.append(jaccard._own(bits)(packed.filter(pa.compute.equal(packed.column("bucket"), number))))
    found = pa.concat_tables(found)
    assert found.num_rows <= 64 * 64 and sum(len(x) // 8 for x in found.column("nodes").to_pylist()) > 300 * 30
    several = {x for k, s in enumerate(sets) for x in s.tolist() if any(x in t for t in map(set, (s.tolist() for s in sets[:k])))}
    own = {jaccard._name(s): (len(s), sum(x not in several for x in s.tolist())) for s in sets if len(s)}
    for percent in (80, 20):
        done = set()
        for part in sorted(set(found.column("part").to_pylist())):
            done |= set(jaccard._done(percent)(found.filter(pa.compute.equal(found.column("part"), part))).column("node").to_pylist())
        assert done == {node for node, (size, n) in own.items() if n and n >= size - (size * percent + 99) // 100 + 1}
    assert 250 < len(done) < len(own)
