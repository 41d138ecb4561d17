from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from conftest import SMALL
from llm_fixtures import documents  # noqa: F401


def test_stages_follow_each_other(spark, path_for):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = {row["doc_id"]: row for row in docs.collect()}
    counts = [len(given)]
    for name, stage in corpus_pipeline.STAGES:
        folder = path_for(name)
        stage(spark, docs, SMALL).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if name != "tokens":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    for row in docs.collect():
        kept, whole = row["text"].split("\n"), given[row["doc_id"]]["text"].split("\n")
        places = iter(whole)
        assert all(line in places for line in kept)  # lines in order, none changed
        assert row["n_tokens"] == len(row["ids"]) > 0


def test_copies_go_and_nulls_do_no_harm(spark, documents, tmp_path):
    draw = random.Random(1)
    text = lambda: ". ".join(" ".join(draw.choice(["alpha", "beta", "gamma", "delta", "rho"]) + str(draw.randrange(99)) for _ in range(12)) for _ in range(6)) + "."
    rows = [(i, text(), "en", f"s{i % 2}") for i in range(40)]
    rows += [(100 + i, rows[i][1], "en", None) for i in range(5)] + [(200, None, "en", "s0"), (201, "", None, None), (None, "12 34", "en", "s1")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = [r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert len(found) == len(set(found)) and set(found) <= set(range(40))
    assert len(found) > 20
    documents([]).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_copies_give_the_mix_its_weights(spark, documents, path_for):
    draw = random.Random(2)
    text = lambda: " ".join(f"w{draw.randrange(999)}" for _ in range(draw.randrange(20, 60)))
    rows = [(i, text(), "en", f"s{i % 3}") for i in range(300)]
    rows += [(300, "one two three", "en", "s2"), (300, "one two three", "en", "s2"), (None, "one two", "en", "s2")]
    folder = path_for("mixed")
    corpus_pipeline.mixed(spark, documents(rows), SMALL).write.parquet(folder)
    told = corpus_pipeline.tokens(spark, spark.read.parquet(folder), SMALL).collect()
    sizes, found = Counter(), Counter()
    for _, words, _, source in rows:
        sizes[source] += len(words.split())
    for row in told:
        found[row["source"]] += row["copies"] * len(row["text"].split())
    for place in range(3):  # weights 1, 2, 3
        assert abs(found[f"s{place}"] - sum(sizes.values()) * (place + 1) / 6) <= 1
    assert len({r["doc_id"] for r in told}) == len(told) and {1, 2} <= {r["copies"] for r in told}
    assert {r["copies"] for r in corpus_pipeline.tokens(spark, documents(rows), SMALL).collect()} == {1}
