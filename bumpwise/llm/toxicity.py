"""Toxicity by class-conditional Kneser-Ney models.

Two models spell a word letter by letter, one for toxic and one for ordinary text: the chance of
the next letter given the letters so far. They count as Kneser and Ney do, not occurrences but
contexts: in how many different (preceding word, word) pairs a class has a beginning of a word, so
repeats and copies weigh nothing. A class takes a discount from its counts and adds `BACKOFF`
counts spread by one shared model, the pooled counts of both classes, which in turn back off to the
letters alone. An expression that is rare in a class is thus judged by shared counts and says
next to nothing.

A word is read to its end, however long: after `LONGEST` letters, or once neither class has a word
that begins so, the letters so far give way to a sliding history of up to `LONGEST` - 1 letters, as
in compounds and in scripts without blanks. There a class backs off from the longest history to
its own shorter ones, of one letter at least: a letter says nothing there without the one before
it, and nothing more by a history after which neither class has it.

What a word says is log p(word | toxic) - log p(word | ordinary). A document's ratio is the sum of
what all its words say, for either class, divided by their number. Beside it stands `telling`, the
same sum over what single words say beyond `EVIDENCE`: few strong words in a long text. To either,
`PRIOR_WORDS` words that say nothing are added, so that a short text is not judged by one word.

The model is fitted on a bounded sample: labelled documents with the smallest seeded hashes, with
their whole texts, as many of either class and at most `SAMPLE_PER_CLASS`, as far as a class has
`SAMPLE_CHARS` characters; a document of more than an eighth of these is not learned from. Three
quarters of the sample give the counts, one quarter fits the logistic curve that turns both figures
into a score. Every text is scored.

Nulls: a null text is an empty one; a text without a letter has figures of 0. Labels that are null are
ignored; a document with several labels is toxic if one of them is. Without labels of both classes
every score is 0. Repeated rows are scored each. An empty table gives an empty result. Labels,
language, source and id are no inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bumpwise.llm.common import fold, stored, table

SAMPLE_PER_CLASS = 4000
SAMPLE_CHARS = 1 << 24  # of a class
SEED = "toxic-1"
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
LONGEST = 8  # letters (and the end of the word) that are told apart at once
DISCOUNT = 0.75
BACKOFF = 30.0
EVIDENCE = 1.5
PRIOR_WORDS = 30.0  # words that say nothing, which each text is taken to have
TOWARDS = (0.0, 2.0)  # where few labels leave the curve: slopes by standard deviation of the figures
START, END = "\x02", "\x03"
_WORD = re.compile(r"[^\W\d_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_CACHED_WORDS, _CACHED_CHARS = 300_000, 1 << 23
_CHUNK_CHARS = 1 << 21
_PIECE = 1 << 18


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different (toxic, preceding word, word) of each batch."""
    for batch in batches:
        pairs: set[tuple[int, str, str]] = set()
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            words = words_of(text)
            pairs.update((toxic, a, b) for a, b in zip(["", *words], words, strict=False))
        columns = list(zip(*pairs, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
            ["toxic", "before", "word"],
        )


def vocabulary(chosen: DataFrame) -> DataFrame:
    """`word, toxic, n`: in how many different pairs a class has a word."""
    pairs = chosen.select("text", "toxic").mapInArrow(_pairs, "toxic int, before string, word string")
    return pairs.distinct().groupBy("word", "toxic").agg(F.count(F.lit(1)).alias("n"))


def beginnings(words: DataFrame) -> DataFrame:
    """`beginning, ordinary, toxic`: in how many pairs of each class words begin so."""
    spelled = F.concat("word", F.lit(END))
    sizes = F.sequence(F.lit(1), F.least(F.char_length(spelled), F.lit(LONGEST)))
    parts = words.select("toxic", "n", F.explode(F.transform(sizes, lambda k: F.substring(spelled, 1, k))).alias("beginning"))
    of = lambda toxic: F.sum(F.when(F.col("toxic") == toxic, F.col("n")).otherwise(0))
    return parts.groupBy("beginning").agg(of(0).alias("ordinary"), of(1).alias("toxic"))


def _spelled(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of all words with their starts and ends; of each its place in its word, and the
    word's number."""
    text = "".join([f"{START}{word}{END}" for word in words])
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter((len(word) + 2 for word in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    return codes, np.arange(len(codes)) - (np.cumsum(lengths) - lengths)[owner], owner


def _slides(codes: np.ndarray, depth: np.ndarray, places: np.ndarray) -> Iterator[tuple]:
    """By size from 2: which of `places` have size - 1 symbols before them in their word, hashes of
    these symbols, and hashes of them and the place's own."""
    which, history, power = np.arange(len(places)), np.zeros(len(places), np.uint64), 1
    for size in range(2, LONGEST + 1):
        far = depth[places] >= size - 1
        which, places = which[far], places[far]
        history = history[far] + codes[places - size + 1] * np.uint64(power)
        power = power * int(_MULTIPLIER) & 0xFFFFFFFFFFFFFFFF
        yield size, which, history, history * _MULTIPLIER + codes[places]


def _slid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The histories and letters of each batch of words, with their counts."""
    for batch in batches:
        codes, depth, owner = _spelled(batch.column("word").to_pylist())
        n, toxic = batch.column("n").to_numpy(), batch.column("toxic").to_numpy() == 1
        every = np.flatnonzero(depth > 0)
        for start in range(0, len(every), _PIECE):
            places = every[start : start + _PIECE]
            for size, which, history, gram in _slides(codes, depth, places):
                word = owner[places[which]]
                keys, first, at = np.unique(gram, return_index=True, return_inverse=True)
                of = lambda chosen: np.bincount(at, n[word] * chosen[word], len(keys)).astype(np.int64)  # noqa: B023, E731
                columns = [np.full(len(keys), size, np.int32), keys.view(np.int64), history[first].view(np.int64), of(~toxic), of(toxic)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["size", "gram", "history", "ordinary", "toxic"])


def slides(words: DataFrame) -> DataFrame:
    """`size, gram, history, ordinary, toxic`: how often, over the pairs of each class, a letter
    (or the end) comes after the size - 1 symbols before it; both as hashes."""
    parts = words.mapInArrow(_slid, "size int, gram long, history long, ordinary long, toxic long")
    return parts.groupBy("size", "gram").agg(
        F.min("history").alias("history"), F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")
    )


def _hashes(texts: list[str]) -> np.ndarray:
    """Polynomial hash of texts of one length."""
    if not texts:
        return np.empty(0, np.uint64)
    if not texts[0]:
        return np.zeros(len(texts), np.uint64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    total = np.zeros(len(texts), np.uint64)
    for column in codes.reshape(len(texts), -1).astype(np.uint64).T:
        total = total * _MULTIPLIER + column
    return total


@dataclass(frozen=True)
class Level:
    """Beginnings of one length: the counts of (ordinary, toxic), and of the beginnings one letter
    shorter the totals and numbers of different next letters, of (ordinary, toxic, both)."""

    keys: np.ndarray
    counts: np.ndarray
    histories: np.ndarray
    totals: np.ndarray
    types: np.ndarray


@dataclass(frozen=True)
class Model:
    levels: tuple[Level, ...]  # by length, from 1
    letters: dict[int, float]  # share of the different beginnings that end in a letter
    slides: tuple[Level, ...]  # of sliding histories, by size from 2; (ordinary, toxic) only


def _sliding(counts: pa.Table) -> Level:
    """From `gram, history, ordinary, toxic` of one size."""
    keys, given = counts.column("gram").to_numpy().view(np.uint64), np.empty((counts.num_rows, 2), np.float32)
    given[:, 0], given[:, 1] = counts.column("ordinary").to_numpy(), counts.column("toxic").to_numpy()
    histories, at = np.unique(counts.column("history").to_numpy().view(np.uint64), return_inverse=True)
    totals, types = np.empty((len(histories), 2), np.float32), np.empty((len(histories), 2), np.float32)
    for k in (0, 1):
        totals[:, k] = np.bincount(at, given[:, k], len(histories))
        types[:, k] = np.bincount(at, given[:, k] > 0, len(histories))
    order = np.argsort(keys)
    return Level(keys[order], given[order], histories, totals, types)


def build(words: DataFrame) -> Model | None:
    """The model, from a stored `vocabulary`; None without words of both classes. The sizes of
    `slides` come to the driver one after another."""
    counts = beginnings(words).toArrow().to_pandas()
    if counts.empty or not counts["ordinary"].sum() or not counts["toxic"].sum():
        return None
    last = counts["beginning"].str[-1].value_counts(normalize=True)
    levels = []
    for size in range(1, LONGEST + 1):
        given = counts[counts["beginning"].str.len() == size]
        by_class = given[["ordinary", "toxic"]].to_numpy(float)
        three = np.column_stack((by_class, by_class.sum(axis=1)))
        history = given["beginning"].str[:-1].to_numpy()
        totals, types = (pd.DataFrame(x).groupby(history).sum() for x in (three, three > 0))
        keys, histories = _hashes(given["beginning"].tolist()), _hashes(totals.index.tolist())
        a, b = np.argsort(keys), np.argsort(histories)
        levels.append(
            Level(keys[a], by_class[a], histories[b], totals.to_numpy(float)[b], types.to_numpy(float)[b])
        )
    letters = {ord(letter): float(share) for letter, share in last.items()}
    del counts, given, history
    slid = stored(slides(words), "toxicity-slides")
    sliding = [_sliding(slid.where(F.col("size") == size).drop("size").toArrow()) for size in range(2, LONGEST + 1)]
    return Model(tuple(levels), letters, tuple(sliding))


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Rows of `values` for the wanted keys, zeros where there is none."""
    if not len(keys):
        return np.zeros((len(wanted), values.shape[1]))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((keys[at] == wanted)[:, None], values[at], 0.0)


def _alone(model: Model, letters: np.ndarray) -> np.ndarray:
    different, place = np.unique(letters, return_inverse=True)
    return np.maximum(np.array([model.letters.get(int(code), 0.0) for code in different])[place], 1e-6)


def _slid_ratios(model: Model, codes: np.ndarray, depth: np.ndarray, places: np.ndarray) -> np.ndarray:
    """What the symbols at `places` say after their sliding histories."""
    chance = np.repeat(_alone(model, codes[places])[:, None], 2, axis=1)
    for (_, which, history, gram), level in zip(_slides(codes, depth, places), model.slides, strict=True):
        counts = _found(level.keys, level.counts, gram)
        seen = counts.sum(axis=1) > 0
        which, counts, history = which[seen], counts[seen], history[seen]
        totals, types = (_found(level.histories, x, history) for x in (level.totals, level.types))
        backed = (DISCOUNT * types + BACKOFF) * chance[which]
        chance[which] = (np.maximum(counts - DISCOUNT, 0) + backed) / (totals + BACKOFF)
    return np.log(chance[:, 1]) - np.log(chance[:, 0])


def word_ratios(model: Model, words: list[str]) -> np.ndarray:
    """log p(word | toxic) - log p(word | ordinary) of each word."""
    codes, depth, owner = _spelled(words)
    starts = np.flatnonzero(depth == 0) + 1
    lengths = np.diff(np.append(starts, len(codes) + 1)) - 1
    told = np.zeros(len(words), np.int64)  # letters of each word that a known beginning precedes
    ratio, rows, before = np.zeros(len(words)), np.arange(len(words)), np.zeros(len(words), np.uint64)
    for size, level in enumerate(model.levels, start=1):
        longer = lengths[rows] >= size
        rows, before = rows[longer], before[longer]
        letter = codes[starts[rows] + size - 1]
        totals = _found(level.histories, level.totals, before)
        seen = totals[:, 2] > 0  # a beginning that neither class has says nothing more
        rows, before, letter, totals = rows[seen], before[seen], letter[seen], totals[seen]
        told[rows] = size
        types = _found(level.histories, level.types, before)
        before = before * _MULTIPLIER + letter
        counts = _found(level.keys, level.counts, before)
        both = np.maximum(counts.sum(axis=1) - DISCOUNT, 0) + DISCOUNT * types[:, 2] * _alone(model, letter)
        shared = (both / totals[:, 2])[:, None]
        chance = np.maximum(counts - DISCOUNT, 0) + (DISCOUNT * types[:, :2] + BACKOFF) * shared
        chance = np.log(chance / (totals[:, :2] + BACKOFF))
        ratio[rows] += chance[:, 1] - chance[:, 0]
    beyond = np.flatnonzero(depth > told[owner])
    for start in range(0, len(beyond), _PIECE):
        places = beyond[start : start + _PIECE]
        ratio += np.bincount(owner[places], _slid_ratios(model, codes, depth, places), len(words))
    return ratio


Curve = tuple[float, float, float]  # slopes of ratio and telling, offset


def _rate(model: Model | None, curve: Curve | None, keep: list[str]) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        cached = 0
        for batch in batches:
            figures: list[tuple[float, float]] = []
            chunk: list[list[str]] = []
            chars = 0

            def settle() -> None:
                nonlocal chars, cached
                words = set().union(*chunk)
                missing = list(words.difference(known))
                if len(known) + len(missing) > _CACHED_WORDS or cached + chars > _CACHED_CHARS:
                    known.clear()
                    cached, missing = 0, list(words)
                if missing:
                    known.update(zip(missing, word_ratios(model, missing).tolist(), strict=True))
                    cached += sum(map(len, missing))
                for words in chunk:
                    said = list(map(known.__getitem__, words))
                    telling = math.fsum([each - EVIDENCE for each in said if each > EVIDENCE])
                    figures.append((math.fsum(said) / (len(words) + PRIOR_WORDS), telling / (len(words) + PRIOR_WORDS)))
                chunk.clear()
                chars = 0

            for text in batch.column("_text").to_pylist():
                chunk.append(words_of(text) if model else [])
                chars += len(text or "")
                if chars > _CHUNK_CHARS:
                    settle()
            settle()
            both = np.array(figures).reshape(-1, 2)
            if curve is None:
                score = np.zeros(len(both))
            else:
                score = 1 / (1 + np.exp(-np.clip(both @ np.array(curve[:2]) + curve[2], -50, 50)))
            kept = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(score)], [*keep, "ratio", "telling", "score"]
            )

    return work


def rate(
    documents: DataFrame,
    model: Model | None,
    curve: Curve | None,
    keep: dict[str, Column],
) -> DataFrame:
    """`keep` (name -> expression) with `ratio`, `telling` and `score` for each row of `documents`."""
    rows = documents.select(F.col("text").alias("_text"), *[c.alias(n) for n, c in keep.items()])
    shape = "".join(f"`{n}` {t}, " for n, t in rows.dtypes if n != "_text")
    return rows.mapInArrow(_rate(model, curve, list(keep)), f"{shape}ratio double, telling double, score double")


def fit_curve(figures: np.ndarray, toxic: np.ndarray) -> Curve:
    """Slopes and offset of a logistic curve over two figures, slightly drawn to `TOWARDS`, by
    Newton's method in short steps. A figure that is the same everywhere, or that would lower a
    score by speaking for toxic, gets no slope."""
    scale, towards = figures.std(axis=0), np.array(TOWARDS)
    weight = np.where(toxic == 1, 0.5 / max(1, (toxic == 1).sum()), 0.5 / max(1, (toxic == 0).sum()))
    weight *= len(toxic)
    used = np.flatnonzero(scale > 1e-9)
    while True:
        x = np.column_stack((figures[:, used] / scale[used], np.ones(len(figures))))
        goal = np.append(towards[used], -towards[used] @ x[:, :-1].mean(axis=0))
        drawn, coefficients = np.diag([1.0] * len(used) + [0.1]), np.zeros(len(used) + 1)
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x @ coefficients, -50, 50)))
            slope = x.T @ (weight * (p - toxic)) + drawn @ (coefficients - goal)
            bend = (x * (weight * p * (1 - p))[:, None]).T @ x + drawn
            step = np.clip(np.linalg.solve(bend, slope), -1, 1)
            coefficients -= step
            if np.abs(step).max() < 1e-9:
                break
        if (coefficients[:-1] >= 0).all():
            break
        used = used[coefficients[:-1] >= 0]
    slopes = np.zeros(2)
    slopes[used] = coefficients[:-1] / scale[used]
    return float(slopes[0]), float(slopes[1]), float(coefficients[-1])


def sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id, text, toxic` of the documents to learn from, stored."""
    drawn = F.xxhash64(F.lit(SEED), F.col("doc_id"))
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {row["toxic"]: row["count"] for row in known.groupBy("toxic").count().collect()}
    most = min(SAMPLE_PER_CLASS, sizes.get(0, 0), sizes.get(1, 0))
    part = lambda toxic: known.where(F.col("toxic") == toxic).orderBy(drawn, "doc_id").limit(most)
    # bounded: 2 * SAMPLE_PER_CLASS rows of two numbers
    drawn_rows = F.broadcast(part(0).unionByName(part(1)))
    chosen = documents.select("doc_id", "text").where(F.char_length(F.coalesce("text", F.lit(""))) <= SAMPLE_CHARS // 8)
    chosen = stored(chosen.join(drawn_rows, "doc_id"), "toxicity-sample")
    chars = chosen.groupBy("doc_id", "toxic").agg(F.sum(F.char_length("text")).alias("chars"))
    # the rows of `drawn_rows`, so bounded too
    so_far = F.sum("chars").over(Window.partitionBy("toxic").orderBy(drawn, "doc_id"))
    fitting = chars.withColumn("so_far", F.coalesce(so_far, F.lit(0))).where(F.col("so_far") <= SAMPLE_CHARS)
    return chosen.join(F.broadcast(fitting.select("doc_id")), "doc_id")


def learn(documents: DataFrame, labels: DataFrame) -> tuple[Model | None, Curve | None]:
    """Fit on documents (doc_id, text) and labels (doc_id, toxic)."""
    chosen = sample(documents, labels)
    fitting = F.pmod(F.xxhash64(F.lit("part"), F.col("doc_id")), F.lit(4)) != 0
    words = stored(vocabulary(chosen.where(fitting)), "toxicity-words")
    model = build(words)
    if model is None:
        return None, None
    told = rate(chosen.where(~fitting), model, None, {"toxic": F.col("toxic")}).drop("score").toPandas()
    if told["toxic"].nunique() < 2:
        return model, (100.0, 100.0, -2.0)
    return model, fit_curve(told[["ratio", "telling"]].to_numpy(float), told["toxic"].to_numpy(float))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = labels.where(fold("doc_id", FOLDS) != HELD_OUT).select("doc_id", "toxic")
    model, curve = learn(documents, known)
    keep = {"doc_id": F.col("doc_id"), "held_out": fold("doc_id", FOLDS) == HELD_OUT}
    return rate(documents, model, curve, keep).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "ratio", "telling"
    )
