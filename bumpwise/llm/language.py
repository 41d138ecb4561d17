"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A trigram binds the
vectors of its three symbols, each permuted (rolled) by its place, by multiplication; a text
bundles its trigrams by addition, and so does a language over all its training texts. A text gets
the language whose profile has the largest cosine to its own. Runs of anything but letters are one
boundary symbol; trigrams with a boundary in the middle are left out.

Profiles are whole numbers, so their sums do not depend on the order. What goes to the driver is
one profile per language: `DIMENSIONS` numbers times the languages taught.

Nulls: a null text, or one without a letter, is `und` with score 0. Rows with a null language teach
nothing, and with nothing taught every text is `und`. Ties go to the language first by code point.
Repeated rows count and are answered each time. Texts are read whole. An empty table gives an
empty result. Columns of the input other than those asked for play no part.

Memory: a text is never cut, but the vectors of its trigrams are made some thousands at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bumpwise.llm.common import fold, table

DIMENSIONS = 512
SEED = 863
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
_CHUNK_CHARS = 1 << 19
_KEPT_TRIGRAMS = 1 << 16  # vectors kept of a chunk; of more distinct trigrams they are made in slices
_AT_ONCE = 4096


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=1 << 14)
def _letter_vector(code: int) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, DIMENSIONS)
    return (2 * bits - 1).astype(np.int8)


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(first place, lower-case texts) of at most about _CHUNK_CHARS characters, whole texts each."""
    chunk, first, chars = [], 0, 0
    for place, text in enumerate(texts):
        chunk.append((text or "").lower())
        chars += len(chunk[-1])
        if chars >= _CHUNK_CHARS:
            yield first, chunk
            chunk, first, chars = [], place + 1, 0
    if chunk:
        yield first, chunk


class Bound:
    """The vectors of distinct trigrams, made for those asked for, or kept if there are few."""

    def __init__(self, letters: np.ndarray, first: np.ndarray, second: np.ndarray, third: np.ndarray):
        self.rolled = [np.roll(letters, turn, axis=1) for turn in (2, 1)] + [letters]
        self.places = (first, second, third)
        self.kept = self._made(slice(None)) if len(first) <= _KEPT_TRIGRAMS else None

    def _made(self, rows) -> np.ndarray:
        parts = [vectors[places[rows]] for vectors, places in zip(self.rolled, self.places, strict=True)]
        return parts[0] * parts[1] * parts[2]

    def bundle(self, counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The sum of the trigrams' vectors, each as often as counted, some thousands at a time."""
        total = np.zeros(DIMENSIONS)
        for start in range(0, len(rows), _AT_ONCE):
            some = rows[start : start + _AT_ONCE]
            vectors = self._made(some) if self.kept is None else self.kept[some]
            # counts and sums are whole numbers; a slice's sums stay far below 2**24
            weights = counts[start : start + _AT_ONCE]
            kind = np.float32 if weights.sum() < 1 << 24 else np.float64
            total += weights.astype(kind) @ vectors.astype(kind)
        return total


def trigrams(texts: list[str], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, Bound]:
    """(group, trigram, count) of the texts' trigrams and the trigrams' vectors.

    `groups` says which group each text counts for. Returns groups and counts, aligned with the
    trigrams' rows in the vectors: (2 x n of group and count, rows, vectors).
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.asarray(groups, np.int64), lengths)
    present = np.flatnonzero(np.bincount(codes, minlength=1))
    letters = present[_is_letter()[present]]
    index = np.zeros(int(present[-1]) + 1, np.int64)
    index[letters] = np.arange(1, len(letters) + 1)
    symbols = index[codes]
    kept = symbols != 0
    kept[1:] |= symbols[:-1] != 0  # of a run of boundaries the first stays
    symbols, owner = symbols[kept], owner[kept]
    symbols = np.concatenate(([0], symbols, [0]))
    base = len(letters) + 1
    middle = symbols[1:-1]
    inside = middle != 0
    grams = ((symbols[:-2] * base + middle) * base + symbols[2:])[inside]
    owner = owner[inside]
    different, rows = np.unique(grams, return_inverse=True)
    pairs, counts = np.unique(owner * max(1, len(different)) + rows, return_counts=True)
    group, row = np.divmod(pairs, max(1, len(different)))
    # the boundary's vector is drawn from code point 0, which is no letter
    vectors = np.stack([_letter_vector(int(code)) for code in (0, *letters)])
    first, second, third = different // base**2, different // base % base, different % base
    return np.stack((group, counts)), row, Bound(vectors, first, second, third)


def _teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per language and dimension: the bundled trigrams of this task's texts."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, languages = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        for first, chunk in _chunks(texts):
            names = sorted(set(languages[first : first + len(chunk)]))
            place = {name: at for at, name in enumerate(names)}
            groups = np.array([place[x] for x in languages[first : first + len(chunk)]])
            (group, counts), rows, bound = trigrams(chunk, groups)
            for at, name in enumerate(names):
                mine = group == at
                total = np.rint(bound.bundle(counts[mine], rows[mine])).astype(np.int64)
                sums[name] = sums.get(name, 0) + total
    names = [name for name in sums for _ in range(DIMENSIONS)]
    places = np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(sums))
    values = np.concatenate(list(sums.values())) if sums else np.empty(0, np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array(places), pa.array(values)], ["lang", "place", "value"]
    )


def learn(documents: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, one profile each) from all rows with a language."""
    rows = (
        documents.where(F.col("lang").isNotNull())
        .select("text", "lang")
        .mapInArrow(_teach, "lang string, place int, value long")
        .groupBy("lang", "place")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    languages = sorted({row["lang"] for row in rows})
    at = {name: place for place, name in enumerate(languages)}
    profiles = np.zeros((len(languages), DIMENSIONS))
    for row in rows:
        profiles[at[row["lang"]], row["place"]] = row["value"]
    return languages, profiles


def _answer(
    languages: list[str], profiles: np.ndarray, keep: list[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    norms = np.linalg.norm(profiles, axis=1, keepdims=True) if len(languages) else np.ones((0, 1))
    units = (profiles / np.where(norms == 0, 1, norms)).T

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for first, chunk in _chunks(texts) if languages else ():
                (group, counts), rows, bound = trigrams(chunk, np.arange(len(chunk)))
                edges = np.searchsorted(group, np.arange(len(chunk) + 1))
                for at in range(len(chunk)):
                    start, end = edges[at], edges[at + 1]
                    if start == end:
                        continue
                    vector = bound.bundle(counts[start:end], rows[start:end])
                    cosines = vector @ units / max(np.linalg.norm(vector), 1e-300)
                    best = int(np.argmax(cosines))
                    names[first + at] = languages[best]
                    scores[first + at] = min(1.0, max(0.0, float(cosines[best])))
            kept = [batch.column(name) for name in keep]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names, pa.string()), pa.array(scores)], [*keep, "lang_pred", "score"]
            )

    return work


def identify(
    documents: DataFrame, model: tuple[list[str], np.ndarray], keep: dict[str, Column]
) -> DataFrame:
    """`keep` (name -> expression) with `lang_pred` and `score` for each row of `documents`."""
    rows = documents.select(F.col("text").alias("_text"), *[c.alias(n) for n, c in keep.items()])
    shape = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n != "_text")
    return rows.mapInArrow(
        _answer(*model, list(keep)), f"{shape}, lang_pred string, score double"
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = learn(documents.where(fold("doc_id", FOLDS) != HELD_OUT))
    keep = {"doc_id": F.col("doc_id"), "held_out": fold("doc_id", FOLDS) == HELD_OUT}
    return identify(documents, model, keep)
