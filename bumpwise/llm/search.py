"""Ranked lexical search by range-maximum tables over posting lists.

Documents lie in blocks, in the order of their ids. A block keeps, for each term of the queries, the
places of the documents that hold it and its impact there (its part of the score), and over all
these lists one sparse table: row j holds, for each posting, the place of the largest impact among
the 2**j postings that start there. Two look-ups give the largest impact of a term in any interval
of documents, and their sum over a query's terms bounds every score in the interval.

A query starts with the whole block. It takes the intervals of the highest bounds first, scores the
document of the largest single impact in each exactly, and splits the interval there. It ends when
no remaining bound reaches the 10th best score, which a task carries from block to block. The best
of all tasks are merged by rank. Results are exact.

A first pass over the texts stores the blocks and counts; a second reads the blocks. Lists hold the
query terms only, so what is sent to the tasks is bounded by the queries: they are served in batches
of at most `QUERY_BATCH` items, chosen by a hash of the item, each a pass of its own. Texts are read
in slices, so a long one needs no large list of words.

Nulls: a null text has no terms, so the document is never found; a null id is a document and comes
after all others among equal scores; a null item text finds nothing. Empty texts likewise. Repeated
rows are documents of their own, with ranks of their own. Ties go by id. An empty table on either
side gives an empty result. Other columns are not read, so names cannot clash; repeated item ids
are items of their own only if their texts differ, equal rows give one answer.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bumpwise.llm.common import stored, table

TOP = 10
BLOCK_DOCUMENTS = 2048
BLOCK_POSTINGS = 1 << 19
QUERY_BATCH = 1024
# intervals that are split together
_WIDTH = 64
_SLICE = 1 << 20
_NO_ID = np.iinfo(np.int64).max

# fixed values: a term is a run of these bytes, in lower case (every byte of a character beyond
# ASCII is one of them)
_KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
_TO_TERMS = bytes(b if b in _KEPT else 32 for b in bytes(range(256)).lower())

_BLOCK = (
    "n_documents long, n_terms long, terms array<int>, sizes array<int>, ids binary, lengths binary, "
    "places binary, counts binary"
)
_FOUND = "query int, score long, doc_id long, known boolean"


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded size."""
    data = (text or "").encode("utf-8", "surrogatepass")
    at = 0
    while at < len(data):
        end = at + _SLICE
        words = data[at:end].translate(_TO_TERMS)
        if end < len(data):
            cut = words.rfind(b" ")
            while cut < 0 and end < len(data):  # one term longer than the slice
                end += _SLICE
                words = data[at:end].translate(_TO_TERMS)
                cut = words.rfind(b" ")
            if end < len(data):
                words, end = words[:cut], at + cut + 1
        yield words.split()
        at = end


def counted(text: str | None) -> Counter:
    counts: Counter = Counter()
    for words in terms_of(text):
        counts.update(words)
    return counts


class _Block:
    """Documents and the postings of query terms, until they are packed."""

    def __init__(self):
        self.ids, self.lengths, self.terms, self.places, self.counts = [], [], [], [], []

    def add(self, doc_id: int | None, text: str | None, known: dict[bytes, int]) -> None:
        length, found = 0, {}
        for words in terms_of(text):
            length += len(words)
            for word, count in Counter(words).items():
                if (term := known.get(word)) is not None:
                    found[term] = found.get(term, 0) + count
        if length:
            self.terms += found.keys()
            self.counts += found.values()
            self.places += [len(self.ids)] * len(found)
            self.ids.append((doc_id is None, doc_id or 0))
            self.lengths.append(length)

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCUMENTS or len(self.terms) >= BLOCK_POSTINGS

    def packed(self) -> pa.RecordBatch:
        """One row: documents in the order of ids, postings in the order of term and document."""
        order = sorted(range(len(self.ids)), key=self.ids.__getitem__)
        ids = np.array([_NO_ID if self.ids[i][0] else self.ids[i][1] for i in order], np.int64)
        lengths = np.array(self.lengths, np.int64)[order]
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        terms = np.array(self.terms, np.int32)
        places = rank[np.array(self.places, np.int32)] if len(terms) else np.empty(0, np.int32)
        by = np.lexsort((places, terms))
        listed, sizes = np.unique(terms, return_counts=True)
        row = {
            "n_documents": [len(ids)],
            "n_terms": [int(lengths.sum())],
            "terms": [listed.tolist()],
            "sizes": [sizes.tolist()],
            # null ids stand at the end; their number tells them from the largest id
            "ids": [ids.tobytes() + int(sum(null for null, _ in self.ids)).to_bytes(8, "little")],
            "lengths": [lengths.tobytes()],
            "places": [places[by].astype(np.int32).tobytes()],
            "counts": [np.array(self.counts, np.int64)[by].tobytes()],
        }
        shape = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), shape, strict=True)], list(row))


def _indexed(vocabulary) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block = vocabulary.value, _Block()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block.add(doc_id, text.as_py(), known)
                if block.full():
                    yield block.packed()
                    block = _Block()
        if block.ids:
            yield block.packed()

    return work


def weight(n_documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df + 1)))


class Lists:
    """The posting lists of a block with their impacts and sparse tables of range maxima.

    `keys` is term * documents + place, ascending, so one search finds a place in any list.
    """

    def __init__(self, terms: np.ndarray, sizes: np.ndarray, places: np.ndarray, impacts: np.ndarray, documents: int):
        self.documents, self.places, self.impacts = documents, places, impacts
        slot = np.repeat(np.arange(len(terms), dtype=np.int64), sizes)
        self.keys = slot * documents + places
        self.slots = {int(term): at for at, term in enumerate(terms)}
        best = np.arange(len(places), dtype=np.int32)
        self.tables, width = [best], 1
        while 2 * width <= (int(sizes.max()) if len(sizes) else 0):
            # rows may reach into the next list at its end; no look-up asks for those
            later = np.concatenate([best[width:], best[-width:]])
            best = np.where(impacts[later] > impacts[best], later, best)
            self.tables.append(best)
            width *= 2
        self.stacked = np.stack(self.tables) if len(places) else np.empty((1, 0), np.int32)

    def largest(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The posting of the largest impact in [first, last) of each pair, -1 where it is empty."""
        length = last - first
        some = length > 0
        level = np.zeros(length.shape, np.int64)
        level[some] = np.frexp(length[some].astype(np.float64))[1] - 1
        left = np.where(some, first, 0)
        right = np.where(some, last - (1 << level), 0)
        one, two = self.stacked[level, left], self.stacked[level, right]
        return np.where(some, np.where(self.impacts[two] > self.impacts[one], two, one), -1)

    def starts(self, slots: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where `place` would stand in each list."""
        return np.searchsorted(self.keys, slots * self.documents + place)


def search(lists: Lists, query: dict[int, int], floor: int, top: int) -> tuple[list[tuple[int, int]], int]:
    """The (score, place) pairs of a block that may be among the `top` best, and the splits made.

    `query` maps terms to their number in the query. Only scores above zero and not below `floor`
    are wanted; of equal scores the earlier places come first, so an interval whose bound equals the
    `top`-th best score is still searched.
    """
    pairs = [(lists.slots[term], count) for term, count in query.items() if term in lists.slots]
    if not pairs:
        return [], 0
    slots = np.array([slot for slot, _ in pairs], np.int64)
    times = np.array([count for _, count in pairs], np.int64)

    def bounded(first, last):
        best = lists.largest(first, last)
        value = np.where(best >= 0, lists.impacts[best] * times, 0)
        head = value.argmax(axis=1)
        rows = np.arange(len(best))
        return value.sum(axis=1), lists.places[best[rows, head]]

    first = lists.starts(slots, np.zeros(1, np.int64))[None, :]
    last = lists.starts(slots, np.full(1, lists.documents))[None, :]
    bound, middle = bounded(first, last)
    scores, places, splits = np.empty(0, np.int64), np.empty(0, np.int64), 0
    least = max(floor, 1)
    while len(bound):
        alive = bound >= least
        if not alive.all():
            first, last, bound, middle = first[alive], last[alive], bound[alive], middle[alive]
        if not len(bound):
            break
        if len(bound) > _WIDTH:
            chosen = np.argpartition(bound, -_WIDTH)[-_WIDTH:]
        else:
            chosen = np.arange(len(bound))
        a, b, at = first[chosen], last[chosen], middle[chosen].astype(np.int64)
        splits += len(chosen)
        split = lists.starts(slots[None, :], at[:, None])
        inside = (split < b) & (lists.places[np.minimum(split, len(lists.places) - 1)] == at[:, None])
        exact = np.where(inside, lists.impacts[np.minimum(split, len(lists.places) - 1)] * times, 0).sum(axis=1)
        scores, places = np.concatenate([scores, exact]), np.concatenate([places, at])
        if len(scores) >= top:
            kept = np.lexsort((places, -scores))[:top]
            scores, places = scores[kept], places[kept]
            least = max(least, int(scores[-1]))
        rest = np.ones(len(bound), bool)
        rest[chosen] = False
        new_first, new_last = np.concatenate([a, split + inside]), np.concatenate([split, b])
        new_bound, new_middle = bounded(new_first, new_last)
        keep = new_bound >= least
        first, last = np.concatenate([first[rest], new_first[keep]]), np.concatenate([last[rest], new_last[keep]])
        bound = np.concatenate([bound[rest], new_bound[keep]])
        middle = np.concatenate([middle[rest], new_middle[keep]])
    wanted = scores >= max(floor, 1)
    return list(zip(scores[wanted].tolist(), places[wanted].tolist(), strict=True)), splits


def _searched(queries, weights, n_documents: int, n_terms: int, top: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, factor = queries.value, weights.value
        best: list[list[tuple[int, bool, int]]] = [[] for _ in asked]
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                lists, ids, nulls = _opened(row, factor, n_documents, n_terms)
                for nth, query in enumerate(asked):
                    mine = best[nth]
                    floor = -mine[-1][0] if len(mine) == top else 1
                    found, _ = search(lists, query, floor, top)
                    if found:
                        known = len(ids) - nulls
                        mine += [(-score, place >= known, int(ids[place]) if place < known else 0) for score, place in found]
                        mine.sort()
                        del mine[top:]
        rows = [(nth, -score, None if null else doc, not null) for nth, mine in enumerate(best) for score, null, doc in mine]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.bool_())
        columns = zip(*rows, strict=True) if rows else ([], [], [], [])
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, [field.split()[0] for field in _FOUND.split(", ")])

    return work


def _opened(row: dict, factor: np.ndarray, n_documents: int, n_terms: int) -> tuple[Lists, np.ndarray, int]:
    """The lists of a stored block, its ids and how many of these, at the end, are null."""
    ids = np.frombuffer(row["ids"], np.int64)
    lengths = np.frombuffer(row["lengths"], np.int64)
    places = np.frombuffer(row["places"], np.int32)
    counts = np.frombuffer(row["counts"], np.int64)
    terms, sizes = np.array(row["terms"], np.int64), np.array(row["sizes"], np.int64)
    measure = np.array([25 + 75 * n * n_documents // n_terms for n in lengths.tolist()], np.int64)
    share = (1_000_000_000 * counts) // (1000 * counts + 8 * measure[places])
    return Lists(terms, sizes, places, share * np.repeat(factor[terms], sizes), len(lengths)), ids[:-1], int(ids[-1])


def _answers(documents: DataFrame, items: list[tuple], top: int) -> DataFrame:
    """query, score, doc_id, rank for a batch of items (their texts)."""
    spark, context = documents.sparkSession, documents.sparkSession.sparkContext
    asked = [counted(text) for (text,) in items]
    known = {term: at for at, term in enumerate(sorted(set().union(*asked)))}
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = stored(rows.mapInArrow(_indexed(context.broadcast(known)), _BLOCK), "search-blocks")
    total = blocks.agg(F.sum("n_documents").alias("n"), F.sum("n_terms").alias("length")).first()
    sizes = blocks.select(F.explode(F.arrays_zip("terms", "sizes")).alias("part"))
    # one row per term of the batch, so bounded by the queries
    counted_ = sizes.groupBy("part.terms").agg(F.sum("part.sizes").alias("df")).collect()
    factor = np.zeros(max(len(known), 1), np.int64)
    for term, df in counted_:
        factor[term] = weight(total["n"], df)
    queries = [{known[term]: count for term, count in query.items()} for query in asked]
    work = _searched(context.broadcast(queries), context.broadcast(factor), total["n"] or 0, total["length"] or 1, top)
    found = blocks.mapInArrow(work, _FOUND)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.desc("known"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return stored(ranked.select("query", "rank", "doc_id", "score"), "search-ranked")


def ranked_search(documents: DataFrame, items: DataFrame, top: int = TOP, batch: int = QUERY_BATCH) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` documents of each item with a score above zero.

    `documents` has doc_id and text, `items` item_id and text.
    """
    spark = documents.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    asked = stored(asked.distinct(), "search-items")
    batches = -(-asked.count() // batch)
    results = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for nth in range(batches):
        part = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(batches)) == nth).collect()
        if part:
            found = _answers(documents, [(row["text"],) for row in part], top)
            names = spark.createDataFrame([(at, row["item_id"]) for at, row in enumerate(part)], "query int, item_id long")
            results = results.unionByName(found.join(F.broadcast(names), "query").select(*results.columns))
    return results


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP13_SQL = f"""
WITH words AS (SELECT doc_id, {_TERMS.format(text="text")} AS terms FROM documents WHERE text IS NOT NULL),
sized AS (SELECT doc_id, row_number() OVER () AS place, terms, len(terms)::BIGINT AS n FROM words WHERE len(terms) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM sized),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({_TERMS.format(text="text")}) AS term FROM benchmark WHERE text IS NOT NULL) GROUP BY 1, 2),
spread AS (SELECT place, doc_id, n, unnest(terms) AS term FROM sized),
postings AS (
  SELECT place, doc_id, n, term, count(*)::BIGINT AS tf
  FROM spread WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2, 3, 4),
weights AS (
  SELECT term, floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, totals GROUP BY term),
scored AS (
  SELECT item_id, place, any_value(doc_id) AS doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), totals GROUP BY item_id, place),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
