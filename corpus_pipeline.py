"""A training corpus from `documents`: five stages, each written as Parquet and read by the next.

1. language    documents without a language, or surely of another one than they say, go
2. lines       of similar lines one stays; documents that lose every word go
3. near copies of the documents whose shingles are similar one stays
4. mixing      documents that the mix of the sources does not take go
5. tokens      byte-level BPE ids, and the text decoded from them; a row per document, with the
               number of its `copies`: how many times the mix takes it

Nulls and empty texts: a null text has no language and goes in the first stage. Each stage takes an
empty table to an empty table. Extra columns are dropped by `run`: it starts from the columns of
`documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bumpwise.llm import bpe, jaccard, language, lines, mixing
from bumpwise.llm.common import WORD, stored, word_count
from bumpwise.session import store, work_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# a cosine from which another language than the stated one is believed
SURE = 0.5
# the metadata of doc_id that names the table of copies
COPIES = "copies"
FIVE_WORDS = jaccard.Similarity(words=5, percent=80)


def _documents(frame: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars as the text is now."""
    return frame.select(
        *[F.col(c) for c in COLUMNS[:-1]], F.char_length("text").cast("long").alias("n_chars")
    )


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.learn(docs)
    told = language.identify(docs, model, {c: F.col(c) for c in COLUMNS})
    other = F.coalesce(F.col("lang_pred") != F.col("lang"), F.lit(False)) & (F.col("score") >= SURE)
    return told.where(~other & (F.col("lang_pred") != language.UNKNOWN)).select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = lines.without_repeats(docs.select(*COLUMNS))
    return _documents(cleaned.where(F.col("text").rlike(WORD)))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS, F.xxhash64(*COLUMNS).alias("row_hash"))


def _join(docs: DataFrame, keys: DataFrame, how: str, *also: str) -> DataFrame:
    """Keyed documents joined on (doc_id, row_hash) with keys that are counted, then broadcast if
    they are few; else both sides are shuffled. `also` names more columns of the keys."""
    copy, n_keys = store(keys.select(F.col("doc_id").alias("key_id"), F.col("row_hash").alias("key_hash"), *also), "pipeline-keys")
    copy = F.broadcast(copy) if n_keys <= lines.BROADCAST_ROWS else copy
    same = F.col("doc_id").eqNullSafe(F.col("key_id")) & (F.col("row_hash") == F.col("key_hash"))
    return docs.join(copy, same, how)


def _once(keyed: DataFrame, repeated: DataFrame) -> DataFrame:
    """Keyed documents, of those named in `repeated` one of each."""
    if repeated.isEmpty():
        return keyed
    once = _join(keyed, repeated, "left_semi").dropDuplicates(["doc_id", "row_hash"])
    return _join(keyed, repeated, "left_anti").unionByName(once)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id stays; among rows with that id, the first by content.

    The texts are not moved for it: rows are named by id and hash, and those to drop are taken out.
    """
    keyed = _keyed(docs)
    found = stored(
        jaccard.jaccard_components(keyed, {c: F.col(c) for c in ("doc_id", "row_hash")}, FIVE_WORDS), "pipeline-clusters"
    )
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_hash")
    marked = found.withColumn("_order", order)
    least = marked.where("cluster is not null").groupBy("cluster").agg(F.min("_order").alias("_least"))
    dropped = marked.join(least, "cluster").where(F.col("_order") != F.col("_least"))
    kept = _join(keyed, dropped.select("doc_id", "row_hash").distinct(), "left_anti")
    # rows that are equal in all columns have one name; they are few, and one of each stays
    repeated = stored(found.groupBy("doc_id", "row_hash").count().where("count > 1"), "pipeline-repeated")
    return _once(kept, repeated).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document that is taken is one row. Those taken several times are named, with the number of
    their copies, in a stored table; the metadata of doc_id holds its path, for the next stage.

    Rows that are equal in all columns have one name; one of them stays, for the copies of all.
    """
    keyed = _keyed(docs)
    sized = mixing.mix(keyed, word_count(F.col("text")), carry=("doc_id", "row_hash"))
    times = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(0)
    named = stored(
        sized.groupBy("doc_id", "row_hash").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(times).alias("copies")),
        "pipeline-mix",
    )
    path = work_path(spark, "pipeline-copies")
    named.where("copies > 1").select("doc_id", "row_hash", "copies").write.parquet(path)
    kept = _once(_join(keyed, named.where("copies = 0"), "left_anti"), named.where("n_rows > 1"))
    return kept.select(F.col("doc_id").alias("doc_id", metadata={COPIES: path}), *COLUMNS[1:])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document that no mix has taken several times has one copy."""
    ranks, pattern = bpe.public_vocabulary()
    path = docs.schema["doc_id"].metadata.get(COPIES)
    if path:
        docs = _join(_keyed(docs), spark.read.parquet(path), "left", "copies")
    else:
        docs = docs.withColumn("copies", F.lit(1))
    kept = {c: F.col(c) for c in ("doc_id", "lang", "source")} | {"copies": F.coalesce("copies", F.lit(1)).cast("long")}
    return bpe.encode_documents(docs, ranks, pattern, kept, texts_back=True).select(
        "doc_id", "lang", "source", "ids", F.decode("decoded", "UTF-8").alias("text"),
        "n_tokens", "ids_sha256", "decoded_sha256", "copies",
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", by_language),
    ("lines", without_repeated_lines),
    ("near_copies", without_near_copies),
    ("mixing", mixed),
    ("tokens", tokens),
]

# no stage can be told in SQL: hyperdimensional profiles, MinHash, subset sums and BPE
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
