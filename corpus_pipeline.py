"""The corpus pipeline: quality, repeated lines, near duplicates, benchmark passages,
packing. Each stage is written as Parquet and reread as the next one's documents.

Every stage takes documents (doc_id, text, any other columns of any names) and all but the
last return the same columns. For all of them: a null text is an empty one; rows with a null
id are documents like others; an empty table gives an empty one; other columns are handed
on as they are, whatever the operators call their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mesonlab.llm.common import table, written
from mesonlab.llm.decontaminate import decontaminate
from mesonlab.llm.lines import PASSAGE_WORDS, dedup_lines
from mesonlab.llm.minhash import near_duplicates
from mesonlab.llm.packing import pack_documents
from mesonlab.llm.quality import THRESHOLD, learned_keys, score_documents, train


def _row(docs: DataFrame) -> Column:
    """All columns of a row, as one that no operator's column can replace."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; all if there is nothing to learn
    from. Each row is judged by its own text, so rows that repeat stay or go together; an
    empty text has the score of no words. A null id is never learned from."""
    own = docs.select("doc_id", "text")
    model = train(own, table(spark, sf_dir, "labels"), learned_keys)
    if isinstance(model, float):
        return docs
    scored = score_documents(docs.select(_row(docs).alias("row"), "text"), model)
    return scored.where(F.col("score") >= THRESHOLD).select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later repeated runs of lines and passages; one that held nothing else
    goes, one that was empty before stays. The first occurrence is that of the smallest id, null
    ids before others, then of the smallest hash of the text; rows that repeat id and text are
    one document and keep the same. ``n_chars`` becomes the length of what is left."""
    clean = dedup_lines(docs.select("doc_id", "text", _row(docs).alias("row")), passage_words=PASSAGE_WORDS)
    clean = clean.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\s]"))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return clean.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id. Where ids repeat
    or are null, a document is a pair of id and text, and that of the smallest hash of both
    stays; of rows that repeat the pair, one stays, by a hash of all columns. Texts without
    words are in no group: they all stay, but for such repeated rows."""
    rows, ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    if rows == ids:
        kept = near_duplicates(docs.select("doc_id", "text")).where("kept").select(F.col("doc_id").alias("key"))
        return docs.select(_row(docs).alias("row"), F.col("doc_id").cast("long").alias("key")).join(kept, "key", "left_semi").select("row.*")
    keyed = docs.select(_row(docs).alias("row"), F.xxhash64(F.col("doc_id").cast("string"), F.col("doc_id").isNull(), "text", F.col("text").isNull()).alias("key"))
    first = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64(F.col("row").cast("string"))))
    keyed = written(keyed.withColumn("turn", first).where("turn = 1").drop("turn"), "near-rows")
    kept = near_duplicates(keyed.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text"))).where("kept").select(F.col("doc_id").alias("key"))
    return keyed.join(kept, "key", "left_semi").select("row.*")


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark: each row is judged by its own text, an
    empty one has none; an empty benchmark, or one of null texts, removes nothing."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Placement of every piece of every document in sequences of 1024 tokens: doc_id, piece,
    start, length, ids_crc32, sequence_id, offset. Each row is a document, also where ids
    repeat or are null; an empty text is its end token alone; documents of equal length take
    places in the order of id, piece and content."""
    return pack_documents(docs.select("doc_id", "text"))


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("leaks", leaks), ("packing", packing)]
#: The fitted classifier can't be said in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
