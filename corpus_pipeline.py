"""The corpus pipeline: language ID, near-duplicates, repeated passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return
the columns of ``documents``. ``run`` applies them in order, each result written as Parquet in the folder
for checkpoints and read again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.functions.shared import checkpoint_folder
from quantloom.llm.common import checkpointed, importable, sieved, table
from quantloom.llm.decontamination import WINDOW, contamination
from quantloom.llm.langid import fit, predict
from quantloom.llm.minhash import NO_ID, grouped
from quantloom.llm.packing import pack_documents
from quantloom.llm.suffixdedup import remove_repeats

SIMILAR = (80, 100)
SHINGLE = 5


def bundled(docs: DataFrame) -> DataFrame:
    """doc_id, text, lang and all columns but the text as one, so that no column of a stage can clash with one of the documents."""
    return docs.select("doc_id", "text", "lang", F.struct(*[c for c in docs.columns if c != "text"]).alias("_document"))


def unbundled(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    return df.select(*[changed.get(c, F.col("text") if c == "text" else F.col("_document")[c]).alias(c) for c in columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts whose language can't be told: none, without a letter, or under the calibrated score.

    The model is fitted on a bounded sample of the rows with a label and calibrated on another (``langid.fit``). Rows that repeat fare alike; with no
    label at all nothing can be told and all go; an empty table stays empty.
    """
    importable(spark)
    model = fit(docs.select("doc_id", "text", "lang"), F.col("doc_id"))
    return unbundled(predict(bundled(docs), model).filter("accepted"), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near-duplicates the document of the smallest id (of that id, the text of the smallest hash); rows that repeat id and text stay once.

    Decided by id and text: of two rows of one id each goes or stays by itself. A document without a word is in no group and stays.
    Nulls, empty texts, ties and an empty table: see ``minhash``; other columns pass through.
    """
    importable(spark)
    rows = checkpointed(grouped(docs, SHINGLE, *SIMILAR).groupBy("_id", "_h", "_group").agg(F.count("*").alias("_n")))
    least = checkpointed(rows.groupBy("_group").agg(F.min(F.struct("_id", "_h")).alias("_least")))  # so that a large group's rows can be split in the join
    told = rows.join(least, "_group").withColumn("_stays", F.struct("_id", "_h") == F.col("_least"))
    key = F.xxhash64("_id", "_h")
    doubtful = checkpointed(told.filter("_n > 1 or not _stays").select(key.alias("_key"), "_id", "_h", "_stays"))
    keyed = bundled(docs).withColumns({"_id": F.coalesce(F.col("doc_id"), F.lit(NO_ID)).cast("long"), "_h": F.xxhash64("text")}).withColumn("_key", key)
    sifted = sieved(keyed, "_key", doubtful.select("_key"), "_maybe")  # texts are shuffled only of rows that may go
    looked = sifted.filter("_maybe").join(doubtful, ["_key", "_id", "_h"], "left")
    once = looked.filter("_stays").dropDuplicates(["_id", "_h"])
    parts = [sifted.filter("not _maybe"), looked.filter("_stays is null"), once]
    return unbundled(reduce(DataFrame.unionAll, [p.select("text", "_document") for p in parts]), docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts 100-byte repeats of earlier text, whole characters only; documents of which nothing is left go.

    A null text becomes an empty one, and stays. ``n_chars``, where there is one, is counted again. Repeats and ties: see ``suffixdedup``.
    """
    importable(spark)
    out = remove_repeats(bundled(docs), whole=True).withColumn("text", F.col("kept").cast("string")).filter("text <> '' or n_bytes = 0")
    return unbundled(out, docs.columns, n_chars=F.length("text").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item, or the whole of an item of fewer words.

    Nulls, repeats and empty tables: see ``decontamination``; a text without words stays.
    """
    benchmark = table(spark, sf_dir, "benchmark", "item_id", "text")
    return unbundled(contamination(bundled(docs), benchmark, WINDOW).filter(F.size("spans") == 0), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: a row for each piece of each document; a null or empty text is its end alone. Only doc_id and text are read."""
    importable(spark)
    return pack_documents(docs.select("doc_id", "text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]
ORACLE_SQL = None  # SQL expresses neither the model nor the token ids; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; what a stage wrote goes when the next one has written. An empty table gives an empty result."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            fs.delete(at(before), True)
        before = f"{folder}/{name}"
    return docs
