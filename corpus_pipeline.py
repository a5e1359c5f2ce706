"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the documents
that go on, with the columns of ``documents``; the last one returns packed pieces.

1. ``language``: documents without a recognisable language (``und``) go; ``lang`` is filled where it
   was null. Learned from the labelled documents that the held-out rule allows.
2. ``near_duplicates``: shingles of five words, similarity 0.8; of each component the document with
   the least key stays. Rows with a null key are linked with nothing and stay; rows that repeat a
   kept key are that document and stay.
3. ``substrings``: words covered by a 50-word window that also starts in an earlier document go. Texts
   without such words stay as they are; ``n_chars`` follows the text.
4. ``personal_data``: every span becomes its kind in brackets; ``n_chars`` follows the text.
5. ``packing``: all documents become pieces of at most 1024 tokens with a sequence and an offset.

Every stage works on all rows it is given; null or empty texts pass stages 2 to 5 as empty ones, and
extra columns go along up to stage 4. Two stages cannot be said in SQL (trained models), so there is
no SQL for the result; the tests hold each stage against a brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeaudit.functions.durable import shared_folder
from lakeaudit.llm import language, neardup, packing, pii, substrings
from lakeaudit.llm.common import ready, salted_join, table

ORACLE_SQL = None


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.select(*columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(docs.where(language.fold(F.col("doc_id")) != 2))
    # columns of a stage's own are taken away again, so a document column of that name is put aside
    names = [f"_c{i}" if c in ("lang_pred", "score") else c for i, c in enumerate(docs.columns)]
    found = language.predict(docs.toDF(*names), model).where(F.col("lang_pred") != language.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*names).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    verdicts = neardup.near_duplicates(docs)
    dropped = verdicts.where(~F.col("kept")).select("doc_id").distinct()
    return salted_join(docs, dropped, ["doc_id"], "left_anti", salts=8, spread=F.xxhash64("text")).select(*docs.columns)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = [f"_c{i}" if c in ("n_words", "n_removed") else c for i, c in enumerate(docs.columns)]
    done = substrings.remove_repeats(docs.toDF(*names), as_is=True)
    return _with_length(done.select(*names).toDF(*docs.columns), docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_length(pii.redact(docs, pii.train(docs)), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("substrings", remove_repeated_passages),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(ready(spark), sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex[:12]}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
