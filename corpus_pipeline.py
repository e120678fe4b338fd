"""From raw documents to packed training sequences, stage by stage.

1. language: texts without letters, and those unlike every known language, go; a missing ``lang`` is filled in.
   Unlike is a score below what noise reaches, or below a low quantile of the language's own documents if that is
   less. Texts of a few different 3-grams stay, and all with letters if no labelled text is there to learn from.
2. near_duplicates: one document of each group of near copies stays (five words, similarity 0.8).
3. secrets: credentials in a text are replaced by a mark.
4. mixing: documents repeat, or are left out, so that each source has its target of words.
5. packing: texts become pieces of at most 2048 tokens in as few sequences as possible.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the next one's
``docs``, so a lost executor repeats no earlier stage. All but the last return the columns of ``docs``, further
columns included. Null texts go in the first stage; rows that repeat are one group in the second.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapwise.llm import language, minhash, mixing, packing, secrets
from lapwise.llm.common import read, shared_folder, whole_row

# The stages learn from their own input and count in tokens of a tokenizer: beyond SQL.
ORACLE_SQL = None


def _key(column: Column | str) -> Column:
    """A document's key as text without nulls."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit("null"))


def _replaced(docs: DataFrame, **new: Column) -> list[Column]:
    """The columns of ``docs`` out of ``doc``, some of them anew and in their types."""
    return [new.get(c, F.col("doc")[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    profiles = language.fit(docs, "text", "lang", "doc_id")
    profiles = language.with_floors(profiles, docs, "text", "lang")
    rows = docs.select(whole_row(docs).alias("doc"), language.judge_language("text", profiles).alias("found"))
    guess = F.nullif("found.lang", F.lit(language.UNKNOWN))
    return rows.where("found.like").select(*_replaced(docs, lang=F.coalesce("doc.lang", guess)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(docs, "text", "doc_id").where("kept")
    kept = found.select(_key("doc_id").alias("key"), F.col("text_hash").alias("hash"))
    rows = docs.select(whole_row(docs).alias("doc"), _key("doc_id").alias("key"), F.xxhash64("text").alias("hash"))
    # One row stays of those with a kept key and text.
    same = Window.partitionBy("key", "hash").orderBy("doc.source", "doc.lang")
    return (
        rows.join(kept, ["key", "hash"], "left_semi").withColumn("nth", F.row_number().over(same))
        .where("nth = 1").select("doc.*")
    )


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(whole_row(docs).alias("doc"), secrets.find_secrets("text").alias("spans"))
    rows = rows.withColumn("clean", secrets.redact(F.col("doc.text"), "spans"))
    return rows.select(*_replaced(docs, text=F.col("clean"), n_chars=F.length("clean")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    alike = [
        _key("doc_id").alias("key"), F.xxhash64("text").alias("hash"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("name"),
    ]
    names = ["key", "hash", "name"]
    sized = docs.select("doc_id", "source", mixing.words("text").alias("size"), *alike)
    mixed = mixing.mix(sized, "doc_id", "size", "source").where("taken > 0")
    mixed = mixed.select(*names, (F.col("taken") / F.col("size")).cast("int").alias("times"))
    rows = docs.select(whole_row(docs).alias("doc"), *alike)
    # Rows alike in key, text and source are interchangeable: the nth of them has the nth number.
    same = Window.partitionBy(*names)
    taken = mixed.withColumn("nth", F.row_number().over(same.orderBy(F.desc("times"))))
    rows = rows.withColumn("nth", F.row_number().over(same.orderBy("doc.lang")))
    return (
        rows.join(taken, [*names, "nth"])
        .select("doc", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time")).select("doc.*")
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, "text", "doc_id")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
