"""From documents to packed training sequences in four stages, each a table of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railweave.llm import language, minhash, packing, substrings
from railweave.llm.common import store

#: A document goes if it has no word with a letter, or if the mean over its words of each word's
#: own largest posterior is below this: the words fit no known language.  Texts that switch
#: between known languages are certain word by word and stay.
LEAST_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn on a bounded sample of the labelled documents and drop what is no known language.

    Null and empty texts have no word and go.  Without any label nothing can be learned and
    all documents stay.
    """
    if docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).isEmpty():
        return docs
    model = language.train(docs)
    # what the operator adds must not replace columns that the documents bring along
    held = docs.select(F.struct(*docs.columns).alias("row"), "text")
    known = language.certainty(held, model).where(F.col("certainty") >= LEAST_SCORE)
    return known.select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts stays, the one of least doc_id."""
    return minhash.keep_one(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut what repeats over 200 bytes or more; bytes left of a cut character go with it.

    ``n_chars`` is counted again.  A document of which nothing stays keeps its row, with an
    empty text; so does a null text.
    """
    held = docs.select(F.struct(*docs.columns).alias("row"), "text")
    cut = substrings.remove_repeats(held)
    # a cut in the middle of a character leaves bytes that are no UTF-8
    whole = F.when(F.is_valid_utf8(F.col("kept").cast("string")), F.col("kept").cast("string")).otherwise(
        F.replace(F.make_valid_utf8(F.col("kept").cast("string")), F.lit("�"), F.lit("")))
    new = {"text": F.col("clean"), "n_chars": F.char_length("clean").cast("long")}
    return cut.select("row", whole.alias("clean")).select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of each piece of each document in sequences of 4096 tokens."""
    return packing.pack_documents(docs)


STAGES = [("language_id", identify_language), ("near_dedup", drop_near_duplicates), ("suffix_dedup", remove_repeated_passages), ("packing", pack)]

#: Forward-backward, suffix arrays and a tokenizer are beyond SQL; tests compare each stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
