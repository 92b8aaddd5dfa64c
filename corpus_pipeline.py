"""From raw documents to packed training sequences: STAGES in order, each reading what the one before it wrote."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adyield.llm import language_id, mixing, near_dedup, packing, suffix_dedup
from adyield.session import shared_folder

#: No SQL twin: n-gram ranks, passage removal and packing are tested against brute force.
ORACLE_SQL = None

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text that scores less than this is in none of the languages, also where no labelled document is named as one of them.
MIN_LANGUAGE_SCORE = 0.05
#: A passage of more than 50 words that stands more than once is cut, whatever its bytes.
PASSAGE_WORDS = 51


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a letter and those of a language unlike all that the labelled documents teach.

    What is unlike is learned too: a score far below nearly all labelled documents of the named language and about that length.
    """
    profiles = [tuple(row) for row in language_id.learn_profiles(docs).collect()]
    learned = language_id.least_scores(language_id.identify(docs, profiles, keep=("lang",), letters=True))
    least = spark.createDataFrame(learned, "least_pred string, least_size int, least double")
    judged = language_id.identify(docs, profiles, keep=tuple(COLUMNS[1:]), letters=True).filter(F.col("lang_pred") != language_id.UNKNOWN)
    alike = (F.col("lang_pred") == F.col("least_pred")) & (language_id.size_class(F.col("n_letters")) == F.col("least_size"))
    enough = F.greatest(F.coalesce("least", F.lit(0.0)), F.lit(MIN_LANGUAGE_SCORE))
    return judged.join(F.broadcast(least), alike, "left").filter(F.col("score") >= enough).select(COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of every group of near-duplicates (five-word shingles, similarity 0.8), and of repeated rows one.

    Rows without an id are in no group and stay.
    """
    kept = near_dedup.near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id").distinct()
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("source", "lang")
    named = docs.join(kept, "doc_id", "left_semi").withColumn("nth", F.row_number().over(same)).filter("nth = 1")
    return named.select(COLUMNS).union(docs.filter("doc_id is null").select(COLUMNS))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 400 bytes or 51 words that stand more than once; documents stay, with what is left of their text."""
    cut = suffix_dedup.remove_repeats(docs, keep=("lang", "source"), as_text=True, words=PASSAGE_WORDS)
    return cut.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents so that sources weigh as the square root of their size, and shuffle."""
    return mixing.mix(docs).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise and pack into sequences of 1024."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("minhash_near_dedup", one_of_each_group),
    ("suffix_array_dedup", without_repeated_passages),
    ("poisson_mixing", mixed_sources),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of a folder, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
