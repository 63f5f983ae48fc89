"""Corpus pipeline: the stages that turn ``documents`` into token ids.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before
it kept, and returns the columns of ``documents``; the last one returns ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlake.llm import bpe, langid, mixing
from wattlake.llm.common import fresh, read_table, stored
from wattlake.llm.line_dedup import line_dedup
from wattlake.llm.near_dedup import near_duplicates
from wattlake.llm.queries import tokenizer_path

#: Bits a byte above which a text is in no learned language: its model does worse than one that knows nothing
#: and takes 8 bits for every byte.  This depends neither on the number of languages nor on a text's length.
MAX_LANGUAGE_BITS = 8.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; texts without a letter go, and those that no model codes."""
    out = langid.identify(docs)
    sure = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("lang_bits") <= MAX_LANGUAGE_BITS)
    return out.where(sure).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of repeated line runs; ``n_chars`` follows the text."""
    out = line_dedup(docs).select(*docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (shingles of five words, similarity 0.8 or more)."""
    judged = near_duplicates(docs, text_key="kept_text").where("kept AND doc_id IS NOT NULL")
    kept = judged.select(F.col("doc_id").alias("kept_id"), "kept_text").distinct()
    text, n = fresh(docs, "text_key", "copy")
    keyed = docs.withColumn(text, F.xxhash64("text"))
    # a row is judged by its own text, whatever other texts go by its id
    stay = keyed.join(kept, (F.col("doc_id") == F.col("kept_id")) & (F.col(text) == F.col("kept_text")), "left_semi")
    # rows that repeat a kept document go as well; null ids are linked with nothing but equal texts
    stay = stay.unionByName(keyed.where("doc_id IS NULL"))
    stay = stay.withColumn(n, F.row_number().over(Window.partitionBy("doc_id", text).orderBy(text)))
    return stay.where(F.col(n) == 1).select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those without words have nothing to give."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text again."""
    out = bpe.encoded(docs, tokenizer_path(), ["doc_id", "lang", "source"])
    return out.select("doc_id", "lang", "source", "n_tokens", "ids", "round_trips")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", lines),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("bpe_encode", encode),
]

#: Language models, similarity on hashes and BPE merges are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each one's rows are written and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
