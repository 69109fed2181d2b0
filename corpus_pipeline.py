"""Training-corpus pipeline: five stages, each one operator of ``marketscope.llm``.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.

Defined cases: null texts, texts without letters and long texts of no learned language
are rejected by the first stage;
the operators' docstrings state the rest (empty tables, ties, repeated rows,
further columns, which are kept up to packing).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketscope.llm.common import ROW, prepare, read_table, written
from marketscope.llm.decontaminate import clean_documents
from marketscope.llm.language_id import LANG, UNKNOWN, held_out, with_language
from marketscope.llm.line_dedup import without_repeats
from marketscope.llm.packing import pack
from marketscope.llm.simhash_dedup import keep_one

#: a text of LONG_WORDS words or more stays if its words are this certain of their own languages, on the way from a
#: uniform guess (0) to certainty (1): code-switched text is certain, random letters are not; shorter ones stay.
#: Relative, so it means the same for any number of languages. README: measured values
MIN_CERTAINTY, LONG_WORDS = 0.7, 20


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: drops documents without letters and those whose words are of no learned language."""
    prepare(spark)
    labelled = with_language(docs, docs.where(~held_out(F.col("doc_id"))))
    lang = F.col(LANG)
    words = F.size(F.split(F.col(f"{ROW}.text"), r"\s+"))
    certain = (words < LONG_WORDS) | (lang["certainty"] >= MIN_CERTAINTY)
    return labelled.where((lang["lang"] != UNKNOWN) & certain).select(f"{ROW}.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: deletes later copies of repeated lines and runs."""
    prepare(spark)
    return without_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: one document of each SimHash component stays."""
    prepare(spark)
    return keep_one(docs, shingle=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: drops documents that hold a benchmark item."""
    return clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: sequences of at most 1024 tokens."""
    prepare(spark)
    return pack(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("simhash_dedup", near_dedup),
          ("decontaminate", decontaminate), ("packing", packing)]

#: hashes, tokenizers and the language model have no SQL form: tested against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
