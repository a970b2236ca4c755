"""A training corpus from raw documents, in five stages.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame`` that calls one operator
of ``loanframe.llm`` and works on all rows that the stage before it kept.  ``run``
writes the result of every stage as a Parquet table in the shared folder and hands the
reread table to the next.

1. language ID: documents whose language cannot be told go;
2. line dedup: chunks of lines that occur earlier go from the texts;
3. SimHash near-dedup: one document of each group of linked documents stays;
4. benchmark decontamination: documents that hold a test item go;
5. byte-level BPE: the token ids of what is left, and the check that they decode to it.

Defined cases: null and letterless texts are rejected by the first stage; documents
that the second stage emptied stay, and form one near-duplicate group; empty tables
pass through every stage; extra columns are kept up to the fourth stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanframe.llm.bpe import decode_ids, encode_texts
from loanframe.llm.common import stored, table
from loanframe.llm.decontaminate import drop_contaminated
from loanframe.llm.langid import drop_unidentified, fit_language_model
from loanframe.llm.linededup import remove_repeated_chunks
from loanframe.llm.queries import RANKS, held_out
from loanframe.llm.simhash import keep_one_of_each


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told, without ambiguity (operator 10)."""
    model = fit_language_model(docs.filter(~held_out(3, 1)).select("text", "lang"))
    return drop_unidentified(docs, model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents rid of chunks of lines that occur earlier (operator 7)."""
    return remove_repeated_chunks(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (operator 5)."""
    return keep_one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item (operator 1)."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, the token ids and their number (operator 6); ``exact``
    tells that they decode to the text."""
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    encoded = encode_texts(docs.select("doc_id", "source", "lang", "text"), path, pattern)
    decoded = decode_ids(encoded, path, pattern)
    return decoded.select(
        "doc_id",
        "source",
        "lang",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        (F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("exact"),
    )


STAGES = [
    ("language_id", identified),
    ("line_dedup", without_repeated_lines),
    ("simhash_near_dedup", one_of_each),
    ("benchmark_decontamination", decontaminated),
    ("byte_bpe", tokenized),
]

#: The fingerprints, edit distances and merges of the stages are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
