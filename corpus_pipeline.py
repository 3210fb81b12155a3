"""From raw documents to encoded ones: language, near duplicates, personal data, source mix, pieces.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns
of documents, in their order, and columns beyond those five stay as well, whatever their names. run() applies them in
order, writing each stage's rows before the next one reads them. Every stage gives an empty table for an empty one, and
works on whole texts, however long; memory follows the longest one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import jaccard, language, mixing, personal_data, pieces
from tidelog.llm.queries import tokenizer
from tidelog.sources.scratch import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, so without any letter, go: null and empty texts too.

    Nulls in other columns don't matter: rows without lang aren't learnt from, a null doc_id is like any other. Repeated
    rows all stay or all go; ties between languages keep the document.
    """
    return language.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words a shingle, similarity 0.8 or more.

    It is the one with the smallest doc_id, nulls last, then with the smallest text; repeated rows are copies, so one
    stays. Null and empty texts, and texts without words, are linked with nothing: all of them stay.
    """
    return jaccard.one_of_each(docs, n=5, percent=80)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind, and n_chars follows; all documents stay, repeated ones too.

    Null and empty texts stay as they are, and so does n_chars of texts without personal data, null or not. Of spans that
    overlap the first names the stretch, of those that start together the longest.
    """
    return personal_data.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by weight: documents come as often as the mix takes them, some not at all, none more than three times.

    Null is a source of its own, the last. Texts without words, null or empty, are taken 0 times. Repeated rows are
    documents of their own; equal finish times go by source, pass, hash and doc_id, null first.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids, of the text decoded from them and of the spans of the pieces.

    A row for each row, repeated ones and null ids included; null and empty texts have no pieces. Other columns go.
    """
    return pieces.round_trip(docs, tokenizer("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_id),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal),
    ("mix", mix),
    ("encode", encode),
]

#: Models and near duplicates are beyond SQL; tests hold the whole rows of run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
