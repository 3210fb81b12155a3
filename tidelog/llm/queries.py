"""Queries op1 to op10 over the whole tables, and the SQL that checks them where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """The place of a vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    return scan(table(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import plan

    return plan(table(spark, sf_dir, "documents"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neighbours import search

    return search(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import predict

    return predict(table(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .personal_data import digests

    return digests(table(spark, sf_dir, "documents"))


def op6_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ._graph import written
    from .ogg import from_ogg, to_ogg

    return from_ogg(written(to_ogg(table(spark, sf_dir, "documents"))))  # stored, then read back


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score, train

    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import join

    return join(table(spark, sf_dir, "documents"), n=4, percent=85)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pieces import round_trip

    return round_trip(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), limit=1024)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


#: The other operators are beyond SQL: hash orders, models, checksums or tokenizers. Tests hold them against brute force.
SQL = {
    "op8_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
r AS (SELECT doc_id, doc_id AS c FROM n UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, w.doc_id) AS component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m USING (doc_id)
""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
