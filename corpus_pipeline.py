"""A training corpus from ``documents`` in five stages, each written as Parquet and read again by the next.

toxicity      rows that the toxicity operator rejects go
ngram_join    of each group of near duplicates (five-word grams, Jaccard 0.8 or more) the first row stays
personal_data personal data and the terms that disclose it are replaced in the texts
mixing        sources are brought to their target weights: rows go, stay or repeat
packing       the rows' tokens are packed into sequences of at most 4096

SQL cannot express the learned, graph and bulk-synchronous stages, so ORACLE_SQL is None; the tests hold every stage
against a brute-force version. Null texts and repeated rows pass as the operators define; extra columns are kept up to
the last stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.config import checkpoint_dir, discard
from caseloom.llm import mixing, ngram_join, packing, privacy, toxicity
from caseloom.llm.frames import table

NEAR_GRAM, NEAR = 5, ngram_join.Alike(80, 100)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, NEAR_GRAM, NEAR)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = privacy.sanitise(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeat(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; the stages' tables go to the shared checkpoint folder.

    A stage's table is deleted once the next one's is written; the last stays, as the result is read from it.
    """
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
