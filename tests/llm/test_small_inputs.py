"""Every operator on empty tables, nulls, empty texts, repeated rows, ties and extra columns with clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from caseloom.llm import ann, fingerprints, language, mixing, ngram_join, packing, privacy, substrings, token_counts, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = " ".join(f"word{i}" for i in range(60))
ROWS = [(1, "Hello there, write to a.b@mail.com now", "en", "s1", 10), (2, None, "en", None, None), (3, "", None, "s1", 0),
        (4, WORDS, "en", "s2", 5), (4, WORDS, "en", "s2", 5), (None, "x y z", "de", "s2", 1), (5, "é" * 3000, "fr", "s3", 2),
        (6, WORDS + " tail", None, None, 7), (7, "   \n\t ", "en", "s1", 4)]
CLASHES = ["at", "id", "part", "guard", "count", "size", "node", "gram", "key", "rank", "length", "piece", "n", "score", "word", "value",
           "copies", "source_size", "base", "terms", "weight", "target", "rate", "place", "component", "digest", "root", "task"]
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def odd(spark, rows=ROWS):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in CLASHES:
        df = df.withColumn(c, F.lit("clash"))
    return df


OPERATORS = {
    "language": lambda d: language.predict(d, language.train(language.sample_features(d, 10), epochs=1)),
    "mixing": mixing.mix,
    "privacy": privacy.detect,
    "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, d.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))), passages=True),
    "substrings": substrings.dedup_substrings,
    "ngram_join": ngram_join.near_duplicates,
    "fingerprints": fingerprints.edited_fingerprints,
    "token_counts": lambda d: token_counts.token_counts(d, BYTE),
    "prefix_tables": lambda d: token_counts.prefix_tables(d, BYTE),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_every_row(spark, name):
    assert sorted(str(r["doc_id"]) for r in OPERATORS[name](odd(spark)).collect()) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", [*OPERATORS, "packing"])
def test_empty_table(spark, name):
    op = OPERATORS.get(name) or (lambda d: packing.pack_documents(d, WORD))
    assert op(odd(spark, [])).collect() == []


def test_packing_takes_every_row(spark):
    got = packing.pack_documents(odd(spark), WORD, 64).collect()
    twice = [r.piece for r in got if r.doc_id == 4]  # the repeated row has its pieces again
    assert sorted(twice) == sorted(2 * list(set(twice))) and len({(str(r.doc_id), r.piece) for r in got}) == len(got) - len(twice) // 2
    assert {r.doc_id for r in got} == {r[0] for r in ROWS}
    assert all(r.length == 1 for r in got if r.doc_id in (2, 3, 7))  # null, empty and blank: the end token alone


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int")
    for rows in (docs, docs.limit(0)):
        for stage in (corpus_pipeline.drop_near_duplicates, corpus_pipeline.replace_personal_data, corpus_pipeline.mix_sources):
            assert stage(spark, rows, "").columns == docs.columns
            stage(spark, rows, "").collect()
        assert toxicity.keep_clean(rows, toxicity.fit(rows, labels)).count() == rows.count()  # one label only: no model


def test_stages_on_clashing_columns(spark):
    for stage in (corpus_pipeline.drop_near_duplicates, corpus_pipeline.mix_sources, corpus_pipeline.replace_personal_data):
        stage(spark, spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHES if not c.startswith("__")}), "").collect()


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
            (6, [1.0, None]), (7, [0.5, 0.5]), (None, [1.0, 1.0]), (8, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("class", F.lit("clash")).withColumn("id", F.lit(1))
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(df, 20, F.col("vec_id") % 20 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 7, 0.5)]
    assert ann.nearest(df.limit(0), 20).collect() == []
