"""Training on texts of no or one letter."""

from pyspark.sql import functions as F

from vicinal.llm.language_id import fit_languages, sample_vectors


def test_adjacent_empty_and_one_letter_texts(spark):
    rows = [("", "en"), ("", "fr"), ("x", "en"), ("", "fr"), ("é", "fr"), ("", "en"), ("the dog", "en"), ("le chien", "fr")]
    docs = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "doc_id bigint, text string, lang string").coalesce(1)
    sample = docs.select(F.col("text").alias("_text"), "lang", F.col("doc_id").alias("_order"))
    vectors = sample_vectors(sample)
    assert vectors["lang"].tolist() == [lang for _, lang in rows] and [len(x) > 0 for x in vectors["features"]] == [any(map(str.isalpha, t)) for t, _ in rows]
    assert fit_languages(docs, "text", "lang", "doc_id").languages == ["en", "fr"]
