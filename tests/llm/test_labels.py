"""Labels that language identification learns from."""

import pytest
from pyspark.sql import functions as F

from catalyne.llm import langid

FEW = [(1, "the cat sat on the mat", "en"), (2, "le chat est sur la table", "fr"), (3, "42 !", "xx"), (4, None, "en"), (5, "the dog", None)]


def test_languages_without_words_and_repeated_rows(spark):
    """A label whose texts have no word is a language that no piece speaks for; repeated rows teach again."""
    docs = spark.createDataFrame(FEW * 3, "doc_id long, text string, lang string")
    langs, probs = langid.train(docs, langid.default_vocabulary())
    assert langs == ["en", "fr", "xx"] and probs.shape[1] == 3
    assert abs(probs.sum(axis=0) - 1).max() < 1e-9 and len(set(probs[:, 2])) == 1
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs.distinct(), langs, probs, langid.default_vocabulary()).collect()}
    assert got == {1: "en", 2: "fr", 3: "und", 4: "und", 5: "en"}


def test_fits_side_by_side_are_those_of_one_process(spark):
    docs = spark.createDataFrame(FEW, "doc_id long, text string, lang string")
    pieces = langid.vocabulary(langid.default_vocabulary())
    langs, probs = langid.train(docs, langid.default_vocabulary())
    counts = {"cat": 1, "mat": 1, "on": 1, "sat": 1, "the": 2}
    assert (probs[:, langs.index("en")] == langid.fit(counts, langid.Lattice(pieces), len(pieces))).all()


def test_too_many_labels(spark):
    docs = spark.range(langid.MOST_LANGS + 1).select(F.col("id").alias("doc_id"), F.lit("word").alias("text"), F.concat(F.lit("l"), "id").alias("lang"))
    with pytest.raises(ValueError, match="more than"):
        langid.train(docs, langid.default_vocabulary())
