"""Accents by tables, against Python's own Unicode data."""

import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from catalyne.functions import text


def brute(x, compatible):
    if compatible:
        return "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    return "".join(c for c in unicodedata.normalize("NFD", x) if unicodedata.category(c) != "Mn")


@pytest.mark.parametrize("compatible", [True, False])
def test_every_character(spark, compatible):
    """Each alone, and sixteen neighbours in one text."""
    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    texts = chars + ["".join(chars[i : i + 16]) for i in range(0, len(chars), 16) if not any(unicodedata.combining(c) for c in chars[i : i + 16])]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    wrong = [(ascii(r["t"]), ascii(r["f"])) for r in rows.select("t", text.fold_accents("t", compatible).alias("f")).collect() if r["f"] != brute(r["t"], compatible)]
    assert wrong == []


def test_texts(spark):
    odd = ["", None, "plain", "Crème brûlée", "ȩ́a", "½ ﬁn…", "한국어 텍스트", "\U0001d49c\U0001f600é", "a\0b"]
    rows = spark.createDataFrame([(t,) for t in odd], "t string")
    assert [r["f"] for r in rows.select(text.fold_accents("t").alias("f")).collect()] == [t if t is None else brute(t, True) for t in odd]


def test_no_python_in_search_and_similarity(spark):
    from catalyne.operators import search, similarity

    products = spark.createDataFrame([("1", "Crème", "Bé", "x")], "code string, product_name string, brands string, text string")
    plans = [search.documents(products), search.search(products, "creme"), similarity.term_weights(products.select(F.col("code").alias("item_id"), "text"), "item_id")]
    for p in plans:
        assert "Python" not in p._jdf.queryExecution().executedPlan().toString()
