import pytest
from conftest import SF, same

from catalyne.plans import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, duck, name):
    same(queries.QUERIES[name](spark, SF), duck, queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_without_sql(spark, name):
    assert queries.QUERIES[name](spark, SF).count() > 0


def test_clean_text_of_every_page(spark, tmp_path):
    import hashlib
    import re
    import unicodedata

    from duckdb import sql

    def brute(x):
        x = "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
        x = re.sub("[^a-zA-Z0-9%+\\-/,:. \t\n\x0b\f\r]", " ", re.sub("<[^>]+>", " ", x.replace("_", " ")))
        return hashlib.md5(" ".join(x.split()).encode()).hexdigest()

    odd = ["<p>Crème brûlée_à 5 %</p>", "ﬁn Ⅳ 漢字 <b\n>x</b>", "plain", "", None]
    spark.createDataFrame(list(enumerate(odd)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {r["page_id"]: r["cleaned"] for r in queries.QUERIES["str_clean_text_pages"](spark, str(tmp_path)).collect()}
    assert found == {i: None if x is None else brute(x) for i, x in enumerate(odd)}
    pages = sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall()
    found = {r["page_id"]: r["cleaned"] for r in queries.QUERIES["str_clean_text_pages"](spark, SF).collect()}
    assert len(found) == len(pages) and found == {i: brute(x) for i, x in pages}


def test_texts_of_every_item(spark):
    items = {r["item_id"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    assert {r["item_id"] for r in queries.QUERIES["str_tokenize_folded"](spark, SF).collect()} == items
    assert {r["item_id"] for r in queries.QUERIES["tfidf_vectors_folded"](spark, SF).collect()} == items
    assert {r["item_id"] for r in queries.QUERIES["tfidf_cosine_folded"](spark, SF).collect()} == items - {0}


def test_ingredients_of_every_part(spark, duck):
    """At sf0.01, as sf0.001 has no more than 200 parts."""
    wide = f"{SF}/../sf0.01"
    found = queries.QUERIES["catalog_detail_ingredients_all"](spark, wide)
    parts = duck.sql(f"SELECT count(DISTINCT l_partkey) FROM '{wide}/lineitem.parquet'").fetchall()[0][0]
    assert found.count() == parts > 200


def test_nutrition_of_every_part(spark):
    assert queries.QUERIES["similar_nutrition_all"](spark, SF).count() == spark.read.parquet(f"{SF}/part.parquet").count()


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_the_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys

    from conftest import ROOT

    shutil.copytree(ROOT / "catalyne", tmp_path / "catalyne", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert 'pipeline' not in e.queries() and 'catalog_products_list' in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, check=True)
