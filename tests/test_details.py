"""Details of many products."""

import random

import pytest
from pyspark.sql import functions as F

from catalyne.operators import catalog
from catalyne.plans import queries
from catalyne.plans.tables import catalog as star

SF = "/root/testdata/sf0.001"


def plain(name):
    x = (name[3:] if name[2:3] == ":" else name).replace("-", " ").strip()
    return x[:1].upper() + x[1:].lower()


@pytest.mark.parametrize("a_task", [7, 8192])
def test_labels_by_place_each_once_in_any_case(spark, monkeypatch, a_task):
    """Against brute force: repeated links, places that are missing or shared, names without letters or missing."""
    for limit in ("FEW_CODES", "CODES_A_TASK"):
        monkeypatch.setattr(catalog, limit, a_task, raising=False)
    rnd = random.Random(5)
    names = {1: "en:sugar", 2: "fr:Sugar", 3: "cane-sugar", 4: "SEL", 5: "sel", 6: "en:", 7: None, 8: "água", 9: "ÁGUA", 10: " - "}
    links = [(str(rnd.randint(0, 59)), rnd.randint(1, 11), rnd.choice([None, 1, 2, 3, 2**31 - 1])) for _ in range(900)]
    links += links[:200] + [(None, 1, 1), ("0", None, 1)]
    products = spark.createDataFrame([(f" {i} ", i) for i in range(70)], "code string, n int").withColumn("categorie_principale", F.lit(None).cast("long"))
    c = catalog.Catalog(
        products, spark.createDataFrame([], "category_id long, category_name string"), spark.createDataFrame(list(names.items()), "ingredient_id long, ingredient_name string"),
        spark.createDataFrame(links, "code string, ingredient_id long, ingredient_order int"),
    )
    expected = {}
    for i in range(70):
        places = sorted({(2**31 - 1 if n is None else n, names[k]) for code, k, n in links if code == str(i) and names.get(k)})
        first = {}
        for _, name in places:
            if plain(name):
                first.setdefault(plain(name).lower(), plain(name))
        expected[str(i)] = list(first.values())
    codes = [str(i) for i in range(70)]
    found = catalog.details(c, spark.createDataFrame([(x, 0) for x in [*codes, "none"]], "code string, pos int"))
    assert {r["code"]: r["ingredients"] for r in found.collect()} == expected
    assert [(r["code"], r["ingredients"]) for r in catalog.details(c, codes).collect()] == list(expected.items())


def test_tasks_grow_with_codes(spark, monkeypatch):
    """A task's memory stays: many codes come in more tasks, however small Spark thinks these are."""
    for limit in ("FEW_CODES", "CODES_A_TASK"):
        monkeypatch.setattr(catalog, limit, 10, raising=False)
    rows = queries.QUERIES["catalog_detail_ingredients_all"](spark, SF)
    codes = spark.read.parquet(f"{SF}/part.parquet").count()
    assert codes > 100 and rows.rdd.getNumPartitions() == -(-codes // 10)


def test_links_are_shuffled_once(spark, monkeypatch):
    """No row of links is sorted or hashed before it comes to its product's task."""
    monkeypatch.setattr(catalog, "FEW_CODES", 10, raising=False)
    rows = queries.QUERIES["catalog_detail_ingredients_all"](spark, SF)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Aggregate(keys=[code" in plan and "ingredient_id" not in "".join(x for x in plan.splitlines() if "Aggregate(" in x)


def test_few_codes_are_not_dealt(spark):
    c = star(spark, SF)
    plan = catalog.details(c, c.products.where("p_partkey < 9").select("code", F.lit(0).alias("pos")))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" not in plan
