"""Ingredient trees against a plain walk, and in time in proportion to their nodes."""

import json
import random
import time

from catalyne.functions.text import clean_text, slug
from catalyne.operators import ingredients, taxonomy

TAXONOMY = taxonomy.Taxonomy({"en:sugar": "en:sugar", "fr:sucre": "en:sugar", "x:1": "en:one"})
TEXTS = ["Sugar", "sucre", "Sücré é", "", " ", None, "<b>", "<b> salt_x</b>", "日本", "½", "\ufe64b\ufe65", "...", "-", "/,", "%", "a-b--c", "ﬁn"]
IDS = [None, "", "  ", "X:1", " en:other ", 5]


def tree(rnd, depth):
    out = []
    for _ in range(rnd.randint(0, 4)):
        node = {}
        if (i := rnd.choice(IDS)) is not None or rnd.random() < 0.3:
            node["id"] = i
        if rnd.random() < 0.9:
            node["text"] = rnd.choice(TEXTS)
        if depth and rnd.random() < 0.7:
            node["ingredients"] = tree(rnd, depth - 1)
        elif rnd.random() < 0.1:
            node["ingredients"] = {"text": "no list"}
        out.append(node if rnd.random() < 0.9 else rnd.choice(["text", 3, None, []]))
    return out


def walk(code, items, tag_of, parent=None, level=1):
    for place, node in enumerate(items, 1):
        if isinstance(node, dict) and (tag := tag_of(node)):
            yield code, place, level, tag, parent
            below = node.get("ingredients")
            yield from walk(code, below if isinstance(below, list) else [], tag_of, tag, level + 1)


def test_trees_against_a_walk(spark):
    rnd = random.Random(1)
    products = {str(i): tree(rnd, 4) for i in range(150)}
    texts = spark.createDataFrame([(t,) for t in TEXTS if t is not None], "t string")
    slugs = {r["t"]: r["s"] for r in texts.select("t", slug("t").alias("s"), clean_text("t")).collect()}

    def tag_of(node):
        own = str(node["id"]).strip().lower() if node.get("id") is not None else ""
        s = slugs.get(node.get("text")) or ""
        named = [x for x in (own, s and f"en:{s}", s and f"fr:{s}") if x]
        return next((TAXONOMY.canonical[x] for x in named if x in TAXONOMY.canonical), named[0] if named else None)

    expected = sorted((x for c, t in products.items() for x in walk(c, t, tag_of)), key=repr)
    rows = spark.createDataFrame([(c, json.dumps(t)) for c, t in products.items()] + [("no json", "{"), ("an object", '{"text": "a"}'), ("null", None)], "code string, ingredients string")
    got = ingredients.resolved(ingredients.tree_nodes(rows), TAXONOMY.tags(spark)).select("code", "place", "level", "tag", "parent").collect()
    assert sorted(map(tuple, got), key=repr) == expected and len(expected) > 300


def test_a_large_product_costs_its_nodes(spark):
    def seconds(n):
        items = [{"text": f"a{i}", "ingredients": [{"id": f"b{i}"}]} for i in range(n // 2)]
        rows = spark.createDataFrame([("1", json.dumps(items))], "code string, ingredients string")
        began = time.perf_counter()
        made = ingredients.normalize_ingredients(rows, TAXONOMY)
        assert made[1].count() == n // 2 == made[2].count()
        return time.perf_counter() - began

    seconds(200)
    small, large = seconds(2_000), seconds(20_000)
    print(f"2,000 nodes: {small:.1f} s, 20,000 nodes: {large:.1f} s")
    assert large < 10 * small + 5


def test_two_levels_take_one_pass(spark, monkeypatch):
    """Recursion is for what lies below the second level alone; the tables come from the nodes as they were written."""
    passes, real = [], ingredients.written
    monkeypatch.setattr(ingredients, "written", lambda df, name: passes.append(name) or real(df, name))
    monkeypatch.setattr(ingredients, "endless_recursion", lambda spark: (_ for _ in ()).throw(AssertionError("recursion")))
    items = [{"id": "x:1", "ingredients": [{"text": "Sugar"}, 3, {"text": "salt", "ingredients": []}]}, {"text": "<b>", "ingredients": [{"text": "lost"}]}]
    rows = spark.createDataFrame([("1", json.dumps(items))], "code string, ingredients string")
    names, product, sub, _ = ingredients.normalize_ingredients(rows, TAXONOMY)
    assert passes == ["nodes"]
    assert [(r["ingredient_name"], r["ingredient_order"]) for r in product.collect()] == [("one", 1)]
    assert sorted((r["sous_ingredient_name"], r["rang"]) for r in sub.collect()) == [("salt", 3), ("sugar", 1)]
    assert {r["ingredient_name"] for r in names.collect()} == {"one", "sugar", "salt"}


def test_limits_of_recursion_are_as_before(spark):
    spark.conf.set("spark.sql.cteRecursionLevelLimit", "77")
    rows = spark.createDataFrame([("1", "[]")], "code string, ingredients string")
    assert ingredients.tree_nodes(rows).count() == 0
    assert spark.conf.get("spark.sql.cteRecursionLevelLimit") == "77"
    spark.conf.unset("spark.sql.cteRecursionLevelLimit")
