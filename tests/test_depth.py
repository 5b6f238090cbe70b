"""Trees and chains deeper than any table at hand."""

import json

from catalyne.operators import ingredients, taxonomy


def test_every_ancestor_of_a_long_chain(spark):
    edges = spark.createDataFrame([(f"t{i}", f"t{i + 1}") for i in range(110)], "tag string, parent string")
    start = spark.createDataFrame([("t0",)], "tag string")
    assert {r["distance"]: r["ancestor"] for r in taxonomy.closure(edges, start).collect()} == {i: f"t{i}" for i in range(1, 111)}


def test_every_level_of_a_deep_tree(spark):
    tree = []
    for i in reversed(range(110)):
        tree = [{"id": f"en:{i}", "ingredients": tree}]
    products = spark.createDataFrame([("1", json.dumps(tree))], "code string, ingredients string")
    assert {r["level"]: r["id"] for r in ingredients.tree_nodes(products).collect()} == {i + 1: f"en:{i}" for i in range(110)}
