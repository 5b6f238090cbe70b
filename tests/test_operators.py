import gzip
import io
import json
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalyne import schemas
from catalyne.functions import numeric, text
from catalyne.operators import catalog, columns, compare, filters, ingredients, rules, search, taxonomy, transform
from catalyne.plans import load
from catalyne.sources import readers, sinks
from catalyne.streaming import incremental

FOODS = """
stopwords:en: the

en:food

< en:food
en:beverages, drinks
fr:boissons

< en:food
en:sweeteners

< en:sweeteners
en:syrups

< en:syrups
en:maple syrups, maple syrup
fr:sirops d'érable

# the last parent counts
< en:sweeteners
< en:syrups
en:simple syrups

< en:maple   syrups
xx: no english here
"""


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def test_texts(spark):
    lit = F.lit
    assert one(spark, text.clean_name(lit("en:plant-based-Foods"))) == "Plant based foods"
    assert one(spark, text.clean_text(lit("_Soy_ Lécithin <b>(E322)</b> ﬁ"))) == "Soy Lecithin E322 fi"
    assert one(spark, text.slug(lit("Whole / Wheat,  Flour-"))) == "whole-wheat-flour"
    assert one(spark, text.tag_name(lit("fr:beurre-de:cacao"))) == "beurre de:cacao"
    assert one(spark, text.tag_name(lit("e150a"))) == "e150a"
    assert one(spark, text.normalized(lit("fr:Crème-Brûlée  n°5"))) == "creme brulee n 5"
    assert one(spark, text.normalized(lit(None).cast("string"))) == ""
    assert one(spark, text.tokens(text.normalized(lit("The organic 42 maple x syrup")))) == ["maple", "syrup"]
    assert one(spark, text.code_path(lit("12345"))) == "000/000/001/2345"
    assert one(spark, text.code_path(lit("3017620422003"))) == "301/762/042/2003"
    assert one(spark, text.code_path(lit("30176204220031"))) == "301/762/042/20031"
    assert one(spark, text.digit_stem(lit("off_1700_1800.json.gz"))) == "1700_1800"
    assert one(spark, text.split_property(lit("en: en:Emulsifier, en:stabiliser"))) == ["en:emulsifier", "en:stabiliser"]
    assert one(spark, text.literal_list(lit("['en:a', 'en:b']"))) == ["en:a", "en:b"]
    assert one(spark, text.literal_list(lit("[broken"))) == []
    assert one(spark, text.is_language_code(lit("fra"))) and not one(spark, text.is_language_code(lit("e150")))
    assert one(spark, text.stable_id(lit("en:sugar"))) == 7071660975026803004
    assert taxonomy.plain_slug("Sirop d'Érable") == one(spark, text.slug(lit("Sirop d'Érable")))


def test_numbers(spark):
    lit = F.lit
    assert [one(spark, numeric.grade_value(lit(g))) for g in ("A", "e", "f", "", "ab")] == [5, 1, None, None, None]
    assert one(spark, numeric.log_feature(lit("x"))) == 0 and one(spark, numeric.log_feature(lit(-3.0))) == 0
    assert one(spark, numeric.log_feature(lit(float("inf")))) == 0 and one(spark, numeric.log_feature(lit(float("nan")))) == 0
    zero, unit = F.array(lit(0.0), lit(0.0)), F.array(lit(3.0), lit(4.0))
    assert one(spark, numeric.cosine(zero, unit)) == 0 and one(spark, numeric.cosine(unit, unit)) == pytest.approx(1)
    assert one(spark, numeric.euclidean_similarity(zero, zero)) == 0 and one(spark, numeric.euclidean_similarity(unit, unit)) == 1
    assert sinks.rejection_rate(1000, 100) == 10 and sinks.rejection_rate(200, 50) == 25 and sinks.rejection_rate(0, 0) == 0


def test_fuzzy():
    assert text.fuzzy("", "a") == 0 and text.fuzzy("a", None) == 0
    assert text.fuzzy("maple", "pure maple syrup") == 1 and text.fuzzy("maplesyrup", "maple syrup") == 0.95
    assert 0.75 < text.fuzzy("mapel", "pure maple syrup") < 0.95


def test_columns(spark):
    rows = spark.createDataFrame([("1", "b", 1.5)], "code string, environmental_grade string, x double")
    got = columns.resolve(rows, "code, grade|environmental_grade ,absent|missing")
    assert got.columns == ["code", "grade", "absent"] and got.first()["grade"] == "b" and got.first()["absent"] is None
    assert columns.keep_columns("a,b|c") == {"a", "b", "c"} and columns.keep_columns(None) is None
    assert columns.conform(rows, schemas.TRANSFORMED).schema.fieldNames() == schemas.TRANSFORMED.fieldNames()
    assert len(schemas.TRANSFORMED) == 34


def test_rules(spark):
    rows = spark.createDataFrame([("111", "n", "x", ["a"]), ("", "n", "x", ["a"]), (None, "n", "x", ["a"]), ("4", None, "x", ["a"]), ("5", "n", "x", None)], "code string, product_name string, nutriments string, categories_tags array<string>")
    good = rules.judged(rows, rules.snapshot_rules())
    assert [r["code"] for r in good.where("valid").collect()] == ["111"] and good.count() == 5
    assert dict(map(tuple, rules.failures(rows, rules.snapshot_rules()).collect()))["code_not_blank"] == 2
    assert tuple(rules.summary(rows, rules.snapshot_rules()).first()) == (5, 1, 4, 80.0)
    assert rules.summary(rows.limit(0), rules.snapshot_rules()).first()["rejection_rate"] == 0.0


def test_transform_snapshot(spark):
    row = {"code": "3017620422003", "brands": "B", "nutriscore_grade": "unknown", "ecoscore_grade": "a-plus", "product_name": [("fr", "Nom"), ("main", "Name")], "images": [("front_en", None), ("front_en", 7)], "nutriments": [("fat", 30.9456789), ("energy-kcal", 100.0)]}
    kind = "code string, brands string, nutriscore_grade string, ecoscore_grade string, product_name array<struct<lang:string,text:string>>, images array<struct<key:string,rev:bigint>>, nutriments array<struct<name:string,`100g`:double>>"
    got = transform.transform_snapshot(spark.createDataFrame([row], kind), "https://i").first()
    assert got["product_name"] == "Name" and got["fat_100g"] == 30.95 and got["energy_kcal_100g"] == 100 and got["salt_100g"] is None
    assert got["front_url"] == "https://i/301/762/042/2003/front_en.7.400.jpg" and got["nutrition_url"] is None
    assert got["nutriscore_grade"] is None and got["ecoscore_grade"] == "a-plus"


def test_transform_delta(spark):
    row = ("12345", "N", '{"selected": {"front": {"en": {"rev": "\\"5\\""}}}}', '{"aggregated_set": {"nutrients": {"saturated-fat": {"value": 30.9456789}}}}', '["en:a"]')
    rows = spark.createDataFrame([row, ("1", "M", "{bad", None, None)], "code string, product_name string, images string, nutrition string, categories_tags string")
    got = {r["code"]: r for r in transform.transform_delta(rows, "https://i").collect()}
    assert got["12345"]["front_url"] == "https://i/000/000/001/2345/front_en.5.400.jpg"
    assert got["12345"]["saturated_fat_100g"] == 30.95 and got["12345"]["categories_tags"] == ["en:a"]
    assert got["1"]["front_url"] is None and got["1"]["fat_100g"] is None


def test_taxonomy():
    t = taxonomy.parse_categories(FOODS)
    assert t.canonical["en:drinks"] == t.canonical["fr:boissons"] == "en:beverages" and t.canonical["en:maple-syrup"] == "en:maple-syrups"
    assert t.parents["en:food"] is None and t.parents["en:simple-syrups"] == "en:syrups" and "xx:no-english-here" not in t.canonical


def test_categories(spark):
    products = spark.createDataFrame([("1", [" EN:Drinks", "fr:boissons", "en:maple-syrup"]), ("2", ["en:odd"]), ("3", None)], "code string, categories_tags array<string>")
    cats, links, principal = taxonomy.normalize_categories(products, taxonomy.parse_categories(FOODS))
    names = {r["category_id"]: r["category_name"] for r in cats.collect()}
    assert set(names.values()) == {"en:beverages", "en:maple-syrups", "en:syrups", "en:sweeteners", "en:food", "en:odd"}
    steps = {(names[r["category_id"]], names[r["category_id_parent"]]): r["distance"] for r in links.collect()}
    assert {a: d for (c, a), d in steps.items() if c == "en:maple-syrups"} == {"en:syrups": 1, "en:sweeteners": 2, "en:food": 3}
    last = {r["code"]: names.get(r["categorie_principale"]) for r in principal.collect()}
    assert last == {"1": "en:maple-syrups", "2": "en:odd", "3": None}
    assert [x.count() for x in taxonomy.normalize_categories(products.drop("categories_tags"), taxonomy.Taxonomy())] == [0, 0, 0]


def test_closure_of_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "d")], "tag string, parent string")
    assert sorted(map(tuple, taxonomy.closure(edges).collect())) == [("a", "b", 1), ("a", "c", 2), ("b", "a", 2), ("b", "c", 1), ("c", "a", 1), ("c", "b", 2)]


INGREDIENTS = "en: sugar, cane sugar\nfr: sucre\n\nen: cocoa\n\nen: chocolate\n\nen: E471\nadditives_classes: en: en:emulsifier\n"


def test_ingredients(spark):
    tree = [{"id": "en:chocolate", "text": "Chocolat", "ingredients": [{"text": "Cocoa"}, "stray", {"id": "", "text": "<b>"}, {"text": "_Sucre_"}]}, 5, {"text": "", "ingredients": [{"id": "en:lost"}]}, {"id": "en:e471"}]
    products = spark.createDataFrame([("1", json.dumps(tree)), ("2", "not json"), ("3", None), ("4", '{"id": "x"}')], "code string, ingredients string")
    t = taxonomy.parse_ingredients(INGREDIENTS)
    roles = taxonomy.additive_roles(t, taxonomy.parse_ingredients("en: emulsifier"))
    assert roles == {"en:e471": "emulsifier"}
    names, product, sub, aliases = ingredients.normalize_ingredients(products, t, roles)
    assert sorted((r["ingredient_name"], r["ingredient_order"], r["role"]) for r in product.collect()) == [("chocolate", 1, None), ("e471", 4, "emulsifier")]
    known = {r["ingredient_id"]: r["ingredient_name"] for r in names.collect()}
    assert sorted((known[r["ingredient_id"]], r["sous_ingredient_name"], r["rang"]) for r in sub.collect()) == [("chocolate", "cocoa", 1), ("chocolate", "sugar", 4)]
    assert sorted((known[r["ingredient_id"]], r["alias_name"]) for r in aliases.collect()) == [("chocolate", "chocolat"), ("sugar", "sucre")]
    assert [x.count() for x in ingredients.normalize_ingredients(products.drop("ingredients"), t)] == [0] * 4


def test_sources(spark, tmp_path):
    raw = io.BytesIO()
    pd.DataFrame({"a": [1, 2, 3]}).to_parquet(raw)
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("notes.txt", "x")
        z.writestr("in/data.parquet", raw.getvalue())
    assert readers.read_zip_parquet(spark, str(tmp_path / "x.zip"), f"file://{tmp_path}/stage").count() == 3
    (tmp_path / "bad.zip").write_text("no archive")
    with pytest.raises(ValueError):
        readers.read_zip_parquet(spark, str(tmp_path / "bad.zip"), str(tmp_path))
    lines = [{"code": "1", "countries_tags": ["en:Canada"], "max_imgid": 3, "images": {"a": 1}}, {"code": "2", "countries_tags": ["en:france"]}, {"code": "3", "countries_tags": "en:canada", "max_imgid": "7"}]
    with gzip.open(tmp_path / "d.json.gz", "wt") as f:
        f.write("\n".join(map(json.dumps, lines)) + "\n\nbroken\n")
    rows = readers.read_delta(spark, str(tmp_path / "d.json.gz"), "canada")
    assert rows.columns == ["code", "countries_tags", "images", "max_imgid"]
    got = rows.collect()
    assert [r["code"] for r in got] == ["1"] and got[0]["max_imgid"] == "3" and json.loads(got[0]["images"]) == {"a": 1}
    assert readers.read_delta(spark, str(tmp_path / "d.json.gz"), columns="code,x|max_imgid").columns == ["code", "max_imgid", "x"]
    (tmp_path / "index.txt").write_text(" b.gz\n\na.gz \n")
    assert [r["file"] for r in readers.read_index(spark, str(tmp_path / "index.txt")).collect()] == ["a.gz", "b.gz"]
    assert readers.first_table(spark, "nowhere.x", "absent") is None


def test_upsert_and_runs(spark):
    rows = spark.createDataFrame([("1", "a"), ("2", "b")], "code string, v string")
    spark.sql("DROP DATABASE IF EXISTS t_up CASCADE")
    sinks.upsert(rows, "t_up.products")
    batch = spark.createDataFrame([("2", "c"), ("2", "d"), ("3", "e")], "code string, v string")
    for _ in range(2):
        sinks.upsert(batch, "t_up.products")
    assert sorted(map(tuple, spark.table("t_up.products").collect())) == [("1", "a"), ("2", "c"), ("2", "d"), ("3", "e")]
    sinks.upsert(rows, "t_up.other", ["code"])
    sinks.upsert(batch, "t_up.other", ["code"], dedupe="v")
    assert sorted(map(tuple, spark.table("t_up.other").collect())) == [("1", "a"), ("2", "d"), ("3", "e")]
    broken = batch.withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        sinks.upsert(broken, "t_up.products")
    assert spark.table("t_up.products").count() == 4
    assert not sinks.record_run(spark, "validate", 10, 8, 2, None)
    for n in (2, 3):
        assert sinks.record_run(spark, "validate", 10, 10 - n, n, "run1", table="t_up.pipeline_runs")
    assert [(r["records_rejected"], r["rejection_rate"]) for r in spark.table("t_up.pipeline_runs").collect()] == [(3, 30.0)]


def test_quarantine(spark, tmp_path):
    rows = spark.range(5).withColumn("valid", F.col("id") < 2)
    sinks.quarantine(rows, str(tmp_path / "good"), str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "good")).count() == 2 and spark.read.parquet(str(tmp_path / "bad")).count() == 3


def test_loads(spark):
    taxes = taxonomy.parse_categories(FOODS), taxonomy.parse_ingredients(INGREDIENTS)
    kind = "code string, lang string, product_name array<struct<lang:string,text:string>>, countries_tags array<string>, categories_tags array<string>, nutriments array<struct<name:string,`100g`:double>>, ingredients string"
    rows = [("1", "en", [("main", "Syrup")], ["en:Canada"], ["en:maple-syrup"], [("fat", 1.0)], '[{"text": "Sugar"}]'), ("2", "en", [("main", "X")], ["en:france"], ["en:food"], [], None), ("", "en", [("main", "Y")], ["en:canada"], ["en:food"], [], None)]
    made = load.load_snapshot(spark.createDataFrame(rows, kind), *taxes)
    assert made["products"].count() == 1 and made["rejected"].count() == 1
    assert "categories_tags" not in made["products"].columns and made["products"].first()["categorie_principale"] is not None
    spark.sql("DROP DATABASE IF EXISTS t_load CASCADE")
    load.store(made, "t_load", replace=True)
    delta = spark.createDataFrame([("1", "Syrup 2", '{"aggregated_set": {}}', '["en:drinks"]', "[]")], "code string, product_name string, nutrition string, categories_tags string, ingredients string")
    load.store(load.load_delta(delta, "code,product_name,nutrition,categories_tags,ingredients,brands|brand", *taxes), "t_load", replace=False)
    c = catalog.Catalog.of(spark, "t_load")
    got = catalog.details(c, ["1", "x"]).collect()
    assert len(got) == 1 and got[0]["product_name"] == "Syrup 2" and [x["display"] for x in got[0]["categories"]] == ["Food > Beverages"]
    assert catalog.product_list(c, name="syrup").count() == 1
    with pytest.raises(ValueError):
        catalog.product_list(c, limit=0)


def test_search(spark):
    rows = spark.createDataFrame([("123", "Maple syrup", "Acme"), ("2", "Sugar", "Maple Co"), ("3", None, None)], "code string, product_name string, brands string")
    assert [r["code"] for r in search.search(rows, "maple syrup").collect()][0] == "123"
    assert [(r["code"], r["search_score_pct"]) for r in search.search(rows, "123").collect()] == [("123", 100)]
    assert search.search(rows, " - ").count() == 0
    assert [r["code"] for r in search.search(rows, "mapel sirup").collect()][0] == "123"
    assert [r["code"] for r in search.search(rows, "maple", brand="maple co").collect()] == ["2"]
    assert search.search(rows, "maple", min_score=0.5).count() == 1


def test_compare(spark):
    keys = [m.key for m in compare.METRICS]
    rows = spark.createDataFrame([("1", "A", "a", *[1.0] * 11), ("2", "B", "e", *[2.0] * 11), ("3", "C", None, *[None] * 11)], "code string, product_name string, nutriscore_grade string, " + ", ".join(f"{k} double" for k in keys))
    scores = {r["code"]: r["score"] for r in compare.health_scores(rows).collect()}
    assert scores == {"1": round(6 / 7 * 100, 2), "2": round(1 / 7 * 100, 2), "3": 0.0}
    assert {r["points"] for r in compare.radar(rows).where("code = '3'").collect()} == {0}
    assert {r["points"] for r in compare.radar(rows.where("code = '1'")).collect()} == {50}
    best = compare.best_values(compare.long_form(rows)).where("is_best")
    assert {(r["code"], r["metric"]) for r in best.collect()} >= {("1", "fat_100g"), ("2", "proteins_100g")}
    assert compare.best_values(compare.long_form(rows.where("code = '1'"))).where("is_best").count() == 0
    assert [r["product_name"] for r in compare.insights(rows).collect()] == ["B", "A", "B"]
    with pytest.raises(ValueError):
        compare.compare(None, ["1"])


def test_filters(spark):
    rows = spark.createDataFrame([("a", 1.0), (None, None), ("x", 1.0), ("b", 9.0)], "nutriscore_grade string, salt_100g double")
    rows = rows.withColumns({c: F.lit(None).cast("double") for c in ("sugars_100g", "energy_kcal_100g", "fat_100g")})
    assert rows.where(filters.page_filter()).count() == 3 and rows.where(filters.page_filter({"A", "b"})).count() == 1
    tags = spark.createDataFrame([(["en:Canada"],), ([],), (None,), ([None],)], "t array<string>")
    assert tags.where(filters.has_tag("t", "CANADA")).count() == 1


def test_increments(spark, tmp_path):
    spark.sql("DROP DATABASE IF EXISTS t_inc CASCADE")
    index = spark.createDataFrame([("b",), ("a",)], "file string")
    seen = []
    assert incremental.run_pending(spark, index, seen.append, "t_inc.checkpoint") == ["a", "b"] == seen
    more = index.union(spark.createDataFrame([("c",)], "file string"))
    with pytest.raises(RuntimeError):
        incremental.run_pending(spark, more, lambda f: (_ for _ in ()).throw(RuntimeError(f)), "t_inc.checkpoint")
    assert incremental.run_pending(spark, more, seen.append, "t_inc.checkpoint") == ["c"]
    assert incremental.run_pending(spark, more, seen.append, "t_inc.checkpoint") == []
    source = tmp_path / "in"
    source.mkdir()
    for n, rows in (("1.json", [{"code": "1", "v": "a"}, {"code": "2", "v": "a"}]), ("2.json", [{"code": "2", "v": "b"}])):
        (source / n).write_text("\n".join(map(json.dumps, rows)))
        q = incremental.stream_files(spark, str(source), "code string, v string", incremental.upsert_batches("t_inc.rows", ["code"]), str(tmp_path / "cp"))
        q.awaitTermination(120)
    assert sorted(map(tuple, spark.table("t_inc.rows").collect())) == [("1", "a"), ("2", "b")]


def test_countries_of_arrays_and_of_printed_lists(spark):
    printed = ["['en:Canada', 'en:france']", "['en:france']", "en:canada", "", None, "[", "'en:canada'"]
    df = spark.createDataFrame(list(enumerate(printed)), "i int, countries_tags string")
    assert [r["i"] for r in load.select_rows(df, "canada").collect()] == [0]
    arrays = spark.createDataFrame([(0, ["en:Canada"]), (1, ["en:usa", None]), (2, []), (3, None)], "i int, countries_tags array<string>")
    assert [r["i"] for r in load.select_rows(arrays, "canada").collect()] == [0]


def test_the_first_nutrient_of_a_name_decides(spark):
    from catalyne.functions.nested import field_of, field_of_first

    df = spark.sql("SELECT array(named_struct('name', 'fat', '100g', CAST(null AS double)), named_struct('name', 'fat', '100g', 3d), named_struct('name', 'salt', '100g', 1d)) AS n")
    row = df.select(field_of_first("n", "name", "fat", "100g").alias("a"), field_of("n", "name", "fat", "100g").alias("b"), field_of_first("n", "name", "salt", "100g").alias("c"), field_of_first("n", "name", "x", "100g").alias("d")).first()
    assert tuple(row) == (None, 3.0, 1.0, None)
