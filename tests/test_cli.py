from pyspark.sql import functions as F

from catalyne import cli


def test_steps(spark, tmp_path):
    at = lambda x: f"{tmp_path}/{x}"
    kind = "code string, lang string, product_name array<struct<lang:string,text:string>>, countries_tags array<string>, categories_tags array<string>, nutriments array<struct<name:string,`100g`:double>>, ingredients string"
    rows = [("1", "en", [("main", "Syrup")], ["en:canada"], ["en:food"], [], '[{"text": "Sugar"}]'), ("2", "fr", [("main", "X")], ["en:canada"], None, [], None), ("3", "en", None, ["en:france"], None, None, None)]
    spark.createDataFrame(rows, kind).write.parquet(at("raw"))
    (tmp_path / "cats.txt").write_text("en:food\n")
    (tmp_path / "ings.txt").write_text("en:sugar\n")
    spark.sql("DROP DATABASE IF EXISTS t_cli CASCADE")
    cli.main(["filter_data", "--input", at("raw"), "--output", at("f")])
    cli.main(["validate_data", "--input", at("f"), "--output", at("v"), "--invalid", at("i"), "--run", "r", "--table", "t_cli.runs"])
    cli.main(["transform_data", "--input", at("v"), "--output", at("t")])
    cli.main(["normalize_categories", "--input", at("t"), "--output", at("c"), "--closure", at("a"), "--principal", at("p"), "--taxonomy", at("cats.txt")])
    cli.main(["normalize_ingredients", "--input", at("t"), "--output", at("n"), "--products", at("pi"), "--parts", at("s"), "--aliases", at("al"), "--taxonomy", at("ings.txt")])
    cli.main(["finalize_products", "--input", at("t"), "--principal", at("p"), "--output", at("final")])
    cli.main(["load_data", "--input", at("final"), "--table", "t_cli.products"])
    cli.main(["merge_data", "--input", at("final"), "--table", "t_cli.products"])
    cli.main(["load_delta", "--input", at("a"), "--table", "t_cli.up", "--key", "category_id", "--key2", "category_id_parent"])
    assert spark.table("t_cli.products").select("code", F.col("categorie_principale").isNotNull()).collect() == [("1", True)]
    assert spark.read.parquet(at("i")).count() == 1 and spark.table("t_cli.runs").first()["rejection_rate"] == 50.0
    assert [r["ingredient_name"] for r in spark.read.parquet(at("pi")).collect()] == ["sugar"]


def test_delta_steps(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"code": "1", "lang": "en", "countries_tags": ["en:canada"], "brand": "B"}\n')
    (tmp_path / "index.txt").write_text("b\n\na\n")
    cli.main(["fetch_delta_index", "--input", f"{tmp_path}/index.txt", "--output", f"{tmp_path}/r.json"])
    assert (tmp_path / "r.json").read_text() == '["a", "b"]'
    cli.main(["extract_delta", "--input", f"{tmp_path}/d.json", "--output", f"{tmp_path}/x"])
    cli.main(["filter_delta", "--input", f"{tmp_path}/x", "--output", f"{tmp_path}/y", "--columns", "code,brands|brand", "--lang", "EN"])
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/y").collect()] == [("1", "B")]
