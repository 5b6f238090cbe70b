"""A whole weekly delta: index, files in order of name, tables, counts, and runs that break off."""

import gzip
import json

import pytest
from test_operators import FOODS, INGREDIENTS

from catalyne.operators import taxonomy
from catalyne.plans import load
from catalyne.sources import sinks
from catalyne.streaming import incremental

SPEC = "code,product_name,nutrition,categories_tags,ingredients,countries_tags,brands|brand"
TABLES = ["categories", "ancetre_categories", "products", "ingredients", "product_ingredients", "sous_ingredients", "ingredient_alias"]


def record(code, name, country="en:canada", **more):
    return {"code": code, "product_name": name, "countries_tags": [country], "nutrition": {"aggregated_set": {"nutrients": {"fat": {"value": 1.234}}}}, "categories_tags": ["en:maple-syrup"], "ingredients": [{"text": "Sugar", "ingredients": [{"text": "Salt"}]}], **more}


FILES = {
    "delta_1.json.gz": [record("1", "one"), record("2", "two", lang="fr"), record("3", "elsewhere", country="en:france"), record("", "no code")],
    "delta_2.json.gz": [record("2", "two, newer", categories_tags=["en:drinks"]), record("4", "four", brand="B"), {"code": "5", "countries_tags": ["en:canada"]}],
    "delta_3.json.gz": [record("1", "one, newest")],
}


@pytest.fixture
def source(tmp_path):
    for n, rows in FILES.items():
        (tmp_path / n).write_bytes(gzip.compress("\n".join(map(json.dumps, rows)).encode()))
    (tmp_path / "index.txt").write_text("delta_2.json.gz\n\n delta_1.json.gz \n")
    return tmp_path


def job(spark, source, schema):
    spark.sql(f"DROP DATABASE IF EXISTS {schema} CASCADE")
    taxes = taxonomy.parse_categories(FOODS), taxonomy.parse_ingredients(INGREDIENTS)
    return load.WeeklyDelta(f"file://{source}", f"file://{source}/{schema}", schema, SPEC, *taxes, runs=f"{schema}.runs")


def held(spark, schema):
    return {t: sorted(map(str, sinks.read_table(spark, f"{schema}.{t}").collect())) for t in TABLES}


def test_files_in_order_of_name_and_once(spark, source):
    delta = job(spark, source, "t_delta")
    index, checkpoint = f"file://{source}/index.txt", f"file://{source}/cp"
    assert delta.run(spark, index, checkpoint) == ["delta_1.json.gz", "delta_2.json.gz"]
    rows = {r["code"]: r for r in spark.table("t_delta.products").collect()}
    assert {c: r["product_name"] for c, r in rows.items()} == {"1": "one", "2": "two, newer", "4": "four"}
    assert rows["4"]["brands"] == "B" and rows["1"]["fat_100g"] == 1.23
    runs = {r["dag_run_id"]: (r["records_in"], r["records_out"], r["records_rejected"]) for r in spark.table("t_delta.runs").collect()}
    assert runs == {"weekly_delta:delta_1.json.gz": (3, 2, 1), "weekly_delta:delta_2.json.gz": (3, 2, 1)}
    assert spark.read.parquet(f"file://{source}/t_delta/delta_1.json.gz/rejected").count() == 1
    assert spark.table("t_delta.sous_ingredients").count() == 3
    assert delta.run(spark, index, checkpoint) == []
    (source / "index.txt").write_text("\n".join(FILES))
    assert delta.run(spark, index, checkpoint) == ["delta_3.json.gz"]
    assert spark.table("t_delta.products").where("product_name = 'one, newest'").count() == 1


@pytest.mark.parametrize("table", ["ingredients", "sous_ingredients"])
def test_a_run_that_breaks_off_in_the_middle_of_a_file(spark, source, monkeypatch, table):
    job(spark, source, "t_whole").run(spark, f"file://{source}/index.txt", f"file://{source}/cp_whole")
    delta, real, seen = job(spark, source, "t_broken"), load.upsert, []

    def breaks(rows, name, **more):
        if name.endswith(f".{table}") and (seen.append(name) or len(seen) == 2):
            raise RuntimeError("lost")
        real(rows, name, **more)

    monkeypatch.setattr(load, "upsert", breaks)
    index, checkpoint = f"file://{source}/index.txt", f"file://{source}/cp_broken"
    with pytest.raises(Exception):
        delta.run(spark, index, checkpoint)
    monkeypatch.undo()
    before = sinks.versioned(spark, "t_broken.categories").state().version
    assert delta.run(spark, index, checkpoint) == ["delta_1.json.gz", "delta_2.json.gz"]
    assert held(spark, "t_broken") == held(spark, "t_whole")
    # What had both files already was left alone.
    assert sinks.versioned(spark, "t_broken.categories").state().version == before


def test_names_rule_and_an_index_may_shrink(spark, tmp_path):
    def index(*names):
        return spark.createDataFrame([(n,) for n in names], "file string")

    seen, at = [], f"file://{tmp_path}/cp"
    assert incremental.stream_names(spark, index(), seen.append, at) == []
    assert incremental.stream_names(spark, index("b", "a", None, "b"), seen.append, at) == ["a", "b"]
    with pytest.raises(Exception):
        incremental.stream_names(spark, index("c", "d"), lambda f: seen.append(f) if f == "c" else 1 / 0, at)
    assert incremental.stream_names(spark, index("d", "c"), seen.append, at) == ["c", "d"]
    assert seen == ["a", "b", "c", "c", "d"]
