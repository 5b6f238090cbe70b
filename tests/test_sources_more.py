"""Sorted files, archives larger than memory, answers of a service, and texts to show."""

import zipfile

import pytest
from pyspark.sql import functions as F

from catalyne.functions import text
from catalyne.sources import answers, readers, sinks


def test_a_key_lookup_reads_one_file(spark, tmp_path):
    path = f"file://{tmp_path}/sorted"
    rows = spark.range(1000).select(F.format_string("%05d", (F.col("id") * 7919) % 1000).alias("code"), "id")
    rows = rows.unionByName(spark.createDataFrame([(None, 1)], "code string, id long"))
    sinks.write_sorted(rows, path, ["code", "id"], files=8)
    assert spark.read.parquet(path).count() == 1001
    files = {f.split("/")[-1]: [r["code"] for r in spark.read.parquet(f).collect()] for f in spark.read.parquet(path).inputFiles()}
    assert len(files) == 8 and all([c for c in v if c] == sorted(c for c in v if c) for v in files.values())
    one = readers.read_range(spark, path, "00500", "00500")
    assert one.count() == 1 and len(one.inputFiles()) == 1
    assert readers.read_range(spark, path, "00100", "00199").count() == 100
    assert readers.read_range(spark, path, "x", "y").count() == 0
    sinks.write_sorted(rows.limit(0), path, ["code"])
    assert readers.read_range(spark, path, "0", "9").count() == 0


def test_a_member_goes_from_store_to_store(spark, tmp_path):
    """Behind a large member that is passed over; archives without a table, damaged ones and empty ones."""
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    part = next((tmp_path / "t.parquet").glob("*.parquet"))
    with zipfile.ZipFile(tmp_path / "x.zip", "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
        with z.open("zeros.bin", "w", force_zip64=True) as out:
            block = bytes(1 << 24)
            for _ in range(8):
                out.write(block)
        z.write(part, "in/side.parquet")
    assert readers.read_zip_parquet(spark, f"file://{tmp_path}/x.zip", f"file://{tmp_path}/stage").count() == 5
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as z:
        z.writestr("a.txt", "x")
    for name, data in (("none.zip", None), ("bad.zip", b"PK\x03\x04 broken"), ("empty.zip", b"")):
        if data is not None:
            (tmp_path / name).write_bytes(data)
        with pytest.raises(ValueError):
            readers.read_zip_parquet(spark, f"file://{tmp_path}/{name}", f"file://{tmp_path}/stage")


def test_each_text_is_asked_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    log = tmp_path / "asked.txt"

    def ask(texts):
        assert len(texts) <= 12
        calls.add(1)
        with open(log, "a") as f:
            f.writelines(f"{t}\n" for t in texts)
        if "fails" in texts:
            raise OSError("down")
        return [None if t == "unknown" else [float(len(t))] for t in texts]

    rows = spark.createDataFrame([(i, f"text {i % 50}" if i else None) for i in range(100)] + [(100, "unknown")], "id int, t string")
    cache = f"file://{tmp_path}/cache"
    first = {r["id"]: r["answer"] for r in answers.answered(rows, "t", ask, "array<double>", cache).collect()}
    assert first[0] is None and first[100] is None and all(first[i] == [float(len(f"text {i % 50}"))] for i in range(1, 100))
    asked = log.read_text().splitlines()
    assert sorted(asked) == sorted({f"text {i}" for i in range(50)} | {"unknown"})
    made = calls.value
    again = answers.answered(rows.where("t <> 'unknown'"), "t", ask, "array<double>", cache)
    assert again.count() == 99 and calls.value == made
    broken = spark.createDataFrame([(1, "fails"), (2, "text 1")], "id int, t string")
    got = {r["id"]: r["answer"] for r in answers.answered(broken, "t", ask, "array<double>", cache, wait=0.01).collect()}
    assert got == {1: None, 2: [6.0]} and log.read_text().splitlines().count("fails") == answers.TRIES


def shown(spark, most=None, **columns):
    kinds = {k: "array<string>" if isinstance(v, list) else "string" for k, v in columns.items()}
    rows = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{k} {v}" for k, v in kinds.items()))
    return rows.select(text.ingredient_list(rows.dtypes, most).alias("x")).first()["x"]


def test_ingredient_list_and_its_fallbacks(spark):
    assert shown(spark, ingredients=["en:brown-sugar", "no-tag"]) == ["brown sugar", "no tag"]
    assert shown(spark, ingredients=["a-b", "en:c"]) == ["a-b", "en:c"] and shown(spark, 1, ingredients=["a", "b"]) == ["a"]
    assert shown(spark, ingredients=[], ingredients_tags="['en:x-y', 'fra:z']") == ["x y", "fra:z".replace("-", " ")]
    assert shown(spark, ingredients_tags=["en:x"], ingredients_text="no") == ["x"]
    assert shown(spark, ingredients_tags="[]", ingredients_text=" ", ingredients_text_en="a, b;c\nd,,", ingredients_text_fr=None) == ["a", "b", "c", "d"]
    assert shown(spark, ingredients_text_zz="last", ingredients_text_aa="first", ingredients_text_long="never") == ["first"]
    assert shown(spark, ingredients_text_it="it", ingredients_text_aa="aa") == ["it"] and shown(spark, code="1") == []
    assert shown(spark, 2, ingredients_text="a,b,c") == ["a", "b"]


def test_numbers_and_addresses_to_show(spark):
    rows = spark.createDataFrame([(1.005,), (None,), (float("nan"),), (1234567.891,), (-0.5,), (2.0,)], "x double")
    assert [r[0] for r in rows.select(text.display_number("x", "g")).collect()] == ["1.00 g", "—", "—", "1234567.89 g", "-0.50 g", "2.00 g"]
    assert rows.select(text.display_number("x", decimals=0)).first()[0] == "1"
    odd = spark.createDataFrame([("a b&c=d/é+%~!*'()_-.",), (None,)], "x string")
    assert [r[0] for r in odd.select(text.url_component("x")).collect()] == ["a%20b%26c%3Dd%2F%C3%A9%2B%25~!*'()_-.", None]
