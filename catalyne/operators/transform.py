"""Flattening nested records into the transformed products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nested import field_of, field_of_first, parsed, path
from ..functions.text import image_url
from ..schemas import NUTRIENTS, PICTURES, TRANSFORMED, nutrient_column
from .columns import conform
from .filters import ECOSCORE_GRADES, NUTRISCORE_GRADES, listed_or_null

#: Where pictures are; a parameter of the transforms.
IMAGE_BASE = "https://images.example.org/products"
#: Columns of a delta that hold JSON.
JSON_COLUMNS = ("images", "nutrition", "categories_tags", "countries_tags", "ingredients")


def graded(rows: DataFrame) -> DataFrame:
    grades = {"nutriscore_grade": NUTRISCORE_GRADES, "ecoscore_grade": ECOSCORE_GRADES}
    return rows.withColumns({c: listed_or_null(c, v) for c, v in grades.items() if c in rows.columns})


def is_list(rows: DataFrame, name: str) -> bool:
    return name in rows.columns and isinstance(rows.schema[name].dataType, T.ArrayType)


def transform_snapshot(rows: DataFrame, image_base: str = IMAGE_BASE) -> DataFrame:
    """Records of the snapshot: the name is the main one of product_name (lang, text), pictures come from images (key, rev),
    nutrients from nutriments (name, 100g), rounded to two places. All in one projection, without a shuffle."""
    made: dict[str, Column] = {}
    if is_list(rows, "product_name"):
        made["product_name"] = field_of("product_name", "lang", "main", "text")
    if is_list(rows, "images"):
        made |= {f"{p}_url": image_url(image_base, "code", F.lit(f"{p}_en"), field_of("images", "key", f"{p}_en", "rev")) for p in PICTURES}
    if is_list(rows, "nutriments"):
        made |= {nutrient_column(n): F.round(field_of_first("nutriments", "name", n, "100g").cast("double"), 2) for n in NUTRIENTS}
    return conform(graded(rows.withColumns(made)), TRANSFORMED)


def transform_delta(rows: DataFrame, image_base: str = IMAGE_BASE, language: str = "en") -> DataFrame:
    """Records of a delta, whose nested columns are JSON texts or VARIANTs: pictures come from images.selected, nutrients from
    nutrition.aggregated_set. JSON that can't be read is null."""
    kinds = dict(rows.dtypes)
    variants = {c: parsed(c) for c in ("images", "nutrition") if kinds.get(c) == "string"}
    rows = rows.withColumns(variants)
    made: dict[str, Column] = {}
    if "images" in kinds:
        made |= {f"{p}_url": image_url(image_base, "code", F.lit(f"{p}_{language}"), path("images", "selected", p, language, "rev")) for p in PICTURES}
    if "nutrition" in kinds:
        made |= {nutrient_column(n): F.round(path("nutrition", "aggregated_set", "nutrients", n, "value", kind="double"), 2) for n in NUTRIENTS}
    return conform(graded(rows.withColumns(made)), TRANSFORMED)


def finalize(transformed: DataFrame, principal: DataFrame) -> DataFrame:
    """The products: transformed rows with their principal category, less the columns that other tables took over."""
    return transformed.join(principal.select("code", "categorie_principale"), "code", "left").drop("categories_tags", "ingredients")
