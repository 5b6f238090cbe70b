"""Schemas of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

#: Nutrients in the order of their columns, by the name that sources give them.
NUTRIENTS = ("energy-kcal", "fat", "saturated-fat", "trans-fat", "cholesterol", "sodium", "salt", "carbohydrates", "fiber", "sugars", "proteins", "calcium", "iron", "potassium")
#: Pictures, in the order of their columns.
PICTURES = ("front", "ingredients", "nutrition", "packaging")


def nutrient_column(name: str) -> str:
    return name.replace("-", "_") + "_100g"


NUTRIENT_COLUMNS = [nutrient_column(n) for n in NUTRIENTS]
PICTURE_COLUMNS = [f"{p}_url" for p in PICTURES]

_STRING, _DOUBLE, _LONG, _INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
_TAGS = T.ArrayType(_STRING)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


#: The columns of the transformed products, in order.
TRANSFORMED = _struct(
    code=_STRING, product_name=_STRING, brands=_STRING, product_quantity=_STRING, product_quantity_unit=_STRING, quantity=_STRING, serving_quantity=_STRING, serving_size=_STRING,
    categories_tags=_TAGS, countries_tags=_TAGS, ecoscore_score=_DOUBLE, ecoscore_grade=_STRING, ingredients=_STRING, ingredients_n=_LONG, nutriscore_score=_DOUBLE, nutriscore_grade=_STRING,
    **dict.fromkeys(PICTURE_COLUMNS, _STRING), **dict.fromkeys(NUTRIENT_COLUMNS, _DOUBLE),
)
CATEGORIES = _struct(category_id=_LONG, category_name=_STRING)
CLOSURE = _struct(category_id=_LONG, category_id_parent=_LONG, distance=_INT)
PRINCIPAL = _struct(code=_STRING, categorie_principale=_LONG)
INGREDIENTS = _struct(ingredient_id=_LONG, ingredient_name=_STRING)
PRODUCT_INGREDIENTS = _struct(code=_STRING, ingredient_id=_LONG, ingredient_name=_STRING, ingredient_order=_INT, role=_STRING)
SUB_INGREDIENTS = _struct(code=_STRING, ingredient_id=_LONG, sous_ingredient_id=_LONG, sous_ingredient_name=_STRING, rang=_INT)
ALIASES = _struct(ingredient_id=_LONG, alias_name=_STRING)
RUNS = _struct(dag_run_id=_STRING, dag_name=_STRING, command=_STRING, records_in=_LONG, records_out=_LONG, records_rejected=_LONG, rejection_rate=_DOUBLE, executed_at=T.TimestampType())

#: Keys by which a batch replaces rows of each table.
UPSERT_KEYS = {
    "products": ["code"], "categories": ["category_name"], "ancetre_categories": ["category_id", "category_id_parent"], "ingredients": ["ingredient_id"],
    "product_ingredients": ["code"], "sous_ingredients": ["code"], "ingredient_alias": ["ingredient_id", "alias_name"], "pipeline_runs": ["dag_run_id", "command"],
}
