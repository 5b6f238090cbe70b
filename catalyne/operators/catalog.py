"""Catalogue queries: lists, categories, details."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import category_path, clean_name, search_key, strip, without_language
from ..sources.readers import first_table
from ..sources.sinks import read_table
from .filters import contains_text, has_letter

#: How many rows a list has, and may have.
LIMIT, MAX_LIMIT = 500, 1000
#: Codes that go to every task; of more, those whose details one task makes, on average.
FEW_CODES, CODES_A_TASK = 8192, 36864
LIST_COLUMNS = ["code", "product_name", "brands", "energy_kcal_100g", "fat_100g", "salt_100g", "sugars_100g", "saturated_fat_100g", "fiber_100g", "carbohydrates_100g", "proteins_100g", "calcium_100g", "iron_100g", "potassium_100g", "nutriscore_grade", "ecoscore_grade", "front_url"]


@dataclass
class Catalog:
    """The serving tables. links (code, category_id), closure and aliases can be missing."""

    products: DataFrame
    categories: DataFrame
    ingredients: DataFrame | None = None
    product_ingredients: DataFrame | None = None
    closure: DataFrame | None = None
    links: DataFrame | None = None
    aliases: DataFrame | None = None

    @classmethod
    def of(cls, spark: SparkSession, schema: str = "silver") -> Catalog:
        """The tables of a schema; those that may be missing are looked up first."""

        def table(*names: str) -> DataFrame | None:
            found = first_table(spark, *[f"{schema}.{n}" for n in names])
            return read_table(spark, found) if found else None

        return cls(
            table("products"), table("categories"), table("ingredients"), table("product_ingredients"),
            closure=table("ancetre_categories"), links=table("product_categories"), aliases=table("ingredient_alias"),
        )


def category_links(c: Catalog) -> DataFrame:
    """(code, category_id): the link table, if there is one, and the principal categories, each pair once."""
    own = c.products.where("categorie_principale is not null").select("code", F.col("categorie_principale").alias("category_id"))
    return (c.links.select("code", "category_id").union(own) if c.links is not None else own).distinct()


def joined_names(links: DataFrame, categories: DataFrame) -> DataFrame:
    """(code, categories): the names of each code's categories, sorted, with | between."""
    named = links.join(categories.select("category_id", "category_name"), "category_id", "left")
    return named.groupBy("code").agg(F.array_join(F.array_sort(F.collect_set("category_name")), "|").alias("categories"))


def with_ingredient(c: Catalog, text: str) -> DataFrame:
    """(code): products one of whose ingredients, by name or alias, contains a text."""
    wanted = text.lower().strip().replace("-", " ")
    rows = c.product_ingredients.select("code", "ingredient_id").join(c.ingredients.select("ingredient_id", "ingredient_name"), "ingredient_id")
    match = F.contains(search_key("ingredient_name"), F.lit(wanted))
    if c.aliases is not None:
        hit = c.aliases.where(F.contains(search_key("alias_name"), F.lit(wanted))).select("ingredient_id").distinct().withColumn("by_alias", F.lit(True))
        rows = rows.join(hit, "ingredient_id", "left")
        match = match | F.col("by_alias").isNotNull()
    return rows.where(match).select("code")


def in_category(c: Catalog, text: str) -> DataFrame:
    """(code): products in a category whose name contains a text, with hyphens for spaces."""
    wanted = F.lit(text.lower().replace(" ", "-"))
    name = F.col("category_name")
    hit = c.categories.where(F.contains(F.lower(name), wanted) | F.contains(F.lower(without_language(name)), wanted))
    return category_links(c).join(hit.select("category_id"), "category_id", "left_semi").select("code")


def filtered(c: Catalog, name: str | None = None, brand: str | None = None, ingredient: str | None = None, category: str | None = None, wildcards: bool = False) -> DataFrame:
    """Products that pass every given filter. wildcards: % and _ in the name and the brand stand for other characters; without
    it they stand for themselves."""
    rows = c.products
    if name:
        rows = rows.where(contains_text("product_name", name, wildcards))
    if brand:
        rows = rows.where(contains_text("brands", brand, wildcards))
    if ingredient:
        rows = rows.join(with_ingredient(c, ingredient), "code", "left_semi")
    if category:
        rows = rows.join(in_category(c, category), "code", "left_semi")
    return rows


def product_list(c: Catalog, name: str | None = None, brand: str | None = None, ingredient: str | None = None, category: str | None = None, limit: int = LIMIT, wildcards: bool = False) -> DataFrame:
    """Products that pass every given filter (see filtered()), with the names of their categories as an array, by name (nulls
    last) and code. The limit comes before the categories are gathered, so that only the listed rows are joined."""
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit: 1 to {MAX_LIMIT}")
    rows = filtered(c, name, brand, ingredient, category, wildcards)
    order = [F.col("product_name").asc_nulls_last(), "code"]
    listed = rows.select(*[x for x in LIST_COLUMNS if x in rows.columns]).orderBy(*order).limit(limit)
    links = category_links(c).join(listed.select("code"), "code", "left_semi")
    labels = F.transform(F.filter(F.split(F.coalesce("categories", F.lit("")), r"\|"), lambda x: x != ""), clean_name)
    return listed.join(joined_names(links, c.categories), "code", "left").withColumn("categories", labels).orderBy(*order)


def category_list(c: Catalog) -> DataFrame:
    """(category_id, category_name, parent_category_id, parent_name, label, parent_label, display_label): every category that
    has letters, once for each display label in any case (the first by name), sorted by it."""
    cats = c.categories
    if c.closure is None:
        rows = cats.select("category_id", "category_name", F.lit(None).cast("long").alias("parent_category_id"), F.lit(None).cast("string").alias("parent_name"))
    else:
        up = c.closure.where("distance = 1").select("category_id", F.col("category_id_parent").alias("parent_category_id"))
        names = cats.select(F.col("category_id").alias("parent_category_id"), F.col("category_name").alias("parent_name"))
        rows = cats.join(up, "category_id", "left").join(names, "parent_category_id", "left")
    label, parent = clean_name("category_name"), F.nullif(clean_name(F.coalesce("parent_name", F.lit(""))), F.lit(""))
    rows = rows.withColumns({"label": label, "parent_label": parent}).where(has_letter("label"))
    rows = rows.withColumn("display_label", F.concat_ws(" > ", "parent_label", "label"))
    first = Window.partitionBy(F.lower("display_label")).orderBy("category_name", "category_id")
    kept = rows.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    return kept.select("category_id", "category_name", "parent_category_id", "parent_name", "label", "parent_label", "display_label").orderBy(F.lower("display_label"))


def category_entries(c: Catalog, codes: DataFrame) -> DataFrame:
    """(code, categories): array of (parent, child, display) for each category of a code; display: its ancestors from the
    farthest on, and itself, each label once."""
    links = category_links(c).join(codes, "code", "left_semi").join(c.categories, "category_id")
    links = links.withColumn("child", clean_name("category_name")).where("child <> ''")
    if c.closure is None:
        rows = links.select("code", "category_name", F.lit(None).cast("string").alias("parent"), "child", F.col("child").alias("display"))
    else:
        names = c.categories.select(F.col("category_id").alias("category_id_parent"), clean_name("category_name").alias("above"))
        up = c.closure.join(names, "category_id_parent").where("above <> ''")
        both = links.join(up.select("category_id", "distance", "above"), "category_id", "left")
        chain = F.array_sort(F.collect_list(F.when(F.col("above").isNotNull(), F.struct((-F.col("distance")).alias("d"), "above"))))
        rows = both.groupBy("code", "category_id", "category_name", "child").agg(chain.alias("chain"), F.max(F.when(F.col("distance") == 1, F.col("above"))).alias("parent"))
        rows = rows.withColumn("display", category_path(F.concat(F.col("chain.above"), F.array("child"))))
    first = Window.partitionBy("code", F.lower("display")).orderBy("category_name")
    kept = rows.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    listed = kept.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("category_name", "parent", "child", "display"))).alias("c"))
    return listed.select("code", F.transform("c", lambda x: F.struct(x["parent"].alias("parent"), x["child"].alias("child"), x["display"].alias("display"))).alias("categories"))


def ingredient_names(c: Catalog, codes: DataFrame) -> DataFrame:
    """(code, ingredients): the labels of a code's ingredients in order, each once in any case; links can be repeated. A code's
    links are gathered in one step, so that they are dealt out once, by code, before names widen them."""
    names = c.ingredients.select("ingredient_id", "ingredient_name", clean_name("ingredient_name").alias("label")).where("label <> ''")
    rows = c.product_ingredients.select("code", "ingredient_id", "ingredient_order").join(codes, "code", "left_semi").join(names, "ingredient_id")
    place = [F.coalesce("ingredient_order", F.lit(2**31 - 1)).alias("n"), "ingredient_name", "label"]
    listed = rows.groupBy("code").agg(F.sort_array(F.collect_set(F.struct(F.lower("label").alias("folded"), *place))).alias("l"))
    first = F.filter("l", lambda x, i: (i == 0) | (F.get("l", i - 1)["folded"] != x["folded"]))
    ordered = F.sort_array(F.transform(first, lambda x: F.struct(x["n"], x["ingredient_name"], x["label"].alias("label"))))
    return listed.select("code", ordered["label"].alias("ingredients"))


def dealt(codes: DataFrame) -> DataFrame:
    """Codes in tasks of CODES_A_TASK at most, on average; what is joined with many of them comes to these tasks, so that a
    task's memory doesn't grow with the tables. Few go to every task."""
    n = codes.count()
    if n <= FEW_CODES:
        return F.broadcast(codes)
    parts = max(-(-n // CODES_A_TASK), int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return codes.repartition(parts, "code").hint("shuffle_hash")


def requested(spark: SparkSession, codes: Sequence[str]) -> DataFrame:
    """(code, pos): the codes asked for, trimmed, without blanks, each at its first place."""
    listed = list(dict.fromkeys(x.strip() for x in codes if x and x.strip()))
    return spark.createDataFrame([(x, i) for i, x in enumerate(listed)], "code string, pos int")


def details(c: Catalog, codes: Sequence[str] | DataFrame, keep_pos: bool = False) -> DataFrame:
    """The products of some codes, in the order asked for, with categories and ingredients; unknown codes are left out."""
    wanted = dealt(codes) if isinstance(codes, DataFrame) else F.broadcast(requested(c.products.sparkSession, codes))
    keys = wanted.select("code")
    rows = c.products.withColumn("code", strip(F.col("code").cast("string"))).join(wanted, "code")
    rows = rows.join(category_entries(c, keys), "code", "left")
    kind = "array<struct<parent:string,child:string,display:string>>"
    rows = rows.withColumn("categories", F.coalesce("categories", F.array().cast(kind)))
    if c.product_ingredients is not None:
        rows = rows.join(ingredient_names(c, keys), "code", "left").withColumn("ingredients", F.coalesce("ingredients", F.array().cast("array<string>")))
    rows = rows.orderBy("pos")
    return rows if keep_pos else rows.drop("pos")
