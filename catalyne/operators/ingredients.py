"""Ingredient trees: from recursive JSON lists to four tables."""

from __future__ import annotations

import re
import string
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import folding
from ..functions.text import clean_text, presence, slug, stable_id, strip, tag_name
from ..schemas import ALIASES, INGREDIENTS, PRODUCT_INGREDIENTS, SUB_INGREDIENTS
from ..sources.files import endless_recursion, written
from ..sources.sinks import empty
from .taxonomy import Taxonomy

#: Levels of a tree that are followed: all of them.
MAX_LEVELS = 1 << 30


@lru_cache
def named_class() -> tuple[str, str, str]:
    """(a class of all characters that a slug keeps something of; characters that are folded to angle brackets, and to which)."""
    t = folding.folding(True)
    pairs = [*zip(t.one, t.to), *t.more.items()]
    kept = [c for c, x in pairs if re.search("[a-zA-Z0-9%+:.]", x)]
    angles = [(c, x) for c, x in pairs if x in "<>"]
    return folding.char_class([*kept, *string.ascii_letters, *string.digits, *"%+:."]), "".join(c for c, _ in angles), "".join(x for _, x in angles)


def has_tag_sql(item: str) -> str:
    """SQL for whether an object of a tree gets a tag: it has an id, or a text of which a slug is left."""
    kept, angles, plain = named_class()
    text = f"translate(try_variant_get({item}, '$.text', 'string'), '{angles}', '{plain}')"
    kept = kept.replace("{", "{{").replace("}", "}}")  # braces name frames in Spark's SQL texts
    return f"(coalesce(try_variant_get({item}, '$.id', 'string') RLIKE r'\\S', false) OR coalesce(regexp_replace({text}, r'<[^>]+>', ' ') RLIKE r'{kept}', false))"


def tree_nodes(products: DataFrame, column: str = "ingredients", max_levels: int = MAX_LEVELS) -> DataFrame:
    """(code, place, level, id, text, parent_id, parent_text): every object in the nested lists of a JSON column that gets a tag
    and all of whose ancestors get one; place: its number in its list, from 1. What is below an object without a tag isn't
    followed. Anything that isn't a list has no nodes; items that aren't objects are no nodes but keep their places.

    Each row carries what its parent is known by, so that no tree is gathered: a product costs its nodes. The first two levels
    come out of one pass over the texts; recursion follows the nodes below these, where there are any.
    """
    spark = products.sparkSession
    kind = dict(products.dtypes)[column]
    tree = F.try_parse_json(F.col(column) if kind == "string" else F.to_json(column))
    get = lambda item, name, kind="string": F.try_variant_get(item, f"$.{name}", kind)
    tag, below = F.expr(has_tag_sql("item").format()), "array<variant>"
    top = products.select("code", F.posexplode(F.try_variant_get(tree, "$", below)).alias("at", "item")).where(tag)
    within = F.coalesce(get("item", "ingredients", below), F.array().cast(below)) if max_levels > 1 else F.array().cast(below)
    top = top.select("code", (F.col("at") + 1).alias("place"), get("item", "id").alias("id"), get("item", "text").alias("text"), within.alias("within"))
    # Each node stands before those inside of it, at 0.
    both = top.select("code", "place", "id", "text", F.posexplode(F.concat(F.array(F.lit(None).cast("variant")), "within")).alias("at", "item"))
    own = F.col("at") == 0
    deeper = get("item", "ingredients", "variant") if max_levels > 2 else F.lit(None).cast("variant")
    deeper = F.when(F.size(F.try_variant_get(deeper, "$", below)) > 0, deeper)
    nodes = both.where(own | tag).select(
        "code", F.when(own, F.col("place")).otherwise(F.col("at")).alias("place"), F.when(own, 1).otherwise(2).alias("level"),
        F.when(own, F.col("id")).otherwise(get("item", "id")).alias("id"), F.when(own, F.col("text")).otherwise(get("item", "text")).alias("text"),
        F.when(~own, F.col("id")).alias("parent_id"), F.when(~own, F.col("text")).alias("parent_text"), deeper.alias("deeper"),
    )
    nodes = written(nodes, "nodes")
    if not nodes.agg(F.bool_or(F.col("deeper").isNotNull())).first()[0]:
        return nodes.drop("deeper")
    with endless_recursion(spark):
        more = spark.sql(
            f"""
            WITH RECURSIVE nodes(code, place, level, parent_id, parent_text, item) AS (
              SELECT r.code, e.pos + 1, 3, r.id, r.text, e.value
              FROM {{roots}} r, LATERAL variant_explode(r.deeper) e WHERE e.key IS NULL
              UNION ALL
              SELECT n.code, e.pos + 1, n.level + 1, try_variant_get(n.item, '$.id', 'string'), try_variant_get(n.item, '$.text', 'string'), e.value
              FROM nodes n, LATERAL variant_explode(try_variant_get(n.item, '$.ingredients', 'variant')) e
              WHERE n.level < {int(max_levels)} AND e.key IS NULL AND {has_tag_sql("n.item")}
            )
            SELECT code, place, level, try_variant_get(item, '$.id', 'string') AS id, try_variant_get(item, '$.text', 'string') AS text, parent_id, parent_text
            FROM nodes WHERE {has_tag_sql("item")}
            """,
            roots=nodes.where("deeper is not null"),
        )
        return nodes.drop("deeper").unionByName(written(more, "nodes"))


def tagged(rows: DataFrame, tags: DataFrame, id: str, text: str, out: str, fold: bool = True) -> DataFrame:
    """rows with a tag: the canonical one of the first of id, en:slug and fr:slug that the taxonomy knows, else the id, else
    en:slug, else null."""
    cols = rows.columns
    named = rows.withColumns({"_id": presence(F.lower(strip(id))), "_slug": presence(slug(text, fold))})
    named = named.withColumns({"_en": F.concat(F.lit("en:"), "_slug"), "_fr": F.concat(F.lit("fr:"), "_slug")})
    for c in ("_id", "_en", "_fr"):  # a taxonomy is a text of some MB
        named = named.join(F.broadcast(tags.select(F.col("tag").alias(c), F.col("canonical").alias(f"{c}_known"))), c, "left")
    return named.select(*cols, F.coalesce("_id_known", "_en_known", "_fr_known", "_id", "_en").alias(out))


def resolved(nodes: DataFrame, tags: DataFrame, fold: bool = True) -> DataFrame:
    """(code, place, level, clean, tag, parent): the cleaned text, the tag, and the tag of the node above, null at the top."""
    rows = nodes.withColumn("clean", presence(clean_text("text", fold)))
    rows = tagged(tagged(rows, tags, "id", "text", "tag", fold), tags, "parent_id", "parent_text", "parent", fold)
    return rows.select("code", "place", "level", "clean", "tag", "parent")


def normalize_ingredients(products: DataFrame, taxonomy: Taxonomy, roles: dict[str, str] | None = None, fold: bool = True) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(ingredients, product ingredients, sub-ingredients, aliases). The first level of a tree is the product's ingredients, in
    order, with an additive's role; every deeper node is a sub-ingredient of the one above it; a node's cleaned text is an
    alias where it isn't the tag's readable name. Without an ingredients column: empty tables."""
    spark = products.sparkSession
    if "ingredients" not in products.columns:
        return tuple(empty(spark, s) for s in (INGREDIENTS, PRODUCT_INGREDIENTS, SUB_INGREDIENTS, ALIASES))
    # Four tables are read from these rows, each with no more than it needs; what depends on names alone comes from distinct ones.
    nodes, tags = tree_nodes(products), taxonomy.tags(spark)
    number, name, place = stable_id("tag"), tag_name("tag"), F.col("place").cast("int")
    known = spark.createDataFrame(list((roles or {}).items()), "role_tag string, role string")
    top = tagged(nodes.where("level = 1"), tags, "id", "text", "tag", fold).select("code", "tag", place.alias("place")).distinct()
    top = top.join(F.broadcast(known), F.lower("tag") == F.col("role_tag"), "left")
    product = top.select("code", number.alias("ingredient_id"), name.alias("ingredient_name"), F.col("place").alias("ingredient_order"), "role")
    below = tagged(tagged(nodes.where("level > 1"), tags, "id", "text", "tag", fold), tags, "parent_id", "parent_text", "parent", fold)
    below = below.select("code", "parent", "tag", place.alias("place")).distinct()
    sub = below.select("code", stable_id("parent").alias("ingredient_id"), number.alias("sous_ingredient_id"), name.alias("sous_ingredient_name"), F.col("place").alias("rang"))
    names = tagged(nodes.select("id", "text").distinct(), tags, "id", "text", "tag", fold)
    ingredients = names.select("tag").distinct().select(number.alias("ingredient_id"), name.alias("ingredient_name"))
    alias = F.lower(presence(clean_text("text", fold)))
    aliases = names.select("tag", alias.alias("alias_name")).distinct().where((F.col("alias_name") != "") & (F.col("alias_name") != name)).select(number.alias("ingredient_id"), "alias_name")
    return ingredients, product, sub, aliases
