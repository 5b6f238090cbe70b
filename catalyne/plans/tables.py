"""The engine's tables as views of a star schema: parts are products, line items link them, places are the category forest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import stable_id
from ..operators.catalog import Catalog
from ..operators.taxonomy import closure


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def place_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tag, parent): nations under regions, customers under nations."""
    nations = read(spark, sf_dir, "nation").select(F.concat(F.lit("N:"), "n_nationkey").alias("tag"), F.concat(F.lit("R:"), "n_regionkey").alias("parent"))
    customers = read(spark, sf_dir, "customer").select(F.concat(F.lit("C:"), "c_custkey").alias("tag"), F.concat(F.lit("N:"), "c_nationkey").alias("parent"))
    return nations.unionByName(customers)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with the columns of products; nutrients come from size and price."""
    p = read(spark, sf_dir, "part")
    size, price = F.col("p_size").cast("double"), F.col("p_retailprice")
    grade = F.get(F.split(F.lit("a,b,c,d,e"), ","), F.pmod(F.col("p_partkey"), F.lit(6)).cast("int"))
    made = {"energy_kcal_100g": price, "fat_100g": size, "salt_100g": size / 10, "sugars_100g": F.when(F.col("p_partkey") % 7 != 0, size / 2), "saturated_fat_100g": size / 4, "fiber_100g": F.when(F.col("p_partkey") % 5 != 0, price / 300), "carbohydrates_100g": price / 20, "proteins_100g": F.when(F.col("p_partkey") % 3 != 0, size / 3)}
    return p.select(F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("product_name"), F.col("p_brand").alias("brands"), "p_type", "p_partkey", *[c.alias(k) for k, c in made.items()], grade.alias("nutriscore_grade"), stable_id("p_type").alias("categorie_principale"))


#: The same in SQL.
PARTS_SQL = """
SELECT p_partkey::VARCHAR AS code, p_name AS product_name, p_brand AS brands, p_type, p_partkey, p_retailprice AS energy_kcal_100g, p_size::DOUBLE AS fat_100g,
  p_size::DOUBLE / 10 AS salt_100g, CASE WHEN p_partkey % 7 <> 0 THEN p_size::DOUBLE / 2 END AS sugars_100g, p_size::DOUBLE / 4 AS saturated_fat_100g,
  CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice / 300 END AS fiber_100g, p_retailprice / 20 AS carbohydrates_100g,
  CASE WHEN p_partkey % 3 <> 0 THEN p_size::DOUBLE / 3 END AS proteins_100g,
  CASE p_partkey % 6 WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'c' WHEN 3 THEN 'd' WHEN 4 THEN 'e' END AS nutriscore_grade
FROM part
"""


def line_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code, ingredient_id, ingredient_order): a part's supplier, once for each line item."""
    lines = read(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_partkey").cast("string").alias("code"), F.col("l_suppkey").alias("ingredient_id"), F.col("l_suppkey").cast("int").alias("ingredient_order"))


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    """Parts in categories by type; their suppliers are their ingredients, in order of key."""
    products = parts(spark, sf_dir)
    kinds = products.select(F.col("categorie_principale").alias("category_id"), F.col("p_type").alias("category_name")).distinct()
    supplier = read(spark, sf_dir, "supplier")
    lines = line_links(spark, sf_dir).select("code", "ingredient_id").distinct()
    return Catalog(products, kinds, supplier.select(F.col("s_suppkey").alias("ingredient_id"), F.col("s_name").alias("ingredient_name")), lines.withColumn("ingredient_order", F.col("ingredient_id").cast("int")))


def places(spark: SparkSession, sf_dir: str) -> Catalog:
    """Customers as products in the category of their nation, with regions above."""
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    tags = nation.select(F.concat(F.lit("N:"), "n_nationkey").alias("tag"), F.col("n_name").alias("category_name")).unionByName(region.select(F.concat(F.lit("R:"), "r_regionkey").alias("tag"), F.col("r_name").alias("category_name")))
    edges = nation.select(F.concat(F.lit("N:"), "n_nationkey").alias("tag"), F.concat(F.lit("R:"), "n_regionkey").alias("parent"))
    up = closure(edges).select(stable_id("tag").alias("category_id"), stable_id("ancestor").alias("category_id_parent"), "distance")
    customers = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("code"), F.col("c_name").alias("product_name"), F.col("c_mktsegment").alias("brands"), stable_id(F.concat(F.lit("N:"), "c_nationkey")).alias("categorie_principale"))
    return Catalog(customers, tags.select(stable_id("tag").alias("category_id"), "category_name"), closure=up)
