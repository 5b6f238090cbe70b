"""Comparing a few products: statistics, best values, health score, radar, insights."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import band, grade_value
from .catalog import Catalog, details


@dataclass(frozen=True)
class Metric:
    key: str
    label: str
    unit: str
    better: str
    default: bool = False


#: Metrics, their units, and which way is better.
METRICS = (
    Metric("energy_kcal_100g", "Calories", "kcal", "lower", True),
    Metric("fat_100g", "Lipides", "g", "lower", True),
    Metric("saturated_fat_100g", "Acides gras saturés", "g", "lower"),
    Metric("carbohydrates_100g", "Glucides", "g", "lower", True),
    Metric("sugars_100g", "Sucres", "g", "lower", True),
    Metric("fiber_100g", "Fibres", "g", "higher"),
    Metric("proteins_100g", "Protéines", "g", "higher", True),
    Metric("salt_100g", "Sel", "g", "lower", True),
    Metric("calcium_100g", "Calcium", "mg", "higher"),
    Metric("iron_100g", "Fer", "mg", "higher"),
    Metric("potassium_100g", "Potassium", "mg", "higher"),
)
DEFAULTS = tuple(m for m in METRICS if m.default)
GRADE = Metric("nutriscore", "Nutri-Score", "", "higher")
#: How many products a comparison takes.
FEWEST, MOST = 2, 4
#: Title, metric, which end, what the value must exceed.
INSIGHTS = (
    ("Meilleur en protéines", "proteins_100g", "max", 0.0),
    ("Moins calorique", "energy_kcal_100g", "min", None),
    ("Attention au sucre", "sugars_100g", "max", 10.0),
    ("Riche en fibres", "fiber_100g", "max", 2.0),
    ("Attention au sel", "salt_100g", "max", 1.0),
)
MOST_INSIGHTS = 4


def long_form(products: DataFrame, metrics: Sequence[Metric] = DEFAULTS, by: Sequence[str] = (), grade: bool = False) -> DataFrame:
    """(by, code, metric, better, value) for each product and metric, without a shuffle; grade: the score's grade as a metric."""
    items = [F.struct(F.lit(m.key).alias("metric"), F.lit(m.better).alias("better"), F.col(m.key).cast("double").alias("value")) for m in metrics]
    if grade:
        items.append(F.struct(F.lit(GRADE.key).alias("metric"), F.lit(GRADE.better).alias("better"), grade_value("nutriscore_grade").cast("double").alias("value")))
    return products.select(*by, "code", F.explode(F.array(*items)).alias("m")).select(*by, "code", "m.*")


def stats(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, metric, min, max, avg) over the known values."""
    return rows.groupBy(*by, "metric").agg(F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("avg"))


def placed(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """rows with the least, the greatest and the number of known values of their metric."""
    least = rows.groupBy(*by, "metric").agg(F.min("value").alias("min"), F.max("value").alias("max"), F.count("value").alias("known"))
    return rows.join(least, [*by, "metric"])


def contribution() -> Column:
    """0 to 1, 1 for the best; null where the value is, or where all are the same."""
    share = (F.col("value") - F.col("min")) / (F.col("max") - F.col("min"))
    return F.when(F.col("max") != F.col("min"), F.when(F.col("better") == "lower", 1 - share).otherwise(share))


def best_values(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """placed() with is_best: the better end among two or more known values; ties all are."""
    best = F.when(F.col("better") == "lower", F.col("min")).otherwise(F.col("max"))
    return placed(rows, by).withColumn("is_best", F.coalesce((F.col("value") == best) & (F.col("known") > 1), F.lit(False)))


def health_scores(products: DataFrame, metrics: Sequence[Metric] = DEFAULTS, by: Sequence[str] = ()) -> DataFrame:
    """(by, code, score): the mean contribution over the metrics that tell products apart, the grade among them, out of 100;
    0 where there is none. by: columns that set comparisons apart."""
    rows = placed(long_form(products, metrics, by, grade="nutriscore_grade" in products.columns), by).withColumn("c", contribution())
    return rows.groupBy(*by, "code").agg(F.round(F.coalesce(F.avg("c"), F.lit(0.0)) * 100, 2).alias("score"))


def breakdown(products: DataFrame, metrics: Sequence[Metric] = DEFAULTS, by: Sequence[str] = ()) -> DataFrame:
    """(by, code, metric, value, contribution, band) behind the health scores."""
    rows = placed(long_form(products, metrics, by, grade="nutriscore_grade" in products.columns), by).withColumn("contribution", contribution())
    return rows.where("contribution is not null").select(*by, "code", "metric", "value", "contribution", band("contribution").alias("band"))


def leaderboard(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """scores with their rank, best first; ties by code."""
    return scores.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "code")))


def radar(products: DataFrame, metrics: Sequence[Metric] = DEFAULTS, by: Sequence[str] = ()) -> DataFrame:
    """(by, code, metric, points): 0 to 100, whole numbers; 0 where the value isn't known, 50 where all are the same."""
    rows = placed(long_form(products, metrics, by), by)
    share = (F.col("value") - F.col("min")) / (F.col("max") - F.col("min")) * 100
    share = F.when(F.col("better") == "lower", 100 - share).otherwise(share)
    points = F.when(F.col("value").isNull(), 0).when(F.col("max") == F.col("min"), 50).otherwise(F.floor(share + 0.5))
    return rows.select(*by, "code", "metric", points.cast("int").alias("points"))


def insights(products: DataFrame, order: str = "code") -> DataFrame:
    """(n, title, metric, product_name, value): the first product at the telling end of each metric, if it tells enough; four
    at most."""
    found = None
    for n, (title, key, end, above) in enumerate(INSIGHTS):
        known = products.where(F.col(key).isNotNull())
        rank = [F.desc(key) if end == "max" else F.asc(key), F.col(order)]
        one = known.orderBy(*rank).limit(1).select(F.lit(n).alias("n"), F.lit(title).alias("title"), F.lit(key).alias("metric"), "product_name", F.col(key).cast("double").alias("value"))
        one = one.where(F.col("value") > above) if above is not None else one
        found = one if found is None else found.unionByName(one)
    return found.orderBy("n").limit(MOST_INSIGHTS)


def compare(c: Catalog, codes: Sequence[str]) -> dict[str, DataFrame]:
    """Everything that a comparison shows, of two to four products."""
    if not FEWEST <= len(set(codes)) <= MOST:
        raise ValueError(f"a comparison takes {FEWEST} to {MOST} products")
    products = details(c, codes).cache()
    rows = long_form(products)
    return {"products": products, "table": best_values(rows), "stats": stats(rows), "scores": leaderboard(health_scores(products)), "breakdown": breakdown(products), "radar": radar(products), "insights": insights(products)}
