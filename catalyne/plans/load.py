"""The two loads: a whole snapshot, and one delta."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import ingredients as trees
from ..operators.columns import resolve
from ..operators.filters import has_tag, is_language
from ..operators.rules import Rule, delta_rules, judged, snapshot_rules
from ..operators.taxonomy import Taxonomy, normalize_categories
from ..operators.transform import finalize, transform_delta, transform_snapshot
from ..sources.readers import read_delta, read_index
from ..sources.sinks import quarantine, record_run, replace_table, upsert, write_parquet
from ..streaming.incremental import stream_names

#: Fixed value: the country that loads keep unless told otherwise.
COUNTRY = "canada"


def tables(transformed: DataFrame, categories: Taxonomy, ingredients: Taxonomy, roles: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The normalized tables of transformed products, which are read once for each of them: give rows that are written."""
    names, closure, principal = normalize_categories(transformed, categories)
    parts = trees.normalize_ingredients(transformed, ingredients, roles)
    return {
        "categories": names, "ancetre_categories": closure, "products": finalize(transformed, principal),
        **dict(zip(("ingredients", "product_ingredients", "sous_ingredients", "ingredient_alias"), parts)),
    }


def select_rows(rows: DataFrame, country: str | None = COUNTRY, language: str | None = None) -> DataFrame:
    if country:
        rows = rows.where(has_tag("countries_tags", country, rows.schema["countries_tags"].dataType.simpleString()))
    return rows.where(is_language("lang", language)) if language else rows


def valid_rows(rows: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(rows that meet all rules, the others)."""
    both = judged(rows, rules)
    return both.where("valid").drop("valid"), both.where("not valid").drop("valid")


def load_snapshot(rows: DataFrame, categories: Taxonomy, ingredients: Taxonomy, roles: dict[str, str] | None = None, country: str | None = COUNTRY, language: str | None = None) -> dict[str, DataFrame]:
    """From raw records to the tables by name, and the rejected records under `rejected`."""
    good, bad = valid_rows(select_rows(rows, country, language), snapshot_rules())
    return {**tables(transform_snapshot(good), categories, ingredients, roles), "rejected": bad}


def load_delta(rows: DataFrame, spec: str, categories: Taxonomy, ingredients: Taxonomy, roles: dict[str, str] | None = None, language: str | None = None) -> dict[str, DataFrame]:
    """As load_snapshot(), from a delta's texts, whose columns a spec names."""
    chosen = resolve(rows.where(is_language("lang", language)) if language else rows, spec)
    good, bad = valid_rows(chosen, delta_rules())
    return {**tables(transform_delta(good), categories, ingredients, roles), "rejected": bad}


def store(made: dict[str, DataFrame], schema: str, replace: bool, mark: tuple[str, str] | None = None) -> None:
    """Writes the tables, those first that others refer to. mark: what the rows are, so that a table that has them already
    is left alone."""
    for name in ("categories", "ancetre_categories", "ingredients", "products", "product_ingredients", "sous_ingredients", "ingredient_alias"):
        replace_table(made[name], f"{schema}.{name}") if replace else upsert(made[name], f"{schema}.{name}", mark=mark)


@dataclass
class WeeklyDelta:
    """A whole delta, file by file: base holds the files; staging takes what is made of each; schema has the tables."""

    base: str
    staging: str
    schema: str
    spec: str
    categories: Taxonomy
    ingredients: Taxonomy
    roles: dict[str, str] | None = None
    country: str | None = COUNTRY
    language: str | None = None
    runs: str = "monitoring.pipeline_runs"
    dag: str = "weekly_delta"

    def apply(self, spark: SparkSession, file: str) -> dict[str, int]:
        """One file: extract, choose, validate, count, transform, normalize, upsert. Each part reads what the one before has
        written. Every table remembers the file, so that a run that broke off in the middle can be run again: tables that
        have the file, or a later one, stay as they are. Returns the counts."""
        own = f"{self.staging.rstrip('/')}/{file}"
        rows = read_delta(spark, f"{self.base.rstrip('/')}/{file}", self.country)  # the spec takes what the file has
        chosen = resolve(rows.where(is_language("lang", self.language)) if self.language else rows, self.spec)
        counts = quarantine(judged(chosen, delta_rules()), f"{own}/valid", f"{own}/rejected")
        record_run(spark, "validate_delta", *counts.values(), run_id=f"{self.dag}:{file}", dag=self.dag, table=self.runs)
        write_parquet(transform_delta(spark.read.parquet(f"{own}/valid")), f"{own}/transformed")
        made = tables(spark.read.parquet(f"{own}/transformed"), self.categories, self.ingredients, self.roles)
        store(made, self.schema, replace=False, mark=("delta", file))
        return counts

    def run(self, spark: SparkSession, index: str, checkpoint: str) -> list[str]:
        """Every file that the index names after the last one that is done, in order of name. Nothing new: nothing happens."""
        return stream_names(spark, read_index(spark, index), lambda file: self.apply(spark, file), checkpoint)
