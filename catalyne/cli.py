"""Every step of the loads as a command: python -m catalyne.cli STEP --input PATH --output PATH ..."""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable

from pyspark.sql import SparkSession

from .operators import ingredients, taxonomy
from .operators.columns import resolve
from .operators.filters import has_tag, is_language
from .operators.rules import delta_rules, judged, snapshot_rules
from .operators.transform import finalize, transform_snapshot
from .operators.transform import transform_delta as flattened
from .plans.load import COUNTRY
from .session import session
from .sources import readers, sinks

OPTIONS = {
    "input": "path of the rows, or of the snapshot's archive, the index or the delta", "output": "path of the result", "invalid": "path of the rejected rows", "principal": "path of the principal categories",
    "closure": "path of the ancestors", "products": "path of the product ingredients", "parts": "path of the sub-ingredients", "aliases": "path of the aliases", "taxonomy": "path of the taxonomy's text",
    "additives": "path of the additives' taxonomy", "classes": "path of the additive classes' taxonomy", "staging": "folder that executors read", "columns": "column spec, such as code,grade|old_grade",
    "country": "country that rows must carry; empty for all", "lang": "language that rows must have", "table": "table, with its schema", "key": "key column of an upsert", "key2": "second key column", "run": "run id for the metrics", "dag": "name of the run's plan",
}
STEPS: dict[str, Callable[[SparkSession, argparse.Namespace], object]] = {}


def step(f: Callable[[SparkSession, argparse.Namespace], object]):
    STEPS[f.__name__] = f
    return f


@step
def extract_data(spark, a):
    sinks.write_parquet(readers.read_zip_parquet(spark, a.input, a.staging), a.output)


@step
def filter_data(spark, a):
    rows = spark.read.parquet(a.input)
    rows = rows.where(has_tag("countries_tags", a.country, rows.schema["countries_tags"].dataType.simpleString())) if a.country else rows
    rows = rows.where(is_language("lang", a.lang)) if a.lang else rows
    names = [c.strip() for c in a.columns.split(",")] if a.columns else rows.columns
    sinks.write_parquet(rows.select(*names), a.output)


def validate(spark, a, rules):
    counts = sinks.quarantine(judged(spark.read.parquet(a.input), rules), a.output, a.invalid)
    sinks.record_run(spark, a.step, counts["records_in"], counts["records_out"], counts["records_rejected"], a.run, a.dag or "", a.table or "monitoring.pipeline_runs")


@step
def validate_data(spark, a):
    validate(spark, a, snapshot_rules())


@step
def validate_delta(spark, a):
    validate(spark, a, delta_rules())


@step
def transform_data(spark, a):
    sinks.write_parquet(transform_snapshot(spark.read.parquet(a.input)), a.output)


@step
def transform_delta(spark, a):
    sinks.write_parquet(flattened(spark.read.parquet(a.input)), a.output)


@step
def fetch_delta_index(spark, a):
    sinks.write_result([r["file"] for r in readers.read_index(spark, a.input).collect()], a.output)


@step
def extract_delta(spark, a):
    sinks.write_parquet(readers.read_delta(spark, a.input, a.country, a.columns), a.output, sinks.BATCH_ROWS)


@step
def filter_delta(spark, a):
    rows = spark.read.parquet(a.input)
    rows = rows.where(is_language("lang", a.lang)) if a.lang else rows
    sinks.write_parquet(resolve(rows, a.columns or ",".join(rows.columns)), a.output)


@step
def normalize_categories(spark, a):
    made = taxonomy.normalize_categories(spark.read.parquet(a.input), taxonomy.parse_categories(readers.read_text(spark, a.taxonomy)))
    for rows, path in zip(made, (a.output, a.closure, a.principal)):
        sinks.write_parquet(rows, path)


@step
def normalize_ingredients(spark, a):
    parsed = taxonomy.parse_ingredients(readers.read_text(spark, a.taxonomy))
    roles = taxonomy.additive_roles(*(taxonomy.parse_ingredients(readers.read_text(spark, p)) for p in (a.additives, a.classes))) if a.additives and a.classes else {}
    made = ingredients.normalize_ingredients(spark.read.parquet(a.input), parsed, roles)
    for rows, path, name in zip(made, (a.output, a.products, a.parts, a.aliases), ("ingredients", "product_ingredients", "sous_ingredients", "ingredient_alias")):
        sinks.write_sorted(rows, path, sinks.ORDERS[name])


@step
def finalize_products(spark, a):
    sinks.write_parquet(finalize(spark.read.parquet(a.input), spark.read.parquet(a.principal)), a.output)


@step
def load_data(spark, a):
    sinks.replace_table(spark.read.parquet(a.input), a.table)


@step
def load_delta(spark, a):
    keys = [k for k in (a.key, a.key2) if k]
    sinks.upsert(spark.read.parquet(a.input), a.table, keys or None)


@step
def merge_data(spark, a):
    sinks.upsert(spark.read.parquet(a.input), a.table, ["code"])


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="catalyne")
    parser.add_argument("step", choices=sorted(STEPS))
    for name, about in OPTIONS.items():
        parser.add_argument(f"--{name}", help=about, default={"country": COUNTRY, "run": os.environ.get("RUN_ID")}.get(name))
    a = parser.parse_args(argv)
    STEPS[a.step](SparkSession.getActiveSession() or session(), a)


if __name__ == "__main__":
    main()
