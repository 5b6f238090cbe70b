"""Validation: named rules, a verdict for each row, counts of failures."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import not_blank, true


@dataclass(frozen=True)
class Rule:
    """A condition that a valid row meets; null counts as not met."""

    name: str
    test: Column


def snapshot_rules(nutrients: str = "nutriments") -> list[Rule]:
    """What a record of the snapshot must have."""
    return [
        Rule("code_present", F.col("code").isNotNull()),
        Rule("code_not_blank", not_blank(F.col("code").cast("string"))),
        Rule("name_present", F.col("product_name").isNotNull()),
        Rule(f"{nutrients}_present", F.col(nutrients).isNotNull()),
        Rule("categories_present", F.col("categories_tags").isNotNull()),
    ]


def delta_rules() -> list[Rule]:
    """What a record of a delta must have."""
    return snapshot_rules("nutrition")


def judged(rows: DataFrame, rules: Sequence[Rule], flag: str = "valid") -> DataFrame:
    """rows with a flag: whether all rules hold."""
    verdict = F.lit(True)
    for r in rules:
        verdict = verdict & true(r.test)
    return rows.withColumn(flag, verdict)


def failures(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, failed): how many rows fail each rule, in one pass."""
    counts = rows.agg(*[F.count_if(~true(r.test)).alias(r.name) for r in rules])
    return counts.unpivot([], [r.name for r in rules], "rule", "failed")


def summary(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(records_in, records_out, records_rejected, rejection_rate)."""
    counts = judged(rows, rules).agg(F.count("*").alias("records_in"), F.count_if("valid").alias("records_out"))
    rejected = F.col("records_in") - F.col("records_out")
    share = F.when(F.col("records_in") > 0, F.round(rejected / F.col("records_in") * 100, 2)).otherwise(0.0)
    return counts.select("records_in", "records_out", rejected.alias("records_rejected"), share.alias("rejection_rate"))
