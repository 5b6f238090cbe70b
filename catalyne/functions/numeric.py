"""Numbers as columns: features, grades, vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, col

#: What each grade counts.
GRADES = {"a": 5, "b": 4, "c": 3, "d": 2, "e": 1}


def finite(c: ColumnOrName) -> Column:
    """The number, or null where there is none, or none that is finite."""
    x = F.try_cast(col(c).cast("string"), "double") if hasattr(F, "try_cast") else col(c).cast("string").try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def log_feature(c: ColumnOrName) -> Column:
    """log(1 + x) of what is above 0, else 0."""
    return F.log1p(F.greatest(F.coalesce(finite(c), F.lit(0.0)), F.lit(0.0)))


def grade_value(c: ColumnOrName) -> Column:
    """a to e as 5 to 1; null for anything else."""
    values = F.create_map(*[F.lit(x) for pair in GRADES.items() for x in pair])
    return F.try_element_at(values, F.lower(F.trim(col(c))))


def valid_grade(c: ColumnOrName) -> Column:
    return F.when(grade_value(c).isNotNull(), F.lower(F.trim(col(c))))


def vector(*cols: Column) -> Column:
    return F.array(*[c.cast("double") for c in cols])


def total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: ColumnOrName, b: ColumnOrName) -> Column:
    return total(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: ColumnOrName) -> Column:
    return F.sqrt(total(F.transform(col(a), lambda x: x.cast("double") * x.cast("double"))))


def cosine(a: ColumnOrName, b: ColumnOrName) -> Column:
    """0 where a vector is empty, null or zero, or where lengths differ."""
    length = norm(a) * norm(b)
    return F.coalesce(F.when((length > 0) & (F.size(col(a)) == F.size(col(b))), dot(a, b) / length), F.lit(0.0))


def euclidean_similarity(a: ColumnOrName, b: ColumnOrName) -> Column:
    """1 less the distance over the sum of the lengths, 0 at least; 0 where both are zero."""
    gap = F.sqrt(total(F.zip_with(col(a), col(b), lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))))
    length = norm(a) + norm(b)
    return F.coalesce(F.when(length > 0, F.greatest(F.lit(0.0), 1 - gap / length)), F.lit(0.0))


def percent(c: ColumnOrName) -> Column:
    return F.round(col(c) * 100).cast("int")


def tier(c: ColumnOrName) -> Column:
    """How far a product is processed, by its number of ingredients."""
    n = F.round(col(c))
    return F.when(n <= 10, "low").when(n <= 20, "medium").when(n.isNotNull(), "high")


def band(c: ColumnOrName) -> Column:
    """A contribution of 0 to 1 as a band."""
    p = F.floor(col(c) * 100 + 0.5)
    return F.when(p >= 60, "good").when(p >= 30, "fair").when(p.isNotNull(), "poor")


def rate(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """part of whole in percent, to two places; 0 of nothing."""
    return F.when(col(whole) > 0, F.round(col(part) / col(whole) * 100, 2)).otherwise(0.0)
