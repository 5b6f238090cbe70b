"""Predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.nested import tag_list
from ..functions.numeric import valid_grade
from ..functions.text import ColumnOrName, col, normalized, strip

#: Grades that each score can have.
NUTRISCORE_GRADES = ("a", "b", "c", "d", "e")
ECOSCORE_GRADES = ("a-plus", "a", "b", "c", "d", "e", "f")
#: The page's limits for a hundred grams.
DEFAULT_LIMITS = {"salt_100g": 5.0, "sugars_100g": 100.0, "energy_kcal_100g": 1000.0, "fat_100g": 100.0}


def true(c: Column) -> Column:
    """False for null."""
    return F.coalesce(c, F.lit(False))


def has_tag(tags: ColumnOrName, part: str, kind: str = "array<string>") -> Column:
    """Whether any tag contains a text, in any case. kind: the column's type; tags that are a text are a printed list, and
    a text that is none has no tags."""
    return true(F.exists(tag_list(tags, kind), lambda t: F.contains(F.lower(t), F.lit(part.lower()))))


def is_language(c: ColumnOrName, language: str) -> Column:
    return true(F.lower(col(c)) == language.lower())


def contains_text(c: ColumnOrName, text: str, wildcards: bool = False) -> Column:
    """Whether a column contains a text, in any case. wildcards: % and _ in the text stand for other characters."""
    lowered = F.lower(col(c))
    return true(lowered.like(f"%{text.lower()}%") if wildcards else F.contains(lowered, F.lit(text.lower())))


def listed_or_null(c: ColumnOrName, values) -> Column:
    return F.when(col(c).isin(*values), col(c))


def not_blank(c: ColumnOrName) -> Column:
    return true(strip(c) != "")


def has_letter(c: ColumnOrName) -> Column:
    return true(col(c).rlike("[a-zA-Z]"))


def within(limits: dict[str, float]) -> Column:
    """Whether no known value is above its limit."""
    out = F.lit(True)
    for name, most in limits.items():
        out = out & (F.col(name).isNull() | (F.col(name) <= most))
    return out


def page_filter(grades: set[str] | None = None, **limits: float) -> Column:
    """The page's filter: one of the chosen grades, if any is chosen, and no value above its limit."""
    chosen = true(valid_grade("nutriscore_grade").isin(*[g.lower() for g in grades])) if grades else F.lit(True)
    return chosen & within(DEFAULT_LIMITS | limits)


def brand_matches(c: ColumnOrName, brand: str | None, normal: bool = False) -> Column:
    """Whether a brand contains another, both normalized. normal: the column already is."""
    if not brand:
        return F.lit(True)
    return F.contains(F.coalesce(col(c) if normal else normalized(c), F.lit("")), normalized(F.lit(brand)))


def pending(c: ColumnOrName, checkpoint: str | None) -> Column:
    """Names after the checkpoint; all without one."""
    return F.lit(True) if checkpoint is None else col(c) > checkpoint
