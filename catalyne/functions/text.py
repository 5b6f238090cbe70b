"""Text as columns: names, tags, slugs, tokens, addresses."""

from __future__ import annotations

import ast
import re
from collections.abc import Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import folding

ColumnOrName = Column | str

#: Words that carry no meaning in product texts.
STOPWORDS = ["a", "al", "and", "au", "aux", "avec", "bio", "canada", "canadian", "dans", "de", "des", "du", "en", "et", "for", "free", "from", "la", "le", "les", "of", "organic", "partly", "pour", "sans", "skim", "the", "to", "with"]
LANGUAGE_PREFIX = "^[a-z]{2,3}:"
IMAGE_SIZE = "400"


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnOrName) -> Column:
    """Without any white space around it."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\s+", " "))


def presence(c: Column) -> Column:
    """Null instead of an empty text."""
    return F.nullif(c, F.lit(""))


def fold_accents(c: ColumnOrName, compatible: bool = True) -> Column:
    """Letters without their accents; compatible: ligatures and the like are taken apart as well."""
    return folding.fold(col(c), compatible)


def without_language(c: ColumnOrName) -> Column:
    return F.regexp_replace(col(c), LANGUAGE_PREFIX, "")


def clean_name(c: ColumnOrName) -> Column:
    """A tag as a label: `en:plant-based-foods` gives `Plant based foods`."""
    plain = strip(F.replace(without_language(c), F.lit("-"), F.lit(" ")))
    return F.concat(F.upper(F.substring(plain, 1, 1)), F.lower(F.substring(plain, 2, 1 << 30)))


def search_key(c: ColumnOrName) -> Column:
    """What tolerant filters compare: no language prefix, spaces for hyphens, lower case; empty for null."""
    return F.lower(F.replace(without_language(F.coalesce(col(c), F.lit(""))), F.lit("-"), F.lit(" ")))


def tag_name(c: ColumnOrName) -> Column:
    """The readable name of a tag: what follows its first colon, with spaces for hyphens and underscores."""
    c = col(c)
    bare = F.when(F.contains(c, F.lit(":")), F.substring_index(F.regexp_replace(c, "^[^:]*:", "\u0001:"), "\u0001:", -1)).otherwise(c)
    return F.translate(bare, "-_", "  ")


def clean_text(c: ColumnOrName, fold: bool = True) -> Column:
    """Letters, digits and a few signs, one space between words. fold: False where a text is known to be plain."""
    x = F.translate(fold_accents(c) if fold else col(c), "_", " ")
    x = F.regexp_replace(x, "<[^>]+>", " ")
    return squeeze(F.regexp_replace(x, r"[^a-zA-Z0-9%+\-/,:.\s]", " "))


def slug(c: ColumnOrName, fold: bool = True) -> Column:
    x = F.translate(F.lower(clean_text(c, fold)), "/,", "  ")
    return F.btrim(F.regexp_replace(F.regexp_replace(x, r"\s+", "-"), "-+", "-"), F.lit("-"))


def normalized(c: ColumnOrName, prefix: bool = True, fold: bool = True) -> Column:
    """The form that search and similarity compare. prefix: language prefixes go, as in the service; the page keeps them."""
    x = F.lower(F.coalesce(col(c), F.lit("")))
    x = fold_accents(x, compatible=False) if fold else x
    x = without_language(x) if prefix else x
    return squeeze(F.regexp_replace(F.translate(x, "-", " "), "[^a-z0-9 ]", " "))


def tokens(norm: ColumnOrName) -> Column:
    """Meaningful tokens of a normalized text: two letters or more, no number, no stop word."""
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    return F.filter(F.split(col(norm), " "), lambda t: (F.length(t) > 1) & ~t.rlike("^[0-9]+$") & ~F.array_contains(stop, t))


def seed_query(norm: ColumnOrName) -> Column:
    """The first two meaningful tokens."""
    return F.array_join(F.slice(tokens(norm), 1, 2), " ")


def compact(c: ColumnOrName) -> Column:
    return F.replace(col(c), F.lit(" "), F.lit(""))


def to_tag(lang: str, c: ColumnOrName) -> Column:
    return F.concat(F.lit(f"{lang}:"), F.replace(F.lower(strip(c)), F.lit(" "), F.lit("-")))


def is_language_code(c: ColumnOrName) -> Column:
    return col(c).rlike(r"^\p{L}{2,3}$")


def code_path(c: ColumnOrName) -> Column:
    """`3017620422003` gives `301/762/042/2003`; shorter codes are filled up with zeros, longer ones keep their end."""
    c = col(c)
    full = F.when(F.length(c) < 13, F.lpad(c, 13, "0")).otherwise(c)
    return F.concat_ws("/", F.substring(full, 1, 3), F.substring(full, 4, 3), F.substring(full, 7, 3), F.substring(full, 10, 1 << 30))


def image_url(base: str, code: ColumnOrName, key: ColumnOrName, rev: ColumnOrName) -> Column:
    """Null where the revision is."""
    rev = F.regexp_replace(col(rev).cast("string"), "[\"']", "")
    return F.concat(F.lit(base.rstrip("/") + "/"), code_path(code), F.lit("/"), col(key), F.lit("."), rev, F.lit(f".{IMAGE_SIZE}.jpg"))


def category_path(c: ColumnOrName) -> Column:
    """`a > b > c`, each label once."""
    return F.array_join(F.array_distinct(col(c)), " > ")


def semantic_text(**parts: Column) -> Column:
    """Labelled lines; blank ones are left out."""
    return F.concat_ws("\n", *[F.when(strip(c) != "", F.concat(F.lit(f"{label}: "), c)) for label, c in parts.items()])


def digit_stem(c: ColumnOrName, sep: str = "_") -> Column:
    """The last two groups of digits of a file's name; null with fewer."""
    groups = F.regexp_extract_all(col(c), F.lit("([0-9]+)"), 1)
    return F.when(F.size(groups) >= 2, F.array_join(F.slice(groups, -2, 2), sep))


def quoted_items(c: ColumnOrName) -> Column:
    """What stands in single quotes: `['en:a', 'en:b']` gives two items."""
    return F.regexp_extract_all(col(c), F.lit("'([^']+)'"), 1)


def free_list(c: ColumnOrName) -> Column:
    """A text cut at line ends, commas and semicolons, without blank items."""
    return F.filter(F.transform(F.split(col(c), r"[\n,;]+"), strip), lambda x: x != "")


def first_text(*cols: ColumnOrName) -> Column:
    """The first that isn't blank."""
    return F.coalesce(*[presence(strip(c)) for c in cols])


def top_labels(c: ColumnOrName, n: int = 2) -> Column:
    return F.coalesce(presence(F.array_join(F.slice(col(c), 1, n), ", ")), F.lit("—"))


#: Columns that an ingredient text is taken from, in order.
INGREDIENT_TEXTS = ("ingredients_text", "ingredients_text_fr", "ingredients_text_en", "ingredients_text_de", "ingredients_text_es", "ingredients_text_it")
#: What a URL's component keeps besides letters and digits, and Java's form encoding changes.
URL_SIGNS = {"+": "%20", "%21": "!", "%27": "'", "%28": "(", "%29": ")", "%7E": "~"}


def ingredient_text(columns: Sequence[tuple[str, str]]) -> Column:
    """The first ingredient text that isn't blank, as it is: of the columns in their fixed order, then of any other language
    in order of name. columns: a frame's names and types; those that it lacks, or that are no text, don't count."""
    texts = [c for c, kind in columns if kind == "string"]
    others = sorted(c for c in texts if re.fullmatch("ingredients_text_[a-z]{2}", c) and c not in INGREDIENT_TEXTS)
    found = [F.when(strip(c) != "", F.col(c)) for c in [*(c for c in INGREDIENT_TEXTS if c in texts), *others]]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def ingredient_list(columns: Sequence[tuple[str, str]], most: int | None = None) -> Column:
    """A product's ingredients to show: the items of `ingredients`, as labels if the first has a language before it; else those of
    `ingredients_tags`, an array or a printed list, as labels; else the parts of its ingredient text. No items: an empty list."""
    kinds = dict(columns)
    none = F.array().cast("array<string>")

    def items(name: str) -> Column:
        if name not in kinds:
            return none
        return F.coalesce(F.col(name) if kinds[name].startswith("array") else quoted_items(name), none)

    def labels(c: Column, prefix: str) -> Column:
        return F.transform(c, lambda x: F.replace(F.regexp_replace(x, prefix, ""), F.lit("-"), F.lit(" ")))

    own, tags = items("ingredients") if kinds.get("ingredients", "").startswith("array") else none, items("ingredients_tags")
    shown = F.when(F.coalesce(F.get(own, F.lit(0)), F.lit("")).rlike(LANGUAGE_PREFIX), labels(own, LANGUAGE_PREFIX)).otherwise(own)
    text = F.coalesce(free_list(ingredient_text(columns)), none)
    out = F.when(F.size(own) > 0, shown).when(F.size(tags) > 0, labels(tags, "^[a-z]{2}:")).otherwise(text)
    return F.slice(out, 1, most) if most else out


def url_component(c: ColumnOrName) -> Column:
    """A text as a part of a URL: everything but letters, digits and - _ . ! ~ * ' ( ) as bytes of UTF-8."""
    out = F.url_encode(col(c))
    for raw, safe in URL_SIGNS.items():
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def display_number(c: ColumnOrName, unit: str = "", decimals: int = 2) -> Column:
    """A number rounded half up to hundredths, with so many decimals and its unit; a dash for none."""
    number = col(c).cast("double")
    shown = F.replace(F.format_number(F.floor(number * 100 + 0.5) / 100, decimals), F.lit(","), F.lit(""))
    return F.when(number.isNull() | F.isnan(number), F.lit("—")).otherwise(F.concat(shown, F.lit(f" {unit}" if unit else "")))


def escape_html(c: ColumnOrName) -> Column:
    c = col(c)
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def split_property(c: ColumnOrName) -> Column:
    """The values of a taxonomy property: `en: en:a, en:b` gives two tags."""
    bare = F.regexp_replace(strip(c), r"^[a-z]{2,3}:\s*", "")
    return F.filter(F.transform(F.split(F.lower(bare), ","), strip), lambda x: x != "")


def stable_id(c: ColumnOrName) -> Column:
    """A positive 63-bit number that a text always gets: the first half of its MD5."""
    half = F.conv(F.substring(F.md5(col(c).cast("binary")), 1, 16), 16, 10).cast("decimal(20,0)")
    return (half % F.lit(str(1 << 63)).cast("decimal(20,0)")).cast("long")


@F.pandas_udf(T.ArrayType(T.StringType()))
def literal_list(s: pd.Series) -> pd.Series:
    """The texts of a list that was written as a program would print it; anything else gives no items."""

    def one(x: str | None) -> list[str]:
        try:
            found = ast.literal_eval(x) if x else []
        except (ValueError, SyntaxError, MemoryError, RecursionError):
            return []
        return [str(v) for v in found] if isinstance(found, (list, tuple)) else []

    return s.map(one)


def similar(query: str, field: str) -> float:
    return SequenceMatcher(None, query, field).ratio()


def fuzzy(query: str, field: str | None) -> float:
    """How well a query fits a field or a stretch of its words, 0 to 1."""
    if not query or not field:
        return 0.0
    if query in field:
        return 1.0
    if query.replace(" ", "") in field.replace(" ", ""):
        return 0.95
    words, n = field.split(), len(query.split()) or 1
    stretches = {field, *words}
    for size in (n, n + 1):
        stretches.update(" ".join(words[i : i + size]) for i in range(len(words) - size + 1))
    return max(similar(query, s) for s in stretches)


def fuzzy_ratio(query: str, c: ColumnOrName) -> Column:
    """fuzzy() of a fixed query; for the few rows that a search has narrowed down."""
    return F.pandas_udf(lambda s: s.map(lambda x: fuzzy(query, x)).astype(float), T.DoubleType())(col(c))


def ratio_bound(query: str, c: ColumnOrName) -> Column:
    """What plain_ratio() of a fixed query can't exceed: the letters that both have, each as often as the one that has fewer,
    twice over the letters of both. Null counts as empty."""
    field = F.coalesce(col(c), F.lit(""))
    shared = F.lit(0)
    for letter in sorted(set(query)):
        shared = shared + F.least(F.lit(query.count(letter)), F.length(field) - F.length(F.replace(field, F.lit(letter), F.lit(""))))
    both = F.length(field) + len(query)
    return F.when(both > 0, 2 * shared / both).otherwise(1.0)


def plain_ratio(query: str, c: ColumnOrName) -> Column:
    return F.pandas_udf(lambda s: s.map(lambda x: similar(query, x or "")).astype(float), T.DoubleType())(col(c))
