"""Taxonomies and the category forest: parsing, canonical tags, ancestors."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nested import last, tag_list
from ..functions.text import stable_id, strip
from ..schemas import CATEGORIES, CLOSURE, PRINCIPAL
from ..sources.files import endless_recursion, written
from ..sources.sinks import empty

#: Parent steps that are followed: all of them; what has been seen is the guard against cycles.
MAX_DEPTH = 1 << 30


@dataclass
class Taxonomy:
    """canonical: any tag to its canonical one; parents: a canonical tag to its parent; properties: by canonical tag."""

    canonical: dict[str, str] = field(default_factory=dict)
    parents: dict[str, str | None] = field(default_factory=dict)
    properties: dict[str, dict[str, str]] = field(default_factory=dict)

    def tags(self, spark: SparkSession) -> DataFrame:
        """(tag, canonical); a table of the taxonomy's size, broadcast while Spark finds it small."""
        return spark.createDataFrame(list(self.canonical.items()) or [], "tag string, canonical string")

    def edges(self, spark: SparkSession) -> DataFrame:
        """(tag, parent) of the tags that have one."""
        return spark.createDataFrame([(t, p) for t, p in self.parents.items() if p], "tag string, parent string")


def blocks(text: str) -> list[list[str]]:
    """Runs of lines without blank or comment lines between, less the lines on stop words and synonyms."""
    out: list[list[str]] = [[]]
    for line in map(str.strip, text.splitlines()):
        if not line or line[0] == "#":
            out.append([])
        elif not line.startswith(("stopwords:", "synonyms:")):
            out[-1].append(line)
    return [b for b in out if b]


def entry(line: str) -> tuple[str, list[str], str] | None:
    """(key, values, all of the rest) of a `key: a, b` line."""
    key, colon, rest = line.partition(":")
    return (key.strip(), [v.strip() for v in rest.split(",") if v.strip()], rest.strip()) if colon else None


def category_tag(language: str, value: str) -> str:
    return f"{language.strip()}:{value.strip().lower().replace(' ', '-')}"


def parse_categories(text: str) -> Taxonomy:
    """A block is a category: its first English value is canonical, the values from there on are its synonyms (the first block
    that claims a synonym has it), and its last `<` line is its parent."""
    out = Taxonomy()
    for block in blocks(text):
        parents = [x[2:].strip().lower() for x in block if x.startswith("< ")]
        entries = [e for x in block if not x.startswith("< ") and (e := entry(x)) and e[1]]
        start = next((i for i, (key, _, _) in enumerate(entries) if key == "en"), None)
        if start is None:
            continue
        own = category_tag("en", entries[start][1][0])
        out.canonical[own] = own
        for key, values, _ in entries[start:]:
            for v in values:
                out.canonical.setdefault(category_tag(key, v), own)
        if parents:
            language, colon, value = parents[-1].partition(":")
            out.parents[own] = category_tag(language, value) if colon else language.replace(" ", "-")
        else:
            out.parents[own] = None
    return out


def plain_text(x: str) -> str:
    """clean_text() of functions.text, for the driver."""
    folded = "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    return " ".join(re.sub(r"[^a-zA-Z0-9%+\-/,:.\s]", " ", re.sub(r"<[^>]+>", " ", folded.replace("_", " "))).split())


def plain_slug(x: str) -> str:
    return re.sub(r"-+", "-", "-".join(re.sub("[/,]", " ", plain_text(x).lower()).split())).strip("-")


def readable(tag: str) -> str:
    """tag_name() of functions.text, for the driver."""
    return tag.partition(":")[2].replace("-", " ").replace("_", " ") if ":" in tag else tag.replace("-", " ").replace("_", " ")


def parse_ingredients(text: str) -> Taxonomy:
    """As parse_categories(), with tags from slugs. Before a block's first English name that makes a tag, nothing counts.
    After it, names of any language are synonyms, other keys are properties (the last of each key stands), and `<` lines are
    joined into the property `parents`."""
    out = Taxonomy()
    for block in blocks(text):
        records = [(x, None if x.startswith("< ") else entry(x)) for x in block]
        start = next((i for i, (_, e) in enumerate(records) if e and e[0] == "en" and e[1] and plain_slug(e[1][0])), None)
        if start is None:
            continue
        rest = records[start:]
        names = [(e[0], e[1]) for _, e in rest if e and is_language_key(e[0])]
        properties = {e[0]: e[2] for _, e in rest if e and not is_language_key(e[0])}
        above = [p for x, e in rest if x.startswith("< ") and (p := x[2:].strip().lower())]
        own = f"en:{plain_slug(records[start][1][1][0])}"
        tags = [f"{language}:{s}" for language, values in names for v in values if (s := plain_slug(v))]
        out.canonical[own] = own
        for t in tags:
            out.canonical.setdefault(t, own)
        held = out.properties.setdefault(own, {})
        held |= properties
        if above:
            held["parents"] = ",".join(filter(None, [held.get("parents"), *above]))
    return out


def is_language_key(key: str) -> bool:
    return re.fullmatch(r"[^\W\d_]{2,3}", key) is not None


def additive_roles(additives: Taxonomy, classes: Taxonomy) -> dict[str, str]:
    """A role for each additive that has classes: the readable name of the first one's canonical tag."""
    out = {}
    for tag, props in additives.properties.items():
        listed = re.sub(r"^[a-z]{2,3}:\s*", "", props.get("additives_classes", "").strip()).lower().split(",")
        names = (readable(classes.canonical.get(c.strip(), c.strip())) for c in listed if c.strip())
        if role := next(filter(None, names), None):
            out[tag.lower()] = role
    return out


def canonical_tags(products: DataFrame, tags: DataFrame, column: str = "categories_tags") -> DataFrame:
    """(code, tags): each product's tags in canonical form, unknown ones as they are, first occurrences in order. Products
    without tags have none."""
    items = products.select("code", tag_list(column, dict(products.dtypes)[column]).alias("raw")).withColumn("row", F.monotonically_increasing_id())
    each = items.select("row", "code", F.posexplode("raw").alias("pos", "raw")).withColumn("tag", F.lower(strip("raw"))).where("tag <> ''")
    named = each.join(tags, "tag", "left").select("row", "code", "pos", F.coalesce("canonical", "tag").alias("tag"))
    lists = named.groupBy("row", "code").agg(F.array_sort(F.collect_list(F.struct("pos", "tag"))).alias("t"))
    return lists.select("code", F.array_distinct(F.col("t.tag")).alias("tags"))


def closure(edges: DataFrame, start: DataFrame | None = None, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(tag, ancestor, distance) over (tag, parent) edges, of all tags or of those in start (tag). Every step counts; a tag is
    never its own ancestor, and nothing is followed beyond max_depth or round a cycle."""
    spark = edges.sparkSession
    first = edges.join(start.select("tag").distinct(), "tag", "left_semi") if start is not None else edges
    with endless_recursion(spark):
        up = spark.sql(
            f"""
            WITH RECURSIVE up(tag, ancestor, distance, seen) AS (
              SELECT tag, parent, 1, array(tag, parent) FROM {{first}} WHERE tag <> parent
              UNION ALL
              SELECT u.tag, e.parent, u.distance + 1, array_append(u.seen, e.parent)
              FROM up u JOIN {{edges}} e ON u.ancestor = e.tag
              WHERE u.distance < {int(max_depth)} AND NOT array_contains(u.seen, e.parent)
            )
            SELECT tag, ancestor, distance FROM up
            """,
            first=first,
            edges=edges,
        )
        return written(up, "closure")


def normalize_categories(products: DataFrame, taxonomy: Taxonomy) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(categories, closure, principal category by product). Categories are the tags in use and all of their ancestors, under
    a stable number; a product's principal category is its last tag. Without a categories_tags column: empty tables."""
    spark = products.sparkSession
    if "categories_tags" not in products.columns:
        return empty(spark, CATEGORIES), empty(spark, CLOSURE), empty(spark, PRINCIPAL)
    tagged = canonical_tags(products, taxonomy.tags(spark))
    used = tagged.select(F.explode("tags").alias("tag")).distinct()
    # Of the whole taxonomy, once: ancestors are categories as well, with ancestors of their own.
    above = closure(taxonomy.edges(spark))
    names = used.union(above.join(used, "tag", "left_semi").select("ancestor")).distinct()
    every = above.join(names, "tag", "left_semi")
    categories = names.select(stable_id("tag").alias("category_id"), F.col("tag").alias("category_name"))
    links = every.select(stable_id("tag").alias("category_id"), stable_id("ancestor").alias("category_id_parent"), F.col("distance").cast("int").alias("distance"))
    ends = products.select("code").join(tagged.select("code", last("tags").alias("tag")), "code", "left")
    return categories, links, ends.select("code", stable_id("tag").alias("categorie_principale")).distinct()
